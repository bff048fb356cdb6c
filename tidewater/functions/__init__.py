"""Column builders: scalar functions of the change-event and text domain."""
