"""Structured Streaming jobs wiring the operators into foreachBatch."""
