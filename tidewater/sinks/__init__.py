"""Writers: batch-keyed tables, DB-API apply, report files."""
