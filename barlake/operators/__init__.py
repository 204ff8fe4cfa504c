"""Table-to-table transformations; all lazy unless the name says ``assert``."""
