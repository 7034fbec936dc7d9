"""DataFrame -> DataFrame operators of the pipeline (lazy, no I/O)."""
