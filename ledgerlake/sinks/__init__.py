"""Writers: idempotent month replacement, whole-table replacement, write metrics."""
