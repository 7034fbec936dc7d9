"""Scans: raw text extracts, month-partitioned Parquet tables, label sources, test fixture."""
