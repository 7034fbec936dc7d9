"""ledgerlake: a Spark-native monthly claims lakehouse.

Monthly delimited text extracts land as an all-text *bronze* table partitioned by month; a
declarative column contract types and renames them into *silver*, every row that breaks a rule
goes to a *quarantine* with its original text and the list of reasons, and each run proves that
silver plus quarantine equals bronze in rows and money. Code labels from several sources are merged
by per-column priority into one dimension, and *gold* marts give monthly spending per service and
per region, guarded by data checks. Everything is DataFrame / Column expressions on Parquet.
"""

__version__ = "0.1.0"
