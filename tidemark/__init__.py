"""tidemark: a Spark-native commerce data engine.

Versioned ingestion, record contracts, history-aware lookups, marts, quality
gates, verified Parquet snapshots and pipeline health, all expressed as
DataFrame / Spark SQL plans.
"""

__version__ = "0.1.0"
