"""parcelflow: parcel-delivery event analytics on Spark.

Contracts and ingest, silver/gold models, SCD2 snapshots, KPI views and
declarative data tests, written as DataFrame / Spark SQL / Structured
Streaming jobs. Every function takes and returns DataFrames; parameters
such as ``as_of``, ``days`` and ``run_ts`` are explicit so results are
reproducible.
"""

__version__ = "0.1.0"
