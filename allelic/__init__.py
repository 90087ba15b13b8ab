"""allelic: Spark-native analytics over row-decomposed genomic variant calls.

The public API is plain functions ``(DataFrame..., params) -> DataFrame``.
Everything is expressed with the DataFrame API so Catalyst can push filters
into the Parquet scan, prune columns, and pick join strategies at runtime
(AQE).  No Python UDF runs in any hot path.
"""

from allelic.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
