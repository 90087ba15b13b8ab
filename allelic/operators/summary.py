"""Ingest summary (C19) and per-partition file statistics.

The three columns that the summary needs are written once.  Calls collapse to
(sample, contig, genotype) counts: before the shuffle where that leaves few of
them, else dealt by sample to tasks of a bounded number of rows.  Then each
sample's counts of a level's key are one row, so distinct samples are rows to
count, and no task holds a level's samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.plans.joins import deal
from allelic.session import scratch_path

LEVELS = ["reference_name", "genotype", "sample_id"]


def ingest_summary(calls: DataFrame) -> DataFrame:
    """Rows: (level, key, calls, distinct_samples) for the total, each
    contig, each genotype and each sample."""
    spark, path, rows = calls.sparkSession, scratch_path(calls.sparkSession, "summary_calls"), calls.select(*LEVELS)
    rows.write.parquet(path)
    rows = deal(spark.read.schema(rows.schema).parquet(path), ["sample_id"], LEVELS)
    pre = rows.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n"))
    keys = [F.struct(F.lit(c).alias("level"), F.col(c).alias("key")) for c in LEVELS]
    total = F.struct(F.lit("total").alias("level"), F.lit(None).cast("string").alias("key"))
    one = pre.select("sample_id", "n", F.explode(F.array(*keys, total)).alias("at")).groupBy("sample_id", "at.level", "at.key").agg(F.sum("n").alias("n"))
    return (one.groupBy("level", "key").agg(F.sum("n").alias("calls"), F.count("sample_id").alias("distinct_samples"))
            .orderBy("level", "key"))


def partition_stats(calls: DataFrame, partition_col: str = "reference_name") -> DataFrame:
    """Per-partition stats kept beside each batch: record count, start and
    sample_id ranges (what a table log would record per data file)."""
    return (calls.groupBy(partition_col)
                 .agg(F.count(F.lit(1)).alias("num_records"),
                      F.min("start").alias("min_start"), F.max("start").alias("max_start"),
                      F.min("sample_id").alias("min_sample_id"),
                      F.max("sample_id").alias("max_sample_id"))
                 .orderBy(partition_col))
