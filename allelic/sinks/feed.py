"""Online feed (B8): stamp the store tag, give records without a cohort the
default one, append.  No dedupe: a record fed twice is
stored twice (replays of the same batch id are handled by the partitioned
overwrite in ``write_batch``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.schema import CALL_COLUMNS
from allelic.sinks.writers import write_batch

FEED_COHORT = "online_feed"


def stamp(records: DataFrame, store_id: str, cohort_id: str = FEED_COHORT) -> DataFrame:
    df = records.withColumn("engine", F.lit(store_id))
    given = F.col("cohort_id") if "cohort_id" in df.columns else F.lit(None).cast("string")
    return df.withColumn("cohort_id", F.coalesce(given, F.lit(cohort_id)))


def feed(existing: DataFrame, records: DataFrame, store_id: str,
         cohort_id: str = FEED_COHORT) -> DataFrame:
    new = stamp(records, store_id, cohort_id)
    cols = [c for c in CALL_COLUMNS if c in existing.columns or c in new.columns]
    return existing.unionByName(new, allowMissingColumns=True).select(*cols)


def feed_to_table(records: DataFrame, root: str, store_id: str, batch_id: str,
                  cohort_id: str = FEED_COHORT) -> DataFrame:
    """Append a fed batch to the partitioned table; returns a one-row
    telemetry frame (batch id, store, records, target)."""
    new = stamp(records, store_id, cohort_id)
    write_batch(new, root, batch_id)
    spark = records.sparkSession
    from allelic.sources.tables import read_warehouse
    n = read_warehouse(spark, root).where(F.col("batch_id") == batch_id).groupBy().count()
    return n.select(F.lit(batch_id).alias("batch_id"), F.lit(store_id).alias("engine"),
                    F.col("count").alias("records_ingested"), F.lit(root).alias("target_table"))
