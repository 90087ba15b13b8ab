"""Readers with declared schemas (A3-A8): Parquet, JSON lines / arrays,
OMOP CSV extracts, the Hive-partitioned warehouse and the split layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from allelic.schema import (CALLS_IN, CONDITION, PERSON, REFERENCE_DATA, VARIANT_DATA, VDS_KEPT, WAREHOUSE,
                            conform_calls)


def read_calls_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Calls from Parquet with the declared schema; each file may name its end
    column ``end`` or ``end_pos``; partition columns (e.g. ``reference_name=``
    directories) are discovered, a batch id stays text."""
    df = spark.read.schema(CALLS_IN).parquet(path)
    if "batch_id" in df.columns:
        schema = T.StructType(CALLS_IN.fields + [T.StructField("batch_id", T.StringType())])
        df = spark.read.schema(schema).parquet(path)
    return conform_calls(df, keep_extra=True)


def read_calls_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Calls from JSON lines (or JSON arrays with ``multiline``)."""
    df = spark.read.schema(CALLS_IN).option("multiLine", multiline).json(path)
    return conform_calls(df)


def read_person_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PERSON).option("header", True).csv(path)


def read_conditions_csv(spark: SparkSession, path: str) -> DataFrame:
    # condition_start_date is declared as text: never inferred to a date.
    return spark.read.schema(CONDITION).option("header", True).csv(path)


def read_variant_data(spark: SparkSession, vds_path: str) -> DataFrame:
    """Variant rows of a split export folder."""
    return spark.read.schema(VARIANT_DATA).parquet(f"{vds_path}/table=variant_data")


def read_reference_data(spark: SparkSession, vds_path: str) -> DataFrame:
    """Reference rows of a split export folder (no INFO column)."""
    return spark.read.schema(REFERENCE_DATA).parquet(f"{vds_path}/table=reference_data")


def read_vds_calls(spark: SparkSession, vds_path: str) -> DataFrame:
    """An export of ``write_vds`` as the calls it was made from, in one scan;
    contig filters prune directories."""
    from allelic.operators.vds import vds_to_calls
    kept = T.StructType(VARIANT_DATA.fields + VDS_KEPT.fields)
    rows = spark.read.schema(kept).parquet(vds_path)
    return vds_to_calls(rows, rows.limit(0))


def read_warehouse(spark: SparkSession, root: str) -> DataFrame:
    """The ``batch_id=/part_id=/reference_name=`` layout with its declared
    schema; the part is a matter of the writer."""
    return spark.read.schema(WAREHOUSE).parquet(root)


def scan_contig(spark: SparkSession, root: str, contig: str | None) -> DataFrame:
    """Calls of one contig from the partitioned warehouse: the predicate on
    the partition column prunes directories (``PartitionFilters``)."""
    df = read_warehouse(spark, root)
    return df if contig in (None, "", "All") else df.where(F.col("reference_name") == contig)
