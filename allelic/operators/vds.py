"""Sparse split layout (B5, A8): variant rows with INFO, reference rows
without, and the inverse view back to calls.

The export is one pass over the calls: a row's table is an expression, and
one job writes ``table=variant_data`` / ``table=reference_data`` folders,
each parted by contig and sorted by position.  Reference rows have a null
INFO.  Beside the columns of the split format every row keeps quality,
filter, cohort and engine, reference rows the annotations of their site
(``site_info``), and rows whose depths are not plain numbers their text
(``ad_text``), so the calls come back whole; in sorted files these columns
are runs of one value.

Default mode keeps every original call: only ``0/0`` goes to reference
data, everything else (carriers, ``./.``, phased or multi-allelic calls)
stays in variant data with its genotype.  ``compat=True`` reproduces the
lossy split where every non-carrier call becomes a ``0/0`` reference row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.functions.genotype import is_carrier
from allelic.schema import CALL_COLUMNS

VDS_VERSION, GENOME = "v1.0", "GRCh38"
VARIANT_TABLE, REFERENCE_TABLE = "variant_data", "reference_data"
SPLIT_COLUMNS = ["locus_contig", "locus_position", "alleles", "sample_id", "call", "dp", "gq", "ad", "info"]
KEPT_COLUMNS = ["qual", "filter", "cohort_id", "engine", "site_info", "ad_text"]


def _depths(ad) -> Column:
    return F.array_join(F.transform(ad, lambda x: x.cast("string")), ",")


def split_rows(calls: DataFrame, compat: bool = False) -> DataFrame:
    """Every call as a row of the split layout, with its ``table``."""
    ad = F.transform(F.filter(F.split("allele_depth", ","), lambda x: x.rlike("^[0-9]+$")),
                     lambda x: x.try_cast("int"))
    variant = F.coalesce(is_carrier() if compat else F.col("genotype") != "0/0", F.lit(not compat))
    call = F.when(variant, F.col("genotype")).otherwise(F.lit("0/0")) if compat else F.col("genotype")
    return calls.select(
        F.when(variant, VARIANT_TABLE).otherwise(REFERENCE_TABLE).alias("table"),
        F.col("reference_name").alias("locus_contig"), F.col("start").alias("locus_position"),
        F.array("reference_bases", "alternate_bases").alias("alleles"),
        "sample_id", call.alias("call"), "dp", "gq", ad.alias("ad"),
        F.when(variant, F.col("attributes")).alias("info"),
        "qual", "filter", "cohort_id", "engine", F.when(~variant, F.col("attributes")).alias("site_info"),
        F.when(~F.col("allele_depth").eqNullSafe(_depths(ad)), F.col("allele_depth")).alias("ad_text"))


def split_vds(calls: DataFrame, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    rows = split_rows(calls, compat)
    var = rows.where(F.col("table") == VARIANT_TABLE).drop("table")
    ref = rows.where(F.col("table") == REFERENCE_TABLE).drop("table", "info")
    return var, ref


def write_vds(spark: SparkSession, calls: DataFrame, path: str, compat: bool = False) -> dict:
    """Write both tables in one job and a small metadata record beside them."""
    keys = ["table", "locus_contig", "locus_position", "sample_id"]
    (split_rows(calls, compat).repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").partitionBy("table", "locus_contig").parquet(path))
    row = vds_counts(spark, path).first()
    info = {"version": VDS_VERSION, "reference_genome": GENOME,
            "variant_data_rows": row["variant_rows"], "reference_data_rows": row["reference_rows"]}
    spark.createDataFrame([(json.dumps(info),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/_vds_metadata")
    return info


def table_path(path: str, table: str) -> str:
    return f"{path}/table={table}"


def vds_counts(spark: SparkSession, path: str) -> DataFrame:
    """(variant_rows, reference_rows) in one scan of the export."""
    t = spark.read.parquet(path).select("table")
    return t.agg(F.count(F.when(F.col("table") == VARIANT_TABLE, 1)).alias("variant_rows"),
                 F.count(F.when(F.col("table") == REFERENCE_TABLE, 1)).alias("reference_rows"))


def vds_to_calls(variant_data: DataFrame, reference_data: DataFrame) -> DataFrame:
    """Union both tables back into the call shape; what a table does not have
    is null (an export of the bare split columns has no quality, and no
    annotations on reference rows)."""
    u = variant_data.unionByName(reference_data, allowMissingColumns=True)
    types = {"qual": "double"}
    for c in KEPT_COLUMNS:
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast(types.get(c, "string")))
    out = u.select(
        F.col("locus_contig").alias("reference_name"),
        F.col("locus_position").cast("long").alias("start"),
        (F.col("locus_position") + F.length(F.col("alleles")[0]) - 1).cast("long").alias("end_pos"),
        F.col("alleles")[0].alias("reference_bases"),
        F.col("alleles")[1].alias("alternate_bases"),
        "sample_id", F.col("call").alias("genotype"), "qual", "filter", "dp", "gq",
        F.coalesce("ad_text", _depths(F.col("ad"))).alias("allele_depth"),
        F.coalesce("info", "site_info").alias("attributes"), "cohort_id", "engine")
    return out.select(*CALL_COLUMNS)
