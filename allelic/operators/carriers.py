"""Point lookups at one locus.

The contig predicate prunes partitions and ``start = x`` reaches the Parquet
reader as a pushed filter; with files sorted by ``start`` (see
``allelic.plans.layout``) row-group statistics skip nearly everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import clnsig_col, gene_col, is_carrier, zygosity


def _at_locus(calls: DataFrame, contig: str, start: int, gene: str | None = None) -> DataFrame:
    df = calls.where((F.col("reference_name") == F.lit(contig)) & (F.col("start") == F.lit(start)))
    if gene not in (None, "", "All"):
        df = df.where(gene_col(df) == F.lit(gene))
    return df


def carrier_lookup(calls: DataFrame, contig: str = "chr21", start: int = 25891796,
                   gene: str | None = None) -> DataFrame:
    """Carriers (0/1, 1/1) at a locus with zygosity label and annotations."""
    df = _at_locus(calls, contig, start, gene).where(is_carrier())
    return df.select(
        "sample_id", "reference_name", "start", "reference_bases", "alternate_bases", "genotype",
        zygosity().alias("zygosity"),
        F.col("dp").alias("read_depth"), F.col("gq").alias("genotype_quality"),
        "allele_depth",
        gene_col(df).alias("gene_symbol"), clnsig_col(df).alias("clinical_significance"),
    ).orderBy("sample_id", "reference_bases", "alternate_bases")


def carrier_lookup_plain(calls: DataFrame, contig: str = "chr21", start: int = 25891796,
                         gene: str | None = None, store_id: str | None = None) -> DataFrame:
    """Carriers with raw dp/gq; with ``store_id`` the store tag comes first
    and a null ``engine`` is filled with it."""
    df = _at_locus(calls, contig, start, gene).where(is_carrier())
    cols = ["sample_id", "reference_name", "start", "reference_bases", "alternate_bases",
            "genotype", "dp", "gq", "allele_depth",
            gene_col(df).alias("gene_symbol"), clnsig_col(df).alias("clinical_significance")]
    if store_id is not None:
        cols = [F.coalesce(F.col("engine"), F.lit(store_id)).alias("engine")] + cols
    return df.select(*cols)


def locus_calls(calls: DataFrame, contig: str = "chr21", start: int = 25891796,
                limit: int | None = None) -> DataFrame:
    """Every call at a locus (no genotype filter)."""
    df = (_at_locus(calls, contig, start)
          .select("sample_id", "genotype", "qual", "dp")
          .orderBy("sample_id", "genotype"))
    return df.limit(limit) if limit else df
