"""Per-sample burden rollups.

Group key is (sample, gene): many small groups, so the partial aggregate
does most of the work before the shuffle.  A sample with a third of all
calls is still one group of algebraic aggregates, combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import PATHOGENIC, clnsig_col, dosage, gene_col, is_carrier, optional_eq


def _carriers_of_gene(calls: DataFrame, gene: str, contig: str | None) -> DataFrame:
    df = calls.where(optional_eq("reference_name", contig) & is_carrier())
    return df.where(gene_col(df) == F.lit(gene))


def gene_burden(calls: DataFrame, gene: str = "APP", contig: str | None = "chr21") -> DataFrame:
    """Per sample: distinct sites, alt-allele burden, pathogenic carrier calls."""
    df = _carriers_of_gene(calls, gene, contig)
    return (df.groupBy("sample_id", gene_col(df).alias("gene_symbol"))
              .agg(F.countDistinct("start").alias("distinct_variant_sites"),
                   F.sum(dosage()).cast("long").alias("total_alt_allele_burden"),
                   F.count(F.when(clnsig_col(df) == F.lit(PATHOGENIC), 1))
                    .alias("pathogenic_variant_count"))
              .orderBy(F.col("total_alt_allele_burden").desc(), F.col("sample_id")))


def gene_burden_plain(calls: DataFrame, gene: str = "APP", contig: str | None = "chr21") -> DataFrame:
    df = _carriers_of_gene(calls, gene, contig)
    return (df.groupBy("sample_id", gene_col(df).alias("gene_symbol"))
              .agg(F.countDistinct("start").alias("distinct_variant_sites"),
                   F.sum(dosage()).cast("long").alias("total_alt_allele_burden")))


def sample_call_counts(calls: DataFrame, contig: str | None = "chr21",
                       top: int | None = 20) -> DataFrame:
    """Calls per sample on a contig, largest first (top-k report)."""
    g = (calls.where(optional_eq("reference_name", contig))
              .groupBy("sample_id").agg(F.count(F.lit(1)).alias("burden_count"))
              .orderBy(F.col("burden_count").desc(), F.col("sample_id")))
    return g.limit(top) if top else g
