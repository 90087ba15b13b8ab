"""Site-level frequency operators.

All are a filter (pushed to the scan / partition pruned on
``reference_name``) followed by one hash aggregate on the site key.  The
aggregates are algebraic (count / sum) so a hot site is pre-aggregated
map-side; ``countDistinct`` is planned by Catalyst as a two-level aggregate
over (site, sample), which also spreads a hot site over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import (clnsig_col, dosage, gene_col, is_called, is_carrier,
                                        optional_eq)

SITE_KEY = ["reference_name", "start", "reference_bases", "alternate_bases"]


def allele_frequency(calls: DataFrame, contig: str | None = "chr21",
                     filter_value: str | None = "PASS", normalise: bool = False) -> DataFrame:
    """AC / AN / AF per site on one contig.  AN counts only called genotypes
    (./. excluded); AF is null, not 0, when nothing is called."""
    df = calls.where(optional_eq("reference_name", contig) & optional_eq("filter", filter_value))
    g = df.groupBy(
        "reference_name", "start", "end_pos", "reference_bases", "alternate_bases",
        gene_col(df).alias("gene_symbol"), clnsig_col(df).alias("clinical_significance"),
    ).agg(
        F.count(F.when(is_carrier(normalise=normalise), 1)).alias("carrier_sample_count"),
        F.sum(dosage(normalise=normalise)).cast("long").alias("allele_count"),
        (F.count(F.when(is_called(normalise=normalise), 1)) * 2).alias("allele_number"),
    )
    af = F.round(F.col("allele_count").cast("double")
                 / F.nullif(F.col("allele_number"), F.lit(0)), 4)
    return (g.withColumn("cohort_allele_frequency", af)
             .orderBy("start", "reference_name", "reference_bases", "alternate_bases"))


def carrier_frequency(calls: DataFrame, top: int | None = 10,
                      contig: str | None = None, store_id: str | None = None) -> DataFrame:
    """Carrier frequency per site over all contigs (no PASS filter):
    distinct samples, carriers, carriers / distinct samples.  With ``top``
    it is a top-k report ordered by carriers with a total tiebreak."""
    df = calls.where(optional_eq("reference_name", contig))
    g = df.groupBy(*SITE_KEY, gene_col(df).alias("gene_symbol"),
                   clnsig_col(df).alias("clinical_significance")).agg(
        F.countDistinct("sample_id").alias("total_cohort_samples"),
        F.count(F.when(is_carrier(), 1)).alias("alt_carrier_count"),
    )
    g = g.withColumn("carrier_frequency", F.round(
        F.col("alt_carrier_count").cast("double") / F.col("total_cohort_samples").cast("double"), 4))
    cols = SITE_KEY + ["total_cohort_samples", "alt_carrier_count", "carrier_frequency",
                       "gene_symbol", "clinical_significance"]
    if store_id is not None:
        g = g.withColumn("engine", F.lit(store_id))
        cols = ["engine"] + cols
    g = g.select(*cols).orderBy(F.col("alt_carrier_count").desc(), *SITE_KEY)
    return g.limit(top) if top else g


def site_depth(calls: DataFrame, contig: str | None = "chr21", limit: int | None = None) -> DataFrame:
    """Calls and mean depth per site on a contig (ordered by position)."""
    df = calls.where(optional_eq("reference_name", contig))
    g = (df.groupBy(*SITE_KEY)
           .agg(F.count(F.lit(1)).alias("call_count"), F.avg("dp").alias("mean_depth"))
           .orderBy("start", "reference_name", "reference_bases", "alternate_bases"))
    return g.limit(limit) if limit else g


def site_alt_frequency(calls: DataFrame, contig: str | None = None) -> DataFrame:
    """Alternate-allele frequency as the generator writes it into INFO AF:
    alt alleles over 2 x samples at the site (missing calls count as samples)."""
    df = calls.where(optional_eq("reference_name", contig))
    g = df.groupBy(*SITE_KEY).agg(
        F.sum(dosage()).cast("long").alias("alt_allele_count"),
        F.count(F.lit(1)).alias("sample_count"),
    )
    return g.withColumn("alt_allele_frequency", F.round(
        F.col("alt_allele_count").cast("double") / (F.col("sample_count") * 2).cast("double"), 4))
