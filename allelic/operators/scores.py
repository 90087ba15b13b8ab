"""Polygenic scores: harmonised weights times dosage, a row a sample.

A weight names its effect allele and the other one.  At a site with these two
alleles it counts the alternate allele (``direct``), or the reference allele
(``swapped``); single letters also match on the other strand.  Letters that
pair with each other (A/T, C/G) cannot tell strands apart and are left out
unless asked for.

A swapped weight scores a sample without the alternate allele: 2 - dosage.
So the score is a constant of the cohort (two for each swapped weight) plus a
correction for each call that is not plain reference, and reference calls need
not be there: a table of all calls and the split layout's variant table give
the same scores.  Calls that are neither called nor reference count as missing
and score nothing at their site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import dosage, is_called
from allelic.plans.joins import MAX_BROADCAST_ROWS, join_dimension

#: Letters and those of the other strand.
STRAND_FROM, STRAND_TO = "ACGT", "TGCA"


def harmonised(sites: DataFrame, weights: DataFrame, keep_ambiguous: bool = False) -> DataFrame:
    """``weights(reference_name, start, effect_allele, other_allele, weight)``
    beside ``sites(reference_name, start, reference_bases, alternate_bases)``:
    site, weight and ``sign`` (1 direct, -1 swapped).  Weights without a site
    of their alleles are left out; several weights of a site each count."""
    j = sites.join(weights, ["reference_name", "start"])
    flip = lambda c: F.translate(c, STRAND_FROM, STRAND_TO)
    e, o, ref, alt = (F.upper(c) for c in ("effect_allele", "other_allele", "reference_bases", "alternate_bases"))
    single = (F.length("effect_allele") == 1) & (F.length("other_allele") == 1)
    direct, swapped = (e == alt) & (o == ref), (e == ref) & (o == alt)
    sign = (F.when(direct, 1).when(swapped, -1).when(single & (flip(e) == alt) & (flip(o) == ref), 1)
            .when(single & (flip(e) == ref) & (flip(o) == alt), -1))
    j = j.withColumn("sign", sign).where("sign is not null")
    if not keep_ambiguous:
        j = j.where(~(single & (flip(e) == o)))
    return j.select("reference_name", "start", "reference_bases", "alternate_bases", F.col("weight").cast("double").alias("weight"), "sign")


def polygenic_scores(calls: DataFrame, sites: DataFrame, samples: DataFrame, weights: DataFrame, keep_ambiguous: bool = False,
                     normalise: bool = False, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``sample_id, score, n_weights, n_missing`` of each of ``samples``.

    ``sites`` lists the callset's sites; ``calls`` may leave out reference
    calls.  A sample without calls at the weights' sites is reference there.
    ``n_missing`` counts a sample's weights whose genotype is missing."""
    w = harmonised(sites.select("reference_name", "start", "reference_bases", "alternate_bases").distinct(), weights, keep_ambiguous)
    # one row a site: its weights by sign
    w = w.groupBy("reference_name", "start", "reference_bases", "alternate_bases").agg(
        F.sum(F.col("weight") * F.col("sign")).alias("slope"), F.sum(F.when(F.col("sign") < 0, 2 * F.col("weight")).otherwise(0.0)).alias("base"),
        F.count(F.lit(1)).alias("many"))
    total = w.agg(F.coalesce(F.sum("base"), F.lit(0.0)).alias("base"), F.coalesce(F.sum("many"), F.lit(0)).alias("many")).first()  # one row
    rows = calls.where(F.col("genotype") != "0/0").select(
        "reference_name", "start", "reference_bases", "alternate_bases", "sample_id", dosage(normalise=normalise).alias("d"),
        is_called(normalise=normalise).alias("called"))
    rows = join_dimension(rows, w, ["reference_name", "start", "reference_bases", "alternate_bases"], "inner", max_broadcast_rows)
    per = rows.groupBy("sample_id").agg(
        F.sum(F.when(F.col("called"), F.col("slope") * F.col("d")).otherwise(-F.col("base"))).alias("moved"),
        F.sum(F.when(~F.col("called"), F.col("many")).otherwise(0)).alias("n_missing"))
    return samples.select("sample_id").distinct().join(per, "sample_id", "left").select(
        "sample_id", (F.coalesce("moved", F.lit(0.0)) + float(total["base"])).alias("score"),
        F.lit(int(total["many"])).cast("long").alias("n_weights"), F.coalesce("n_missing", F.lit(0)).cast("long").alias("n_missing"))
