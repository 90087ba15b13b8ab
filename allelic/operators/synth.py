"""Synthetic cohort generation (K1, K2), re-aimed to scale.

Genotypes are drawn for the (sample, site) pairs present in a call skeleton
with a counter-based RNG: one ``md5`` of (seed, sample, contig, start) per
row, whose 128 bits are cut into four independent 32-bit draws (genotype,
DP, GQ, AD).  Each value depends only on its own key, so the output is
identical under any partitioning, retry or executor loss (an order-dependent
RNG is not), and any SQL engine with ``md5`` can recompute it.
Carriers can be pinned: an input table of loci, samples and genotypes that
take the place of what is drawn there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import clnsig_col, gene_col, is_carrier
from allelic.plans.joins import join_dimension
from allelic.schema import CALL_COLUMNS
from allelic.sources.fixtures import sample_name

# Fixed values of the generator's distributions.
P_BENIGN_HOM, P_BENIGN_HET_CUM, P_RARE_HET = 0.20, 0.55, 0.10
HET_DP, HET_GQ, HET_AD_JITTER = (28, 65), (70, 99), 3
HOM_DP, HOM_GQ, HOM_AD_REF = (30, 70), 99, (0, 2)
REF_DP, REF_GQ = (25, 55), (60, 99)
# Conditions for carriers of pathogenic variants: gene -> (concept, years after birth, MM-DD).
PHENOTYPES = {"APP": (43530807, 52, "03-12"),
              "SOD1": (374919, 48, "08-20"),
              "NF2": (4216183, 25, "11-04")}
SEED = 42


_STREAMS = {"gt": 1, "dp": 9, "gq": 17, "ad": 25}  # hex offsets of the 32-bit draws


def _u(seed: int, stream: str) -> Column:
    """Uniform [0, 1) from the row's key and the stream's slice of its md5."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("sample_id"), F.col("reference_name"),
                          F.col("start").cast("string")))
    v = F.conv(F.substring(h, _STREAMS[stream], 8), 16, 10).cast("long")
    return v.cast("double") / F.lit(4294967296.0)


def _randint(seed: int, stream: str, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(_u(seed, stream) * F.lit(float(hi - lo + 1)))).cast("int")


def synthetic_calls(skeleton: DataFrame, seed: int = SEED, pinned: DataFrame | None = None) -> DataFrame:
    """Redraw genotype, DP, GQ and AD for every call of ``skeleton``.
    ``pinned(reference_name, start, sample_id, genotype)`` gives the genotype
    of some; pins without a call are ignored, a pin must stand once."""
    u = _u(seed, "gt")
    benign = clnsig_col(skeleton) == "BENIGN"
    gt = (F.when(benign & (u < P_BENIGN_HOM), F.lit("1/1"))
           .when(benign & (u < P_BENIGN_HET_CUM), F.lit("0/1"))
           .when(~benign & (u < P_RARE_HET), F.lit("0/1"))
           .otherwise(F.lit("0/0")))
    df = skeleton
    if pinned is not None:
        keys = ["reference_name", "start", "sample_id"]
        df = join_dimension(df, pinned.select(*keys, F.col("genotype").alias("_pin")), keys, "left")
        gt = F.coalesce("_pin", gt)
    df = df.withColumn("genotype", gt)
    het, hom = F.col("genotype") == "0/1", F.col("genotype") == "1/1"
    dp = (F.when(het, _randint(seed, "dp", *HET_DP)).when(hom, _randint(seed, "dp", *HOM_DP))
           .otherwise(_randint(seed, "dp", *REF_DP)))
    gq = (F.when(het, _randint(seed, "gq", *HET_GQ)).when(hom, F.lit(HOM_GQ))
           .otherwise(_randint(seed, "gq", *REF_GQ)))
    df = df.withColumn("dp", dp).withColumn("gq", gq.cast("int"))
    ad_ref = (F.when(het, F.floor(F.col("dp") / 2).cast("int")
                     + _randint(seed, "ad", -HET_AD_JITTER, HET_AD_JITTER))
               .when(hom, _randint(seed, "ad", *HOM_AD_REF))
               .otherwise(F.col("dp")))
    df = df.withColumn("allele_depth", F.concat_ws(",", ad_ref.cast("string"),
                                                   (F.col("dp") - ad_ref).cast("string")))
    return df.select(*CALL_COLUMNS)


def synthetic_person(customers: DataFrame, key: str = "c_custkey") -> DataFrame:
    k = F.col(key)
    return customers.select(
        (F.lit(10000) + k).cast("long").alias("person_id"),
        F.when(k % 2 == 0, F.lit(8507)).otherwise(F.lit(8532)).cast("int").alias("gender_concept_id"),
        (F.lit(1960) + (k * 3) % 40).cast("int").alias("year_of_birth"),
        F.lit(6).cast("int").alias("month_of_birth"),
        F.lit(15).cast("int").alias("day_of_birth"),
        F.lit(8527).cast("int").alias("race_concept_id"),
        F.lit(38003564).cast("int").alias("ethnicity_concept_id"),
        sample_name(k).alias("sample_id"))


def synthetic_conditions(calls: DataFrame, person: DataFrame) -> DataFrame:
    """One condition per (person, phenotype) for carriers of a pathogenic
    variant in a gene with a known phenotype; onset = birth year + offset."""
    genes = list(PHENOTYPES)
    c = (calls.where(is_carrier() & (clnsig_col(calls) == "PATHOGENIC")
                     & gene_col(calls).isin(genes))
              .select("sample_id", gene_col(calls).alias("gene")).distinct())
    # carriers (fact side) x person (dimension): checked broadcast / hot-key salting
    j = join_dimension(c, person.select("person_id", "sample_id", "year_of_birth"), "sample_id")

    def pick(i):
        e = None
        for g, v in PHENOTYPES.items():
            e = F.when(F.col("gene") == g, F.lit(v[i])) if e is None else \
                e.when(F.col("gene") == g, F.lit(v[i]))
        return e
    k = None
    for n, g in enumerate(genes, start=1):
        k = F.when(F.col("gene") == g, F.lit(n)) if k is None else k.when(F.col("gene") == g, F.lit(n))
    return j.select(
        (F.col("person_id") * 10 + k).cast("long").alias("condition_occurrence_id"),
        F.col("person_id").cast("long").alias("person_id"),
        pick(0).cast("int").alias("condition_concept_id"),
        F.concat((F.col("year_of_birth") + pick(1)).cast("string"), F.lit("-"), pick(2))
         .alias("condition_start_date"),
        F.lit(32817).cast("int").alias("condition_type_concept_id"))
