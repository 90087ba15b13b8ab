"""Genotype-phenotype joins against OMOP person / condition_occurrence
(C7, C8, C12).

C7/C8: the carriers at one locus are at most one row per sample. That bound
grows with the cohort, so it is checked: they are counted (one pruned scan of
a single locus).  Under ``max_broadcast_rows`` the carriers are broadcast
into the person join, and their person ids are broadcast into a left-semi
filter of condition_occurrence.  Only the carriers' conditions reach the
final left join, and the large condition table is never shuffled.  Over the
limit the same joins run as shuffle joins chosen by AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import clnsig_col, gene_col, is_carrier, optional_eq
from allelic.plans.joins import MAX_BROADCAST_ROWS, join_dimension

# Fixed label values.
GENDER_LABELS = {8507: "MALE", 8532: "FEMALE"}
GENDER_OTHER = "UNKNOWN"
TARGET_PHENOTYPE = 43530807
PHENOTYPE_LABEL = "Early-onset Alzheimer Disease (Confirmed)"
PHENOTYPE_OTHER = "Other Clinical Condition"


def gender_label(c: Column | None = None) -> Column:
    c = F.col("gender_concept_id") if c is None else c
    expr = None
    for k, v in GENDER_LABELS.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(GENDER_OTHER))


def phenotype_label(c: Column | None = None,
                    concept: int = TARGET_PHENOTYPE, label: str = PHENOTYPE_LABEL) -> Column:
    c = F.col("condition_concept_id") if c is None else c
    # A null concept (person without conditions) is labelled "other", as coded.
    return F.when(c == concept, F.lit(label)).otherwise(F.lit(PHENOTYPE_OTHER))


def target_carriers(calls: DataFrame, contig: str, start: int) -> DataFrame:
    df = calls.where((F.col("reference_name") == F.lit(contig)) & (F.col("start") == F.lit(start))
                     & is_carrier())
    return df.select("sample_id", "reference_name", "start", "genotype",
                     gene_col(df).alias("gene_symbol"),
                     clnsig_col(df).alias("clinical_significance"))


def _carrier_persons_and_conditions(calls, person, conditions, contig, start, person_cols,
                                    max_broadcast_rows):
    tc = target_carriers(calls, contig, start)
    p = person.select(*person_cols)
    co = conditions.select("person_id", "condition_concept_id", "condition_start_date")
    if tc.count() <= max_broadcast_rows:
        pc = p.join(F.broadcast(tc), "sample_id")
        co = co.join(F.broadcast(pc.select("person_id").distinct()), "person_id", "left_semi")
    else:
        pc = p.join(tc, "sample_id")
    return pc.join(co, "person_id", "left")


def omop_phenotype_join(calls: DataFrame, person: DataFrame, conditions: DataFrame,
                        contig: str = "chr21", start: int = 25891796,
                        max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    j = _carrier_persons_and_conditions(
        calls, person, conditions, contig, start,
        ["person_id", "sample_id", "year_of_birth", "gender_concept_id"], max_broadcast_rows)
    return j.select(
        "person_id", "sample_id", "year_of_birth",
        gender_label().alias("gender"),
        "gene_symbol", "clinical_significance", "genotype",
        "condition_concept_id", "condition_start_date",
        phenotype_label().alias("phenotype_label"),
    ).orderBy("person_id", "condition_start_date", "condition_concept_id")


def omop_join_plain(calls: DataFrame, person: DataFrame, conditions: DataFrame,
                    contig: str = "chr21", start: int = 25891796,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    j = _carrier_persons_and_conditions(
        calls, person, conditions, contig, start,
        ["person_id", "sample_id", "year_of_birth"], max_broadcast_rows)
    return j.select("person_id", "sample_id", "year_of_birth", "gene_symbol",
                    "clinical_significance", "genotype", "condition_concept_id",
                    "condition_start_date")


def calls_with_demographics(calls: DataFrame, person: DataFrame, contig: str | None = "chr21",
                            limit: int | None = None,
                            max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Calls on a contig with the participant's demographics.  Person is a
    dimension (one row per sample): broadcast after a row-count check, else
    a salted shuffle join so one hot sample does not land in one task."""
    v = calls.where(optional_eq("reference_name", contig)).select("reference_name", "start",
                                                                   "sample_id")
    p = person.select("sample_id", "gender_concept_id", "year_of_birth")
    j = (join_dimension(v, p, "sample_id", "inner", max_broadcast_rows)
          .select("reference_name", "start", "sample_id", "gender_concept_id", "year_of_birth"))
    if limit:
        j = j.orderBy("start", "sample_id").limit(limit)
    return j
