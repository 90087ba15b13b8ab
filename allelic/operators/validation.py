"""Cohort validation report (C20): one (check, passed, detail) row per check.

Calls are read twice: once for the two whole-table checks, once (pruned to a
locus) for its carriers.  Those make one frame, a row a sample, which is held
against the expected carriers, the persons and the conditions, and reduced to
one row for three checks.  Sample lists never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.operators.clinical import TARGET_PHENOTYPE, target_carriers
from allelic.plans.joins import MAX_BROADCAST_ROWS

GENOTYPE_PATTERN = r"^[0-9.]+[/|][0-9.]+$"
PERSON_REQUIRED = ["person_id", "sample_id"]


def _checks(one_row: DataFrame, *checks) -> DataFrame:
    """A row for each ``(check, passed, detail)`` of an aggregate."""
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check"), p.alias("passed"), d.alias("detail")) for c, p, d in checks])).alias("r")).select("r.*")


def _said(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def validate_cohort(calls: DataFrame, person: DataFrame, conditions: DataFrame,
                    contig: str, start: int, expected_calls: int | None = None,
                    expected_carriers: DataFrame | None = None,
                    concept: int = TARGET_PHENOTYPE,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    whole = calls.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~F.col("genotype").rlike(GENOTYPE_PATTERN)
                       | F.col("genotype").isNull(), 1)).alias("m"))
    loaded = (F.col("n") == expected_calls) if expected_calls is not None else F.col("n") > 0
    out = _checks(whole, ("calls_loaded", loaded, _said("calls=", F.col("n"))),
                  ("genotype_format", F.col("m") == 0, _said("malformed=", F.col("m"))))
    persons = person.agg(F.count(F.lit(1)).alias("p"))
    has_cols = all(col in person.columns for col in PERSON_REQUIRED)
    out = out.unionByName(_checks(persons, ("person_columns", F.lit(has_cols) & (F.col("p") > 0), _said("persons=", F.col("p")))))

    # A row a sample that carries or is expected to: at most one per sample of
    # the cohort, counted before any broadcast.  Under the limit the big tables
    # are filtered by a broadcast of it instead of being shuffled.
    samples = target_carriers(calls, contig, start).select("sample_id").distinct().withColumn("found", F.lit(1))
    if expected_carriers is not None:
        samples = samples.join(expected_carriers.select("sample_id").distinct().withColumn("expected", F.lit(1)), "sample_id", "full")
    else:
        samples = samples.withColumn("expected", F.col("found"))
    samples = samples.persist()  # a locus; lost blocks are computed again
    small = samples.count() <= max_broadcast_rows
    near = F.broadcast if small else (lambda df: df)
    own = person.select("sample_id", "person_id").join(near(samples.select("sample_id")), "sample_id", "left_semi")
    ill = conditions.where(F.col("condition_concept_id") == concept).select("person_id")
    if small:
        ill = ill.join(F.broadcast(own.select("person_id").distinct()), "person_id", "left_semi")
    ill = ill.groupBy("person_id").agg(F.count(F.lit(1)).alias("ill"))
    own = own.join(ill, "person_id", "left").groupBy("sample_id").agg(F.count(F.lit(1)).alias("persons"), F.sum("ill").alias("ill"))
    one = samples.join(own, "sample_id", "left").agg(
        F.count("found").alias("c"), F.count_if(F.col("found").isNull() | F.col("expected").isNull()).alias("x"),
        F.count_if(F.col("found").isNotNull() & F.col("persons").isNull()).alias("u"),
        F.coalesce(F.sum(F.when(F.col("found").isNotNull(), F.col("ill"))), F.lit(0)).alias("r"))
    if expected_carriers is not None:
        carriers = ("carriers_at_locus", F.col("x") == 0, _said("carriers=", F.col("c"), " mismatches=", F.col("x")))
    else:
        carriers = ("carriers_at_locus", F.col("c") > 0, _said("carriers=", F.col("c")))
    return out.unionByName(_checks(one, carriers, ("carriers_have_person", F.col("u") == 0, _said("unmatched=", F.col("u"))),
                                   ("concept_in_join", F.col("r") > 0, _said("rows=", F.col("r")))))
