"""Trial matching: participants against eligibility criteria, any number of
trials in one plan.

A trial has criteria of three modes: all of its ``all``, at least one of its
``any`` if it has some, and none of its ``none``; and a window of years of
birth.  A criterion names a kind of fact and a code (a gene with a carried
variant, a condition concept), and may have a window of dates.  Facts meet
the distinct criteria by an equality join, once for all trials that ask for the
same, and what a participant meets is a set of bits.  A participant and a trial
are paired by one criterion: the trial's rarest of ``all``, or the first met of
``any``, or, without positive criteria, the year of birth.  So no participant
is paired with a trial it has no fact for, a pair arises once, and the other
criteria are looked up in the bits (relational division without grouping).
Pairs, which are as many as participants times trials at worst, are made where
the participant is; they are neither shuffled nor held.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from allelic.functions.genotype import clnsig_col, gene_col, is_carrier
from allelic.plans.joins import MAX_BROADCAST_ROWS, join_dimension
from allelic.session import scratch_path

#: Years a trial without a bound takes.
OLDEST, YOUNGEST = 1900, 2100
#: Criteria in a word of bits; words of a participant's bits, above which what
#: is met is a list; pairs that a task makes.
WORD, MAX_WORDS, PAIRS = 62, 8, 1 << 25
#: What is added to a year of birth, so that it is no number of a criterion.
BORN = -(1 << 40)


def facts(calls: DataFrame, person: DataFrame, conditions: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``person_id, kind, code, day``: genes in which a person carries a
    variant (``variant``), those with a given significance
    (``variant:PATHOGENIC``), and conditions with their date."""
    carried = calls.where(is_carrier()).select("sample_id", gene_col(calls).alias("gene"), clnsig_col(calls).alias("sig")).distinct()
    carried = join_dimension(carried, person.select("sample_id", "person_id"), "sample_id", "inner", max_broadcast_rows)
    of_calls = carried.select("person_id", F.explode(F.array(F.lit("variant"), F.concat(F.lit("variant:"), "sig"))).alias("kind"),
                              F.col("gene").alias("code"), F.lit(None).cast("string").alias("day"))
    of_conditions = conditions.select("person_id", F.lit("condition").alias("kind"), F.col("condition_concept_id").cast("string").alias("code"),
                                      F.col("condition_start_date").alias("day"))
    return of_calls.unionByName(of_conditions).where("kind is not null and code is not null").distinct()


def match_trials(facts_: DataFrame, person: DataFrame, trials: DataFrame, criteria: DataFrame,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``trial_id, person_id, n_all, n_any``: who fits which trial, and how
    many of its ``all`` and ``any`` criteria are met.

    ``trials(trial_id, min_year, max_year)``; a null bound is open, a person
    without a year of birth fits no trial.  ``criteria(trial_id, criterion_id,
    mode, kind, code, from_day, to_day)``; a fact without a date does not meet
    a criterion with a window.  Criteria of unknown trials are ignored.
    """
    modes = ["all", "any", "none"]
    spark = person.sparkSession
    zero = F.lit(0).cast("long")
    trials = trials.select("trial_id", F.coalesce("min_year", F.lit(OLDEST)).alias("min_year"), F.coalesce("max_year", F.lit(YOUNGEST)).alias("max_year"))
    criteria = criteria.where(F.col("mode").isin(modes) & F.col("criterion_id").isNotNull()).join(trials.select("trial_id"), "trial_id", "left_semi")
    # a criterion may stand in several rows; equal ones of trials are one term
    asked = criteria.groupBy("trial_id", "mode", "criterion_id").agg(
        F.sort_array(F.collect_set(F.struct("kind", "code", "from_day", "to_day"))).alias("rows"))
    terms = asked.select("rows").distinct().select("rows", (F.row_number().over(Window.orderBy("rows")) - 1).alias("term"))
    n_terms = terms.count()
    rules = terms.select("term", F.explode("rows").alias("x")).select("term", "x.*")

    # Persons are dealt once, with the terms they meet, and kept.
    inside = ((F.col("from_day").isNull() & F.col("to_day").isNull())
              | (F.coalesce(F.col("day") >= F.col("from_day"), F.col("from_day").isNull() & F.col("day").isNotNull())
                 & F.coalesce(F.col("day") <= F.col("to_day"), F.col("to_day").isNull() & F.col("day").isNotNull())))
    known = facts_.where("person_id is not null").select("person_id", "kind", "code", "day")
    met = join_dimension(known, rules, ["kind", "code"], "inner", max_broadcast_rows).where(inside).select("person_id", "term")
    born = person.where("year_of_birth is not null").select("person_id", F.col("year_of_birth").alias("year"))
    people = born.unionByName(met, allowMissingColumns=True).groupBy("person_id").agg(
        F.collect_set("term").alias("met"), F.collect_list("year").alias("years")).where(F.size("years") > 0)
    # a few words hold a bit for every term, else a trial's criteria are the bits
    dense = n_terms <= WORD * MAX_WORDS
    if dense:
        word = lambda w: F.aggregate("met", zero, lambda a, t: F.when(F.floor(t / WORD) == w, a.bitwiseOR(_bit(t))).otherwise(a))
        people = people.withColumns({f"met{w}": word(w) for w in range(-(-n_terms // WORD))})
    keys = F.concat(F.array(F.col("year") + F.lit(BORN)), F.col("met").cast("array<bigint>"))
    people = people.select("*", F.explode("years").alias("year")).drop("years").withColumn("keys", keys)
    people = _kept(spark, people, "trial_people")
    counts = people.select(F.explode("keys").alias("key")).groupBy("key").count()

    criterion = Window.partitionBy("trial_id").orderBy("mode", "criterion_id")
    asked = asked.join(terms, "rows").select("trial_id", "mode", F.col("term").cast("long").alias("key"),
                                             (F.col("term") if dense else F.row_number().over(criterion) - 1).alias("at"))
    # equal criteria of a trial have one bit: they count as often as they stand there
    times = Window.partitionBy("trial_id", "mode", "at").orderBy("key")
    asked = asked.withColumn("time", F.row_number().over(times)).join(counts, "key", "left").na.fill(0, ["count"])
    last, most = asked.agg(F.max("at"), F.max(F.when(F.col("mode") == "any", F.col("time")))).first()
    words, times = range(1 + (last or 0) // WORD), range(1, 1 + (most or 1))
    bits = {f"{m}{w}": (F.col("mode") == m, w) for m in modes for w in words} | {
        f"any{w}_{n}": ((F.col("mode") == "any") & (F.col("time") == n), w) for n in times[1:] for w in words}
    bits = {name: F.bit_or(F.when(of & (F.floor(F.col("at") / WORD) == w), _bit(F.col("at"))).otherwise(zero)) for name, (of, w) in bits.items()}
    one = {m: F.when(F.col("mode") == m, F.struct("count", "at", "key")) for m in modes}
    asks = asked.groupBy("trial_id").agg(
        *[c.alias(n) for n, c in bits.items()], F.count_if(F.col("mode") == "all").alias("n_all"), F.min(one["all"]).alias("rarest"),
        F.collect_set(one["any"]).alias("any_of"), *[F.max(F.when(F.col("at") == j, F.col("key"))).alias(f"term{j}") for j in range(0 if dense else 1 + last)])
    pivots = trials.join(asks, "trial_id", "left").na.fill(0, ["n_all", *bits])
    years = F.when(F.col("min_year") <= F.col("max_year"), F.transform(
        F.sequence("min_year", "max_year"), lambda y: F.struct(F.lit(None).cast("int").alias("at"), (y + F.lit(BORN)).alias("key"))))
    by = lambda x: F.struct(x["at"].alias("at"), x["key"].alias("key"))
    pair_by = (F.when(F.col("rarest").isNotNull(), F.array(F.struct(F.lit(None).cast("int").alias("at"), F.col("rarest.key").alias("key"))))
                .when(F.size("any_of") > 0, F.transform("any_of", by)).otherwise(years))
    pivots = pivots.withColumn("by", F.explode(pair_by))
    # what is to be looked at: all, none, and of ``any`` what stands before the
    # criterion that pairs, as the first that is met pairs
    at = F.col("by.at")
    before = lambda w: F.when(at >= (w + 1) * WORD, F.col(f"any{w}")).when(at >= w * WORD, F.col(f"any{w}").bitwiseAND(_bit(at) - 1)).otherwise(zero)
    care = lambda w: F.col(f"all{w}").bitwiseOR(F.col(f"none{w}")).bitwiseOR(before(w))
    pivots = _kept(spark, pivots.select(F.col("by.key").alias("key"), "trial_id", "min_year", "max_year", "n_all", *[c for c in pivots.columns if c.startswith("term")],
                                        *[c for c in bits if not c.startswith("none")], *[care(w).alias(f"care{w}") for w in words]), "trial_pivots")

    pairs = counts.join(pivots.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key").agg(F.sum(F.col("count") * F.col("n"))).first()[0] or 0
    people = people.repartition(1 + pairs // PAIRS, "person_id").withColumn("key", F.explode("keys")).drop("keys", *["met"] * dense)
    if dense:
        got = [F.col(f"met{w}") if n_terms else zero for w in words]
    else:
        got = [sum((F.when(F.array_contains("met", F.col(f"term{j}").cast("int")), F.lit(1 << j % WORD)).otherwise(zero)
                    for j in range(1 + last) if j // WORD == w), zero) for w in words]
    found = join_dimension(people, pivots, "key", "inner", max_broadcast_rows).where(F.col("year").between(F.col("min_year"), F.col("max_year")))
    for w in words:
        found = found.where(got[w].bitwiseAND(F.col(f"care{w}")) == F.col(f"all{w}"))
    no_any, some = F.lit(True), F.lit(False)
    for w in words:
        no_any, some = no_any & (F.col(f"any{w}") == 0), some | (got[w].bitwiseAND(F.col(f"any{w}")) != 0)
    n_any = sum((F.bit_count(got[w].bitwiseAND(F.col(c))) for w in words for c in (f"any{w}", *[f"any{w}_{n}" for n in times[1:]])), zero)
    return found.where(no_any | some).select("trial_id", "person_id", "n_all", n_any.alias("n_any"))


def _bit(n):
    """The bit of a number in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(n, F.lit(WORD)).cast("int"))


def _kept(spark, df: DataFrame, name: str) -> DataFrame:
    """The frame written once, and read where it is used."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
