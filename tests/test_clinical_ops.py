"""Trial matching, allele fraction over time, carrier states."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from allelic.operators import carrier_states, longitudinal, trials
from allelic.operators.frequency import carrier_frequency
from allelic.plans import joins
from allelic.sources import fixtures as fx
from allelic.plans.layout import diff_counts
from conftest import SF_SMALL

# --- trials --------------------------------------------------------------------

CRITERIA = "trial_id long, criterion_id int, mode string, kind string, code string, from_day string, to_day string"


def fits(facts, born, trial, criteria):
    _, low, high = trial
    if born is None or not (low or 1900) <= born <= (high or 2100):
        return None
    met = lambda c: any(k == c[3] and x == c[4] and (c[5] is None and c[6] is None or d is not None
                        and (c[5] is None or d >= c[5]) and (c[6] is None or d <= c[6])) for k, x, d in facts)
    n = {m: len({c[1] for c in criteria if c[2] == m and met(c)}) for m in ("all", "any", "none")}
    ask = {m: len({c[1] for c in criteria if c[2] == m}) for m in n}
    ok = n["all"] == ask["all"] and (not ask["any"] or n["any"]) and not n["none"]
    return (n["all"], n["any"]) if ok else None


@pytest.mark.parametrize("limit", [1000, 0])
def test_trials_match_brute_force(spark, limit):
    rnd = random.Random(6)
    days = [f"20{y}-0{m}-15" for y in range(10, 16) for m in (1, 5)]
    kinds = [("variant", "A"), ("variant", "B"), ("variant:PATHOGENIC", "A"), ("condition", "1"), ("condition", "2")]
    facts = [(p, *rnd.choice(kinds), rnd.choice([None, *days])) for p in range(40) for _ in range(rnd.randrange(5))]
    persons = [(p, None if p == 7 else 1950 + p) for p in range(40)]
    some = [(t, rnd.choice([None, 1940, 1960]), rnd.choice([None, 1980, 1955])) for t in range(25)]
    criteria = []
    for t, *_ in some:
        for c in range(rnd.randrange(5)):
            start, end = sorted(rnd.sample(days, 2))
            criteria.append((t, c, rnd.choice(["all", "any", "none"]), *rnd.choice(kinds), rnd.choice([None, start]), rnd.choice([None, end])))
    criteria += [(99, 1, "all", "variant", "A", None, None), (3, 50, "other", "variant", "A", None, None)]
    got = trials.match_trials(
        spark.createDataFrame(facts, "person_id long, kind string, code string, day string").distinct(),
        spark.createDataFrame(persons, "person_id long, year_of_birth int"),
        spark.createDataFrame(some, "trial_id long, min_year int, max_year int"), spark.createDataFrame(criteria, CRITERIA), limit).collect()
    want = {}
    for t in some:
        for p, born in persons:
            found = fits([f[1:] for f in facts if f[0] == p], born, t, [c for c in criteria if c[0] == t[0] and c[2] != "other"])
            if found is not None:
                want[t[0], p] = found
    assert {(r.trial_id, r.person_id): (r.n_all, r.n_any) for r in got} == want and len(got) == len(want)


def test_trials_without_criteria_or_facts(spark):
    none = spark.createDataFrame([], "person_id long, kind string, code string, day string")
    persons = spark.createDataFrame([(1, 1980), (2, 1990)], "person_id long, year_of_birth int")
    some = spark.createDataFrame([(1, 1985, None), (2, 1990, 1980)], "trial_id long, min_year int, max_year int")
    got = trials.match_trials(none, persons, some, spark.createDataFrame([], CRITERIA)).collect()
    assert [(r.trial_id, r.person_id, r.n_all, r.n_any) for r in got] == [(1, 2, 0, 0)]


def test_trial_pairs_are_not_shuffled(spark):
    """Facts are dealt by person, and pairs with trials stay there; more
    criteria than a word has bits, and a trial without an id, count too."""
    persons = spark.createDataFrame([(p, 1950 + p % 30) for p in range(60)], "person_id long, year_of_birth int")
    facts = spark.createDataFrame([(p, "condition", str(c), "2012-01-15") for p in range(60) for c in range(p % 3, 70)], "person_id long, kind string, code string, day string")
    some = spark.createDataFrame([(1, None, None), (2, None, None), (None, 1979, None)], "trial_id long, min_year int, max_year int")
    criteria = spark.createDataFrame([(1, c, "all", "condition", str(c), None, None) for c in range(70)] + [(2, 1, "none", "condition", "1", None, None)], CRITERIA)
    got = trials.match_trials(facts, persons, some, criteria)
    want = [(1, p, 70, 0) for p in range(0, 60, 3)] + [(2, p, 0, 0) for p in range(60) if p % 3 == 2] + [(None, p, 0, 0) for p in (29, 59)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [x for x in plan if "hashpartitioning(" in x and "person_id" in x and "trial" in x]


@pytest.mark.parametrize("words", [8, 0])
def test_trial_criteria_that_are_equal_and_persons_that_repeat(spark, words, monkeypatch):
    """Each pair arises once, by one criterion; equal criteria of a trial count
    each, whether terms or criteria are the bits."""
    monkeypatch.setattr(trials, "MAX_WORDS", words)
    persons = spark.createDataFrame([(1, 1980), (1, 1980), (2, 1990), (None, 1980)], "person_id long, year_of_birth int")
    facts = [(1, "condition", "1", "2012-01-15"), (1, "condition", "2", None), (2, "condition", "2", "2012-01-15"), (2, "variant", "A", None)]
    both, one = [("condition", "1", None, None), ("condition", "2", "2012-01-01", None)], ("condition", "2", None, None)
    criteria = [(1, c, "any", *one) for c in (1, 2)] + [(1, 3, "any", "variant", "A", None, None)] + [(2, 1, "all", *x) for x in both] + [(2, 2, "all", *one), (2, 3, "none", "variant", "A", None, None)]
    criteria += [(3, None, "all", "variant", "B", None, None), (4, 1, "all", None, None, None, None)]
    some = [(1, None, None), (2, 1970, None), (3, 1985, 1990), (3, None, None), (4, None, None)]
    got = trials.match_trials(spark.createDataFrame(facts, "person_id long, kind string, code string, day string"), persons,
                              spark.createDataFrame(some, "trial_id long, min_year int, max_year int"), spark.createDataFrame(criteria, CRITERIA))
    want = [(1, 1, 0, 2)] * 2 + [(1, 2, 0, 3)] + [(2, 1, 2, 0)] * 2 + [(3, 1, 0, 0)] * 2 + [(3, 2, 0, 0)] * 2 + [(3, None, 0, 0)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert got.dtypes == [("trial_id", "bigint"), ("person_id", "bigint"), ("n_all", "bigint"), ("n_any", "bigint")]
    # pairs are streamed: nothing groups them
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[:plan.index("trial_pivots")]


# --- allele fraction over time --------------------------------------------------

def observed(seed, n=300):
    rnd = random.Random(seed)
    rows = [(f"s{rnd.randrange(6)}", f"m{rnd.randrange(3)}", f"20{rnd.randrange(10, 20)}-{rnd.randrange(1, 13):02d}-{rnd.randrange(1, 29):02d}",
             dp := rnd.choice([0, 1, 10, 40]), rnd.randrange(dp + 1)) for _ in range(n)]
    return rows + [rows[0]] * 2 + [(None, "m0", "2015-01-01", 5, 1), ("s0", None, "2015-01-01", 5, 1), ("s0", "m0", "no day", 5, 1), ("s0", "m0", None, 5, 1)]


def expected(rows, max_gap, step):
    keep = {}
    for s, m, d, dp, alt in rows:
        if s and m and d and d[0] == "2":
            days = keep.setdefault((s, m), {})
            days[d] = tuple(map(sum, zip(days.get(d, (0, 0)), (dp, alt))))
    out = Counter()
    for key, days in keep.items():
        series = [(d, dp, a, a / dp) for d, (dp, a) in sorted(days.items()) if dp]
        from datetime import date
        episode, begin = 0, 0
        for k, (d, dp, a, f) in enumerate(series):
            since = None if not k else (date.fromisoformat(d) - date.fromisoformat(series[k - 1][0])).days
            if since is None or since > max_gap:
                episode, begin = episode + 1, k
            past = [x[3] for x in series[begin:k]]
            events = [n for n, hit in (("rise", past and f - min(past) >= step), ("fall", past and max(past) - f >= step)) if hit]
            out[(*key, d, dp, a, f, episode, since, f - series[k - 1][3] if k else None, min(past, default=None), max(past, default=None),
                 ",".join(events) if events else "none" if past else "start")] += 1
    return out


@pytest.mark.parametrize("max_gap, step", [(365, 0.25), (30, 0.01), (10_000, 0.9)])
def test_track(spark, max_gap, step):
    rows = observed(1)
    got = Counter(tuple(r) for r in longitudinal.track(spark.createDataFrame(rows, longitudinal.OBSERVATION), max_gap, step).collect())
    assert got == expected(rows, max_gap, step)


def test_stream_with_late_rows_equals_batch(spark, tmpdir_path):
    """Files arrive in any order; a restart goes on, a replayed epoch adds nothing."""
    rows = observed(4, 400)
    src, root, checkpoint = (f"{tmpdir_path}/{n}" for n in ("src", "root", "checkpoint"))
    random.Random(2).shuffle(rows)
    for k in range(4):
        spark.createDataFrame(rows[k::4], longitudinal.OBSERVATION).coalesce(1).write.mode("append").json(src)
        if k != 2:  # two files come at once
            longitudinal.track_stream(spark, src, root, checkpoint, max_files_per_trigger=1)
    got = longitudinal.read_tracked(spark, root)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows, longitudinal.MAX_GAP, longitudinal.STEP)
    batch = longitudinal.track(spark.createDataFrame(rows, longitudinal.OBSERVATION))
    d = diff_counts(batch, got).first()
    assert (d["left_only"], d["right_only"]) == (0, 0) and d["left_rows"] > 200


def test_stream_state_is_by_bucket_of_samples(spark, tmpdir_path):
    """Many samples share a state row, and only changed rows are written."""
    src, root, checkpoint = (f"{tmpdir_path}/{n}" for n in ("src", "root", "checkpoint"))
    first = [(f"s{k}", "m", f"2020-01-0{d}", 10, d) for k in range(40) for d in (1, 3)]
    for rows in (first, [("s1", "m", "2020-01-02", 10, 9), ("s2", "n", "2020-01-02", 10, 9)]):
        spark.createDataFrame(rows, longitudinal.OBSERVATION).coalesce(1).write.mode("append").json(src)
        longitudinal.track_stream(spark, src, root, checkpoint, max_files_per_trigger=1, buckets=2)
    late = spark.read.parquet(root).where("version > 1").select("sample_id", "marker", "day").collect()
    assert sorted(map(tuple, late)) == [("s1", "m", "2020-01-02"), ("s1", "m", "2020-01-03"), ("s2", "n", "2020-01-02")]
    batch = longitudinal.track(spark.read.schema(longitudinal.OBSERVATION).json(src))
    assert Counter(map(tuple, longitudinal.read_tracked(spark, root).collect())) == Counter(map(tuple, batch.collect()))


def test_observations_from_calls(spark):
    rows = [("s", "chr1", "2020-01-01", "10,5"), ("s", "chr1", "2020-01-02", "."), ("s", "chr1", "2020-01-03", "3,2,1"), ("s", "chr1", "2020-01-04", None)]
    df = spark.createDataFrame(rows, "sample_id string, reference_name string, taken string, allele_depth string")
    got = longitudinal.observations(df, "taken", "reference_name").collect()
    assert sorted((r.day, r.dp, r.alt) for r in got) == [("2020-01-01", 15, 5), ("2020-01-03", 6, 3)]


# --- carrier states --------------------------------------------------------------

def test_numbers_are_dense_and_stay(spark):
    one = spark.createDataFrame([(f"s{k:03d}",) for k in range(50)] * 2 + [(None,)], "sample_id string")
    first = carrier_states.number_samples(one)
    known = {r.sample_id: r.number for r in first.collect()}
    assert sorted(known.values()) == list(range(1, 51))
    two = spark.createDataFrame([(f"s{k:03d}",) for k in range(40, 90)], "sample_id string")
    both = {r.sample_id: r.number for r in carrier_states.number_samples(two, first).collect()}
    assert sorted(both.values()) == list(range(1, 91)) and all(both[s] == n for s, n in known.items())
    none = one.where("sample_id = 'x'")
    assert carrier_states.number_samples(none).count() == 0
    assert carrier_states.number_samples(none, first).count() == 50


def test_states_of_batches_merge_to_the_frequency(spark):
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    parts = [calls.where("batch_id = '001'"), calls.where("batch_id = '002'")]
    numbers = carrier_states.number_samples(parts[1], carrier_states.number_samples(parts[0]))
    # numbers far apart: several blocks a site
    for spread in (numbers, numbers.withColumn("number", F.col("number") * 40_000)):
        states = [carrier_states.carrier_states(p, spread) for p in parts]
        got = carrier_states.carrier_frequency_of(carrier_states.merge_states(*states))
        d = diff_counts(carrier_frequency(calls, top=None).select(got.columns), got).first()
        assert (d["left_only"], d["right_only"]) == (0, 0) and d["left_rows"] > 100
    # a batch merged twice adds no sample
    twice = carrier_states.merge_states(states[0], states[0])
    a = {r.start: r.total_cohort_samples for r in carrier_states.carrier_frequency_of(twice).collect()}
    b = {r.start: r.total_cohort_samples for r in carrier_states.carrier_frequency_of(carrier_states.merge_states(states[0])).collect()}
    assert a == b


def test_states_move_fewer_bytes_than_calls(spark):
    """A dense cohort: a bitmap row a site and block against a row a call."""
    calls = spark.range(60_000).select(
        F.lit("chr1").alias("reference_name"), (F.col("id") % 3).alias("start"), F.lit("A").alias("reference_bases"), F.lit("G").alias("alternate_bases"),
        F.concat(F.lit("sample_"), F.expr("id div 3")).alias("sample_id"), F.lit("0/1").alias("genotype"), F.lit('{"gene":"X"}').alias("attributes"))
    states = carrier_states.carrier_states(calls, carrier_states.number_samples(calls))
    assert states.count() == 3 and states.agg(F.sum(F.length("samples"))).first()[0] == 3 * 4096
    assert [r.total_cohort_samples for r in carrier_states.carrier_frequency_of(states).collect()] == [20_000] * 3


def test_sparse_states_are_lists_of_masks(spark):
    """A block with few samples is no 4 KB bitmap; lists and bitmaps merge."""
    few = [("chr1", s, "A", "G", f"s{(s * 31 + k * 1009) % 9000:05d}", "0/1" if k else "./.") for s in range(40) for k in range(3)]
    many = [("chr1", 7, "A", "G", f"s{k:05d}", "1/1") for k in range(9000)]
    cols = "reference_name string, start long, reference_bases string, alternate_bases string, sample_id string, genotype string"
    one, two = (spark.createDataFrame(rows, cols).withColumn("attributes", F.lit(None).cast("string")) for rows in (few, many))
    numbers = carrier_states.number_samples(two).localCheckpoint()
    a, b = (carrier_states.carrier_states(df, numbers).localCheckpoint() for df in (one, two))
    assert a.count() == 40 and a.where("samples is not null").count() == 0
    assert a.agg(F.sum(F.size("words"))).first()[0] <= len(few)
    assert [len(r["samples"]) for r in b.collect()] == [4096]
    merged = carrier_states.merge_states(a, b, a)
    got = {r.start: (r.total_cohort_samples, r.alt_carrier_count) for r in carrier_states.carrier_frequency_of(merged).collect()}
    assert got == {s: (9000, 9004) if s == 7 else (3, 4) for s in range(40)}


def test_grouped_rows_are_dealt_when_they_do_not_combine(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), "id")
    assert joins.deal(df, ["id"], ["a", "id"]).rdd.getNumPartitions() == 10
    assert joins.deal(df, ["a"], ["a"]) is df
