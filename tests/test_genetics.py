"""Association, linkage, components and scores against plain numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from allelic.functions import stats
from allelic.operators import association, ld, pca, scores

SITE = ["reference_name", "start", "reference_bases", "alternate_bases"]
CALL = "reference_name string, start long, reference_bases string, alternate_bases string, sample_id string, genotype string"


def cohort(seed, samples, sites, groups=1, missing=0.1, absent=0.1):
    """Random calls; samples of a group share allele frequencies."""
    rnd = random.Random(seed)
    rows = []
    for k in range(sites):
        p = [rnd.random() for _ in range(groups)]
        for i in range(samples):
            u = rnd.random()
            if u < absent:
                continue
            g = sum(rnd.random() < p[i % groups] for _ in range(2))
            gt = "./." if u < absent + missing else ["0/0", "0/1", "1/1"][g]
            rows.append(("chr1" if k % 2 else "chr2", 1000 + 70 * k, "A", "G" if k % 3 else "C", f"s{i:03d}", gt))
    return rows


DOSE = {"0/0": 0, "0/1": 1, "1/1": 2}


def by_site(rows):
    out = {}
    for *site, sample, gt in rows:
        if gt in DOSE:
            out.setdefault(tuple(site), {})[sample] = DOSE[gt]
    return out


# --- tails ---------------------------------------------------------------------

def test_gamma_and_normal_tail(spark):
    z = [0.5, 1.0, 1.5, 3.0, 10.5, 200.0, 250_000.5]
    got = [r.v for r in spark.createDataFrame([(x,) for x in z], "z double").select(stats.log_gamma(F.col("z")).alias("v")).collect()]
    assert got == pytest.approx([math.lgamma(x) for x in z], rel=1e-13, abs=4e-13)
    x = [0.0, 0.1, 1.0, 1.999, 2.0, 2.5, 5.0, 10.0, 25.0, -1.0, -3.0]
    got = [r.v for r in spark.createDataFrame([(v,) for v in x], "x double").select(stats.erfc(F.col("x")).alias("v")).collect()]
    assert got == pytest.approx([math.erfc(v) for v in x], rel=1e-11)


def test_student_tail(spark):
    def series(t, df):  # for whole degrees
        w = math.atan(abs(t) / math.sqrt(df))
        if df % 2:
            a, total = 1.0, 0.0
            for j in range((df - 1) // 2):
                a = a if j == 0 else a * 2 * j / (2 * j + 1)
                total += a * math.cos(w) ** (2 * j + 1)
            return 1 - 2 / math.pi * (w + math.sin(w) * total)
        b, total = 1.0, 0.0
        for j in range(df // 2):
            b = b if j == 0 else b * (2 * j - 1) / (2 * j)
            total += b * math.cos(w) ** (2 * j)
        return 1 - math.sin(w) * total

    cases = [(t, df) for t in (0.0, 0.01, 0.5, 1.0, 2.0, 4.0, -1.5) for df in (1, 2, 3, 4, 9, 30, 101, 1000)]
    rows = spark.createDataFrame(cases + [(None, 3), (1.0, 0)], "t double, df int").select(
        "t", "df", stats.log_t_two_sided(F.col("t"), F.col("df")).alias("v")).collect()
    for r in rows[:-2]:
        assert math.exp(r.v) == pytest.approx(series(r.t, r.df), abs=1e-10), (r.t, r.df)
    assert rows[-1].v is None and rows[-2].v is None
    # far tails keep their digits: df = 2 has p = 2 / (2 + t * t + t * sqrt(2 + t * t))
    for t in (1e2, 1e5, 1e9):
        got = spark.range(1).select(stats.log_t_two_sided(F.lit(t), F.lit(2)).alias("v")).first().v
        assert got == pytest.approx(math.log(2 / (2 + t * t + t * math.sqrt(2 + t * t))), rel=1e-10)
    got = spark.range(1).select(stats.log_t_two_sided(F.lit(30.0), F.lit(500_000)).alias("v")).first().v
    assert -460 < got < -440  # close to the normal tail, which a plain double cannot reach much beyond


# --- association ---------------------------------------------------------------

def trait_rows(samples, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(samples):
        c = [rnd.randrange(20, 80), rnd.randrange(2)]
        out.append((f"s{i:03d}", rnd.gauss(0.05 * c[0], 1), int(rnd.random() < 0.3 + 0.3 * c[1]), c[0], c[1], 7, 2 * c[0] - 7))
    out[3] = (out[3][0], None, None, *out[3][3:])
    out[4] = (*out[4][:4], None, *out[4][5:])
    return out


TRAITS = "sample_id string, y double, ill int, age int, sex int, same int, twice int"


def ols(site, traits, covariates):
    use = [s for s in site if s in traits and all(v is not None for v in (traits[s]["y"], *(traits[s][c] for c in covariates)))]
    x = np.array([[1.0, *(traits[s][c] for c in covariates), site[s]] for s in use])
    y = np.array([traits[s]["y"] for s in use])
    rank = np.linalg.matrix_rank(x)
    if rank == np.linalg.matrix_rank(x[:, :-1]) or len(use) - rank < 1:
        return len(use), None, None
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    rss = ((y - x @ b) ** 2).sum()
    inner = x[:, -1] - x[:, :-1] @ np.linalg.lstsq(x[:, :-1], x[:, -1], rcond=None)[0]
    return len(use), b[-1], math.sqrt(rss / (len(use) - rank) / (inner ** 2).sum())


@pytest.mark.parametrize("covariates", [[], ["age"], ["age", "sex"], ["age", "same", "twice", "sex"]])
def test_linear_association(spark, covariates):
    rows, traits = cohort(1, 40, 25), trait_rows(40)
    rows += [("chr9", 5, "A", "C", f"s{i:03d}", "0/1") for i in range(30)]  # no variation
    rows += [("chr9", 6, "A", "C", f"s{i:03d}", ["0/0", "1/1"][i]) for i in range(2)]  # too few
    t = {r[0]: dict(zip(["y", "ill", "age", "sex", "same", "twice"], r[1:])) for r in traits}
    calls, frame = spark.createDataFrame(rows, CALL), spark.createDataFrame(traits, TRAITS)
    for limit in (1000, 0):
        got = {tuple(r[c] for c in SITE): r for r in association.linear_association(
            calls, frame, "y", covariates, max_broadcast_rows=limit).collect()}
        assert set(got) == set(by_site(rows))
        for key, site in by_site(rows).items():
            n, beta, se = ols(site, t, covariates)
            r = got[key]
            assert r.n == n
            if beta is None:
                assert r.beta is None and r.p_value is None
            else:
                assert (r.beta, r.se) == (pytest.approx(beta, rel=1e-6), pytest.approx(se, rel=1e-6))
                assert r.p_value == pytest.approx(10 ** -r.neg_log10_p) and 0 <= r.p_value <= 1


def test_perfect_fit_has_no_error(spark):
    rows = [("chr1", 1, "A", "C", f"s{i:03d}", ["0/0", "0/1", "1/1"][i % 3]) for i in range(12)]
    traits = spark.createDataFrame([(f"s{i:03d}", 3.0 * (i % 3)) for i in range(12)], "sample_id string, y double")
    r = association.linear_association(spark.createDataFrame(rows, CALL), traits, "y").first()
    assert r.beta == pytest.approx(3.0) and r.se is None and r.p_value is None


def logistic_brute(rows, traits, covariates):
    use = {r["id"]: r for r in traits if r["ill"] is not None and all(r[c] is not None for c in covariates)}
    x = np.array([[1.0, *(r[c] for c in covariates)] for r in use.values()])
    y = np.array([r["ill"] for r in use.values()], float)
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.lstsq(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y - p), rcond=1e-12)[0]
    p = dict(zip(use, 1 / (1 + np.exp(-x @ b))))
    out = {}
    for key, site in by_site(rows).items():
        s = [i for i in site if i in use]
        xs = np.array([[1.0, *(use[i][c] for c in covariates)] for i in s])
        g, ps = np.array([site[i] for i in s], float), np.array([p[i] for i in s])
        w, r = ps * (1 - ps), np.array([use[i]["ill"] for i in s]) - ps
        h = np.linalg.pinv(xs.T @ (xs * w[:, None]))
        out[key] = (len(s), g @ r - (g * w) @ xs @ h @ (xs.T @ r), (g * g * w).sum() - (g * w) @ xs @ h @ (xs.T @ (w * g)))
    return out


@pytest.mark.parametrize("covariates", [[], ["age", "sex"]])
def test_logistic_association(spark, covariates):
    rows, traits = cohort(2, 40, 15), trait_rows(40)
    frame = spark.createDataFrame(traits, TRAITS)
    got = association.logistic_association(spark.createDataFrame(rows, CALL), frame, "ill", covariates).collect()
    want = logistic_brute(rows, [dict(zip(["id", "y", "ill", "age", "sex", "same", "twice"], r)) for r in traits], covariates)
    assert len(got) == len(want)
    for r in got:
        n, score, variance = want[tuple(r[c] for c in SITE)]
        if variance < 1e-9:  # no variation
            assert r.n == n and r.score is None and r.p_value is None
            continue
        assert (r.n, r.score, r.variance) == (n, pytest.approx(score, rel=1e-6, abs=1e-9), pytest.approx(variance, rel=1e-6))
        assert r.p_value == pytest.approx(math.erfc(abs(score / math.sqrt(variance)) / math.sqrt(2)), rel=1e-6)


def test_states_add_up_over_batches(spark):
    """Sums of two batches added are the sums of both together."""
    rows, frame = cohort(5, 30, 8, missing=0), spark.createDataFrame(trait_rows(30), TRAITS).dropna()
    calls = association.genotyped(spark.createDataFrame(rows, CALL), frame.select("sample_id", "y", "age"))
    names, cols = ["one", "age", "g", "y"], [F.lit(1.0), F.col("age"), F.col("g"), F.col("y")]
    whole = association._sums(calls, names, cols)
    parts = [association._sums(calls.where(F.pmod(F.xxhash64("sample_id"), F.lit(2)) == k), names, cols) for k in (0, 1)]
    measures = [c for c in whole.columns if c not in SITE]
    added = parts[0].unionByName(parts[1]).groupBy(*SITE).agg(*[F.sum(c).alias(c) for c in measures])
    for a, b in zip(whole.orderBy(*SITE).collect(), added.orderBy(*SITE).collect()):
        assert [a[c] for c in measures] == pytest.approx([b[c] for c in measures])


# --- linkage -------------------------------------------------------------------

def r2_brute(rows, window, least):
    sites = by_site(rows)
    out = {}
    for a in sites:
        for b in sites:
            if a[0] == b[0] and 0 <= b[1] - a[1] <= window and (a[1], f"{a[2]}>{a[3]}") < (b[1], f"{b[2]}>{b[3]}"):
                s = sorted(sites[a].keys() & sites[b].keys())
                if len(s) >= least:
                    x, y = np.array([sites[a][i] for i in s], float), np.array([sites[b][i] for i in s], float)
                    cov = (x * y).mean() - x.mean() * y.mean()
                    out[a, b] = (len(s), cov ** 2 / (x.var() * y.var()) if x.var() * y.var() > 1e-12 else None)
    return out


@pytest.mark.parametrize("window, least", [(70, 5), (500, 1), (10_000, 12)])
def test_ld_pairs(spark, window, least):
    rows = cohort(7, 16, 30) + [("chr1", 1070, "A", "T", f"s{i:03d}", "0/1") for i in range(10)]
    rows.append(("chr1", 1070, "A", "T", "s000", "1/1"))  # called twice: the larger dosage
    want = r2_brute(rows, window, least)
    got = ld.ld_pairs(spark.createDataFrame(rows, CALL), window, min_samples=least).collect()
    site = lambda r, x: (r.reference_name, r[f"start_{x}"], *r[f"alleles_{x}"].split(">"))
    assert {(site(r, "a"), site(r, "b")): r.n for r in got} == {k: v[0] for k, v in want.items()}
    for r in got:
        assert r.r2 == (None if want[site(r, "a"), site(r, "b")][1] is None else pytest.approx(want[site(r, "a"), site(r, "b")][1], abs=1e-9))


def greedy(nodes, edges):
    near = {n: set() for n in nodes}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    kept = set()
    for n in sorted(nodes, key=lambda n: nodes[n]):
        if not near[n] & kept:
            kept.add(n)
    return kept


@pytest.mark.parametrize("seed", range(3))
def test_prune_is_the_greedy_walk(spark, seed):
    rnd = random.Random(seed)
    nodes = {k: r for k, r in enumerate(rnd.sample(range(1000), 60))}
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(rnd.choice([0, 40, 150]))]
    edges = [e for e in edges if e[0] != e[1]] + ([(k, k + 1) for k in range(8)] if seed == 0 else [])
    got = ld.prune(spark.createDataFrame(list(nodes.items()), "node int, rank int"), spark.createDataFrame(edges, "a int, b int")).collect()
    assert len(got) == 60 and {r.node for r in got if r.kept} == greedy(nodes, edges)


def test_ld_prune(spark):
    rows = cohort(11, 14, 40)
    got = ld.ld_prune(spark.createDataFrame(rows, CALL), 0.15, 700, min_samples=4).collect()
    sites = by_site(rows)
    rank = {}
    for s, dose in sites.items():
        ac = sum(dose.values())
        rank[s] = (-min(ac, 2 * len(dose) - ac), s[0], s[1], f"{s[2]}>{s[3]}")
    edges = [k for k, (_, r2) in r2_brute(rows, 700, 4).items() if r2 is not None and r2 > 0.15]
    assert edges and {tuple(r[c] for c in SITE) for r in got if r.kept} == greedy(rank, edges)
    assert len(got) == len(sites)


# --- components ----------------------------------------------------------------

def matrix(rows):
    sites = by_site(rows)
    samples = sorted({s for d in sites.values() for s in d})
    cols = []
    for d in sites.values():
        p = sum(d.values()) / 2 / len(d)
        if 0 < p < 1:
            cols.append([(d[s] - 2 * p) / math.sqrt(2 * p * (1 - p)) if s in d else 0.0 for s in samples])
    return samples, np.array(cols).T


@pytest.mark.parametrize("limit", [None, 0])
def test_components_match_numpy(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(pca, "MAX_BROADCAST_ROWS", limit)
    rows = cohort(21, 45, 60, groups=3)
    samples, m = matrix(rows)
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    got = {r.sample_id: [r.pc1, r.pc2] for r in pca.genotype_pca(spark.createDataFrame(rows, CALL), 2, rounds=5).collect()}
    assert sorted(got) == samples
    for k in range(2):
        mine, theirs = np.array([got[x][k] for x in samples]), u[:, k] * s[k]
        assert (mine ** 3).sum() >= 0
        theirs = theirs if (theirs ** 3).sum() >= 0 else -theirs
        assert np.abs(mine - theirs).max() < 1e-4 * s[k]


def test_products_move_no_entries(spark, monkeypatch):
    """A product sends slices of the tall table and sums by bin; the entries
    stay where they are, also when the tall table is beyond a broadcast."""
    plans, held = [], pca._write

    def exchanges(df):
        """Of the plan, without what is kept by an earlier job."""
        n, kept = 0, None
        for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
            depth = len(line) - len(line.lstrip(" :+-"))
            kept = None if kept is not None and depth <= kept else kept
            if kept is None:
                kept = depth if "InMemoryRelation" in line else None
                n += "Exchange hashpartitioning" in line
        return n

    def write(session, df, name):
        n, out = exchanges(df), held(session, df, name)
        plans.append((name, n, out.count()))
        return out

    monkeypatch.setattr(pca, "_write", write)
    monkeypatch.setattr(pca, "MAX_BROADCAST_ROWS", 50)
    rows = cohort(21, 200, 40, groups=3)
    assert pca.genotype_pca(spark.createDataFrame(rows, CALL), 2, rounds=1).count() == len({r[4] for r in rows})
    products = [p[1:] for p in plans if p[0] in ("pca_tall", "pca_y", "pca_w", "pca_b")]
    assert len(products) == 4 and all(n <= pca.BINS for _, n in products)
    assert [n for n, _ in products[1:]] == [2, 2, 2]  # the first one's has the start and the dealing of the entries too


def test_components_beyond_the_rank_are_zero(spark):
    rows = [("chr1", 5, "A", "C", f"s{i}", ["0/0", "1/1"][i % 2]) for i in range(6)]
    got = pca.genotype_pca(spark.createDataFrame(rows, CALL), 3, rounds=1, oversampling=1).collect()
    assert all(abs(r.pc1) > 0.1 and r.pc2 == pytest.approx(0) and r.pc3 == pytest.approx(0) for r in got)


# --- scores --------------------------------------------------------------------

WEIGHTS = "reference_name string, start long, effect_allele string, other_allele string, weight double"


def test_scores_by_hand(spark):
    sites = [("chr1", 1, "A", "G"), ("chr1", 2, "A", "T"), ("chr1", 3, "C", "A"), ("chr1", 4, "ATG", "A"), ("chr1", 5, "A", "C")]
    weights = [("chr1", 1, "g", "a", 1.0),      # direct
               ("chr1", 2, "T", "A", 100.0),    # the strands look alike
               ("chr1", 3, "G", "T", 0.5),      # the other strand of C: swapped
               ("chr1", 4, "ATG", "A", 0.25),   # swapped, more than a letter
               ("chr1", 5, "G", "T", 8.0),      # the other strand of C/A at an A/C site: direct
               ("chr1", 5, "G", "A", 64.0),     # alleles that the site has not
               ("chr1", 9, "A", "C", 32.0)]     # no such site
    rows = [(*sites[0], "s1", "0/1"), (*sites[0], "s2", "1/1"), (*sites[2], "s1", "1/1"), (*sites[2], "s2", "./."), (*sites[2], "s3", "0/0"),
            (*sites[3], "s2", "0/1"), (*sites[4], "s3", "0/1"), (*sites[1], "s1", "1/1")]
    samples = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s4",), ("s4",)], "sample_id string")
    frames = spark.createDataFrame(sites, ", ".join(CALL.split(", ")[:4])), samples, spark.createDataFrame(weights, WEIGHTS)
    calls = spark.createDataFrame(rows, CALL)
    want = {"s1": (1 + 0 + 0.5, 0), "s2": (2 + 0 + 0.25, 1), "s3": (1 + 0.5 + 8, 0), "s4": (1 + 0.5, 0)}
    for df in (calls, calls.where("genotype <> '0/0'")):
        for limit in (100, 0):
            got = scores.polygenic_scores(df, *frames, max_broadcast_rows=limit).collect()
            assert {r.sample_id: (r.score, r.n_missing) for r in got} == want and {r.n_weights for r in got} == {4}
    both = scores.polygenic_scores(calls, *frames, keep_ambiguous=True).collect()
    assert {r.sample_id: r.score for r in both}["s1"] == 201.5


def test_scores_without_weights_or_calls(spark):
    none = spark.createDataFrame([], WEIGHTS)
    samples = spark.createDataFrame([("s1",)], "sample_id string")
    calls = spark.createDataFrame([("chr1", 1, "A", "G", "s1", "0/1")], CALL)
    r = scores.polygenic_scores(calls, calls, samples, none).first()
    assert (r.score, r.n_weights, r.n_missing) == (0.0, 0, 0)
