"""Association of genotypes with a trait, site by site.

A call contributes products of (1, covariates, dosage, trait) to its site.
Their sums are the whole state of a regression: they add up over partitions
and batches, combine before the shuffle, and a site's state is one row.  The
normal equations are then solved in columns, by sweeping out the intercept
and the covariates one after the other.  Nothing runs per row in Python and
no genotype matrix is built.

Samples without a called genotype at a site do not count there.  A covariate
that is constant or a combination of others among a site's samples takes no
degree of freedom.  A site without variation of dosage, or with too few
samples, has null results.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import dosage, is_called, optional_eq
from allelic.functions.stats import log_t_two_sided, normal_two_sided
from allelic.operators.frequency import SITE_KEY
from allelic.plans.joins import MAX_BROADCAST_ROWS, join_dimension

#: A sum of squares below this share of what it was before a sweep is zero.
ZERO = 1e-9


def genotyped(calls: DataFrame, traits: DataFrame, contig: str | None = None, normalise: bool = False,
              max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Called genotypes as dosage ``g`` beside the traits of their sample."""
    df = calls.where(optional_eq("reference_name", contig) & is_called(normalise=normalise))
    df = df.select(*SITE_KEY, "sample_id", dosage(normalise=normalise).cast("double").alias("g"))
    return join_dimension(df, traits, "sample_id", "inner", max_broadcast_rows)


def _sums(rows: DataFrame, names: list[str], cols: list[Column], weight: Column | None = None) -> DataFrame:
    """Per site ``n`` and the sums ``m_i_j`` of the products of the columns."""
    w = F.lit(1.0) if weight is None else weight
    products = {f"m_{names[i]}_{names[j]}": F.sum(cols[i] * cols[j] * w) for i in range(len(cols)) for j in range(i, len(cols))}
    return rows.groupBy(*SITE_KEY).agg(F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in products.items()])


def _sweep(sums: DataFrame, names: list[str], out: list[str]) -> DataFrame:
    """Sums of the columns that are left once ``out`` are regressed out, and
    ``rank``, how many of those were independent."""
    cell = lambda a, b: f"m_{a}_{b}" if names.index(a) <= names.index(b) else f"m_{b}_{a}"
    df = sums.withColumns({f"full_{x}": F.col(cell(x, x)) for x in names}).withColumn("rank", F.lit(0))
    for k, x in enumerate(out):
        rest = names[names.index(x) + 1:] if k == names.index(x) else [y for y in names if y not in out[:k + 1]]
        df = df.withColumn("pivot", F.when(F.col(cell(x, x)) > ZERO * F.col(f"full_{x}"), F.col(cell(x, x))))
        df = df.withColumns({
            **{cell(a, b): F.col(cell(a, b)) - F.coalesce(F.col(cell(x, a)) * F.col(cell(x, b)) / F.col("pivot"), F.lit(0.0))
               for i, a in enumerate(rest) for b in rest[i:]},
            "rank": F.col("rank") + F.when(F.col("pivot").isNotNull(), 1).otherwise(0)})
    return df.drop("pivot")


def linear_association(calls: DataFrame, traits: DataFrame, trait: str, covariates: list[str] | None = None,
                       contig: str | None = None, normalise: bool = False,
                       max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Least squares of ``trait`` on the dosage and the covariates, a row a
    site: n, beta, se, t, df, p_value, neg_log10_p.

    ``traits`` has one row per ``sample_id``; rows with a null trait or
    covariate are left out.  A perfect fit has no standard error."""
    covariates = covariates or []
    t = traits.select("sample_id", F.col(trait).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(covariates)])
    rows = genotyped(calls, t.dropna(), contig, normalise, max_broadcast_rows)
    fixed = ["one", *[f"c{i}" for i in range(len(covariates))]]
    names = [*fixed, "g", "y"]
    df = _sweep(_sums(rows, names, [F.lit(1.0), *map(F.col, names[1:])]), names, fixed)
    gg, gy, yy = F.col("m_g_g"), F.col("m_g_y"), F.col("m_y_y")
    free = F.col("n") - F.col("rank") - 1
    df = df.withColumn("beta", F.when((gg > ZERO * F.col("full_g")) & (free >= 1), gy / gg))
    rss = yy - F.col("beta") * gy
    df = df.withColumn("se", F.when(rss > ZERO * F.col("full_y"), F.sqrt(rss / free / gg)))
    df = df.withColumn("t", F.col("beta") / F.col("se")).withColumn("df", F.when(F.col("beta").isNotNull(), free))
    df = df.withColumn("log_p", log_t_two_sided(F.col("t"), F.col("df")))
    return df.select(*SITE_KEY, "n", "beta", "se", "t", F.col("df").cast("long").alias("df"), F.exp("log_p").alias("p_value"),
                     (-F.col("log_p") / math.log(10)).alias("neg_log10_p"))


def fit_logistic(traits: DataFrame, trait: str, covariates: list[str], steps: int = 50, tolerance: float = 1e-10) -> list[float]:
    """Coefficients (intercept first) of the logistic regression of a 0/1
    trait on the covariates, by Newton steps: each is one aggregate whose
    (k + 1) squared sums reach the driver."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in covariates]]
    y = F.col(trait).cast("double")
    rows = traits.select(trait, *covariates).dropna()
    b = np.zeros(len(x))
    for _ in range(steps):
        p = probability(x, b)
        sums = [F.sum(c * (y - p)) for c in x] + [F.sum(x[i] * x[j] * p * (1 - p)) for i in range(len(x)) for j in range(i, len(x))]
        got = rows.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
        if got[0] is None:
            raise ValueError("no sample has the trait and all covariates")
        h = np.zeros((len(x), len(x)))
        h[np.triu_indices(len(x))] = got[len(x):]
        h = h + np.triu(h, 1).T
        step = np.linalg.lstsq(h, np.array(got[:len(x)], float), rcond=1e-12)[0]
        b = b + step
        if np.abs(step).max() < tolerance * (1 + np.abs(b).max()):
            return b.tolist()
    raise ValueError("the covariates tell cases from controls: the null model does not converge")


def probability(x: list[Column], b) -> Column:
    score = sum((c * float(v) for c, v in zip(x[1:], b[1:])), x[0] * float(b[0]))
    return 1 / (1 + F.exp(-score))


def logistic_association(calls: DataFrame, traits: DataFrame, trait: str, covariates: list[str] | None = None,
                         contig: str | None = None, normalise: bool = False,
                         max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Score test of the dosage in a logistic regression of a 0/1 ``trait``,
    a row a site: n, n_cases, score, variance, z, p_value.

    The model without dosage is fitted once over all samples; a site's state
    are the weighted sums of its samples, from which intercept and covariates
    are swept out."""
    covariates = covariates or []
    b = fit_logistic(traits, trait, covariates)
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in covariates]]
    p = probability(x, b)
    t = traits.select("sample_id", F.col(trait).cast("double").alias("y"), *covariates).dropna()
    t = t.select("sample_id", "y", p.alias("p"), *[c.alias(f"c{i}") for i, c in enumerate(x[1:])])
    rows = genotyped(calls, t, contig, normalise, max_broadcast_rows)
    fixed = ["one", *[f"c{i}" for i in range(len(covariates))]]
    names = [*fixed, "g", "r"]
    w = F.col("p") * (1 - F.col("p"))
    # the residual stands as a column whose products are those of y - p with the others
    cols = [F.lit(1.0), *[F.col(c) for c in names[1:-1]], (F.col("y") - F.col("p")) / w]
    sums = _sums(rows, names, cols, w)
    cases = rows.groupBy(*SITE_KEY).agg(F.sum("y").cast("long").alias("n_cases"))
    df = _sweep(sums, names, fixed).join(cases, SITE_KEY)
    variance = F.when(F.col("m_g_g") > ZERO * F.col("full_g"), F.col("m_g_g"))
    df = df.withColumn("variance", variance).withColumn("z", F.col("m_g_r") / F.sqrt("variance"))
    return df.select(*SITE_KEY, "n", "n_cases", F.when(F.col("variance").isNotNull(), F.col("m_g_r")).alias("score"), "variance", "z",
                     normal_two_sided(F.col("z")).alias("p_value"))
