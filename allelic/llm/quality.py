"""Quality rules: base rules and robust multivariate outliers (DataFrame only).

Every document gets whole-text counts, and from them a vector of transformed
statistics.  A minimum-covariance-determinant estimate is fitted for all
documents, for each language, and for each language and source: concentration
steps keep the ``H`` of the documents with the smallest Mahalanobis distances
and refit mean and covariance on them, from several fixed starts, of which the
least determinant wins.  Each estimate is drawn towards that of the level
above as if ``SHRINK`` documents more came from there, so a verdict moves
smoothly with the size of its group.  A document is rejected when its distance
to its group's estimate is beyond ``CUTOFF``.

A step is two aggregations over the small statistics table: an approximate
quantile of the distances (a mergeable sketch of fixed size) and sums for the
moments.  Both combine before the shuffle, so a source with a third of all
rows costs a partial row per task.  Linear algebra is columns: the Cholesky
factor of each covariance and forward substitution per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import WS, documents, let, materialise, n_words, text_of, words

SYMBOLS = r"#*$%&|<>"
MIN_WORDS = 50
#: Share of the group that each concentration step keeps.
H = 0.75
STEPS = 3
#: Documents that the level above counts for beside a group's own.
SHRINK = 100.0
ACCURACY = 10_000
#: Groups (a few dozen numbers each) whose estimates are broadcast; more are
#: joined by a shuffle, in which Spark splits the groups with many rows.
BROADCAST_GROUPS = 20_000
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats")
#: Least standard deviation of each feature: below it a spread is noise.  For
#: the shares it is about one count in a typical document: one symbol among 800
#: characters, one repeated line or word among 60.
FLOORS = (0.25, 0.05, 0.035, 0.13, 0.13)
#: Median of the chi-square distribution with five degrees of freedom; the
#: distances of a group are scaled to have it.
CHI2_MEDIAN = 4.351
#: Squared distance beyond which a document is rejected: the 0.99999 quantile of
#: the chi-square distribution with five degrees of freedom.  Around a centre
#: without them, 3.8% symbols reject alone, and so do 44% repeated lines or words.
CUTOFF = 30.856


def _repeat_words(w: Column) -> Column:
    """Words inside some 3-word window that the text has more than once."""
    n = F.size(w)
    keys = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))

    def covered(k):
        pairs = F.array_sort(F.transform(k, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(pairs, lambda s: F.array_sort(F.transform(F.filter(s, lambda x, j: (
            (j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(
                F.get(s, j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
        return F.aggregate(
            starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"])

    return F.when(n < 3, F.lit(0)).otherwise(let(keys, lambda k: F.when(
        F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(covered(k))))


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source", carry: tuple | list = ()) -> DataFrame:
    """id, lang, source, ``carry`` (a struct) and the counts of each whole text (null: no words)."""
    t = F.col("t")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return (docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(source_col).cast("string").alias("source"), text_of(text_col).alias("t"),
                        F.struct(*([F.col(c) for c in carry] or [F.lit(0).alias("_")])).alias("carry"))
            .select("id", "lang", "source", "carry", n_words(t).alias("n_words"),
                    F.char_length(F.regexp_replace(t, WS + "+", "")).cast("long").alias("word_chars"),
                    F.char_length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
                    let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                    F.size(F.filter(F.split(t, "\n", -1), lambda x: x != "")).alias("n_lines"),
                    let(words(t), _repeat_words).cast("long").alias("n_repeat_words"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def _features() -> list[Column]:
    words_, share = F.greatest(F.col("n_words"), F.lit(1)), lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), a / b)))
    return [F.log(words_), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words_),
            share(F.col("n_symbols"), F.greatest(F.col("word_chars"), F.lit(1))),
            share(F.col("n_dup_lines"), F.greatest(F.col("n_lines"), F.lit(1))),
            share(F.col("n_repeat_words"), words_)]


#: Levels of estimates: a column each, from the widest.
LEVELS = ("everything", "language", "grp")


def _with_groups(stats: DataFrame) -> DataFrame:
    """A key for each level."""
    part = lambda c: F.coalesce(c, F.lit("\0"))
    return stats.withColumns({"everything": F.lit("all"), "language": F.to_json(F.struct(part("lang").alias("l"))),
                              "grp": F.to_json(F.struct(part("lang").alias("l"), part("source").alias("s")))})


def _cholesky(cov: dict) -> list[list[Column]]:
    """Names of columns of the lower factor, added step by step to a frame."""
    p = len(FEATURES)
    steps = []
    for i in range(p):
        for j in range(i + 1):
            s = cov[i, j] - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            steps.append((f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"l{j}{j}")))
    return steps


def _small(groups: DataFrame) -> DataFrame:
    """``groups``, a materialised table, to be broadcast if small enough."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def _distances(rows: DataFrame, model: DataFrame, key: str) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2`` (unscaled) to each
    model of their ``key``."""
    out = rows.join(model, key, "left")
    parts = []
    for i in range(len(FEATURES)):
        z = F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
        parts.append(F.col(f"z{i}") * F.col(f"z{i}"))
    return out.withColumn("d2", F.round(sum(parts[1:], parts[0]), 9)).drop(
        *[f"z{i}" for i in range(len(FEATURES))])


_P = range(len(FEATURES))
_PAIRS = [(i, j) for i in _P for j in range(i + 1)]


def _factored(model: DataFrame) -> DataFrame:
    """``model`` with the Cholesky factor ``l**`` of its covariance ``c**`` and
    floors, and ``size``, the logarithm of its determinant's root."""
    cov = {(i, j): F.col(f"c{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in _PAIRS}
    for name, col in _cholesky(cov):
        model = model.withColumn(name, col)
    return model.withColumn("size", F.round(sum((F.log(F.col(f"l{i}{i}")) for i in _P), F.lit(0.0)), 9))


def _towards(own: str, above: str, n: str) -> Column:
    w = F.col(n) / (F.col(n) + SHRINK)
    return F.when(F.col(above).isNull(), F.col(own)).otherwise(w * F.col(own) + (1 - w) * F.col(above))


def _level(spark: SparkSession, rows: DataFrame, key: str, above: DataFrame | None) -> DataFrame:
    """Model per ``key``: mean ``m*``, covariance ``c**``, its factor and
    ``scale``.  ``above`` has those of the level above as ``am*``, ``ac**`` and
    ``ascale`` by ``key``."""
    names = [*[f"m{i}" for i in _P], *[f"c{i}{j}" for i, j in _PAIRS]]
    med = rows.groupBy(key).agg(*[F.percentile_approx(f"x{i}", 0.5, ACCURACY).alias(f"m{i}") for i in _P])
    med = _small(materialise(spark, med, "mcd_median"))
    mad = rows.join(med, key).groupBy(key).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in _P],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"a{i}") for i in _P])
    spread = mad.select(key, F.lit(0).alias("start"), *[f"m{i}" for i in _P], *[
        (F.pow(1.4826 * F.col(f"a{i}"), 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    starts = spread
    if above is not None:  # the estimate of the level above is a start of its own
        starts = starts.unionByName(mad.select(key).join(above, key).select(
            key, F.lit(1).alias("start"), *[F.col(f"a{c}").alias(c) for c in names]))
    else:  # the classical estimate of all rows
        starts = starts.unionByName(rows.groupBy(key).agg(
            *[F.avg(f"x{i}").alias(f"m{i}") for i in _P], *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in _PAIRS])
            .withColumn("start", F.lit(1)))
    factor = [f"l{i}{j}" for i, j in _PAIRS]
    model = _small(materialise(spark, _factored(starts), "mcd_start"))
    for step in range(STEPS):
        d = _distances(rows, model.select(key, "start", *[f"m{i}" for i in _P], *factor), key)
        d = d.select(key, "start", "d2", *[f"x{i}" for i in _P])
        limit = d.groupBy(key, "start").agg(F.percentile_approx("d2", H, ACCURACY).alias("limit"))
        limit = _small(materialise(spark, limit, f"mcd_limit_{step}"))
        kept = d.join(limit, [key, "start"]).where("d2 <= limit").groupBy(key, "start").agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in _P],
            *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in _PAIRS])
        if above is not None:
            kept = kept.join(above, key).select(key, "start", *[_towards(c, f"a{c}", "n").alias(c) for c in names])
        model = _small(materialise(spark, _factored(kept.select(key, "start", *names)), f"mcd_{step}"))
    best = model.groupBy(key).agg(F.min(F.struct("size", "start")).alias("best"))
    model = _small(materialise(spark, model.join(best, key).where("start = best.start").drop("start", "best", "size"), "mcd_best"))
    scale = _distances(rows, model, key).groupBy(key).agg(
        (F.percentile_approx("d2", 0.5, ACCURACY) / CHI2_MEDIAN).alias("scale"), F.count(F.lit(1)).alias("n"))
    if above is not None:
        scale = scale.join(above.select(key, "ascale"), key).select(key, _towards("scale", "ascale", "n").alias("scale"))
    return _small(materialise(spark, model.join(scale.select(key, "scale"), key), "mcd_model"))


def fit(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Model per ``grp`` of ``rows(everything, language, grp, x*)``."""
    names = [*[f"m{i}" for i in _P], *[f"c{i}{j}" for i, j in _PAIRS], "scale"]
    keys = materialise(spark, rows.select(*LEVELS).distinct(), "mcd_keys")
    model = None
    for wide, key in zip((None, *LEVELS), LEVELS):
        above = None
        if model is not None:
            above = keys.select(wide, key).distinct().join(model, wide).select(key, *[F.col(c).alias(f"a{c}") for c in names])
            above = _small(materialise(spark, above, "mcd_above"))
        model = _level(spark, rows, key, above)
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", cutoff: float = CUTOFF, carry: tuple | list = ()) -> DataFrame:
    """One row per input row: id, the counts, ``base_failed``, ``distance``
    (scaled squared Mahalanobis distance) and ``kept``.

    Null texts have no words and fail the base rules.  Null languages and
    sources are groups of their own.  Only documents that pass the base rules
    are fitted and judged; ``distance`` is null for the others and where no
    group could be fitted, and such a document is kept if the base rules
    passed it.  Rows repeated in full are judged one by one, alike.  An empty
    table gives an empty result.  Columns in ``carry`` are passed on; others
    are ignored.
    """
    spark = docs.sparkSession
    stats = materialise(spark, text_stats(docs, id_col, text_col, lang_col, source_col, carry), "quality_stats")
    rows = _with_groups(stats).withColumns({f"x{i}": x for i, x in enumerate(_features())})
    rows = materialise(spark, rows, "quality_rows")
    model = fit(spark, rows.where(~F.col("base_failed")).select(*LEVELS, *[f"x{i}" for i in _P]))
    d = _distances(rows, model, "grp")
    # distances shrink below the normal ones where floors dominate: never scale up
    scaled = F.when(~F.col("base_failed"), F.col("d2") / F.greatest(F.col("scale"), F.lit(1.0)))
    return d.withColumn("distance", scaled).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"),
        *[F.col("carry")[c].alias(c) for c in carry])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))
