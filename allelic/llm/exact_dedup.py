"""Exact dedup by content sort (DataFrame functions only).

Sampled splitters cut the order (first bytes of the normalised text, its
64-bit hash, longest original first, id) into ranges; each range is sorted
externally by Spark's window sort, which puts equal texts next to each other,
and every row is compared in full with its neighbour.  A run of equal rows is
a group.  Because the order goes on to length and id, a text with very many
copies spreads over several ranges; only the first and the last run of a range
can go on in another one, so joining up groups across ranges touches at most
two runs a range.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from allelic.llm.common import WS, documents, materialise, parallelism, text_of

#: First characters of the normalised text in the sort key; the hash behind it
#: separates texts that begin alike.
KEY_CHARS = 24
SAMPLES_PER_RANGE = 30
MAX_RANGES = 4096

_KEY = T.StructType([T.StructField("prefix", T.StringType()), T.StructField("hash", T.LongType()),
                     T.StructField("shorter", T.IntegerType()), T.StructField("id", T.LongType())])


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: list) -> DataFrame:
    return (docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), F.struct(*carry).alias("carry"))
            .select("id", "carry", (-F.char_length("text")).alias("shorter"),
                    F.regexp_replace("text", WS + "+", "").alias("norm"))
            .select("id", "carry", "shorter", "norm", F.substring("norm", 1, KEY_CHARS).alias("prefix"),
                    F.xxhash64("norm").alias("hash")))


def splitters(docs: DataFrame, id_col: str, text_col: str, ranges: int, seed: int = 7) -> list:
    """At most ``ranges - 1`` splitters from a bounded sample of sort keys
    (about ``SAMPLES_PER_RANGE`` a range, a fixed-size key each)."""
    rows = docs.count()
    want = SAMPLES_PER_RANGE * ranges
    if ranges < 2 or rows == 0:
        return []
    sample = docs if rows <= want else docs.sample(fraction=min(1.0, 1.1 * want / rows), seed=seed)
    keys = (_keyed(sample, id_col, text_col, [F.lit(0).alias("_")]).select(F.struct(*_KEY.names).alias("k"))
            .orderBy("k").limit(2 * want).collect())
    cuts = [keys[len(keys) * j // ranges].k for j in range(1, ranges)] if keys else []
    return [[k.prefix, k.hash, k.shorter, k.id] for k in cuts]


def _range_of(cuts: list):
    """Number of splitters not above the row's key: one pass over every 64th
    splitter, then one over the 64 from there."""
    if not cuts:
        return F.lit(0)
    blocks = [cuts[i:i + 64] for i in range(0, len(cuts), 64)]
    as_json = lambda rows: json.dumps([dict(zip(_KEY.names, r)) for r in rows])
    heads = F.from_json(F.lit(as_json([b[0] for b in blocks])), T.ArrayType(_KEY))
    tails = F.array(*[F.from_json(F.lit(as_json(b)), T.ArrayType(_KEY)) for b in blocks])
    key = F.struct(*_KEY.names)
    below = lambda a: F.size(F.filter(a, lambda s: s <= key))
    block = below(heads)
    return F.when(block == 0, 0).otherwise(
        (block - 1) * 64 + below(F.element_at(tails, F.greatest(block, F.lit(1)))))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ranges: int | None = None, carry: tuple | list = ()) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` of the normalised text.

    Texts are equal when the same after deleting white space.  The row with
    most code points stays, then the smallest id (null first); of fully tied
    rows (same id, same length) exactly one.  A null text is an empty text;
    all empty texts are one group.  An empty table gives an empty result.
    Columns in ``carry`` are passed on; others are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ranges = min(MAX_RANGES, ranges or 4 * parallelism(spark))
    cuts = splitters(docs, id_col, text_col, ranges)
    order = [F.col(c).asc_nulls_first() for c in ("prefix", "hash", "norm", "shorter", "id")]
    in_range = Window.partitionBy("rng").orderBy(*order)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept_cols = [F.col(c) for c in carry] or [F.lit(0).alias("_")]
    runs = (_keyed(docs, id_col, text_col, kept_cols).withColumn("rng", _range_of(cuts))
            .withColumn("sha", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
            .withColumn("same", F.lag("norm").over(in_range) == F.col("norm"))
            .withColumn("run", F.sum(F.when(F.col("same"), 0).otherwise(1)).over(so_far))
            .select("id", "carry", "shorter", "rng", "run", "sha"))
    runs = materialise(spark, runs, "dedup_runs")

    in_run = Window.partitionBy("rng", "run")
    first = in_run.orderBy(F.col("shorter").asc(), F.col("id").asc_nulls_first())
    rows = (runs.withColumn("nth", F.row_number().over(first))
            .withColumn("head", F.first(F.struct("shorter", "id", "rng")).over(first))
            .withColumn("rows", F.count(F.lit(1)).over(in_run)))
    last = runs.groupBy("rng").agg(F.max("run").alias("last"))
    ends = (rows.where("nth = 1").join(F.broadcast(last), "rng")  # one row a range
            .where("run = 1 or run = last"))
    spanning = (ends.groupBy("sha").agg(F.min("head").alias("all_head"), F.sum("rows").alias("all_rows"),
                                        F.count(F.lit(1)).alias("pieces"))
                .where("pieces > 1").drop("pieces"))
    # at most two runs a range and MAX_RANGES ranges: the broadcast is bounded
    out = rows.join(F.broadcast(spanning), "sha", "left")
    head = F.coalesce("all_head", "head")
    return out.select(
        F.col("id").alias(id_col), head["id"].alias("keep_id"),
        F.coalesce("all_rows", "rows").cast("long").alias("group_size"),
        ((F.col("nth") == 1) & (head["rng"] == F.col("rng"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), *[F.col("carry")[c].alias(c) for c in carry])


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
  FROM documents
), g AS (
  SELECT doc_id, n, row_number() OVER w AS r, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY n) AS group_size
  FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(n) AS text_sha256 FROM g
"""
