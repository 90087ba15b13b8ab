"""Mixing sources to target weights by systematic sampling (DataFrame only).

Each document of a source has the same expected number of copies, target over
source size.  The expected copies are prefix-summed over the documents of the
source, one random offset a source is added, and a document is emitted once
for each integer boundary its step crosses.  The sum runs by document size, so
every size is drawn in proportion and the words taken come near the target.

The prefix sum has two levels: documents are numbered within (source, size
class, salt) blocks and the counts of the blocks are summed per source, so a
source with a third of all rows is spread over all its blocks.  Sums are kept
in fixed point (2**-24 copies) and are exact, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from allelic.llm.common import documents, materialise, n_words, text_of

WEIGHTS = (3, 1, 2)
SHARE_NUM, SHARE_DEN = 3, 2
CAP = 2
BITS = 24
SIZE_STEP = 64
SALTS = 16
SEED = "mix-1"


def _bits24(*parts):
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 6), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: ``source_size`` and ``target``.

    Sources by code point, null last, weigh 3, 1, 2, repeating.  A source
    whose share exceeds ``CAP`` times its size stops there; the rest is shared
    by weight among the others.  With sources ordered by size over weight, the
    ones that stop come first, so the level at which the others share is the
    first one its own source can take.  One row a source goes through the
    unpartitioned windows.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                          (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    src = src.withColumn("weight", weight)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    src = (src.withColumn("total", SHARE_NUM * F.sum("source_size").over(every))
           .withColumn("stopped", F.coalesce(F.sum("source_size").over(
               by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("sharing", F.sum("weight").over(
               by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
           .withColumn("level", (F.col("total") - SHARE_DEN * CAP * F.col("stopped")).cast("double")
                       / (SHARE_DEN * F.col("sharing")))
           .withColumn("fits", F.col("level") * F.col("weight") <= CAP * F.col("source_size"))
           .withColumn("common", F.min(F.when(F.col("fits"), F.struct(
               F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"),
               F.col("level").alias("level")))).over(every)["level"]))
    cap = (CAP * F.col("source_size")).cast("double")
    return src.select("source", "source_size", F.least(
        cap, F.coalesce(F.col("common") * F.col("weight"), cap)).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", salts: int = SALTS, seed: str = SEED,
                carry: tuple | list = ()) -> DataFrame:
    """One row per input row: id, size (words), source_size, target, copies,
    taken (``copies * size``); ``copies`` is 0, 1 or 2.

    A null text has size 0; null sources form one source, last in order; a
    source without words takes nothing.  A null id sorts first.  Rows repeated
    in full are separate documents.  An empty table gives an empty result.
    Columns in ``carry`` are passed on; others are ignored.
    """
    spark = docs.sparkSession
    sizes = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                        n_words(text_of(text_col)).alias("size"),
                        F.struct(*([F.col(c) for c in carry] or [F.lit(0).alias("_")])).alias("carry"))
    sizes = materialise(spark, sizes, "mix_sizes")
    src = (targets(sizes).withColumn("step", F.coalesce(F.floor(
        F.col("target") / F.nullif(F.col("source_size"), F.lit(0)) * (1 << BITS)), F.lit(0)).cast("long"))
        .withColumn("offset", _bits24(F.lit(seed), F.coalesce("source", F.lit("\0")))))
    block = [F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n")).alias("key"),
             F.floor(F.col("size") / SIZE_STEP).alias("cls"),
             (_bits24(F.coalesce(F.col("id").cast("string"), F.lit(""))) % salts).alias("salt")]
    rows = sizes.select("*", *block)
    before = Window.partitionBy("key").orderBy("cls", "salt").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.groupBy("key", "cls", "salt").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    src = src.withColumn("key", F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n"))).drop("source")
    nth = F.row_number().over(Window.partitionBy("key", "cls", "salt")
                              .orderBy("size", F.col("id").asc_nulls_first()))
    upto = (F.col("before") + F.col("nth")) * F.col("step") + F.col("offset")
    copies = F.shiftright(upto, BITS) - F.shiftright(upto - F.col("step"), BITS)
    return (rows.withColumn("nth", nth).join(blocks.join(src, "key"), ["key", "cls", "salt"])
            .withColumn("copies", copies)
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"),
                    *[F.col("carry")[c].alias(c) for c in carry]))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents
), s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), s1 AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s0
), s2 AS (
  SELECT *, 3 * sum(source_size) OVER () AS total,
         row_number() OVER r AS pos,
         coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
         sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing
  FROM s1 WINDOW r AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
), s3 AS (
  SELECT *, (total - 4 * stopped)::DOUBLE / (2 * sharing)::DOUBLE AS level FROM s2
), s4 AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, coalesce(
           (SELECT arg_min(level, pos) FROM s3 WHERE level * weight <= 2 * source_size) * weight,
           (2 * source_size)::DOUBLE)) AS target
  FROM s3
), s5 AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)::DOUBLE * 16777216), 0)::BIGINT AS step,
         ('0x' || substr(md5('mix-1' || coalesce(source, chr(0))), 1, 6))::BIGINT AS ofs
  FROM s4
), o AS (
  SELECT d.doc_id, d.size, s5.source_size, s5.target, s5.step, s5.ofs,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size // 64,
           ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 6))::BIGINT % 16,
           d.size, d.doc_id NULLS FIRST) AS nth
  FROM d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source
), c AS (
  SELECT *, ((nth * step + ofs) >> 24) - (((nth - 1) * step + ofs) >> 24) AS copies FROM o
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM c
"""
