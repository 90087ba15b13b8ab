"""Corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing, packing.

Each stage takes documents and returns documents, but the last, which returns
packed pieces.  Operators return decisions by id; a stage joins them back to
its documents.  Decisions up to ``BROADCAST_ROWS`` are broadcast, more are
shuffled.  Rows are told apart by id and a hash of their text, so ids that
repeat with different texts get their own decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, materialise
from allelic.llm.exact_dedup import exact_dedup
from allelic.llm.jaccard_join import jaccard_classes
from allelic.llm.mixing import mix_sources
from allelic.llm.packing import pack_documents
from allelic.llm.quality import quality

BROADCAST_ROWS = 2_000_000
#: SQL cannot express the covariance estimates and the packing.
ORACLE_SQL = None


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _join(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """By null-safe ``doc_id`` and text hash ``h``; other columns of
    ``decisions`` follow those of ``docs`` in an inner join."""
    small = decisions.count() <= BROADCAST_ROWS
    right = decisions.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (_text_hash() == F.col("_h"))
    return docs.join(F.broadcast(right) if small else right, on, how).drop("_id", "_h")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go; rows repeated in full share
    their fate; a null id, language or source is one of its own.
    """
    result = quality(docs.withColumn("_h", _text_hash()), carry=["_h"])
    gone = result.where(~F.col("kept")).select("doc_id", F.col("_h").alias("h")).distinct()
    return _join(docs, materialise(spark, gone, "stage_quality"), "left_anti")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows that repeat in full,
    one."""
    result = exact_dedup(docs.withColumn("_h", _text_hash()), carry=["_h"])
    result = materialise(spark, result.select("doc_id", F.col("_h").alias("h"), "kept"), "stage_exact")
    fate = result.groupBy("doc_id", "h").agg(F.max("kept").alias("kept"), F.min("kept").alias("all"))
    out = _join(docs, fate.where(~F.col("all")).select("doc_id", "h"), "left_anti")
    repeated = fate.where(F.col("kept") & ~F.col("all")).select("doc_id", "h")
    return out.unionByName(_join(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Texts are told apart, not ids: of an id with several texts each has its
    own fate, and rows repeated in full have one.  Documents without words,
    and those with a null id, stay.
    """
    rows = docs.select("doc_id", _text_hash().alias("h")).where("doc_id is not null").distinct()
    if rows.groupBy("doc_id").count().where("count > 1").head(1):
        # numbers in the order of the ids; written, so that they hold
        rows = rows.orderBy("doc_id", "h").withColumn("_row", F.monotonically_increasing_id())
        rows = materialise(spark, rows, "stage_rows")
        result = jaccard_classes(_join(docs, rows, "inner").select("_row", "text"), "_row")
        gone = result.where("_row <> component_id").select("_row").distinct()
        gone = rows.join(gone, "_row").select("doc_id", "h")
    else:
        result = jaccard_classes(docs).where("doc_id <> component_id").select("doc_id").distinct()
        gone = rows.join(result, "doc_id").select("doc_id", "h")
    return _join(docs, materialise(spark, gone, "stage_near"), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null and empty texts have size 0 and give nothing to take; the copies of
    rows repeated in full add up; a null source is one of its own.
    """
    result = mix_sources(docs.withColumn("_h", _text_hash()), carry=["_h"])
    taken = result.where("copies > 0").groupBy("doc_id", F.col("_h").alias("h")).agg(F.sum("copies").alias("_copies"),
                                                                                  F.count(F.lit(1)).alias("_rows"))
    # rows that repeat in full share their copies: each of them stands for an equal part
    out = _join(docs.dropDuplicates(["doc_id", "text"]) if _repeats(docs) else docs,
                materialise(spark, taken, "stage_mix"), "inner")
    return out.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(docs.columns)


def _repeats(docs: DataFrame) -> bool:
    rows = docs.groupBy("doc_id", _text_hash().alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return bool(rows.head(1))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; a null or empty text is its end id alone."""
    return pack_documents(docs)


STAGES = [("quality", quality_rules), ("exact_dedup", exact), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialise(spark, docs, f"pipeline_{name}")
    return docs
