"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.session import scratch_path

#: The white space of every contract: space and the controls 9 to 13.
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where
    ``body`` uses it inside further lambda functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, kind: str, value: Callable[[Column], Column], op: Callable[[Column, Column], Column],
            identity: Column, block: int = 128) -> Column:
    """``items`` (an array of ``kind``) as structs ``x`` and ``before``, the
    fold by the associative ``op`` of the values (ints) of all items before.

    Arrays are immutable, so appending one by one is quadratic; here items are
    folded in blocks, whose starts come from a fold over the blocks.
    """
    parts = F.when(F.size(items) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / block).cast("int")), lambda b: F.slice(items, b * block + 1, F.lit(block))))
    totals = F.transform(parts, lambda p: F.aggregate(p, identity, lambda a, x: op(a, value(x))))
    ints, pairs = F.lit([]).cast("array<int>"), F.lit([]).cast(f"array<struct<x:{kind},before:int>>")

    def step(acc, x, out, new):
        return F.struct(op(acc["at"], new).alias("at"), F.concat(acc["out"], F.array(out)).alias("out"))

    starts = F.aggregate(totals, F.struct(identity.alias("at"), ints.alias("out")), lambda a, t: step(a, t, a["at"], t), lambda a: a["out"])
    blocks = F.zip_with(parts, starts, lambda p, s: F.aggregate(
        p, F.struct(s.alias("at"), pairs.alias("out")),
        lambda a, x: step(a, x, F.struct(x.alias("x"), a["at"].alias("before")), value(x)), lambda a: a["out"]))
    return F.coalesce(F.flatten(blocks), pairs)


def text_of(col) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of maximal runs of non white space in a non-null text (long)."""
    pieces = F.size(F.split(text, WS + "+"))
    return F.when(text == "", F.lit(0)).otherwise(
        pieces - F.when(text.rlike("^" + WS), 1).otherwise(0)
        - F.when(text.rlike(WS + r"\z"), 1).otherwise(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a non-null text, in order."""
    return F.filter(F.split(text, WS + "+"), lambda w: w != "")


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage
    ends there, so a lost executor costs a re-read and not a re-run."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside hand their Python tasks batches of about ``size`` bytes
    (or of a single longer row), however wide the rows are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
