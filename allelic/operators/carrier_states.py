"""Carrier frequency from states that batches can be added to.

Samples have dense numbers (``number_samples``).  Per site and block of 32,768
sample numbers a state holds the samples seen there and a count of carrier
calls.  Samples are counted as masks of 64: up to ``FEW_WORDS`` masks stay a
list, so a block with few samples is a few bytes; more become a bitmap of
4 KB.  States of a new batch are merged with older ones by or-ing masks,
without reading older calls, and a batch that is counted again adds no sample
twice.  Calls combine before the shuffle where that leaves few of them; else
they are dealt to tasks of a bounded number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.functions.genotype import clnsig_col, gene_col, is_carrier
from allelic.operators.frequency import SITE_KEY
from allelic.plans.joins import MAX_BROADCAST_ROWS, deal, join_dimension, tasks_for
from allelic.session import scratch_path

KEY = [*SITE_KEY, "gene_symbol", "clinical_significance"]
NUMBERS = "sample_id string, number long"
#: Masks of a block, and how many of them stay a list.
WORDS, FEW_WORDS = 512, 128


def number_samples(calls: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``sample_id, number`` from 1, dense; ``known`` numbers stay and new
    samples follow.  New ids are range-sorted and written once; numbers are
    places within a range behind the sizes of the ranges before it, so the
    driver sees a number a range."""
    spark = calls.sparkSession
    ids = calls.select("sample_id").where("sample_id is not null").distinct()
    base = 0
    if known is not None:
        ids = ids.join(known, "sample_id", "left_anti")
        base = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    path = scratch_path(spark, "sample_numbers")
    # the id's low 33 bits are the row's place in its range, the rest is the range
    (ids.repartitionByRange("sample_id").sortWithinPartitions("sample_id")
     .withColumn("at", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.schema("sample_id string, at long").parquet(path).select(
        "sample_id", F.shiftright("at", 33).alias("range"), (F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("place"))
    before, total = {}, base
    for r in placed.groupBy("range").count().orderBy("range").collect():
        before[r["range"]], total = total, total + r["count"]
    starts = spark.createDataFrame(list(before.items()), "range long, before long")
    new = placed.join(F.broadcast(starts), "range").select("sample_id", (F.col("before") + F.col("place")).alias("number"))
    return new if known is None else known.select("sample_id", "number").unionByName(new)


def _states(words: DataFrame) -> DataFrame:
    """A row for each site and block from one for each ``word`` of it: its
    masks as a list (``words``) or, if they are many, a bitmap (``samples``)."""
    g = words.groupBy(*KEY, "block").agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("words"), F.sum("carriers").alias("carriers"))
    mask = F.map_from_entries("words")
    text = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.lpad(F.hex(F.coalesce(F.get(F.map_values(F.map_filter(mask, lambda k, _: k == w)), F.lit(0)), F.lit(0))), 16, "0"))
    many = F.size("words") > FEW_WORDS
    return g.select(*KEY, "block", F.when(many, F.unhex(F.array_join(text, ""))).alias("samples"), F.when(~many, F.col("words")).alias("words"), "carriers")


def _by_word(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY, "block", "word").agg(F.bit_or("mask").alias("mask"), F.sum("carriers").alias("carriers"))


def carrier_states(calls: DataFrame, numbers: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """State rows of some calls: site, ``block``, ``samples`` or ``words``,
    ``carriers``."""
    rows = calls.select(*SITE_KEY, gene_col(calls).alias("gene_symbol"), clnsig_col(calls).alias("clinical_significance"),
                        "sample_id", is_carrier().alias("carrier"))
    rows = join_dimension(rows, numbers, "sample_id", "inner", max_broadcast_rows)
    at = F.bitmap_bit_position("number")
    rows = rows.select(*KEY, F.bitmap_bucket_number("number").alias("block"), F.shiftright(at, 6).cast("int").alias("word"),
                       F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("mask"),
                       F.coalesce(F.col("carrier").cast("long"), F.lit(0)).alias("carriers"))
    return _states(_by_word(deal(rows, [*KEY, "block"], [*SITE_KEY, "block", "word"])))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state for each site and block of several."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    n = out.agg(F.sum(F.coalesce(F.size("words"), F.lit(WORDS)))).first()[0] or 0
    listed = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.struct(
        i.alias("word"), F.conv(F.substring(F.hex("samples"), F.lit(16) * i + 1, F.lit(16)), 16, -10).cast("long").alias("mask")))
    words = F.coalesce("words", F.filter(listed, lambda x: x["mask"] != 0))
    rows = out.repartition(tasks_for(n), *KEY, "block").select(*KEY, "block", "carriers", F.posexplode(words).alias("at", "w"))
    # a state's count goes with its first mask
    rows = rows.select(*KEY, "block", F.col("w.word").alias("word"), F.col("w.mask").alias("mask"), F.when(F.col("at") == 0, F.col("carriers")).otherwise(0).alias("carriers"))
    return _states(_by_word(rows))


def carrier_frequency_of(states: DataFrame) -> DataFrame:
    """Carrier frequency per site, as ``frequency.carrier_frequency`` gives it
    from calls.  States must be merged: a block of a site is one row."""
    listed = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["mask"]))
    g = states.groupBy(*KEY).agg(F.sum(F.coalesce(F.bitmap_count("samples"), listed)).alias("total_cohort_samples"), F.sum("carriers").alias("alt_carrier_count"))
    share = F.round(F.col("alt_carrier_count").cast("double") / F.col("total_cohort_samples").cast("double"), 4)
    return g.select(*SITE_KEY, "total_cohort_samples", "alt_carrier_count", share.alias("carrier_frequency"), "gene_symbol", "clinical_significance")
