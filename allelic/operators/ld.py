"""Linkage disequilibrium: r squared of sites in a window, and pruning.

Calls meet calls of the same sample on the same contig.  Positions fall into
bins as wide as the window, and a call is sent to its own bin as the left
side of a pair and to its own and the next bin as the right one, so the join
has an equality key of contig, sample and bin: what a task holds is bounded
by the sites of a window, whatever the cohort, and no bin is hot, as each
sample parts it.  The sums of a pair of sites combine before the shuffle.

Both genotypes of a sample must be called.  A sample called twice at a site
counts with its largest dosage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.functions.genotype import dosage, is_called, optional_eq
from allelic.operators.frequency import SITE_KEY
from allelic.session import scratch_path

WINDOW, MIN_SAMPLES, MAX_R2 = 500_000, 10, 0.2


def ld_pairs(calls: DataFrame, window: int = WINDOW, contig: str | None = None, min_samples: int = MIN_SAMPLES,
             normalise: bool = False) -> DataFrame:
    """``r2`` of each two sites at most ``window`` bases apart that
    ``min_samples`` samples or more share: contig, both sites, n, r2.

    The first site is the smaller by position, then alleles.  Without
    variation of one of them, r2 is null.  All sums are exact integers."""
    one = calls.where(optional_eq("reference_name", contig) & is_called(normalise=normalise)).select(
        "reference_name", "sample_id", "start", F.concat_ws(">", "reference_bases", "alternate_bases").alias("alleles"),
        dosage(normalise=normalise).cast("long").alias("g"))
    one = one.groupBy("reference_name", "sample_id", "start", "alleles").agg(F.max("g").alias("g"))
    bin_ = F.floor(F.col("start") / window).cast("long")
    left = one.select("reference_name", "sample_id", bin_.alias("bin"), F.col("start").alias("start_a"), F.col("alleles").alias("alleles_a"),
                      F.col("g").alias("a"))
    right = one.select("reference_name", "sample_id", F.explode(F.array(bin_, bin_ - 1)).alias("bin"), F.col("start").alias("start_b"),
                       F.col("alleles").alias("alleles_b"), F.col("g").alias("b"))
    met = left.join(right, ["reference_name", "sample_id", "bin"]).where(
        (F.col("start_b") - F.col("start_a") <= window)
        & ((F.col("start_a") < F.col("start_b")) | (F.col("start_a") == F.col("start_b")) & (F.col("alleles_a") < F.col("alleles_b"))))
    s = met.groupBy("reference_name", "start_a", "alleles_a", "start_b", "alleles_b").agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(F.col("a") * F.col("a")).alias("aa"),
        F.sum(F.col("b") * F.col("b")).alias("bb"), F.sum(F.col("a") * F.col("b")).alias("ab")).where(F.col("n") >= min_samples)
    cov = (F.col("n") * F.col("ab") - F.col("a") * F.col("b")).cast("double")
    va = (F.col("n") * F.col("aa") - F.col("a") * F.col("a")).cast("double")
    vb = (F.col("n") * F.col("bb") - F.col("b") * F.col("b")).cast("double")
    return s.select("reference_name", "start_a", "alleles_a", "start_b", "alleles_b", "n",
                    (cov * cov / F.nullif(va * vb, F.lit(0.0))).alias("r2"))


def _write(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prune(sites: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, kept`` of ``sites(node, rank)``: the greedy independent set of
    the graph ``edges(a, b)``, taking nodes by rank and leaving out
    neighbours of what is taken.  Ranks must differ between neighbours.

    In each round every open node that outranks all its open neighbours is
    taken and its neighbours leave, which gives what the one-by-one walk
    gives.  Rounds follow the longest chain of falling ranks, not the number
    of nodes; edges and states stay tables, minima combine before the shuffle.
    """
    spark = sites.sparkSession
    rank = sites.select(F.col("node"), F.col("rank"))
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    open_ = _write(spark, both.join(rank.select(F.col("node").alias("a"), F.col("rank").alias("ra")), "a")
                   .join(rank.select(F.col("node").alias("b"), F.col("rank").alias("rb")), "b"), "ld_open")
    out = None
    while open_.head(1):
        first = open_.groupBy("a", "ra").agg(F.min("rb").alias("least")).where("ra < least").select(F.col("a").alias("node"))
        first = _write(spark, first, "ld_first")
        left = open_.join(first.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct()
        gone = _write(spark, first.withColumn("kept", F.lit(True)).unionByName(left.withColumn("kept", F.lit(False))), "ld_gone")
        out = gone if out is None else out.unionByName(gone)
        # a node left with no open neighbour has no row any more and is kept
        open_ = open_.join(gone.select(F.col("node").alias("a")), "a", "left_anti").join(gone.select(F.col("node").alias("b")), "b", "left_anti")
        open_ = _write(spark, open_, "ld_open")
    if out is None:
        return rank.select("node", F.lit(True).alias("kept"))
    return rank.join(out, "node", "left").select("node", F.coalesce("kept", F.lit(True)).alias("kept"))


def ld_prune(calls: DataFrame, max_r2: float = MAX_R2, window: int = WINDOW, contig: str | None = None,
             min_samples: int = MIN_SAMPLES, normalise: bool = False) -> DataFrame:
    """Sites with ``minor_allele_count`` and ``kept``: no two kept sites in a
    window have r2 above ``max_r2``.  Sites are taken by their minor allele
    count, largest first, ties by contig, position and alleles."""
    called = calls.where(optional_eq("reference_name", contig) & is_called(normalise=normalise))
    counts = called.groupBy(*SITE_KEY).agg(F.sum(dosage(normalise=normalise)).cast("long").alias("ac"), (2 * F.count(F.lit(1))).alias("an"))
    sites = counts.select(*SITE_KEY, F.least("ac", F.col("an") - F.col("ac")).alias("minor_allele_count"),
                          F.concat_ws(">", "reference_bases", "alternate_bases").alias("alleles"))
    node = lambda start, alleles: F.struct("reference_name", F.col(start).alias("start"), F.col(alleles).alias("alleles"))
    sites = _write(calls.sparkSession, sites.withColumn("node", node("start", "alleles")), "ld_sites")
    linked = ld_pairs(calls, window, contig, min_samples, normalise).where(F.col("r2") > max_r2).select(
        node("start_a", "alleles_a").alias("a"), node("start_b", "alleles_b").alias("b"))
    ranked = sites.select("node", F.struct((-F.col("minor_allele_count")).alias("m"), "node").alias("rank"))
    return sites.join(prune(ranked, linked), "node").select(*SITE_KEY, "minor_allele_count", "kept")
