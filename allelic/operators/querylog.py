"""Rollups over a query-log table (H1-H3, D13): one row per executed query
(strategy, query_type, cohort_size, execution_time_ms, bytes_scanned).

Latency means are computed from an exact decimal sum (twelve decimals)
divided by the count, so the result does not depend on summation order
across partitions.  Everything is a single hash aggregate on a small key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelic.functions.cost import BYTES_IN_MB, dollars, scan_cost

# Pivot columns of the per-store summary.
SUMMARY_TYPES = {"carrier_lookup": "carrier_lookup_ms",
                 "allele_frequency": "allele_freq_ms",
                 "omop_join": "omop_join_ms"}


def _exact_mean(value: Column, cond: Column | None = None) -> Column:
    v = value if cond is None else F.when(cond, value)
    return (F.sum(v.cast("decimal(38,12)")).cast("double")
            / F.count(v).cast("double"))


def with_cost(log: DataFrame) -> DataFrame:
    return log.withColumn("cost_usd", scan_cost(F.col("bytes_scanned")))


def scan_costs(log: DataFrame) -> DataFrame:
    return with_cost(log).select("strategy", "query_type", "cohort_size", "bytes_scanned",
                                 "cost_usd", dollars(F.col("cost_usd")).alias("cost_label"))


def bench_summary(log: DataFrame) -> DataFrame:
    """Per store: mean latency of three query types (0.0 when absent), mean
    cost over all query types and its dollar label."""
    g = with_cost(log).groupBy("strategy").agg(
        *[_exact_mean(F.col("execution_time_ms"), F.col("query_type") == t).alias(c)
          for t, c in SUMMARY_TYPES.items()],
        F.avg("cost_usd").alias("_cost"),
    )
    out = g.select(
        "strategy",
        *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 1).alias(c) for c in SUMMARY_TYPES.values()],
        F.round(F.col("_cost"), 10).alias("mean_cost_usd"),
        dollars(F.col("_cost")).alias("cost_per_query"),
    )
    return out.orderBy("strategy")


def bench_ranking(log: DataFrame) -> DataFrame:
    """Stores ranked by the mean of their three summary latencies."""
    s = bench_summary(log)
    composite = sum((F.col(c) for c in SUMMARY_TYPES.values()), F.lit(0.0)) / F.lit(3.0)
    return (s.select("strategy", F.round(composite, 1).alias("composite_latency_ms"),
                     F.round(F.col("mean_cost_usd") * F.lit(1000000.0), 2)
                      .alias("cost_per_million_queries"))
             .orderBy("composite_latency_ms", "strategy"))


def bench_scaling(log: DataFrame) -> DataFrame:
    """Composite latency per (cohort size, store) plus scan MB and cost of
    the allele-frequency queries."""
    af = F.col("query_type") == "allele_frequency"
    g = with_cost(log).groupBy("cohort_size", "strategy").agg(
        *[F.coalesce(_exact_mean(F.col("execution_time_ms"), F.col("query_type") == t),
                     F.lit(0.0)).alias(c) for t, c in SUMMARY_TYPES.items()],
        F.avg(F.when(af, F.col("bytes_scanned"))).alias("_bytes"),
        F.avg(F.when(af, F.col("cost_usd"))).alias("_cost"),
    )
    composite = sum((F.col(c) for c in SUMMARY_TYPES.values()), F.lit(0.0)) / F.lit(3.0)
    return (g.select("cohort_size", "strategy",
                     F.round(composite, 1).alias("composite_latency_ms"),
                     F.round(F.col("_bytes") / F.lit(BYTES_IN_MB), 2).alias("mb_scanned"),
                     F.round(F.col("_cost"), 10).alias("cost_usd"))
             .orderBy("cohort_size", "strategy"))
