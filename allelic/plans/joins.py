"""Fact-to-dimension joins with a checked broadcast and a skew-aware fallback.

A dimension (one row per participant, per site, ...) is broadcast only after
its row count is measured (one cheap aggregate over the dimension) and found
under ``max_broadcast_rows``.

Beyond that the join is a shuffle join that salts only the hot keys:

1. one partially-aggregated count over the fact side finds the keys with at
   least ``hot_rows`` rows and at least the ``MAX_HOT_KEYS``-th part of all
   rows, so there are at most ``MAX_HOT_KEYS`` of them to broadcast.
2. fact rows of a hot key get a deterministic salt in [0, buckets) (a hash of
   the row, so retries give the same salt); all other rows get salt 0.
3. dimension rows of a hot key are replicated once per salt value; all
   others appear once.

A key holding a third of all calls is therefore spread over ``buckets``
tasks.  Only hot keys' dimension rows are replicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000
HOT_ROWS = 1_000_000
SALT_BUCKETS = 32
MAX_HOT_KEYS = 100_000
#: Rows of a task that groups what does not combine, and what share of the
#: rows may be left by combining that comes before a shuffle.
TASK_ROWS, COMBINED = 1 << 17, 0.25


def hot_keys(fact: DataFrame, keys: list[str], hot_rows: int) -> list:
    """Keys to salt, collected: at most ``MAX_HOT_KEYS``.  A key below the
    share is no more than one of that many equal parts of the work."""
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_rows)
    share = fact.count() / MAX_HOT_KEYS
    return counts.where(F.col("_n") >= share).select(*keys).collect()


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner",
                   max_broadcast_rows: int = MAX_BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
                   buckets: int = SALT_BUCKETS) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"fact-side join type expected, got {how}")
    if dim.count() <= max_broadcast_rows:
        return fact.join(F.broadcast(dim), keys, how)
    hot = hot_keys(fact, keys, hot_rows)
    if not hot:
        return fact.join(dim, keys, how)
    flag = fact.sparkSession.createDataFrame(hot, fact.select(*keys).schema)
    flag = F.broadcast(flag.withColumn("_hot", F.lit(True)))
    row_hash = F.xxhash64(*[F.col(c) for c in fact.columns])
    f = (fact.join(flag, keys, "left")
             .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(buckets)))
                         .otherwise(F.lit(0)).cast("int"))
             .drop("_hot"))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))) \
        .otherwise(F.array(F.lit(0)))
    d = (dim.join(flag, keys, "left")
            .withColumn("_salt", F.explode(copies)).drop("_hot"))
    return f.join(d, keys + ["_salt"], how).drop("_salt")


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def deal(df: DataFrame, by: list[str], groups: list[str]) -> DataFrame:
    """Rows to be grouped by ``groups``, some of which are ``by``.  If groups
    are few for the rows, these stay where they are and combine before the
    shuffle; else they are dealt by ``by``, so many to a task that its memory
    does not grow with the table.  Two counts of one pass tell."""
    rows, found = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*groups))).first()
    return df if found <= COMBINED * rows else df.repartition(tasks_for(rows), *by)
