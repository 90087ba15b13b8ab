"""Allele fraction over time, per sample and marker: batch and stream.

Observations of a day add up.  Days are in order; a pause longer than
``max_gap`` days starts a new episode.  Within an episode each day is held
against the lowest and the highest fraction before it: a rise from the lowest
or a fall from the highest by ``step`` or more is an event.

The stream keeps the days of each sample's markers as state, a row for a bucket
of samples, so that its calls do not grow with samples, and gives, for every micro-batch,
the rows that changed, so late rows of any age are put in their place and the
rows behind them are corrected.  The table it writes has a version per row;
``read_tracked`` takes the latest, which equals the batch result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_GAP, STEP = 365, 0.25
#: State rows of the stream, each of a share of the samples.
BUCKETS = 1024
KEY = ["sample_id", "marker"]
OBSERVATION = "sample_id string, marker string, day string, dp long, alt long"
TRACKED = ("sample_id string, marker string, day string, dp long, alt long, fraction double, episode long, days_since long, "
           "change double, lowest double, highest double, event string")


def observations(calls: DataFrame, day: str, marker: str) -> DataFrame:
    """Observations from calls with a column of days (ISO text): depths of the
    reference and of all alternate alleles, from ``allele_depth``.  Calls
    without usable depths are left out."""
    depths = F.transform(F.split("allele_depth", ","), lambda x: x.try_cast("long"))
    rows = calls.select("sample_id", F.col(marker).alias("marker"), F.col(day).alias("day"), depths.alias("d"))
    rows = rows.where((F.size("d") > 1) & ~F.exists("d", lambda x: x.isNull()))
    total = F.aggregate("d", F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select("sample_id", "marker", "day", total.alias("dp"), (total - F.element_at("d", 1)).alias("alt"))


def track(rows: DataFrame, max_gap: int = MAX_GAP, step: float = STEP) -> DataFrame:
    """A row for each series and day: depths, ``fraction``, ``episode`` (from
    1), ``days_since`` and ``change`` since the day before in the series,
    ``lowest`` and ``highest`` before it in its episode, ``event`` (``start``,
    ``rise``, ``fall``, both as ``rise,fall``, or ``none``).

    Days without depth have no fraction and are left out, rows without sample,
    marker or a valid day too.  A series is one window partition: as many rows
    as it has days."""
    valid = F.col("day").try_cast("date")
    days = rows.where(F.col("sample_id").isNotNull() & F.col("marker").isNotNull() & valid.isNotNull()).groupBy(
        *KEY, F.date_format(valid, "yyyy-MM-dd").alias("day")).agg(F.sum("dp").alias("dp"), F.sum("alt").alias("alt")).where("dp > 0")
    days = days.withColumn("fraction", F.col("alt") / F.col("dp")).withColumn("at", F.col("day").cast("date"))
    order = Window.partitionBy(*KEY).orderBy("at")
    days = days.withColumn("days_since", F.datediff("at", F.lag("at").over(order)).cast("long"))
    days = days.withColumn("change", F.col("fraction") - F.lag("fraction").over(order))
    begins = F.when(F.col("days_since").isNull() | (F.col("days_since") > max_gap), 1).otherwise(0)
    days = days.withColumn("episode", F.sum(begins).over(order))
    past = Window.partitionBy(*KEY, "episode").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumns({"lowest": F.min("fraction").over(past), "highest": F.max("fraction").over(past)})
    rise, fall = F.col("fraction") - F.col("lowest") >= step, F.col("highest") - F.col("fraction") >= step
    event = (F.when(F.col("lowest").isNull(), "start").when(rise & fall, "rise,fall").when(rise, "rise").when(fall, "fall").otherwise("none"))
    return days.select(*KEY, "day", "dp", "alt", "fraction", "episode", "days_since", "change", "lowest", "highest", event.alias("event"))


def _tracked(days, max_gap: int, step: float):
    """:func:`track` of some series, for the stream's state: a frame of days
    sorted by series and day."""
    import numpy as np
    days = days[days["dp"] > 0].reset_index(drop=True)
    at = days["day"].to_numpy().astype("datetime64[D]").astype(np.int64)
    first = ((days["sample_id"] != days["sample_id"].shift()) | (days["marker"] != days["marker"].shift())).to_numpy()
    f = days["alt"] / days["dp"]
    since = np.diff(at, prepend=0)
    begins = first | (since > max_gap)
    number = np.cumsum(begins)
    of_series = number[np.flatnonzero(first)][np.cumsum(first) - 1] if len(days) else number
    low, high = (x.shift().mask(begins) for x in (f.groupby(number).cummin(), f.groupby(number).cummax()))
    rise, fall = f - low >= step, high - f >= step
    days["fraction"], days["episode"] = f, number - of_series + 1
    days["days_since"] = days["dp"].astype("Int64").mask(first, None) if not len(days) else _whole(since, first)
    days["change"], days["lowest"], days["highest"] = f.diff().mask(first), low, high
    days["event"] = np.select([begins, rise & fall, rise, fall], ["start", "rise,fall", "rise", "fall"], "none").astype(object)
    return days


def _whole(values, null):
    import pandas as pd
    return pd.arrays.IntegerArray(values, null.copy())


def _update(max_gap: int, step: float):
    """State of a bucket of samples: a version, and the days and depths of
    their markers as a compressed table."""
    def run(key, frames: Iterator, state) -> Iterator:
        import pandas as pd
        import pyarrow as pa
        version, held = state.get if state.exists else (0, None)
        names = [*KEY, "day", "dp", "alt"]
        new = pd.concat(list(frames))[names]
        old = new.iloc[:0] if held is None else pa.ipc.open_stream(pa.py_buffer(bytes(held))).read_pandas()
        days = pd.concat([old, new]).groupby([*KEY, "day"], as_index=False, sort=True)[["dp", "alt"]].sum()
        touched = new[KEY].drop_duplicates()
        before, after = (_tracked(x.merge(touched, on=KEY).sort_values([*KEY, "day"]), max_gap, step) for x in (old, days))
        was = after[[*KEY, "day"]].merge(before, on=[*KEY, "day"], how="left")
        same = was["dp"].notna().to_numpy()
        for c in after.columns[3:]:
            x, y = after[c], was[c]
            same &= ((x == y).fillna(False) | (x.isna() & y.isna())).to_numpy(bool)
        table, out = pa.Table.from_pandas(days, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(table)
        state.update((version + 1, out.getvalue().to_pybytes()))
        if not same.all():
            yield after[~same].assign(version=version + 1)
    return run


def track_stream(spark: SparkSession, source_dir: str, root: str, checkpoint: str, max_gap: int = MAX_GAP, step: float = STEP,
                 max_files_per_trigger: int = 10, buckets: int = BUCKETS):
    """Follow JSON observations under ``source_dir``; changed rows go to
    ``<root>/epoch=<n>``, which a replayed epoch replaces.  Drains what is
    there and stops.  A state row holds the days of a bucket of samples; the
    number of ``buckets`` stays the same for a checkpoint."""
    rows = (spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir))
    valid = F.col("day").try_cast("date")
    rows = rows.where(F.col("sample_id").isNotNull() & F.col("marker").isNotNull() & valid.isNotNull()).select(
        *KEY, F.date_format(valid, "yyyy-MM-dd").alias("day"), F.coalesce("dp", F.lit(0)).alias("dp"), F.coalesce("alt", F.lit(0)).alias("alt"))
    changed = rows.withColumn("bucket", F.pmod(F.xxhash64("sample_id"), F.lit(buckets)).cast("int")).groupBy("bucket").applyInPandasWithState(
        _update(max_gap, step), TRACKED + ", version long",
        "version long, held binary", "update", "NoTimeout")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/epoch={epoch}")

    q = changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def read_tracked(spark: SparkSession, root: str) -> DataFrame:
    """The latest version of each series and day."""
    rows = spark.read.schema(TRACKED + ", version long, epoch long").parquet(root)
    cols = [c.split()[0] for c in TRACKED.split(", ")]
    rest = [c for c in cols if c not in (*KEY, "day")]
    return rows.groupBy(*KEY, "day").agg(F.max_by(F.struct(*rest), "version").alias("x")).select(*KEY, "day", "x.*")
