"""Principal components of genotypes by randomised subspace iteration.

The matrix of samples by sites is only ever its called entries, standardised
by allele frequency (entries without a call are 0, the mean).  Samples and
sites are dealt to bins and numbered there; entries are packed by pairs of
bins, tall tables (a few columns a sample or site) by bin.  A product goes by
blocks, a slice of the samples' bins with a slice of the sites': the entries
stay where they are, each block gets its slice of the tall table and sends the
sums of its rows.  So what is moved follows samples and sites times the slices
of the other side, not entries.  Columns are made orthonormal by the Gram
matrix (tall-skinny QR).  The driver sees such squares of the few columns, one
a bin, and nothing that grows with samples or sites.  Between rounds one such
step keeps the columns apart; the last ones are made orthonormal to rounding.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from allelic.functions.genotype import dosage, is_called, optional_eq
from allelic.operators.frequency import SITE_KEY
from allelic.plans.joins import MAX_BROADCAST_ROWS
from allelic.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS, OVERSAMPLING = 5, 8
#: Bins of a side, and the least slices of them.
BINS, SLICES = 64, 2
_TALL, _TALL_SCHEMA = "bin int, x binary", pa.schema([("bin", pa.int32()), ("x", pa.binary())])


def _write(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bin(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BINS)).cast("int")


def _by_site(calls: DataFrame, contig: str | None, min_minor: int, normalise: bool) -> DataFrame:
    """``standardised`` with ``site_bin`` and ``site_n``, the number of the
    site in its bin; all by one shuffle."""
    df = calls.where(optional_eq("reference_name", contig) & is_called(normalise=normalise))
    df = df.select("sample_id", F.concat_ws(":", *SITE_KEY).alias("site"), dosage(normalise=normalise).cast("double").alias("g"))
    df = df.withColumn("site_bin", _bin("site")).repartition("site_bin").groupBy("site_bin", "site", "sample_id").agg(F.max("g").alias("g"))
    site = Window.partitionBy("site_bin", "site")
    df = df.withColumns({"ac": F.sum("g").over(site), "an": 2 * F.count(F.lit(1)).over(site)})
    df = df.where(F.least(F.col("ac"), F.col("an") - F.col("ac")) >= min_minor).withColumn("p", F.col("ac") / F.col("an"))
    z = (F.col("g") - 2 * F.col("p")) / F.sqrt(2 * F.col("p") * (1 - F.col("p")))
    number = F.dense_rank().over(Window.partitionBy("site_bin").orderBy("site")) - 1
    return df.select("sample_id", "site", z.alias("z"), "site_bin", number.alias("site_n"))


def standardised(calls: DataFrame, contig: str | None = None, min_minor: int = 1, normalise: bool = False) -> DataFrame:
    """``sample_id, site, z`` of each called genotype at sites with
    ``min_minor`` minor alleles or more: (g - 2p) / sqrt(2p(1 - p)).  A sample
    called twice at a site counts with its largest dosage."""
    return _by_site(calls, contig, min_minor, normalise).select("sample_id", "site", "z")


def _keys(entries: DataFrame, key: str) -> DataFrame:
    """``bin, n, key``: the distinct keys, numbered in their bins from 0."""
    rows = entries.select(key).distinct().withColumn("bin", _bin(key))
    return rows.select("bin", (F.row_number().over(Window.partitionBy("bin").orderBy(key)) - 1).alias("n"), key)


def _pack_entries(table: pa.Table) -> pa.Table:
    """The entries of a pair of bins as a row."""
    raw = lambda c, t: pa.array([table[c].to_numpy().astype(t).tobytes()])
    return pa.Table.from_arrays([table["sample_bin"].combine_chunks()[:1], table["site_bin"].combine_chunks()[:1],
                                 raw("sample_n", np.int32), raw("site_n", np.int32), raw("z", np.float64)],
                                ["sample_bin", "site_bin", "sample_n", "site_n", "z"])


def _pack_columns(k: int):
    """The rows of a bin's numbers and columns as a row of the tall table."""
    def run(table: pa.Table) -> pa.Table:
        x = np.zeros((k, table.num_rows))
        at = table["n"].to_numpy()
        for j in range(k):
            x[j, at] = table[f"q{j}"].to_numpy()
        return pa.Table.from_arrays([table["bin"].combine_chunks()[:1], pa.array([x.tobytes()])], ["bin", "x"])
    return run


def _read(k: int, x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), np.float64).reshape(k, -1)


def _tall_row(b: int, x: np.ndarray) -> pa.RecordBatch:
    """A row of the tall table on the memory of its columns."""
    ends = np.array([0, x.nbytes], np.int32)
    return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(ends), pa.py_buffer(x)])], schema=_TALL_SCHEMA)


def _block(k: int, by: str, to: str, sizes: dict[int, int], turn: np.ndarray | None, without: int | None):
    """Sums of a block: a row for each of its bins of the side ``to``.  The
    tall table is turned by a small matrix; the first row of the bin
    ``without`` stays out."""
    def run(entries: pa.Table, tall: pa.Table) -> pa.Table:
        of, sums = {}, {}
        for b, x in zip(tall["bin"].to_pylist(), tall["x"]):
            of[b] = turn.T @ _read(k, x) if turn is not None else _read(k, x).copy()
            if b == without:
                of[b][:, 0] = 0.0
        for batch in entries.to_batches():
            for n, (b, t) in enumerate(zip(batch[f"{by}_bin"].to_pylist(), batch[f"{to}_bin"].to_pylist())):
                i, j = (np.frombuffer(batch[f"{s}_n"][n].as_buffer(), np.int32) for s in (by, to))
                z, size = np.frombuffer(batch["z"][n].as_buffer(), np.float64), sizes[t]
                if t not in sums:
                    sums[t] = np.zeros((k, size))
                for q in range(k):
                    sums[t][q] += np.bincount(j, weights=z * of[b][q][i], minlength=size)
        of.clear()
        rows = [_tall_row(b, x) for b, x in sums.items()]
        return pa.Table.from_batches(rows, _TALL_SCHEMA)
    return run


def _add(table: pa.Table) -> pa.Table:
    """The sum of a bin's rows."""
    total = np.frombuffer(table["x"][0].as_buffer(), np.float64).copy()
    for x in table["x"][1:]:
        total += np.frombuffer(x.as_buffer(), np.float64)
    return pa.Table.from_arrays([table["bin"].combine_chunks()[:1], pa.array([total.tobytes()])], ["bin", "x"])


class _Matrix:
    """The entries, dealt by block once, and their products."""

    def __init__(self, spark: SparkSession, entries: DataFrame, k: int):
        self.spark, self.k = spark, k
        self.keys = {s: _write(spark, _keys(entries, key), f"pca_{s}") for s, key in (("sample", "sample_id"), ("site", "site"))}
        #: rows of each bin: ``BINS`` numbers a side
        self.sizes = {s: {r.bin: r.n for r in df.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()} for s, df in self.keys.items()}
        self.slices = {s: min(BINS, max(SLICES, -(-sum(n.values()) // (2 * MAX_BROADCAST_ROWS or 1)))) for s, n in self.sizes.items()}
        # a null sample counts as one where sums go to samples, and is none where they come from there
        self.without = next((r.bin for r in self.keys["sample"].where("sample_id IS NULL").collect()), None)
        e = entries.select("sample_id", "site_bin", "site_n", "z", _bin("sample_id").alias("sample_bin")).repartition("sample_bin")
        e = e.withColumn("sample_n", F.dense_rank().over(Window.partitionBy("sample_bin").orderBy("sample_id")) - 1).drop("sample_id")
        packed = e.groupBy("sample_bin", "site_bin").applyInArrow(_pack_entries, "sample_bin int, site_bin int, sample_n binary, site_n binary, z binary")
        packed = _write(spark, packed, "pca_packed")
        block = self._slice("sample", F.col("sample_bin")) * self.slices["site"] + self._slice("site", F.col("site_bin"))
        parts = min(4 * self.slices["sample"] * self.slices["site"], max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        self.blocks = packed.withColumn("block", block.cast("int")).repartition(parts, "block").sortWithinPartitions("block").persist(StorageLevel.DISK_ONLY)

    def _slice(self, side: str, b):
        return F.floor(b * self.slices[side] / BINS)

    def times(self, tall: DataFrame, by: str, to: str, turn: np.ndarray | None) -> DataFrame:
        """The tall table of the side ``to``: each block's part of the side
        ``by`` is sent to it, and the sums of the blocks are added by bin."""
        own, other = self._slice(by, F.col("bin")), F.col("other")
        block = own * self.slices["site"] + other if by == "sample" else other * self.slices["site"] + own
        sent = tall.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(self.slices[to] - 1)))).select(block.cast("int").alias("block"), "bin", "x")
        without = self.without if by == "sample" else None
        part = self.blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_block(self.k, by, to, self.sizes[to], turn, without), _TALL)
        return _write(self.spark, part.groupBy("bin").applyInArrow(_add, _TALL), "pca_tall")


def _total(tall: DataFrame, k: int, value: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over bins of a few numbers of each bin's columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch["x"]:
                yield pa.RecordBatch.from_arrays([pa.array([value(_read(k, x)).ravel().tolist()])], ["v"])
    return sum((np.array(r.v) for r in tall.mapInArrow(run, "v array<double>").collect()), np.zeros(size))


def _gram(tall: DataFrame, k: int, turn: np.ndarray | None = None) -> np.ndarray:
    def square(x: np.ndarray) -> np.ndarray:
        x = x if turn is None else turn.T @ x
        return x @ x.T
    return _total(tall, k, square, k * k).reshape(k, k)


def _orthonormal(tall: DataFrame, k: int, steps: int = 1) -> np.ndarray:
    """What turns the columns to orthonormal ones of the same span;
    directions that vanish are 0."""
    turn = np.eye(k)
    for _ in range(steps):
        values, vectors = np.linalg.eigh(_gram(tall, k, turn))
        keep = values > 1e-12 * max(values.max(), 1e-300)
        turn = turn @ (vectors * np.where(keep, 1 / np.sqrt(np.where(keep, values, 1.0)), 0.0))
    return turn


def _rows(k: int, turn: np.ndarray):
    """A row for each number of a bin, with the turned columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, x in zip(batch["bin"].to_pylist(), batch["x"]):
                x = turn.T @ _read(k, x)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(x.shape[1], b, np.int32)), pa.array(np.arange(x.shape[1], dtype=np.int32)), *map(pa.array, x)],
                                                 ["bin", "n", *[f"pc{j + 1}" for j in range(len(x))]])
    return run


def genotype_pca(calls: DataFrame, components: int = 4, contig: str | None = None, min_minor: int = 1,
                 rounds: int = ROUNDS, oversampling: int = OVERSAMPLING, normalise: bool = False) -> DataFrame:
    """``sample_id, pc1, pc2, ...``: scores (left singular vectors times
    singular values) of the standardised genotypes, the strongest first.

    Each component's sign is such that its scores' cubes sum to 0 or more.
    Samples without a call at a site that varies are left out; components
    beyond the rank are 0.  The start vectors are hashes of site names, so
    runs agree."""
    spark = calls.sparkSession
    k = components + oversampling
    a = _Matrix(spark, _write(spark, _by_site(calls, contig, min_minor, normalise), "pca_entries"), k)
    unit = lambda j: F.xxhash64("site", F.lit(j)) / float(1 << 63)  # noqa: E731  between -1 and 1
    start = a.keys["site"].select("bin", "n", *[unit(j).alias(f"q{j}") for j in range(k)]).groupBy("bin").applyInArrow(_pack_columns(k), _TALL)
    y = a.times(start, "site", "sample", None)
    turn = _orthonormal(y, k)
    for n in range(rounds):
        w = a.times(y, "sample", "site", turn)
        y = a.times(w, "site", "sample", _orthonormal(w, k))
        turn = _orthonormal(y, k, 2 if n == rounds - 1 else 1)
    # the projection's small square gives singular values and the turn of the columns
    values, vectors = np.linalg.eigh(_gram(a.times(y, "sample", "site", turn), k))
    a.blocks.unpersist()
    order = np.argsort(values)[::-1][:components]
    turn = turn @ (vectors[:, order] * np.sqrt(np.maximum(values[order], 0)))
    cubes = _total(y, k, lambda x: ((turn.T @ x) ** 3).sum(axis=1), components)
    turn = turn * np.where(cubes < 0, -1.0, 1.0)
    names = [f"pc{j + 1}" for j in range(components)]
    scores = y.mapInArrow(_rows(k, turn), ", ".join(["bin int", "n int", *[f"{c} double" for c in names]]))
    return _write(spark, scores.join(a.keys["sample"], ["bin", "n"]).select("sample_id", *names), "pca_scores")
