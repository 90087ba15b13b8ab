"""Substring dedup by buckets of suffixes at anchors (not bucket-pointer refinement).

A byte goes when a string of ``LENGTH`` bytes that covers it starts anywhere
else.  Sorting every suffix of a corpus costs many times its size, so only
suffixes at anchors are sorted: of the ``LENGTH - Q + 1`` q-grams of each
window of ``LENGTH`` bytes, the one with the smallest hash (leftmost of equal
ones) is its anchor.  The choice depends on the window's bytes alone, so equal
windows have equal anchors, and every window belongs to exactly one.

* Bucket: anchors are dealt by the identifier (hash) of their q-gram.  An
  anchor alone in its bucket owns no repeated window.
* Refinement: the bucket is sorted on the identifier of the anchor's whole
  neighbourhood, all its windows together.  Equal neighbours: every window of
  both is repeated, and one of them stands for all in what follows.
* What is still open, the edges of repeats, is refined window by window: the
  200 bytes of each window of a bucket are compared in full.  A bucket beyond
  ``BUCKET`` members, or hot in a sample, is refined by further sorts on
  identifiers instead (128 bits each), spread over all tasks: first of blocks
  of ``BLOCK`` windows, where equal blocks are repeated whole and blocks whose
  windows share no string with another block's go, then of the windows left.

Python works on Arrow batches and on sorted rows with bounded buffers; Spark
deals and sorts.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, materialise, parallelism, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, Q = 200, 100
#: Most members of a bucket that one task refines in memory.
BUCKET = 2_000
#: Windows of a block, by their distance from the anchor.
BLOCK = 8
#: Documents of the sample that looks for hot buckets, the share of them that
#: makes a bucket hot, and the most hot buckets; they only decide the dealing.
SAMPLE, HOT_SHARE, MOST_HOT = 5_000, 0.01, 1_000
_BASE = 0x9E3779B97F4A7C15
_state: dict = {}


def _powers(length: int):
    if not _state:
        rnd = np.random.RandomState(9)
        _state["values"] = rnd.randint(0, 1 << 32, 256).astype(np.uint64) << np.uint64(32) | rnd.randint(0, 1 << 32, 256).astype(np.uint64)
        _state["up"] = _state["down"] = np.ones(1, np.uint64)
    if len(_state["up"]) < length:
        n = max(length, 1 << 18)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _state[name] = np.cumprod(steps)
    return _state["values"], _state["up"], _state["down"]


def _mix(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def anchors(data: np.ndarray):
    """Of the bytes of one text: anchor positions, first and last start of the
    windows each owns, q-gram identifiers and neighbourhood identifiers."""
    n = len(data)
    values, up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * up[:n], out=sums[1:])
    grams = _mix((sums[Q:] - sums[:-Q]) * down[:n - Q + 1])
    span = LENGTH - Q + 1
    at, width = np.arange(len(grams), dtype=np.int64), 1
    while 2 * width <= span:
        left, right = at[:-width], at[width:]
        at = np.where(grams[left] <= grams[right], left, right)
        width *= 2
    if width < span:
        left, right = at[:len(at) - (span - width)], at[span - width:]
        at = np.where(grams[left] <= grams[right], left, right)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    pos = at[first]
    around = _mix((sums[last + LENGTH] - sums[first]) * down[first] + _mix(
        (pos - first).astype(np.uint64) * np.uint64(1 << 32) + (last - first).astype(np.uint64)))
    return pos, first, last, grams[pos], around


def _pack(pos, first, last):
    return pos << 16 | (pos - last) << 8 | (pos - first)


def _unpack(x):
    pos = x >> 16
    return pos, pos - (x & 255), pos - (x >> 8 & 255)


def _bytes(col: pa.Array) -> Iterator[np.ndarray]:
    for x in col:
        yield np.frombuffer(x.as_buffer(), np.uint8)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, o, id, x) of each anchor: bucket, neighbourhood, place."""
    for batch in batches:
        ids, out, size = batch["id"].to_numpy(), [], 0
        with np.errstate(over="ignore"):
            for i, data in zip(ids, _bytes(batch["raw"])):
                if len(data) < LENGTH:
                    continue
                pos, first, last, g, o = anchors(data)
                out.append((g.view(np.int64), o.view(np.int64), np.full(len(pos), i), _pack(pos, first, last)))
                size += len(pos)
                if size > 100_000:
                    yield _rows(out)
                    out, size = [], 0
        if out:
            yield _rows(out)


def _rows(out) -> pa.RecordBatch:
    """The third and later anchors here with one neighbourhood are known to be
    covered; they get a negative place, and are dealt out freely."""
    g, o, ids, x = (np.concatenate(c) for c in zip(*out))
    order = np.lexsort((o, g))
    same = (g[order][1:] == g[order][:-1]) & (o[order][1:] == o[order][:-1])
    third = order[2:][same[1:] & same[:-1]]
    x[third] = ~x[third]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (g, o, ids, x)], ["g", "o", "id", "x"])


_OPEN = "kind int, g long, id long, x long"
COVERED, OPEN, STAND_IN = 0, 1, 2


def _refine(hot):
    """Of rows sorted by (g, o): neighbourhoods that repeat are covered, the
    others of a bucket with several are open, with one stand-in of each
    repeated neighbourhood.  Batches are cut at buckets; of a bucket that goes
    on, only its last neighbourhood and stand-ins not yet needed are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = [batch[c].to_numpy() for c in ("g", "o", "id", "x")]
            known = rows[3] < 0
            if known.any():
                yield _kinds(COVERED, rows[0][known], rows[2][known], ~rows[3][known])
                rows = [r[~known] for r in rows]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate([a, b]) for a, b in zip(held, rows)]
            g = rows[0]
            cut = int(np.searchsorted(g, g[-1], "left"))
            if cut == 0 and len(g) > 2_000_000 and g[0] == g[-1]:
                # one bucket fills the buffer: repeated neighbourhoods keep two rows, their other
                # rows are covered at once
                o = rows[1]
                head = np.concatenate([[True], o[1:] != o[:-1]])
                second = np.concatenate([[False], head[:-1]]) & ~head
                more = ~head & ~second
                if more.any():
                    yield _kinds(COVERED, *[r[more] for r in (rows[0], rows[2], rows[3])])
                held = [r[~more] for r in rows]
                continue
            held = [r[cut:] for r in rows]
            if cut:
                yield from settle([r[:cut] for r in rows])
        if held is not None:
            yield from settle(held)

    def settle(rows):
        g, o, ids, x = rows
        new_g = np.concatenate([[True], g[1:] != g[:-1]])
        new_o = new_g | np.concatenate([[True], o[1:] != o[:-1]])
        ends = np.concatenate([new_o[1:], [True]])
        single = new_o & ends
        bucket = np.cumsum(new_g) - 1
        several = np.bincount(bucket, new_o) > 1
        open_in = np.bincount(bucket, single) > 0
        if len(hot):
            many = np.isin(g[new_g], hot)
            several, open_in = several | many, open_in | many
        for kind, pick in ((COVERED, ~single), (OPEN, single & several[bucket]),
                           (STAND_IN, new_o & ~single & several[bucket] & open_in[bucket])):
            if pick.any():
                yield _kinds(kind, g[pick], ids[pick], x[pick])
    return run


def _kinds(kind, g, ids, x) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(g), kind, np.int32)), pa.array(g), pa.array(ids), pa.array(x)],
                                      ["kind", "g", "id", "x"])


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array([pack.compress(memoryview(x)) for x in _bytes(batch["raw"])], pa.binary())],
                                         ["id", "z"])


def _loosen(blob: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(blob)


_CONTEXT = "g long, id long, first long, lead int, kind int, bytes binary, far int"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of all windows of each open anchor, ``lead`` + 1 of them."""
    for batch in batches:
        out, size = [], 0
        for i, z, marks in zip(batch["id"].to_pylist(), batch["z"], batch["marks"]):
            text = _loosen(z.as_py())
            for m in marks.as_py():
                pos, first, last = _unpack(m["x"])
                out.append((m["g"], i, first, last - first, m["kind"], text[first:last + LENGTH], pos - first))
                size += 1
            if size > 20_000:
                yield _batch(out, _CONTEXT)
                out, size = [], 0
        if out:
            yield _batch(out, _CONTEXT)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows, schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(cols, types)], list(names))


_FOUND = "id long, a long, b long, k binary, i binary, bytes binary"


def _runs(i, first, hits) -> list:
    """Covered byte ranges of window starts ``first + hit``, hits rising."""
    out, a, b = [], None, None
    for h in hits:
        if a is not None and h == b + 1:
            b = h
            continue
        if a is not None:
            out.append((i, first + a, first + b + LENGTH, None, None, None))
        a = b = h
    if a is not None:
        out.append((i, first + a, first + b + LENGTH, None, None, None))
    return out


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _blocks(member) -> list:
    """Blocks of the windows of one anchor, for the further sorts: identifiers
    of all their bytes and of the bytes that every window of a full block has.
    Stand-ins have no place."""
    i, first, lead, kind, data, far = member
    out, w = [], 0
    while w <= lead:
        low = (far - w) // BLOCK * BLOCK  # least distance from the anchor in this block
        end = min(lead, far - low)
        core = far - low
        out.append((i, first + w if kind == OPEN else -1, -1, _digest(data[w:end + LENGTH]),
                    _digest(data[core:core + LENGTH - BLOCK + 1]), data[w:end + LENGTH]))
        w = end + 1
    return out


def _compare(members) -> list:
    """Covered ranges of the open members of one bucket, by full comparison."""
    seen: dict = {}
    hits = [set() for _ in members]
    for m, (_, _, lead, _, data, _) in enumerate(members):
        for w in range(lead + 1):
            s = data[w:w + LENGTH]
            other = seen.setdefault(s, (m, w))
            if other != (m, w):
                hits[m].add(w)
                hits[other[0]].add(other[1])
    return [r for m, h in zip(members, hits) if h and m[3] == OPEN for r in _runs(m[0], m[1], sorted(h))]


def _resolve(hot):
    """Rows sorted by bucket: covered ranges (b not -1), and blocks of windows
    of buckets too large for one task (b is -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, members, large, out = None, [], False, []
        for batch in batches:
            for g, *member in zip(*(batch[c].to_pylist() for c in ("g", "id", "first", "lead", "kind", "bytes", "far"))):
                if g != bucket:
                    out += _compare(members)
                    bucket, members, large = g, [], g in hot
                if large:
                    out += _blocks(member)
                else:
                    members.append(member)
                    if len(members) > BUCKET:
                        large = True
                        for m in members:
                            out += _blocks(m)
                        members = []
                if len(out) > 50_000:
                    yield _batch(out, _FOUND)
                    out = []
        yield _batch(out + _compare(members), _FOUND)
    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, removed, count, sha, kept = [], [], [], [], []
        for z, spans in zip(batch["z"], batch["spans"].to_pylist()):
            text = _loosen(z.as_py())
            merged: list = []
            for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            parts, at = [], 0
            for a, b in merged:
                parts.append(text[at:a])
                at = b
            rest = b"".join([*parts, text[at:]])
            n.append(len(text))
            removed.append(len(text) - len(rest))
            count.append(len(merged))
            sha.append(hashlib.sha256(rest).hexdigest())
            kept.append([{"a": a, "b": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays([
            batch["id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
            pa.array(sha, pa.string()), pa.array(kept, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def _hot_buckets(raw: DataFrame) -> list[int]:
    """Buckets that hold a share of a sample; at most ``MOST_HOT``."""
    rows = raw.count()
    if not rows:
        return []
    sample = raw.sample(fraction=min(1.0, SAMPLE / rows), seed=3)
    least = max(50, int(HOT_SHARE * min(rows, SAMPLE)))
    counts = (sample.mapInArrow(_scan, "g long, o long, id long, x long").groupBy("g")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))
    return [r.g for r in counts.orderBy(F.desc("n"), "g").limit(MOST_HOT).collect()]


def _deal(hot: list[int], *more: str) -> Column:
    """By bucket; the rows of hot buckets by ``more`` as well."""
    if not hot:
        return F.col("g")
    return F.when(F.col("g").isin(hot), F.xxhash64("g", *more)).otherwise(F.col("g"))


def _late(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    """Covered ranges of the blocks of large buckets: of blocks that repeat
    whole, and of the windows that repeat in blocks with a common core."""
    one = blocks.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "a")).alias("at"),
                                  F.first("i").alias("i"), F.first("bytes").alias("bytes"))
    one = materialise(spark, one, "suffix_blocks")
    whole = (blocks.where("a >= 0").join(one.where("n > 1").select("k"), "k", "left_semi")
             .select("id", "a", (F.col("a") + F.octet_length("bytes")).alias("b")))
    cores = one.groupBy("i").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    starts = F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH)
    windows = (one.join(cores, "i", "left_semi").select("n", "at.id", "at.a", "bytes", F.explode(starts).alias("w"))
               .select("n", "id", "a", "w", F.unhex(F.md5(F.substring("bytes", F.col("w") + 1, F.lit(LENGTH)))).alias("h")))
    windows = materialise(spark, windows, "suffix_late")
    twice = windows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    single = (windows.where("n = 1 and a >= 0").join(twice, "h", "left_semi")
              .select("id", (F.col("a") + F.col("w")).alias("a"), (F.col("a") + F.col("w") + LENGTH).alias("b")))
    return whole.unionByName(single)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256`` of the bytes left, and ``removed``
    (byte ranges, end exclusive).

    Null texts are empty; texts below ``LENGTH`` bytes keep every byte.  Two
    rows repeated in full are each other's copies, so both lose their text.
    Null and repeated ids are told apart by row.  An empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(id_col).cast("long").alias("key"), F.encode(text_of(text_col), "UTF-8").alias("raw"))
    clash = raw.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or key is null")
    if clash.head(1):  # written once, so that the row numbers hold
        raw = materialise(spark, raw.withColumn("id", F.monotonically_increasing_id()), "suffix_rows")
        names = raw.select("id", "key")
    else:
        raw, names = raw.withColumnRenamed("key", "id"), None
    raw = raw.select("id", "raw")
    hot = _hot_buckets(raw)
    parts = parallelism(spark)

    found = raw.mapInArrow(_scan, "g long, o long, id long, x long")
    place = F.when(F.col("x") < 0, F.xxhash64("id", "x")).otherwise(_deal(hot, "o"))
    found = (found.repartition(parts, place).sortWithinPartitions("g", "o")
             .mapInArrow(_refine(np.array(hot, np.int64)), _OPEN))
    found = materialise(spark, found, "suffix_buckets")

    squeezed = raw.mapInArrow(_squeeze, "id long, z binary")
    marks = (found.where(F.col("kind") != COVERED).groupBy("id")
             .agg(F.collect_list(F.struct("g", "x", "kind")).alias("marks")))
    contexts = squeezed.join(marks, "id").select("id", "z", "marks").mapInArrow(_contexts, _CONTEXT)
    resolved = (contexts.repartition(parts, _deal(hot, "id")).sortWithinPartitions("g")
                .mapInArrow(_resolve(frozenset(hot)), _FOUND))
    resolved = materialise(spark, resolved, "suffix_windows")

    late = _late(spark, resolved.where("b = -1"))
    pos = F.shiftright("x", 16)
    whole = found.where(F.col("kind") == COVERED).select(
        "id", (pos - F.col("x").bitwiseAND(255)).alias("a"),
        (pos - F.shiftright("x", 8).bitwiseAND(255) + LENGTH).alias("b"))
    spans = (whole.unionByName(resolved.where("b <> -1").select("id", "a", "b")).unionByName(late)
             .groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    out = squeezed.join(spans, "id", "left").select("id", "z", "spans").mapInArrow(
        _remove, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<a:long,b:long>>")
    if names is not None:
        out = out.join(names, "id").drop("id").withColumnRenamed("key", "id")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).drop("removed")
