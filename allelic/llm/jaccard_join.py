"""N-gram Jaccard join in the metric space of shingle sets.

The distance 1 - J is a metric.  Single shingles are the pivots of the first
level: a document is nearest to the pivots of its own shingles, ties going to
the rarer one, so its home region is its rarest shingle's.  Within distance
``1 - T`` a partner lacks at most ``(1 - T) * size`` of a document's shingles.
That window replicates the document into the regions of its first
``floor((1 - T) * size) + 1`` pivots, and every linked pair meets in the
region of the first shingle that both have.  (Document pivots tell nothing at
this level: nearly all documents are at distance 1.)

How many documents have a shingle is counted exactly.  A shingle of one
document makes no region, and a document in which more than the window are of
that kind links with nothing and leaves; what it alone shared counts anew.

Inside regions documents are pivots: each document is held against the one,
among the most typical documents of its regions, with which it meets most
often, and links close components.  A region within one component is done.  In the
others the pairs across components remain that three windows admit: sizes,
distances to a common pivot (the triangle inequality), and the places of the
region's shingle, which bound what a pair that first meets here can still
share.  Such pairs are few, and each is compared exactly.  A region where more
than ``MOST_HEADS`` documents could head a pair gets further pivots, and if it
stays open and crowded it is not paired but recurses: its documents go on to
the regions of their next shingles, where the same holds.  What is still
crowded after ``MOST_DEPTH`` shingles in common is paired all the same, as far
as the windows admit, so no link is lost.

Shingles are 64-bit hashes: two that clash count as one (among a thousand
million distinct ones with a chance of about 3 percent, and then one shingle
of two documents is off).  Sets are equal by size and a fingerprint of 128 bits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, materialise, text_of
from allelic.llm.components import components
from allelic.llm.shingles import mix, shingle_sets

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Two documents link when ``100 * intersection >= PERCENT * union``.
PERCENT = 75
#: Rows of which a join by key is broadcast; beyond, it shuffles.
BROADCAST_ROWS = 1_000_000
#: Shingles that a task packs at a time, and that give a range of hashes.
BATCH, RANGE = 1_000_000, 2_000_000
#: Documents of one shingle that a range of hashes may gather.
COMMON = 2_000_000
#: A region with more possible heads of a pair gets so many further pivots and
#: recurses, up to so many shingles.  To hold a row against a head takes some
#: 10 ns, to send it on to its next shingles some 100 microseconds.
MOST_HEADS, PIVOTS, MOST_DEPTH = 5000, 16, 3
#: Stands for the number of documents of a common shingle.
MANY = (1 << 31) - 1


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size and 128-bit fingerprint of each text."""
    for batch in batches:
        n, f1, f2 = [], [], []
        with np.errstate(over="ignore"):
            for _, s in shingle_sets(batch["text"]):
                n.append(len(s))
                f1.append(mix(s + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64))
                f2.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch["id"], batch["h1"], batch["h2"], pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                                          pa.array(f2, pa.int64())], ["id", "h1", "h2", "n", "f1", "f2"])


# --- which shingles documents share ------------------------------------------------------
# Entries (document, shingle) travel packed: a row holds those of one range.

_PACKED = "slot long, docs binary, at binary, s binary, df binary"


def _differences(s: np.ndarray) -> bytes:
    """Hashes as differences (modulo 2**64), their bytes by place: of sorted
    ones the high bytes are 0."""
    return np.diff(s, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _hashes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u8").ravel(), dtype=np.uint64)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _rows(slot: np.ndarray, docs: np.ndarray, at: np.ndarray, s: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    """A row for each slot.  ``docs`` has number and set size of documents,
    ``at`` the document of each entry."""
    order = np.argsort(slot, kind="stable")
    cuts = np.flatnonzero(np.diff(slot[order])) + 1
    rows = []
    for some in np.split(order, cuts) if len(order) else ():
        used, local = np.unique(at[some], return_inverse=True)
        rows.append((int(slot[some[0]]), docs[used].tobytes(), local.astype(np.uint32 if len(used) > 1 << 16 else np.uint16).tobytes(),
                     _differences(s[some]), df[some].astype(np.uint32).tobytes() if len(df) else b""))
    cols = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.binary()] * 4))],
                                      ["slot", "docs", "at", "s", "df"])


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, and document, shingle and count of each packed entry."""
    docs, at, s, df, base = [], [], [], [], 0
    for r in table.to_pylist():
        d = np.frombuffer(r["docs"], np.int64).reshape(-1, 2)
        a = np.frombuffer(r["at"], np.uint32 if len(d) > 1 << 16 else np.uint16)
        docs.append(d)
        at.append(a.astype(np.int64) + base)
        s.append(_hashes(r["s"]))
        df.append(np.frombuffer(r["df"], np.uint32))
        base += len(d)
    return tuple(np.concatenate(x) for x in (docs, at, s, df))


def _sets_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    for batch in batches:
        num = batch["num"].to_pylist()
        for row, s in shingle_sets(batch["text"]):
            yield num[row], len(s), s


def _sets_of_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    for batch in batches:
        flat = batch["s"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.cumsum(batch["s"].value_lengths().to_numpy(zero_copy_only=False))
        for k, (num, n) in enumerate(zip(batch["num"].to_pylist(), batch["n"].to_pylist())):
            yield num, n, flat[ends[k - 1] if k else 0:ends[k]]


def _among(s: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, s), len(known) - 1)] == s


def _pack(sets, ranges: int, common, want: bool):
    """Packed entries of the shingles that are common (``want``), by document,
    or of the others, by shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held, size = [], [], 0

        def flush():
            s, at = np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held])
            d = np.array(docs, np.int64)
            if want:
                slot, df = _range_of(mix(d[:, 0].astype(np.uint64)), ranges)[at], np.full(len(s), MANY, np.uint32)
            else:
                order = np.argsort(s)
                s, at = s[order], at[order]
                slot, df = _range_of(s, ranges), np.zeros(0, np.uint32)
            docs.clear()
            held.clear()
            return _rows(slot, d, at, s, df)

        with np.errstate(over="ignore"):
            for num, n, s in sets(batches):
                if len(common.value):
                    s = s[_among(s, common.value) == want]
                docs.append((num, n))
                held.append(s)
                size += len(s)
                if size >= BATCH:
                    yield flush()
                    size = 0
            if held:
                yield flush()
    return run


def _shared(ranges: int):
    """Of a range of shingles the entries whose shingle several documents
    have, with their number, by document."""
    def run(table: pa.Table) -> pa.Table:
        docs, at, s, _ = _entries(table)
        order = np.argsort(s)
        at, s = at[order], s[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        df = np.repeat(np.diff(first, append=len(s)), np.diff(first, append=len(s)))
        keep = df > 1
        at, s, df = at[keep], s[keep], df[keep]
        with np.errstate(over="ignore"):
            slot = _range_of(mix(docs[:, 0].astype(np.uint64)), ranges)[at]
        return pa.Table.from_batches([_rows(slot, docs, at, s, df)])
    return run


def _ordered(percent: int):
    """Of a range of documents those that may link: their shared shingles,
    the rarest first."""
    def run(table: pa.Table) -> pa.Table:
        docs, at, s, df = _entries(table)
        num, n = docs[at, 0], docs[at, 1]
        order = np.lexsort((s, df, num))
        num, n, s, df = num[order], n[order], s[order], df[order]
        first = np.flatnonzero(np.concatenate([[True], num[1:] != num[:-1]])) if len(num) else np.zeros(0, np.int64)
        sizes = np.diff(first, append=len(num))
        may = sizes >= n[first] - (100 - percent) * n[first] // 100
        keep = np.repeat(may, sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes[may])]).astype(np.int32)
        return pa.table({"num": pa.array(num[first][may]), "n": pa.array(n[first][may]),
                         "s": pa.ListArray.from_arrays(pa.array(offsets), pa.array(s[keep].view(np.int64)))})
    return run


_ORDERED = "num long, n long, s array<long>"


def _survivors(rows: DataFrame, sets, entries: int, common, percent: int) -> DataFrame:
    """``num, n, s`` of the documents that may link: their shared shingles,
    those of the fewest documents first."""
    ranges = 1 + entries // RANGE
    packed = rows.mapInArrow(_pack(sets, ranges, common, False), _PACKED)
    shared = packed.groupBy("slot").applyInArrow(_shared(ranges), _PACKED)
    if len(common.value):
        shared = shared.unionByName(rows.mapInArrow(_pack(sets, ranges, common, True), _PACKED))
    return materialise(rows.sparkSession, shared.groupBy("slot").applyInArrow(_ordered(percent), _ORDERED), "join_survivors")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, s in shingle_sets(batch["text"]):
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], ["s"])


def _common(texts: DataFrame, n_docs: int) -> np.ndarray:
    """Shingles that ``COMMON`` documents or more have, by a sample in which
    20 of such would be expected; there are at most ``2 * n_docs / COMMON``
    sets' worth of them.  They only count as frequent and travel apart, so
    no range gathers too much; a wrong guess changes no result."""
    if n_docs <= COMMON:
        return np.zeros(0, np.uint64)
    of = F.pmod(F.xxhash64("num"), F.lit(COMMON)) < 20
    seen = texts.where(of).mapInArrow(_each, "s long").groupBy("s").count().where("count >= 10")
    return np.sort(np.array([r.s for r in seen.select("s").collect()], np.int64).view(np.uint64))


# --- links -----------------------------------------------------------------------------

def _broadcast(rows: DataFrame) -> DataFrame:
    """Broadcast behind a count."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact distances of ``pairs(a, b)``, and which of them link."""
    a = sets.select(F.col("num").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    b = sets.select(F.col("num").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    # the set of the many joins first, so the shared pivot side can be split where it is hot
    rows = pairs.join(b, "b").join(a, "a")
    n = F.size(F.array_intersect("sa", "sb"))
    union = F.col("na") + F.col("nb") - n
    return rows.select("a", "b", (1 - n / union).alias("d"), (100 * n >= percent * union).alias("link"))


class _Labels:
    """Component of each id that is not the smallest of its own, as a table;
    further links are closed among components only."""

    def __init__(self, spark: SparkSession, reps: DataFrame, edges: DataFrame):
        self.spark, self.reps = spark, reps  # num, rep: the id of each document compared
        self.ids = components(spark, edges)

    def of(self, rows: DataFrame, num: str, to: str) -> DataFrame:
        """``rows`` with the component of the documents in ``num``."""
        by = self.reps.join(self.ids, F.col("rep") == F.col("id"), "left").select(
            F.col("num").alias(num), F.coalesce("component", "rep").alias(to))
        return rows.join(by, num)

    def close(self, links: DataFrame) -> None:
        edges = self.of(self.of(links.select("a", "b"), "a", "x"), "b", "y").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = materialise(self.spark, edges.distinct(), "join_closed")
        if not edges.head(1):
            return
        to = components(self.spark, edges).select(F.col("id").alias("component"), F.col("component").alias("to"))
        roots = to.select(F.col("component").alias("id"), F.col("to").alias("component"))  # these had no row
        moved = self.ids.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        self.ids = materialise(self.spark, moved.unionByName(roots.join(moved.select("id"), "id", "left_anti")), "join_labels")


def _head(percent: int):
    """Whether a row can be the smaller set of a pair that first meets here."""
    return F.expr(f"{100 + percent} * (n - miss) >= {2 * percent} * n")


def _mixed(rows: DataFrame, percent: int) -> DataFrame:
    """Of ``rows(key, num, n, miss, c, p, d)`` the regions in which a pair
    across components is possible, with their number of ``heads``."""
    regions = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count_if(_head(percent)).alias("heads"))
    return rows.join(regions.where("lo <> hi and heads > 0").select("key", "heads"), "key")


def _pivots(rows: DataFrame, percent: int) -> DataFrame:
    """Up to ``PIVOTS`` heads of each region, those with the fewest misses of
    as many hash classes."""
    cols = ["num", "n", "miss", "c", "p", "d"]
    of = F.pmod(F.xxhash64("num"), F.lit(PIVOTS))
    least = [F.min(F.when(_head(percent) & (of == k), F.struct("miss", *[c for c in cols if c != "miss"]))).alias(f"h{k}") for k in range(PIVOTS)]
    heads = rows.groupBy("key").agg(*least).select("key", F.explode(F.array(*[f"h{k}" for k in range(PIVOTS)])).alias("h"))
    return heads.where("h is not null").select("key", *[F.col(f"h.{c}").alias(c) for c in cols])


def _admitted(heads: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs across components of a head and a larger set of its region that
    the windows of sizes, places and distances admit.  ``miss`` counts the
    shingles before the region's that a partner met here first has not."""
    t, slack, cols = percent, 1 - percent / 100 + 1e-9, ("num", "n", "miss", "c", "p", "d")
    a = heads.select("key", *[F.col(x).alias(f"{x}_a") for x in cols])
    b = rows.select("key", *[F.col(x).alias(f"{x}_b") for x in cols])
    pairs = a.join(b, "key").where(
        f"""c_a <> c_b and (n_a < n_b or n_a = n_b and num_a < num_b) and 100 * n_a >= {t} * n_b
        and {100 + t} * least(n_a - miss_a, n_b - miss_b) >= {t} * (n_a + n_b)
        and (p_a is null or p_b is null or p_a <> p_b or abs(d_a - d_b) <= {slack!r})""")
    return pairs.select(F.greatest("num_a", "num_b").alias("b"), F.least("num_a", "num_b").alias("a")).distinct()


def _deeper(rows: DataFrame, sets: DataFrame, depth: int, percent: int) -> DataFrame:
    """The rows of regions in those of their documents' next shingles: one at
    place q makes q - depth misses, of which the window allows so many."""
    s = sets.select("num", F.col("s").alias("own"), (F.col("n") - F.size("s")).alias("alone"))
    start = f"cast(miss + {depth} - alone as int)"  # behind the region's own shingle, from 0
    nexts = F.expr(f"slice(own, {start} + 1, cast({100 - percent} * n div 100 - miss + 1 as int))")
    rows = rows.join(s, "num").select("key", "num", "n", "miss", "p", "d", F.posexplode(nexts).alias("i", "next"))
    return rows.select(F.xxhash64("key", "next").alias("key"), "num", "n", (F.col("miss") + F.col("i")).alias("miss"), "p", "d")


def _links(spark: SparkSession, sets: DataFrame, labels_of, percent: int) -> _Labels:
    """Components by the links among ``sets(num, n, s)``."""
    window = f"({100 - percent} * n div 100)"
    entries = sets.select("num", "n", (F.col("n") - F.size("s")).alias("alone"), "s").select(
        "num", "n", "alone", F.posexplode(F.expr(f"slice(s, 1, cast({window} + 1 - alone as int))")).alias("i", "key"))
    entries = entries.select("num", "n", "alone", "key", (F.col("alone") + F.col("i")).alias("miss"))
    entries = materialise(spark, entries, "join_entries")

    # the nearest of the most typical documents of each region
    typical = F.struct((F.lit(1_000_000) * F.col("alone")).cast("long") / F.col("n"), F.col("num").alias("pivot"))
    heads = entries.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min(typical).alias("x")).where("docs > 1").select(
        "key", F.col("x.pivot").alias("pivot"))
    met = entries.join(heads, "key").where("num <> pivot").groupBy("num", "pivot").agg(F.count(F.lit(1)).alias("met"))
    best = met.groupBy("num").agg(F.max(F.struct("met", (-F.col("pivot")).alias("q"))).alias("x"))
    best = materialise(spark, best.select((-F.col("x.q")).alias("a"), F.col("num").alias("b")), "join_nearest")
    known = materialise(spark, _compare(best, sets, percent), "join_known")
    labels = labels_of(known.where("link").select("a", "b"))

    def settle(pairs: DataFrame) -> None:
        nonlocal known
        pairs = pairs.join(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        pairs = materialise(spark, pairs, "join_pairs")
        if pairs.head(1):
            more = materialise(spark, _compare(pairs, sets, percent), "join_known")
            known = known.unionByName(more)
            labels.close(more.where("link"))

    def still_open(rows: DataFrame) -> DataFrame:
        return materialise(spark, _mixed(labels.of(rows.select("key", "num", "n", "miss", "p", "d"), "num", "c"), percent), "join_open")

    # pairs across components, region by region
    at = known.select(F.col("b").alias("num"), F.col("a").alias("p"), "d")
    rows, crowd = entries.join(at, "num", "left"), F.col("heads") > MOST_HEADS
    for depth in range(1, MOST_DEPTH + 1):
        rows = still_open(rows)
        if rows.where(crowd).head(1):  # further pivots first: they close most of a crowd
            crowded = rows.where(crowd)
            settle(_admitted(_pivots(crowded, percent), crowded, percent))
            rows = still_open(rows)
        few = rows if depth == MOST_DEPTH else rows.where(~crowd)
        settle(_admitted(few.where(_head(percent)), few, percent))
        if depth == MOST_DEPTH or not rows.where(crowd).head(1):
            return labels
        rows = materialise(spark, _deeper(still_open(rows.where(crowd)), sets, depth, percent), "join_deeper")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id
    reachable by links, its own included).

    Null, empty and blank texts have no shingles and link with nothing; a text
    of one to four words is one shingle.  Equal sets are one class and are
    compared once.  Rows that repeat an id are one document, with the links of
    each of its texts; rows repeated in full are one.  A row with a null id is
    returned with a null component and links with nothing.  An empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    every = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).select(
        "id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    stats = materialise(spark, every.mapInArrow(_scan, "id long, h1 long, h2 long, n long, f1 long, f2 long"), "join_stats")

    # distinct (id, text) rows, and a numbered class for each distinct set
    distinct = stats.where("n > 0 and id is not null").groupBy("id", "h1", "h2", "n", "f1", "f2").agg(F.count(F.lit(1)).alias("rows"))
    classes = distinct.groupBy("n", "f1", "f2").agg(F.min(F.struct("id", "h1", "h2", "rows")).alias("x"))
    classes = classes.select("n", "f1", "f2", "x.*", F.monotonically_increasing_id().alias("num"))
    classes = materialise(spark, classes, "join_classes")  # numbers hold from here on
    copies = distinct.join(classes.select("n", "f1", "f2", F.col("id").alias("rep")), ["n", "f1", "f2"]).where("id <> rep")
    copies = materialise(spark, copies.select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), "join_copies")

    keys = _broadcast(classes.select("id", "h1", "h2", "num", "rows"))
    texts = every.join(keys, ["id", "h1", "h2"]).select("num", "text", "rows")
    again = classes.where("rows > 1").head(1)
    once = texts.where("rows = 1").select("num", "text")
    texts = once.unionByName(texts.where("rows > 1").groupBy("num").agg(F.first("text").alias("text"))) if again else once
    size = classes.agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c")).first()
    common = spark.sparkContext.broadcast(_common(texts, size["c"]))
    sets = _survivors(texts, _sets_of_texts, size["s"] or 0, common, percent)
    # what only documents that have left shared is no region any more
    left = sets.agg(F.sum(F.size("s"))).first()[0] or 0
    sets = _survivors(sets.select("num", "n", "s"), _sets_of_arrays, left, common, percent)

    reps = materialise(spark, classes.join(sets.select("num"), "num", "left_semi").select("num", F.col("id").alias("rep")), "join_reps")

    def labels_of(links: DataFrame) -> _Labels:
        ends = (links.join(reps.select(F.col("num").alias("a"), F.col("rep").alias("x")), "a")
                .join(reps.select(F.col("num").alias("b"), F.col("rep").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
        return _Labels(spark, reps, ends.unionByName(copies))

    labels = _links(spark, sets, labels_of, percent)
    return stats.join(labels.ids, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir))
