"""LM scoring by cross-entropy difference.

Two bigram models, of the target documents and of all documents, share one
vocabulary (every word of the corpus), one order and one smoothing.  The
per-token loss difference scores a document: below zero it reads more like
the target than like the corpus.

Documents are dealt into chunks of a bounded size by a hash; texts travel
compressed, a row for the documents of a batch that go to one chunk, in which
rows repeated in full stand once with their number.  A chunk counts its
distinct words and bigrams, and sends the counts to parts of the key space,
where they are summed; each chunk gets the sums of its own keys back and
scores its documents with them.  Tables grow with the corpus, a task holds one
chunk or one part, a frequent word is one entry a chunk, and nothing but the
number of chunks is on the driver.  A chunk has a row for each part that holds
keys of it, so rows are at most the smaller of chunks times parts and of the
distinct keys of all chunks.

Keys are 64-bit hashes of words and of word pairs: two that clash are counted
as one, which among a thousand million keys has a chance of about 5 percent.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Weight of the unigram model in each bigram row, in counts.
PRIOR = 20.0
BROADCAST_IDS = 2_000_000
#: Bytes of text in a chunk; its keys take about as much in a part.
CHUNK_BYTES = 12_000_000
#: Stands for the start of a text; no token has a space.
START = " start"


def tokens(text: str) -> list[str]:
    return text.lower().split()


def _hash(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False)


def _mix(k: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    k = (k ^ (k >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    k = (k ^ (k >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return k ^ (k >> np.uint64(32))


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for the documents of a batch that go to one chunk."""
    import zstandard
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        chunk = batch["chunk"].to_numpy(zero_copy_only=False)
        order = np.argsort(chunk, kind="stable")
        numbers, blobs = [], []
        for some in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1) if len(order) else ():
            rows = batch.take(pa.array(some))
            seen = Counter(zip(rows["id"].to_pylist(), rows["target"].to_pylist(), rows["text"].to_pylist()))
            texts = [t.encode() for _, _, t in seen]
            head = np.array([(i or 0, i is None, target, many, len(t)) for ((i, target, _), many), t in zip(seen.items(), texts)], np.int64)
            numbers.append(int(chunk[some[0]]))
            blobs.append(pack.compress(np.int64(len(head)).tobytes() + head.tobytes() + b"".join(texts)))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "docs"])


class _Docs:
    """The documents of a chunk."""

    def __init__(self, blobs: list[bytes]):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        heads, self.texts = [np.zeros((0, 5), np.int64)], []
        for raw in map(unpack.decompress, blobs):
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            head = np.frombuffer(raw, np.int64, 5 * n, 8).reshape(n, 5)
            at = 8 + 40 * n + np.concatenate([[0], np.cumsum(head[:, 4])])
            self.texts += [raw[x:y].decode() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            heads.append(head)
        head = np.concatenate(heads)
        self.ids, self.null, self.target, self.many = head[:, 0], head[:, 1] == 1, head[:, 2] == 1, head[:, 3]


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, their bytes by place: the high ones are 0."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u8").ravel(), dtype=np.uint64)


class _Chunk:
    """Words and bigrams of some texts, numbered, and the order of their keys."""

    def __init__(self, texts: list[str], many: np.ndarray, n_parts: int):
        index = {START: 0}
        number = index.setdefault
        cur, lengths = [], []
        for t in texts:
            ws = tokens(t)
            lengths.append(len(ws))
            cur.append(np.array([number(w, len(index)) for w in ws], np.int64))
        self.lengths, self.many = np.array(lengths, np.int64), many
        self.cur = np.concatenate(cur) if cur else np.zeros(0, np.int64)
        first = (np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]
        prev = np.roll(self.cur, 1)
        prev[first] = 0
        self.last = self.cur[first + self.lengths[self.lengths > 0] - 1]
        size = self.size = len(index)
        pairs, self.pair = np.unique(prev * size + self.cur, return_inverse=True)
        self.a, self.b = pairs // size, pairs % size
        h = _hash(list(index))
        # the lowest bit parts words from bigrams
        one = np.uint64(1)
        self.keys = np.concatenate([_mix(h) | one, _mix(h[self.a] * np.uint64(0x9E3779B97F4A7C15) + h[self.b]) & ~one])
        # parts are ranges of the upper half of the key
        part = ((self.keys >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)
        self.order = np.argsort(self.keys)
        own, at = np.unique(part[self.order], return_index=True)
        #: place of the keys of each part that has some, in order
        self.parts = {int(p): slice(x, y) for p, x, y in zip(own, at, [*at[1:], len(self.keys)])}

    def counts(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By key: occurrences, and those that end a text (of words), where
        document k counts ``use[k]`` times."""
        w, some = np.repeat(use, self.lengths), use[self.lengths > 0]
        count = lambda x, of, n: np.bincount(x, of, n).astype(np.int64)  # noqa: E731  exact up to 2**53
        ends = np.zeros(len(self.keys), np.int64)
        ends[:self.size] = count(self.last, some, self.size)
        total = np.concatenate([count(self.cur, w, self.size), count(self.pair, w, len(self.a))])
        total[0] += some.sum()  # starts: as many as texts that end
        return total, ends


def _pack(x: np.ndarray) -> bytes:
    """Counts in the narrowest of 1, 4 and 8 bytes."""
    most = x.max(initial=0)
    return x.astype(np.uint8 if most < 1 << 8 else np.uint32 if most < 1 << 32 else np.uint64).tobytes()


def _unpack(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    return np.frombuffer(blob, {1: np.uint8, 4: np.uint32, 8: np.uint64}[len(blob) // n]).astype(np.int64)


_SENT = "part int, chunk int, keys binary, n binary, n_target binary, ends binary, ends_target binary"
_SUMS = "chunk int, part int, n binary, n_target binary, ends binary, ends_target binary"
_STATS = "types long, tokens long, tokens_target long"


def _emit(n_parts: int):
    """A row with the counts of the chunk's keys for each part that has some."""
    def run(table: pa.Table) -> pa.Table:
        docs = _Docs(table["docs"].to_pylist())
        chunk = table["chunk"][0].as_py()
        with np.errstate(over="ignore"):
            c = _Chunk(docs.texts, docs.many, n_parts)
        keys, o = c.keys[c.order], c.order
        (n, ends), (n_target, ends_target) = c.counts(docs.many), c.counts(docs.many * docs.target)
        rows = []
        for p, s in c.parts.items():
            k = keys[s]
            word = (k & np.uint64(1)).astype(bool)
            at = o[s]
            rows.append((p, chunk, _pack_keys(k), _pack(n[at]), _pack(n_target[at]), _pack(ends[at][word]), _pack(ends_target[at][word])))
        names = [x.split()[0] for x in _SENT.split(", ")]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
    return run


class _Part:
    """The keys of a part, and where each chunk's are among them."""

    def __init__(self, table: pa.Table):
        keys = [_unpack_keys(x) for x in table["keys"].to_pylist()]
        self.keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        self.word = (self.keys & np.uint64(1)).astype(bool)
        self.words = [(k & np.uint64(1)).astype(bool) for k in keys]
        self.where = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])

    def total(self, blobs: list[bytes], of_words: bool) -> np.ndarray:
        out = np.zeros(len(self.keys), np.int64)
        for blob, at, w in zip(blobs, self.where, self.words):
            at = at[w] if of_words else at
            out[at] += _unpack(blob, len(at))  # a chunk has a key once
        return out


def _sum(table: pa.Table) -> pa.Table:
    """The sums of a part's keys, for each chunk those it sent."""
    part = _Part(table)
    sums = [part.total(table[c].to_pylist(), "ends" in c) for c in ("n", "n_target", "ends", "ends_target")]
    cols = [table["chunk"].to_pylist(), table["part"].to_pylist(),
            *[[_pack(s[at]) for at in part.where] for s in sums[:2]],
            *[[_pack(s[at[w]]) for at, w in zip(part.where, part.words)] for s in sums[2:]]]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], [x.split()[0] for x in _SUMS.split(", ")])


def _count(table: pa.Table) -> pa.Table:
    """Words of a part, and their occurrences in all texts and in the target's."""
    part = _Part(table)
    real = part.word & (part.keys != (_mix(_hash([START])) | np.uint64(1))[0])
    n = [int(part.total(table[c].to_pylist(), False)[real].sum()) for c in ("n", "n_target")]
    return pa.table({"types": [int(real.sum())], "tokens": [n[0]], "tokens_target": [n[1]]})


_SCORES = "id long, n_tokens long, target_loss double, background_loss double"


def _score(n_parts: int):
    """Losses of a chunk's documents from the sums of its keys: Dirichlet
    smoothing with the unigram model, itself smoothed by one count a word and
    one for all words unseen."""
    def run(table: pa.Table, sums: pa.Table) -> pa.Table:
        docs = _Docs(table["docs"].to_pylist())
        with np.errstate(over="ignore"):
            c = _Chunk(docs.texts, docs.many, n_parts)
        n = {name: np.zeros(len(c.keys), np.int64) for name in ("n", "n_target", "ends", "ends_target")}
        if sorted(sums["part"].to_pylist()) != sorted(c.parts):
            raise ValueError("a chunk needs the sums of each of its parts once")
        for r in sums.select(["part", *n]).to_pylist():
            at = c.order[c.parts[r["part"]]]
            word = at[at < c.size]
            for name, keys in (("n", at), ("n_target", at), ("ends", word), ("ends_target", word)):
                n[name][keys] = _unpack(r[name], len(keys))
        stats = sums.slice(0, 1).to_pylist()[0]
        n_types = stats["types"] + 1
        doc, many, losses = np.repeat(np.arange(len(c.lengths)), c.lengths), np.maximum(c.lengths, 1), []
        for end in ("_target", ""):
            count, ends = n[f"n{end}"], n[f"ends{end}"]
            uni = (count[:c.size] + 1.0) / (stats[f"tokens{end}"] + n_types)
            rows = count[:c.size] - ends[:c.size]
            p = (count[c.size:] + PRIOR * uni[c.b]) / (rows[c.a] + PRIOR)
            x = np.bincount(doc, -np.log(p)[c.pair], len(c.lengths)) / many
            x[c.lengths == 0] = np.nan
            losses.append(x)
        each = np.repeat(np.arange(len(docs.ids)), docs.many)
        return pa.table({"id": pa.array(docs.ids[each], mask=docs.null[each]), "n_tokens": pa.array(c.lengths[each]),
                         "target_loss": pa.array(losses[0][each]), "background_loss": pa.array(losses[1][each])})
    return run


def score_documents(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``target_loss``,
    ``background_loss`` (nats a token) and ``score``, their difference.

    ``target_ids`` has the target documents' ids in its first column; nulls
    and ids without a document are ignored, repeated ids count once.  Without
    target documents that model is its uniform prior.  Null, empty and blank
    texts have no tokens and null losses.  Rows repeated in full count and are
    scored each.  An empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("id")).where("id is not null").distinct()
    ids = ids.withColumn("target", F.lit(True))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    n = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // CHUNK_BYTES
    # by content, so that a task that runs again deals alike
    dealt = texts.join(ids, "id", "left").select("id", "text", F.coalesce("target", F.lit(False)).alias("target"),
                                                 F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int").alias("chunk"))
    chunks = dealt.mapInArrow(_deal, "chunk int, docs binary").repartitionById(n, "chunk")
    sent = chunks.groupBy("chunk").applyInArrow(_emit(n), _SENT).repartitionById(n, "part")
    stats = sent.groupBy("part").applyInArrow(_count, _STATS).agg(
        *[F.sum(c).alias(c) for c in ("types", "tokens", "tokens_target")]).withColumn("all", F.lit(0))
    sums = sent.groupBy("part").applyInArrow(_sum, _SUMS).repartitionById(n, "chunk").withColumn("all", F.lit(0))
    sums = sums.join(F.broadcast(stats), "all").drop("all")  # one row
    out = chunks.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(_score(n), _SCORES)
    loss = lambda c: F.round(F.when(F.col("n_tokens") > 0, F.col(c)), 6)
    return out.select(F.col("id").alias(id_col), "n_tokens", loss("target_loss").alias("target_loss"),
                      loss("background_loss").alias("background_loss"),
                      F.round(loss("target_loss") - loss("background_loss"), 6).alias("score"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_documents(documents(spark, sf_dir), labels.where("quality = 1").select("doc_id"))
