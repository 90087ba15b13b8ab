"""Packing along a space-filling curve.

Documents are tokenised once.  Each one's token counts, hashed to a fixed
number of buckets, are projected to a few dimensions and placed on a Hilbert
curve; the token ids are range-sorted by that key, and each range is cut into
sequences, so that neighbours on the curve share a sequence.  Ranges hold a
fixed amount of tokens, whatever the input; the last, short sequence of a
range is cut into powers of two, which need no padding.

Python runs per batch inside tasks (tokenising, numpy); Spark sorts and deals.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, materialise, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
BUCKETS, DIMS, BITS = 1024, 4, 12
RANGE_TOKENS = 8_000_000
#: Chunks that a worker remembers, about 200 bytes each.
CACHE = 900_000
_PACKED = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of each row of unsigned integer
    coordinates (rows x dims, each below ``2**bits``, dims * bits < 64)."""
    x = axes.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):  # undo the reflections of each level
        q, p = 1 << level, (1 << level) - 1
        for d in range(dims):
            high = (x[:, d] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, d]) & p)
            x[:, 0] = np.where(high, x[:, 0] ^ p, x[:, 0] ^ swap)
            x[:, d] ^= swap
    for d in range(1, dims):  # Gray code
        x[:, d] ^= x[:, d - 1]
    t = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        t ^= np.where(x[:, dims - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> level) & 1)
    return key


def curve_keys(counts: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors (rows x buckets)."""
    v = np.sqrt(counts)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    y = v @ np.random.RandomState(11).standard_normal((counts.shape[1], DIMS))
    even = 1 / (1 + np.exp(-1.702 * y))  # close to the normal distribution function
    return hilbert(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


#: A full stop or comma that may share a piece with the character before it.
_JOINED = re.compile(r"(?<![a-z0-9\xdf-\xf6\xf8-\xff])[.,][ \n]")


class Encoder:
    """Token ids of texts.

    Where the tokenizer's pieces never cross a blank, texts are cut at blanks
    and the ids of each chunk are remembered.  In Latin-1 texts case is folded
    first and full stops and commas behind letters or digits, which are pieces
    of their own, are cut off, so that fewer chunks are new.  New chunks of
    letters alone are encoded in one go: each is one piece, and its last id
    ends a word.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.cuts = self._ids("a b. c") == self._ids("a") + self._ids("b") + self._ids(".") + self._ids("c")
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        self.ends[[i for w, i in self.tok.get_vocab().items() if w.endswith("</w>")]] = True
        self.folds = self._ids("AÀ") == self._ids("aà")
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.cuts:
            return np.array(self._ids(text), "<u4").tobytes()
        if self.folds and _latin(text):  # there case is folded letter by letter
            text = text.lower()
            if not _JOINED.search(text):
                text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ")
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        new = set(chunks).difference(self.known)
        if new:
            if len(self.known) > CACHE:
                self.known = {}
                new = set(chunks)
            self._learn(new)
        return b"".join(map(self.known.__getitem__, chunks))

    def _learn(self, new: set) -> None:
        letters = [c for c in new if c.isalpha() and _latin(c)]
        if letters and self._learn_letters(letters):
            new = new.difference(letters)
        new = list(new)
        for at in range(0, len(new), 1000):
            part = new[at:at + 1000]
            for c, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                self.known[c] = np.array(e.ids, "<u4").tobytes()

    def _learn_letters(self, letters: list) -> bool:
        e = self.tok.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0]
        ids = np.array(e.ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(ends) != len(letters):
            return False
        raw, at = ids.tobytes(), 0
        for c, end in zip(letters, ends.tolist()):
            self.known[c] = raw[at:end]
            at = end
        return True


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def _encoder(tokenizer_json: str) -> Encoder:
    """One per worker process: what it has learnt serves the next task too."""
    home = sys.modules.setdefault("_allelic_encoders", types.ModuleType("_allelic_encoders"))
    key = "e" + str(zlib.crc32(tokenizer_json.encode()))
    if not hasattr(home, key):
        setattr(home, key, Encoder(tokenizer_json))
    return getattr(home, key)


def _tokenise(tokenizer_json: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        encode, pack = _encoder(tokenizer_json), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = np.zeros((part.num_rows, BUCKETS), np.float32)
                sizes, blobs = [], []
                for row, text in enumerate(part["text"]):
                    raw = encode(text.as_py()) + end
                    arr = np.frombuffer(raw, "<u4")
                    counts[row] = np.bincount((arr * np.uint32(2654435761)) >> np.uint32(22), minlength=BUCKETS)
                    sizes.append(len(arr))
                    # byte planes apart: the high bytes are nearly constant
                    blobs.append(pack.compress(np.frombuffer(raw, "u1").reshape(-1, 4).T.tobytes()))
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(sizes, pa.int64()), pa.array(curve_keys(counts)),
                                                  pa.array(blobs, pa.binary())], ["id", "n", "key", "blob"])
    return run


def _unpack(blob: bytes, n: int) -> np.ndarray:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=4 * n)
    return np.frombuffer(np.frombuffer(raw, "u1").reshape(4, n).T.tobytes(), "<u4")


def powers(n: int) -> list[int]:
    """Powers of two, falling, that sum to n."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _pack(length: int):
    """Rows of one range, sorted, to pieces.  One open sequence is held."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held, fill, seq, part = [], [], 0, 0, 0  # held: (id, start, doc tokens, ids) of the open sequence

        def close(pieces, number):
            offset = 0
            for i, start, total, ids in pieces:
                out.append((i, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset))
                offset += len(ids)

        def flush():
            rows = pd.DataFrame(out, columns=[c.split()[0] for c in _PACKED.split(", ")])
            out.clear()
            return rows

        for f in frames:
            for i, n, blob, part in zip(f["id"], f["n"], f["blob"], f["part"]):
                ids, start = _unpack(blob, n), 0
                while start < n:
                    take = min(n - start, length - fill)
                    held.append((i, start, n, ids[start:start + take]))
                    start, fill = start + take, fill + take
                    if fill == length:
                        close(held, (part << 32) + seq)
                        held, fill, seq = [], 0, seq + 1
                if len(out) > 20_000:
                    yield flush()
        for size in powers(fill):
            piece = []
            while size:
                i, start, total, ids = held.pop(0)
                piece.append((i, start, total, ids[:size]))
                if len(ids) > size:
                    held.insert(0, (i, start + size, total, ids[size:]))
                size -= len(piece[-1][3])
            close(piece, (part << 32) + seq)
            seq += 1
        yield flush()
    return run


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Null and empty texts are the end id alone, so every row has a piece; a
    null id is passed on.  Rows repeated in full are separate documents, with
    equal keys and pieces of their own.  Ties on the curve go by id.  An empty
    table gives an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer or tokenizer_file(), encoding="utf-8") as f:
        model = f.read()  # a fixed file of the driver, sent with the task code
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(model)
    ids = rows.mapInArrow(lambda batches: _tokenise(shared.value, end_id)(batches), "id long, n long, key long, blob binary")
    ids = materialise(spark, ids, "pack_ids")
    tokens = ids.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-tokens // RANGE_TOKENS))
    ranged = (ids.repartitionByRange(ranges, F.col("key"), F.col("id").asc_nulls_first())
              .withColumn("part", F.spark_partition_id().cast("long"))
              .sortWithinPartitions(F.col("key"), F.col("id").asc_nulls_first()))
    return ranged.mapInPandas(_pack(length), _PACKED).withColumnRenamed("id", id_col)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
