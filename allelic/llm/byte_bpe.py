"""Byte-level BPE: texts to token ids and back.

A text is cut by a pattern into pieces; each piece is merged by itself.  New
pieces of a batch are laid into padded matrices by length, a piece a row.  In
each round every row merges its leftmost pair of minimum rank: ranks of pairs
come from a hash table of all pairs that merge, the merged cell is squeezed
out of its row, and rows without a pair left leave the matrix.  A piece longer
than ``LONG`` bytes is a matrix of its own; there a round also takes further
places of the same rank for as long as no merge so far has made a lower one,
which is the order of single merges in fewer rounds.

Work is a map over documents, with no shuffle: Spark deals the batches, numpy
merges, and a worker remembers the ids of short pieces (``CACHE`` of them).
"""

from __future__ import annotations

import base64
import re
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Remembered pieces a worker, of at most ``SHORT`` characters each.
CACHE, SHORT = 600_000, 64
#: Bytes of a piece from which it is merged by itself; cells of a matrix.
LONG, CELLS = 512, 1 << 19
#: Bytes of text or ids that are worked on at a time.
SLICE = 1 << 20
_NONE = np.int32(np.iinfo(np.int32).max)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of each pair of tokens that merges: open addressing over the
    multiplied key ``left * size + right``."""

    def __init__(self, ranks: dict[bytes, int], size: int):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    values.append(rank)
        self.size = size
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slot[rest]] == -1]
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            placed = self.keys[slot[rest]] == keys[rest]
            self.values[slot[rest[placed]]] = values[rest[placed]]
            rest = rest[~placed]
            slot[rest] = (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge or a cell is
        padding (negative)."""
        shape = left.shape
        keys = left.astype(np.int64).ravel() * self.size + right.ravel()
        pad = (left.ravel() < 0) | (right.ravel() < 0)
        out = np.full(len(keys), _NONE, np.int32)
        rest = np.flatnonzero(~pad)
        slot = self._slot(keys[rest])
        while len(rest):
            there = self.keys[slot]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            on = ~hit & (there != -1)
            rest, slot = rest[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)


class Codec:
    """Ids of texts by a rank file, and the bytes of ids."""

    def __init__(self, rank_file: bytes, pattern: str, unknown: str = ""):
        import regex
        self.token_ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        size = 1 + max(self.token_ids.values())
        self.tokens = [b""] * size
        for token, i in self.token_ids.items():
            self.tokens[i] = token
        self.first = np.array([self.token_ids[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.token_ids, size)
        self.cut = regex.compile(pattern).findall
        # both libraries agree on texts without letters that only one of them knows
        self.odd = re.compile(f"[{unknown}]").search if unknown else lambda text: None
        apart = pattern
        for name in (r"\p{L}", r"\p{N}"):
            apart = apart.replace(name, f"[{name}--[{unknown}]]")
        self.cut_odd = regex.compile(apart, regex.V1).findall if unknown else self.cut
        # in ASCII the classes are ranges, which the plain library cuts faster
        plain = pattern
        for name, chars in ((r"\p{L}", "A-Za-z"), (r"\p{N}", "0-9")):
            plain = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(name, chars), plain).replace(name, f"[{chars}]")
        self.cut_ascii = re.compile(plain, re.ASCII).findall if r"\p" not in plain else self.cut
        self.known: dict[str, bytes] = {}

    def cut_text(self, text: str) -> list[str]:
        if text.isascii():
            return self.cut_ascii(text)
        return (self.cut_odd if self.odd(text) else self.cut)(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        if len(self.known) > CACHE:
            self.known = {}
        cut, new = [self.cut_text(t) for t in texts], set()
        for pieces in cut:
            new.update(pieces)
        new = list(new.difference(self.known))
        known, long = self.known, {}
        for p, ids in zip(new, self._merge([p.encode() for p in new])):
            (known if len(p) <= SHORT else long)[p] = ids
        find = (lambda p: known.get(p) or long[p]) if long else known.__getitem__
        return [b"".join(map(find, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece.  A piece that is a token is that token."""
        out: list[bytes] = [b""] * len(pieces)
        open_rows = []
        for k, p in enumerate(pieces):
            i = self.token_ids.get(p)
            if i is not None:
                out[k] = i.to_bytes(4, "little")
            else:
                open_rows.append(k)
        open_rows.sort(key=lambda k: len(pieces[k]))
        at = 0
        while at < len(open_rows):
            width = 1 << (len(pieces[open_rows[at]]) - 1).bit_length()
            to = at
            while to < len(open_rows) and len(pieces[open_rows[to]]) <= width and (to - at + 1) * width <= max(CELLS, width):
                to += 1
            rows = open_rows[at:to]
            if width > LONG:
                for k in rows:
                    out[k] = self._merge_long(pieces[k])
            else:
                for k, ids in zip(rows, self._merge_rows([pieces[k] for k in rows])):
                    out[k] = ids
            at = to
        return out

    def _merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        size = np.array([len(p) for p in pieces])
        width = int(size.max())
        cells = np.full((len(pieces), width), -1, np.int32)
        cells[np.arange(width) < size[:, None]] = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs.ranks(cells[:, :-1], cells[:, 1:])
        row, out = np.arange(len(pieces)), [b""] * len(pieces)
        while len(row):
            width = cells.shape[1]
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(row), np.int64)
            least = ranks[np.arange(len(row)), at] if width > 1 else np.full(len(row), _NONE)
            on = least != _NONE
            if not on.all():
                done = np.flatnonzero(~on)
                filled = (cells[done] >= 0).sum(axis=1)
                flat = cells[done].astype("<u4")
                for k, ids, n in zip(row[done].tolist(), flat, filled.tolist()):
                    out[k] = ids[:n].tobytes()
                cells, ranks, row, at, least = cells[on], ranks[on], row[on], at[on], least[on]
                if not len(row):
                    break
            r = np.arange(len(row))
            cells[r, at] = least
            keep = np.ones(cells.shape, bool)
            keep[r, at + 1] = False
            cells = cells[keep].reshape(len(row), width - 1)
            keep = np.ones(ranks.shape, bool)
            keep[r, at] = False
            ranks = ranks[keep].reshape(len(row), width - 2)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.ranks(cells[left, at[left] - 1], least[left])
            right = np.flatnonzero(at < width - 2)
            ranks[right, at[right]] = self.pairs.ranks(least[right], cells[right, at[right] + 1])
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        ids = self.first[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.ranks(ids[:-1], ids[1:])
        while len(ranks):
            least = ranks.min()
            if least == _NONE:
                break
            at = np.flatnonzero(ranks == least)
            # of overlapping places every other one, from the left
            head = np.ones(len(at), bool)
            head[1:] = at[1:] != at[:-1] + 1
            start = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
            # neighbours at the time of each merge: those to the left are merged, to the right not yet
            padded = np.concatenate([[-1], ids, [-1]])
            before = padded[at].copy()
            before[1:][at[1:] == at[:-1] + 2] = least
            after = padded[at + 3]
            merged = np.full(len(at), least, np.int32)
            lower = np.flatnonzero((self.pairs.ranks(before, merged) < least) | (self.pairs.ranks(merged, after) < least))
            if len(lower):
                at = at[:lower[0] + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids[at] = least
            ids = ids[keep]
            keep = np.ones(len(ranks), bool)
            keep[at] = False
            ranks = ranks[keep]
            now = at - np.arange(len(at))
            for pair in (now[now > 0] - 1, now[now < len(ids) - 1]):
                ranks[pair] = self.pairs.ranks(ids[pair], ids[pair + 1])
        return ids.astype("<u4").tobytes()


def unknown_letters(pattern: str) -> str:
    """Letters and digits that the ``regex`` library knows and ``tiktoken``,
    built on an older Unicode, does not, as the inside of a character class.

    Those newer than Python's own tables are tried out: in a vocabulary that
    joins a last byte to "a" and to "1", one token more or less tells whether
    the pattern keeps the two together.
    """
    import regex
    import tiktoken
    new = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"]
    new = regex.findall(r"[\p{L}\p{N}]", "".join(new))
    ranks = {bytes([b]): b for b in range(256)}
    for last in range(0x80, 0xC0):
        for other in b"a1":
            ranks[bytes([last, other])] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = [c for c in new if len(probe.encode_ordinary(f"{c}a")) > len(c.encode()) and len(probe.encode_ordinary(f"{c}1")) > len(c.encode())]
    code = np.array([ord(c) for c in out])
    runs = np.split(code, np.flatnonzero(np.diff(code) > 1) + 1) if out else []
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


def _codec(rank_file: bytes, pattern: str, unknown: str) -> Codec:
    """One per worker process: what it has learnt serves the next task too."""
    home = sys.modules.setdefault("_allelic_codecs", types.ModuleType("_allelic_codecs"))
    key = f"c{zlib.crc32(rank_file)}_{zlib.crc32((pattern + unknown).encode())}"
    if not hasattr(home, key):
        setattr(home, key, Codec(rank_file, pattern, unknown))
    return getattr(home, key)


def _slices(batch: pa.RecordBatch, col: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SLICE`` bytes of ``col``, of one row at least."""
    ends = np.cumsum(pc.binary_length(batch[col]).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        yield batch.slice(at, to - at)
        at = to


class _Model:
    """What the tasks need; the rank file and the pattern go out once."""

    def __init__(self, spark: SparkSession, ranks: str | None, pattern: str | None):
        import public_tokenizers
        with open(ranks or public_tokenizers.path(RANKS), "rb") as f:
            rank_file = f.read()  # a fixed file of the driver, sent with the task code
        pattern = pattern or public_tokenizers.PATTERN
        self.shared = spark.sparkContext.broadcast((rank_file, pattern, unknown_letters(pattern)))


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value)
        for batch in batches:
            for part in _slices(batch, "text"):
                ids = codec.encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["id"], pa.array([len(x) // 4 for x in ids], pa.int64()),
                                                  pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])
    return run


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value)
        for batch in batches:
            for part in _slices(batch, "ids"):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(map(codec.decode, part["ids"].to_pylist()), pa.binary())],
                                                 [*part.schema.names, "bytes"])
    return run


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """One row per input row: id, ``n_tokens`` and ``ids`` (binary, 32-bit
    little-endian), as the tiktoken library encodes ordinary text.

    Null and empty texts have no tokens; a null id is passed on.  Texts are
    encoded whole, also those without a place to cut.  Rows repeated in full
    are encoded each.  Strings that look like special tokens are text.  An
    empty table gives an empty result; other columns are ignored.
    """
    model = _Model(docs.sparkSession, ranks, pattern)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_encode(model.shared), "id long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, ids_col: str = "ids", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` with the ``bytes`` of its ids (binary) as a last column;
    null ids have no bytes, an id outside the vocabulary is an error."""
    if "bytes" in encoded.columns:
        raise ValueError("the column bytes is the result's")
    model = _Model(encoded.sparkSession, ranks, pattern)
    rows = encoded.withColumn(ids_col, F.coalesce(F.col(ids_col), F.lit(b"")))
    if ids_col != "ids":
        rows = rows.withColumnRenamed(ids_col, "ids")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", bytes binary"
    out = rows.mapInArrow(_decode(model.shared), schema)
    return out if ids_col == "ids" else out.withColumnRenamed("ids", ids_col)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode_documents(encode_documents(documents(spark, sf_dir)))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
