"""Spelling variants by reduced-alphabet generation.

Words are reduced: each letter is hashed to one of a few symbols.  Of each
reduced word its full neighbourhood is generated: itself and all words one
deleted, replaced or inserted symbol away.  Two words one edit apart reduce to
the same or to neighbouring words, so joining neighbourhoods with the reduced
vocabulary finds every pair; the original words decide.

Reduced words travel as 64-bit keys, and a bitmap of the reduced vocabulary
(of bounded size, see ``bitmap``) drops most neighbours in the task that makes
them.  Equal keys only propose, so a clash or a wrong "perhaps" of the bitmap
costs a comparison.  The number of symbols follows the vocabulary, so that
chance alone gives a word about one wrong candidate: more words, more symbols,
and buckets of the join stay small.
"""

from __future__ import annotations

import re
import string
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm import bitmap
from allelic.llm.common import documents, materialise, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
#: A run loses a letter where this divides its hash.
NOISE = 31
LEAST_SYMBOLS, MOST_SYMBOLS = 4, 64
#: Distinct words that a task counts at a time; cells of a matrix of neighbours.
TYPES, CELLS = 400_000, 1 << 20
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def symbols_for(n_words: int, chars: int = MIN_CHARS) -> int:
    """The fewest symbols for which a reduced word of ``chars`` symbols has
    about one wrong partner in its neighbourhood of some 2 * chars * symbols."""
    size = LEAST_SYMBOLS
    while size < MOST_SYMBOLS and size ** (chars - 1) < 2 * chars * n_words:
        size += 1
    return size


def _count(min_chars: int, noise: int | None):
    find = re.compile(rf"[a-zÀ-ÿ]{{{min_chars},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], ["word", "n"])
            c.clear()
            return out

        for batch in batches:
            for i, text in zip(batch["id"].to_pylist(), batch["text"]):
                runs = find(text.as_buffer().to_pybytes().translate(_LOWER).decode())
                if noise:
                    start = zlib.crc32(f"{'' if i is None else i}:".encode())
                    hashes = [zlib.crc32(w.encode(), start) for w in runs]
                    for k in [k for k, h in enumerate(hashes) if h % noise == 0]:
                        w = runs[k]
                        at = hashes[k] % len(w)
                        runs[k] = w[:at] + w[at + 1:]
                c.update(runs)
                if len(c) > TYPES:
                    yield flush()
        yield flush()
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, noise: int | None = None) -> DataFrame:
    """``word, n`` of each run of letters (``A-Z`` lower-cased, Latin-1 letters
    as they are) of ``min_chars`` or more that occurs ``min_count`` times.

    With ``noise``, a run whose hash with its document's id it divides loses
    one letter before it is counted; a null id counts as empty there.  Null
    and empty texts have no words; rows repeated in full count each.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    counts = rows.mapInArrow(_count(min_chars, noise), "word string, n long").where(F.char_length("word") >= min_chars)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _reduced(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length, and their letters as symbols from 1."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        n = int(lengths[rows[0]])
        for at in range(0, len(rows), max(1, CELLS // max(1, n * symbols))):
            some = rows[at:at + max(1, CELLS // max(1, n * symbols))]
            code = np.frombuffer("".join([words[r] for r in some]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), n)
            yield some, bitmap.mix(code.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _neighbourhood(s: np.ndarray, symbols: int) -> Iterator[np.ndarray]:
    """Keys (rows x some) of the reduced words ``s`` and of all their
    neighbours, a block of places at a time; a key may repeat."""
    rows, n = s.shape
    power, every = _powers(n + 1), np.arange(1, symbols + 1, dtype=np.uint64)
    before = np.zeros((rows, n + 1), np.uint64)
    np.cumsum(s * power[:n], axis=1, out=before[:, 1:])
    total = before[:, n:]
    yield bitmap.mix(total)
    step = max(1, CELLS // (rows * symbols))
    for at in range(0, n, step):
        i = slice(at, min(n, at + step))
        after = total - before[:, i.start + 1:i.stop + 1]
        yield bitmap.mix(before[:, i] + after * _BACK)
        replaced = total[:, :, None] + (every - s[:, i, None]) * power[i][:, None]
        yield bitmap.mix(replaced.reshape(rows, -1))
    for at in range(0, n + 1, step):
        i = slice(at, min(n + 1, at + step))
        inserted = (before[:, i] + (total - before[:, i]) * np.uint64(_BASE))[:, :, None] + every * power[i][:, None]
        yield bitmap.mix(inserted.reshape(rows, -1))


def _keys(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, np.uint64)
            with np.errstate(over="ignore"):
                for rows, s in _reduced(batch["word"].to_pylist(), symbols) if batch.num_rows else ():
                    key[rows] = bitmap.mix((s * _powers(s.shape[1])).sum(axis=1, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], pa.array(key.view(np.int64))], ["word", "n", "key"])
    return run


def _near_keys(symbols: int, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                for rows, s in _reduced(batch["word"].to_pylist(), symbols) if batch.num_rows else ():
                    found = []
                    for keys in _neighbourhood(s, symbols):
                        r, c = np.nonzero(bitmap.hits(known.value, keys))
                        found.append(np.stack([rows[r].astype(np.uint64), keys[r, c]], axis=1))
                    found = np.unique(np.concatenate(found), axis=0)
                    yield pa.RecordBatch.from_arrays([batch["word"].take(pa.array(found[:, 0].astype(np.int64))),
                                                      pa.array(found[:, 1].copy().view(np.int64))], ["word", "key"])
    return run


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """``word, other, other_n``, both ways, of all words of ``words(word, n)``
    that differ by one inserted, deleted or replaced code point."""
    spark = words.sparkSession
    size = words.count()
    symbols = symbols or symbols_for(size)
    keyed = materialise(spark, words.select("word", "n").mapInArrow(_keys(symbols), "word string, n long, key long"), "variants_keyed")
    bits = bitmap.bits_for(size)
    known = spark.sparkContext.broadcast(bitmap.collect(bitmap.place_rows(keyed, "key", bits), bits))
    proposed = keyed.select("word").mapInArrow(_near_keys(symbols, known), "word string, key long")
    others = keyed.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    return (proposed.join(others, "key").where("word <> other").where(F.levenshtein("word", "other", 1) == 1)
            .select("word", "other", "other_n"))


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to their ends, paths doubling."""
    hops = materialise(spark, forms.select("word", F.col("form").alias("root")), "variants_hops")
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("far"))
        more = materialise(spark, hops.join(on, "root", "left").select(
            "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "variants_hops")
        hops = more.drop("moved")
        if not more.where("moved").head(1):
            return hops


def spelling_forms(words: DataFrame, ratio: int = RATIO, symbols: int | None = None) -> DataFrame:
    """One row per word of ``words(word, n)``: ``word, form, root, n, n_near,
    form_n``.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code
    point order) if that is ``ratio`` times the word's or more; ``root`` the
    end of the chain of forms, or the word.  Rows with a null word are left
    out, counts of a repeated word add up, a null count is 0.  An empty table
    gives an empty result; other columns are ignored.
    """
    spark = words.sparkSession
    words = words.where("word is not null").groupBy("word").agg(F.sum(F.coalesce("n", F.lit(0))).cast("long").alias("n"))
    words = materialise(spark, words, "variants_words")
    best = near_words(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("x"))
    fits = -F.col("x.m") >= ratio * F.col("n")
    out = words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("x.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, -F.col("x.m")).alias("form_n"))
    out = materialise(spark, out, "variants_forms")
    roots = _roots(spark, out.where("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(word_counts(documents(spark, sf_dir), noise=NOISE))
