"""Phrase collocations by Toivonen's method.

A sample of the documents proposes phrases, level by level, with a lowered
count.  One full pass then counts, over all documents, the proposals and
their negative border: each phrase whose two parts one word shorter are both
proposed.  (Every word is in the border or proposed.)  If a phrase of the
border turns out frequent, its extensions were not counted: such failures join
the proposals, and a further pass counts what they add, until none is left.
The sample only decides which pass counts a phrase; the result is the same
for any sample, an empty one included.

These passes count 64-bit hashes of phrases, packed into a row for each chunk
of text and range of hashes; phrases that clash are counted together, so none
is lost.  A last pass counts the phrases themselves, of those whose hash was
frequent, and only its counts are returned.

Sets of hashes are bitmaps of bounded size (see ``bitmap``), which may say
"perhaps" of a hash that is not in the set; then more is counted than needed.
Tasks cut and count chunks with numpy; sums, scores and ranks are DataFrame
operations.
"""

from __future__ import annotations

import string
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from allelic.llm import bitmap
from allelic.llm.common import arrow_batches, documents, materialise, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_WORDS, MIN_COUNT, TOP, COVER = 3, 10, 2000, 50
#: Share of the documents that proposes, and the part of its share of
#: ``MIN_COUNT`` that a phrase needs there.
SAMPLE, SLACK = 0.4, 0.75
#: Bytes of text that a task counts at a time, and that give a range of hashes.
CHUNK, RANGE = 1_000_000, 8_000_000
#: Upper case to lower case; ends of pieces to a line feed, blanks to a space.
_FOLD = bytes.maketrans((string.ascii_uppercase + ".,;:!?\n\v\f\r\t").encode(),
                        (string.ascii_lowercase + "\n" * 10 + " ").encode())
_LEVELS = 16  # more words than a phrase may have


def _hash(words) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False)


def _first(h: np.ndarray, lang: str) -> np.ndarray:
    """Hashes of one-word phrases of a language."""
    return bitmap.mix(h ^ _hash([lang])[0])


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those without the last word and that word's."""
    return bitmap.mix(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


class _Chunk:
    """The words of some text of one language, numbered."""

    def __init__(self, text: bytes, lang: str):
        d = np.frombuffer(text, np.uint8)
        end = d == 10
        word = ~(end | (d == 32))
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, sizes = edge[::2], edge[1::2] - edge[::2]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(d[word]))
        coded = words.dictionary_encode()
        self.lang, self.words, self.w = lang, coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        piece = np.cumsum(end)[starts]
        last = np.flatnonzero(np.diff(piece, append=-1))
        #: words from each one to the end of its piece
        self.left = last[np.searchsorted(last, np.arange(len(piece)))] - np.arange(len(piece)) + 1
        self.h = _hash(self.words.to_pylist())

    def _distinct(self, at: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Word columns and counts of the distinct phrases of ``k`` words that
        start at ``at``."""
        size = len(self.h)
        heads, held = [], 0  # columns of the first words once these have numbers of their own
        code, most = self.w[at], size
        for j in range(1, k):
            if most * size >= 1 << 63:  # the next word would not fit
                value, code = np.unique(code, return_inverse=True)
                heads, held, most = self._columns(value, heads, j - held), j, len(value)
            code, most = code * size + self.w[at + j], most * size
        value, n = np.unique(code, return_counts=True)
        return self._columns(value, heads, k - held), n

    def _columns(self, code: np.ndarray, heads: list[np.ndarray], k: int) -> list[np.ndarray]:
        """Columns of ``heads`` and of the ``k`` words behind them."""
        cols = []
        for _ in range(k if heads else k - 1):
            cols.append(code % len(self.h))
            code = code // len(self.h)
        return [*([c[code] for c in heads] or [code]), *cols[::-1]]

    def _hashes(self, cols: list[np.ndarray]) -> np.ndarray:
        h = _first(self.h[cols[0]], self.lang)
        for c in cols[1:]:
            h = _longer(h, self.h[c])
        return h

    def count(self, levels: list[int], now: np.ndarray, before: np.ndarray | None) -> Iterator[tuple]:
        """``(k, word columns, hashes, counts)`` of the phrases of ``levels``
        whose parts are in the bitmap ``now``, but not of those whose parts
        are all in ``before``."""
        h = _first(self.h, self.lang)
        if 1 in levels:
            yield 1, [np.arange(len(h))], h, np.bincount(self.w, minlength=len(h))
        is_now = bitmap.hits(now, h)[self.w]
        is_before = bitmap.hits(before, h)[self.w] if before is not None else None
        h = h[self.w]  # from here on by place
        for k in range(2, max(levels) + 1):
            at = np.flatnonzero(self.left >= k)
            at = at[is_now[at] & is_now[at + 1]]
            new = at if is_before is None else at[~(is_before[at] & is_before[at + 1])]
            if k in levels and len(new):
                cols, n = self._distinct(new, k)
                yield k, cols, self._hashes(cols), n
            if k == max(levels) or not len(at):
                return
            longer = _longer(h[at], self.h[self.w[at + k - 1]])
            h = np.zeros(len(self.w), np.uint64)
            h[at] = longer
            one = np.zeros(len(self.w), bool)
            one[at] = bitmap.hits(now, longer)
            if is_before is not None:
                both = np.zeros(len(self.w), bool)
                both[at] = bitmap.hits(before, longer) & is_before[at] & is_before[at + 1]
                is_before = both
            is_now = one

    def phrases(self, cols: list[np.ndarray]) -> pa.Array:
        """The language, a tab and the words of each phrase."""
        sep = lambda x: pa.scalar(x, pa.large_string())
        out = pc.binary_join_element_wise(sep(self.lang), self.words.take(pa.array(cols[0])), sep("\t"))
        if len(cols) > 1:
            out = pc.binary_join_element_wise(out, *(self.words.take(pa.array(c)) for c in cols[1:]), sep(" "))
        return out.cast(pa.string())


def _cut(text: bytes) -> Iterator[bytes]:
    """Parts of about ``CHUNK`` bytes that end with a piece."""
    at = 0
    while at < len(text):
        to = text.find(b"\n", at + CHUNK) + 1 if len(text) - at > CHUNK else len(text)
        to = to or len(text)
        yield text[at:to]
        at = to


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    """Chunks of one language each; documents end pieces."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * CHUNK, "right")))
            some = batch.slice(at, to - at)
            at = to
            lang = some["lang"].dictionary_encode()
            number = lang.indices.to_numpy()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                texts = some["text"].take(pa.array(np.flatnonzero(number == k))).cast(pa.large_binary())
                text = b"\n".join(texts.to_pylist()).translate(_FOLD)
                for part in _cut(text):
                    chunk = _Chunk(part, name)
                    if len(chunk.w):
                        yield chunk


_PACKED = "slot long, h binary, n binary"


def _narrow(n: np.ndarray) -> bytes:
    """Counts in the narrowest of 1, 4 and 8 bytes."""
    most = n.max(initial=0)
    return n.astype(np.uint8 if most < 1 << 8 else np.uint32 if most < 1 << 32 else np.uint64).tobytes()


def _count_hashes(levels: list[int], ranges: int, now, before):
    """A row for each chunk, number of words and range of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for chunk in _chunks(batches):
                rows = []
                for k, _, h, n in chunk.count(levels, now.value, before and before.value):
                    order = np.argsort(h)
                    h, n = h[order], n[order]
                    part = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                    cuts = np.flatnonzero(np.diff(part)) + 1
                    for some, m in zip(np.split(h, cuts), np.split(n, cuts)):
                        slot = int(((some[0] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)) * _LEVELS + k
                        rows.append((slot, some.tobytes(), _narrow(m)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                                     ["slot", "h", "n"])
    return run


def _add_hashes(least: int):
    def run(table: pa.Table) -> pa.Table:
        h = [np.frombuffer(x, np.uint64) for x in table["h"].to_pylist()]
        n = [np.frombuffer(x, {1: np.uint8, 4: np.uint32, 8: np.uint64}[len(x) // len(k)]).astype(np.int64)
             for x, k in zip(table["n"].to_pylist(), h)]
        h, n = np.concatenate(h), np.concatenate(n)
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h = h[first[np.add.reduceat(n, first) >= least]]
        k = table["slot"][0].as_py() % _LEVELS
        return pa.table({"k": pa.array(np.full(len(h), k, np.int32)), "h": pa.array(h.view(np.int64))})
    return run


def _frequent_hashes(texts: DataFrame, levels: list[int], ranges: int, least: int, now, before=None) -> DataFrame:
    """``k, h``: the hashes that at least ``least`` occurrences share, of
    phrases whose parts are in ``now`` and not all in ``before``."""
    rows = texts.mapInArrow(_count_hashes(levels, ranges, now, before), _PACKED)
    return rows.groupBy("slot").applyInArrow(_add_hashes(least), "k int, h long")


def _count_phrases(levels: list[int], found):
    """Counts of the phrases whose hash is in the bitmap, and of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for chunk in _chunks(batches):
                yield pa.RecordBatch.from_arrays([pa.array([chunk.lang + "\t"]), pa.array([len(chunk.w)], pa.int64())], ["key", "n"])
                for _, cols, h, n in chunk.count(levels, found.value, None):
                    keep = np.flatnonzero(bitmap.hits(found.value, h))
                    for at in range(0, len(keep), 100_000):
                        some = keep[at:at + 100_000]
                        yield pa.RecordBatch.from_arrays([chunk.phrases([c[some] for c in cols]), pa.array(n[some], pa.int64())], ["key", "n"])
    return run


def _unseen(seen):
    """Hashes that are not in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch["h"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield batch.filter(pa.array(~bitmap.hits(seen.value, h)))
    return run


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the column ``h``."""
    return bitmap.collect(bitmap.place_rows(hashes, "h", bits), bits)


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT, sample: float = SAMPLE) -> DataFrame:
    """``lang, k, phrase, n`` of each phrase of 1 to ``max_words`` words that
    occurs ``min_count`` times or more in its language, and, as ``k`` 0 and an
    empty phrase, the number of words of each language.

    Phrases do not cross ``[.,;:!?]`` or line ends; overlapping occurrences
    count.  A null language is ``und``; null, empty and blank texts have no
    words; rows repeated in full count each.
    """
    if not 1 <= max_words < _LEVELS:
        raise ValueError(f"phrases have 1 to {_LEVELS - 1} words")
    with arrow_batches(docs.sparkSession, 4 * CHUNK):
        return _frequent_phrases(docs, lang_col, text_col, max_words, min_count, sample)


def _frequent_phrases(docs: DataFrame, lang_col: str, text_col: str, max_words: int, min_count: int, sample: float) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    some = texts.where(F.pmod(F.xxhash64("lang", "text"), F.lit(1000)) < int(1000 * sample))
    lowered = max(1, int(SLACK * sample * min_count))
    ranges = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE
    share = lambda x: spark.sparkContext.broadcast(x)  # noqa: E731  at most 32 MB

    # proposals of the sample; those of the longest phrases have no extensions
    proposed, bits, seen = None, bitmap.bits_for(0), np.zeros(bitmap.bits_for(0) // 8, np.uint8)
    for k in range(1, max_words):
        now = share(seen)
        level = materialise(spark, _frequent_hashes(some, [k], ranges, lowered, now), "phrases_proposed")
        now.unpersist()
        proposed = level if proposed is None else proposed.unionByName(level)
        bits = bitmap.bits_for(proposed.count())
        seen = _bitmap(proposed, bits)

    found, before, levels = None, None, list(range(1, max_words + 1))
    while True:
        now = share(seen)
        counted = materialise(spark, _frequent_hashes(texts, levels, ranges, min_count, now, before), "phrases_counted")
        found = counted if found is None else found.unionByName(counted)
        failed = counted.where(F.col("k") < max_words).select("h").mapInArrow(_unseen(now), "h long")
        more = _bitmap(failed, bits)
        if not more.any():
            break
        if before is not None:
            before.unpersist()
        before, seen, levels = now, seen | more, list(range(2, max_words + 1))
    now.unpersist()

    frequent = share(_bitmap(found, bitmap.bits_for(found.count())))
    counts = texts.mapInArrow(_count_phrases(list(range(1, max_words + 1)), frequent), "key string, n long")
    counts = counts.groupBy("key").agg(F.sum("n").alias("n")).where((F.col("n") >= min_count) | F.col("key").endswith("\t"))
    phrase = F.substring_index("key", "\t", -1)  # a language may have tabs, a phrase has none
    out = counts.select(F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)").alias("lang"),
                        F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("k"), phrase.alias("phrase"), "n")
    return materialise(spark, out, "phrases_frequent")


def _cut_score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exact up to 10**15 occurrences; a is
    at most l and r, so the quotient is small."""
    big = lambda c: F.col(c).cast("decimal(15,0)")
    return F.call_function("div", (big(a) * big(a) * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)"),
                           (big(l) * big(r)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, top: int = TOP, cover: int = COVER, sample: float = SAMPLE) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n,
    score``.

    ``a`` counts a phrase of 2 to ``max_words`` words, ``l`` and ``r`` the two
    parts of its lowest-scoring cut (the first of several), ``n`` all words of
    the language.  A phrase within a longer one that has ``cover`` percent of
    its count or more is left out.  Ties in rank go by ``a``, then by the bytes
    of the phrase.  Nulls, empty texts and repeated rows: see
    ``frequent_phrases``.  An empty table gives an empty result; other columns
    are ignored.
    """
    frequent = frequent_phrases(docs, lang_col, text_col, max_words, min_count, sample)
    found = frequent.where("k > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")

    within = (found.where(F.size("words") > 2)
              .withColumn("m", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
              .withColumn("i", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)))
              .select("lang", part(F.col("i"), F.col("m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = found.join(within, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {cover} * a")

    cuts = (kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
            .select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"),
                    part(F.col("cut") + 1, F.size("words")).alias("right")))
    counts = frequent.where("k > 0")
    scored = (cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
              .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
              .withColumn("score", _cut_score("a", "l", "r"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (scored.select("lang", "phrase", "a", "x.l", "x.r", "x.score")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    totals = frequent.where("k = 0").select("lang", F.col("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP11_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k, i, ws
  FROM words, (SELECT unnest([1, 2, 3]) AS k), unnest(range(1, len(ws) - k + 2)) AS pos(i)),
f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS n
  FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
inner_of AS (
  SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM cand, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN inner_of b ON b.lang = c.lang AND b.phrase = c.phrase
  WHERE b.longer IS NULL OR 100 * b.longer < 50 * c.a),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS x, array_to_string(ws[cut + 1:k], ' ') AS y
  FROM kept, (SELECT unnest([1, 2]) AS cut) WHERE cut < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, p.n AS l, q.n AS r,
         ((1000000::HUGEINT * c.a * c.a) // (p.n::HUGEINT * q.n))::BIGINT AS score, cut
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y),
least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
