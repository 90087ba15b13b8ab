"""Phrase collocations against plain Python, bitmaps, exact scores."""

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from allelic.llm import bitmap, phrases
from allelic.llm.phrases import collocations, frequent_phrases, op11_phrases

from .brute import LOWER
from .conftest import SCHEMA, SF


def counts(rows, most):
    """rows: (lang, text) -> lang -> Counter of word tuples."""
    out = {}
    for lang, text in rows:
        c = out.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            c.update(tuple(w[i:i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    return out


def brute(rows, most=3, least=10, top=2000):
    out = []
    for lang, c in counts(rows, most).items():
        total = sum(n for p, n in c.items() if len(p) == 1)
        found = {p: n for p, n in c.items() if len(p) > 1 and n >= least}
        longer = {}
        for p, n in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(n, longer.get(p[i:i + m], 0))
        ranked = []
        for p, a in found.items():
            if 100 * longer.get(p, 0) >= 50 * a:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), " ".join(p), c[p[:k]], c[p[k:]]))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p, -a, left, right, total, -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("sample", [0.0, 0.1, 1.0])
def test_same_for_any_sample(spark, docs, sample):
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert rows_of(collocations(docs, sample=sample)) == brute(rows)


@pytest.mark.parametrize("most, least, top", [(2, 3, 7), (4, 4, 50), (5, 2, 100000)])
def test_lengths_and_limits(spark, docs, most, least, top):
    some = docs.where("doc_id % 3 = 0")
    rows = [(r.lang, r.text) for r in some.collect()]
    got = rows_of(collocations(some, max_words=most, min_count=least, top=top))
    assert got == brute(rows, most, least, top)


def test_every_pass_adds_what_failed(spark, docs, monkeypatch):
    """Without a sample the words, then the pairs, fail: three passes."""
    passes = []
    held = phrases._frequent_hashes
    monkeypatch.setattr(phrases, "_frequent_hashes", lambda *a: passes.append(a[1]) or held(*a))
    frequent_phrases(docs, sample=0.0)
    assert passes == [[1], [2], [1, 2, 3], [2, 3], [2, 3]]
    passes.clear()
    frequent_phrases(docs, sample=1.0)
    assert passes == [[1], [2], [1, 2, 3]]


def test_full_bitmap_costs_work_only(spark, docs, monkeypatch):
    rows = [(r.lang, r.text) for r in docs.collect()]
    monkeypatch.setattr(bitmap, "MOST_BITS", 15)
    monkeypatch.setattr(phrases, "CHUNK", 500)
    monkeypatch.setattr(phrases, "RANGE", 9000)
    assert rows_of(collocations(docs)) == brute(rows)


def test_phrases_too_long_for_one_number():
    """Codes of many words do not fit 64 bits and are numbered on the way."""
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(30)}" for _ in range(4000)]
    text = " ".join(words[:2500]) + "\n" + " ".join(words[2500:])
    chunk = phrases._Chunk((text + " " + " ".join(f"x{k}" for k in range(50_000))).encode(), "en")
    full = np.full(1 << 12, 255, np.uint8)
    with np.errstate(over="ignore"):
        for k, cols, h, n in chunk.count(list(range(1, 8)), full, None):
            got = {p.split("\t")[1]: c for p, c in zip(chunk.phrases(cols).to_pylist(), n.tolist()) if "x" not in p}
            want = Counter(" ".join(w[i:i + k]) for w in (words[:2500], words[2500:]) for i in range(len(w) - k + 1))
            assert got == want and len(h) == len(n)


def test_hand_counts(spark):
    rows = [(None, "A b. a b! a\tb c d"), ("en", "the cat\nthe cat; THE CAT"), ("en", None), ("en", " \x0b ,,, "), ("x", "one"), ("a\tb", "z z")]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = {(r.lang, r.phrase): r.n for r in frequent_phrases(df, min_count=2).collect()}
    assert got == {("und", ""): 7, ("und", "a"): 3, ("und", "b"): 3, ("und", "a b"): 3, ("en", ""): 6, ("en", "the"): 3,
                   ("en", "cat"): 3, ("en", "the cat"): 3, ("x", ""): 1, ("a\tb", ""): 2, ("a\tb", "z"): 2}


def test_edge_rows(spark, edge):
    rows = [(r.lang, r.text) for r in edge.collect()]
    assert rows_of(collocations(edge)) == brute(rows)
    assert rows_of(collocations(edge, min_count=1, top=100000)) == brute(rows, 3, 1, 100000)


def test_empty_table(spark, empty):
    assert collocations(empty).collect() == []
    blank = spark.createDataFrame([(1, " ", None, None, None)], SCHEMA)
    assert collocations(blank).collect() == []


def test_scores_beyond_64_bits(spark):
    rows = [(10 ** 14 + 7, 10 ** 14 + 9, 3 * 10 ** 14), (10, 10, 10), (3, 7, 11), (10 ** 12, 10 ** 12, 10 ** 13 + 1)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = {r.a: r.score for r in df.select("a", phrases._cut_score("a", "l", "r").cast("long").alias("score")).collect()}
    assert got == {a: 1000000 * a * a // (left * right) for a, left, right in rows}


def test_bitmap(spark):
    h = np.random.RandomState(1).randint(-(1 << 63), 1 << 63, 1000).view(np.uint64)
    bits = bitmap.bits_for(len(h))
    df = spark.createDataFrame([(int(x),) for p in bitmap.places(h, bits) for x in p], "bit long")
    made = bitmap.collect(df, bits)
    assert bitmap.hits(made, h).all()
    rows = spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "key long")
    assert (bitmap.collect(bitmap.place_rows(rows, "key", bits), bits) == made).all()
    others = np.random.RandomState(2).randint(0, 1 << 63, 100_000).astype(np.uint64)
    assert bitmap.hits(made, others).mean() < 0.01
    assert not bitmap.collect(df.where(F.lit(False)), bits).any()


def test_task_memory_is_bounded(spark):
    """A task counts a bounded part of its text at a time."""
    rnd = random.Random(3)
    text = "\n".join(" ".join(f"w{rnd.randrange(9000)}" for _ in range(12)) for _ in range(60_000))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang", "text"])
    full = SimpleNamespace(value=np.full(1 << 12, 255, np.uint8))
    for run in (phrases._count_hashes([1, 2, 3], 9, full, None), phrases._count_phrases([1, 2, 3], full)):
        tracemalloc.start()
        assert sum(b.num_rows for b in run([batch]))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 70e6


def test_wide_rows_come_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held, seen, inner = spark.conf.get(key), [], phrases._frequent_phrases

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    monkeypatch.setattr(phrases, "_frequent_phrases", lambda d, *a: seen.extend(r.n for r in d.mapInArrow(sizes, "n long").collect()) or inner(d, *a))
    docs = spark.range(0, 300, 1, 1).selectExpr("'en' AS lang", "repeat('ab cd ', 8000) AS text")
    got = {r.phrase: r.n for r in frequent_phrases(docs).collect()}
    assert max(seen) < 8 * phrases.CHUNK < 14e6 and spark.conf.get(key) == held
    assert got["ab cd"] == 300 * 8000 and got[""] == 300 * 16000


def test_query(spark, docs):
    assert rows_of(op11_phrases(spark, SF)) == brute([(r.lang, r.text) for r in docs.collect()])
