"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from allelic.llm import variants
from allelic.llm.variants import near_words, op12_variants, spelling_forms, symbols_for, word_counts

from .brute import LOWER
from .conftest import SF


def counts(rows, noise=31):
    out = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if noise and h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def brute(n, ratio=10):
    gaps = {}  # words with one letter out, and themselves, share a gap if near
    for w in n:
        for g in {w, *((w[:k] + w[k + 1:]) for k in range(len(w)))}:
            gaps.setdefault(g, []).append(w)
    near = {w: set() for w in n}
    for some in gaps.values():
        for a in some:
            near[a].update(b for b in some if one_edit(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def random_words(letters, many, seed=1):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.choice([1, 2, 5, 7, 8, 9, 12]))) for _ in range(many)}
    return {w: rnd.choice([1, 2, 3, 30, 45, 400, 5000]) for w in sorted(words)}


@pytest.mark.parametrize("letters, symbols", [("ab", None), ("ab", 2), ("abcd", None), ("abcdéЖ日", 3), ("abcdefgh", 64)])
def test_all_near_words(spark, letters, symbols):
    n = random_words(letters, 400)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = [(r.word, r.other) for r in near_words(df, symbols).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in n for b in n if one_edit(a, b)}
    assert rows_of(spelling_forms(df, symbols=symbols)) == brute(n)


def test_neighbourhood_is_full():
    s = np.array([[1, 3, 2], [2, 2, 2]], np.uint64)
    with np.errstate(over="ignore"):
        keys = np.concatenate(list(variants._neighbourhood(s, 3)), axis=1)
        for row, word in zip(keys, s.tolist()):
            words = {tuple(word)} | {(*word[:i], *word[i + 1:]) for i in range(3)}
            words |= {(*word[:i], c, *word[i + 1:]) for i in range(3) for c in (1, 2, 3)}
            words |= {(*word[:i], c, *word[i:]) for i in range(4) for c in (1, 2, 3)}
            want = {int(variants.bitmap.mix((np.array(w, np.uint64) * variants._powers(len(w))).sum(dtype=np.uint64))) for w in words}
            assert {int(x) for x in row} == want


def test_long_chains_and_ties(spark):
    n = {"aaaaaaa": 10 ** 6, "aaaaaab": 10 ** 5, "aaaaabb": 10 ** 4, "aaaabbb": 1000, "aaabbbb": 100, "aabbbbb": 10, "abbbbbb": 1,
         "zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30, "zzzzzzw": 29, "x" * 3000: 50, "x" * 2999: 5}
    df = spark.createDataFrame([(w, m, "clash") for w, m in n.items()], "word string, n long, key string")
    got = {r.word: (r.form, r.root) for r in spelling_forms(df).collect()}
    assert got["abbbbbb"] == ("aabbbbb", "aaaaaaa") and got["zzzzzzz"] == ("zzzzzzx", "zzzzzzx")
    assert got["x" * 2999] == ("x" * 3000, "x" * 3000)
    assert rows_of(spelling_forms(df)) == brute(n)


def test_symbols_grow_with_the_vocabulary():
    assert [symbols_for(n) for n in (0, 100, 10 ** 4, 10 ** 6, 10 ** 30)] == [4, 4, 8, 16, 64]


def test_small_matrices_change_nothing(spark, monkeypatch):
    n = random_words("abc", 150, 5) | {"y" * 90: 4}
    monkeypatch.setattr(variants, "CELLS", 60)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows_of(spelling_forms(df)) == brute(n)


def test_edge_rows(spark, edge, monkeypatch):
    monkeypatch.setattr(variants, "TYPES", 50)
    n = counts([(r.doc_id, r.text) for r in edge.collect()])
    assert {r.word: r.n for r in word_counts(edge, noise=31).collect()} == n
    assert rows_of(spelling_forms(word_counts(edge, noise=31))) == brute(n)


def test_nulls_repeats_and_empty_tables(spark, empty):
    assert spelling_forms(word_counts(empty)).collect() == []
    df = spark.createDataFrame([(None, 5), ("abcdefg", 1), ("abcdefg", 1), ("abcdef", None), ("abcdexg", 20)], "word string, n long")
    assert rows_of(spelling_forms(df)) == brute({"abcdefg": 2, "abcdef": 0, "abcdexg": 20})


def test_query(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(op12_variants(spark, SF)) == brute(counts(rows))
