"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from allelic.llm import byte_bpe
from allelic.llm.byte_bpe import Codec, PairTable, decode_documents, encode_documents, op13_byte_bpe, unknown_letters

from .conftest import SF


@pytest.fixture(scope="module")
def rank_file():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(rank_file):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(rank_file):
    return Codec(rank_file, public_tokenizers.PATTERN, unknown_letters(public_tokenizers.PATTERN))


def check(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:60]
        assert codec.decode(ids) == text.encode()


def test_hand_written(codec, library):
    check(codec, library, ["", "a", " ", "don't we'll", "  x  ", "\n\n  a\t b", "<|endoftext|>", "½²٣ 7½", "é‍ x\u0085", "\x1c a\x1f"])


def test_long_pieces(codec, library):
    check(codec, library, ["a" * 5000, "ab" * 3000, "é" * 3000, "日本語のテキスト" * 300, "=-" * 900, " " * 4000, "aab" * 171])


@pytest.mark.parametrize("letters", ["ab", "abc", "etaoinshrdlu", "üßéa"])
def test_random_pieces(codec, library, letters):
    rnd = random.Random(letters)
    check(codec, library, ["".join(rnd.choice(letters) for _ in range(rnd.choice([2, 9, 40, 300, 900]))) for _ in range(120)])


def test_every_class_of_code_points(codec, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    check(codec, library, [f"a{chr(c)}a 1{chr(c)}1 {chr(c)}! " for c in points])


def test_letters_newer_than_the_library(codec, library):
    first = codec.odd  # only the newest letters go the slow way
    assert first("plain ünïcode 日本") is None
    check(codec, library, [f"x{chr(c)}a{chr(c)}1" for c in range(0x10EC0, 0x10F00)])


def test_merges_are_leftmost_and_least():
    # "bc" outranks "ab", and a merge can make a rank lower than its own
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"ab": 258, b"xab": 259, b"aa": 260}
    file = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    own, library = Codec(file, r"\S+|\s+"), tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    check(own, library, ["".join(rnd.choice("abcx") for _ in range(n)) for n in [3, 5, 8, 13, 600, 1500] * 30])


def test_pair_table():
    table = PairTable({b"a": 0, b"b": 1, b"ab": 2, b"aba": 3}, 4)
    left, right = np.array([[0, 2, 0, 1, -1]]), np.array([[1, 0, 0, -1, 0]])
    none = np.iinfo(np.int32).max
    assert table.ranks(left, right).tolist() == [[2, 3, none, none, none]]


def test_forgetting_changes_nothing(rank_file, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 3)
    codec = Codec(rank_file, public_tokenizers.PATTERN)
    for _ in range(3):
        check(codec, library, ["some words of a text", "other words, " + "x" * 100])


def test_edge_rows(spark, edge, library):
    rows = decode_documents(encode_documents(edge)).collect()
    want = sorted((str(r.doc_id), library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in edge.collect())
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.bytes)) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)


def test_empty_table_and_null_ids(spark, empty):
    assert encode_documents(empty).collect() == []
    ids = spark.createDataFrame([(1, None), (2, bytearray(b"\x05\0\0\0"))], "doc_id long, x binary").withColumn("n", F.lit(1))
    assert [len(r.bytes) for r in decode_documents(ids, "x").orderBy("doc_id").collect()] == [0, 1]
    with pytest.raises(ValueError):
        decode_documents(ids.withColumn("bytes", F.lit(1)), "x")


def test_query(spark, docs, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op13_byte_bpe(spark, SF).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r.text or "").encode()))
    assert got == want
