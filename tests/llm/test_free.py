"""Operators with Python inside tasks, against plain Python."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from allelic.llm import components, fixity, jaccard_join, lm_scoring, packing, suffix_dedup
from llm import brute
from llm.conftest import edge_rows, prose

PAIRS = [(r[0], r[1]) for r in edge_rows()]


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --- components ----------------------------------------------------------------------

def test_components_path_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, j) for j in range(6, 30)] + [(1, 1), (3, 2), (2, 3)]
    got = dict(components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(101, 161)}, **{j: 5 for j in range(6, 30)}, 3: 2}


# --- Jaccard join --------------------------------------------------------------------

CLASSES = ("doc_id", "n_shingles", "component_id")


def test_join_edges(edge):
    rows = [(i, t) for i, t in PAIRS if i != 6]
    out = jaccard_join.jaccard_classes(edge.where("doc_id is null or doc_id <> 6"))
    assert _rows(out, *CLASSES) == brute.near_classes(rows)


def test_join_repeated_ids_are_one_document(edge):
    got = sorted((r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(edge).collect() if r.doc_id == 6)
    assert got == [(296, 6), (296, 6), (415, 6)]
    assert _rows(jaccard_join.jaccard_classes(edge), *CLASSES) == brute.near_classes(PAIRS)


def test_join_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _rows(jaccard_join.jaccard_classes(docs), *CLASSES) == brute.near_classes(rows)


def crowded(seed, many, edits, size=150):
    """Documents about as far apart from one another as the threshold, of
    which groups share their edits, so that regions stay open."""
    rnd = random.Random(seed)
    base = prose(rnd, size).split()
    rows = []
    for i in range(many):
        w = list(base)
        for _ in range(rnd.choice(edits)):
            at = rnd.randrange(len(w))
            w[at] = f"edit{at}x{rnd.randrange(3)}" if rnd.random() < 0.8 else f"edit{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w[:rnd.choice([size, size, size - 12])])))
    return rows


@pytest.mark.parametrize("heads, pivots", [(0, 1), (2, 2), (5000, 16)])
def test_join_recursion_in_a_crowded_band(spark, monkeypatch, heads, pivots):
    monkeypatch.setattr(jaccard_join, "MOST_HEADS", heads)
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    depths = []
    held = jaccard_join._deeper
    monkeypatch.setattr(jaccard_join, "_deeper", lambda rows, sets, depth, percent: depths.append(depth) or held(rows, sets, depth, percent))
    rows = crowded(8, 90, [2, 3, 4, 5, 6])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(jaccard_join.jaccard_classes(df), *CLASSES) == brute.near_classes(rows)
    assert depths == ([1, 2] if heads == 0 else depths)


@pytest.mark.parametrize("percent", [50, 90, 100])
def test_join_other_thresholds(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard_join, "MOST_HEADS", 2)
    rows = crowded(percent, 60, [0, 1, 2, 4, 8, 12], 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(jaccard_join.jaccard_classes(df, percent=percent), *CLASSES) == brute.near_classes(rows, percent)


def test_join_ranges_batches_and_common_shingles(spark, docs, monkeypatch):
    """Small ranges and batches, and shingles that count as common, change
    nothing."""
    monkeypatch.setattr(jaccard_join, "BATCH", 3000)
    monkeypatch.setattr(jaccard_join, "RANGE", 20_000)
    monkeypatch.setattr(jaccard_join, "COMMON", 45)
    seen = []
    held = jaccard_join._common
    monkeypatch.setattr(jaccard_join, "_common", lambda *a: seen.append(held(*a)) or seen[-1])
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10**6 + i, t) for i, t in crowded(4, 60, [1, 2, 5])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(jaccard_join.jaccard_classes(df), *CLASSES) == brute.near_classes(rows)
    assert len(seen[0])


@pytest.mark.parametrize("seed", range(3))
def test_join_rows_that_repeat_ids(spark, seed):
    """Ids that occur several times, with one text or several, lose no link."""
    rnd = random.Random(seed)
    small = [" ".join(f"{c}{k}" for k in range(8)) for c in "abc"]
    rows = [(5, "p q r s t u v w"), (6, "p q r s t u v"), (6, "p q r s t u v"), (7, "p q r s t u v w x"), (8, "q r s t u v w x"),
            (8, "q r s t u v w x"), (9, small[0]), (9, small[1]), (9, small[1]), (10, small[1] + " z"), (11, small[0] + " z"), (12, small[2])]
    rows += [(100 + k, prose(rnd, rnd.randrange(3, 40))) for k in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(jaccard_join.jaccard_classes(df), *CLASSES) == brute.near_classes(rows)


def test_join_threshold_is_inclusive(spark):
    a = [f"a{i}" for i in range(16)]  # 12 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:13])), (3, " ".join(a[:12]))]  # 9 and 8 of them
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(jaccard_join.jaccard_classes(df).select("doc_id", "component_id").collect())
    assert got == {1: 1, 2: 1, 3: 1}  # 9/12 links, 8/9 links
    assert brute.near_classes(rows) == [(1, 12, 1), (2, 9, 1), (3, 8, 1)]


# --- substring dedup -----------------------------------------------------------------

REMOVED = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_edges(edge):
    want = sorted(((i, *r) for (i, _), r in zip(PAIRS, brute.removed([t for _, t in PAIRS]))), key=str)
    assert _rows(suffix_dedup.suffix_dedup(edge), *REMOVED) == want


@pytest.mark.parametrize("bucket", [2_000, 2])
def test_suffix_shared_passages(spark, monkeypatch, bucket):
    """Passages cut at random places; with small buckets, by the further sort."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rnd = random.Random(bucket)
    source = prose(rnd, 400)
    rows = []
    for i in range(60):
        a = rnd.randrange(len(source) - 600)
        rows.append((i, prose(rnd, 40) + " " + source[a:a + rnd.randrange(150, 600)] + " " + prose(rnd, 40)))
    rows.append((60, "xy" * 300))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((i, *r) for (i, _), r in zip(rows, brute.removed([t for _, t in rows]))), key=str)
    assert _rows(suffix_dedup.suffix_dedup(df), *REMOVED) == want


def test_suffix_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0.0)
    rnd = random.Random(5)
    passage = prose(rnd, 60)
    rows = [(i, prose(rnd, 30) + " " + passage + " " + prose(rnd, 30)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((i, *r) for (i, _), r in zip(rows, brute.removed([t for _, t in rows]))), key=str)
    assert _rows(suffix_dedup.suffix_dedup(df), *REMOVED) == want


# --- packing -------------------------------------------------------------------------

def _check_packing(rows, pieces, length=4096):
    tok = Tokenizer.from_file(packing.tokenizer_file())
    ids = [(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in rows]
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    assert sum(p.length for p in pieces) == sum(len(x) for _, x in ids)
    want = Counter()
    for i, x in ids:
        want[i, len(x)] += len(x)
    got = Counter()
    for p in pieces:
        got[p.doc_id, p.doc_tokens] += p.length
        assert any(zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for i, x in ids
                   if i == p.doc_id and len(x) == p.doc_tokens)
    assert got == want
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at == length or at & (at - 1) == 0 and at < length


SPECIAL = ["don't I'll go x", "<|endoftext|> a<|startoftext|>b", "é ́e\x1cf\x85g", "ΑΣ Σ ǅ İstanbul", "日本語 テスト 123 4.5", "\x0b\x0c x"]


def test_pack_edges(spark, edge):
    _check_packing(PAIRS, packing.pack_documents(edge).collect())


def test_pack_special_texts(spark):
    rows = list(enumerate(SPECIAL))
    _check_packing(rows, packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_pack_many_ranges(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_TOKENS", 20_000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _check_packing(rows, packing.pack_documents(docs).collect())


def test_hilbert_is_a_walk():
    cube = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert(cube, 3)
    assert sorted(key) == list(range(512))
    assert (abs(np.diff(cube[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_pack_empty(empty):
    assert packing.pack_documents(empty).count() == 0


# --- LM scoring ----------------------------------------------------------------------

def _losses(rows, target):
    toks = [(i, (t or "").lower().split()) for i, t in rows]
    index = {w: k for k, w in enumerate(sorted({w for _, ws in toks for w in ws}), 1)}
    size = len(index) + 1
    out = []
    for use in (lambda i: i in target, lambda i: True):
        c = np.zeros((size, size))
        for i, ws in toks:
            if use(i):
                for a, b in zip([0, *(index[w] for w in ws)], [index[w] for w in ws]):
                    c[a, b] += 1
        uni = (c.sum(0) + 1) / (c.sum() + size)  # one count for what is unseen
        p = (c + lm_scoring.PRIOR * uni) / (c.sum(1, keepdims=True) + lm_scoring.PRIOR)
        score = []
        for i, ws in toks:
            at = [index[w] for w in ws]
            score.append(sum(-math.log(p[a, b]) for a, b in zip([0, *at], at)) / len(ws) if ws else None)
        out.append(score)
    return [(i, len(ws), a, b) for (i, ws), a, b in zip(toks, *out)]


def _check_losses(got, want):
    key = lambda r: (str(r[0]), r[1], r[3] or 0)
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:2] == w[:2]
        if w[2] is None:
            assert g[2:] == (None, None, None)
        else:
            assert g[2:4] == pytest.approx(w[2:], abs=2e-6)
            assert g[4] == pytest.approx(g[2] - g[3], abs=1e-6)


@pytest.mark.parametrize("chunk", [30_000, 200, 10**9])
def test_lm_every_word_counts(spark, edge, monkeypatch, chunk):
    """Rare and long words too, over one chunk or many chunks and parts; with
    small chunks most parts have no keys of a chunk."""
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk)
    few = edge if chunk > 200 else edge.where("length(text) < 500 or text is null")
    target = spark.createDataFrame([(1,), (4,), (None,), (999,), (4,), (6,)], "doc_id long")
    rows = [(r.doc_id, r.text) for r in few.collect()]
    _check_losses(lm_scoring.score_documents(few, target).collect(), _losses(rows, {1, 4, 6}))


def test_lm_rows_repeated_in_full(spark, monkeypatch):
    """They count each and travel once a batch."""
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 400)
    rows = [(1, "a b c a b")] * 300 + [(2, "b c"), (2, "c b"), (None, "a b"), (None, "a b"), (3, "")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(1,)], "doc_id long")
    _check_losses(lm_scoring.score_documents(df, target).collect(), _losses(rows, {1}))
    sent = [r for b in lm_scoring._deal(iter([pa.RecordBatch.from_pylist([{"id": i, "text": t, "target": False, "chunk": 0} for i, t in rows])]))
            for r in b.to_pylist()]
    assert len(sent) == 1 and len(lm_scoring._Docs([sent[0]["docs"]]).texts) == 5


def test_lm_keys_travel_as_differences():
    for keys in ([], [0], [5, 6, 1 << 63, (1 << 64) - 1]):
        keys = np.array(keys, np.uint64)
        assert (lm_scoring._unpack_keys(lm_scoring._pack_keys(keys)) == keys).all()


def test_lm_held_out(spark, docs):
    """Good documents not trained on score below the bad ones."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = labels.where("quality = 1 and doc_id % 2 = 0").select("doc_id")
    score = lm_scoring.score_documents(docs, train)
    held = score.join(labels.where("doc_id % 2 = 1"), "doc_id").where("score is not null").select("quality", "score").collect()
    good, bad = [[r.score for r in held if r.quality == q] for q in (1, 0)]
    auc = np.mean([g < b for g in good for b in bad])
    assert auc > 0.9


def test_lm_empty(spark, empty):
    assert lm_scoring.score_documents(empty, empty.select("doc_id")).count() == 0


# --- fixity --------------------------------------------------------------------------

def _audit(spark, left, right):
    schema = "archive string, offset long, record binary, hash string"
    l, r = (spark.createDataFrame([(*x, "clash") for x in side], schema) for side in (left, right))
    return sorted((tuple(x)[:5] for x in fixity.audit(l, r).collect()), key=str)


def test_fixity_locates_faults(spark):
    left = [(f"a{k % 3}", k * 5000, b"r%d" % k) for k in range(200)] + [(None, 0, b"x"), ("e", 7, None), ("e", 8, b""), ("e", 8, b"")]
    right = [x for k, x in enumerate(left) if k != 17]
    right[40] = (*right[40][:2], b"damaged")
    right.append(("a1", 99_999_999, b"new"))
    right.append(("z", 0, b"archive"))
    changed = right[40]
    assert _audit(spark, left, right) == sorted([
        (left[17][0], left[17][1], "missing", len(left[17][2]), None),
        (changed[0], changed[1], "changed", len(left[41][2]), 7),
        ("a1", 99_999_999, "extra", None, 3), ("z", 0, "extra", None, 7)], key=str)


def test_fixity_equal_repeated_and_empty(spark):
    rows = [("a", 0, b"x"), ("a", 0, b"x"), ("a", 1, None), (None, None, b"y")]
    assert _audit(spark, rows, list(reversed(rows))) == []
    assert _audit(spark, rows, rows[1:]) == [("a", 0, "missing", 1, None)]
    assert _audit(spark, [], []) == []


def test_warc_files_round_trip(spark, tmpdir_path):
    import glob
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>é {k}\n</p>") for k in range(600)] + [(None, None, None), (5, "http://h/5", "<p>é 5\n</p>")],
                                  "page_id long, url string, html string")
    rec = fixity.archive_pages(pages)
    fixity.write_warc(rec, tmpdir_path + "/w")
    rows = rec.collect()
    for archive in {r.archive for r in rows}:
        data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{tmpdir_path}/w/archive={archive}/part-*")))
        for r in rows:
            if r.archive == archive:
                assert data[r.offset:r.offset + len(r.record)] == bytes(r.record)
        assert len(data) == sum(len(r.record) for r in rows if r.archive == archive)


def test_warc_reader_gives_records_back_and_audits_replicas(spark, tmpdir_path):
    """Replicas on disk: equal ones agree; a changed byte and a broken length are found, and hide nothing behind them."""
    import glob
    import shutil
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>é {k}\r\n\r\nWARC/1.1 in the text</p>") for k in range(300)], "page_id long, url string, html string")
    rec = fixity.archive_pages(pages)
    one, two = f"{tmpdir_path}/one", f"{tmpdir_path}/two"
    fixity.write_warc(rec, one)
    shutil.copytree(one, two)
    left = fixity.read_warc(spark, one, "part-*")
    assert sorted((r.archive, r.offset, bytes(r.record)) for r in left.collect()) == sorted((r.archive, r.offset, bytes(r.record)) for r in rec.collect())
    first = left.orderBy("archive", "offset").first()
    assert (first.uri, first.date, first.type, first.record_id, first.valid) == ("http://h/0", fixity.NO_DATE, "resource", "<urn:page:0>", True)
    assert fixity.audit(left, fixity.read_warc(spark, two, "part-*")).count() == 0
    path = glob.glob(f"{two}/archive=a0/part-*")[0]
    data = bytearray(open(path, "rb").read())
    bad = [r for r in rec.orderBy("offset").collect() if r.archive == "a0"]
    data[bad[7].offset + len(bad[7].record) - 10] ^= 1
    at = data.find(b"Content-Length: ", bad[20].offset) + 16
    data[at:at + 1] = b"9"
    for crc in glob.glob(f"{two}/archive=a0/.part-*.crc"):
        os.replace(crc, crc + ".old")
    open(path, "wb").write(bytes(data))
    right = fixity.read_warc(spark, two, "part-*")
    assert [r.offset for r in right.where("not valid").collect()] == [bad[20].offset] and right.count() == 300
    got = sorted((r.archive, r.offset, r.status) for r in fixity.audit(left, right).collect())
    assert got == [("a0", bad[7].offset, "changed"), ("a0", bad[20].offset, "changed")]


def test_warc_parser_on_odd_files():
    assert list(fixity.parse_warc(b"")) == []
    assert [x[3] for x in fixity.parse_warc(b"no record at all")] == [False]
    assert [(x[0], x[3]) for x in fixity.parse_warc(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\nWARC/1.1\r\n")] == [(0, True), (37, False)]


def test_fixity_hash_is_of_offset_length_and_record(spark):
    df = spark.createDataFrame([("a", 12, b"abc")], "archive string, offset long, record binary")
    want = hashlib.sha256(f"12:3:{hashlib.sha256(b'abc').hexdigest()}".encode()).hexdigest()
    assert fixity.leaves(df).first().hash == want


def test_join_and_suffix_empty(empty):
    assert jaccard_join.jaccard_classes(empty).count() == 0
    assert suffix_dedup.suffix_dedup(empty).count() == 0
