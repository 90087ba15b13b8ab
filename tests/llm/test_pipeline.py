"""The pipeline stage by stage against plain Python, and the registered queries."""

from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from allelic.llm import mixing, quality
from llm import brute
from llm.conftest import SCHEMA, SF
from llm.test_free import _check_packing


def _ids(df):
    return sorted((r.doc_id for r in df.collect()), key=str)


def test_stages(spark, docs):
    base = P.materialise(spark, docs.unionByName(docs.where("doc_id % 20 = 0")), "t0")
    one = P.materialise(spark, P.quality_rules(spark, base, SF), "t1")
    kept = {r.doc_id for r in quality.quality(base).where("kept").collect()}
    assert one.columns == docs.columns and _ids(one) == [i for i in _ids(base) if i in kept]

    two = P.materialise(spark, P.exact(spark, one, SF), "t2")
    stay = [r[0] for r in brute.exact_dedup([(r.doc_id, r.text) for r in one.collect()]) if r[3]]
    assert two.columns == docs.columns and _ids(two) == sorted(stay, key=str)

    three = P.materialise(spark, P.near_duplicates(spark, two, SF), "t3")
    stay = [r[0] for r in brute.near_classes([(r.doc_id, r.text) for r in two.collect()]) if r[0] == r[2]]
    assert three.columns == docs.columns and _ids(three) == sorted(stay, key=str)

    four = P.materialise(spark, P.mixing(spark, three, SF), "t4")
    copies = Counter({r.doc_id: r.copies for r in mixing.mix_sources(three).collect()})
    assert four.columns == docs.columns and Counter(_ids(four)) == +copies

    _check_packing([(r.doc_id, r.text) for r in four.collect()], P.packing(spark, four, SF).collect())


def test_stages_on_edges(spark, edge, empty):
    plain = edge.select(*[c.split()[0] for c in SCHEMA.split(", ")])
    for start in (plain, empty):
        df = start
        for n, (_, stage) in enumerate(P.STAGES):
            df = P.materialise(spark, stage(spark, df, SF), f"e{n}")
            if n < 4:
                assert df.columns == start.columns
        assert (df.count() == 0) == (start is empty)


def test_exact_stage_keeps_one_of_rows_repeated_in_full(spark):
    rows = [(1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (1, "other", "en", "s", 5), (2, "ab", "en", "s", 2)]
    out = P.exact(spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "a b"), (1, "other")]


def test_near_duplicates_tells_texts_apart(spark):
    """Of an id with a near copy and a text of its own, the copy goes."""
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(5, a), (6, a + " more"), (6, b), (6, b), (7, b + " end"), (8, "other words"), (None, a), (9, None), (4, "z " + a)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    out = P.near_duplicates(spark, df, SF)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(4, "z " + a), (6, b), (6, b), (8, "other words"), (9, None), (None, a)], key=str)


def test_registered():
    q = E.queries()
    for n in range(1, 14):
        assert len([k for k in q if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in q and set(E.oracle_sql()) <= set(q)


@pytest.mark.parametrize("name", ["op3_mixing", "op4_exact_dedup", "op8_fixity", "op10_licenses", "op11_phrases"])
def test_oracle(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ref = con.sql(E.oracle_sql()[name])
    cols = sorted(ref.columns)
    want = Counter(str(r) for r in con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({E.oracle_sql()[name]})").fetchall())
    got = Counter(str(tuple(r)) for r in E.queries()[name](spark, SF).select(*[f"`{c}`" for c in cols]).collect())
    assert got == want
