"""Physical-plan assertions: pruning, pushdown, join strategy, idempotent
appends and the streaming N+1 path."""

import os

from pyspark.sql import functions as F

from allelic.operators import carriers, frequency
from allelic.sinks import writers
from allelic.sinks.vcf import write_vcf
from allelic.sources import fixtures as fx
from allelic.sources import tables
from allelic.streaming.ingest import ingest_vcf_stream
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _warehouse(spark, root):
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    writers.write_batch(calls.where(F.col("batch_id") == "001"), root)
    writers.write_batch(calls.where(F.col("batch_id") == "002"), root)
    return tables.read_warehouse(spark, root)


def test_partition_pruning_and_pushdown(spark, tmpdir_path):
    wh = _warehouse(spark, os.path.join(tmpdir_path, "wh"))
    p = plan(carriers.carrier_lookup(wh, "chr21", fx.TARGET_START))
    assert "PartitionFilters: [isnotnull(reference_name" in p and "chr21" in p
    assert "EqualTo(start," in p
    # Column pruning: the lookup does not read cohort_id / qual.
    assert "ReadSchema" in p and "cohort_id" not in p.split("ReadSchema")[1].split("\n")[0]
    # Materialised gene column lets the gene predicate reach the scan.
    from allelic.operators import burden
    pb = plan(burden.gene_burden(wh, "APP", "chr21"))
    assert "EqualTo(gene_symbol,APP)" in pb


def test_aggregate_is_partial_then_final(spark):
    p = plan(frequency.allele_frequency(fx.variants(spark, SF_SMALL)))
    assert p.count("HashAggregate") >= 2


def test_append_is_idempotent(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "wh2")
    wh = _warehouse(spark, root)
    n1 = wh.count()
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    writers.write_batch(calls.where(F.col("batch_id") == "002"), root)  # replay
    assert tables.read_warehouse(spark, root).count() == n1
    per_batch = {r["batch_id"]: r["count"]
                 for r in tables.read_warehouse(spark, root).groupBy("batch_id").count().collect()}
    assert set(per_batch) == {"001", "002"}
    assert sum(per_batch.values()) == calls.count()


def test_streaming_n1_matches_batch_load(spark, tmpdir_path):
    calls = fx.variants(spark, SF_SMALL, with_batch=True).where(F.col("reference_name") == "chr21")
    src = os.path.join(tmpdir_path, "landing")
    for b in ("001", "002"):
        write_vcf(calls.where(F.col("batch_id") == b).drop("batch_id"), f"{src}/batch_{b}")
    root = os.path.join(tmpdir_path, "stream_tbl")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    ingest_vcf_stream(spark, src, root, ckpt, max_files_per_trigger=1)
    got = tables.read_warehouse(spark, root)
    assert {r[0] for r in got.select("batch_id").distinct().collect()} == {"001", "002"}
    carriers_stream = got.where(F.col("genotype").isin("0/1", "1/1")).count()
    assert carriers_stream == calls.where(F.col("genotype").isin("0/1", "1/1")).count()
    # Restart on the same checkpoint: nothing new, nothing duplicated.
    n = got.count()
    ingest_vcf_stream(spark, src, root, ckpt, max_files_per_trigger=1)
    assert tables.read_warehouse(spark, root).count() == n


def test_dimension_join_broadcast_and_salted_paths(spark):
    """Small person table: checked broadcast.  Forced over the limit: salted
    shuffle join with a hot sample (a third of all calls) gives the same rows."""
    from allelic.operators import clinical
    calls = fx.variants(spark, SF_SMALL)
    skewed = calls.withColumn("sample_id", F.when(F.col("gq") < 73, F.lit("sample_000001"))
                              .otherwise(F.col("sample_id")))
    person = fx.person(spark, SF_SMALL)
    small = clinical.calls_with_demographics(skewed, person, contig=None)
    assert "BroadcastHashJoin" in plan(small)
    from allelic.plans.joins import join_dimension
    v = skewed.select("reference_name", "start", "sample_id")
    p_dim = person.select("sample_id", "gender_concept_id", "year_of_birth")
    salted = join_dimension(v, p_dim, "sample_id", max_broadcast_rows=0, hot_rows=1000) \
        .select("reference_name", "start", "sample_id", "gender_concept_id", "year_of_birth")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(salted)
        # a shuffle join on (sample_id, _salt)
        assert "SortMergeJoin [sample_id" in p and "_salt" in p
        got = sorted(map(tuple, salted.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(tuple, small.collect())) == got
    # the hot sample's rows are spread over many salt values
    hot = (skewed.where(F.col("sample_id") == "sample_000001")
           .select(F.pmod(F.xxhash64(*[F.col(c) for c in ["reference_name", "start", "sample_id"]]),
                          F.lit(32)).alias("s")).distinct().count())
    assert hot > 16


def test_omop_join_filters_conditions_before_join(spark):
    from allelic.operators import clinical
    calls = fx.variants(spark, SF_SMALL)
    person, cond = fx.person(spark, SF_SMALL), fx.condition_occurrence(spark, SF_SMALL)
    a = clinical.omop_phenotype_join(calls, person, cond, fx.TARGET_CONTIG, fx.TARGET_START)
    assert "LeftSemi" in plan(a)
    b = clinical.omop_phenotype_join(calls, person, cond, fx.TARGET_CONTIG, fx.TARGET_START,
                                     max_broadcast_rows=0)
    assert "LeftSemi" not in plan(b)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_many_hot_keys_do_not_fail(spark, monkeypatch):
    from allelic.plans import joins
    monkeypatch.setattr(joins, "MAX_HOT_KEYS", 3)
    fact = spark.createDataFrame([(k, n) for k in range(8) for n in range(20 if k else 200)], "k long, n long")
    dim = spark.createDataFrame([(k, k * 10) for k in range(8)], "k long, v long")
    assert len(joins.hot_keys(fact, ["k"], 10)) == 1
    got = joins.join_dimension(fact, dim, "k", max_broadcast_rows=0, hot_rows=10)
    assert sorted(map(tuple, got.collect())) == sorted((r["k"], r["n"], r["k"] * 10) for r in fact.collect())
