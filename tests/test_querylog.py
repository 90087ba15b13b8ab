"""Query-log rollups, scan cost and contig partitioning on small explicit inputs."""

import os

import pytest
from pyspark.sql import functions as F

from allelic.functions.cost import dollars, scan_cost
from allelic.operators import querylog
from allelic.schema import QUERY_LOG
from allelic.sinks import writers
from allelic.sources import tables


def _log(spark, rows):
    return spark.createDataFrame(rows, QUERY_LOG)


def test_cost_floor_and_label(spark):
    df = spark.createDataFrame([(0,), (10 * 2 ** 20,), (2 ** 40,)], "b long")
    got = df.select(scan_cost(F.col("b")).alias("c"), dollars(scan_cost(F.col("b"))).alias("l")) \
        .collect()
    assert got[0]["c"] == got[1]["c"] == pytest.approx(5 * 10 / 2 ** 20)
    assert got[0]["l"] == "$0.000048" and got[2]["l"] == "$5.000000"


def test_summary_pivot_and_ranking(spark):
    log = _log(spark, [
        ("a", "carrier_lookup", 10, 100.0, 0), ("a", "allele_frequency", 10, 200.0, 0),
        ("a", "omop_join", 10, 300.0, 0), ("a", "gene_burden", 10, 50.0, 0),
        ("b", "carrier_lookup", 10, 10.0, 2 ** 40), ("b", "carrier_lookup", 10, 30.0, 0)])
    s = {r["strategy"]: r for r in querylog.bench_summary(log).collect()}
    assert (s["a"]["carrier_lookup_ms"], s["a"]["allele_freq_ms"], s["a"]["omop_join_ms"]) == \
        (100.0, 200.0, 300.0)
    # absent query types read 0.0; repeated types are averaged
    assert (s["b"]["carrier_lookup_ms"], s["b"]["allele_freq_ms"]) == (20.0, 0.0)
    assert s["b"]["cost_per_query"].startswith("$2.5")
    r = querylog.bench_ranking(log).collect()
    assert [x["strategy"] for x in r] == ["b", "a"]
    assert r[1]["composite_latency_ms"] == 200.0


def test_scaling_groups_by_size_and_store(spark):
    log = _log(spark, [("a", "allele_frequency", 10, 30.0, 2 ** 21),
                       ("a", "allele_frequency", 50, 60.0, 2 ** 22),
                       ("a", "carrier_lookup", 50, 30.0, 0)])
    rows = {(r["cohort_size"], r["strategy"]): r for r in querylog.bench_scaling(log).collect()}
    assert rows[(10, "a")]["composite_latency_ms"] == 10.0 and rows[(10, "a")]["mb_scanned"] == 2.0
    assert rows[(50, "a")]["composite_latency_ms"] == 30.0


def test_contig_partitioning(spark, tmpdir_path):
    cols = ("reference_name string, start long, end_pos long, reference_bases string, "
            "alternate_bases string, sample_id string, genotype string, qual double, "
            "filter string, dp int, gq int, allele_depth string, attributes string, "
            "cohort_id string, engine string")
    rows = [("chr21", 1, 1, "A", "G", "s1", "0/1", 1.0, "PASS", 1, 1, "", "{}", "c", "e"),
            ("chr21", 2, 2, "A", "G", "s1", "0/1", 1.0, "PASS", 1, 1, "", "{}", "c", "e"),
            ("chr22", 3, 3, "A", "G", "s1", "0/1", 1.0, "PASS", 1, 1, "", "{}", "c", "e")]
    root = os.path.join(tmpdir_path, "parts")
    writers.write_batch(spark.createDataFrame(rows, cols), root, batch_id="b1")
    dirs = sorted(d for d in os.listdir(f"{root}/batch_id=b1/part_id=0") if d.startswith("reference_name="))
    assert dirs == ["reference_name=chr21", "reference_name=chr22"]
    got = {r["reference_name"]: r["count"] for r in
           tables.read_warehouse(spark, root).groupBy("reference_name").count().collect()}
    assert got == {"chr21": 2, "chr22": 1}
