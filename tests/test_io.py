"""Writers / readers with declared schemas, feed stream, synthetic cohort."""

import json
import os

import pytest
from pyspark.sql import functions as F

from allelic.operators import synth
from allelic.schema import CALL_COLUMNS
from allelic.sinks import writers
from allelic.sources import fixtures as fx
from allelic.sources import tables
from allelic.streaming.ingest import ingest_feed_stream
from conftest import SF_SMALL, write_text


def test_json_array_and_end_column(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "arr.json")
    with open(p, "w") as f:
        json.dump([{"reference_name": "chr1", "start": 5, "end": 5, "sample_id": "a",
                    "genotype": "0/1", "dp": 3}], f)
    df = tables.read_calls_json(spark, p, multiline=True)
    r = df.first()
    assert df.columns == CALL_COLUMNS and r["start"] == 5 and r["genotype"] == "0/1"
    assert r["end_pos"] == 5


def test_parquet_files_with_either_end_column(spark, tmpdir_path):
    rows = [("chr1", 5, 6), ("chr2", 8, 9)]
    for k, name in enumerate(("end", "end_pos")):
        df = spark.createDataFrame(rows[k:k + 1], f"reference_name string, start long, {name} long")
        df.write.parquet(f"{tmpdir_path}/mixed/batch_id=00{k}")
    got = tables.read_calls_parquet(spark, f"{tmpdir_path}/mixed").orderBy("start").collect()
    assert [(r["end_pos"], r["batch_id"]) for r in got] == [(6, "000"), (9, "001")]


def test_csv_export_has_header(spark, tmpdir_path):
    person = fx.person(spark, SF_SMALL)
    out = writers.write_csv(person, os.path.join(tmpdir_path, "csv"))
    first = [f for f in os.listdir(out) if f.endswith(".csv")][0]
    with open(os.path.join(out, first)) as f:
        assert f.readline().strip().startswith("person_id,gender_concept_id")
    back = tables.read_person_csv(spark, out)
    assert back.count() == person.count()
    assert dict(back.dtypes)["person_id"] == "bigint"


def test_condition_date_stays_text(spark, tmpdir_path):
    out = writers.write_csv(fx.condition_occurrence(spark, SF_SMALL),
                            os.path.join(tmpdir_path, "cond"))
    back = tables.read_conditions_csv(spark, out)
    assert dict(back.dtypes)["condition_start_date"] == "string"


def test_feed_stream(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "feed_src")
    calls = fx.variants(spark, SF_SMALL).where(F.col("reference_name") == "chr21")
    calls.write.json(src)
    root = os.path.join(tmpdir_path, "feed_tbl")
    ingest_feed_stream(spark, src, root, os.path.join(tmpdir_path, "feed_ckpt"), "delta_lake")
    got = tables.read_warehouse(spark, root)
    assert got.count() == calls.count()
    assert {r[0] for r in got.select("engine").distinct().collect()} == {"delta_lake"}


def test_two_feed_streams_add_up_and_default_the_cohort(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "two_feeds")
    for k in range(2):
        src = os.path.join(tmpdir_path, f"src{k}")
        os.makedirs(src)
        with open(f"{src}/a.json", "w") as f:
            f.write(json.dumps({"reference_name": "chr1", "start": k, "end": k + 1, "cohort_id": "own"}) + "\n")
            f.write(json.dumps({"reference_name": "chr1", "start": 10 + k}) + "\n")
        ingest_feed_stream(spark, src, root, os.path.join(tmpdir_path, f"ck{k}"), f"store{k}")
    got = {(r["start"], r["cohort_id"], r["engine"], r["end_pos"])
           for r in tables.read_warehouse(spark, root).collect()}
    assert got == {(0, "own", "store0", 1), (10, "online_feed", "store0", None),
                   (1, "own", "store1", 2), (11, "online_feed", "store1", None)}


def test_stream_files_of_one_batch_add_up(spark, tmpdir_path):
    from allelic.streaming.ingest import ingest_vcf_stream
    src, root = os.path.join(tmpdir_path, "land"), os.path.join(tmpdir_path, "t")
    os.makedirs(f"{src}/batch_001")
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"
    for k in range(3):
        write_text(f"{src}/batch_001/f{k}.vcf", [head, f"chr1\t{k + 1}\t.\tA\tG\t.\tPASS\t.\tGT\t0/1"])
    ingest_vcf_stream(spark, src, root, os.path.join(tmpdir_path, "ck"))  # one file a trigger
    assert sorted(r["start"] for r in tables.read_warehouse(spark, root).collect()) == [1, 2, 3]


def test_stream_needs_a_batch_id(spark, tmpdir_path):
    import pytest
    from allelic.streaming.ingest import ingest_vcf_stream
    src = os.path.join(tmpdir_path, "free")
    os.makedirs(src)
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1"
    for name in ("site_a_run1.vcf", "site_b_run2.vcf"):
        write_text(f"{src}/{name}", [head, "chr1\t7\t.\tA\tG\t.\tPASS\t.\tGT\t0/1"])
    with pytest.raises(Exception, match="no batch id"):
        ingest_vcf_stream(spark, src, f"{tmpdir_path}/t1", os.path.join(tmpdir_path, "ck1"))
    ingest_vcf_stream(spark, src, f"{tmpdir_path}/t2", os.path.join(tmpdir_path, "ck2"), batch_id="7")
    got = tables.read_warehouse(spark, f"{tmpdir_path}/t2").collect()
    assert [(r["start"], r["batch_id"]) for r in got] == [(7, "7"), (7, "7")]


def test_replay_drops_contigs_that_are_gone(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "replayed")
    rows = spark.createDataFrame([("chr1", 1), ("chr5", 2)], "reference_name string, start long")
    full = tables.conform_calls(rows)
    writers.write_batch(full, root, batch_id="001")
    writers.write_batch(full, root, batch_id="002")
    writers.write_batch(full.where("reference_name = 'chr1'"), root, batch_id="001")
    got = sorted((r["batch_id"], r["reference_name"]) for r in tables.read_warehouse(spark, root).collect())
    assert got == [("001", "chr1"), ("002", "chr1"), ("002", "chr5")]


def test_sample_ids_above_six_digits_stay_distinct(spark):
    keys = spark.range(999_998, 1_000_012)
    names = keys.select(fx.sample_name(F.col("id")).alias("s")).distinct()
    assert names.count() == 14
    assert fx.sample_name and keys.select(fx.sample_name(F.lit(7)).alias("s")).first()["s"] == "sample_000007"


def test_shared_folder_is_required_off_local_mode(monkeypatch):
    import pytest
    from allelic import session

    class Sc:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: {})
        getCheckpointDir = staticmethod(lambda: None)

    class Spark:
        sparkContext = Sc
        conf = {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark)


def test_synthetic_calls_distribution_and_determinism(spark):
    skel = fx.variants(spark, SF_SMALL)
    a = synth.synthetic_calls(skel)
    b = synth.synthetic_calls(skel.repartition(7))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    benign = a.where(F.get_json_object("attributes", "$.clnsig") == "BENIGN")
    n = benign.count()
    hom = benign.where(F.col("genotype") == "1/1").count() / n
    het = benign.where(F.col("genotype") == "0/1").count() / n
    assert 0.15 < hom < 0.25 and 0.30 < het < 0.40
    bad = a.where((F.col("genotype") == "0/1") & ~F.col("dp").between(28, 65)).count()
    assert bad == 0


def test_batch_stats_beside_batch(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "wh_stats")
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    b1 = calls.where(F.col("batch_id") == "001").drop("batch_id")
    writers.write_batch(b1, root, batch_id="001", stats=True)
    st = spark.read.parquet(os.path.join(root, "_stats"))
    assert st.groupBy().sum("num_records").first()[0] == b1.count()
    assert st.where(F.col("min_start") > F.col("max_start")).count() == 0
    # the stats folder is invisible to table reads
    assert tables.read_warehouse(spark, root).count() == b1.count()


def test_lookup_by_stats_reads_only_covering_files(spark, tmpdir_path):
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    root = f"{tmpdir_path}/stats"
    for b in ("001", "002"):
        writers.write_batch(calls.where(F.col("batch_id") == b), root, partitions=12, stats=True)
    every = writers.written_files(spark, root).count()
    got = writers.lookup_by_stats(spark, root, fx.TARGET_CONTIG, fx.TARGET_START)
    assert 0 < len(got.inputFiles()) < every / 4
    assert got.count() == calls.where((F.col("reference_name") == fx.TARGET_CONTIG) & (F.col("start") == fx.TARGET_START)).count() > 0
    one = got.agg(F.min("sample_id")).first()[0]
    assert writers.lookup_by_stats(spark, root, fx.TARGET_CONTIG, fx.TARGET_START, one).count() == 1
    assert writers.lookup_by_stats(spark, root, "chr99", 1).count() == 0
    writers.write_batch(calls.limit(5), root, "003")
    with pytest.raises(ValueError, match="no file statistics"):
        writers.lookup_by_stats(spark, root, fx.TARGET_CONTIG, fx.TARGET_START)


def test_bundle_keeps_schemas(spark, tmpdir_path):
    a = spark.createDataFrame([(1, None, 2.5), (2, "x", None)], "n int, s string, d double")
    empty = a.where("n > 9")
    path = writers.write_bundle({"a": a, "none": empty}, f"{tmpdir_path}/bundle")
    back = writers.read_bundle(spark, path, "a")
    assert back.schema == a.schema and sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, a.collect()), key=str)
    assert writers.read_bundle(spark, path, "none").collect() == []
    with pytest.raises(ValueError, match="no result"):
        writers.read_bundle(spark, path, "b")


def test_shards_are_sized_from_counts(spark, tmpdir_path):
    from allelic.sinks.vcf import shard_width, write_vcf
    from allelic.sources.vcf import read_vcf
    calls = fx.variants(spark, SF_SMALL).where("reference_name = 'chr21'")
    assert shard_width(calls.where("start < 0")) > 0
    width = shard_width(calls, 300)
    write_vcf(calls, f"{tmpdir_path}/sized", width)
    lines = spark.read.text(f"{tmpdir_path}/sized").withColumn("file", F.input_file_name())
    cells = lines.where("value not like '#%'").groupBy("file").agg(F.sum(F.size(F.split("value", "\t")) - 9).alias("n"))
    assert cells.count() > 3 and cells.agg(F.max("n")).first()[0] <= 900
    assert read_vcf(spark, f"{tmpdir_path}/sized").count() == calls.count()


def test_kept_result_is_not_read_again(spark):
    from allelic.operators import browse
    kept = browse.keep_result(browse.browse_variants(fx.variants(spark, SF_SMALL), contig="chr21", limit=500))
    n = kept.count()
    one = browse.refilter(kept, sample_id=kept.first()["sample_id"])
    assert "InMemoryTableScan" in one._jdf.queryExecution().executedPlan().toString() and 0 < one.count() < n
    assert browse.refilter(kept, contig="chr1").count() == 0
    kept.unpersist()


def test_same_headers_stand_once(spark, tmpdir_path):
    """Many files with one header: calls are not shuffled, also where files
    times samples pass the limit; with many headers the shuffle join agrees."""
    from allelic.sources.vcf import read_vcf
    for k in range(6):
        names = [f"S{j}" for j in range(5)] if k < 5 else ["T1", "T2", "T3"]
        with open(f"{tmpdir_path}/f{k}.vcf", "w") as f:
            f.write("\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split() + names) + "\n")
            f.write("\n".join("\t".join(["chr1", str(100 * k + r), ".", "A", "G", "9", "PASS", ".", "GT", *["0/1"] * len(names)]) for r in range(4)) + "\n")
    whole = read_vcf(spark, tmpdir_path, max_broadcast_samples=8)  # 8 distinct of 28
    assert whole.count() == 4 * 28
    p = whole._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    other = read_vcf(spark, tmpdir_path, max_broadcast_samples=7)
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, whole.collect()))


def test_json_lines_are_compressed_and_bounded(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(writers, "MAX_JSON_RECORDS_PER_FILE", 500)
    calls = fx.variants(spark, SF_SMALL)
    bytes_of = lambda p: sum(os.path.getsize(f"{p}/{f}") for f in os.listdir(p) if f.startswith("part-"))
    small = writers.write_json(calls, f"{tmpdir_path}/small")
    plain = writers.write_json(calls, f"{tmpdir_path}/plain", compression="none")
    assert bytes_of(small) * 4 < bytes_of(plain)
    assert len([f for f in os.listdir(small) if f.endswith(".json.gz")]) >= calls.count() / 500
    back = tables.read_calls_json(spark, small)
    assert back.exceptAll(calls).count() == 0 and back.count() == calls.count()
