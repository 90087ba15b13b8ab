"""Packing of small files, the Z curve, hot and warm tiers."""

import hashlib
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from allelic import registry
from allelic.plans import tiers
from allelic.plans.layout import cluster, compact_small, diff_counts, splitters, z_key
from allelic.schema import CALL_COLUMNS
from allelic.sinks import writers
from allelic.sources import fixtures as fx
from allelic.sources import tables
from conftest import SF_SMALL


def files(root):
    out = {}
    for d, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{d}/{n}", "rb") as f:
                    out[os.path.relpath(f"{d}/{n}", root)] = hashlib.md5(f.read()).hexdigest()
    return out


def same(a, b):
    d = diff_counts(a.select(*CALL_COLUMNS), b.select(*CALL_COLUMNS)).first()
    return d["left_only"] == d["right_only"] == 0 and d["left_rows"] > 0


def test_only_small_files_are_rewritten(spark, tmpdir_path):
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    src, dst = f"{tmpdir_path}/src", f"{tmpdir_path}/dst"
    part = F.when(F.col("sample_id") < "sample_000100", "big").otherwise(F.concat(F.lit("p"), F.substring("sample_id", 12, 2)))
    writers.write_batches(calls.withColumn("part_id", part), src, partitions=1)
    sizes = {p: os.path.getsize(f"{src}/{p}") for p in files(src)}
    small = sorted(sizes.values())[len(sizes) * 3 // 4]
    report = compact_small(spark, src, dst, target_bytes=4 * small, small_bytes=small).collect()
    before, after = files(src), files(dst)
    large = {p: h for p, h in before.items() if sizes[p] >= small}
    assert large and large.items() <= after.items()  # byte for byte
    assert len(after) < len(before) / 2
    assert sum(r.copied + r.rewritten for r in report) == len(before) and sum(r.copied for r in report) >= len(large)
    assert same(calls, tables.read_warehouse(spark, dst))
    # the result is a table: a batch can be appended
    writers.write_batch(calls.limit(10), dst, "003")
    assert tables.read_warehouse(spark, dst).count() == calls.count() + 10


def test_nothing_small_or_nothing_large(spark, tmpdir_path):
    calls = fx.variants(spark, SF_SMALL, with_batch=True).where("reference_name in ('chr1', 'chr2')")
    src = f"{tmpdir_path}/src"
    writers.write_batches(calls.withColumn("part_id", F.substring("sample_id", 12, 2)), src)
    compact_small(spark, src, f"{tmpdir_path}/copy", small_bytes=0)
    assert files(f"{tmpdir_path}/copy") == files(src)
    compact_small(spark, src, f"{tmpdir_path}/one", small_bytes=1 << 40, target_bytes=1 << 40)
    assert len(files(f"{tmpdir_path}/one")) == 4 and same(calls, tables.read_warehouse(spark, f"{tmpdir_path}/one"))


def reads(root, column, value):
    """Files whose statistics cannot rule the value out."""
    n = 0
    for p in files(root):
        meta = pq.ParquetFile(f"{root}/{p}").metadata
        at = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        n += any(s.min <= value <= s.max for s in stats)
    return n


def test_both_lookups_skip_files_on_the_curve(spark, tmpdir_path):
    n = 40_000
    calls = spark.range(n).select(
        F.lit("chr1").alias("reference_name"), (F.col("id") % 200 * 100).alias("start"), F.concat(F.lit("s"), F.lpad(F.expr("id div 200").cast("string"), 4, "0")).alias("sample_id"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("end_pos", "long"), ("reference_bases", "string"), ("alternate_bases", "string"), ("genotype", "string"),
          ("qual", "double"), ("filter", "string"), ("dp", "int"), ("gq", "int"), ("allele_depth", "string"), ("cohort_id", "string"), ("engine", "string"))],
        F.lit("{}").alias("attributes"), F.lit("b").alias("batch_id"))
    curve, plain = f"{tmpdir_path}/curve", f"{tmpdir_path}/plain"
    cluster(calls, curve, files=64)
    writers.write_batch(calls, plain, "b", partitions=64)
    assert len(files(curve)) >= 48 and same(calls, tables.read_warehouse(spark, curve))
    by_start, by_sample = reads(curve, "start", 5000), reads(curve, "sample_id", "s0100")
    assert by_start <= len(files(curve)) / 3 and by_sample <= len(files(curve)) / 3
    assert by_sample < reads(plain, "sample_id", "s0100")


def test_z_key_interleaves_ranks(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in "abcd"], "x long, y string")
    got = {(r.x, r.y): r.z for r in df.select("x", "y", z_key(["x", "y"], [[1, 2, 3], ["b", "c", "d"]], 2).alias("z")).collect()}
    assert [got[k] for k in [(0, "a"), (0, "b"), (1, "a"), (1, "b"), (0, "c"), (2, "a"), (3, "d")]] == [0, 1, 2, 3, 4, 8, 15]
    assert splitters(df.where("x > 9"), "x", 8) == [] and splitters(df, "x", 4) == [1, 2, 3]


# --- tiers ---------------------------------------------------------------------

def test_tiers_follow_appends_replays_and_compaction(spark, tmpdir_path):
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    root = f"{tmpdir_path}/tiers"
    one, two = calls.where("batch_id = '001'"), calls.where("batch_id = '002'")
    again = one.where("reference_name <> 'chr5' and sample_id <> 'sample_000001'")
    for part in (one, two, again):
        tiers.append_tiered(part, root)
    now = again.unionByName(two)
    hot = now.where("genotype in ('0/1', '1/1') and get_json_object(attributes, '$.clnsig') = 'PATHOGENIC'")
    for place in (root, tiers.compact_tiered(spark, root, f"{tmpdir_path}/compacted")):
        covered = tiers.read_tiered(spark, place, {**tiers.CLINICAL, "reference_name": "chr21"})
        assert same(hot.where("reference_name = 'chr21'"), covered)
        assert all("/hot/" in f for f in covered.inputFiles())
        narrow = tiers.read_tiered(spark, place, {"clinical_significance": "PATHOGENIC", "genotype": ["1/1"]})
        assert same(hot.where("genotype = '1/1'"), narrow) and all("/hot/" in f for f in narrow.inputFiles())
        for asked in ({"clinical_significance": "PATHOGENIC"}, {"reference_name": "chr21"}, {**tiers.CLINICAL, "genotype": ["0/0", "1/1"]}):
            assert all("/warm/" in f for f in tiers.read_tiered(spark, place, asked).inputFiles())
        assert same(now, tiers.read_tiered(spark, place, {}))


def test_incomplete_hot_tier_is_not_read(spark, tmpdir_path, monkeypatch):
    """A job that fails between the tiers leaves readers on the warm one."""
    calls = fx.variants(spark, SF_SMALL, with_batch=True)
    root = f"{tmpdir_path}/tiers"
    tiers.append_tiered(calls.where("batch_id = '001'"), root)
    held, done = tiers.write_batch, []

    def failing(df, path, *a, **b):
        if path.endswith("/hot"):
            raise RuntimeError("lost")
        done.append(path)
        return held(df, path, *a, **b)

    monkeypatch.setattr(tiers, "write_batch", failing)
    for batch in ("002", "001"):  # a new part, then one that the hot tier had
        with pytest.raises(RuntimeError):
            tiers.append_tiered(calls.where(f"batch_id = '{batch}'"), root)
        df = tiers.read_tiered(spark, root, tiers.CLINICAL)
        assert all("/warm/" in f for f in df.inputFiles()) and df.count() > 0
    monkeypatch.setattr(tiers, "write_batch", held)
    for batch in ("001", "002"):
        tiers.append_tiered(calls.where(f"batch_id = '{batch}'"), root)
    assert all("/hot/" in f for f in tiers.read_tiered(spark, root, tiers.CLINICAL).inputFiles())
    with pytest.raises(ValueError, match="route by"):
        tiers.append_tiered(calls, root, "003", rule={"filter": ["PASS"]})


def test_parts_without_hot_calls(spark, tmpdir_path):
    calls = fx.variants(spark, SF_SMALL, with_batch=True).where("genotype = '0/0'")
    root = tiers.append_tiered(calls, f"{tmpdir_path}/tiers", "001")
    assert tiers.read_tiered(spark, root, tiers.CLINICAL).count() == 0


def test_covered():
    rule = {"a": ["x", "y"], "b": ["z"]}
    assert tiers.covered({"a": "x", "b": ["z"], "c": 1}, rule) and tiers.covered({}, {})
    assert not any(tiers.covered(f, rule) for f in ({"a": "x"}, {"a": ["x", "w"], "b": "z"}, {"a": [], "b": "z"}, {"a": None, "b": "z"}))


def test_annotations_are_taken_behind_the_shuffle(spark, monkeypatch):
    """The range layout runs its input twice; JSON is not among it.  The hot
    tier reads the part that the warm one has."""
    plan = writers._laid_out(fx.variants(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "get_json_object" in plan.split("rangepartitioning")[0] and "get_json_object" not in plan.split("rangepartitioning")[1]


def test_hot_tier_is_written_from_the_warm_part(spark, tmpdir_path, monkeypatch):
    held, read = tiers.write_batch, {}

    def seen(df, path, *a, **b):
        read[path.rpartition("/")[2]] = df.inputFiles()
        return held(df, path, *a, **b)

    monkeypatch.setattr(tiers, "write_batch", seen)
    for batch in ("001", "002"):
        tiers.append_tiered(fx.variants(spark, SF_SMALL, with_batch=True).where(f"batch_id = '{batch}'"), f"{tmpdir_path}/tiers")
        assert read["hot"] and all(f"/warm/batch_id={batch}/part_id=0/" in f for f in read["hot"])


def test_writers_get_calls_that_are_joined_once(spark, monkeypatch):
    held, plans = writers.write_batch, []

    def seen(df, *a, **b):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return held(df, *a, **b)

    monkeypatch.setattr(writers, "write_batch", seen)
    monkeypatch.setattr(tiers, "write_batch", seen)
    for name in ("replay_equal", "tier_lookup"):
        registry.REGISTRY[name](spark, SF_SMALL)
    assert len(plans) == 9 and not [p for p in plans if "Join" in p]
