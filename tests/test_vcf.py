"""VCF parsing rules on inline files (every rule of the reader's contract)."""

import json
import os

import pytest

from allelic.sinks.vcf import write_vcf
from allelic.sources.vcf import read_vcf, read_vcf_rejects, vcf_samples
from conftest import write_text

HDR = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2"


def _rows(df):
    return {(r["reference_name"], r["start"], r["sample_id"]): r.asDict() for r in df.collect()}


def test_basic_two_samples(spark, tmpdir_path):
    p = write_text(os.path.join(tmpdir_path, "a.vcf"), [
        "##source=made by this test", HDR,
        "\t".join(["chr7", "5530600", ".", "CTT", "C", "61.5", "q20", "DP=18;GENE=ACTB;SOMATIC", "GT:GQ:DP:AD",
                   "1/1:44:18:1,17", "0/1:51:22:12,10"])])
    df = read_vcf(spark, p)
    rows = _rows(df)
    assert len(df.columns) == 15 and set(rows) == {("chr7", 5530600, "S1"), ("chr7", 5530600, "S2")}
    first, second = rows["chr7", 5530600, "S1"], rows["chr7", 5530600, "S2"]
    assert (first["genotype"], first["dp"], first["gq"], first["allele_depth"]) == ("1/1", 18, 44, "1,17")
    assert (second["genotype"], second["dp"], second["gq"], second["allele_depth"]) == ("0/1", 22, 51, "12,10")
    assert first["end_pos"] == 5530602 and first["qual"] == 61.5 and first["filter"] == "q20"
    assert json.loads(second["attributes"]) == {"dp": "18", "gene": "ACTB", "somatic": "true"}
    assert (first["cohort_id"], first["engine"]) == ("synthetic_v1", "s3_tables")


def test_edge_cases(spark, tmpdir_path):
    lines = [
        "##meta", HDR, "",
        # QUAL '.', DP '.', upper-case contig, INFO flag + '=' inside value + duplicate key
        "CHRX\t100\t.\tATG\tA\t.\tPASS\tDB;K=a=b;GENE=X;gene=Y\tGT:DP:GQ:AD\t./.:.:.:.\t0|1:12:7",
        # FORMAT longer than sample field (truncate), multi-allelic
        "chr1\t200\t.\tC\tA,T\t50\tq10\t.\tGT:DP:GQ:AD:PL\t1/2:9\t1/1:-3:x:1,2",
        # too few fields: skipped
        "chr1\t300\t.\tC\tA\t50\tPASS\t.\tGT\t0/1",
        # extra fields ignored
        "chr1\t400\t.\tC\tA\t50\tPASS\t.\tGT\t0/1\t1/1\textra",
        "   ",
    ]
    p = write_text(os.path.join(tmpdir_path, "b.vcf"), lines)
    rows = _rows(read_vcf(spark, p))
    assert len(rows) == 6
    a = rows[("chrx", 100, "S1")]
    assert a["qual"] == 0.0 and a["dp"] == 0 and a["gq"] == 0 and a["genotype"] == "./."
    assert a["end_pos"] == 102
    attrs = json.loads(a["attributes"])
    assert attrs["db"] == "true" and attrs["k"] == "a=b" and attrs["gene"] == "Y"
    b = rows[("chrx", 100, "S2")]
    assert b["genotype"] == "0|1" and b["dp"] == 12 and b["gq"] == 7 and b["allele_depth"] == ""
    c = rows[("chr1", 200, "S1")]
    assert c["genotype"] == "1/2" and c["dp"] == 9 and c["gq"] == 0 and c["allele_depth"] == ""
    assert c["alternate_bases"] == "A,T" and json.loads(c["attributes"]) == {".": "true"}
    d = rows[("chr1", 200, "S2")]
    assert d["dp"] == 0 and d["gq"] == 0 and d["allele_depth"] == "1,2"
    assert ("chr1", 300, "S1") not in rows
    rej = read_vcf_rejects(spark, p).collect()
    assert [(r["n_fields"], r["expected_fields"]) for r in rej] == [(10, 11)]
    assert rows[("chr1", 400, "S2")]["genotype"] == "1/1"


def test_header_without_samples(spark, tmpdir_path):
    p = write_text(os.path.join(tmpdir_path, "c.vcf"), [
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT", "chr1\t1\t.\tA\tC\t1\tPASS\t.\tGT"])
    assert read_vcf(spark, p).count() == 0


def test_missing_header_raises(spark, tmpdir_path):
    p = write_text(os.path.join(tmpdir_path, "d.vcf"), ["chr1\t1\t.\tA\tC\t1\tPASS\t.\tGT\t0/1"])
    with pytest.raises(ValueError, match="No '#CHROM' header|before the '#CHROM' header"):
        read_vcf(spark, p)


def test_missing_file_raises(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        read_vcf(spark, os.path.join(tmpdir_path, "nope.vcf"))


def test_gzip_and_multi_file_headers(spark, tmpdir_path):
    a = write_text(os.path.join(tmpdir_path, "a.vcf.gz"), [
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA1",
        "chr2\t5\t.\tG\tT\t9\tPASS\t.\tGT\t0/1"], gz=True)
    b = write_text(os.path.join(tmpdir_path, "b.vcf"), [
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tB1\tB2",
        "chr2\t5\t.\tG\tT\t9\tPASS\t.\tGT\t1/1\t0/0"])
    rows = _rows(read_vcf(spark, [a, b]))
    assert {k[2] for k in rows} == {"A1", "B1", "B2"}
    assert rows[("chr2", 5, "B1")]["genotype"] == "1/1"
    s = vcf_samples(spark, [a, b]).collect()
    assert sorted(r["sample_id"] for r in s) == ["A1", "B1", "B2"]


def test_shuffle_header_path_equals_broadcast(spark, tmpdir_path):
    p = write_text(os.path.join(tmpdir_path, "e.vcf"), [
        HDR, "chr3\t7\t.\tA\tC\t1\tPASS\tGENE=Q\tGT:DP\t0/1:4\t1/1:5",
        "chr3\t8\t.\tA\tC\t1\tPASS\t.\tGT:DP\t0/0:1\t./.:2"])
    a = read_vcf(spark, p)
    b = read_vcf(spark, p, max_broadcast_samples=0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_writer_round_trip(spark, tmpdir_path):
    p = write_text(os.path.join(tmpdir_path, "f.vcf"), [
        HDR, "chr3\t7\t.\tA\tC\t1.5\tPASS\tGENE=Q;CLNSIG=VUS\tGT:DP:GQ:AD\t0/1:4:9:2,2\t1/1:5:9:0,5",
        "chr3\t8\t.\tA\tC\t2.0\tPASS\tGENE=Q\tGT:DP:GQ:AD\t0/0:1:3:1,0\t0/0:2:3:2,0"])
    calls = read_vcf(spark, p)
    out = os.path.join(tmpdir_path, "out")
    write_vcf(calls, out)
    back = read_vcf(spark, out)
    cols = ["reference_name", "start", "sample_id", "genotype", "dp", "gq", "allele_depth", "qual"]
    assert sorted(map(tuple, calls.select(cols).collect())) == \
        sorted(map(tuple, back.select(cols).collect()))
    got = {r["start"]: json.loads(r["attributes"]) for r in back.collect()}
    assert got[7] == {"gene": "Q", "clnsig": "VUS"}


def test_writer_fills_missing_cells_and_the_reader_leaves_them_out(spark, tmpdir_path):
    """A sample without a call has a cell, as the format asks, and no call."""
    df = spark.createDataFrame(
        [("chr1", 10, 10, "A", "G", "s1", "0/1", 9.0, "PASS", 5, 6, "2,3", "{}", "c", "e"),
         ("chr1", 20, 20, "A", "G", "s2", "1/1", 9.0, "PASS", 5, 6, "0,5", "{}", "c", "e")],
        "reference_name string, start long, end_pos long, reference_bases string, "
        "alternate_bases string, sample_id string, genotype string, qual double, filter string, "
        "dp int, gq int, allele_depth string, attributes string, cohort_id string, engine string")
    out = os.path.join(tmpdir_path, "dense")
    write_vcf(df, out)
    cells = [r["value"].split("\t")[9:] for r in spark.read.text(out).where("value not like '#%'").collect()]
    assert sorted(cells) == [[".", "1/1:5:6:0,5"], ["0/1:5:6:2,3", "."]]
    for limit in (10, 0):
        back = {(r["start"], r["sample_id"]): r for r in read_vcf(spark, out, max_broadcast_samples=limit).collect()}
        assert set(back) == {(10, "s1"), (20, "s2")}
        assert back[(20, "s2")]["genotype"] == "1/1"
        # Empty INFO is written as '.', which the reader keeps as the key '.'.
        assert json.loads(back[(10, "s1")]["attributes"]) == {".": "true"}


def test_lone_dots_of_other_files_are_calls(spark, tmpdir_path):
    p = write_text(os.path.join(tmpdir_path, "dots.vcf"), [HDR, "chr1\t7\t.\tA\tG\t.\tPASS\t.\tGT:DP\t.\t0/1:3"])
    assert {k[2]: r["genotype"] for k, r in _rows(read_vcf(spark, p)).items()} == {"S1": ".", "S2": "0/1"}
    other = write_text(os.path.join(tmpdir_path, "own.vcf"), [
        "##allelic_absent_cell=NA", HDR, "chr1\t7\t.\tA\tG\t.\tPASS\t.\tGT:DP\t.\tNA"])
    assert {(k[2], r["genotype"]) for k, r in _rows(read_vcf(spark, [other])).items()} == {("S1", ".")}
    assert len(_rows(read_vcf(spark, [p, other], max_broadcast_samples=0))) == 2


def test_null_fields_survive_the_writer(spark, tmpdir_path):
    from allelic.schema import CALLS
    rows = [("chr1", 5, 5, "A", "G", "s1", "0/1", None, None, 4, 5, "1,3", '{"gene":"X"}', "c", "e"),
            ("chr1", 6, 6, "A", "G", "s1", None, 2.0, "PASS", None, None, None, None, "c", "e"),
            ("chr1", 7, 7, "A", "G", "s1", ".", 2.0, "PASS", 1, 2, "", "{}", "c", "e")]
    write_vcf(spark.createDataFrame(rows, CALLS), f"{tmpdir_path}/nulls")
    back = {r["start"]: r for r in read_vcf(spark, f"{tmpdir_path}/nulls").collect()}
    assert set(back) == {5, 6, 7}
    assert (back[5]["qual"], back[5]["filter"], back[5]["genotype"], back[5]["allele_depth"]) == (0.0, ".", "0/1", "1,3")
    assert (back[6]["genotype"], back[6]["dp"], back[6]["gq"], back[6]["allele_depth"], back[6]["qual"]) == ("./.", 0, 0, "", 2.0)
    assert back[7]["genotype"] == "."


@pytest.mark.parametrize("by_prefix", [True, False])
def test_header_rules_on_both_ways(spark, tmpdir_path, monkeypatch, by_prefix):
    """Headers from file prefixes and from a scan follow the same rules."""
    import allelic.sources.vcf as vr
    if not by_prefix:
        monkeypatch.setattr(vr, "_prefix_readable", lambda uris: False)
    body = "chr1\t7\t.\tA\tG\t.\tPASS\t.\tGT\t0/1\t."
    two = HDR.replace("S1\tS2", "A1\tA0")
    first = write_text(os.path.join(tmpdir_path, "two.vcf"), ["##allelic_absent_cell=.", HDR, body, two, body])
    assert [(r["genotype"], r["sample_id"]) for r in read_vcf(spark, first).collect()] == [("0/1", "S1")] * 2
    early = write_text(os.path.join(tmpdir_path, "early.vcf"), [body, HDR, body])
    with pytest.raises(ValueError, match="before the '#CHROM' header"):
        read_vcf(spark, [first, early])
    none = write_text(os.path.join(tmpdir_path, "none.vcf"), ["##meta"])
    empty = write_text(os.path.join(tmpdir_path, "empty.vcf"), [])
    for p in (none, empty):
        with pytest.raises(ValueError, match="No '#CHROM' header"):
            vcf_samples(spark, [first, p])
        assert read_vcf(spark, [first, p], validate_headers=False).count() == 2


def test_writer_salted_sample_list_join(spark, tmpdir_path, monkeypatch):
    import allelic.sinks.vcf as vw
    p = write_text(os.path.join(tmpdir_path, "g.vcf"), [
        HDR, "chr3\t7\t.\tA\tC\t1.5\tPASS\tGENE=Q\tGT:DP:GQ:AD\t0/1:4:9:2,2\t1/1:5:9:0,5",
        "chr3\t8\t.\tA\tC\t2.0\tPASS\tGENE=Q\tGT:DP:GQ:AD\t0/0:1:3:1,0\t0/0:2:3:2,0"])
    calls = read_vcf(spark, p)
    a = sorted(r["line"] for r in vw.vcf_lines(calls).collect())
    monkeypatch.setattr(vw, "MAX_BROADCAST_SAMPLES", 0)
    b = sorted(r["line"] for r in vw.vcf_lines(calls).collect())
    assert a == b and len(a) == len(vw.META_LINES) + 1 + 2


def test_writer_places_cells_by_sample_and_refuses_two(spark, tmpdir_path):
    from allelic.schema import CALLS
    row = lambda s, gt, q: ("chr1", 100, 100, "A", "G", s, gt, q, "PASS", 9, 8, "9,0", '{"gene":"X"}', "c", "e")
    calls = [row("C", "0/1", 1.0), row("A", "1/1", 1.0), row("B", "0/0", 2.0)]
    write_vcf(spark.createDataFrame(calls, CALLS), f"{tmpdir_path}/v")
    back = read_vcf(spark, f"{tmpdir_path}/v").collect()
    assert {(r["sample_id"], r["genotype"], r["qual"]) for r in back} == {("A", "1/1", 1.0), ("B", "0/0", 2.0), ("C", "0/1", 1.0)}
    with pytest.raises(Exception, match="two calls of one sample at chr1:100"):
        write_vcf(spark.createDataFrame([*calls, row("A", "0/1", 1.0)], CALLS), f"{tmpdir_path}/w")


def test_sparse_calls_make_text_that_grows_with_them(spark, tmpdir_path):
    """Two of 800 samples have a call at a site: shards are narrow, and lines
    fill the gaps before, between and behind their calls."""
    from allelic.schema import CALLS
    from allelic.sinks.vcf import DEFAULT_BUCKET, MAX_FILL, shard_width
    rows = [("chr1", 1000 + 50 * k, 1000 + 50 * k, "A", "G", f"S{2 * k + j:04d}", "0/1", 1.0, "PASS", 9, 8, "5,4", '{"gene":"X"}', "synthetic_v1", "s3_tables")
            for k in range(400) for j in (0, 1)]
    calls = spark.createDataFrame(rows, CALLS)
    width = shard_width(calls)
    assert DEFAULT_BUCKET % shard_width(calls, within=DEFAULT_BUCKET) == 0 and shard_width(calls, within=DEFAULT_BUCKET) <= width
    write_vcf(calls, f"{tmpdir_path}/v", None)
    lines = [r.value.split("\t") for r in spark.read.text(f"{tmpdir_path}/v").where("value not like '#%'").collect()]
    assert len(lines) == 400 and sum(len(x) - 9 for x in lines) <= 2 * MAX_FILL * len(rows)
    assert sorted(map(tuple, read_vcf(spark, f"{tmpdir_path}/v").collect())) == sorted(rows)


def test_files_in_folders_of_their_own_are_listed_by_few_tasks_and_once(spark, tmpdir_path):
    """A folder a file: not a listing task a folder, and the session's settings
    stand as before."""
    import os

    from allelic.session import _LISTING, LISTING_TASKS
    for k in range(70):
        os.makedirs(f"{tmpdir_path}/v/bucket={k}")
        with open(f"{tmpdir_path}/v/bucket={k}/part-0", "w") as f:
            f.write("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\n" + f"chr1\t{k}\t.\tA\tG\t9\tPASS\t.\tGT\t0/1\n")
    sc, was = spark.sparkContext, spark.conf.get(_LISTING)
    sc.setJobGroup("listing", "listing")
    try:
        assert read_vcf(spark, f"{tmpdir_path}/v").count() == 70
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker, found = sc.statusTracker(), []
    for job in tracker.getJobIdsForGroup("listing"):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            found.append((info.name, info.numTasks))
    assert max(n for _, n in found) <= LISTING_TASKS * sc.defaultParallelism
    assert len([1 for name, _ in found if name.startswith("text at")]) == 1
    assert spark.conf.get(_LISTING) == was


def test_compressed_vcf_and_shards_of_calls_without_samples(spark, tmpdir_path):
    """A shard is dealt as calls, its header among them, and becomes text behind that."""
    import glob

    from allelic.schema import CALLS
    row = lambda contig, start, sample: (contig, start, start, "A", "G", sample, "0/1", 9.0, "PASS", 3, 4, "1,2", '{"gene":"X"}', "c", "e")
    calls = spark.createDataFrame([row("chr1", 5, "B"), row("chr1", 5, "A"), row("chr1", 7, "C"), row("chr1", 150, "A"), row("chr2", 5, None)], CALLS)
    write_vcf(calls.where("sample_id is not null"), f"{tmpdir_path}/v", 100, compression="gzip")
    files = glob.glob(f"{tmpdir_path}/v/reference_name=*/bucket=*/part-*")
    assert len(files) == 2 and all(f.endswith(".txt.gz") for f in files)
    back = read_vcf(spark, f"{tmpdir_path}/v").select("reference_name", "start", "sample_id", "genotype", "dp", "attributes").collect()
    assert sorted(map(tuple, back)) == [("chr1", *x, "0/1", 3, '{"gene":"X"}') for x in ((5, "A"), (5, "B"), (7, "C"), (150, "A"))]
    assert [(r.sample_index, r.sample_id) for r in vcf_samples(spark, files[:1] if "bucket=0" in files[0] else files[1:]).orderBy("sample_index").collect()] == [
        (0, "A"), (1, "B"), (2, "C")]
    write_vcf(calls, f"{tmpdir_path}/w", 100)
    text = sorted(r.value for r in spark.read.text(f"{tmpdir_path}/w").where("value not like '##%'").collect())
    from allelic.sinks.vcf import vcf_lines
    assert text == sorted(r.line for r in vcf_lines(calls, 100).where("line not like '##%'").collect())


def test_lines_come_from_calls_that_are_kept(spark):
    """The tables are joined once, not for the places and again for the lines."""
    from allelic import registry
    from conftest import SF_SMALL
    plan = registry.queries()["calls_to_vcf"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "attributes" in plan
