"""Operator semantics on small inline call tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from allelic.functions.cost import scan_cost
from allelic.operators import burden, browse, carriers, clinical, frequency, policy, summary
from allelic.operators.vds import split_vds, vds_to_calls
from allelic.plans.layout import diff_counts
from allelic.sinks.feed import feed

COLS = ("reference_name string, start long, end_pos long, reference_bases string, "
        "alternate_bases string, sample_id string, genotype string, qual double, filter string, "
        "dp int, gq int, allele_depth string, attributes string, cohort_id string, engine string")
A = '{"gene":"APP","clnsig":"PATHOGENIC"}'
B = '{"gene":"APP","clnsig":"BENIGN"}'


def call(start, sample, gt, attrs=A, flt="PASS", contig="chr21", dp=30):
    return (contig, start, start, "A", "G", sample, gt, 50.0, flt, dp, 90, "15,15", attrs,
            "c1", "s3_tables")


@pytest.fixture()
def calls(spark):
    rows = [call(100, "s1", "0/1"), call(100, "s2", "1/1"), call(100, "s3", "0/0"),
            call(100, "s4", "./."), call(100, "s5", "0|1"),
            call(200, "s1", "./.", B), call(200, "s2", "./.", B),
            call(300, "s1", "1/1", B, flt="LowQual"),
            call(400, "s9", "0/1", contig="chr17")]
    return spark.createDataFrame(rows, COLS)


def test_allele_frequency(calls):
    out = {r["start"]: r for r in frequency.allele_frequency(calls).collect()}
    assert set(out) == {100, 200}
    r = out[100]
    assert (r["carrier_sample_count"], r["allele_count"], r["allele_number"]) == (2, 3, 6)
    assert r["cohort_allele_frequency"] == 0.5
    # Only missing calls: AN = 0 and AF is null, not 0.
    assert out[200]["allele_number"] == 0 and out[200]["cohort_allele_frequency"] is None


def test_normalised_genotypes(calls):
    out = {r["start"]: r for r in frequency.allele_frequency(calls, normalise=True).collect()}
    assert out[100]["carrier_sample_count"] == 3


def test_carrier_frequency_top_ties(calls):
    rows = frequency.carrier_frequency(calls, top=2).collect()
    # tie at one carrier broken by contig name: chr17 < chr21
    assert [r["start"] for r in rows] == [100, 400]
    assert rows[0]["total_cohort_samples"] == 5 and rows[0]["carrier_frequency"] == 0.4


def test_carrier_lookup_and_gene_filter(calls):
    rows = carriers.carrier_lookup(calls, "chr21", 100).collect()
    assert [(r["sample_id"], r["zygosity"]) for r in rows] == [("s1", "HET"), ("s2", "HOM_ALT")]
    assert carriers.carrier_lookup(calls, "chr21", 100, gene="SOD1").count() == 0
    plain = carriers.carrier_lookup_plain(calls.withColumn("engine", F.lit(None).cast("string")),
                                          "chr21", 100, store_id="x").collect()
    assert {r["engine"] for r in plain} == {"x"}


def test_gene_burden(calls):
    rows = burden.gene_burden(calls, "APP", "chr21").collect()
    got = {r["sample_id"]: (r["distinct_variant_sites"], r["total_alt_allele_burden"],
                            r["pathogenic_variant_count"]) for r in rows}
    assert got == {"s1": (2, 3, 1), "s2": (1, 2, 1)}
    assert rows[0]["sample_id"] == "s1"
    # no contig filter: the chr17 carrier annotated APP counts too
    assert burden.gene_burden_plain(calls, "APP", None).count() == 3


def test_omop_join_labels(spark, calls):
    person = spark.createDataFrame([(1, 8507, 1970, "s1"), (2, 0, 1980, "s2"), (3, 8532, 1990, "s3")],
                                   "person_id long, gender_concept_id int, year_of_birth int, sample_id string")
    cond = spark.createDataFrame([(10, 1, 43530807, "2020-01-01"), (11, 1, 5, "2021-01-01")],
                                 "condition_occurrence_id long, person_id long, condition_concept_id int, "
                                 "condition_start_date string")
    rows = clinical.omop_phenotype_join(calls, person, cond, "chr21", 100).collect()
    assert len(rows) == 3
    labels = {(r["person_id"], r["condition_concept_id"]): (r["gender"], r["phenotype_label"])
              for r in rows}
    assert labels[(1, 43530807)] == ("MALE", "Early-onset Alzheimer Disease (Confirmed)")
    assert labels[(2, None)] == ("UNKNOWN", "Other Clinical Condition")


def test_browse_orders_and_refuses_bad_pages(calls):
    rows = browse.browse_variants(calls, contig="chr21", sample_id="All", limit=1000).collect()
    assert len(rows) == 8 and [r["start"] for r in rows] == sorted(r["start"] for r in rows)
    for limit in (0, -1, 1001):
        with pytest.raises(ValueError, match="page size"):
            browse.browse_variants(calls, limit=limit)


def test_summary_levels(calls):
    rows = {(r["level"], r["key"]): r["calls"] for r in summary.ingest_summary(calls).collect()}
    assert rows[("total", None)] == 9
    assert rows[("reference_name", "chr17")] == 1
    assert rows[("genotype", "./.")] == 3


def test_policy(calls):
    r = policy.researcher_view(calls)
    assert "sample_id" not in r.columns and len(r.columns) == 11
    with pytest.raises(Exception):
        r.select("sample_id").collect()
    m = policy.researcher_masked(calls)
    assert m.columns == calls.columns and m.where(F.col("sample_id").isNotNull()).count() == 0
    with pytest.raises(ValueError):
        policy.published(calls)
    for renamed in (calls.select(F.col("sample_id").alias("sid")), calls.select(F.col("sample_id").alias("qual"))):
        with pytest.raises(ValueError):
            policy.published(renamed)


def test_published_follows_lineage(spark, calls):
    ok = [
        frequency.allele_frequency(calls),
        frequency.carrier_frequency(calls, top=3),
        frequency.site_alt_frequency(calls),
        calls.withColumn("d", F.when(F.col("genotype") == "1/1", 2).otherwise(0)).groupBy("start").agg(F.sum("d").alias("allele_count")),
        calls.groupBy("start").agg(F.count_distinct("sample_id").alias("sample_count")),
        calls.groupBy("start").agg(F.avg("dp").alias("mean_depth")).union(calls.groupBy("start").agg(F.avg("gq").alias("x"))),
    ]
    for df in ok:
        assert policy.published(df) is df
    sid, gt = F.col("sample_id"), F.col("genotype")
    bad = [
        calls.groupBy(F.upper(sid).alias("gene_symbol")).agg(F.count("*").alias("sample_count")),
        calls.select(F.concat(sid, F.lit("")).alias("gene_symbol")),
        calls.select(F.sha2(sid, 256).alias("filter")),
        calls.groupBy("start").agg(F.array_join(F.collect_list("sample_id"), ",").alias("gene_symbol")),
        calls.groupBy("start").agg(F.max("sample_id").alias("gene_symbol")),
        calls.groupBy("start").agg(F.sum(F.xxhash64("sample_id")).alias("allele_count")),
        calls.groupBy("start").agg(F.first(F.struct("sample_id"))["sample_id"].alias("qual")),
        calls.groupBy(gt.alias("filter")).agg(F.count("*").alias("sample_count")),
        calls.select(F.col("filter")).union(calls.select(sid)),
        calls.select(F.when(gt == "1/1", F.lit("yes")).alias("filter")),
        calls.select(F.explode(F.array("sample_id")).alias("gene_symbol")),
        calls.select(F.lag("sample_id").over(Window.orderBy("start")).alias("gene_symbol")),
        calls.withColumn("x", sid).groupBy("x").agg(F.count("*").alias("sample_count")).select(F.col("x").alias("gene_symbol"), "sample_count"),
        calls.selectExpr("(select max(sample_id) from values ('a') t(sample_id)) as gene_symbol"),
        calls.select("sample_id").mapInPandas(lambda it: (f.rename(columns={"sample_id": "qual"}) for f in it), "qual string"),
    ]
    for df in bad:
        with pytest.raises(ValueError, match="withheld"):
            policy.published(df)


def test_vds_keeps_depth_text(spark, calls):
    depths = [".", "9,.", "", None, "07,1", "3,4", "99999999999,1", ",", "1", " 2,3"]
    rows = [call(100 + k, "s1", gt)[:11] + (d, A, "c1", "e") for k, d in enumerate(depths) for gt in ("0/0", "0/1")]
    df = spark.createDataFrame(rows, COLS)
    for mode in (False, True):
        back = vds_to_calls(*split_vds(df, compat=mode))
        got = sorted((r.start, str(r.allele_depth)) for r in back.collect())
        assert got == sorted((100 + k, str(d)) for k, d in enumerate(depths) for _ in range(2))
    d = diff_counts(df, vds_to_calls(*split_vds(df))).first()
    assert (d["left_only"], d["right_only"]) == (0, 0)


def test_vds_split_and_back(calls):
    var, ref = split_vds(calls)
    assert ref.count() == 1 and var.count() == 8
    back = vds_to_calls(var, ref)
    cols = ["reference_name", "start", "sample_id", "genotype", "dp", "gq", "allele_depth"]
    d = diff_counts(calls.select(cols), back.select(cols)).first()
    assert (d["left_only"], d["right_only"]) == (0, 0)
    cvar, cref = split_vds(calls, compat=True)
    assert cvar.count() == 4 and cref.where(F.col("call") != "0/0").count() == 0


def test_diff_counts_bag_semantics(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    d = diff_counts(a, b).first()
    assert (d["left_rows"], d["right_rows"], d["left_only"], d["right_only"]) == (3, 2, 2, 1)


def test_feed_keeps_present_cohort(calls):
    recs = calls.limit(2).drop("cohort_id")
    out = feed(calls, recs, "store_x")
    assert out.count() == 11
    assert out.where(F.col("cohort_id") == "online_feed").count() == 2
    assert out.where(F.col("engine") == "store_x").count() == 2


def test_scan_cost_floor(spark):
    df = spark.createDataFrame([(0,), (2 ** 40,)], "b long")
    got = [r[0] for r in df.select(scan_cost(F.col("b"))).collect()]
    assert got[0] == pytest.approx(10 * 2 ** 20 / 2 ** 40 * 5) and got[1] == 5.0


def test_validate_cohort_expected_sets(spark, calls):
    from allelic.operators.validation import validate_cohort
    person = spark.createDataFrame([(1, "s1"), (2, "s2")], "person_id long, sample_id string")
    cond = spark.createDataFrame([(1, 43530807)], "person_id long, condition_concept_id int")
    good = spark.createDataFrame([("s1",), ("s2",)], "sample_id string")
    bad = spark.createDataFrame([("s1",), ("s7",)], "sample_id string")
    r = {x["check"]: x for x in validate_cohort(calls, person, cond, "chr21", 100, 9, good).collect()}
    assert all(x["passed"] for x in r.values()), r
    assert r["carriers_at_locus"]["detail"] == "carriers=2 mismatches=0"
    r = {x["check"]: x for x in validate_cohort(calls, person, cond, "chr21", 100, 10, bad,
                                                max_broadcast_rows=0).collect()}
    assert not r["calls_loaded"]["passed"]
    assert r["carriers_at_locus"]["detail"] == "carriers=2 mismatches=2"
    assert r["concept_in_join"]["passed"] and r["carriers_have_person"]["passed"]


def test_summary_counts_samples_without_expanding_calls(spark):
    rows = [("chr1", "0/1", "a"), ("chr1", "0/1", "a"), ("chr1", None, "b"), (None, "0/1", None), ("chr2", "0/0", "a")]
    for n in (1, 50):  # calls that do not combine, then calls that do
        df = spark.createDataFrame(rows * n, "reference_name string, genotype string, sample_id string")
        out = summary.ingest_summary(df)
        assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
        assert {(r.level, r.key, r.calls, r.distinct_samples) for r in out.collect()} == {
            ("total", None, 5 * n, 2), ("reference_name", "chr1", 3 * n, 2), ("reference_name", None, n, 0), ("reference_name", "chr2", n, 1),
            ("genotype", "0/1", 3 * n, 1), ("genotype", None, n, 1), ("genotype", "0/0", n, 1),
            ("sample_id", "a", 3 * n, 1), ("sample_id", "b", n, 1), ("sample_id", None, n, 0)}
