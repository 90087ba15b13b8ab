"""Call, clinical and query-log tables derived from the driver's TPC-H-like
tables by fixed formulas (see FIXTURES.md).  Each formula is mirrored as SQL
in ``allelic.sources.fixtures_sql`` so DuckDB can act as an independent
oracle over the same parquet files.

Everything here is a lazy DataFrame: Catalyst prunes the columns each query
needs and pushes contig / position predicates through the projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.schema import CALL_COLUMNS

# Fixed values of the derivation (FIXTURES.md, section B).
N_CONTIGS = 22
SITE_BASE = 1000000
SITE_STRIDE = 137
COHORT_ID = "synthetic_v1"
ENGINE_TAG = "s3_tables"
STRATEGIES = ["s3_tables", "custom_iceberg", "delta_lake", "hail_vds"]
QUERY_TYPES = ["allele_frequency", "carrier_lookup", "gene_burden", "omop_join"]
COHORT_SIZES = [10, 50, 100, 250, 500, 1000, 2500]
CONDITION_CONCEPTS = [43530807, 374919, 4216183]
URGENT_PRIORITY = "1-URGENT"
CONDITION_TYPE = 32817
MALE, FEMALE, UNKNOWN_GENDER = 8507, 8532, 0
RACE, ETHNICITY = 8527, 38003564

# Target locus and genes present at every scale.
TARGET_CONTIG = "chr21"
TARGET_START = 1002740
TARGET_GENE = "APP"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sample_name(key: Column) -> Column:
    """``sample_`` and the key, padded to six digits; longer keys stay whole."""
    text = key.cast("string")
    return F.concat(F.lit("sample_"), F.lpad(text, F.greatest(F.length(text), F.lit(6)), F.lit("0")))


def sites(part: DataFrame) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    contig_num = k % N_CONTIGS + 1
    gene = (F.when(contig_num == 21, F.when(k % 4 == 0, F.lit("APP")).otherwise(F.lit("SOD1")))
            .when(contig_num == 17, F.lit("BRCA1"))
            .otherwise(F.concat(F.lit("GENE"), contig_num.cast("string"))))
    return part.select(
        k.alias("site_key"),
        F.concat(F.lit("chr"), contig_num.cast("string")).alias("reference_name"),
        (F.lit(SITE_BASE) + k * SITE_STRIDE).cast("long").alias("start"),
        F.when(s % 7 == 0, F.lit("ATG")).when(s % 2 == 0, F.lit("A")).otherwise(F.lit("C"))
         .alias("reference_bases"),
        F.when(s % 3 == 0, F.lit("G")).otherwise(F.lit("T")).alias("alternate_bases"),
        F.when(k % 10 == 3, F.lit("LowQual")).otherwise(F.lit("PASS")).alias("filter"),
        gene.alias("gene"),
        F.when(s % 5 == 0, F.lit("PATHOGENIC")).when(s % 5 == 1, F.lit("VUS"))
         .otherwise(F.lit("BENIGN")).alias("clnsig"),
        (F.lit(30) + s).cast("double").alias("qual"),
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (customer, part) pairs with the largest quantity.  Both
    sides are big: a shuffle join on the order key, then a partial +
    final aggregate on (custkey, partkey)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .groupBy("o_custkey", "l_partkey")
              .agg(F.max("l_quantity").alias("max_qty")))


def variants(spark: SparkSession, sf_dir: str, with_batch: bool = False) -> DataFrame:
    """The call table (15 canonical columns; ``batch_id`` optionally)."""
    st = sites(table(spark, sf_dir, "part"))
    p = _pairs(spark, sf_dir)
    j = p.join(st, p.l_partkey == st.site_key)
    ck, sk = F.col("o_custkey"), F.col("site_key")
    m = (ck + sk) % 8
    gt = (F.when(m == 0, F.lit("1/1")).when(m.isin(1, 2), F.lit("0/1"))
          .when(m == 3, F.lit("./.")).otherwise(F.lit("0/0")))
    dp = F.col("max_qty").cast("int")
    j = j.select(
        "reference_name", "start",
        (F.col("start") + F.length("reference_bases") - 1).cast("long").alias("end_pos"),
        "reference_bases", "alternate_bases",
        sample_name(ck).alias("sample_id"),
        gt.alias("genotype"),
        "qual", "filter",
        dp.alias("dp"),
        (F.lit(60) + (ck * 7 + sk) % 40).cast("int").alias("gq"),
        F.concat(F.lit('{"gene":"'), F.col("gene"), F.lit('","clnsig":"'), F.col("clnsig"),
                 F.lit('"}')).alias("attributes"),
        F.lit(COHORT_ID).alias("cohort_id"),
        F.lit(ENGINE_TAG).alias("engine"),
        F.when(ck % 2 == 1, F.lit("001")).otherwise(F.lit("002")).alias("batch_id"),
    )
    h = F.floor(F.col("dp") / 2).cast("int")
    ad = (F.when(F.col("genotype") == "0/1",
                 F.concat((F.col("dp") - h).cast("string"), F.lit(","), h.cast("string")))
          .when(F.col("genotype") == "1/1", F.concat(F.lit("0,"), F.col("dp").cast("string")))
          .otherwise(F.concat(F.col("dp").cast("string"), F.lit(",0"))))
    j = j.withColumn("allele_depth", ad)
    cols = CALL_COLUMNS + (["batch_id"] if with_batch else [])
    return j.select(*cols)


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        (F.lit(10000) + k).cast("long").alias("person_id"),
        F.when(k % 7 == 0, F.lit(UNKNOWN_GENDER)).when(k % 2 == 0, F.lit(MALE))
         .otherwise(F.lit(FEMALE)).cast("int").alias("gender_concept_id"),
        (F.lit(1960) + (k * 3) % 40).cast("int").alias("year_of_birth"),
        F.lit(6).cast("int").alias("month_of_birth"),
        F.lit(15).cast("int").alias("day_of_birth"),
        F.lit(RACE).cast("int").alias("race_concept_id"),
        F.lit(ETHNICITY).cast("int").alias("ethnicity_concept_id"),
        sample_name(k).alias("sample_id"),
    )


def condition_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == URGENT_PRIORITY)
    k = F.col("o_orderkey")
    concept = (F.when(k % 3 == 0, F.lit(CONDITION_CONCEPTS[0]))
               .when(k % 3 == 1, F.lit(CONDITION_CONCEPTS[1]))
               .otherwise(F.lit(CONDITION_CONCEPTS[2])))
    return o.select(
        k.cast("long").alias("condition_occurrence_id"),
        (F.lit(10000) + F.col("o_custkey")).cast("long").alias("person_id"),
        concept.cast("int").alias("condition_concept_id"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("condition_start_date"),
        F.lit(CONDITION_TYPE).cast("int").alias("condition_type_concept_id"),
    )


def traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample: number of conditions, case status, covariates."""
    c = condition_occurrence(spark, sf_dir).groupBy("person_id").agg(
        F.count(F.lit(1)).alias("n_conditions"), F.max(F.when(F.col("condition_concept_id") == CONDITION_CONCEPTS[0], 1).otherwise(0)).alias("is_case"))
    return person(spark, sf_dir).join(c, "person_id", "left").select(
        "sample_id", F.coalesce("n_conditions", F.lit(0)).cast("long").alias("n_conditions"),
        F.coalesce("is_case", F.lit(0)).alias("is_case"), (F.col("year_of_birth") - 1980).alias("age"),
        F.when(F.col("gender_concept_id") == MALE, 1).otherwise(0).alias("male"))


def score_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of four kinds: the alternate allele, the reference allele, the
    other strand, and an allele that the site does not have."""
    st, r = sites(table(spark, sf_dir, "part")), F.col("site_key") % 5
    ref, alt, flip = F.col("reference_bases"), F.col("alternate_bases"), lambda c: F.translate(c, "ACGT", "TGCA")
    return st.where(r < 4).select(
        "reference_name", "start",
        F.when(r == 0, alt).when(r == 1, ref).when(r == 2, flip(alt)).otherwise(F.lit("N")).alias("effect_allele"),
        F.when(r == 1, alt).when(r == 2, flip(ref)).otherwise(ref).alias("other_allele"),
        ((F.col("qual") - 55) / 100).alias("weight"))


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("trial_id"), (F.lit(1960) + k % 10).cast("int").alias("min_year"), (F.lit(1985) + k % 15).cast("int").alias("max_year"))


def trial_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four criteria a trial: a gene, one or two conditions in a window
    of years, and an excluded gene; every seventh trial only excludes."""
    k = F.col("s_suppkey")
    concept = lambda i: F.element_at(F.array(*[F.lit(str(c)) for c in CONDITION_CONCEPTS]), (i % 3 + 1).cast("int"))
    contig, none = k % N_CONTIGS + 1, F.lit(None).cast("string")
    gene = F.when(contig == 21, "APP").when(contig == 17, "BRCA1").otherwise(F.concat(F.lit("GENE"), contig.cast("string")))
    from_day = F.concat((1992 + k % 4).cast("string"), F.lit("-01-01"))
    to_day = F.concat((1995 + k % 4).cast("string"), F.lit("-12-31"))
    positive = k % 7 != 0

    def one(i, use, mode, kind, code, start=none, end=none):
        return F.when(use, F.struct(F.lit(i).alias("criterion_id"), F.lit(mode).alias("mode"), F.lit(kind).alias("kind"), code.alias("code"),
                                    start.alias("from_day"), end.alias("to_day")))

    rules = F.array(one(1, positive, "all", "variant", gene), one(2, positive, "any", "condition", concept(k), from_day, to_day),
                    one(3, positive & (k % 2 == 0), "any", "condition", concept(k + 1)),
                    one(4, k % 4 != 2, "none", "variant:PATHOGENIC", F.lit("BRCA1")))
    return table(spark, sf_dir, "supplier").select(k.alias("trial_id"), F.explode(F.array_compact(rules)).alias("x")).select("trial_id", "x.*")


def biopsies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths of a marker (the contig of a part) of a customer by order day."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    dp = F.col("l_quantity").cast("long")
    part = (F.col("o_custkey") + F.col("l_partkey") + F.col("l_linenumber")) % 10
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        sample_name(F.col("o_custkey")).alias("sample_id"), F.concat(F.lit("chr"), (F.col("l_partkey") % N_CONTIGS + 1).cast("string")).alias("marker"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("day"), dp.alias("dp"),
        F.floor(dp * part / 10).cast("long").alias("alt"))


def _pick(values: list, idx: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v)))
    return expr


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per executed query, derived from ``events``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        _pick(STRATEGIES, F.col("user_id") % 4).alias("strategy"),
        _pick(QUERY_TYPES, F.col("event_id") % 4).alias("query_type"),
        _pick(COHORT_SIZES, F.col("user_id") % 7).cast("int").alias("cohort_size"),
        F.abs(F.col("value")).cast("double").alias("execution_time_ms"),
        (F.col("event_id") * 100000).cast("long").alias("bytes_scanned"),
    )
