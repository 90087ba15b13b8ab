"""Declared schemas.  Sources read with these (never ``inferSchema``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The canonical call table: one row per (variant site, sample).
# ``end_pos`` is the canonical end column (``end`` is reserved in some
# dialects); readers accept either spelling.
CALLS = T.StructType([
    T.StructField("reference_name", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end_pos", T.LongType()),
    T.StructField("reference_bases", T.StringType()),
    T.StructField("alternate_bases", T.StringType()),
    T.StructField("sample_id", T.StringType()),
    T.StructField("genotype", T.StringType()),
    T.StructField("qual", T.DoubleType()),
    T.StructField("filter", T.StringType()),
    T.StructField("dp", T.IntegerType()),
    T.StructField("gq", T.IntegerType()),
    T.StructField("allele_depth", T.StringType()),
    T.StructField("attributes", T.StringType()),
    T.StructField("cohort_id", T.StringType()),
    T.StructField("engine", T.StringType()),
])
CALL_COLUMNS = [f.name for f in CALLS.fields]

# Columns materialised from ``attributes`` in the warehouse layout so that
# gene / significance predicates reach the Parquet scan as pushed filters.
DERIVED_ANNOTATIONS = ["gene_symbol", "clinical_significance"]

# The partitioned warehouse: calls + materialised annotations + batch id.
# Declared so partition values keep their text type ('001' stays '001').
WAREHOUSE = T.StructType(CALLS.fields + [
    T.StructField("gene_symbol", T.StringType()),
    T.StructField("clinical_significance", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("part_id", T.StringType()),
])

# Call files as delivered: either name of the end column.
CALLS_IN = T.StructType(CALLS.fields + [T.StructField("end", T.LongType())])

PERSON = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("gender_concept_id", T.IntegerType()),
    T.StructField("year_of_birth", T.IntegerType()),
    T.StructField("month_of_birth", T.IntegerType()),
    T.StructField("day_of_birth", T.IntegerType()),
    T.StructField("race_concept_id", T.IntegerType()),
    T.StructField("ethnicity_concept_id", T.IntegerType()),
    T.StructField("sample_id", T.StringType()),
])

CONDITION = T.StructType([
    T.StructField("condition_occurrence_id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("condition_concept_id", T.IntegerType()),
    # ISO date kept as text, exactly as the clinical extract delivers it.
    T.StructField("condition_start_date", T.StringType()),
    T.StructField("condition_type_concept_id", T.IntegerType()),
])

# Sparse split layout: variant rows keep INFO, reference rows do not.
VARIANT_DATA = T.StructType([
    T.StructField("locus_contig", T.StringType()),
    T.StructField("locus_position", T.LongType()),
    T.StructField("alleles", T.ArrayType(T.StringType())),
    T.StructField("sample_id", T.StringType()),
    T.StructField("call", T.StringType()),
    T.StructField("dp", T.IntegerType()),
    T.StructField("gq", T.IntegerType()),
    T.StructField("ad", T.ArrayType(T.IntegerType())),
    T.StructField("info", T.StringType()),
])
# What the split export keeps besides, so that calls come back whole.
VDS_KEPT = T.StructType([
    T.StructField("qual", T.DoubleType()),
    T.StructField("filter", T.StringType()),
    T.StructField("cohort_id", T.StringType()),
    T.StructField("engine", T.StringType()),
    T.StructField("site_info", T.StringType()),
    T.StructField("ad_text", T.StringType()),
])
REFERENCE_DATA = T.StructType([f for f in VARIANT_DATA.fields if f.name != "info"])

# One row per executed query (the query log rolled up by H1-H3).
QUERY_LOG = T.StructType([
    T.StructField("strategy", T.StringType()),
    T.StructField("query_type", T.StringType()),
    T.StructField("cohort_size", T.IntegerType()),
    T.StructField("execution_time_ms", T.DoubleType()),
    T.StructField("bytes_scanned", T.LongType()),
])


def conform_calls(df: DataFrame, keep_extra: bool = False) -> DataFrame:
    """Project any call-shaped frame onto CALLS: ``end`` counts where
    ``end_pos`` is absent or null, casts to the declared types, fills absent columns with null.
    Extra columns (partition keys, materialised annotations) are kept when
    ``keep_extra`` is set."""
    if "end" in df.columns:
        given = [F.col("end_pos")] if "end_pos" in df.columns else []
        df = df.withColumn("end_pos", F.coalesce(*given, F.col("end"))).drop("end")
    cols = []
    for f in CALLS.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in CALL_COLUMNS and c != "end"]
    return df.select(*cols)
