"""Column expressions for genotype semantics (JVM-side, codegen friendly).

The genotype sets are literal: phased ``0|1``, ``1/0``, ``1/2`` and ``./.``
are neither carriers nor called unless ``normalise=True`` is requested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference's query semantics).
CARRIER_GENOTYPES = ["0/1", "1/1"]
CALLED_GENOTYPES = ["0/0", "0/1", "1/1"]
HET = "0/1"
HOM_ALT = "1/1"
ZYGOSITY_LABELS = {"0/1": "HET", "1/1": "HOM_ALT", "other": "OTHER"}
PATHOGENIC = "PATHOGENIC"


def _gt(genotype: Column | str, normalise: bool) -> Column:
    c = F.col(genotype) if isinstance(genotype, str) else genotype
    if not normalise:
        return c
    # Phased separator to unphased, then order alleles so 1/0 reads as 0/1.
    g = F.regexp_replace(c, r"\|", "/")
    return (F.when(g == "1/0", F.lit("0/1")).otherwise(g))


def is_carrier(genotype: Column | str = "genotype", normalise: bool = False) -> Column:
    return _gt(genotype, normalise).isin(CARRIER_GENOTYPES)


def is_called(genotype: Column | str = "genotype", normalise: bool = False) -> Column:
    return _gt(genotype, normalise).isin(CALLED_GENOTYPES)


def dosage(genotype: Column | str = "genotype", normalise: bool = False) -> Column:
    """Alternate allele dosage: 0/1 -> 1, 1/1 -> 2, anything else -> 0."""
    g = _gt(genotype, normalise)
    return F.when(g == HET, F.lit(1)).when(g == HOM_ALT, F.lit(2)).otherwise(F.lit(0))


def zygosity(genotype: Column | str = "genotype") -> Column:
    g = _gt(genotype, False)
    return (F.when(g == HET, F.lit(ZYGOSITY_LABELS["0/1"]))
            .when(g == HOM_ALT, F.lit(ZYGOSITY_LABELS["1/1"]))
            .otherwise(F.lit(ZYGOSITY_LABELS["other"])))


def json_field(name: str, column: str = "attributes") -> Column:
    """Scalar text from the JSON annotation column; null when absent."""
    return F.get_json_object(F.col(column), f"$.{name}")


def gene_col(df: DataFrame) -> Column:
    """Gene symbol: the materialised column when the layout has it (so the
    predicate pushes into Parquet), else extracted from ``attributes``."""
    if "gene_symbol" in df.columns:
        return F.col("gene_symbol")
    return json_field("gene")


def clnsig_col(df: DataFrame) -> Column:
    if "clinical_significance" in df.columns:
        return F.col("clinical_significance")
    return json_field("clnsig")


def with_annotations(df: DataFrame) -> DataFrame:
    """Materialise gene_symbol / clinical_significance (idempotent)."""
    if "gene_symbol" not in df.columns:
        df = df.withColumn("gene_symbol", json_field("gene"))
    if "clinical_significance" not in df.columns:
        df = df.withColumn("clinical_significance", json_field("clnsig"))
    return df


def optional_eq(column: str, value) -> Column:
    """Optional-parameter filter: ``None``, ``''`` and ``'All'`` mean no filter."""
    if value is None or (isinstance(value, str) and value in ("", "All")):
        return F.lit(True)
    return F.col(column) == F.lit(value)
