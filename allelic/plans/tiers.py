"""Hot and warm tiers: a routed subset of the calls beside all of them.

``<root>/warm`` holds every call, ``<root>/hot`` those of a rule (carried
pathogenic variants), both in the table layout.  A part of a batch is written
to both, and a replay replaces both.  A reader uses the hot tier only if its
filters cannot ask for a call that the rule leaves out, and only if every part
of the warm tier is complete in the hot one; else it reads the warm tier, with
the same rows.  The rule is written beside the tiers, once.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.functions.genotype import CARRIER_GENOTYPES, PATHOGENIC
from allelic.plans.layout import compact
from allelic.schema import WAREHOUSE
from allelic.sinks.writers import write_batch
from allelic.sources.tables import read_warehouse

#: The routed subset: values of each column.
CLINICAL = {"clinical_significance": [PATHOGENIC], "genotype": CARRIER_GENOTYPES}
RULE = "_rule"  # leading underscore: not data


def _in(rule: dict) -> Column:
    out = F.lit(True)
    for column, values in rule.items():
        out = out & F.coalesce(F.col(column).isin(values), F.lit(False))
    return out


def _rule(spark: SparkSession, root: str, rule: dict | None = None) -> dict:
    """The rule of the tiers; written by the first append."""
    path = f"{root}/{RULE}"
    there = _exists(spark, f"{path}/_SUCCESS")
    if not there and rule is not None:
        spark.createDataFrame([(json.dumps(rule, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return rule
    found = json.loads(spark.read.text(path).first()[0])
    if rule is not None and found != rule:
        raise ValueError(f"the tiers at {root} route by {found}")
    return found


def _files(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [] if found is None else [s.getPath().toString() for s in found]


def _exists(spark: SparkSession, path: str) -> bool:
    return bool(_files(spark, path))


def _parts(spark: SparkSession, tier: str) -> set[str]:
    """Batch and part of what is completely written: a name a part."""
    return {"/".join(f.split("/")[-3:-1]) for f in _files(spark, f"{tier}/batch_id=*/part_id=*/_SUCCESS")}


def append_tiered(calls: DataFrame, root: str, batch_id: str | None = None, part_id: str = "0", rule: dict | None = None) -> str:
    """Write a part of a batch to both tiers, the warm one first: until the
    hot one is complete, readers use the warm one.  The hot part is read from
    the warm one, whose columns the rule is pushed into."""
    spark = calls.sparkSession
    rule = _rule(spark, root, rule or CLINICAL)
    batch_id = batch_id or calls.select("batch_id").first()[0]
    hot = f"{root}/hot"
    _drop_marker(spark, f"{hot}/batch_id={batch_id}/part_id={part_id}/_SUCCESS")
    write_batch(calls, f"{root}/warm", batch_id, part_id=part_id)
    written = (spark.read.schema(WAREHOUSE).option("basePath", f"{root}/warm")
               .parquet(f"{root}/warm/batch_id={batch_id}/part_id={part_id}"))
    write_batch(written.where(_in(rule)), hot, batch_id, part_id=part_id)
    return root


def _drop_marker(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)


def covered(filters: dict, rule: dict) -> bool:
    """Whether rows that pass ``filters`` (column: value or values) pass the
    rule."""
    for column, values in rule.items():
        asked = filters.get(column)
        asked = [asked] if isinstance(asked, str) or asked is None else list(asked)
        if not asked or None in asked or not set(asked) <= set(values):
            return False
    return True


def read_tiered(spark: SparkSession, root: str, filters: dict) -> DataFrame:
    """The calls that pass ``filters``, from the hot tier where that is all."""
    hot, warm = f"{root}/hot", f"{root}/warm"
    use = covered(filters, _rule(spark, root)) and _parts(spark, warm) <= _parts(spark, hot)
    df = read_warehouse(spark, hot if use else warm)
    for column, values in filters.items():
        df = df.where(F.col(column).isin([values] if isinstance(values, (str, int, float)) else list(values)))
    return df


def compact_tiered(spark: SparkSession, src: str, dst: str) -> str:
    """Compact both tiers to a new place; readers go on with the old one."""
    rule = _rule(spark, src)
    hot_is_whole = _parts(spark, f"{src}/warm") <= _parts(spark, f"{src}/hot")
    _rule(spark, dst, rule)
    for tier in ("warm", "hot"):
        compact(spark, f"{src}/{tier}", f"{dst}/{tier}")
        # the writer marks the table; a tier's parts are marked one by one
        for b in {p.split("/")[0] for p in _parts(spark, f"{src}/{tier}")} if tier == "warm" or hot_is_whole else ():
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{dst}/{tier}/{b}/part_id=0/_SUCCESS")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()
    return dst
