"""Table writes.

The warehouse layout is Hive-partitioned ``batch_id=<id>/part_id=<part>/
reference_name=<contig>/``.  Appending a batch only writes its own directory,
and a replayed batch replaces that directory whole, also the contigs that the
new version no longer has.  A part is what one file or one epoch of a stream
added to a batch, so parts of a batch never overwrite one another.  Filters on
the contig still prune directories.

Rows are range-partitioned on (contig, start, sample_id) before the write:
the boundaries come from a sample of the data, so a contig holding a third
of all calls (or a single hot position) is split over many tasks
(``spark.sql.shuffle.partitions``, merged by AQE where they are small).  Each task's rows are sorted by (start, sample_id), so the
Parquet row-group min/max statistics on ``start`` let point lookups skip
data, and ``maxRecordsPerFile`` bounds file size.  Range boundaries come
from a sampling pass over the input, so an expensive input (a VCF parse)
should be persisted by the caller first, as the N+1 stream does per
micro-batch.  A hash layout on (contig, position block) would skip that
pass but leaves every task writing into every contig directory (many small
files), so range partitioning is the default.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from allelic.functions.genotype import with_annotations
from allelic.schema import CALL_COLUMNS, DERIVED_ANNOTATIONS

MAX_RECORDS_PER_FILE = 5_000_000
#: A compressed file is read by one task, so JSON files hold fewer rows.
MAX_JSON_RECORDS_PER_FILE = 1_000_000


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> str:
    """JSON lines, compressed: every line repeats the names of its fields.
    ``compression="none"`` writes plain text; readers take either."""
    df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", MAX_JSON_RECORDS_PER_FILE).json(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_bundle(results: dict[str, DataFrame], path: str) -> str:
    """Several results as one folder: JSON lines per result, and ``_bundle``
    with the name, row count and schema of each."""
    spark = next(iter(results.values())).sparkSession
    rows = []
    for name, df in results.items():
        write_json(df, f"{path}/{_directory('result', name)}")
        n = spark.read.schema(df.schema).json(f"{path}/result={name}").count()
        rows.append((name, n, df.schema.json()))
    about = spark.createDataFrame(rows, "name string, n_rows long, columns string")
    about.coalesce(1).write.mode("overwrite").json(f"{path}/_bundle")
    return path


def read_bundle(spark, path: str, name: str) -> DataFrame:
    """A result of a bundle, with the schema it was written with."""
    about = spark.read.schema("name string, n_rows long, columns string").json(f"{path}/_bundle")
    found = about.where(F.col("name") == name).first()
    if found is None:
        raise ValueError(f"no result {name!r} in {path}")
    return spark.read.schema(StructType.fromJson(json.loads(found["columns"]))).json(f"{path}/result={name}")


def layout(calls: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-distribute by (contig, start, sample_id), sort within tasks.  One
    partition means one file a contig: a contig is a task then."""
    keys = ["reference_name", "start", "sample_id"]
    if partitions == 1:
        return calls.repartition("reference_name").sortWithinPartitions(*keys)
    df = calls.repartitionByRange(partitions, *keys) if partitions else \
        calls.repartitionByRange(*keys)
    return df.sortWithinPartitions(*keys)


_NAME = re.compile(r"[\w.+-]+")


def _directory(name: str, value: str) -> str:
    if not _NAME.fullmatch(value):
        raise ValueError(f"{name} {value!r}: letters, digits and ._+- expected")
    return f"{name}={value}"


def _only_batch(calls: DataFrame) -> str:
    ids = [r[0] for r in calls.select("batch_id").distinct().limit(2).collect()]
    if len(ids) != 1 or ids[0] is None:
        raise ValueError(f"one batch id expected, found {ids}; write_batches takes several")
    return ids[0]


def write_batch(calls: DataFrame, root: str, batch_id: str | None = None,
                partitions: int | None = None, stats: bool = False, part_id: str = "0") -> str:
    """Write one part of one batch, replacing that part alone.  Gene symbol and
    significance are materialised next to ``attributes`` so their predicates
    are pushed into the Parquet scan."""
    batch_id = _only_batch(calls) if batch_id is None else batch_id
    _write(_laid_out(calls, partitions), ["reference_name"], "static",
           f"{root}/{_directory('batch_id', batch_id)}/{_directory('part_id', part_id)}")
    if stats:
        write_batch_stats(calls.sparkSession, root, [batch_id])
    return root


def _laid_out(calls: DataFrame, partitions: int | None = None, extra: tuple = ()) -> DataFrame:
    """The layout of the table's columns and ``extra`` ones.  Annotations that
    are not there yet are taken from ``attributes`` behind the shuffle: the
    range layout runs what is before it twice."""
    given = [c for c in DERIVED_ANNOTATIONS if c in calls.columns]
    df = layout(calls.select(*CALL_COLUMNS, *given, *extra), partitions)
    return with_annotations(df).select(*CALL_COLUMNS, *DERIVED_ANNOTATIONS, *extra)


def _write(df: DataFrame, partition_by: list[str], overwrite: str, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "snappy")
       .partitionBy(*partition_by).parquet(path))


def write_batches(calls: DataFrame, root: str, partitions: int | None = None) -> str:
    """Write parts of several batches in one job, from ``batch_id`` and
    ``part_id`` columns.  A part must be the whole of something that does not
    change (a file): a replay overwrites the same directories."""
    _write(_laid_out(calls, partitions, ("batch_id", "part_id")), ["batch_id", "part_id", "reference_name"], "dynamic", root)
    return root


STATS_DIR = "_stats"  # leading underscore: skipped by table readers


def write_batch_stats(spark, root: str, batch_ids: list[str] | None = None) -> str:
    """Per data file of the given batches: record count, start range and
    sample_id range, written to ``<root>/_stats/batch_id=<id>/``.  Reads only
    the written batch's files (partition pruning) and four columns."""
    from allelic.sources.tables import read_warehouse
    wh = read_warehouse(spark, root)
    if batch_ids is not None:
        wh = wh.where(F.col("batch_id").isin(batch_ids))
    st = (wh.groupBy("batch_id", "reference_name", F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("num_records"),
                 F.min("start").alias("min_start"), F.max("start").alias("max_start"),
                 F.min("sample_id").alias("min_sample_id"),
                 F.max("sample_id").alias("max_sample_id")))
    out = f"{root}/{STATS_DIR}"
    (st.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(out))
    return out


FILE_STATS = ("reference_name string, file string, num_records long, min_start long, max_start long, "
              "min_sample_id string, max_sample_id string, batch_id string")


def read_file_stats(spark, root: str) -> DataFrame:
    """The statistics of all batches, a row a data file."""
    return spark.read.schema(FILE_STATS).parquet(f"{root}/{STATS_DIR}")


def files_covering(spark, root: str, contig: str, start: int, sample_id: str | None = None) -> list[str]:
    """Data files that can hold calls at a position (and of a sample): a row a
    file reaches the driver, as in a listing."""
    st = read_file_stats(spark, root).where(
        (F.col("reference_name") == contig) & (F.col("min_start") <= start) & (F.col("max_start") >= start))
    if sample_id is not None:
        st = st.where((F.col("min_sample_id") <= sample_id) & (F.col("max_sample_id") >= sample_id))
    return sorted(r["file"] for r in st.select("file").distinct().collect())


def lookup_by_stats(spark, root: str, contig: str, start: int, sample_id: str | None = None) -> DataFrame:
    """Calls at a position (and of a sample), reading only the files whose
    statistics cover it.  Every batch must have been written with
    ``stats=True``; a batch without them is an error."""
    from allelic.schema import WAREHOUSE
    from allelic.sources.tables import read_warehouse
    missing = read_warehouse(spark, root).select("batch_id").distinct().join(
        read_file_stats(spark, root).select("batch_id").distinct(), "batch_id", "left_anti").first()
    if missing is not None:
        raise ValueError(f"batch {missing['batch_id']!r} has no file statistics")
    files = files_covering(spark, root, contig, start, sample_id)
    table = read_warehouse(spark, root)
    df = spark.read.schema(WAREHOUSE).option("basePath", root).parquet(*files) if files else table.where(F.lit(False))
    df = df.where((F.col("reference_name") == contig) & (F.col("start") == start))
    return df if sample_id is None else df.where(F.col("sample_id") == sample_id)


def rewrite_all(calls: DataFrame, root: str, partitions: int | None = None) -> str:
    """The naive alternative to an append: rewrite every partition."""
    calls = calls.withColumn("part_id", F.lit("0"))
    _write(_laid_out(calls, partitions, ("batch_id", "part_id")), ["batch_id", "part_id", "reference_name"], "static", root)
    return root


def written_files(spark, root: str) -> DataFrame:
    """(reference_name, batch_id, file) for every data file of the layout."""
    from allelic.sources.tables import read_warehouse
    return (read_warehouse(spark, root)
                 .select("reference_name", "batch_id", F.col("_metadata.file_path").alias("file"))
                 .distinct())
