"""Physical layout maintenance: compaction and clustering (K4).

``compact`` rewrites a table in the range layout of the writers.
``compact_small`` leaves large files as they are and packs only the small ones
of a contig together.  ``cluster`` lays a table out along a Z curve of position
and sample, so that lookups by either skip files.  Output goes to a new path;
the old files stay until the caller swaps paths, so a failed job leaves the
table readable.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType
from pyspark.sql.window import Window

from allelic.functions.genotype import with_annotations
from allelic.schema import CALL_COLUMNS, DERIVED_ANNOTATIONS, WAREHOUSE
from allelic.sinks.writers import rewrite_all
from allelic.sources.tables import read_warehouse

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TARGET_BYTES, SMALL_BYTES = 256 << 20, 64 << 20
#: Bits of each rank of the Z curve, and rows that its splitters come from.
Z_BITS, Z_SAMPLE = 5, 20_000


def compact(spark: SparkSession, src: str, dst: str, target_files: int | None = None) -> str:
    """Rewrite a table clustered, with the parts of each batch merged into its
    first one.  The result has the table's own layout, so batches can be
    appended to it."""
    return rewrite_all(read_warehouse(spark, src), dst, target_files)


def diff_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference both ways in one shuffle: tag each side, count every
    distinct row per side, and sum the surpluses.  Same result as two
    ``exceptAll`` passes; one row (left_rows, right_rows, left_only,
    right_only).  Rows are told apart by 128 bits of the SHA-256 of their
    values, so what is shuffled and held does not grow with their width."""
    cols = left.columns
    tagged = (left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    # a negative zero is zero
    values = [F.when(F.col(f.name) == 0, F.lit(0).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
              if isinstance(f.dataType, FractionalType) else F.col(f.name) for f in tagged.schema if f.name in cols]
    row = F.unhex(F.left(F.sha2(F.to_json(F.struct(*values)), 256), F.lit(32)))
    per_row = tagged.groupBy(row).agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    return per_row.agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))), F.lit(0))
         .cast("long").alias("left_only"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))), F.lit(0))
         .cast("long").alias("right_only"))


def _table_files(spark: SparkSession, root: str) -> DataFrame:
    """Data files of the table layout with their keys and sizes (listed, not
    read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(root).select("path", "length"))
    key = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1).alias(name)
    return files.select("path", "length", key("batch_id"), key("part_id"), key("reference_name"))


def _copy(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pfs
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pfs.FileSystem.from_uri(row["path"])
                to_fs, to = pfs.FileSystem.from_uri(f"{target}/{row['name']}")
                to_fs.create_dir(to.rpartition("/")[0], recursive=True)
                with fs.open_input_stream(path, compression=None) as f, to_fs.open_output_stream(to, compression=None) as out:
                    while data := f.read(8 << 20):
                        out.write(data)
                yield pa.RecordBatch.from_pylist([{"path": row["path"]}])
    return run


def compact_small(spark: SparkSession, src: str, dst: str, target_bytes: int = TARGET_BYTES,
                  small_bytes: int = SMALL_BYTES) -> DataFrame:
    """Copy files of ``small_bytes`` or more as they are, and rewrite smaller
    ones of a batch and contig, packed in path order into bins of about
    ``target_bytes`` (a bin alone in its group with one file is copied too).
    Returns ``batch_id, reference_name, copied, rewritten, bins``.

    Bins become parts of their batch named ``bin-<n>``, sorted by (start,
    sample_id); the result has the table's layout, so batches can be appended.
    The driver sees the paths of small files only."""
    if "://" not in dst:
        dst = "file://" + dst
    files = _table_files(spark, src).withColumn("small", F.col("length") < small_bytes)
    order = Window.partitionBy("batch_id", "reference_name").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(order), F.lit(0))
    bins = files.where("small").withColumn("bin", F.floor(before / target_bytes))
    alone = F.count(F.lit(1)).over(Window.partitionBy("batch_id", "reference_name", "bin")) == 1
    bins = bins.withColumn("alone", alone)
    keep = files.where("not small").drop("small").unionByName(bins.where("alone").drop("small", "bin", "alone"))
    name = F.concat_ws("/", F.concat(F.lit("batch_id="), "batch_id"), F.concat(F.lit("part_id="), "part_id"),
                       F.concat(F.lit("reference_name="), "reference_name"), F.element_at(F.split("path", "/"), -1))
    n = keep.count()
    if n:
        done = keep.select("path", name.alias("name")).repartition(n).mapInArrow(_copy(dst), "path string")
        done.write.format("noop").mode("overwrite").save()
    packed = bins.where("not alone").select("path", "bin").collect()  # a row a small file
    if packed:
        rows = (spark.read.schema(WAREHOUSE).option("basePath", src).parquet(*[r["path"] for r in packed])
                .withColumn("path", F.regexp_replace("_metadata.file_path", "^file:/+", "/")))
        of = spark.createDataFrame(packed, "path string, bin long").withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
        rows = rows.join(F.broadcast(of), "path").withColumn("part_id", F.concat(F.lit("bin-"), F.col("bin").cast("string")))
        keys = ["batch_id", "reference_name", "part_id"]
        (rows.select(*CALL_COLUMNS, *DERIVED_ANNOTATIONS, "batch_id", "part_id")
         .repartition(len({r["path"].rpartition("/")[0] for r in packed}) + 1, *keys).sortWithinPartitions(*keys, "start", "sample_id")
         .write.mode("append").partitionBy("batch_id", "part_id", "reference_name").parquet(dst))
    every = keep.select("batch_id", "reference_name", F.lit(1).alias("copied"), F.lit(0).alias("rewritten"), F.lit(None).cast("long").alias("bin"))
    every = every.unionByName(bins.where("not alone").select("batch_id", "reference_name", F.lit(0).alias("copied"), F.lit(1).alias("rewritten"), "bin"))
    return every.groupBy("batch_id", "reference_name").agg(F.sum("copied").alias("copied"), F.sum("rewritten").alias("rewritten"),
                                                           F.count_distinct("bin").alias("bins"))


def splitters(df: DataFrame, column: str, ranges: int, sample: int = Z_SAMPLE) -> list:
    """At most ``ranges - 1`` values that cut the column into even ranges, from
    at most ``sample`` rows with the smallest hashes."""
    picked = df.select(column, F.xxhash64(*df.columns).alias("h")).where(F.col(column).isNotNull()).orderBy("h").limit(sample)
    values = sorted(r[0] for r in picked.select(column).collect())
    return sorted({values[len(values) * k // ranges] for k in range(1, ranges)}) if values else []


def _rank(column: str, cuts: list) -> Column:
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.coalesce(F.col(column), F.lit(cuts[0]))))


def z_key(columns: list[str], cuts: list[list], bits: int = Z_BITS) -> Column:
    """The ranks of the columns with their bits interleaved, the first
    column's highest bit first."""
    key = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for column, c in zip(columns, cuts):
            key = key * 2 + F.shiftright(_rank(column, c), b).bitwiseAND(F.lit(1))
    return key


def cluster(calls: DataFrame, root: str, files: int | None = None, bits: int = Z_BITS) -> str:
    """Write a whole table along the Z curve of (start, sample_id) within its
    contigs: one file a range of the curve and contig, sorted along it, so the
    statistics of files and row groups bound both columns."""
    cuts = [splitters(calls, c, 1 << bits) for c in ("start", "sample_id")]
    df = with_annotations(calls).select(*CALL_COLUMNS, *DERIVED_ANNOTATIONS, "batch_id", F.lit("0").alias("part_id"))
    df = df.withColumn("_z", z_key(["start", "sample_id"], cuts, bits))
    keys = ["reference_name", "_z"]
    df = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    (df.sortWithinPartitions(*keys, "start", "sample_id").drop("_z")
     .write.mode("overwrite").option("compression", "snappy").partitionBy("batch_id", "part_id", "reference_name").parquet(root))
    return root
