"""Text files -> block-gzip files, a task a file (A10, the inverse reader)."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.session import few_listing_tasks, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 65_280
#: Bytes of small files that a task compresses.
TASK_BYTES = 64 << 20
#: Fixed values of the format: a member's header up to its size, and the
#: empty block that ends a file.
HEADER = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0"
LAST = HEADER + b"\x1b\0\x03\0" + b"\0" * 8


def block(text: bytes) -> bytes:
    """One block of at most ``BLOCK_BYTES`` of text."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(text) + c.flush()
    if len(body) > BLOCK_BYTES:  # does not compress: stored
        c = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = c.compress(text) + c.flush()
    size = len(HEADER) + 2 + len(body) + 8
    return (HEADER + (size - 1).to_bytes(2, "little") + body + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little"))


def _compress(target: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pfs
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pfs.FileSystem.from_uri(row["path"])
                to_fs, to = pfs.FileSystem.from_uri(f"{target}/{row['name']}")
                to_fs.create_dir(to.rpartition("/")[0], recursive=True)
                blocks = 0
                # a run that was lost half-way is written anew under the same name
                with fs.open_input_stream(path, compression=None) as f, to_fs.open_output_stream(to, compression=None) as out:
                    while text := f.read(block_bytes):
                        out.write(block(text))
                        blocks += 1
                    out.write(LAST)
                yield pa.RecordBatch.from_pylist([{"file": f"{target}/{row['name']}", "blocks": blocks}])
    return run


def write_block_gzip(spark: SparkSession, source: str, target: str, suffix: str = ".gz",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Compress each file under ``source`` (no others than text files of a
    writer) to a file under ``target`` with the same path and ``suffix``
    added.  Returns ``file, blocks``, evaluated once."""
    with few_listing_tasks(spark):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
                 .load(source).select("path", "length"))
    # the path below the source; partition values stand escaped in it
    name = F.concat(F.element_at(F.split("path", source.rstrip("/").rpartition("/")[2] + "/"), -1), F.lit(suffix))
    if "://" not in target:
        target = "file://" + target
    n, size = files.agg(F.count(F.lit(1)), F.sum("length")).first()
    # a task a file, or several small files
    tasks = max(1, min(n, max(16 * spark.sparkContext.defaultParallelism, (size or 0) // TASK_BYTES)))
    done = files.select("path", name.alias("name")).repartition(tasks).mapInArrow(
        _compress(target, block_bytes), "file string, blocks long")
    path = scratch_path(spark, "packed_files")
    done.write.parquet(path)  # a row a file
    return spark.read.schema("file string, blocks long").parquet(path)
