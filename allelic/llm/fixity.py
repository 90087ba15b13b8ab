"""Merkle fixity audit of WARC replicas.

A replica is a table of records: archive, offset of the record in it, and its
bytes.  Leaves are hashes of records with their offset and length; a node
covers an aligned range of offsets and hashes its children in offset order.
Only roots are compared at first; the audit then goes down, level by level,
into the ranges whose hashes differ, and ends at the records.

Trees are levels in one table each; a node's children are few (a range holds
at most ``FANOUT`` smaller ranges, a lowest range as many records as fit), so
no group grows with the input.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from allelic.llm.common import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of the offset that a lowest range spans (64 KiB), and bits a level adds.
LEAF_BITS, LEVEL_BITS = 16, 4
FANOUT = 1 << LEVEL_BITS
LEVELS = 6
#: Ids to an archive.
ARCHIVE_IDS = 256
#: Archives for rows without an id.
LOOSE_ARCHIVES = 64
VERSION = "WARC/1.1"
#: Date of records whose capture is not known; the format asks for one.
NO_DATE = "1970-01-01T00:00:00Z"


def warc_record(url: Column, record_id: Column, body: Column, date: Column | None = None) -> Column:
    """Bytes of a WARC resource record (null body: empty; ``date`` in UTC to
    the second, as the format writes it)."""
    date = F.coalesce(F.lit(NO_DATE) if date is None else date, F.lit(NO_DATE))
    payload = F.coalesce(body.cast("string"), F.lit(""))
    head = F.concat(
        F.lit(VERSION + "\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: "), date, F.lit("\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.encode(F.concat(head, payload, F.lit("\r\n\r\n")), "UTF-8")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as records: ``archive``, ``offset``, ``id``, ``record``.

    Ids in a row share an archive; records follow by id, then by their hash.
    Rows without an id go to archives of their own by content hash.
    """
    rec = pages.select(F.col(id_col).cast("long").alias("id"),
                       warc_record(F.col(url_col), F.col(id_col), F.col(html_col)).alias("record"))
    archive = F.coalesce(F.concat(F.lit("a"), F.floor(F.col("id") / ARCHIVE_IDS).cast("string")),
                         F.concat(F.lit("n"), F.conv(F.substring("sha", 1, 6), 16, 10).cast("long") % LOOSE_ARCHIVES))
    rec = rec.withColumn("sha", F.sha2("record", 256)).withColumn("archive", archive)
    before = Window.partitionBy("archive").orderBy("id", "sha").rowsBetween(Window.unboundedPreceding, -1)
    return rec.withColumn("offset", F.coalesce(F.sum(F.octet_length("record").cast("long")).over(before), F.lit(0).cast("long"))).select(
        "archive", "offset", "id", "record")


def write_warc(records: DataFrame, path: str) -> None:
    """A folder of WARC files per archive, records whole and in offset order.

    Records end in a line feed, which the text writer puts back.
    """
    rows = records.select("archive", "offset", F.decode("record", "UTF-8").alias("value"))
    rows = rows.withColumn("value", F.expr("left(value, char_length(value) - 1)"))
    (rows.repartition("archive").sortWithinPartitions("archive", "offset").select("archive", "value")
     .write.partitionBy("archive").option("lineSep", "\n").text(path))


def parse_warc(data: bytes) -> Iterator[tuple[int, bytes, dict, bool]]:
    """``(offset, bytes, header fields, valid)`` of each record of a file.

    A record that does not end where its length says, or has no length, is
    returned as not valid, up to the next place that reads like the start of a
    record, so one fault does not hide what follows."""
    at, mark = 0, VERSION.encode() + b"\r\n"
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8", "replace").split("\r\n") if head >= 0 else []
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        end = head + 8 + int(fields["content-length"]) if fields.get("content-length", "").isdigit() else -1
        valid = data.startswith(mark, at) and 0 <= end <= len(data) and data[end - 4:end] == b"\r\n\r\n" and (
            end == len(data) or data.startswith(mark, end))
        if not valid:
            after = data.find(b"\r\n" + mark, at + 1)
            end = after + 2 if after >= 0 else len(data)
        yield at, data[at:end], fields, valid
        at = end


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("warc-record-id", "warc-date", "warc-target-uri", "warc-type")
    for batch in batches:
        for row in batch.to_pylist():
            rows, size = [], 0
            for offset, record, fields, valid in parse_warc(row["content"]):
                rows.append((row["archive"], row["path"], offset, *(fields.get(n) for n in names), valid, record))
                size += len(record)
                if size > 4_000_000:
                    yield _records(rows)
                    rows, size = [], 0
            yield _records(rows)


def _records(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 9
    types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [c.split()[0] for c in WARC_ROW.split(", ")])


WARC_ROW = ("archive string, path string, offset long, record_id string, date string, uri string, type string, valid boolean, record binary")


def read_warc(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The records of WARC files under ``path``, a task parsing whole files of
    the size that writers give an archive.  ``archive`` is the partition of
    the folder, or null; ``offset`` is the place in the file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    archive = F.nullif(F.regexp_extract("path", "/archive=([^/]*)/", 1), F.lit(""))
    return files.select("path", archive.alias("archive"), "content").mapInArrow(_parse, WARC_ROW)


def leaves(records: DataFrame) -> DataFrame:
    """``archive``, ``offset``, ``length``, ``hash`` of each record.  A null
    record has length -1 and a hash of its own."""
    length = F.coalesce(F.octet_length("record"), F.lit(-1)).cast("long")
    return records.select("archive", "offset", length.alias("length"), F.sha2(F.concat_ws(
        ":", F.col("offset").cast("string"), length.cast("string"),
        F.coalesce(F.sha2("record", 256), F.lit("missing"))).cast("binary"), 256).alias("hash"))


def _shift(level: int) -> int:
    return LEAF_BITS + LEVEL_BITS * level


def tree(leaf: DataFrame, levels: int = LEVELS) -> DataFrame:
    """All nodes: ``archive``, ``level``, ``range``, ``hash``, ``records``;
    the root is level ``levels``, range 0, over every offset."""
    spark = leaf.sparkSession
    nodes = leaf.select("archive", F.lit(-1).alias("level"), F.col("offset").alias("range"), "hash", F.lit(1).cast("long").alias("records"))
    out, below = [], nodes
    for level in range(levels + 1):
        up = (F.shiftright("range", LEAF_BITS if level == 0 else LEVEL_BITS) if level < levels else F.lit(0).cast("long"))
        child = F.struct(F.col("range").alias("r"), F.col("hash").alias("h"))
        below = (below.withColumn("up", up).groupBy("archive", "up")
                 .agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(
                     ":", c["r"].cast("string"), c["h"])), ",").cast("binary"), 256).alias("hash"), F.sum("records").alias("records"))
                 .select("archive", F.lit(level).alias("level"), F.col("up").alias("range"), "hash", "records"))
        out.append(below)
    nodes = out[0]
    for x in out[1:]:
        nodes = nodes.unionByName(x)
    return materialise(spark, nodes, "merkle")


def audit(left: DataFrame, right: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Records in which two replicas (``archive``, ``offset``, ``record``)
    differ: archive, offset, ``status`` (``changed``, ``missing`` on the
    right, ``extra`` on the right), both lengths and hashes, and ``depth``,
    the nodes compared above the record.

    Equal replicas give no rows, two empty ones too.  A null archive is an
    archive of its own; null offsets count as 0.  Records that repeat at one
    offset are compared as a multiset by their hashes.  Only ranges below
    differing ones are read again.
    """
    spark = left.sparkSession
    sides = []
    for side, name in ((left, "l"), (right, "r")):
        rows = side.select(F.coalesce(F.col("archive"), F.lit("\0")).alias("archive"),
                           F.coalesce(F.col("offset"), F.lit(0)).cast("long").alias("offset"), "record")
        sides.append(materialise(spark, leaves(rows), f"leaves_{name}"))
    trees = [tree(x, levels) for x in sides]
    bad = None
    for level in range(levels, -1, -1):
        pair = []
        for t in trees:
            nodes = t.where(F.col("level") == level).select("archive", "range", "hash")
            if bad is not None:
                up = F.shiftright("range", LEVEL_BITS) if level + 1 < levels else F.lit(0).cast("long")
                nodes = nodes.withColumn("up", up).join(
                    bad.select("archive", F.col("range").alias("up")), ["archive", "up"], "left_semi").drop("up")
            pair.append(nodes)
        l, r = pair
        bad = materialise(spark, l.withColumnRenamed("hash", "lh").join(r.withColumnRenamed("hash", "rh"), ["archive", "range"], "full")
                          .where(~F.col("lh").eqNullSafe(F.col("rh"))).select("archive", "range"), f"differ_{level}")
    found = []
    for leaf, n in zip(sides, "lr"):
        inside = leaf.withColumn("range", F.shiftright("offset", LEAF_BITS)).join(bad, ["archive", "range"], "left_semi")
        copy = F.row_number().over(Window.partitionBy("archive", "offset", "hash").orderBy("length"))
        found.append(inside.withColumn("copy", copy).select("archive", "offset", "hash", "copy", F.col("length").alias(f"{n}_length"), F.lit(True).alias(n)))
    both = found[0].join(found[1], ["archive", "offset", "hash", "copy"], "full").where("l is null or r is null")
    nth = F.row_number().over(Window.partitionBy("archive", "offset", "side").orderBy("hash", "copy"))
    lone = both.withColumn("side", F.col("l").isNotNull()).withColumn("nth", nth)
    a = lone.where("side").select("archive", "offset", "nth", F.col("hash").alias("left_hash"), F.col("l_length").alias("left_length"))
    b = lone.where("not side").select("archive", "offset", "nth", F.col("hash").alias("right_hash"), F.col("r_length").alias("right_length"))
    status = F.when(F.col("right_hash").isNull(), "missing").when(F.col("left_hash").isNull(), "extra").otherwise("changed")
    return a.join(b, ["archive", "offset", "nth"], "full").select(
        F.when(F.col("archive") != "\0", F.col("archive")).alias("archive"), "offset", status.alias("status"), "left_length", "right_length",
        "left_hash", "right_hash", F.lit(levels + 1).alias("depth"))


def damage(records: DataFrame) -> DataFrame:
    """A replica with faults: by the record's hash, one in 101 has a changed
    byte, one in 103 is cut short, one in 107 is gone."""
    n = F.conv(F.substring(F.sha2("record", 256), 1, 8), 16, 10).cast("long")
    size = F.octet_length("record")
    cut = F.when(n % 101 == 0, F.concat(F.substring("record", F.lit(1), size - 1), F.lit("#").cast("binary"))).when(
        n % 103 == 0, F.substring("record", F.lit(1), F.floor(size / 2).cast("int"))).otherwise(F.col("record"))
    return records.where(n % 107 != 0).withColumn("record", cut)


def op8_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages' archive against a replica with known faults."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = archive_pages(pages)
    return audit(records, damage(records))


OP8_SQL = r"""
WITH p AS (
  SELECT page_id AS id, encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z'
    || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
    || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10)) AS rec
  FROM pages
), r AS (
  SELECT id, 'a' || (id // 256) AS archive, octet_length(rec) AS len, rec, sha256(rec) AS sha FROM p
), o AS (
  SELECT *, coalesce(sum(len) OVER (PARTITION BY archive ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ofs,
         ('0x' || substr(sha, 1, 8))::BIGINT AS n
  FROM r
), d AS (
  SELECT *, CASE WHEN n % 107 = 0 THEN NULL
                 WHEN n % 101 = 0 THEN unhex(substr(hex(rec), 1, 2 * (len - 1)) || '23')
                 WHEN n % 103 = 0 THEN unhex(substr(hex(rec), 1, 2 * (len // 2))) ELSE rec END AS bad
  FROM o
)
SELECT archive, ofs AS "offset", CASE WHEN bad IS NULL THEN 'missing' ELSE 'changed' END AS status,
       len AS left_length, octet_length(bad) AS right_length,
       sha256(ofs || ':' || len || ':' || sha) AS left_hash,
       sha256(ofs || ':' || octet_length(bad) || ':' || sha256(bad)) AS right_hash, 7 AS depth
FROM d WHERE bad IS NULL OR bad <> rec
"""
