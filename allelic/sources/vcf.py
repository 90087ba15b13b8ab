"""Multi-sample VCF text -> call table (A1, A2, A10), as one Spark job.

Plan: ``read.text`` (plus ``_metadata.file_path``) -> header lines give each
file's sample list -> body lines join their file's header -> ``posexplode``
of the sample list yields one row per (site, sample) -> FORMAT/INFO parsed
with built-in array / map expressions.  No Python runs per row.

Header join: the header side holds one row per file with that file's
samples.  Headers sit at the start of each file, so they are read from the
file prefixes only (one small task per group of files, ``mapInPandas`` over
the file list); the body scan is the only full pass over the text.  Where a
file lies in a store that Python cannot open, the headers of all files come
from a scan of the text instead, by the same rules: the first ``#CHROM`` line
of a file is its header, a file without one and records before it are errors,
raised on the driver.  Files of a cohort mostly have the same header, so a file
only carries the hash of its sample list, and each distinct list stands once.
The size of the distinct lists is measured first; under ``max_broadcast_samples`` they are
broadcast, otherwise they are exploded to (list, index, sample) and joined on
(list, index) after the body is exploded, a balanced shuffle join with no hot
key.

Semantics (fixed by the reference parser): lines are stripped; blank and
``#`` lines skipped; body lines with fewer than 9 + n_samples fields are
skipped, extra fields ignored; contig lower-cased; QUAL ``.`` -> 0.0; INFO
split on ``;`` with the first ``=`` separating key and value, bare tokens
become ``true``, keys lower-cased, a repeated key keeps its last value;
FORMAT keys zip with the sample's fields truncated to the shorter; GT
defaults to ``./.``; DP / GQ that are not all digits become 0; AD missing
becomes ''.  Every genotype is kept, including 0/0 and ./.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from allelic.schema import CALL_COLUMNS
from allelic.session import few_listing_tasks, scratch_path
from allelic.sources.bgzf import SPLIT_BYTES, block_size, gzip_lines

# The header reader runs in Python workers; ship this module's functions by
# value so workers need no installed copy of the package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files / install
    pass

MAX_BROADCAST_SAMPLES = 2_000_000  # files x samples held by the broadcast header
MAX_BROADCAST_FILES = 100_000  # (file, sample count) rows held by a broadcast
#: The header line by which a file declares its absent cell.
ABSENT_META = "##allelic_absent_cell="
DEFAULT_COHORT, DEFAULT_ENGINE = "synthetic_v1", "s3_tables"
_BLANKS = " \t\n\r\x0b\x0c"


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _is_gzip(path: str) -> bool:
    return path.endswith((".gz", ".bgz"))


def read_lines(spark: SparkSession, paths, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stripped text lines with their file path; block-gzip files are read in
    parts of ``split_bytes`` where Python can open them."""
    return _lines(spark, *_listed(spark, paths), split_bytes)


def _lines(spark: SparkSession, text: DataFrame, inputs: list[str], split_bytes: int) -> DataFrame:
    line = F.btrim("line", F.lit(_BLANKS)).alias("line")
    packed = [p for p in inputs if _is_gzip(p)]
    if packed and _prefix_readable(packed):
        out = gzip_lines(spark, packed, split_bytes).select(path_key(F.col("uri")).alias("file"), line)
        rest = [p for p in inputs if not _is_gzip(p)]
        return out.unionByName(_text_lines(_text(spark, rest)).select("file", line)) if rest else out
    unread = [p for p in packed if p.endswith(".bgz")]
    if unread:  # Spark's text reader chooses the codec by suffix and does not know this one
        raise ValueError(f"block-gzip files in this store must be named .gz: {unread[:5]}")
    # small files are several to a task, which Spark's cost of a file keeps apart
    size = int(str(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-size // SPLIT_BYTES))
    return _text_lines(text).select("file", line).coalesce(tasks)


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    with few_listing_tasks(spark):
        return spark.read.text(paths)


def _text_lines(text: DataFrame) -> DataFrame:
    """Lines with their file and, to order them in it, block and number."""
    return text.select(
        path_key(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("number"))


def _listed(spark: SparkSession, paths) -> tuple[DataFrame, list[str]]:
    """The text under the paths and its files, listed once."""
    try:
        text = _text(spark, _as_list(paths))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"VCF file not found: {paths}") from e
        raise
    return text, text.inputFiles()


def input_files(spark: SparkSession, paths) -> list[str]:
    return _listed(spark, paths)[1]


def path_key(c: Column) -> Column:
    """File identity without the URI scheme (``file:///x`` == ``file:/x``)."""
    return F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


_HEADER = "uri string, samples array<string>, absent string, early boolean, plain_gzip boolean"


def _read_header_prefixes(batches):
    """mapInPandas body: for each file URI read lines up to ``#CHROM``.
    ``samples`` is null without a header, ``early`` says that records came
    before it."""
    import io

    import pandas as pd
    import pyarrow.fs as pfs
    for pdf in batches:
        rows = []
        for uri in pdf["uri"]:
            fs, path = pfs.FileSystem.from_uri(uri)
            got, absent, early, plain = None, None, False, False
            with fs.open_input_file(path) as raw:
                if _is_gzip(uri):
                    plain = not block_size(raw.read(1 << 16))
                    raw.seek(0)
                    import gzip
                    stream = gzip.GzipFile(fileobj=raw)
                else:
                    stream = raw
                for line in io.TextIOWrapper(stream, encoding="utf-8"):
                    line = line.strip()
                    if line.startswith(ABSENT_META):
                        absent = line[len(ABSENT_META):]
                    if line.startswith("#CHROM"):
                        parts = line.split("\t")
                        got = parts[9:] if len(parts) > 9 else []
                        break
                    early = early or bool(line) and not line.startswith("#")
            rows.append((uri, got, absent, early, plain))
        yield pd.DataFrame(rows, columns=["uri", "samples", "absent", "early", "plain_gzip"])


def _prefix_readable(uris: list[str]) -> bool:
    """Whether Python can open the stores of all files."""
    import pyarrow.fs as pfs
    for uri in {u.partition(":")[0]: u for u in uris}.values():
        try:
            pfs.FileSystem.from_uri(uri)
        except Exception:  # noqa: BLE001 - unsupported scheme / missing driver
            return False
    return True


def header_prefixes(spark: SparkSession, uris: list[str]) -> DataFrame:
    """(file, samples, absent, early, plain_gzip): one row per file, from the
    file prefixes."""
    files = spark.createDataFrame([(u,) for u in uris], "uri string")
    n = max(1, min(len(uris), spark.sparkContext.defaultParallelism))
    h = files.repartition(n).mapInPandas(_read_header_prefixes, _HEADER)
    return h.withColumn("file", path_key(F.col("uri"))).drop("uri")


def header_scan(spark: SparkSession, uris: list[str]) -> DataFrame:
    """The same from a scan of the text."""
    place, line = F.struct("block", "number"), F.btrim("line", F.lit(_BLANKS))
    rows = _text_lines(_text(spark, uris)).withColumn("line", line).where("line <> ''")
    h = F.split("line", "\t")
    samples = F.when(F.size(h) > 9, F.slice(h, 10, F.greatest(F.size(h) - 9, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    header, meta = F.col("line").startswith("#CHROM"), F.col("line").startswith(ABSENT_META)
    seen = rows.groupBy("file").agg(
        F.min(F.when(header, F.struct("block", "number", samples.alias("samples")))).alias("h"),
        F.min(F.when(~F.col("line").startswith("#"), place)).alias("body"),
        F.min(F.when(meta, F.struct("block", "number", F.substring("line", len(ABSENT_META) + 1, 1 << 20).alias("absent")))).alias("m"))
    first = F.struct(F.col("h.block").alias("block"), F.col("h.number").alias("number"))
    files = spark.createDataFrame([(u,) for u in uris], "uri string").select(path_key(F.col("uri")).alias("file"), "uri")
    return files.join(seen, "file", "left").select(
        "file", F.col("h.samples").alias("samples"), F.col("m.absent").alias("absent"),
        F.coalesce(F.col("body") < first, F.lit(False)).alias("early"), F.col("uri").endswith("gz").alias("plain_gzip"))


def vcf_samples(spark: SparkSession, paths) -> DataFrame:
    """(file, sample_index, sample_id) for every file; raises ValueError when
    a file has no ``#CHROM`` header."""
    hdr, _, _ = resolve_headers(spark, input_files(spark, paths))
    return hdr.select("file", F.posexplode("samples").alias("sample_index", "sample_id"))


def info_to_json(info: Column) -> Column:
    """INFO text -> JSON object text (values are strings; flags 'true';
    keys lower-cased; a repeated key keeps its last value)."""
    items = F.filter(F.split(info, ";"), lambda x: x != "")
    entries = F.transform(items, lambda x: F.named_struct(
        F.lit("k"), F.lower(F.split(x, "=", 2)[0]),
        F.lit("v"), F.when(F.instr(x, "=") > 0, F.split(x, "=", 2)[1]).otherwise(F.lit("true"))))
    last = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda o: o["k"] == e["k"]))
    return F.to_json(F.map_from_entries(last))


FORMAT_KEYS = ["GT", "DP", "GQ", "AD"]


def _last_pos(fmt: Column, key: str) -> Column:
    """1-based position of the last ``key`` in the FORMAT keys, 0 if absent
    (computed once per line)."""
    r = F.array_position(F.reverse(fmt), F.lit(key))
    return F.when(r > 0, F.size(fmt) - r + 1).otherwise(F.lit(0)).cast("int")


def _format_value(fmt: Column, pos: Column, sf: Column, key: str) -> Column:
    """Value of ``key`` for one sample: FORMAT keys zipped with the sample's
    fields, truncated to the shorter, last duplicate wins.  Fast path: the
    last occurrence lies inside the sample's fields, so it is the answer.
    Otherwise (truncated duplicate) search the truncated zip."""
    n = F.least(F.size(fmt), F.size(sf))
    zipped = F.zip_with(F.slice(fmt, 1, n), F.slice(sf, 1, n),
                        lambda k, v: F.named_struct(F.lit("k"), k, F.lit("v"), v))
    slow = F.try_element_at(F.filter(zipped, lambda x: x["k"] == key), F.lit(-1))["v"]
    return (F.when((pos > 0) & (pos <= F.size(sf)), F.try_element_at(sf, pos))
             .when(pos > 0, slow))


def _digits_or_zero(v: Column) -> Column:
    return F.when(v.rlike("^[0-9]+$"), F.coalesce(v.try_cast("int"), F.lit(0))).otherwise(F.lit(0))


def _list_key(samples: Column) -> Column:
    return F.md5(F.to_json(samples))


def resolve_headers(spark: SparkSession, inputs: list[str], validate: bool = True) -> tuple[DataFrame, int, int]:
    """(header frame: file, samples, absent), samples of all distinct lists,
    and the number of ordinary gzip files.  Two aggregate rows reach the
    driver."""
    found = header_prefixes(spark, inputs) if _prefix_readable(inputs) else header_scan(spark, inputs)
    path = scratch_path(spark, "vcf_headers")  # read once, and looked at several times
    found.write.parquet(path)
    hdr = spark.read.schema(found.schema).parquet(path)
    lost, early = F.when(F.col("samples").isNull() & ~F.col("early"), F.col("file")), F.when(F.col("early"), F.col("file"))
    lists = hdr.where(F.col("samples").isNotNull()).groupBy(_list_key(F.col("samples"))).agg(F.max(F.size("samples")).alias("n"))
    total = lists.agg(F.sum("n")).first()[0] or 0
    r = hdr.agg(F.count_if("plain_gzip").alias("plain_gzip"), F.count(lost).alias("n_lost"),
                F.min(lost).alias("lost"), F.count(early).alias("n_early"), F.min(early).alias("early")).first()
    if validate and r["n_lost"]:
        raise ValueError(f"Invalid VCF: No '#CHROM' header found in {r['n_lost']} files, such as {r['lost']}")
    if validate and r["n_early"]:
        raise ValueError(f"Invalid VCF: records before the '#CHROM' header in {r['n_early']} files, such as {r['early']}")
    return hdr.where(F.col("samples").isNotNull()).select("file", "samples", "absent"), total, r["plain_gzip"]


def read_vcf(spark: SparkSession, paths, cohort_id: str = DEFAULT_COHORT,
             engine: str = DEFAULT_ENGINE, max_broadcast_samples: int = MAX_BROADCAST_SAMPLES,
             validate_headers: bool = True, repartition_compressed: bool = True,
             carry: dict | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Parse VCF files (plain, gzip or block-gzip) into the 15-column call
    table.  ``carry`` adds per-line columns (expressions over ``file``, e.g. a
    batch id taken from the path) that are kept on every call."""
    text, inputs = _listed(spark, paths)
    lines = _lines(spark, text, inputs, split_bytes)
    for name, expr in (carry or {}).items():
        lines = lines.withColumn(name, expr)
    hdr, total, plain_gzip = resolve_headers(spark, inputs, validate_headers)
    if repartition_compressed and plain_gzip:
        # such a file is one task: spread its lines before exploding
        lines = lines.repartition(spark.sparkContext.defaultParallelism * 2)
    return parse_lines(lines, hdr, total <= max_broadcast_samples, cohort_id, engine,
                       extra=list(carry or {}), n_files=len(inputs))


def parse_lines(lines: DataFrame, hdr: DataFrame, broadcast_header: bool,
                cohort_id: str = DEFAULT_COHORT, engine: str = DEFAULT_ENGINE,
                extra: list | None = None, n_files: int | None = None) -> DataFrame:
    """(file, line) rows + per-file headers (file, samples, absent) -> calls.  ``extra`` columns of
    ``lines`` (e.g. a batch id) are carried to the output."""
    extra = extra or []
    body = lines.where((F.length("line") > 0) & ~F.col("line").startswith("#"))
    body = body.select("file", F.split("line", "\t").alias("f"), *extra)
    site_cols = [
        F.lower(F.col("f")[0]).alias("reference_name"),
        F.col("f")[1].cast("long").alias("start"),
        F.col("f")[3].alias("reference_bases"),
        F.col("f")[4].alias("alternate_bases"),
        F.when(F.col("f")[5] == ".", F.lit(0.0)).otherwise(F.col("f")[5].cast("double"))
         .alias("qual"),
        F.col("f")[6].alias("filter"),
        info_to_json(F.col("f")[7]).alias("attributes"),
        F.split(F.col("f")[8], ":").alias("fmt"),
    ]
    line_cols = site_cols + [_last_pos(F.split(F.col("f")[8], ":"), k).alias(f"p_{k}")
                             for k in FORMAT_KEYS]
    # A row a file, and a row a distinct list: the first is broadcast behind a
    # check of the file count, the second behind one of its samples.
    hdr = hdr.withColumn("list", _list_key(F.col("samples")))
    files = hdr.select("file", "list", "absent", F.size("samples").alias("n_samples"))
    if n_files is not None and n_files <= MAX_BROADCAST_FILES:
        files = F.broadcast(files)
    lists = hdr.groupBy("list").agg(F.first("samples").alias("samples"))
    j = body.join(files, "file").where(F.size("f") >= F.col("n_samples") + 9)
    # The generator emits only the sample's own cell: the line's field array
    # is not carried into every exploded row (that would copy it n times).
    if broadcast_header:
        j = j.join(F.broadcast(lists), "list")
        cells = F.zip_with("samples", F.slice("f", 10, F.size("samples")),
                           lambda sm, c: F.named_struct(F.lit("s"), sm, F.lit("c"), c))
        cells = F.when(F.col("absent").isNull(), cells).otherwise(F.filter(cells, lambda x: x["c"] != F.col("absent")))
        # Line-level columns are projected before the explode; expressions
        # next to a generator in one select would be evaluated per output row.
        per_line = j.select(*extra, *line_cols, cells.alias("cells"))
        keep = [c for c in per_line.columns if c != "cells"]
        calls = (per_line.select(*keep, F.explode("cells").alias("cell"))
                 .select(*keep, F.col("cell")["s"].alias("sample_id"),
                         F.col("cell")["c"].alias("c")))
    else:
        per_line = j.select("list", "absent", *extra, *line_cols,
                            F.slice("f", 10, F.col("n_samples")).alias("cells"))
        keep = [c for c in per_line.columns if c != "cells"]
        calls = per_line.select(*keep, F.posexplode("cells").alias("idx", "c"))
        calls = calls.where("absent is null or c <> absent").drop("absent")
        names = lists.select("list", F.posexplode("samples").alias("idx", "sample_id"))
        calls = calls.join(names, ["list", "idx"])
    sf = F.split(F.col("c"), ":")
    calls = calls.withColumn("sf", sf)

    def val(k):
        return _format_value(F.col("fmt"), F.col(f"p_{k}"), F.col("sf"), k)
    out = calls.select(
        "reference_name", "start",
        (F.col("start") + F.length("reference_bases") - 1).alias("end_pos"),
        "reference_bases", "alternate_bases", "sample_id",
        F.coalesce(val("GT"), F.lit("./.")).alias("genotype"),
        "qual", "filter",
        _digits_or_zero(val("DP")).alias("dp"),
        _digits_or_zero(val("GQ")).alias("gq"),
        F.coalesce(val("AD"), F.lit("")).alias("allele_depth"),
        "attributes",
        F.lit(cohort_id).alias("cohort_id"),
        F.lit(engine).alias("engine"),
        *extra,
    )
    return out.select(*CALL_COLUMNS, *extra)


def read_vcf_rejects(spark: SparkSession, paths) -> DataFrame:
    """Body lines the reader skips because they have fewer than 9 + n_samples
    fields: (file, line, n_fields, expected_fields).  The reference parser
    logs one warning per such line; here they are a DataFrame to inspect."""
    text, inputs = _listed(spark, paths)
    lines = _lines(spark, text, inputs, SPLIT_BYTES)
    hdr, _, _ = resolve_headers(spark, inputs)
    body = lines.where((F.length("line") > 0) & ~F.col("line").startswith("#"))
    n = hdr.select("file", (F.size("samples") + 9).alias("expected_fields"))
    if len(inputs) <= MAX_BROADCAST_FILES:
        n = F.broadcast(n)
    return (body.join(n, "file")
                .select("file", "line", F.size(F.split("line", "\t")).alias("n_fields"),
                        "expected_fields")
                .where(F.col("n_fields") < F.col("expected_fields")))
