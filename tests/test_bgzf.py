"""Block-gzip files: ranges at any offset, other gzip files, the writer."""

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from allelic.sinks.bgzf import LAST, block, write_block_gzip
from allelic.sources.bgzf import block_size, first_block, gzip_lines, gzip_ranges, range_text
from allelic.sources.vcf import read_vcf, vcf_samples


class File(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def blocked(text: bytes, size: int) -> bytes:
    return b"".join(block(text[at:at + size]) for at in range(0, len(text), size)) + LAST


def lines_of(raw: bytes, step: int) -> list[bytes]:
    out = []
    for start in range(0, len(raw), step):
        text = b"".join(range_text(File(raw), start, min(start + step, len(raw))))
        out += text.removesuffix(b"\n").split(b"\n") if text else []
    return out


TEXTS = [b"one\ntwo\nthree\n", b"no last break\nhere", b"\n\n\n", b"x" * 5000 + b"\n" + b"y" * 5000, b"a\n" * 3000, b"only one line"]


@pytest.mark.parametrize("size", [1, 7, 100, 65_280])
@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_each_line_belongs_to_one_range(text, size):
    if size == 1:
        text = text[:200]
    raw = blocked(text, size)
    assert gzip.decompress(raw) == text
    for step in (1 if len(raw) < 2000 else 37, 29, 64, 500, len(raw)):
        assert lines_of(raw, step) == text.removesuffix(b"\n").split(b"\n")


def test_random_texts_and_offsets():
    rnd = random.Random(5)
    for _ in range(40):
        text = b"\n".join(bytes(rnd.choices(b"abc\x1f\x8b\x08\x04", k=rnd.randrange(60))) for _ in range(80))
        raw = blocked(text, rnd.randrange(5, 400))
        assert lines_of(raw, rnd.randrange(20, 300)) == text.removesuffix(b"\n").split(b"\n")


def test_a_header_in_the_data_is_no_block():
    trap = block(b"inner")  # stored as it is inside a block
    raw = block(os.urandom(300) + trap[:18] + os.urandom(300)) + block(b"next\n") + LAST
    at = raw.find(trap[:4], 4)
    real = block_size(raw)
    assert first_block(File(raw), 1, len(raw)) == real
    assert at == -1 or at == real or first_block(File(raw), at, at + 1) is None


def test_files_in_spark(spark, tmpdir_path):
    rnd = random.Random(2)
    text = "\n".join(f"line {k} {rnd.random()}" for k in range(20_000)) + "\n"
    for name, raw in (("a.gz", blocked(text.encode(), 9000)), ("b.bgz", blocked(text.encode(), 65_280)), ("c.gz", gzip.compress(text.encode())),
                      ("d.gz", gzip.compress(b"x\n") + gzip.compress(b"y")), ("e.gz", b"")):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(raw)
    paths = [f"file:{tmpdir_path}/{n}" for n in ("a.gz", "b.bgz", "c.gz", "d.gz", "e.gz")]
    df = gzip_lines(spark, paths, 20_000)
    got = {r.f: r.n for r in df.groupBy(F.element_at(F.split("uri", "/"), -1).alias("f")).agg(F.count("*").alias("n")).collect()}
    assert got == {"a.gz": 20_000, "b.bgz": 20_000, "c.gz": 20_000, "d.gz": 2}
    assert sorted(r.line for r in df.where("uri like '%a.gz'").collect()) == sorted(text.splitlines())
    ranges = gzip_ranges(spark, paths[:1], 20_000)
    assert ranges.rdd.getNumPartitions() == ranges.count() > 5
    # the lines of one file really come from several tasks
    tasks = gzip_lines(spark, paths[:1], 20_000).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5


def test_vcf_from_block_gzip_equals_plain(spark, tmpdir_path):
    rows = [f"chr1\t{k}\t.\tA\tG\t9\tPASS\tGENE=X\tGT:DP\t0/1:{k % 50}\t./.:." for k in range(3000)]
    head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2"]
    os.makedirs(f"{tmpdir_path}/plain")
    with open(f"{tmpdir_path}/plain/part-0.vcf", "w") as f:
        f.write("\n".join(head + rows) + "\n")
    done = write_block_gzip(spark, f"{tmpdir_path}/plain", f"{tmpdir_path}/packed", block_bytes=2000).collect()
    assert len(done) == 1 and done[0].blocks > 50
    plain = sorted(map(tuple, read_vcf(spark, f"{tmpdir_path}/plain").collect()))
    for step in (997, 1 << 20):
        assert sorted(map(tuple, read_vcf(spark, f"{tmpdir_path}/packed", split_bytes=step).collect())) == plain
    assert [r.sample_id for r in vcf_samples(spark, f"{tmpdir_path}/packed").orderBy("sample_index").collect()] == ["S1", "S2"]


def test_truncated_files_are_errors(spark, tmpdir_path):
    whole = blocked(b"some text\n" * 1000, 500)
    for name, raw in (("cut.gz", whole[:-len(LAST) - 5]), ("plain.gz", gzip.compress(os.urandom(5000))[:-9])):
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(raw)
        with pytest.raises(Exception, match="truncated"):
            gzip_lines(spark, [f"file:{tmpdir_path}/{name}"], 1 << 20).count()
