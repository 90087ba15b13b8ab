"""Property test: the Spark VCF parser against a brute-force model of the
parsing rules, on randomly generated lines (small fixture, exhaustive compare)."""

import json
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from allelic.sources.vcf import read_vcf

SAMPLES = ["S1", "S2", "S3"]
KEYS = ["GT", "DP", "GQ", "AD", "PL"]
tok = st.sampled_from(["0/1", "1/1", "0/0", "./.", "0|1", "12", "7", "x", "", "-3", "3,4", "."])
info_item = st.one_of(
    st.sampled_from(["DB", "H2", ".", ""]),
    st.tuples(st.sampled_from(["AF", "GENE", "gene", "K"]), st.sampled_from(["1", "a=b", "APP", ""]))
      .map(lambda kv: f"{kv[0]}={kv[1]}"))


@st.composite
def vcf_line(draw):
    fmt = draw(st.lists(st.sampled_from(KEYS), min_size=1, max_size=5))
    n_cells = draw(st.integers(min_value=1, max_value=4))  # 1..2 short rows get dropped
    cells = [":".join(draw(st.lists(tok, min_size=0, max_size=6))) for _ in range(n_cells)]
    info = ";".join(draw(st.lists(info_item, min_size=0, max_size=4))) or "."
    pos = draw(st.integers(min_value=1, max_value=10**9))
    qual = draw(st.sampled_from([".", "10", "3.5"]))
    ref = draw(st.sampled_from(["A", "ATG", "GC"]))
    return "\t".join([draw(st.sampled_from(["chr1", "CHR2", "chrX"])), str(pos), ".", ref, "T",
                      qual, "PASS", info, ":".join(fmt)] + cells)


def model(lines):
    """Brute-force statement of the documented rules."""
    out = {}
    for raw in lines:
        line = raw.strip()
        if not line or line.startswith("#"):
            continue
        f = line.split("\t")
        if len(f) < 9 + len(SAMPLES):
            continue
        attrs = {}
        for item in f[7].split(";"):
            if not item:
                continue
            key, sep, val = item.partition("=")
            attrs[key.lower()] = val if sep else "true"
        keys = f[8].split(":")
        for i, s in enumerate(SAMPLES):
            d = {}
            for k, v in zip(keys, f[9 + i].split(":")):
                d[k] = v

            def num(k):
                v = d.get(k, "")
                return int(v) if v.isdigit() else 0
            out[(f[0].lower(), int(f[1]), s)] = (
                d.get("GT", "./."), num("DP"), num("GQ"), d.get("AD", ""),
                0.0 if f[5] == "." else float(f[5]), int(f[1]) + len(f[3]) - 1, attrs)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(vcf_line(), min_size=5, max_size=40,
                unique_by=lambda ln: (ln.split("\t")[0].lower(), ln.split("\t")[1])))
def test_parser_matches_model(spark, lines):
    d = tempfile.mkdtemp(prefix="allelic-prop-")
    p = os.path.join(d, "p.vcf")
    with open(p, "w") as fh:
        fh.write("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(SAMPLES)
                 + "\n" + "\n".join(lines) + "\n")
    got = {}
    for r in read_vcf(spark, p).collect():
        got[(r["reference_name"], r["start"], r["sample_id"])] = (
            r["genotype"], r["dp"], r["gq"], r["allele_depth"], r["qual"], r["end_pos"],
            json.loads(r["attributes"]))
    want = model(lines)
    assert set(got) == set(want)
    assert got == want
