"""Secret scan (DataFrame functions only).

Base rules find assignments, access keys and hex runs by pattern.  The method
adds tokens that read like random strings: two character Markov models, one of
random strings and one of ordinary identifiers, give each candidate token a
log-likelihood ratio.  Both are trained from labelled samples of the corpus:
strings that the base rules take as secrets, and words of ordinary text.
Models are bigram counts over a fixed alphabet, so they have a fixed size; the
scan itself reads every row and whole text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import WORD, documents, let, materialise, running, text_of

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "random")
ANY = f"(?:{ASSIGN})|(?:{ACCESS})|(?:{HEX})"
ASSIGN_VALUE = 12
#: Positions of a character in a model: the alphabet, then start, then end.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
N = len(ALPHABET) + 2
#: Most documents that train a model; those with the smallest id hash.
TRAIN_DOCS = 20_000
SMOOTH = 0.5
#: Added pseudo-random strings per class that training always has: a model of
#: random strings is close to uniform within the characters that occur.
PRIOR = 2.0
#: A token is a secret at this mean log-likelihood ratio a character; one of
#: small letters, capitals or digits alone needs the second.
LLR, LLR_ONE_CLASS = 0.5, 1.0


def spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs ``s``, ``e`` (code points,
    end exclusive) and ``v`` (the group); matches with a shorter group go."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.zip_with(
        F.zip_with(F.transform(pieces, F.char_length), F.transform(found, F.char_length),
                   lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))),
        value, lambda x, v: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), v.alias("v")))
    # the piece behind the last match has none
    steps = F.filter(steps, lambda x: x["hit"].isNotNull())
    placed = let(steps, lambda items: running(items, "struct<gap:int,hit:int,v:string>", lambda x: x["gap"] + x["hit"],
                                              lambda a, b: a + b, F.lit(0)))
    out = F.transform(placed, lambda p: F.struct(
        (p["before"] + p["x"]["gap"]).alias("s"), (p["before"] + p["x"]["gap"] + p["x"]["hit"]).alias("e"), p["x"]["v"].alias("v")))
    return F.filter(out, lambda x: F.char_length(x["v"]) >= least) if least else out


def _uncovered(cand: Column, base: Column) -> Column:
    """Candidates that no base span covers whole.  In order of their starts, a
    span before it that reaches its end covers a candidate."""
    kind = "struct<s:int,k:int,e:int,v:string>"
    return F.transform(F.filter(let(F.array_sort(F.concat(base, cand)), lambda items: running(
        items, kind, lambda x: F.when(x["k"] < 3, x["e"]).otherwise(F.lit(-1)), lambda a, b: F.greatest(a, b), F.lit(-1))),
        lambda p: (p["x"]["k"] == 3) & (p["before"] < p["x"]["e"])), lambda p: p["x"])


def _codes(token: Column) -> Column:
    """Alphabet positions of the characters, from 1, between start and end."""
    chars = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.concat(F.array(F.lit(N - 1)), F.filter(chars, lambda c: c > 0), F.array(F.lit(N)))


def _cells(tokens: DataFrame) -> DataFrame:
    """Bigram counts of the ``token`` column of each ``kind``: at most
    ``N * N`` rows a kind."""
    pairs = let(_codes(F.col("token")), lambda c: F.transform(
        F.sequence(F.lit(1), F.size(c) - 1), lambda i: (F.element_at(c, i) - 1) * N + F.element_at(c, i + 1)))
    return tokens.select("kind", F.explode(pairs).alias("cell")).groupBy("kind", "cell").agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = TRAIN_DOCS) -> list[float]:
    """Log ratio of the transition probabilities, random over ordinary, by
    cell; trained on at most ``max_docs`` documents."""
    sample = (docs.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(id_col).alias("id"))
              .orderBy("h", "id").limit(max_docs).select("id").distinct())
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).join(
        F.broadcast(sample), "id", "left_semi")  # at most max_docs ids
    t = F.col("t")
    random = F.concat(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)),
                      F.regexp_extract_all(t, F.lit(HEX), F.lit(0)))
    plain = F.filter(F.regexp_extract_all(F.regexp_replace(t, ANY, " "), F.lit(WORD), F.lit(0)),
                     lambda w: w.rlike("^[A-Za-z_-]{5,40}$"))
    tokens = (rows.select(F.explode(F.concat(
        F.transform(F.filter(random, lambda w: F.char_length(w) >= ASSIGN_VALUE), lambda w: F.struct(F.lit("random").alias("kind"), w.alias("token"))),
        F.transform(F.array_distinct(plain), lambda w: F.struct(F.lit("plain").alias("kind"), w.alias("token"))))).alias("x"))
        .select("x.*"))
    counts = {(r.kind, r.cell - 1): r.n for r in _cells(tokens).collect()}
    out = [0.0] * (N * N)
    k = len(ALPHABET)
    classes = [range(0, 26), range(26, 52), range(52, 62), range(62, k)]
    of = {c: set(cl) for cl in classes for c in cl}
    for a in range(N):
        r = [counts.get(("random", a * N + b), 0) for b in range(k)]
        # random strings without training data of their class: uniform over letters and digits
        r = [x + PRIOR * (1.0 if b < 62 else 0.25) for b, x in enumerate(r)]
        p = [counts.get(("plain", a * N + b), 0) + SMOOTH * (1.0 if a < k and b in of[a] else 0.25) for b in range(k)]
        rs, ps = sum(r), sum(p)
        for b in range(k):
            out[a * N + b] = round(math.log(r[b] / rs) - math.log(p[b] / ps), 6)
    return out


def score(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio a character, random over ordinary."""
    table = F.from_json(F.lit("[" + ",".join(map(str, model)) + "]"), "array<double>")
    return let(_codes(token), lambda c: F.aggregate(
        F.sequence(F.lit(1), F.size(c) - 2), F.lit(0.0),
        lambda s, i: s + F.element_at(table, (F.element_at(c, i) - 1) * N + F.element_at(c, i + 1)))
        / F.greatest(F.size(c) - 2, F.lit(1)))


def _one_class(v: Column) -> Column:
    return v.rlike(r"^([a-z]+|[A-Z]+|[0-9]+)\z")


def find_secrets(docs: DataFrame, model: list[float] | None = None, id_col: str = "doc_id",
                 text_col: str = "text", llr: float = LLR, llr_one_class: float = LLR_ONE_CLASS) -> DataFrame:
    """One row per input row: id and ``found``, an array of structs ``kind``,
    ``s``, ``e``, ``v``, by start, then kind in the order of ``KINDS``.

    Null and empty texts have no spans.  A random-string span is dropped when
    a base span covers it whole; base spans always stay.  Rows repeated in full
    are scanned alike.  An empty table gives an empty result (and a model of
    the priors alone).  Other columns are ignored.
    """
    model = train(docs, id_col, text_col) if model is None else model
    t = F.col("t")
    base = lambda k, a: F.transform(a, lambda x: F.struct(
        x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["v"].alias("v")))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    none = F.lit([]).cast("array<struct<s:int,k:int,e:int,v:string>>")
    found = F.when(t.rlike(ANY), F.concat(
        base(0, spans(t, ASSIGN, 2, ASSIGN_VALUE)), base(1, spans(t, ACCESS)), base(2, spans(t, HEX)))).otherwise(none)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).select(
        "id", found.alias("base"), F.when(t.rlike(CANDIDATE), base(3, spans(t, CANDIDATE))).otherwise(none).alias("cand"))
    # few rows and short columns from here on: the text scan is not repeated
    rows = materialise(docs.sparkSession, rows, "secret_spans")
    extra = F.filter(_uncovered(F.col("cand"), F.col("base")),
                     lambda c: score(c["v"], model) >= F.when(_one_class(c["v"]), llr_one_class).otherwise(llr))
    return rows.select(F.col("id").alias(id_col), F.transform(
        F.array_sort(F.concat("base", extra)), lambda x: F.struct(
            F.get(kinds, x["k"]).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"))).alias("found"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("found", lambda x: x["kind"] != "random")
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    listed = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select(id_col, count("assign"), count("access"), count("hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(documents(spark, sf_dir)))
