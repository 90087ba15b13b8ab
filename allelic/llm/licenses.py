"""License scan by sentence rules (DataFrame functions only).

A text is cut into sentences, and these into the pieces at which a sentence
may end or go on (line ends, semicolons, colons).  Pieces in a row are joined,
normalised, and looked up among the known licence sentences by an equality
join; a known sentence that lies in a longer one does not count.  Their
identifiers in reading order form the document's sequence, in which ordered
licence rules are matched, longer rules first.  The number of known sentences
does not add to the work per text.  Only texts with a word that every known
sentence has are cut, and of these only pieces that begin like one are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import documents, let, materialise, text_of

#: Known licence sentences (fixed values, public licence wording), by identifier from 1.
SENTENCES = (
    "This work is licensed under the GNU General Public License, version 3",
    "Licensed under the Apache License, Version 2.0",
    "Licensed under CC BY-NC 4.0",
    "Released under the MIT License",
    "you may not use this file except in compliance with the License",
    "You may obtain a copy of the License at",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "See the GNU General Public License for more details",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "SPDX-License-Identifier: Apache-2.0",
    "SPDX-License-Identifier: MIT",
    "SPDX-License-Identifier: GPL-3.0-or-later",
    "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "All rights reserved",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "This is free and unencumbered software released into the public domain",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "See the GNU Lesser General Public License for more details",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
)
#: Other published wordings of known sentences, with the identifier.
WORDINGS = (
    (2, "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    (10, SENTENCES[9] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, "
         "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
         "so, subject to the following conditions"),
    (20, SENTENCES[19].replace("and/or distribute", "and distribute")),
    (24, SENTENCES[23].replace("https:", "http:")),
    (26, SENTENCES[6].replace("version 3", "version 2")),
    (25, SENTENCES[24].replace("version 2.1", "version 3")),
)
#: Licences with the names by which short notices call them (fixed values).
NAMES = (
    ("mit", "MIT License", "MIT Licence", "MIT"),
    ("apache-2.0", "Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache-2.0"),
    ("gpl-2.0", "GNU General Public License v2.0", "GNU General Public License version 2", "GPLv2", "GPL-2.0"),
    ("gpl-3.0", "GNU General Public License v3.0", "GNU General Public License version 3", "GPLv3", "GPL-3.0"),
    ("lgpl-2.1", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License version 2.1", "LGPL-2.1"),
    ("lgpl-3.0", "GNU Lesser General Public License v3.0", "GNU Lesser General Public License version 3", "LGPLv3", "LGPL-3.0"),
    ("agpl-3.0", "GNU Affero General Public License v3.0", "GNU Affero General Public License version 3", "AGPLv3", "AGPL-3.0"),
    ("bsd-2-clause", "BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    ("bsd-3-clause", "BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    ("isc", "ISC License", "ISC"),
    ("mpl-2.0", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "MPL-2.0"),
    ("cc0-1.0", "CC0 1.0 Universal", "CC0 1.0", "CC0"),
    ("cc-by-4.0", "CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("unlicense", "Unlicense"),
    ("zlib", "zlib License"),
    ("epl-2.0", "Eclipse Public License 2.0", "EPL-2.0"),
)
#: Short notices: subject, verb and name of a licence.
SUBJECTS = ("", "This project is", "This software is", "This program is", "This work is", "This file is", "The code is", "This code is")
VERBS = ("licensed under", "released under", "distributed under")
#: Identifiers of the licences of NAMES in notices and in SPDX lines.
NOTICE, SPDX = 100, 200
#: Endings of SPDX identifiers of licences of the GNU family.
SPDX_ENDINGS = ("", "-only", "-or-later")


def _notices() -> list[tuple[int, str]]:
    """Notices and SPDX lines of each licence that are no known sentence."""
    out = []
    for k, (licence, *names) in enumerate(NAMES):
        for name in names:
            out += [(NOTICE + k, f"{s} {v} {the}{name}".strip()) for s in SUBJECTS for v in VERBS for the in ("", "the ")]
        ends = SPDX_ENDINGS if "gpl" in licence else SPDX_ENDINGS[:1]
        out += [(SPDX + k, f"SPDX-License-Identifier: {licence}{end}") for end in ends]
    return out


#: Ordered rules: licence and the sentence identifiers that follow one another
#: (other sentences between them do not count).
RULES = (
    ("gpl-3.0", (1,)), ("apache-2.0", (2,)), ("cc-by-nc-4.0", (3,)), ("mit", (4,)),
    ("apache-2.0", (2, 5, 6)), ("apache-2.0", (2, 5)),
    ("gpl-3.0", (7, 8, 9)), ("gpl-3.0", (7,)), ("mit", (10, 11)), ("mit", (10,)),
    ("bsd", (12, 13)), ("bsd", (12,)), ("apache-2.0", (14,)), ("mit", (15,)), ("gpl-3.0", (16,)),
    ("cc-by-4.0", (17,)), ("proprietary", (18,)), ("gpl-3.0", (1, 9)),
    ("mit", (10, 11, 19)), ("isc", (20,)), ("bsd-2-clause", (12, 13, 21)), ("bsd-3-clause", (12, 13, 21, 22)),
    ("mpl-2.0", (23, 24)), ("mpl-2.0", (23,)), ("lgpl", (25, 29, 30)), ("lgpl", (25,)), ("gpl-2.0", (26, 8, 9)), ("gpl-2.0", (26,)),
    ("unlicense", (27,)), ("agpl-3.0", (28,)), ("cc-by-sa-4.0", (31,)),
    *((licence, (NOTICE + k,)) for k, (licence, *_) in enumerate(NAMES)),
    *((licence, (SPDX + k,)) for k, (licence, *_) in enumerate(NAMES)),
)
#: Every known sentence has one of these.
TRIGGER = r"(?iu)licen[sc]e|copyright|permission|warranty|redistribut|reserved|unencumbered|mozilla|released|distributed"
#: Sentences end at . ! ? before white space or the end, at blank lines and at
#: marks of a list like (a) or 1) that begin a line.
HARD = (r"[.!?;]*[.!?][.!?;]*(?:[\x20\x09-\x0D]+|\z)|\x0D?\x0A[\x20\x09]*\x0D?\x0A"
        r"|(?:^|[\x0A\x0D])[\x20\x09*#/-]*\(?(?:[0-9]{1,2}|[a-z])\)[\x20\x09]")
#: They may end, or go on, at a line end and at ; or : before white space.
SOFT = r"[;:]+(?:[\x20\x09-\x0D]+|\z)|[\x0A\x0D]+"


def marked(text: Column) -> Column:
    """Lower case letters and digits, single spaces between; \\x01 where a
    sentence ends, \\x02 where it may end."""
    steps = [(HARD, "\x01"), (SOFT, "\x02"), (r"[^\p{L}\p{N}\x01\x02]+", " "),
             (r"[\x20\x02]*\x01[\x20\x01\x02]*", "\x01"), (r"\x20*\x02[\x20\x02]*", "\x02")]
    out = F.translate(F.lower(text), "\x01\x02\x03", "   ")
    for pattern, mark in steps:
        out = F.regexp_replace(out, pattern, mark)
    return F.trim(out)


def _normal_text(s: str) -> str:
    """:func:`marked` without marks, for the fixed sentences, which are ASCII."""
    return " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())


def known_sentences(sentences=SENTENCES, wordings=WORDINGS, notices=None) -> dict[str, int]:
    """Identifier of each normalised known sentence; numbered ones first."""
    out: dict[str, int] = {}
    for i, x in [*enumerate(sentences, 1), *wordings, *(_notices() if notices is None else notices)]:
        out.setdefault(_normal_text(x), i)
    return out


def rules_in_order(rules=RULES) -> list[tuple[str, tuple]]:
    """Longer rules first, then as listed."""
    return sorted(rules, key=lambda r: -len(r[1]))


def _candidates(marks: Column, known: dict[str, int]) -> Column:
    """Joined pieces in a row as structs of sentence, first and last piece and
    text, that are no longer than a known sentence and begin with the first
    word of one."""
    firsts, words, chars = sorted({k.split()[0] for k in known}), max(len(k.split()) for k in known), max(map(len, known))
    starts = F.array(*[F.lit(w) for w in firsts])

    def of(sentence, n):
        def begun(p):
            return F.flatten(F.transform(p, lambda x, i: F.when(F.array_contains(starts, F.substring_index(x, " ", 1)), F.transform(
                F.sequence(i + 1, F.least(F.size(p), i + words)), lambda j: F.struct(
                    n.alias("n"), (i + 1).alias("i"), j.alias("j"), F.array_join(F.slice(p, i + 1, j - i), " ").alias("t"))))
                .otherwise(F.lit([]).cast("array<struct<n:int,i:int,j:int,t:string>>"))))
        return let(F.filter(F.split(sentence, "\x02"), lambda x: x != ""), begun)

    found = F.flatten(F.transform(F.split(marks, "\x01"), of))
    return F.filter(found, lambda c: F.char_length(c["t"]) <= chars)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, int] | None = None,
                  rules=RULES, trigger: str = TRIGGER) -> DataFrame:
    """One row per input row: id, ``sentence_ids`` (known sentences in reading
    order, comma-joined) and ``licenses`` (distinct licences of the matched
    rules, by code point, comma-joined), ``n_rules`` (matches).

    A rule matches where its identifiers follow one another in the sequence of
    known sentences; matched sentences are used up, longest rules first.  Null
    and empty texts match nothing.  Repeated rows are scanned alike; an empty
    table gives an empty result; other columns are ignored.  A sentence longer
    or shorter than the known one is another sentence.
    """
    spark = docs.sparkSession
    known = known_sentences() if known is None else known
    t = F.col("t")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).select(
        F.monotonically_increasing_id().alias("row"), "id", F.when(t.rlike(trigger), _candidates(marked(t), known)).alias("found"))
    rows = materialise(spark, rows, "license_rows")  # numbers hold from here on; texts are not kept
    table = spark.createDataFrame(list(known.items()), "t string, sentence int")
    hits = rows.select("row", F.explode("found").alias("x")).select("row", "x.*").join(F.broadcast(table), "t")  # a fixed list
    own = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "i", "j", "sentence"))).alias("hits"))
    whole = F.filter("hits", lambda x: ~F.exists("hits", lambda y: (
        (x["n"] == y["n"]) & (y["i"] <= x["i"]) & (y["j"] >= x["j"]) & ((y["i"] < x["i"]) | (y["j"] > x["j"])))))
    own = own.select("row", F.array_join(F.transform(whole, lambda x: x["sentence"].cast("string")), ",").alias("sentence_ids"))
    out = rows.select("row", F.col("id").alias(id_col)).join(own, "row", "left").withColumn(
        "sentence_ids", F.coalesce("sentence_ids", F.lit(""))).drop("row")
    # each identifier between its own commas, so that adjacent matches do not share one
    rest = F.when(F.col("sentence_ids") != "", F.concat(F.lit(","), F.replace(
        "sentence_ids", F.lit(","), F.lit(",,")), F.lit(","))).otherwise(F.lit(""))
    out = out.withColumn("rest", rest).withColumn("hits", F.lit([]).cast("array<string>")).withColumn("n_rules", F.lit(0))
    return (_match(out, rules_in_order(rules))
            .select(id_col, "sentence_ids", F.array_join(F.array_sort(F.array_distinct("hits")), ",").alias("licenses"),
                    F.col("n_rules").cast("long").alias("n_rules")))


def _match(frame: DataFrame, rules: list) -> DataFrame:
    """Use up the rules one after the other, in one expression a row."""
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f",{i}," for i in ids)).alias("ids"))
                      for name, ids in rules])

    def use(acc, rule):
        n = ((F.char_length(acc["rest"]) - F.char_length(F.replace(acc["rest"], rule["ids"], F.lit(""))))
             / F.char_length(rule["ids"])).cast("int")
        return F.struct(F.replace(acc["rest"], rule["ids"], F.lit(";")).alias("rest"),
                        F.when(n > 0, F.concat(acc["hits"], F.array(rule["name"]))).otherwise(acc["hits"]).alias("hits"),
                        (acc["n_rules"] + n).alias("n_rules"))

    start = F.struct("rest", "hits", "n_rules")
    return frame.withColumn("m", F.when(F.col("rest") == "", start).otherwise(
        F.aggregate(table, start, use))).select(*[c for c in frame.columns if c not in ("rest", "hits", "n_rules")], "m.hits", "m.n_rules")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _sql() -> str:
    """DuckDB: pieces and their joins as rows, the sentences by a join, the
    rules one after the other."""
    known = known_sentences()
    rows = ", ".join("('%s', %d)" % x for x in known.items())
    words = max(len(k.split()) for k in known)
    steps, prev = [], "s"
    for k, (name, ids) in enumerate(rules_in_order()):
        pat = "".join(f",{i}," for i in ids)
        n = f"(length(rest) - length(replace(rest, '{pat}', ''))) // {len(pat)}"
        steps.append(f"r{k} AS (SELECT doc_id, rn, sentence_ids, replace(rest, '{pat}', ';') AS rest, "
                     f"n + {n} AS n, CASE WHEN {n} > 0 THEN list_append(hits, '{name}') ELSE hits END AS hits FROM {prev})")
        prev = f"r{k}"
    cut = "translate(lower(t), chr(1) || chr(2) || chr(3), '   ')"
    for pattern, mark in ((HARD, "chr(1)"), (SOFT, "chr(2)"), (r"[^\p{L}\p{N}\x01\x02]+", "' '"), (r"\x20*\x02[\x20\x02]*", "chr(2)")):
        cut = f"regexp_replace({cut}, '{pattern}', {mark}, 'g')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
known(norm, id) AS (VALUES {rows}),
sentence AS (
  SELECT rn, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS n
  FROM (SELECT rn, string_split({cut}, chr(1)) AS parts FROM d WHERE regexp_matches(t, '{TRIGGER.replace("(?iu)", "(?i)")}'))
), piece AS (
  SELECT rn, n, list_filter(list_transform(string_split(part, chr(2)), lambda x: trim(x)), lambda x: x <> '') AS p FROM sentence
), begun AS (SELECT rn, n, p, unnest(range(1, len(p) + 1)) AS i FROM piece
), joined AS (
  SELECT rn, n, p, i, unnest(range(i, least(len(p), i + {words - 1}) + 1)) AS j FROM begun
  WHERE split_part(p[i], ' ', 1) IN (SELECT DISTINCT split_part(norm, ' ', 1) FROM known)
), hit AS (SELECT rn, n, i, j, id FROM joined JOIN known ON known.norm = array_to_string(p[i:j], ' ')
), q AS (
  SELECT rn, string_agg(id::VARCHAR, ',' ORDER BY n, i, j) AS ids FROM hit h
  WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.rn = h.rn AND o.n = h.n AND o.i <= h.i AND o.j >= h.j AND (o.i < h.i OR o.j > h.j))
  GROUP BY rn
), s AS (
  SELECT doc_id, rn, coalesce(ids, '') AS sentence_ids,
         CASE WHEN ids IS NULL THEN '' ELSE ',' || replace(ids, ',', ',,') || ',' END AS rest,
         0 AS n, []::VARCHAR[] AS hits
  FROM d LEFT JOIN q USING (rn)
), {", ".join(steps)}
SELECT doc_id, sentence_ids, array_to_string(list_sort(list_distinct(hits)), ',') AS licenses, n::BIGINT AS n_rules
FROM {prev}
"""


OP10_SQL = _sql()
