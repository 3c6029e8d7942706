"""Operator 8: licence scan by canonical digests.

A text is brought to a canonical form: ASCII lower case, punctuation and white
space as single spaces, lines that name an owner left out, variant spellings made equal.
The SHA-256 of the whole canonical text is joined to the digests of known
licences; so is that of every line taken as a text of its own, which finds
one-line notices inside longer documents. Only whole texts and whole lines are
compared, never parts of them.

DataFrame functions throughout. The known texts are a parameter; their table has
a few rows per licence, so it is broadcast, and refused above MAX_KNOWN rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringside.llm.common import table, whole_text

MAX_KNOWN = 20_000

#: Spellings that count as equal, the second written for the first.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("sub licence", "sublicense"), ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("organisation", "organization"),
    ("authorisation", "authorization"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("whilst", "while"),
    ("merchantibility", "merchantability"), ("per cent", "percent"), ("v 2", "version 2"), ("v2", "version 2"),
    ("v3", "version 3"), ("v 3", "version 3"), ("creative commons attribution", "cc by"),
]
#: A line that only states whose work it is: copyright with (c), a year or a name, never wrapped prose such as "copyright
#: notice and".
OWNER = (r"^\W*(?:(?i:copyright)\W*(?:(?i:c)\W|\d{4})|(?i:c)\W+\d{4}(?!\w)|(?i:all rights reserved)\W*$"
         r"|Copyright\W+(?:(?:by|the|The) +)?(?!(?:Holders?|Owners?|Notices?|Licen[cs]e|Laws?|Act)\b)[A-Z])|^[^\w\u00a9]*\u00a9\W*\d{4}")
#: What separates words: any ASCII character but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
          "DEALINGS IN THE SOFTWARE.")
_ISC = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.")
#: Fixed values: (identifier, text) of known licences and of the notices that stand for them.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software.\n" + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n" + _ISC),
    ("MIT", "MIT License"), ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This code is released under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
]
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.\n")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission.\n")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
            "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
            "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
#: Whole texts beside those of KNOWN; BSD clauses are numbered or marked by signs.
WHOLE = [(name, text) for name, numbered in (("BSD-2-Clause", _BSD + _BSD_END), ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END))
         for text in (numbered, numbered.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))]
#: Titles that a whole text may bear.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero Clause BSD License", "BSD 0-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"],
}


def known_texts() -> list[tuple[str, str]]:
    """KNOWN, and the whole texts with and without each title."""
    whole = KNOWN[:3] + WHOLE
    return KNOWN + WHOLE + [(name, f"{title}\n{text}") for name, text in whole for title in TITLES[name]]


def canonical_line(line: Column) -> Column:
    """One line in canonical form; empty if it holds no word or only says whose work it is."""
    words = F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), SEPARATORS, " "))
    return F.when(line.rlike(OWNER), "").otherwise(_spelled(words))


def _spelled(words: Column) -> Column:
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    for variant, standard in SPELLINGS:
        padded = F.replace(padded, F.lit(f" {variant} "), F.lit(f" {standard} "))
    return F.trim(padded)


def canonical_text(lines: Column) -> Column:
    """The canonical form of a whole text, from its canonical lines; how the text was wrapped makes no difference."""
    return _spelled(F.array_join(lines, " "))


def canonical_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), canonical_line), lambda x: x != "")


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(digest, licence), one row per digest: the first named licence of a text that several share."""
    rows = [(i, name, text) for i, (name, text) in enumerate(known_texts() if known is None else known)]
    if len(rows) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    texts = spark.createDataFrame(rows, "n int, licence string, text string")
    canon = canonical_text(canonical_lines(F.col("text")))
    return texts.select("n", "licence", canon.alias("canon")).filter("canon <> ''").groupBy(
        F.sha2("canon", 256).alias("digest")).agg(F.min_by("licence", "n").alias("licence"))


def scan(docs: DataFrame, known=None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, licence, notices) of every row.

    licence: the known licence that the whole text is, or null. notices: sorted,
    distinct licences that whole lines name. Null and empty texts, and texts of
    copyright lines alone, match nothing. Repeated rows come back as often as
    they came; other columns play no part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(whole_text(text)).alias("k"),
                       canonical_lines(whole_text(text)).alias("lines"))
    # a line's digest is looked up once per document, the whole text's beside them
    units = F.concat(
        F.transform(F.array_distinct("lines"), lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("digest"))),
        F.array(F.struct(F.lit(True).alias("whole"), F.sha2(canonical_text(F.col("lines")), 256).alias("digest"))))
    hits = rows.select("id", "k", F.explode(units).alias("u")).select("id", "k", "u.*").join(
        F.broadcast(known_digests(spark, known)), "digest")
    found = hits.groupBy("id", "k").agg(
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("licence")))).alias("notices"))
    every = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(whole_text(text)).alias("k2"))
    met = every.join(found, every["doc_id"].eqNullSafe(found["id"]) & (every["k2"] == found["k"]), "left")
    return met.select("doc_id", "licence", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))


def op8(spark, sf_dir):
    """Licences that whole documents, and whole lines in them, are."""
    out = scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "licence", F.array_join("notices", ",").alias("notices"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _spelled_sql(words: str) -> str:
    padded = f"' ' || {words} || ' '"
    for variant, standard in SPELLINGS:
        padded = f"replace({padded}, ' {variant} ', ' {standard} ')"
    return f"trim({padded})"


def _owner_sql(line: str) -> str:
    """OWNER without looking ahead: a name behind the word, unless it is one of those that wrapped prose has there."""
    def found(pattern: str) -> str:
        return f"regexp_matches({line}, '{pattern}')"

    sure = (r"^\W*(?:(?i:copyright)\W*(?:(?i:c)\W|\d{4})|(?i:c)\W+\d{4}(?:\W|$)|(?i:all rights reserved)\W*$)"
            "|^[^\\w\u00a9]*\u00a9\\W*\\d{4}")
    ways = [r"^\W*Copyright\W+", r"^\W*Copyright\W+(?:by|the|The) +"]
    prose = r"(?:Holders?|Owners?|Notices?|Licen[cs]e|Laws?|Act)\b"
    return " or ".join([found(sure), *[f"({found(w + '[A-Z]')} and not {found(w + prose)})" for w in ways]])


def _oracle() -> str:
    line = _spelled_sql("trim(regexp_replace(translate(line, '" + _UPPER + "', '" + _LOWER + "'), '" + SEPARATORS + "', ' ', 'g'))")
    known = ", ".join(f"({i}, {_sql_text(n)}, {_sql_text(t)})" for i, (n, t) in enumerate(known_texts()))
    lines = f"""SELECT _ID_, pos, w FROM (SELECT _ID_, pos, CASE WHEN {_owner_sql("line")} THEN '' ELSE {line} END AS w FROM (
      SELECT _ID_, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM _TABLE_)) WHERE w <> ''"""
    whole = _spelled_sql("string_agg(w, ' ' ORDER BY pos)")
    return f"""
WITH known AS (SELECT * FROM (VALUES {known}) AS t(n, licence, text)),
known_lines AS ({lines.replace('_ID_', 'n').replace('_TABLE_', 'known')}),
canon AS (SELECT n, {whole} AS c FROM known_lines GROUP BY n),
digests AS (SELECT c, arg_min(licence, n) AS licence FROM canon JOIN known USING (n) GROUP BY c),
doc_lines AS ({lines.replace('_ID_', 'doc_id').replace('_TABLE_', 'documents')}),
doc_canon AS (SELECT doc_id, {whole} AS c FROM doc_lines GROUP BY doc_id),
noted AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
          FROM doc_lines JOIN digests ON w = c GROUP BY doc_id)
SELECT d.doc_id, g.licence, coalesce(o.notices, '') AS notices
FROM documents d LEFT JOIN doc_canon x USING (doc_id) LEFT JOIN digests g ON x.c = g.c LEFT JOIN noted o USING (doc_id)
"""


QUERIES = {"op8_licence_digests": op8}
ORACLES = {"op8_licence_digests": _oracle()}
