import textwrap

import pytest

from ringside.llm import licences

from .test_licences import _scan

TEXTS = dict(reversed(licences.KNOWN[:3] + licences.WHOLE))


def _file(name, width, title=True, owner="Copyright (c) 2021, Some One\nCopyright The Other Authors. All rights reserved."):
    body = "\n\n".join(textwrap.fill(p, width) if width else p for p in TEXTS[name].split("\n"))
    return (f"{licences.TITLES[name][0]}\n\n" if title else "") + f"{owner}\n\n{body}\n"


def test_whole_files_however_wrapped_and_titled(spark):
    cases = [(name, w, t) for name in TEXTS for w in (0, *range(40, 90, 7)) for t in (True, False)]
    got = _scan(spark, [_file(*c) for c in cases])
    assert [got[i][0] for i in range(len(cases))] == [c[0] for c in cases]


def test_isc_with_prose_line_that_begins_with_copyright(spark):
    text = _file("ISC", 0).replace("that the above copyright notice", "that the above\ncopyright notice")
    assert "\ncopyright notice" in text
    upper = _file("BSD-3-Clause", 0).replace("BY THE COPYRIGHT HOLDERS", "BY THE\nCOPYRIGHT HOLDERS")
    got = _scan(spark, [text, upper, _file("MIT", 60) + "more", "copyright is a word\n" + licences.KNOWN[0][1]])
    assert [got[i][0] for i in range(4)] == ["ISC", "BSD-3-Clause", None, None]


@pytest.mark.parametrize("owner", ["Copyright 1999-2004 A", "(c) 2001 A", "© 2001 A", "Copyright © A", "COPYRIGHT (C) 2001 A B",
                                   " * Copyright (c) A", "All Rights Reserved."])
def test_owner_lines_are_left_out(spark, owner):
    assert _scan(spark, [_file("MIT", 70, owner=owner)])[0][0] == "MIT"


def test_checking_sql_says_what_the_query_says(spark):
    import duckdb
    import pandas as pd

    texts = [_file(name, w, t) for name in TEXTS for w in (0, 50, 72) for t in (True, False)]
    texts += [None, "", "Copyright 2001 A", "Copyright The Holders\nMIT License", "Copyright Holders of\nMIT License", "copyright notice\nISC",
              _file("ISC", 0).replace("that the above copyright", "that the above\ncopyright"), "one\nLicensed under CC BY 4.0.\nMIT License",
              "Licensed under the GNU General Public Licence,  version 3", "c 2001 A\nSPDX-License-Identifier: MIT", "Copyright by Notices\nx"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype=object)}))
    want = {r[0]: (r[1], r[2]) for r in con.execute(licences.ORACLES["op8_licence_digests"]).fetchall()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["licence"], ",".join(r["notices"])) for r in licences.scan(docs).collect()}
    assert got == want and sum(v[0] is not None for v in got.values()) >= 6 * len(TEXTS)
