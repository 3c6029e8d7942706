import duckdb

from ringside.llm import licences

MIT = licences.KNOWN[0][1]


def _scan(spark, texts, **how):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: (r["licence"], r["notices"]) for r in licences.scan(docs, **how).collect()}


def test_variants_of_whole_texts_match(spark):
    loud = "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + MIT.upper().replace("SUBLICENSE", "sub-licence").replace(" ", "  ")
    assert _scan(spark, [MIT, loud, MIT + " more", MIT[:-20]]) == {0: ("MIT", []), 1: ("MIT", []), 2: (None, []), 3: (None, [])}


def test_notices_are_whole_lines(spark):
    texts = ["prose here\nLicenced under the apache licence; version 2.0!\nprose\nMIT LICENSE\nmit license", "the MIT License is short",
             "", None, "Copyright 2020 me", "Licensed under CC-BY-NC 4.0.", "x\n" * 50_000]
    got = _scan(spark, texts)
    assert got == {0: (None, ["Apache-2.0", "MIT"]), 1: (None, []), 2: (None, []), 3: (None, []), 4: (None, []),
                   5: ("CC-BY-NC-4.0", ["CC-BY-NC-4.0"]), 6: (None, [])}


def test_repeated_rows_clashing_columns_and_own_known_texts(spark):
    docs = spark.createDataFrame([(None, "A b", 1), (2, "a-B", 2), (2, "a-B", 2), (2, "c", 3)], "doc_id long, text string, licence int")
    got = licences.scan(docs, known=[("ONE", "a b!"), ("TWO", "A, B"), ("NONE", "copyright 2001")]).collect()
    assert sorted((r["licence"] or "", r["doc_id"] or 0) for r in got) == [("", 2), ("ONE", 0), ("ONE", 2), ("ONE", 2)]
    assert licences.scan(docs.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = con.execute(licences.ORACLES["op8_licence_digests"]).fetchall()
    got = [tuple(r) for r in licences.op8(spark, folder).collect()]
    assert sorted(got) == sorted(want) and any(r[2] for r in got)
