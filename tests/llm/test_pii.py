import datetime
import re

from ringside.llm import pii


def _luhn(digits):
    back = [int(c) for c in reversed(digits)]
    return sum(d if i % 2 == 0 else (2 * d - 9 * (d > 4)) for i, d in enumerate(back)) % 10 == 0


def _run(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.pseudonymise(docs, found="found", **more).collect()}


def test_values_keep_their_format_and_stay_linked(spark):
    text = ("mail Bosbt.42@mail8.example.com, call +1 (988) 555-2485 card 4041894974608795, ip 70.123.182.155. "
            "born 1984-02-29 or 29.02.1984, ssn 123-45-6789")
    out = _run(spark, [text, "again 4041894974608795 and 4041 8949 7460 8795!"])
    new = out[0]["text"]
    shape = lambda s: re.sub("[0-9]+", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
    assert shape(new) == shape(text)
    for value in ("Bosbt.42@mail8", "+1 (988) 555-2485", "4041894974608795", "70.123.182.155", "1984-02-29", "123-45-6789"):
        assert value not in new
    card = re.search(r"card (\d{16})", new)[1]
    assert _luhn(card)
    assert card in out[1]["text"] and f"{card[:4]} {card[4:8]} {card[8:12]} {card[12:]}" in out[1]["text"]
    a, b = re.search(r"born (\S+) or (\S+),", new).groups()
    assert datetime.date.fromisoformat(a) == datetime.datetime.strptime(b, "%d.%m.%Y").date()
    assert [m["kind"] for m in out[0]["found"]] == ["email", "phone", "card", "ip", "date", "date", "ssn"]


def test_unvalidated_values_and_plain_text_stay(spark):
    texts = ["4041894974608796 300.1.1.1 1984-02-30 000-12-3456 1.2.3.4.5", "", None, "no numbers at all", "v1.2 4.0. 3.",
             "00000000000000000 @ 12345", "x" * 200_000 + " 7"]
    out = _run(spark, texts)
    assert [out[i]["text"] for i in range(len(texts))] == texts
    assert all(out[i]["found"] == [] for i in range(len(texts)))


def test_permutation_is_one_to_one(spark):
    df = spark.range(0, 1000).selectExpr("id", "split(lpad(cast(id as string), 3, '0'), '(?!^)(?!$)') as d")
    moved = pii.feistel(df["d"].cast("array<bigint>"), pii.F.array_repeat(pii.F.lit(10).cast("bigint"), pii.F.lit(3)), "k", "t")
    assert df.select(moved.alias("m")).distinct().count() == 1000
    dates = spark.range(0, 73170, 7).selectExpr(
        "id", "date_format(date_add(date'1900-01-01', cast(id as int)), 'yyyy-MM-dd') as text")
    assert pii.pseudonymise(dates).select("text").distinct().count() == dates.count()


def test_other_key_other_pseudonym_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "+1 (988) 555-2485", 5, None)], "doc_id long, text string, found int, `a.b` string")
    one = pii.pseudonymise(docs, key="one").collect()[0]
    two = pii.pseudonymise(docs, key="two").collect()[0]
    assert one["text"] != two["text"] and one["found"] == 5 and docs.columns == list(one.asDict())
    assert pii.pseudonymise(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = pii.pseudonymise(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
