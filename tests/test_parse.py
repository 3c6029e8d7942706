"""Cell parsers and classifications on literal inputs."""

import math

import pytest
from pyspark.sql import functions as F

from ringside.functions import measures as m
from ringside.functions import parse

TEXT_CASES = [
    (parse.landed, "24 of 66", 24.0), (parse.attempted, "24 of 66", 66.0), (parse.landed, "none", None),
    (parse.landed, "7OF9", 7.0), (parse.attempted, None, None),
    (parse.percent, "---", None), (parse.percent, "36%", 36.0), (parse.percent, "-1.5%", -1.5), (parse.percent, "nan", None),
    (parse.count, "3", 3.0), (parse.count, "1,234", 1234.0), (parse.count, "--", None), (parse.count, "", None),
    (parse.clock_seconds, "2:15", 135.0), (parse.clock_seconds, "1:02:03", 3723.0),
    (parse.clock_seconds, "1:2:3:4", None), (parse.clock_seconds, "x:10", None),
    (parse.clock_seconds, "45", 45.0), (parse.clock_seconds, "---", None),
    (parse.bio_clock, "1:2:3:4", 1.0), (parse.bio_clock, "a:b", None), (parse.bio_clock, "12:30", 750.0),
    (parse.bio_int, "1,5 in", 15), (parse.bio_float, "72.5%", 72.5), (parse.bio_int, " ", None),
    (parse.scheduled_rounds, "3 Rnd + OT (5-5-5-5)", 3), (parse.scheduled_rounds, "No Time Limit", None),
    (parse.round_minutes, "3 Rnd + OT (5-5-5-5)", [5.0] * 4), (parse.round_minutes, "No Time Limit", []),
    (parse.round_minutes, "1 Rnd (12)", [12.0]), (parse.round_minutes, None, []),
    (m.class_name, "UFC Lightweight Title Bout", "Lightweight"), (m.class_name, "Women's Strawweight Bout", "Women's Strawweight"),
    (m.class_name, "  ", None), (m.is_title, "UFC Lightweight Title Bout", True), (m.is_women, "Womens Flyweight", True),
    (m.is_title, None, False), (m.is_women, "Flyweight", False),
    (m.class_rank, "Women's Featherweight", 3), (m.class_rank, "Catch Weight", None),
    (m.known_result, " w ", "W"), (m.known_result, "x", None),
    (parse.url_key, " https://a.test/b// ", "http://a.test/b"), (parse.url_key, "", None),
    (parse.name_key, "  Jon   DOE ", "jon doe"), (parse.name_key, None, ""),
]


@pytest.mark.parametrize("fn, text, want", TEXT_CASES)
def test_text_cells(spark, fn, text, want):
    row = spark.createDataFrame([(text,)], "c string").select(fn(F.col("c")).alias("v")).first()
    assert row["v"] == want


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def lit(v, kind="double"):
    return F.lit(v).cast(kind)


@pytest.mark.parametrize("method, outcome, group", [
    ("Overturned", "decisive", "NC"), ("Could Not Continue", "no_contest", "NC"), ("DQ", "decisive", "DQ"),
    ("Decision - Split", "decisive", "DEC"), ("KO/TKO", "decisive", "KO_TKO"),
    ("TKO - Doctor's Stoppage", "decisive", "KO_TKO"), ("Submission", "decisive", "SUB"),
    ("Other", None, "OTHER"), (None, None, "OTHER"), ("Decision", "no_contest", "NC"),
])
def test_method_groups(spark, method, outcome, group):
    assert value(spark, m.method_group(lit(method, "string"), lit(outcome, "string"))) == group
    assert value(spark, m.counts_for_stats(F.lit(group))) == (group not in ("NC", "DQ"))


@pytest.mark.parametrize("rnd, clock, fmt, seconds", [
    (2, "1:40", "3 Rnd (5-5-5)", 400.0), (3, "0:20", "2 Rnd (10-5)", 920.0), (3, None, "3 Rnd (5-5-5)", 600.0),
    (1, "---", "3 Rnd (5-5-5)", None), (None, "2:00", None, 120.0), (3, "1:00", "No Time Limit", 660.0),
])
def test_bout_seconds(spark, rnd, clock, fmt, seconds):
    assert value(spark, parse.bout_seconds(lit(rnd, "int"), lit(clock, "string"), lit(fmt, "string"))) == seconds


def test_measures(spark):
    assert value(spark, m.evenness(lit(100), lit(0), lit(0))) < 0.01
    assert value(spark, m.evenness(lit(40), lit(30), lit(30))) > 0.95
    assert value(spark, m.evenness(lit(None), lit(-1), lit(0))) is None
    assert value(spark, m.per_minute(lit(90), lit(300))) == 18.0
    assert value(spark, m.per_minute(lit(90), lit(0))) is None
    assert value(spark, m.share(lit(1), lit(0))) is None
    assert math.isclose(value(spark, m.mean_of([lit(1), lit(None), lit(4)])), 2.5)
    for who, winner, outcome, want in ((10, 10, "decisive", "W"), (11, 10, "decisive", "L"), (10, None, "draw", "D"),
                                       (10, None, "no_contest", "NC"), (10, None, "decisive", None)):
        assert value(spark, m.corner_result(lit(who, "long"), lit(winner, "long"), F.lit(outcome))) == want


@pytest.mark.parametrize("p, pick, tossup, high", [
    (0.5, "TOSSUP", True, False), (0.5004, "TOSSUP", True, False), (0.51, "A", False, False),
    (0.66, "A", False, True), (0.34, "B", False, True), (0.6594, "A", False, False), (1.7, "A", False, True),
])
def test_picks(spark, p, pick, tossup, high):
    got = spark.range(1).select(*[c.alias(n) for n, c in m.pick_of(lit(p)).items()]).first()
    assert (got["pick"], got["is_tossup"], got["is_high_conf_66"]) == (pick, tossup, high)


def test_display_and_dates(spark):
    assert value(spark, m.show_clock(lit(125.4))) == "2:05"
    assert value(spark, m.show_clock(lit(59.7))) == "1:00"
    assert value(spark, m.show_clock(lit(-3))) == "0:00"
    assert value(spark, m.show_percent(lit(0.123))) == "12.3%"
    assert value(spark, m.show_hits(lit(1, "int"), lit(0, "int"))) == "n/a"
    assert str(value(spark, parse.day(F.lit("June 3, 2024")))) == "2024-06-03"
    assert str(value(spark, parse.day(F.lit("2024-06-03T10:00")))) == "2024-06-03"
    assert value(spark, parse.day(F.lit("soon"))) is None
    one = m.match_key(F.lit("https://e.test/"), lit("2024-01-01", "date"), lit(None, "string"), F.lit("B  b"),
                      F.lit("http://a.test"), F.lit("A"))
    two = m.match_key(F.lit("http://e.test"), lit("2024-01-01", "date"), F.lit("http://a.test/"), F.lit("A"),
                      lit(None, "string"), F.lit("b b"))
    assert value(spark, one) == value(spark, two) == "http://e.test|2024-01-01|b b|http://a.test"
