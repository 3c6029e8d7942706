"""Window features against a row-by-row restatement, with and without hot fighters."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringside.columns import FEATURE_COLS, STAT_COLS
from ringside.operators import history
from tests import brute

FLAGS = ["is_valid_for_stats", "is_title", "reached_round_3", "completed_round_3", "went_the_distance"]
INTS = ["fighter_id", "fight_id", "opponent_id", "final_round", "scheduled_rounds", "day_no"]
TEXTS = ["result", "method_group", "weight_class_norm"]
NUMBERS = sorted(set(STAT_COLS) | set(history.CARDIO_INPUTS))


def schema():
    fields = [T.StructField(c, T.LongType()) for c in INTS]
    fields += [T.StructField(c, T.StringType()) for c in TEXTS]
    fields += [T.StructField(c, T.BooleanType()) for c in [*FLAGS, "is_fighter1"]]
    fields += [T.StructField(c, T.DoubleType()) for c in NUMBERS]
    return T.StructType(fields)


def random_history(seed, fighters, bouts, hot_share=0.0):
    """Random bouts with date ties, gaps, unknown results, invalid bouts and missing numbers."""
    rng = random.Random(seed)
    rows = []
    for fight in range(bouts):
        a = 1 if rng.random() < hot_share else rng.randrange(1, fighters + 1)
        b = a
        while b == a:
            b = rng.randrange(1, fighters + 1)
        bout = {
            "fight_id": (fight * 7919) % 100003,
            "day_no": 8000 + rng.choice([0, 3, 40, 200]) * rng.randrange(0, 12),
            "weight_class_norm": rng.choice(["Lightweight", "Flyweight", "Heavyweight", "Catch Weight", None]),
            "is_title": rng.random() < 0.2,
            "scheduled_rounds": rng.choice([3, 3, 5, None]),
            "method_group": rng.choice(["KO_TKO", "SUB", "DEC", "DQ", "NC", "OTHER"]),
            "final_round": rng.choice([1, 2, 3, 4, 5, None]),
            "is_valid_for_stats": rng.random() < 0.7,
        }
        results = rng.choice([("W", "L"), ("L", "W"), ("W", "L"), ("D", "D"), ("NC", "NC"), (None, None)])
        for me, other, first, result in ((a, b, True, results[0]), (b, a, False, results[1])):
            row = dict(bout, fighter_id=me, opponent_id=other, is_fighter1=first, result=result)
            row["reached_round_3"] = rng.random() < 0.6
            row["completed_round_3"] = row["reached_round_3"] and rng.random() < 0.6
            row["went_the_distance"] = rng.random() < 0.4
            for c in NUMBERS:
                row[c] = None if rng.random() < 0.25 else round(rng.uniform(0, 50), 2)
            rows.append(row)
    return rows


def build(spark, rows):
    df = spark.createDataFrame([tuple(r[f.name] for f in schema()) for r in rows], schema())
    df = df.withColumn("event_date", F.date_from_unix_date(F.col("day_no").cast("int")))
    df = df.withColumn("day_no", F.col("day_no").cast("int")).withColumn("bout_order", F.col("fight_id"))
    return history.build_features(df)


def assert_same(got, want):
    assert len(got) == len(want)
    for row in got:
        expected = want[row["fighter_id"], row["fight_id"]]
        for c in FEATURE_COLS:
            g, w = row[c], expected[c]
            if isinstance(w, float) and g is not None:
                assert g == pytest.approx(w, abs=1e-9), (c, row["fighter_id"], row["fight_id"])
            else:
                assert g == w, (c, row["fighter_id"], row["fight_id"], g, w)


def test_every_feature_matches_the_restatement(spark):
    rows = random_history(1, fighters=7, bouts=60)
    assert_same(build(spark, rows).collect(), brute.features(rows))


def test_hot_fighter_is_cut_into_pieces_with_the_same_results(spark):
    rows = random_history(2, fighters=9, bouts=90, hot_share=0.6)
    spark.conf.set("spark.ringside.hotRows", "20")
    spark.conf.set("spark.ringside.pieceRows", "9")
    try:
        assert_same(build(spark, rows).collect(), brute.features(rows))
    finally:
        spark.conf.unset("spark.ringside.hotRows")
        spark.conf.unset("spark.ringside.pieceRows")


def test_later_bouts_do_not_change_earlier_features(spark):
    rows = random_history(3, fighters=5, bouts=30)
    cut = sorted(r["day_no"] for r in rows)[len(rows) // 2]
    early = [r for r in rows if r["day_no"] <= cut]
    whole = {(r["fighter_id"], r["fight_id"]): r for r in build(spark, rows).collect()}
    for row in build(spark, early).collect():
        assert row == whole[row["fighter_id"], row["fight_id"]]


def test_empty_history_is_an_error(spark):
    empty = spark.createDataFrame([], schema())
    with pytest.raises(history.EmptyHistory):
        history.load_history(empty)
