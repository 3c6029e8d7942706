"""Matching, scoring and freezing of logged picks."""

import pytest
from pyspark.sql import functions as F

from ringside.operators import ledger

PICK = ("event_url string, day string, fighter_a_name string, fighter_b_name string, fighter_a_url string, "
        "fighter_b_url string, fighter_a_id long, fighter_b_id long, p_a double")
EVENT, DAY = "https://e.test/1/", "2020-01-01"
PICKS = [
    (EVENT, None, "Ann", "Bea", "https://f.test/1", None, None, 2, 0.70),        # A by url, B by id, event by url
    (None, DAY, "cat  one", "DEE", None, None, None, None, 0.30),                 # names only, event by date
    (None, DAY, "Fay", "Eve", None, None, 6, 5, 0.50),                            # corners swapped, toss-up
    (EVENT, DAY, "Gil", "Hal", None, None, 7, 8, 0.90),                           # ends in a draw
    (None, "2020-02-02", "Ann", "Bea", None, None, 1, 2, 0.60),                   # other date, stays pending
    (EVENT, None, "Ann", "Hal", None, None, 1, 8, 0.60),                          # people who never met
]


@pytest.fixture(scope="module")
def done(spark):
    fights = spark.createDataFrame(
        [(101, 1, 1, 2, 2, "decisive"), (102, 1, 3, 4, 4, "decisive"), (103, 1, 5, 6, 5, "decisive"),
         (104, 1, 7, 8, None, "draw"), (105, 1, 1, 2, None, "unknown"), (106, 1, 1, 2, 1, "decisive")],
        "fight_id long, event_id int, fighter1_id long, fighter2_id long, winner_id long, outcome_type string")
    events = spark.createDataFrame([(1, "http://e.test/1", DAY)], "event_id int, event_url string, d string").selectExpr(
        "event_id", "event_url", "to_date(d) as event_date")
    names = ["Ann", "Bea", "Cat One", "Dee", "Eve", "Fay", "Gil", "Hal"]
    people = spark.createDataFrame(
        [(i + 1, n, f"http://f.test/{i + 1}/") for i, n in enumerate(names)],
        "fighter_id long, fighter_name string, fighter_url string")
    return ledger.completed_fights(fights, events, people)


def predictions(spark, rows=PICKS):
    df = spark.createDataFrame(rows, PICK)
    return df.withColumn("event_date", F.to_date("day")).drop("day").withColumn("event_headline", F.lit("Card"))


def when(text):
    return F.lit(text).cast("timestamp")


@pytest.fixture(scope="module")
def cycle(spark, done):
    empty = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    return ledger.run_cycle(empty, predictions(spark), done, when("2020-03-01 00:00:00"))


def test_scores(cycle):
    got = {(r["fighter_a_name"], r["fighter_b_name"], str(r["event_date"])): r for r in cycle[0].collect()}
    assert len(got) == 6
    r = got["Ann", "Bea", "None"]
    assert (r["fight_id"], r["winner_side"], r["pick_correct"]) == (101, "B", False)  # lowest of 101 and 106
    r = got["cat  one", "DEE", DAY]
    assert (r["fight_id"], r["winner_side"], r["pick_correct"], r["is_high_conf_66"]) == (102, "B", True, True)
    r = got["Fay", "Eve", DAY]
    assert (r["fight_id"], r["winner_side"], r["pick"], r["pick_correct"]) == (103, "B", "TOSSUP", None)
    r = got["Gil", "Hal", DAY]
    assert (r["outcome_type"], r["winner_side"], r["pick_correct"]) == ("draw", None, None)
    assert got["Ann", "Bea", "2020-02-02"]["scored_at"] is None and got["Ann", "Hal", "None"]["fight_id"] is None


def test_summary(cycle):
    assert cycle[1].first().asDict() == {
        "n_logged": 6, "n_pending": 2, "n_tossup": 1, "n_tossup_scored": 1, "n_picks_scored": 2, "n_correct": 1,
        "n_high_scored": 2, "n_high_correct": 1, "n_void": 1}


def test_scored_rows_stay_frozen_and_pending_ones_move(spark, done, cycle):
    again = [(*p[:-1], 0.01) for p in PICKS]
    new, _ = ledger.run_cycle(cycle[0], predictions(spark, again), done, when("2021-01-01 00:00:00"))
    old = {r["match_key"]: r for r in cycle[0].collect()}
    for r in new.collect():
        if old[r["match_key"]]["scored_at"] is not None:
            assert r == old[r["match_key"]]
        else:
            assert r["p_a"] == 0.01 and r["predicted_at"].year == 2021
