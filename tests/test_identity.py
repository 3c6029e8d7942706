"""People of a load told apart as inserting them one after the other would."""

import random

import pytest
from pyspark.sql import functions as F

from ringside.operators import identity
from ringside.sources import payload
from tests.test_loads import bout, event

SCHEMA = "fighter_name string, fighter_url string, seq long, bout int, side int"
PEOPLE = "fighter_id long, fighter_name string, fighter_url string"


def one_by_one(known, mentions):
    """(fighters in order of insertion, fighter of every mention); a fighter is its (name, url) row."""
    table, out = [(n, u) for _, n, u in sorted(known)], []
    for name, url, *_ in mentions:
        hit = [x for x in table if url is not None and x[1] == url] or [x for x in table if x[0] == name]
        if not hit:
            hit = [(name, url)]
            table.append(hit[0])
        out.append(hit[0])
    return table, out


def got(spark, known, mentions):
    fighters = spark.createDataFrame(known, PEOPLE)
    rows = spark.createDataFrame(mentions, SCHEMA).select(
        "fighter_name", "fighter_url", F.struct("seq", F.col("bout").alias("place"), "side").alias("place"))
    people, new = identity.resolve(rows, fighters)
    ids = {r["fighter_id"]: (r["fighter_name"], r["fighter_url"]) for r in fighters.unionByName(new).collect()}
    assert len(ids) == len(known) + new.count()
    met = rows.join(people.withColumnsRenamed({"fighter_name": "n", "fighter_url": "u"}),
                    (F.col("fighter_name") == F.col("n")) & F.col("fighter_url").eqNullSafe(F.col("u")))
    met = met.select("place", identity.at_place(F.col("place")).alias("id")).collect()
    return set(ids.values()), [ids[r["id"]] for r in sorted(met, key=lambda r: tuple(r["place"]))]


def check(spark, known, pairs):
    mentions = [(n, u, i // 4, i % 4 // 2, 1 + i % 2) for i, (n, u) in enumerate(pairs)]
    table, want = one_by_one(known, mentions)
    found, who = got(spark, known, mentions)
    assert who == want and found == set(table)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_inserting_one_after_the_other(spark, seed):
    rng = random.Random(seed)
    names, urls = [f"n{i}" for i in range(25)], [None, *(f"u{i}" for i in range(25))]
    known = [] if seed == 1 else [(i + 1, f"n{i}", f"u{i * 2}" if i % 3 else None) for i in range(6)]
    check(spark, known, [(rng.choice(names), rng.choice(urls)) for _ in range(160)])


def test_three_namesakes_in_one_load(spark):
    check(spark, [], [("Ann", "u1"), ("Bea", "u2"), ("Ann", "u3"), ("Ann", None), ("Ann", "u4"), ("Ann", "u1")])


def test_a_chain_of_borrowed_urls(spark):
    # each name comes with its own URL, then with the next one's: every second registration waits for the one before
    check(spark, [], [x for i in range(9) for x in ((f"n{i}", f"u{i}"), (f"n{i + 1}", f"u{i}"))])
    check(spark, [], [x for i in range(9) for x in ((f"n{i + 1}", f"u{i}"), (f"n{i}", f"u{i}"))])


def test_a_url_that_someone_else_takes_later_changes_whom_it_means(spark):
    check(spark, [(1, "Ann", None)], [("Ann", "u9"), ("Zoe", "u9"), ("Ann", "u9"), ("Ann", None)])


def test_nobody_and_nothing(spark):
    assert got(spark, [], []) == (set(), [])
    check(spark, [(1, "Ann", "u1")], [("Ann", "u1"), ("Bob", "u1")])


def test_load_follows_the_rule(spark):
    docs = spark.createDataFrame([
        (1, event(1, bout(1, ("Ann", "http://f.test/a1"), "Bea"), bout(2, ("Ann", "http://f.test/a2"), "Cat"))),
        (2, event(2, bout(3, ("Ann", None), ("Ann", "http://f.test/a3"), status=("W", "L"))))], "seq long, payload string")
    nobody = spark.createDataFrame([], PEOPLE)
    rows = payload.load_rows(docs, nobody, unique_names=False)[0]
    names = {r["fighter_id"]: r["fighter_url"] for r in rows["fighters"].collect()}
    assert sorted(names.values()) == ["http://f.test/Bea", "http://f.test/Cat", "http://f.test/a1"]
    fights = {r["fight_url"][-1]: r for r in rows["fights"].collect()}
    assert names[fights["2"]["fighter1_id"]] == "http://f.test/a1" and fights["2"]["winner_id"] == fights["1"]["fighter1_id"]
    assert names[fights["3"]["fighter1_id"]] == names[fights["3"]["fighter2_id"]] == "http://f.test/a1"
    apart = payload.load_rows(docs, nobody)[0]
    assert apart["fighters"].count() == 6  # three Anns with a URL each, Bea, Cat, and the one without stays unknown
