"""Features kept up to date by change: equal to a full build, and nothing else is touched."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ringside.columns import FEATURE_COLS
from ringside.operators import history
from ringside.operators.upsert import BUCKET, upsert_buckets, write_buckets
from ringside.plans.build import BY, RAW, Store, everything, ingest
from ringside.plans.refresh import features_from, first_changes, refresh, widened
from tests.test_features import random_history, schema
from tests.test_loads import bout, event


def frame(spark, rows):
    df = spark.createDataFrame([tuple(r[f.name] for f in schema()) for r in rows], schema())
    df = df.withColumn("event_date", F.date_from_unix_date(F.col("day_no").cast("int")))
    return df.withColumn("day_no", F.col("day_no").cast("int")).withColumn("bout_order", F.col("fight_id"))


def by_key(df):
    return {(r["fighter_id"], r["fight_id"]): r for r in df.collect()}


def edited(rows, kind, seed):
    rng, fights = random.Random(seed), sorted({r["fight_id"] for r in rows})
    one = rng.choice(fights)
    if kind == "gone":
        return [r for r in rows if r["fight_id"] != one]
    if kind == "new":
        return rows  # the caller takes the bout from the state before
    if kind == "moved":
        return [dict(r, day_no=r["day_no"] - 500) if r["fight_id"] == one else r for r in rows]
    if kind == "result":
        return [dict(r, result="W" if r["is_fighter1"] else "L", method_group="SUB") if r["fight_id"] == one else r for r in rows]
    return [dict(r, sig_str_landed=99.0) if r["fight_id"] == one and r["is_fighter1"] else r for r in rows]


@pytest.mark.parametrize("kind", ["gone", "new", "moved", "result", "number"])
def test_recomputed_rows_are_all_that_can_differ(spark, kind):
    rows = random_history(4, fighters=24, bouts=50)
    now = edited(rows, kind, 9)
    was = edited(rows, "gone", 9) if kind == "new" else rows
    before, after = frame(spark, was), frame(spark, now)
    starts = widened(first_changes(before, after), after)
    from_ = {r["fighter_id"]: tuple(r["start"]) for r in starts.collect()}
    assert 2 <= len(from_) < 24
    old, new = by_key(history.build_features(before)), by_key(history.build_features(after))
    got = by_key(features_from(after, starts))
    place = {(r["fighter_id"], r["fight_id"]): (r["day_no"], r["fight_id"]) for r in now}
    late = {k for k in new if k[0] in from_ and place[k] >= from_[k[0]]}
    assert set(got) == late
    for k, row in new.items():
        want = got.get(k) or old[k]
        for c in FEATURE_COLS:
            g, w = want[c], row[c]
            assert g == w or (isinstance(w, float) and g == pytest.approx(w, abs=1e-9)), (kind, k, c, g, w)


def test_no_change_recomputes_nothing(spark):
    rows = frame(spark, random_history(5, fighters=6, bouts=12))
    starts = widened(first_changes(rows, rows), rows)
    assert starts.isEmpty() and features_from(rows, starts).isEmpty()


FIRST = [event(1, bout(1, "Ann", "Bea"), bout(2, "Cat", "Dot"), bout(11, "Uma", "Vic")),
         event(2, bout(3, "Ann", "Cat"), bout(12, "Vic", "Wyn")),
         event(3, bout(4, "Bea", "Dot"), bout(13, "Uma", "Wyn"))]
THEN = [event(4, bout(5, "Ann", "Dot")), event(1, bout(1, "Ann", "Bea", status=("L", "W")), bout(2, "Cat", "Dot"), bout(11, "Uma", "Vic"))]


def documents(spark, texts, seq=0):
    return spark.createDataFrame([(seq + i, t) for i, t in enumerate(texts)], "seq long, payload string")


def body(store):
    return store.read("fighters").select("fighter_id", F.lit(70.0).alias("height"), F.lit(72).alias("reach"))


def files(folder):
    return {(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_refresh_after_a_load_equals_a_full_build(spark, tmp_path):
    store, whole = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "w"))
    ingest(store, documents(spark, FIRST))
    refresh(store, body(store), bucket_rows=1)  # nothing is stored yet: everything is built
    folders = {t: store.path(store.tables()[t]) for t in BY}
    held = {t: files(p) for t, p in folders.items()}
    others = {r["fighter_id"] for r in store.read("fighters").collect() if r["fighter_name"] in ("Uma", "Vic", "Wyn")}
    ingest(store, documents(spark, THEN, 10))
    refresh(store, body(store))
    whole.replace_all({t: store.read(t) for t in RAW})
    everything(whole, body(store))
    for t in [*BY, "fighter_fight_facts", "fight_facts", "fighter_round_facts"]:
        got, want = store.read(t), whole.read(t)
        assert sorted(got.columns) == sorted(want.columns) and got.count() == want.count() > 0
        assert got.select(sorted(got.columns)).exceptAll(want.select(sorted(want.columns))).isEmpty(), t
    for t, p in folders.items():  # in place, and buckets without a change keep their files
        assert store.path(store.tables()[t]) == p
        assert held[t] & files(p) and files(p) - held[t]
    p = folders["fighter_fight_features"]
    for r in spark.read.parquet(p).filter(F.col("fighter_id").isin(list(others))).select(BUCKET).distinct().collect():
        inside = {x for x in held["fighter_fight_features"] if x[0].endswith(f"{BUCKET}={r[0]}")}
        shared = spark.read.parquet(p).filter(F.col(BUCKET) == r[0]).filter(~F.col("fighter_id").isin(list(others))).count()
        assert shared or inside <= files(p)
    now = {t: files(p) for t, p in folders.items()}
    refresh(store, body(store))
    assert now == {t: files(p) for t, p in folders.items()}


def test_a_cancelled_bout_leaves_all_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    ingest(store, documents(spark, FIRST))
    refresh(store, body(store), bucket_rows=1)
    gone = store.read("fights").filter("fight_url like '%/4'").select("fight_id").first()[0]
    store.replace("fights", store.read("fights").filter(F.col("fight_id") != gone))
    refresh(store, body(store))
    for t in [*BY, "fight_facts"]:
        assert store.read(t).filter(F.col("fight_id") == gone).isEmpty() and not store.read(t).isEmpty()


def test_emptied_buckets_are_deleted(spark, tmp_path):
    path = str(tmp_path / "t")
    write_buckets(spark.range(40).select("id", F.lit(1).alias("v")), path, ["id"], bucket_rows=4)
    gone = spark.range(40).filter("id <> 7").select("id")
    new = spark.createDataFrame([(100, 2)], "id long, v int")
    upsert_buckets(spark, path, new, ["id"], gone=gone)
    assert {(r["id"], r["v"]) for r in spark.read.parquet(path).collect()} == {(7, 1), (100, 2)}


def test_facts_change_together_or_not_at_all(spark, tmp_path, monkeypatch):
    from ringside.operators import corners
    from ringside.plans import build

    store = Store(spark, str(tmp_path / "s"))
    ingest(store, documents(spark, FIRST))
    build.facts(store)
    before = store.tables()
    ingest(store, documents(spark, THEN, 10))
    real = corners.round_facts
    monkeypatch.setattr(corners, "round_facts", lambda *a: real(*a).withColumn("kd", F.raise_error(F.lit("torn")).cast("double")))
    with pytest.raises(Exception, match="torn"):
        build.facts(store)
    names = ("fight_facts", "fighter_fight_facts", "fighter_round_facts")
    assert {t: store.tables()[t] for t in names} == {t: before[t] for t in names}


def exchanges(df):
    """Number of columns that each exchange of the plan moves."""
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if node.nodeName().endswith("Exchange"):
            found.append(node.output().size())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_pairing_moves_no_wide_rows(spark):
    from ringside.operators import model_rows
    from ringside.session import cut, cut_by

    built = history.build_features(frame(spark, random_history(6, fighters=8, bouts=20)))
    bio = built.select("fighter_id", F.lit(70.0).alias("height"), F.lit(72).alias("reach")).distinct()
    plain, laid_out = cut(built, "features"), cut_by(built, "features", "fight_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = {n: exchanges(model_rows.paired(f, bio)) for n, f in (("plain", plain), ("laid out", laid_out))}
        assert max(moved["laid out"]) < 12 < 300 < max(moved["plain"])
        a, b = (model_rows.paired(f, bio) for f in (plain, laid_out))
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and a.count() == b.count() > 0
        # the windows' results are not exchanged either: nothing as wide as a feature row moves
        assert max(exchanges(built)) < 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
