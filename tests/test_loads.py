"""Ingestion, keyed writes, full rebuild and the folder stream on small documents."""

import json

import pytest
from pyspark.sql import functions as F

from ringside.operators import audit
from ringside.operators.upsert import latest, latest_of_few, replace_group, upsert, upsert_buckets, write_buckets
from ringside.plans.build import Store, everything, ingest
from ringside.sources import payload
from ringside.sources.binding import documents
from ringside.streaming.follow import follow_folder

CELLS = {"kd": "0", "sig_str": "5 of 9", "total_str": "6 of 10", "td": "1 of 2", "sub_att": "0", "rev": "0", "ctrl": "1:00"}


def bout(n, a, b, rounds=2, status=("W", "L"), judges=()):
    names = [x if isinstance(x, tuple) else (x, f"http://f.test/{x}") for x in (a, b)]
    return {
        "metadata": {"url": f"http://b.test/{n}", "page_title": "t", "source": "s"},
        "general_info": {"weight_class": "Lightweight Bout", "method": "KO/TKO", "round": rounds, "time": "1:00",
                         "time_format": "3 Rnd (5-5-5)"},
        "fighters": {f"fighter{i + 1}": {"name": n_, "url": u} for i, (n_, u) in enumerate(names)},
        "fight_result": {u: s for (_, u), s in zip(names, status) if u},
        "totals": {"significant_strikes": {"fighter1": {"sig_str": "9 of 12"}, "fighter2": {"sig_str": "3 of 8"}}},
        "round_stats": [{"round": r + 1, "fighter1": CELLS, "fighter2": CELLS} for r in range(rounds)],
        "judges": list(judges),
    }


def event(n, *fights):
    return json.dumps({"url": f"http://e.test/{n}", "headline": f"E{n}", "date": f"2020-0{n}-01", "location": "x",
                       "fights": list(fights)})


JUDGES = [{"judge": "J1", "score": "29 - 28"}, {"score": "30 - 27"}, {"judge_name": "J2", "score": "29 - 28"},
          {"judge": "J1", "score": "28 - 29"}]
DOCS = [
    (1, event(1, bout(1, "Ann", "Bea", rounds=3, judges=JUDGES), bout(2, "Cat", ("Ann", None)))),
    (2, event(2, bout(3, "Bea", "Cat", status=("D", "D")))),
    (3, '{"url": "http://e.test/9", "fights": ['),
    (4, event(3, bout(4, "Ann", ("", None)), bout(5, "Ann", "Cat"))),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "seq long, payload string")


@pytest.fixture(scope="module")
def store(spark, docs, tmp_path_factory):
    s = Store(spark, str(tmp_path_factory.mktemp("store")))
    counts, aside = ingest(s, docs)
    s.counts = {r["what"]: r["n"] for r in counts.collect()}
    s.aside = {r["seq"] for r in aside.collect()}
    return s


def test_bad_documents_are_set_aside_whole(store):
    assert store.aside == {3, 4}
    assert store.counts == {"events": 2, "fights": 3, "fighters": 6, "distinct_fighters": 4, "round_stats": 7,
                            "judge_scores": 2}


def test_people_without_url_find_their_name(store):
    assert store.read("fighters").count() == 3
    fights = {r["fight_url"][-1]: r for r in store.read("fights").collect()}
    assert fights["2"]["fighter2_id"] == fights["1"]["fighter1_id"]
    assert fights["1"]["winner_id"] == fights["1"]["fighter1_id"] and fights["1"]["outcome_type"] == "decisive"
    assert fights["3"]["winner_id"] is None and fights["3"]["outcome_type"] == "draw"
    assert fights["2"]["outcome_type"] == "unknown"


def test_judges_last_entry_wins_and_nameless_are_skipped(store):
    assert {(r["judge_name"], r["score"]) for r in store.read("judge_scores").collect()} == {
        ("J1", "28 - 29"), ("J2", "29 - 28")}


def test_rebuild_and_audit(spark, store):
    ids = store.read("fighters").select("fighter_id")
    bio = ids.select("fighter_id", F.lit(70.0).alias("height"), F.lit(72).alias("reach"), F.lit("x").alias("fighting_style"))
    everything(store, bio)
    assert store.read("fighter_fight_features").count() == 6
    assert len(store.read("fight_model_train").columns) == 789
    names = audit.RAW_TABLES + audit.FACT_TABLES + ["fight_model_rows", "fight_model_train"]
    tables = {n: store.read(n) for n in names if store.exists(n)} | {"fighter_bio": bio}
    tables["fighter_performance_stats"] = ids
    found = {r["check"]: r["found"] for r in audit.violations(tables, "2021-01-01").collect()}
    assert not any(found.values()), found
    # every defect check fires on a corrupted copy
    bad = dict(tables)
    fights = tables["fights"]
    wrong = fights.limit(1).withColumns({"fight_id": F.lit(-5), "event_id": F.lit(-6), "winner_id": F.lit(-7),
                                         "fighter1_id": F.lit(-8), "fighter2_id": F.lit(-8)})
    decisive = fights.limit(1).withColumns({"fight_id": F.lit(-9), "winner_id": F.lit(None).cast("long"),
                                            "outcome_type": F.lit("decisive"), "fighter2_id": F.lit(-10)})
    bad["fights"] = fights.unionByName(wrong).unionByName(decisive)
    extra = tables["round_stats"].limit(1).drop("round_number").crossJoin(
        spark.createDataFrame([(n,) for n in range(4, 10)], "round_number int"))
    bad["round_stats"] = tables["round_stats"].unionByName(extra.select(tables["round_stats"].columns))
    totals = tables["fight_totals"]
    bad["fight_totals"] = totals.withColumns({"fighter1_sig_str": F.lit("9 of 2"), "fighter1_sig_str_percent": F.lit("x")})
    days = tables["events"]
    bad["events"] = days.unionByName(days.limit(1).withColumn("event_date", F.lit("1990-01-01").cast("date"))).unionByName(
        days.limit(1).withColumn("event_date", F.lit("2030-01-01").cast("date")))
    bad["fighter_bio"] = bio.withColumn("height", F.lit(20.0))
    bad["fighter_fight_features"] = tables["fighter_fight_features"].limit(5).withColumns(
        {"momentum_sig_str_percent_avg": F.lit(101.0), "momentum_sig_str_landed_avg": F.lit(-1.0)})
    corner = tables["fighter_fight_facts"]
    bad["fighter_fight_facts"] = corner.withColumns(
        {"sig_str_absorbed": F.lit(-3.0), "pace": F.lit(-1.0), "strike_defense": F.lit(140.0)}
    ).unionByName(corner.limit(1))
    bad["fight_facts"] = tables["fight_facts"].withColumns(
        {"is_valid_for_stats": ~F.col("is_valid_for_stats"), "method_raw": F.lit("Overturned")})
    bad["fight_model_rows"] = tables["fight_model_rows"].withColumn("y_method_group", F.lit(None).cast("string"))
    found = {r["check"]: r["found"] for r in audit.violations(bad, "2021-01-01").collect()}
    assert all(found.values()), found


def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"))
    s.replace_all({"a": spark.range(3), "b": spark.range(4)})
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        s.replace_all({"a": spark.range(9), "b": broken})
    assert (s.read("a").count(), s.read("b").count()) == (3, 4)
    s.replace("a", s.read("a").unionByName(spark.range(1)))
    assert (s.read("a").count(), s.read("b").count()) == (4, 4) and not s.exists("c")
    assert s.drop_old() == 3 and (s.read("a").count(), s.read("b").count()) == (4, 4)


def test_reload_with_fewer_rounds_resyncs(spark, store):
    again = spark.createDataFrame([(9, event(1, bout(1, "Ann", "Bea", rounds=1)))], "seq long, payload string")
    before = store.read("round_stats").count()
    ingest(store, again)
    assert store.read("round_stats").count() == before - 2
    assert store.read("fights").count() == 3 and store.read("fighters").count() == 3


def test_stream_loads_a_folder_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.json").write_text(DOCS[0][1] + "\n")
    target = Store(spark, str(tmp_path / "tables"))
    for _ in range(2):
        follow_folder(target, str(inbox), str(tmp_path / "state")).awaitTermination()
    assert target.read("fights").count() == 2
    (inbox / "b.json").write_text(DOCS[1][1] + "\n")
    follow_folder(target, str(inbox), str(tmp_path / "state")).awaitTermination()
    assert target.read("fights").count() == 3


def test_stream_takes_the_last_line_of_a_file(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lines = [event(1, bout(1, "Ann", "Bea", rounds=1 + i % 3)) for i in range(40)]
    (inbox / "a.json").write_text("\n".join(lines) + "\n")
    target = Store(spark, str(tmp_path / "tables"))
    follow_folder(target, str(inbox), str(tmp_path / "state")).awaitTermination()
    assert target.read("fights").first()["round"] == 1 + 39 % 3


def test_real_input_is_read_or_set_aside(spark):
    def doc(n, **changes):
        e = json.loads(event(n, bout(n, "Ann", "Bea")))
        for path, value in changes.items():
            place = e
            *way, last = path.split("__")
            for step in way:
                place = place[int(step) if step.isdigit() else step]
            place[last] = value
        return json.dumps(e)

    rows = [(1, doc(1, date="June 3, 2024")), (2, doc(2, date="soon")), (3, doc(3, date=None)),
            (4, doc(4, fights__0__general_info__round="3")), (5, doc(5, fights__0__general_info__round="three")),
            (6, doc(6, fights__0__round_stats__0__round="1", fights__0__round_stats__0__extra={"x": [1]},
                    fights__0__metadata__more="m", fights__0__totals__other="o")),
            (7, doc(7, fights__0__round_stats__0__round="first"))]
    tables, aside, _ = payload.load_rows(
        spark.createDataFrame(rows, "seq long, payload string"),
        spark.createDataFrame([], "fighter_id long, fighter_name string, fighter_url string"))
    assert {r["seq"] for r in aside.collect()} == {2, 5, 7}
    assert {r["event_url"][-1]: str(r["event_date"]) for r in tables["events"].collect()} == {
        "1": "2024-06-03", "3": "None", "4": "2020-04-01", "6": "2020-06-01"}
    assert {r["fight_url"][-1]: r["round"] for r in tables["fights"].collect()}["4"] == 3
    six = tables["fights"].filter("fight_url like '%/6'").select("fight_id")
    raw = tables["round_stats"].join(six, "fight_id").orderBy("round_number").first()["raw_round"]
    assert json.loads(raw)["extra"] == {"x": [1]}
    assert json.loads(tables["fight_metadata"].join(six, "fight_id").first()["raw_metadata"])["more"] == "m"
    assert json.loads(tables["fight_totals"].join(six, "fight_id").first()["raw_totals"])["other"] == "o"


def test_tables_of_a_load_are_made_when_read(spark, monkeypatch):
    written, plain = [], payload.cut
    monkeypatch.setattr(payload, "cut", lambda df, name: written.append(name) or plain(df, name))
    nobody = spark.createDataFrame([], "fighter_id long, fighter_name string, fighter_url string")
    # the bout comes twice; its second round comes twice within the later document
    later = event(2, bout(1, "Ann", "Bea"))
    later = json.loads(later)
    later["fights"][0]["round_stats"].append(later["fights"][0]["round_stats"][1] | {"fighter1": CELLS | {"kd": "7"}})
    docs = spark.createDataFrame([(1, event(1, bout(1, "Ann", "Cat", rounds=3))), (2, json.dumps(later)), (3, event(3, bout(3, "Ann", "Dee")))],
                                 "seq long, payload string")
    rows = payload.load_rows(docs, nobody, counted=False)[0].written()
    assert rows["events"].count() == 3 and written == ["documents", "events"]
    assert {r["fighter_name"] for r in rows["fighters"].collect()} == {"Ann", "Bea", "Cat", "Dee"}
    assert "document-bouts" not in written and "round_stats" not in written
    assert rows["fights"].count() == 2 and written.count("document-bouts") == written.count("people") == 1
    state = payload.apply_load(rows, rows)
    kds = [r["fighter1_kd"] for r in state["round_stats"].orderBy("fight_id", "round_number").collect()]
    assert sorted(kds) == ["0", "0", "0", "7"] and written.count("fights") == 1


def test_tables_in_buckets_are_written_once(spark, tmp_path, monkeypatch):
    from ringside.plans import build

    monkeypatch.setattr(build, "cut", lambda df, name: pytest.fail(f"{name} is written aside"))
    store = Store(spark, str(tmp_path))
    store.replace_all({"t": spark.range(50)}, {"t": ["id"]}, bucket_rows=10)
    assert store.read("t").count() == 50 and len(list(tmp_path.glob("t/*/key_bucket=*"))) == 5


def test_latest_of_few_is_latest(spark):
    rows = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", None, 1, "z"), ("a", None, 3, None), ("b", 1, 1, "w"),
                                  (None, None, 5, "v"), (None, 2, 4, "u")], "k string, l int, seq int, v string")
    for keys in (["k"], ["k", "l"], ["seq", "v"]):
        order = ["seq", "v"] if keys != ["seq", "v"] else ["l"]
        few, all_ = latest_of_few(rows, keys, order), latest(rows, keys, order)
        assert few.columns == all_.columns and sorted(map(str, few.collect())) == sorted(map(str, all_.collect()))


def test_counts_of_findings_are_whole(spark):
    events = spark.range(57).select(F.col("id").alias("event_id"), F.lit("e").alias("headline"),
                                    F.lit("1990-01-01").cast("date").alias("event_date"))
    early = {"events": events}
    assert audit.checks("2021-01-01")["events_too_early"](early).count() == audit.SHOWN["events_too_early"]
    assert audit.findings("2021-01-01")["events_too_early"](early).count() == 57


def test_keyed_writes(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", False), (2, "b", True), (3, "c", False)], "k int, v string, done boolean")
    new = spark.createDataFrame([(1, "A", False, 1), (1, "AA", False, 2), (2, "B", False, 1), (4, "D", False, 1)],
                                "k int, v string, done boolean, at int")
    last = latest(new, ["k"], ["at"]).drop("at")
    got = {r["k"]: r["v"] for r in upsert(old, last, ["k"], frozen=F.col("done")).collect()}
    assert got == {1: "AA", 2: "b", 3: "c", 4: "D"}
    groups = spark.createDataFrame([(1,), (2,)], "k int")
    got = {r["k"]: r["v"] for r in replace_group(old, groups, last.filter("k = 1"), "k").collect()}
    assert got == {1: "AA", 3: "c"}
    path = str(tmp_path / "kept")
    write_buckets(old, path, ["k"], bucket_rows=1)
    assert spark.read.text(f"{path}/_layout").first()[0] == "3"
    upsert_buckets(spark, path, last, ["k"])
    assert {r["k"]: r["v"] for r in spark.read.parquet(path).collect()} == {1: "AA", 2: "B", 3: "c", 4: "D"}


def test_name_rule_can_take_the_first_namesake(spark):
    known = spark.createDataFrame([(1, "Ann", "u1"), (2, "Ann", "u2")], "fighter_id long, fighter_name string, fighter_url string")
    asked = spark.createDataFrame([("Ann", None)], "fighter_name string, fighter_url string")
    assert payload.resolve_people(asked, known).first()["is_new"]
    assert payload.resolve_people(asked, known, unique_names=False).first()["fighter_id"] == 1


def test_documents_are_parsed_once_and_by_many_tasks(spark):
    orders = spark.range(40).selectExpr("id as o_orderkey", "id % 7 as o_custkey").coalesce(1)
    docs = documents(orders)
    assert docs.rdd.getNumPartitions() > 1
    good, aside = payload.read_documents(docs)
    for df, n in ((good, 43), (aside, 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.split("\n") if line.lstrip("+-: ").startswith("Filter") and "from_json" in line]
        assert df.count() == n
