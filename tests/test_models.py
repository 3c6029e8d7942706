"""Card scoring, percentiles, page patterns and a small model run."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringside import columns
from ringside.functions import scores
from ringside.operators import card, history, pages, views
from ringside.plans import learn
from ringside.plans.predict import read_ablation
from tests import test_features as tf


def test_upcoming_bouts_read_history_and_leave_it_alone(spark):
    rows = tf.random_history(5, fighters=12, bouts=40)
    df = spark.createDataFrame([tuple(r[f.name] for f in tf.schema()) for r in rows], tf.schema())
    df = df.withColumns({"event_date": F.date_from_unix_date(F.col("day_no").cast("int")),
                         "day_no": F.col("day_no").cast("int"), "bout_order": F.col("fight_id") + F.lit(2**63 - 10**7)})
    people = spark.createDataFrame([(i, f"N{i}", f"http://f.test/{i}") for i in range(1, 13)] + [(99, "N1", "http://f.test/99")],
                                   "fighter_id long, fighter_name string, fighter_url string")
    asked = spark.createDataFrame(
        [(0, "n3 ", None, "N4", "https://f.test/4/", "Lightweight", True),   # by name, by url
         (1, "N1", None, "Nobody", None, "UFC Flyweight Title Bout", False)],  # shared name and unknown
        "bout_no int, fighter_a_name string, fighter_a_url string, fighter_b_name string, fighter_b_url string, "
        "weight_class_raw string, is_main boolean")
    named = card.resolve_card(asked, people)
    got = {r["bout_no"]: r for r in named.collect()}
    assert (got[0]["fighter_a_id"], got[0]["fighter_b_id"]) == (3, 4) and got[0]["scheduled_rounds"] == 5
    assert got[1]["a_missing"] and got[1]["b_missing"] and got[1]["fighter_a_id"] != got[1]["fighter_b_id"] < 0
    assert got[1]["is_title"] and got[1]["scheduled_rounds"] == 5
    day = F.date_from_unix_date(F.lit(max(r["day_no"] for r in rows)))  # same day as the last bouts
    narrow = {(r["fight_id"], r["fighter_id"]): r for r in card.card_features(df, named, day).collect()}
    whole = history.build_features(card.with_upcoming(df, named, day))
    past = {(r["fight_id"], r["fighter_id"]): r for r in history.build_features(df).collect()}
    for r in whole.collect():
        key = (r["fight_id"], r["fighter_id"])
        assert r == (narrow[key] if key[0] < 0 else past[key])
    assert len(narrow) == 4 and narrow[-2, got[1]["fighter_a_id"]]["debut_flag"]
    bio = people.select("fighter_id", F.lit(70.0).alias("height"), F.col("fighter_id").cast("int").alias("reach"))
    both = {(r["fight_id"], r["orientation"]): r for r in card.card_rows(
        card.card_features(df, named, day), named, bio).collect()}
    assert both[-1, "page"]["diff_reach"] == -1 == -both[-1, "swapped"]["diff_reach"]
    assert both[-1, "page"]["a_career_wins"] == both[-1, "swapped"]["b_career_wins"]


def test_symmetric_probability(spark):
    rows = spark.createDataFrame(
        [(1, "page", 0.7, 3.0, -1.0, 50.0), (1, "swapped", 0.4, 2.0, 1.5, -3.0)],
        "fight_id int, orientation string, p double, slpm double, td double, ctrl double")
    r = card.symmetric(rows).first()
    assert r["p_a"] == pytest.approx(0.65) and r["p_b"] == pytest.approx(0.35)
    assert (r["td_a"], r["td_b"], r["ctrl_b"], r["slpm_b"]) == (0.0, 1.5, 0.0, 2.0)


@pytest.mark.parametrize("values", [
    [random.Random(1).gauss(0, 10) for _ in range(3000)],
    [random.Random(2).choice([0.0, 0.0, 1.0, 7.0]) for _ in range(3000)],
    [5.0], [1.0, 2.0],
])
def test_exact_percentile(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for p in (0.01, 0.5, 0.99):
        assert scores.exact_percentile(df, F.col("v"), p) == pytest.approx(np.percentile(values, 100 * p))


def test_histogram_matches_numpy(spark):
    values = [random.Random(4).random() for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = {r["bin"]: r["n"] for r in views.score_histogram(df).collect()}
    assert [got.get(i, 0) for i in range(20)] == list(np.histogram(values, bins=20)[0])


PAGE = """<table class="x"><tr><th>A</th></tr></table><TABLE><thead><tr class="head"><th>Round 1</th></tr></thead>
<tr><td><a class="n" href="/f/1"> Ann <b>B</b></a></td><td>W</td></tr></TABLE><section><h2>Totals</h2></section>
<i> nc </i><i>Win</i>"""


def test_page_patterns(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "")], "page_id int, html string")
    t = {r["page_id"]: r for r in pages.table_profile(df).collect()}
    assert (t[1]["n_tables"], t[1]["n_classless_tables"], t[1]["n_rows"]) == (2, 1, 3)
    assert (t[1]["n_header_cells"], t[1]["n_data_cells"], t[2]["n_tables"]) == (2, 2, 0)
    rows = {r["row_no"]: r for r in pages.table_rows(df).collect()}
    assert rows[0]["row_class"] == "head" and rows[0]["tags"] == ["th"] and rows[1]["texts"] == ["Ann B", "W"]
    link = pages.links(df).first()
    assert (link["text"], link["href"], link["link_class"]) == ("Ann B", "/f/1", "n")
    assert {r["status"]: r["n"] for r in pages.status_nodes(df).collect()} == {"w": 1, "nc": 1}
    assert pages.headings(df).first()["heading"] == "Totals"


def test_nested_and_unclosed_tables():
    rows = pages.rows_of_page
    assert rows("<table><tr><td>a<table><tr><th>b</th></tr></table>c</td><td/></tr></table>") == [
        (0, 0, None, ["td", "th", "td"], ["a b c", "b", ""]), (0, 1, None, ["th"], ["b"]), (1, 0, None, ["th"], ["b"])]
    # a table with a class holds one without; an end tag that nothing opened, and one that closes what is inside
    assert rows("<table class=x><tr><td></b><table><tr class=' q '><td>1<i>2</td><td>3</td></table>") == [
        (1, 0, "q", ["td", "td"], ["1 2", "3"])]
    assert rows("<table class=''><tr><td>x <br/>y&nbsp;&lt;z<script>no</script><!-- no --></table>") == [
        (0, 0, None, ["td"], ["x y\xa0<z"])]
    # cells that are not closed hold what follows
    assert rows("<table><tr><td>a<td>b</tr><tr><td>c") == [
        (0, 0, None, ["td", "td"], ["a b", "b"]), (0, 1, None, ["td"], ["c"])]
    assert rows(None) == rows("") == rows("<tr><td>no table</td></tr>") == rows("<table></table>") == []


def test_registry_sizes():
    assert (len(columns.STAT_COLS), len(columns.HISTORY_COLS), len(columns.FEATURE_COLS)) == (38, 91, 319)
    assert (len(columns.DIFF_COLS), len(columns.LABEL_COLS), len(columns.CARDIO_FACT_COLS)) == (74, 24, 30)


def train_rows(spark, n=600):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        x = rng.uniform(-1, 1)
        date = f"{2015 + i % 4}-0{1 + i % 9}-01"
        won = int(rng.random() < 0.5 + 0.4 * x)
        for side, s in (("page", 1), ("swapped", -1)):
            z = None if i % 10 == 0 else s * x
            rows.append((i, date, side, z, s * x * 2, rng.choice(["L", "M"]), 8, 9, 0.5, won if s == 1 else 1 - won,
                         3 + s * x))
    df = spark.createDataFrame(rows, "fight_id long, d string, orientation string, diff_reach double, a_last3_x double, "
                               "weight_class_norm string, a_career_fights_count int, b_career_fights_count int, "
                               "a_career_win_pct double, y_a_win int, y_a_td_landed double")
    return df.withColumns({"event_date": F.to_date("d"), "a_debut_flag": F.lit(False), "b_debut_flag": F.lit(False),
                           "a_career_n_opp_known": F.lit(3), "b_career_win_pct": F.lit(0.4)}).drop("d")


def test_trees_are_kept_up_to_the_least_loss():
    assert learn.trees_to_keep([3, 2, 1, 2, 2, 0], patience=3) == 6
    assert learn.trees_to_keep([3, 2, 1, 2, 2, 2, 0], patience=3) == 3
    assert learn.trees_to_keep([1.0]) == 1


def test_trees_beyond_the_end_are_not_grown(spark, monkeypatch):
    rows = train_rows(spark, 300)
    early = F.year("event_date") < 2017
    fit, val, cols = rows.filter(early), rows.filter(~early).withColumn("y_a_td_landed", F.col("y_a_td_landed") + 0.3), ["a_last3_x"]
    boost = learn.Boost(trees=20, depth=2, step=0.9, subsample=1.0, columns="all")
    monkeypatch.setattr(learn, "PATIENCE", 3)
    monkeypatch.setattr(learn, "trees_to_keep", lambda losses, keep=learn.trees_to_keep: keep(losses, 3))
    grown = []
    plain = learn.GBTRegressor._fit
    monkeypatch.setattr(learn.GBTRegressor, "_fit", lambda self, df: grown.append(self.getMaxIter()) or plain(self, df))
    monkeypatch.setattr(learn, "FIRST_TREES", 20)
    whole = learn.fit(fit, cols, "y_a_td_landed", boost, val=val)
    assert grown[0] == 20 and whole.trees <= 5
    grown.clear()
    monkeypatch.setattr(learn, "FIRST_TREES", 2)
    some = learn.fit(fit, cols, "y_a_td_landed", boost, val=val)
    assert grown[0] == 2 and max(grown) < 20 and some.trees == whole.trees
    a, b = ([r["p"] for r in m.predict(val).orderBy(*learn.KEYS).collect()] for m in (whole, some))
    assert a == pytest.approx(b, abs=1e-9)


def test_stat_model_scores_grow_the_whole_model(monkeypatch):
    import queries

    asked = []
    monkeypatch.setattr(queries, "_slices", lambda spark, d: [type("Rows", (), {"columns": ["a_x", "y_a_td_landed"]})()] * 3)
    monkeypatch.setattr(learn, "stat_scores", lambda fit, val, test, cols, label, base, boost: asked.append((cols, label, boost)) or (None, None))
    queries._stat_model_scores(None, "")
    assert asked == [(["a_x"], "y_a_td_landed", learn.Boost())] and (learn.Boost().trees, learn.Boost().depth) == (500, 5)


def test_model_round_trip(spark, tmp_path):
    from datetime import date

    eras = scores.Eras(date(2015, 1, 1), date(2017, 1, 1), date(2018, 1, 1))
    rows = train_rows(spark)
    fit, val, test = [eras.slice(rows, e) for e in ("FIT", "VAL", "TEST")]
    cols = ["diff_reach", "a_last3_x", "weight_class_norm", "not_there"]
    boost = learn.Boost(trees=5, depth=3)
    model, result = learn.win_models(fit, val, test, cols, boost)
    r = result.first()
    assert model.trees > 1
    assert r["logloss"] < r["coin_logloss"] and r["veteran_n"] == r["n_test"] and "not_there" not in model.features
    learn.save(model, str(tmp_path / "win"))
    again = learn.load(spark, str(tmp_path / "win"))
    one, two = ({(x["fight_id"], x["orientation"]): x["p"] for x in m.predict(test).collect()} for m in (model, again))
    assert one == two and again.trees == model.trees
    oof = learn.walk_forward(rows, cols, "y_a_td_landed", boost)
    filled = {x["y"]: x["n"] for x in oof.join(rows, learn.KEYS).groupBy(F.year("event_date").alias("y")).agg(
        F.count("pred").alias("n")).collect()}
    assert filled[2015] == 0 and filled[2016] == filled[2018] == 300
    recipes = learn.ablation_recipes(cols, [*cols, "prod_expected_td_pm"])
    assert list(recipes) == ["baseline", "drop_last3", "drop_bio", "drop_last3+momentum (1 gone)", "add_td_products (+1)"]
    out = learn.ablate(spark, fit, val, test, {k: recipes[k] for k in ("baseline", "drop_last3")}, boost)
    assert len(out.columns) == 18 and out.first()["delta_val_logloss"] == 0.0
    out.toDF(*[f" {c}" for c in out.columns]).coalesce(1).write.option("header", True).csv(str(tmp_path / "a"))
    back = read_ablation(spark, str(tmp_path / "a"))
    assert [tuple(r) for r in back.orderBy("recipe").collect()] == [tuple(r) for r in out.orderBy("recipe").collect()]


def test_predictions_equal_a_plain_refit(spark):
    from datetime import date

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    eras = scores.Eras(date(2015, 1, 1), date(2018, 1, 1), date(2019, 1, 1))
    rows = train_rows(spark)
    fit, test = eras.slice(rows, "FIT"), eras.slice(rows, "VAL")
    cols = ["diff_reach", "weight_class_norm", "a_last3_x"]
    boost = learn.Boost(trees=4, depth=3, subsample=1.0, columns="all")
    got = {(r["fight_id"], r["orientation"]): r["p"] for r in learn.fit(fit, cols, "y_a_win", boost, kind="win").predict(test).collect()}

    def plain(df):
        df = df.withColumns({"f0": F.coalesce("diff_reach", F.lit(-1e9)), "f2": F.col("a_last3_x"),
                             "f1": F.when(F.col("weight_class_norm") == "L", 0.0).otherwise(1.0)})
        # every row: eight and nine bouts, opponents known, no debut
        return VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features").transform(df)

    trees = GBTClassifier(labelCol="y_a_win", maxIter=4, maxDepth=3, stepSize=boost.step, minInstancesPerNode=boost.min_rows, seed=42)
    again = trees.fit(plain(fit)).transform(plain(test)).select(*learn.KEYS, vector_to_array("probability")[1].alias("p"))
    want = {(r["fight_id"], r["orientation"]): r["p"] for r in again.collect()}
    assert got.keys() == want.keys() and len(set(want.values())) > 5
    for k, p in want.items():
        assert got[k] == pytest.approx(p, abs=1e-9)


def test_slices_of_one_matrix_equal_fits_of_their_own(spark):
    rows = train_rows(spark)
    cols = ["a_last3_x", "weight_class_norm", "diff_reach"]
    boost = learn.Boost(trees=3, depth=3, subsample=1.0, columns="all")
    matrix = learn.Matrix.of(rows, [*cols, "a_career_win_pct", "not_there"], ["y_a_td_landed"])
    assert matrix.slots == [*cols, "a_career_win_pct"]
    early, late = F.year("event_date") < 2017, F.year("event_date") >= 2017
    for some in (cols, ["diff_reach", "a_last3_x"]):
        one = learn.fit(matrix.where(early), some, "y_a_td_landed", boost).predict(matrix.where(late), "g")
        own = learn.fit(rows.filter(early), some, "y_a_td_landed", boost).predict(rows.filter(late), "g")
        a, b = ({(r["fight_id"], r["orientation"]): r["g"] for r in x.collect()} for x in (one, own))
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_walk_forward_equals_a_fit_a_year(spark):
    rows = train_rows(spark)
    cols = ["diff_reach", "a_last3_x"]
    boost = learn.Boost(trees=3, depth=3, subsample=1.0, columns="all")
    got = {(r["fight_id"], r["orientation"]): r["pred"] for r in learn.walk_forward(rows, cols, "y_a_td_landed", boost).collect()}
    assert len(got) == rows.count()
    year = F.year("event_date")
    for fold in learn.fold_plan(rows, "y_a_td_landed"):
        target = rows.filter(year == fold.year)
        if fold.mode == "none":
            assert all(got[r["fight_id"], r["orientation"]] is None for r in target.collect())
            continue
        usable = rows.filter(year < fold.year)
        early = F.col("event_date") < F.lit(fold.edge)
        model = learn.fit(usable, cols, "y_a_td_landed", boost) if fold.mode == "fixed" else learn.fit(
            usable.filter(early), cols, "y_a_td_landed", boost, val=usable.filter(~early))
        for r in model.predict(target, "g").collect():
            assert got[r["fight_id"], r["orientation"]] == pytest.approx(r["g"], abs=1e-9)


def test_many_percentiles_at_once(spark):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 5), rng.choice([1.0, 2.0, None]), None) for _ in range(800)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    got = scores.exact_percentiles(df, {"a1": (a, 0.01), "a9": (a, 0.99), "am": (a, 0.5), "bm": (b, 0.5), "c": (c, 0.5), "top": (b, 1.0)})
    known = [x[1] for x in rows if x[1] is not None]
    assert got["c"] is None and got["top"] == 2.0 and got["bm"] == pytest.approx(np.percentile(known, 50))
    for name, p in (("a1", 1), ("a9", 99), ("am", 50)):
        assert got[name] == pytest.approx(np.percentile([x[0] for x in rows], p))
