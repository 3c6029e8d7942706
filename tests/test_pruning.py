"""Wide tables are put together with the columns that are read, and nothing wide is written on the way."""

from pyspark.sql import functions as F

from ringside.columns import DIFF_COLS, FEATURE_COLS, LABEL_COLS
from ringside.operators import corners, model_rows
from ringside.sources import binding
from ringside.sources.binding import Bench

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")
FLAGS = ["N", "R", None]


def tables(spark, folder):
    lines = [(o, 1 + (o * 3 + n) % 9, None if n == 4 else o * 5 + n * 17, n, float(n * 7 % 11), 10.0 * n + o, 0.0, 0.0,
              FLAGS[(o + n) % 3], "O", None) for o in range(1, 40) for n in range(1, 2 + o % 6)]
    spark.createDataFrame(lines + lines[:5], LINES).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.range(1, 45).select(
        F.col("id").alias("o_orderkey"), (F.col("id") * 3).alias("o_custkey"),
        F.expr("date_add(date'1999-01-01', cast(id % 9 as int))").alias("o_orderdate"), F.lit("3-MEDIUM").alias("o_orderpriority"))
    orders.write.parquet(f"{folder}/orders.parquet")
    parts = spark.range(1, 12).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit(5).alias("p_size"),
        F.lit("t").alias("p_type"))
    parts.write.parquet(f"{folder}/part.parquet")
    return Bench(spark, str(folder))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cells_of_a_round_are_those_of_its_lines(spark, tmp_path):
    bench = tables(spark, tmp_path)
    want = bench.lines.groupBy("fight_id", "round_number").agg(*binding.exprs(binding.ROUND_AGGS))
    want = want.join(bench.per_fight.filter("f2 is not null"), "fight_id", "left_semi").select(*bench.round_stats.columns)
    assert want.count() == bench.round_stats.count() > 40
    assert want.exceptAll(bench.round_stats).isEmpty()


def test_corners_are_counted_without_reading_cells(spark, tmp_path):
    bench = tables(spark, tmp_path)
    assert "regexp" in plan(bench.corner_facts)
    assert "regexp" not in plan(bench.corner_facts.groupBy("fight_id").count())
    assert "regexp" not in plan(corners.round_facts(bench.eligible, bench.round_stats).groupBy("fighter_id").count())


def test_a_plan_of_few_features_holds_no_others_and_says_the_same(spark, tmp_path):
    bench = tables(spark, tmp_path)
    none, few = bench.train_with(), bench.train_with("a_career_pace_avg", "y_a_pace")
    more = bench.train_with("diff_career_pace_avg", "b_last5_late_td_avg", "a_career_mix_entropy", "prod_expected_td_pm")
    assert bench.train_with("b_career_pace_avg") is few
    assert not set(FEATURE_COLS) & {c[2:] for c in none.columns}
    assert set(FEATURE_COLS) & {c[2:] for c in few.columns if c.startswith("a_")} == {"career_pace_avg"}
    assert "prod_expected_td_pm" in more.columns and "prod_expected_sig_pm" not in more.columns
    shown = ["fight_id", "orientation", "a_career_pace_avg", "b_career_pace_avg", "diff_career_pace_avg", "y_a_pace"]
    a, b = (sorted(map(str, df.select(*shown).collect())) for df in (few, more))
    assert a == b and len(a) > 40


def test_training_rows_are_counted_without_windows_and_in_one_pass(spark, tmp_path):
    train = tables(spark, tmp_path).model_train
    assert "regexp" not in plan(train.groupBy("y_a_win").count()) and "Window" not in plan(train.groupBy("y_a_win").count())
    names = ["fighter_id", *model_rows.BODY, *FEATURE_COLS]
    wide = spark.range(3).select(
        F.col("id").alias("fight_id"), F.lit(None).cast("date").alias("event_date"), *[F.lit(None).alias(c) for c in model_rows.BOUT],
        *[F.lit(float(s)).alias(f"f{s}_{c}") for s in (1, 2) for c in names],
        *[F.lit(-1.0).alias(f"diff_{c}") for c in model_rows.BODY + DIFF_COLS], F.lit(1).alias("y_fighter1_win"),
        *[F.lit(None).alias(c) for c in model_rows.SHARED_LABELS], *[F.lit(float(s)).alias(f"y_f{s}_{c}") for s in (1, 2) for c in LABEL_COLS])
    both = model_rows.mirrored(wide)
    assert plan(both.select("fight_id", "a_reach")).count("Range") == 1
    shown = both.select("orientation", "a_fighter_id", "b_fighter_id", "diff_reach", "y_a_win").distinct().collect()
    assert sorted(map(tuple, shown)) == [("page", 1.0, 2.0, -1.0, 1), ("swapped", 2.0, 1.0, 1.0, 0)]
