"""Stored layers of the bound tables: what is read several times is worked out once."""

from pyspark.sql import functions as F

from ringside import columns
from ringside.operators import model_rows
from ringside.sources.binding import Bench


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def small_bench(spark, tmp_path, orders=12):
    """Four lines an order, so two rounds of two competitors each; every order has the same day of a month."""
    lines = [(o, 1 + (o * 3 + i) % 6, 1 + (o + i) % 5, i + 1, float(10 + o), 100.0 * o + i, 0.0, 0.0, "N" if i % 2 else "R", "O")
             for o in range(1, orders + 1) for i in range(4)]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                  "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    lines = lines.withColumn("l_shipdate", F.lit("1998-01-01").cast("timestamp"))
    bouts = spark.createDataFrame([(o, 10 + o, f"{1996 + o % 5}-03-0{1 + o % 9}", "1-URGENT" if o % 2 else "3-MEDIUM")
                                   for o in range(1, orders + 1)], "o_orderkey long, o_custkey long, d string, o_orderpriority string")
    bouts = bouts.select("o_orderkey", "o_custkey", F.to_timestamp("d").alias("o_orderdate"), "o_orderpriority")
    people = spark.createDataFrame([(i, f"n{i}", "b", "t", 5 + i) for i in range(1, 7)],
                                   "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    for name, df in (("lineitem", lines), ("orders", bouts), ("part", people)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Bench(spark, str(tmp_path))


def test_labels_and_windows_read_stored_corner_facts(spark, tmp_path):
    tables = small_bench(spark, tmp_path)
    stored = tables.stored_train_with("a_career_pace_avg", "prod_expected_td_pm")
    assert "raw_round" not in plan_of(stored) and "fighter1_sig_str" not in plan_of(stored)  # no cell of a round is read again
    plain = tables.train_with("a_career_pace_avg", "prod_expected_td_pm")
    assert stored.schema == plain.schema
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect())) and stored.count() > 0
    tables.__dict__["stored_features"] = tables.features_with(["career_pace_avg"])
    made = model_rows.model_rows(tables.stored_features, tables.fight_facts, tables.corner_facts, tables.fighter_bio)
    kept = tables.stored_model_rows
    assert kept.columns == made.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, made.collect()))


def test_one_join_copies_the_rows_of_both_corners(spark):
    """Joins whose rows hold the first corner's features: one, for they meet what has all else."""
    sides = spark.createDataFrame([(i + 1, b, 2 - i, i == 0, 0.5) for b in (1, 2) for i in (0, 1)],
                                  "fighter_id long, fight_id long, opponent_id long, is_fighter1 boolean, career_pace_avg double")
    sides = sides.withColumns({"event_date": F.lit("2000-01-01").cast("date"), "result": F.lit("W")})
    corners = sides.select("*", *[F.lit(1.0).alias(c) for c in columns.LABEL_COLS])
    facts = sides.filter("is_fighter1").select("fight_id", *[F.lit(1).alias(c) for c in model_rows.BOUT], F.lit("DEC").alias("method_group"),
                                               F.lit("decisive").alias("outcome_type"), F.lit(1).cast("long").alias("winner_id"))
    bio = spark.createDataFrame([(1, 70.0, 71), (2, 60.0, None)], "fighter_id long, height double, reach int")
    rows = model_rows.model_rows(sides, facts, corners, bio)
    assert [(r["f1_height"], r["f2_height"], r["diff_height"], r["y_fighter1_win"]) for r in rows.collect()] == [(70.0, 60.0, 10.0, 1)] * 2
    wide, todo = 0, [rows._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        wide += node.nodeName() == "Join" and "f1_career_pace_avg" in node.output().toString()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert wide == 1
