"""Corner facts on hand-made bouts that end in different ways."""

import pytest
from pyspark.sql import functions as F

from ringside.operators import corners

CELLS = ["kd", "sig_str", "total_str", "td", "sub_att", "rev", "ctrl"]
FIGHT = ("fight_id int, event_id int, weight_class string, method string, round int, time string, time_format string, "
         "fighter1_id int, fighter2_id int, winner_id int, outcome_type string")
THREE, FIVE = "3 Rnd (5-5-5)", "5 Rnd (5-5-5-5-5)"
FIGHTS = [
    (1, 1, "Lightweight", "Decision - Split", 3, "5:00", THREE, 10, 20, 10, "decisive"),   # three-round distance
    (2, 1, "Lightweight", "KO/TKO", 3, "0:20", THREE, 11, 21, 21, "decisive"),              # stopped early in round 3
    (3, 1, "Lightweight", "KO/TKO", 4, "0:30", FIVE, 12, 22, 12, "decisive"),               # five-rounder, stopped in 4
    (4, 1, None, "Decision", 5, "5:00", FIVE, 13, 23, None, "draw"),                        # five-round distance
    (5, 1, "Flyweight", "Submission", 1, "1:00", THREE, 14, 24, 14, "decisive"),            # first-round finish
    (6, 1, "Flyweight", "DQ", 2, "1:00", THREE, 15, 25, 15, "decisive"),                    # no rounds recorded
    (7, 1, "Flyweight", "KO/TKO", 1, "1:00", THREE, 16, 16, 16, "decisive"),                # a fighter against himself
    (8, 2, "Flyweight", "KO/TKO", 1, "1:00", THREE, 17, 27, 17, "decisive"),                # undated event
]


def rounds():
    rows = []
    for fight, n in ((1, 3), (2, 3), (3, 4), (4, 5), (5, 1)):
        for r in range(1, n + 1):
            one = ["---" if r == 3 else "1", f"{10 - r} of {20 - r}", "5 of 9", "1 of 2", "0", "0", "1:30"]
            two = ["0", f"{r} of {10 * r}", "5 of 9", "0 of 0", "1", "--", "--"]
            raw = '{"significant_strikes":{"fighter1":{"distance":"3 of 4"},"fighter2":{}}}' if r == 1 else "broken"
            rows.append((fight, r, *one, *two, raw))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    names = [f"fighter{s}_{c} string" for s in (1, 2) for c in CELLS]
    return {
        "fights": spark.createDataFrame(FIGHTS, FIGHT),
        "events": spark.createDataFrame([(1, "2020-01-01"), (2, None)], "event_id int, d string").selectExpr(
            "event_id", "to_date(d) as event_date"),
        "rounds": spark.createDataFrame(rounds(), f"fight_id int, round_number int, {', '.join(names)}, raw_round string"),
        "totals": spark.createDataFrame(
            [(1, "30 of 60", "15 of 30", *["10 of 20"] * 12)],
            "fight_id int, fighter1_sig_str string, fighter2_sig_str string, "
            + ", ".join(f"fighter{s}_{p} string" for s in (1, 2) for p in corners.STRIKE_PARTS)),
    }


@pytest.fixture(scope="module")
def facts(tables):
    eligible = corners.eligible_fights(tables["fights"], tables["events"])
    bouts = corners.fight_facts(eligible)
    rows = corners.corner_facts(eligible, bouts, tables["totals"], tables["rounds"]).collect()
    return {(r["fight_id"], r["is_fighter1"]): r for r in rows}


def test_undated_and_self_bouts_are_left_out(facts):
    assert {k[0] for k in facts} == {1, 2, 3, 4, 5, 6}
    assert len(facts) == 12


def test_totals_win_over_summed_rounds(facts):
    assert facts[1, True]["sig_str_landed"] == 30.0 and facts[1, True]["distance_pct"] == pytest.approx(100 / 3)
    assert facts[2, True]["sig_str_landed"] == 9 + 8 + 7 and facts[2, True]["distance_landed"] is None


def test_opponent_numbers_mirror(facts):
    for (fight, first), row in facts.items():
        other = facts[fight, not first]
        assert row["sig_str_absorbed"] == other["sig_str_landed"]
        assert row["kd_absorbed"] == other["kd"] and row["ctrl_against_seconds"] == other["ctrl_seconds"]
    assert facts[1, True]["strike_defense"] == 50.0
    assert facts[1, True]["td_defense"] is None  # nothing attempted is not 100 percent
    assert facts[2, False]["td_defense"] == 50.0


def test_sums_skip_unreadable_cells_but_stay_null_without_any(facts):
    assert facts[1, True]["kd"] == 2.0 and facts[1, False]["ctrl_seconds"] is None
    assert facts[6, True]["kd"] is None and facts[6, True]["pace"] is None


def test_three_round_distance(facts):
    r = facts[1, True]
    assert r["went_the_distance"] and r["completed_round_3"] and r["last_completed_round"] == 3
    assert r["cardio_distance_att"] == pytest.approx(17 / 19) == r["cardio_observed_att"]
    assert r["cardio_consec_att"] == pytest.approx((18 / 19 + 17 / 18) / 2)
    assert r["late_kd"] == 0.0 and r["late_ctrl_seconds"] == 90.0  # an unreadable late cell counts as 0


def test_early_stoppage_in_round_three(facts):
    r = facts[2, True]
    assert r["reached_round_3"] and not r["completed_round_3"] and not r["went_the_distance"]
    assert r["last_completed_round"] == 2 and r["cardio_last_full_r1_att"] == pytest.approx(18 / 19)
    assert r["cardio_r3_r1_att"] == pytest.approx(17 / 19) and r["cardio_observed_att"] is None


def test_five_round_stoppage(facts):
    r = facts[3, True]
    assert not r["went_the_distance"] and r["completed_round_3"] and r["last_completed_round"] == 3
    assert r["cardio_five_stoppage_att"] == pytest.approx(17 / 19) == r["cardio_observed_att"]
    assert r["late_td_landed"] is None  # a five-rounder needs round 5 for late sums


def test_five_round_distance(facts):
    r = facts[4, True]
    assert r["went_the_distance"] and r["completed_round_5"] and r["result"] == "D"
    assert r["cardio_distance_att"] == pytest.approx(15 / 19)
    assert r["cardio_consec_att"] == pytest.approx((18 / 19 + 17 / 18 + 16 / 17 + 15 / 16) / 4)
    assert r["late_td_landed"] == 2.0


def test_first_round_finish_and_missing_rounds(facts):
    assert facts[5, True]["last_completed_round"] is None and not facts[5, True]["reached_round_3"]
    assert facts[6, True]["reached_round_3"] is False and facts[6, False]["is_valid_for_stats"] is False


def test_round_facts_read_the_stored_json(tables):
    eligible = corners.eligible_fights(tables["fights"], tables["events"])
    rows = {(r["fight_id"], r["round_number"], r["is_fighter1"]): r
            for r in corners.round_facts(eligible, tables["rounds"]).collect()}
    assert len(rows) == 32
    assert rows[1, 1, True]["distance_landed"] == 3.0 and rows[1, 2, True]["distance_landed"] is None
    assert rows[1, 3, True]["kd"] is None and rows[1, 1, True]["ctrl_seconds"] == 90.0


def test_a_round_is_not_parsed_once_for_every_cell(tables):
    eligible = corners.eligible_fights(tables["fights"], tables["events"])
    plan = corners.round_facts(eligible, tables["rounds"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") <= 2 + 3 * len(corners.STRIKE_PARTS)


def test_a_text_in_the_place_of_cells_is_not_read_as_json(tables):
    inner = r'"{\"distance\":\"3 of 4\"}"'
    raws = ['{"significant_strikes":{"fighter1":%s,"fighter2":{"distance":"1 of 2"}}}' % inner,
            '[{"significant_strikes":{"fighter1":{"distance":"3 of 4"}}}]', None, '{"significant_strikes":{"fighter1":[7]}}']
    rounds = tables["rounds"].filter("fight_id = 4").withColumn(
        "raw_round", F.element_at(F.array(*[F.lit(x) for x in raws]), F.pmod("round_number", F.lit(4)).cast("int") + 1))
    eligible = corners.eligible_fights(tables["fights"], tables["events"])
    found = corners.round_facts(eligible, rounds).filter("distance_landed is not null").collect()
    assert [(r["fighter_id"], r["round_number"], r["distance_landed"], r["distance_attempted"]) for r in found] == [(23, 4, 1.0, 2.0)]
