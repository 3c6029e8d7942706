"""Bouts to corners: one wide row per bout becomes one numeric row per side.

Both sides of a bout sit on the same wide row until the unpivot, so what the
opponent did is copied over there; no self-join and no extra shuffle is needed.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.columns import CARDIO_FACT_COLS, OPPONENT_RATE_COLS
from ringside.functions import measures as m
from ringside.functions import parse
from ringside.operators import cardio

SIDES = (1, 2)
STRIKE_PARTS = ["distance", "clinch", "ground", "head", "body", "leg"]
PAIR_CELLS = ["sig_str", "total_str", "td"]
COUNT_CELLS = ["kd", "sub_att", "rev"]

FIGHT_FACT_COLS = [
    "fight_id", "event_id", "event_date", "weight_class_raw", "weight_class_norm", "is_title",
    "is_women", "time_format_raw", "scheduled_rounds", "final_round", "fight_seconds",
    "method_raw", "method_group", "outcome_type", "winner_id", "is_valid_for_stats",
]

CORNER_FACT_COLS = (
    [
        "fighter_id", "fight_id", "opponent_id", "is_fighter1", "event_date", "result",
        "is_valid_for_stats", "method_group", "final_round", "fight_seconds",
        "sig_str_landed", "sig_str_attempted", "sig_str_percent",
        "total_str_landed", "total_str_attempted",
        "td_landed", "td_attempted", "td_percent", "kd", "sub_att", "rev", "ctrl_seconds",
    ]
    + [f"{part}_{k}" for part in STRIKE_PARTS for k in ("landed", "attempted")]
    + ["distance_pct", "clinch_pct", "ground_pct"]
    + OPPONENT_RATE_COLS
    + CARDIO_FACT_COLS
)

# Bout columns kept on the corner rows so that the history step needs no join.
BOUT_CONTEXT_COLS = ["weight_class_norm", "is_title", "scheduled_rounds"]

ROUND_STATS = (
    [f"{c}_{k}" for c in PAIR_CELLS for k in ("landed", "attempted")]
    + COUNT_CELLS
    + ["ctrl_seconds"]
    + [f"{part}_{k}" for part in STRIKE_PARTS for k in ("landed", "attempted")]
)


def eligible_fights(fights: DataFrame, events: DataFrame) -> DataFrame:
    """Dated bouts with two known corners; a bout of a competitor against itself has bout and round facts too."""
    dated = events.select("event_id", "event_date").filter("event_date is not null")
    known = fights.filter("fighter1_id is not null and fighter2_id is not null")
    return known.join(dated, "event_id")


def corner_rejects(eligible: DataFrame) -> DataFrame:
    """Bouts without corner facts: one competitor in both corners has no opponent, and two rows of one key."""
    same = eligible.filter("fighter1_id = fighter2_id")
    return same.select("fight_id", F.col("fighter1_id").alias("fighter_id"), F.lit("same competitor twice").alias("reason"))


def fight_facts(eligible: DataFrame) -> DataFrame:
    group = m.method_group(F.col("method"), F.col("outcome_type"))
    return eligible.select(
        "fight_id",
        "event_id",
        "event_date",
        F.col("weight_class").alias("weight_class_raw"),
        m.class_name(F.col("weight_class")).alias("weight_class_norm"),
        m.is_title(F.col("weight_class")).alias("is_title"),
        m.is_women(F.col("weight_class")).alias("is_women"),
        F.col("time_format").alias("time_format_raw"),
        parse.scheduled_rounds(F.col("time_format")).alias("scheduled_rounds"),
        F.col("round").alias("final_round"),
        parse.bout_seconds(F.col("round"), F.col("time"), F.col("time_format")).alias("fight_seconds"),
        F.col("method").alias("method_raw"),
        group.alias("method_group"),
        "outcome_type",
        "winner_id",
        m.counts_for_stats(group).alias("is_valid_for_stats"),
    )


def parsed_rounds(rounds: DataFrame) -> DataFrame:
    """Numeric round cells of both sides: s1_td_landed, s2_kd, ..."""
    cols = []
    for s in SIDES:
        for c in PAIR_CELLS:
            cell = F.col(f"fighter{s}_{c}")
            cols += [parse.landed(cell).alias(f"s{s}_{c}_landed")]
            cols += [parse.attempted(cell).alias(f"s{s}_{c}_attempted")]
        cols += [parse.count(F.col(f"fighter{s}_{c}")).alias(f"s{s}_{c}") for c in COUNT_CELLS]
        cols.append(parse.clock_seconds(F.col(f"fighter{s}_ctrl")).alias(f"s{s}_ctrl_seconds"))
    return rounds.select("fight_id", "round_number", *cols)


def round_totals(parsed: DataFrame) -> DataFrame:
    """Per bout: summed cells, strike output of rounds 1-5 and late-round sums, in one aggregation.

    A SQL sum is NULL when nothing was readable. The late sums instead count an
    unreadable cell as 0 once such a round exists at all.
    """
    rnd = F.col("round_number")
    aggs = []
    for s in SIDES:
        for c in [f"{p}_{k}" for p in PAIR_CELLS for k in ("landed", "attempted")] + COUNT_CELLS + ["ctrl_seconds"]:
            aggs.append(F.sum(f"s{s}_{c}").alias(f"s{s}_{c}_sum"))
        for n in range(1, 6):
            for k in ("landed", "attempted"):
                aggs.append(F.max(F.when(rnd == n, F.col(f"s{s}_sig_str_{k}"))).alias(f"s{s}_r{n}_{k}"))
        for first in (3, 4):
            for c in ("td_landed", "td_attempted", "kd", "ctrl_seconds"):
                late = F.sum(F.when(rnd >= first, F.coalesce(F.col(f"s{s}_{c}"), F.lit(0.0))))
                aggs.append(late.alias(f"s{s}_late{first}_{c}"))
    return parsed.groupBy("fight_id").agg(*aggs)


def _totals(totals: DataFrame) -> DataFrame:
    cols = []
    for s in SIDES:
        for c in ["sig_str", *STRIKE_PARTS]:
            cell = F.col(f"fighter{s}_{c}")
            cols.append(parse.landed(cell).alias(f"s{s}_tot_{c}_landed"))
            cols.append(parse.attempted(cell).alias(f"s{s}_tot_{c}_attempted"))
    return totals.select("fight_id", *cols)


OWN = (
    ["total_str_landed", "total_str_attempted", "td_landed", "td_attempted", *COUNT_CELLS, "ctrl_seconds"]
    + [f"r{n}_{k}" for n in range(1, 6) for k in ("landed", "attempted")]
    + [f"late{f}_{c}" for f in (3, 4) for c in ("td_landed", "td_attempted", "kd", "ctrl_seconds")]
)
FACED = ["sig_str_landed", "sig_str_attempted", "td_landed", "td_attempted", "kd", "ctrl_seconds"]


def _both_sides(rows: DataFrame, kept: list[str], sides: dict[int, dict]) -> DataFrame:
    """Every row twice, once for each side, with that side's columns: sides has the same names for both.

    Each column is an expression of its own, so that what a query does not read is not worked out either; cells of a
    struct in an array would all be.
    """
    me = F.col("__side")
    cols = [F.when(me == 1, sides[1][n]).otherwise(sides[2][n]).alias(n) for n in sides[1]]
    return rows.withColumn("__side", F.explode(F.array(*[F.lit(s) for s in SIDES]))).select(*kept, *cols)


def _side(me: int, other: int) -> dict:
    def own(c, s=me):
        return F.col(f"s{s}_{c}" if c.startswith(("r1", "r2", "r3", "r4", "r5", "late")) else f"s{s}_{c}_sum")

    def strikes(k, s):
        """Bout totals, or the summed rounds when the totals are missing."""
        whole = F.col(f"s{s}_tot_sig_str_landed")
        return F.when(whole.isNull(), F.col(f"s{s}_sig_str_{k}_sum")).otherwise(F.col(f"s{s}_tot_sig_str_{k}"))

    cols = {
        "fighter_id": F.col(f"fighter{me}_id"),
        "opponent_id": F.col(f"fighter{other}_id"),
        "is_fighter1": F.lit(me == 1),
        "sig_str_landed": strikes("landed", me),
        "sig_str_attempted": strikes("attempted", me),
        "opp_sig_str_landed": strikes("landed", other),
        "opp_sig_str_attempted": strikes("attempted", other),
    }
    cols |= {c: own(c) for c in OWN}
    cols |= {f"opp_{c}": own(c, other) for c in FACED[2:]}
    for part in STRIKE_PARTS:
        cols |= {f"{part}_{k}": F.col(f"s{me}_tot_{part}_{k}") for k in ("landed", "attempted")}
    return cols


def corner_rows(eligible: DataFrame, facts: DataFrame, totals: DataFrame, rounds: DataFrame) -> DataFrame:
    """Unpivot: two rows per bout, each with its own and the opponent's raw numbers; see corner_rejects."""
    ids = eligible.filter("fighter1_id <> fighter2_id").select("fight_id", "fighter1_id", "fighter2_id")
    wide = (
        facts.join(ids, "fight_id")
        .join(_totals(totals), "fight_id", "left")
        .join(round_totals(parsed_rounds(rounds)), "fight_id", "left")
    )
    bout = [
        "fight_id", "event_date", "is_valid_for_stats", "method_group", "final_round",
        "fight_seconds", "winner_id", "outcome_type", *BOUT_CONTEXT_COLS,
    ]
    return _both_sides(wide, bout, {1: _side(1, 2), 2: _side(2, 1)})


def with_opponent_and_rates(rows: DataFrame) -> DataFrame:
    """Result, accuracies, absorbed volume, defense, differences and per-minute rates."""
    c = F.col
    sec = c("fight_seconds")

    def defense(kind):
        return 100.0 - m.share(c(f"opp_{kind}_landed"), c(f"opp_{kind}_attempted"))

    volume = F.coalesce(
        c("sig_str_attempted") + c("td_attempted"), c("sig_str_attempted"), c("td_attempted")
    )
    derived = {
        "result": m.corner_result(c("fighter_id"), c("winner_id"), c("outcome_type")),
        "sig_str_percent": m.share(c("sig_str_landed"), c("sig_str_attempted")),
        "td_percent": m.share(c("td_landed"), c("td_attempted")),
        "distance_pct": m.share(c("distance_landed"), c("sig_str_landed")),
        "clinch_pct": m.share(c("clinch_landed"), c("sig_str_landed")),
        "ground_pct": m.share(c("ground_landed"), c("sig_str_landed")),
        "sig_str_absorbed": c("opp_sig_str_landed"),
        "sig_str_opp_attempted": c("opp_sig_str_attempted"),
        "strike_defense": defense("sig_str"),
        "td_absorbed": c("opp_td_landed"),
        "td_opp_attempted": c("opp_td_attempted"),
        "td_defense": defense("td"),
        "kd_absorbed": c("opp_kd"),
        "ctrl_against_seconds": c("opp_ctrl_seconds"),
        "sig_str_diff": c("sig_str_landed") - c("opp_sig_str_landed"),
        "td_diff": c("td_landed") - c("opp_td_landed"),
        "ctrl_diff": c("ctrl_seconds") - c("opp_ctrl_seconds"),
        "fight_minutes": F.when(sec > 0, sec / 60.0),
        "sig_str_landed_pm": m.per_minute(c("sig_str_landed"), sec),
        "sig_str_absorbed_pm": m.per_minute(c("opp_sig_str_landed"), sec),
        "sig_str_attempted_pm": m.per_minute(c("sig_str_attempted"), sec),
        "td_landed_pm": m.per_minute(c("td_landed"), sec),
        "td_attempted_pm": m.per_minute(c("td_attempted"), sec),
        "kd_pm": m.per_minute(c("kd"), sec),
        "sub_att_pm": m.per_minute(c("sub_att"), sec),
        "ctrl_seconds_pm": m.per_minute(c("ctrl_seconds"), sec),
        "pace": m.per_minute(volume, sec),
    }
    return rows.withColumns(derived)


def corner_facts(eligible, facts, totals, rounds) -> DataFrame:
    rows = with_opponent_and_rates(corner_rows(eligible, facts, totals, rounds))
    return cardio.with_cardio(rows).select(*CORNER_FACT_COLS, *BOUT_CONTEXT_COLS)


def round_facts(eligible: DataFrame, rounds: DataFrame) -> DataFrame:
    """Two rows per recorded round, strike breakdown read from the stored JSON.

    In three projections, so that a corner's JSON is taken out of the round's once and each cell out of that once: a
    column that is used twice is not worked out again, one that is not read not at all.
    """
    both = rounds.join(eligible.select("fight_id", "fighter1_id", "fighter2_id"), "fight_id")
    both = both.withColumn("__text", parse.text_for_cells(F.col("raw_round")))

    def side(s):
        cols = {"fighter_id": F.col(f"fighter{s}_id"), "is_fighter1": F.lit(s == 1)}
        cols |= {c: F.col(f"fighter{s}_{c}") for c in [*PAIR_CELLS, *COUNT_CELLS, "ctrl"]}
        return cols | {"__strikes": F.when(~F.col("__text"), parse.strikes_of(F.col("raw_round"), s))}

    rows = _both_sides(both, ["fight_id", "round_number", "raw_round", "__text"], {s: side(s) for s in SIDES})
    for part in STRIKE_PARTS:
        first, second = (parse.strike_cell(F.col("raw_round"), s, part) for s in SIDES)
        whole = F.when(F.col("is_fighter1"), first).otherwise(second)
        cell = F.when(F.col("__text"), whole).otherwise(F.get_json_object("__strikes", f"$.{part}"))
        rows = rows.withColumn(part, cell)
    cols = {}
    for c in [*PAIR_CELLS, *STRIKE_PARTS]:
        cols |= {f"{c}_landed": parse.landed(F.col(c)), f"{c}_attempted": parse.attempted(F.col(c))}
    cols |= {c: parse.count(F.col(c)) for c in COUNT_CELLS} | {"ctrl_seconds": parse.clock_seconds(F.col("ctrl"))}
    return rows.select("fight_id", "fighter_id", "round_number", "is_fighter1", *[cols[c].alias(c) for c in ROUND_STATS])
