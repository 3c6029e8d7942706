"""Data-quality checks over the bout tables, each a small DataFrame.

``checks`` maps a name to a function of the tables. Checks named in ``MUST_BE_ZERO``
or ``MUST_BE_EMPTY`` report a defect when they find anything.
"""

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.functions import parse
from ringside.session import cut

Tables = Mapping[str, DataFrame]

# Limits of the checks.
MAX_ROUNDS = 5
FIRST_EVENT = "1993-11-01"
FUTURE_DAYS = 30
HEIGHT_RANGE, REACH_RANGE = (48, 90), (48, 100)
#: How many findings a report shows; counts of findings are taken before this.
SHOWN = {
    "round_count_gaps": 30, "feature_rows_per_fight": 30, "odd_percent_text": 20, "landed_above_attempted": 20,
    "events_in_future": 20, "events_too_early": 20,
}
PERCENT_TEXT = r"^\d{1,3}%$"
PAIR_TEXT = r"^\d+ of \d+$"
NC_METHODS = ["Overturned", "Could Not Continue"]

RAW_TABLES = [
    "events", "fighters", "fights", "fight_metadata", "fight_totals", "round_stats",
    "judge_scores", "fighter_bio", "fighter_performance_stats", "fighter_fight_features",
]
FACT_TABLES = ["fight_facts", "fighter_fight_facts", "fighter_round_facts"]


def row_counts(tables: Tables, names: list[str]) -> DataFrame:
    rows = [
        tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, rows)


def how_many(df: DataFrame, cond: Column | str, name: str) -> DataFrame:
    return df.filter(cond).agg(F.count(F.lit(1)).alias(name))


def coverage(df: DataFrame, cols: dict[str, str], total: str = "total") -> DataFrame:
    """How many rows there are and how many have each column, in one pass."""
    return df.agg(F.count(F.lit(1)).alias(total), *[F.count(c).alias(n) for n, c in cols.items()])


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Rows whose key has no parent; a NULL key is no reference."""
    keys = parent.select(F.col(parent_key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti").agg(F.count(F.lit(1)).alias(name))


def distribution(df: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _missing_event(t):
    keys = t["events"].select("event_id")
    return t["fights"].join(keys, "event_id", "left_anti").agg(F.count(F.lit(1)).alias("fights_missing_event"))


def _shared_names(t):
    return distribution(t["fighters"], ["fighter_name"]).filter("row_count > 1").orderBy(F.desc("row_count"))


def _rounds_past_official(t):
    top = t["round_stats"].groupBy("fight_id").agg(F.max("round_number").alias("max_recorded_round"))
    official = t["fights"].select("fight_id", F.col("round").alias("official_final_round"))
    return top.join(official, "fight_id").filter("max_recorded_round > official_final_round")


def _round_count_gaps(t):
    recorded = distribution(t["round_stats"], ["fight_id"], "recorded_rounds")
    official = t["fights"].select("fight_id", F.col("round").alias("official_final_round"))
    both = official.join(recorded, "fight_id", "left").fillna(0, ["recorded_rounds"])
    gap = F.abs(F.col("recorded_rounds") - F.col("official_final_round"))
    return both.filter(gap != 0).orderBy(gap.desc(), "fight_id")


def _odd_percent_text(t):
    cell = F.col("fighter1_sig_str_percent")
    odd = cell.isNotNull() & ~cell.rlike(PERCENT_TEXT) & ~cell.isin("---", "--")
    return t["fight_totals"].filter(odd).select("fight_id", cell).orderBy("fight_id")


def _landed_above_attempted(t):
    cell = F.col("fighter1_sig_str")
    wrong = cell.rlike(PAIR_TEXT) & (parse.landed(cell) > parse.attempted(cell))
    return t["fight_totals"].filter(wrong).select("fight_id", cell).orderBy("fight_id")


def _events_after(t, today):
    late = F.col("event_date") > F.date_add(F.lit(today).cast("date"), FUTURE_DAYS)
    rows = t["events"].filter(late).select("event_id", "headline", "event_date")
    return rows.orderBy(F.desc("event_date"), "event_id")


def _events_before(t):
    early = F.col("event_date") < F.lit(FIRST_EVENT).cast("date")
    rows = t["events"].filter(early).select("event_id", "headline", "event_date")
    return rows.orderBy("event_date", "event_id")


def _body_out_of_range(t):
    h, r = F.col("height"), F.col("reach")
    return t["fighter_bio"].filter(~h.between(*HEIGHT_RANGE) | ~r.between(*REACH_RANGE)).select("fighter_id", h, r)


def _known_corners(t):
    return t["fights"].filter("fighter1_id is not null and fighter2_id is not null")


def _feature_rows_per_fight(t):
    rows = distribution(t["fighter_fight_features"], ["fight_id"], "feature_row_count")
    both = _known_corners(t).select("fight_id").join(rows, "fight_id", "left").fillna(0, ["feature_row_count"])
    return both.filter("feature_row_count <> 2").orderBy("fight_id")


def _feature_row_total(t):
    """Two one-row aggregates side by side, as a union that is summed up."""
    want = _known_corners(t).agg((2 * F.count(F.lit(1))).alias("expected_feature_rows"))
    have = t["fighter_fight_features"].agg(F.count(F.lit(1)).alias("actual_feature_rows"))
    both = want.unionByName(have, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("expected_feature_rows", "actual_feature_rows")])


def _fights_without_facts(t):
    dated = t["events"].filter("event_date is not null").select("event_id")
    eligible = _known_corners(t).join(dated, "event_id", "left_semi")
    missing = eligible.join(t["fight_facts"].select("fight_id"), "fight_id", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("fights_missing_fight_facts"))


def _not_two_corners(t):
    odd = distribution(t["fighter_fight_facts"], ["fight_id"], "n").filter("n <> 2")
    return odd.agg(F.count(F.lit(1)).alias("fights_without_exactly_2_corner_facts"))


def _absorbed_mismatch(t):
    a = t["fighter_fight_facts"].select("fight_id", "opponent_id", "sig_str_absorbed")
    b = t["fighter_fight_facts"].select(
        "fight_id", F.col("fighter_id").alias("opponent_id"), F.col("sig_str_landed").alias("landed")
    )
    both = a.join(b, ["fight_id", "opponent_id"])
    return how_many(both, ~F.col("sig_str_absorbed").eqNullSafe(F.col("landed")), "absorbed_mismatch")


def _debuts(t):
    last5 = F.col("last5_sig_str_landed_pm_avg").isNotNull()
    return t["fighter_fight_features"].agg(
        F.count_if("debut_flag").alias("debuts"),
        F.count_if(F.col("debut_flag") & last5).alias("debuts_with_last5_rate"),
        F.count_if(~F.col("debut_flag") & (F.col("last5_fights_count") == 0)).alias("nondebut_empty_last5"),
    )


VALID_MISMATCH = (
    "(method_group in ('NC','DQ') and is_valid_for_stats) "
    "or (method_group not in ('NC','DQ') and not is_valid_for_stats)"
)
WINNER_ELSEWHERE = (
    "winner_id is not null and not (winner_id <=> fighter1_id) and not (winner_id <=> fighter2_id)"
)


def checks(today: str) -> dict[str, Callable[[Tables], DataFrame]]:
    """All checks as a report shows them: lists of findings in order, the long ones cut to what SHOWN says."""

    def shown(find, rows):
        return lambda t: find(t).limit(rows)

    return {name: shown(f, SHOWN[name]) if name in SHOWN else f for name, f in findings(today).items()}


def findings(today: str) -> dict[str, Callable[[Tables], DataFrame]]:
    """All checks with all they find; ``today`` is given so that a rerun of an old audit says the same."""
    return {
        "row_counts": lambda t: row_counts(t, RAW_TABLES),
        "self_fights": lambda t: how_many(t["fights"], "fighter1_id = fighter2_id", "self_fight_count"),
        "distinct_urls": lambda t: t["fighters"].agg(
            F.count(F.lit(1)).alias("total_fighters"), F.countDistinct("fighter_url").alias("distinct_urls")
        ),
        "shared_names": _shared_names,
        "missing_event": _missing_event,
        "missing_fighter1": lambda t: orphans(
            t["fights"], "fighter1_id", t["fighters"], "fighter_id", "fights_missing_fighter1"
        ),
        "missing_fighter2": lambda t: orphans(
            t["fights"], "fighter2_id", t["fighters"], "fighter_id", "fights_missing_fighter2"
        ),
        "missing_totals": lambda t: orphans(
            t["fights"], "fight_id", t["fight_totals"], "fight_id", "fights_missing_totals"
        ),
        "missing_metadata": lambda t: orphans(
            t["fights"], "fight_id", t["fight_metadata"], "fight_id", "fights_missing_metadata"
        ),
        "missing_rounds": lambda t: orphans(
            t["fights"], "fight_id", t["round_stats"], "fight_id", "fights_missing_round_stats"
        ),
        "too_many_rounds": lambda t: distribution(t["round_stats"], ["fight_id"], "round_row_count").filter(
            F.col("round_row_count") > MAX_ROUNDS
        ),
        "round_number_range": lambda t: t["round_stats"]
        .filter(~F.col("round_number").between(1, MAX_ROUNDS))
        .select("fight_id", "round_number"),
        "rounds_past_official": _rounds_past_official,
        "round_count_gaps": _round_count_gaps,
        "totals_coverage": lambda t: coverage(
            t["fight_totals"],
            {"has_sig_str": "fighter1_sig_str", "has_sig_str_pct": "fighter1_sig_str_percent"}
            | {f"has_{p}": f"fighter1_{p}" for p in ("head", "body", "leg", "distance", "clinch", "ground")},
        ),
        "rounds_coverage": lambda t: coverage(
            t["round_stats"],
            {f"has_{c}": f"fighter1_{c}" for c in ("kd", "sig_str", "td", "sub_att", "ctrl")}
            | {"has_raw_round": "raw_round"},
        ),
        "metadata_coverage": lambda t: coverage(
            t["fight_metadata"], {"has_title": "page_title", "has_canonical": "canonical_url"}
        ),
        "fights_coverage": lambda t: coverage(
            t["fights"], {f"has_{c}": c for c in ("referee", "method", "weight_class", "finish_details")}
        ),
        "judges_coverage": lambda t: coverage(t["judge_scores"], {"has_name": "judge_name", "has_score": "score"}),
        "events_coverage": lambda t: coverage(
            t["events"], {"has_location": "event_location", "has_headline": "headline"}
        ),
        "bio_coverage": lambda t: coverage(
            t["fighter_bio"], {"has_height": "height", "has_reach": "reach", "has_style": "fighting_style"}
        ),
        "snapshot_coverage": lambda t: coverage(
            t["fighter_performance_stats"], {"has_sig": "sig_strikes_landed", "has_td_def": "takedown_defense"}
        ),
        "features_coverage": lambda t: coverage(
            t["fighter_fight_features"],
            {
                "has_momentum_sig_str": "momentum_sig_str_landed_avg",
                "has_career_sig_str": "career_sig_str_landed_avg",
                "has_momentum_td": "momentum_td_landed_avg",
            },
        ),
        "odd_percent_text": _odd_percent_text,
        "landed_above_attempted": _landed_above_attempted,
        "events_in_future": lambda t: _events_after(t, today),
        "events_too_early": _events_before,
        "body_out_of_range": _body_out_of_range,
        "feature_rows_per_fight": _feature_rows_per_fight,
        "feature_row_total": _feature_row_total,
        "percent_average_range": lambda t: t["fighter_fight_features"]
        .filter(~F.col("momentum_sig_str_percent_avg").between(0, 100))
        .select("fighter_id", "fight_id", "momentum_sig_str_percent_avg"),
        "negative_momentum": lambda t: t["fighter_fight_features"]
        .filter("momentum_sig_str_landed_avg < 0")
        .select("fighter_id", "fight_id", "momentum_sig_str_landed_avg"),
        "outcomes": lambda t: distribution(t["fights"], ["outcome_type"], "fight_count").orderBy(F.desc("fight_count")),
        "winner_not_in_bout": lambda t: how_many(t["fights"], WINNER_ELSEWHERE, "winner_not_in_bout"),
        "decisive_without_winner": lambda t: how_many(
            t["fights"], "outcome_type = 'decisive' and winner_id is null", "decisive_missing_winner"
        ),
        "fact_counts": lambda t: row_counts(t, FACT_TABLES),
        "method_groups": lambda t: distribution(t["fight_facts"], ["method_group"]).orderBy(F.desc("row_count")),
        "fights_without_facts": _fights_without_facts,
        "not_two_corners": _not_two_corners,
        "valid_flag_mismatch": lambda t: how_many(t["fight_facts"], VALID_MISMATCH, "invalid_flag_mismatch"),
        "nc_not_grouped": lambda t: how_many(
            t["fight_facts"],
            F.col("method_raw").isin(NC_METHODS) & ~F.col("method_group").eqNullSafe(F.lit("NC")),
            "nc_method_not_grouped",
        ),
        "model_row_count": lambda t: how_many(t["fight_model_rows"], F.lit(True), "model_rows"),
        "model_rows_without_label": lambda t: how_many(
            t["fight_model_rows"], "y_method_group is null", "model_rows_missing_label"
        ),
        "outcome_labels": lambda t: distribution(t["fight_model_rows"], ["y_outcome_type", "y_fighter1_win"]),
        "rates_coverage": lambda t: coverage(
            t["fighter_fight_facts"],
            {
                "has_absorbed": "sig_str_absorbed", "has_str_def": "strike_defense", "has_td_def": "td_defense",
                "has_slpm": "sig_str_landed_pm", "has_pace": "pace",
            },
            "n",
        ),
        "absorbed_mismatch": _absorbed_mismatch,
        "negative_pace": lambda t: how_many(
            t["fighter_fight_facts"], "pace < 0 or sig_str_landed_pm < 0", "negative_pace"
        ),
        "defense_range": lambda t: how_many(
            t["fighter_fight_facts"],
            "strike_defense < 0 or strike_defense > 100 or td_defense < 0 or td_defense > 100",
            "defense_out_of_range",
        ),
        "debuts": _debuts,
        "orientation_labels": lambda t: distribution(t["fight_model_train"], ["orientation", "y_a_win"]),
        "train_rows": lambda t: how_many(t["fight_model_train"], F.lit(True), "train_rows"),
        "train_wins": lambda t: how_many(t["fight_model_train"], "y_a_win = 1", "train_wins"),
    }


MUST_BE_ZERO = [
    "self_fights", "missing_event", "missing_fighter1", "missing_fighter2", "winner_not_in_bout",
    "decisive_without_winner", "fights_without_facts", "not_two_corners", "valid_flag_mismatch",
    "nc_not_grouped", "model_rows_without_label", "absorbed_mismatch", "negative_pace", "defense_range",
]
MUST_BE_EMPTY = [
    "too_many_rounds", "round_number_range", "rounds_past_official", "odd_percent_text",
    "landed_above_attempted", "events_in_future", "events_too_early", "body_out_of_range",
    "feature_rows_per_fight", "percent_average_range", "negative_momentum",
]


def _narrow(t: Tables, today: str) -> dict[str, DataFrame]:
    """Of every table the keys and one 0/1 column per check of single rows; each table is read once."""
    c = F.col
    cell, pair = c("fighter1_sig_str_percent"), c("fighter1_sig_str")
    day, h, r = c("event_date"), c("height"), c("reach")
    flags = {
        "fights": {"self_fights": F.expr("fighter1_id = fighter2_id"), "winner_not_in_bout": F.expr(WINNER_ELSEWHERE),
                   "decisive_without_winner": F.expr("outcome_type = 'decisive' and winner_id is null")},
        "fight_facts": {"valid_flag_mismatch": F.expr(VALID_MISMATCH),
                        "nc_not_grouped": c("method_raw").isin(NC_METHODS) & ~c("method_group").eqNullSafe(F.lit("NC"))},
        "fight_model_rows": {"model_rows_without_label": c("y_method_group").isNull()},
        "fighter_fight_facts": {"negative_pace": F.expr("pace < 0 or sig_str_landed_pm < 0"), "defense_range": F.expr(
            "strike_defense < 0 or strike_defense > 100 or td_defense < 0 or td_defense > 100")},
        "round_stats": {"round_number_range": ~c("round_number").between(1, MAX_ROUNDS)},
        "fight_totals": {"odd_percent_text": cell.isNotNull() & ~cell.rlike(PERCENT_TEXT) & ~cell.isin("---", "--"),
                         "landed_above_attempted": pair.rlike(PAIR_TEXT) & (parse.landed(pair) > parse.attempted(pair))},
        "events": {"events_in_future": day > F.date_add(F.lit(today).cast("date"), FUTURE_DAYS),
                   "events_too_early": day < F.lit(FIRST_EVENT).cast("date")},
        "fighter_bio": {"body_out_of_range": ~h.between(*HEIGHT_RANGE) | ~r.between(*REACH_RANGE)},
        "fighter_fight_features": {"percent_average_range": ~c("momentum_sig_str_percent_avg").between(0, 100),
                                   "negative_momentum": c("momentum_sig_str_landed_avg") < 0},
        "fighters": {},
    }
    keys = {
        "fights": ["fight_id", "event_id", "fighter1_id", "fighter2_id", "round"], "fight_facts": ["fight_id"],
        "fighter_fight_facts": ["fight_id", "fighter_id", "opponent_id", "sig_str_absorbed", "sig_str_landed"],
        "round_stats": ["fight_id", "round_number"], "events": ["event_id", "event_date"], "fighters": ["fighter_id"],
        "fighter_fight_features": ["fight_id"],
    }
    out = {}
    for name, marks in flags.items():
        kept = t[name].select(*keys.get(name, []), *[F.coalesce(v, F.lit(False)).cast("int").alias(k) for k, v in marks.items()])
        out[name] = cut(kept, f"audit-{name.replace('_', '-')}") if name in keys else kept
    return out


def _found(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """(check, found) from one aggregate."""
    row = df.agg(*[F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias(k) for k, v in counts.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("found")) for k in counts])))


def _bouts(n: dict[str, DataFrame]) -> DataFrame:
    """One row per bout id that any table mentions: how often each does, and whether what the bout refers to is there."""
    dated = n["events"].select("event_id", F.col("event_date").isNotNull().cast("int").alias("dated"))
    fights = n["fights"].join(dated, "event_id", "left")
    for s in (1, 2):
        there = n["fighters"].select(F.col("fighter_id").alias(f"fighter{s}_id"), F.lit(1).alias(f"person{s}"))
        fights = fights.join(there, f"fighter{s}_id", "left")
    both = (F.col("fighter1_id").isNotNull() & F.col("fighter2_id").isNotNull()).cast("int")
    missing = [(F.col(f"fighter{s}_id").isNotNull() & F.col(f"person{s}").isNull()).cast("int").alias(f"no_person{s}") for s in (1, 2)]
    parts = [
        fights.select("fight_id", F.lit(1).alias("fights"), F.col("round").alias("official"), both.alias("known"), "dated",
                      F.col("dated").isNull().cast("int").alias("no_event"), *missing),
        n["round_stats"].select("fight_id", F.lit(1).alias("rounds"), F.col("round_number").alias("top")),
        n["fighter_fight_features"].select("fight_id", F.lit(1).alias("features")),
        n["fight_facts"].select("fight_id", F.lit(1).alias("facts")),
        n["fighter_fight_facts"].select("fight_id", F.lit(1).alias("corners")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    sums = ["fights", "known", "no_event", "no_person1", "no_person2", "rounds", "features", "facts", "corners"]
    return rows.groupBy("fight_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
                                        *[F.max(c).alias(c) for c in ("official", "dated", "top")])


def violations(tables: Tables, today: str) -> DataFrame:
    """One row per defect check: its name and how much it found, however much that is.

    Each table is read once, into its keys and a 0/1 column per check. Checks of single rows are one aggregate a table;
    checks across tables are counts over one grouping of all narrow rows by bout.
    """
    n = _narrow(tables, today)
    c = F.col
    checked = set(MUST_BE_ZERO) | set(MUST_BE_EMPTY)
    rows = [_found(df, {k: F.sum(k) for k in df.columns if k in checked}) for df in n.values() if checked & set(df.columns)]
    there = c("fights") > 0
    rows.append(_found(_bouts(n), {
        "missing_event": F.sum("no_event"), "missing_fighter1": F.sum("no_person1"), "missing_fighter2": F.sum("no_person2"),
        "fights_without_facts": F.count_if(there & (c("known") > 0) & (c("dated") == 1) & (c("facts") == 0)),
        "not_two_corners": F.count_if((c("corners") > 0) & (c("corners") != 2)),
        "too_many_rounds": F.count_if(c("rounds") > MAX_ROUNDS),
        "rounds_past_official": F.count_if(there & (c("top") > c("official"))),
        "feature_rows_per_fight": F.count_if((c("known") > 0) & (c("features") != 2)),
    }))
    rows.append(_found(_absorbed_mismatch(n), {"absorbed_mismatch": F.sum("absorbed_mismatch")}))
    return reduce(DataFrame.unionByName, rows)
