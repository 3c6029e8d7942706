"""Pre-bout features of every corner row, from that fighter's earlier rows only.

"Earlier" is row order by (date, bout id); upcoming bouts come last on their day. Bouts that do not count for
statistics stay out of performance and cardio means but count for activity,
record, rounds, titles and schedule strength.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.columns import (
    FEATURE_COLS,
    FEATURE_KEYS,
    STAT_COLS,
    TREND_COLS,
    TRENDS,
    WINDOW_COLS,
    WINDOWS,
    trend_col,
    window_col,
)
from ringside.functions import measures as m
from ringside.operators.timeline import Recent, Timeline, highest, number, total
from ringside.session import cut

# Window lengths in days.
MOMENTUM_DAYS = 540
ACTIVITY_DAYS = 720
STALE_DAYS = 365

ENTITY, ORDER, DAY = ["fighter_id"], ["day_no", "bout_order"], "day_no"

CARDIO_INPUTS = [
    "cardio_r3_r1_att", "cardio_r3_r1_landed", "late_td_landed", "late_kd", "late_ctrl_seconds",
    "cardio_distance_att", "cardio_distance_landed", "cardio_consec_att",
    "cardio_five_stoppage_att", "cardio_observed_att",
]
HISTORY_INPUTS = (
    FEATURE_KEYS
    + ["is_valid_for_stats", "method_group", "final_round", "weight_class_norm", "is_title", "scheduled_rounds"]
    + ["reached_round_3", "completed_round_3", "went_the_distance"]
)
DERIVED_STATS = ["style_entropy", "ctrl_per_td", "ground_per_ctrl_min", "sub_per_td"]


class EmptyHistory(RuntimeError):
    pass


def derived_stats() -> dict[str, Column]:
    c = F.col
    return {
        "style_entropy": m.evenness(c("distance_pct"), c("clinch_pct"), c("ground_pct")),
        "ctrl_per_td": m.ratio(c("ctrl_seconds"), c("td_landed")),
        "ground_per_ctrl_min": m.per_minute(c("ground_landed"), c("ctrl_seconds")),
        "sub_per_td": m.ratio(c("sub_att"), c("td_landed")),
    }


def load_history(corners: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Corner facts in the shape the feature step reads."""
    if corners.isEmpty():
        raise EmptyHistory("there are no corner facts; build them first")
    if facts is not None:
        context = facts.select("fight_id", "weight_class_norm", "is_title", "scheduled_rounds")
        corners = corners.drop("weight_class_norm", "is_title", "scheduled_rounds").join(context, "fight_id")
    flags = ["is_valid_for_stats", "is_title", "reached_round_3", "completed_round_3", "went_the_distance"]
    stats = [s for s in STAT_COLS if s not in DERIVED_STATS]
    rows = corners.filter("event_date is not null").select(*HISTORY_INPUTS, *stats, *CARDIO_INPUTS)
    return rows.withColumns(
        {f: F.coalesce(F.col(f), F.lit(False)) for f in flags}
        | derived_stats()
        | {
            "result": m.known_result(F.col("result")),
            DAY: F.unix_date("event_date"),
            "bout_order": F.col("fight_id").cast("long"),
        }
    )


def _num(cond: Column):
    return number(F.when(cond, 1))


def _avg(name: str) -> Column:
    return m.ratio(F.col(f"s_{name}"), F.col(f"n_{name}"))


def _recent(name: str, n: int, value: str) -> list[Column]:
    return [F.col(f"{name}_{k}.{value}") for k in range(1, n + 1)]


def _recent_count(name: str, n: int) -> Column:
    return sum((F.col(f"{name}_{k}").isNotNull().cast("int") for k in range(2, n + 1)),
               F.col(f"{name}_1").isNotNull().cast("int"))


def _hits(flags: list[Column]) -> Column:
    ints = [F.coalesce(f, F.lit(False)).cast("int") for f in flags]
    return sum(ints[1:], ints[0])


# -- performance windows ----------------------------------------------------


def performance_inputs(stats=STAT_COLS):
    """What the four performance windows need: prior sums, sums before the trailing window, last five."""
    valid = F.col("is_valid_for_stats")
    prior, older = {}, {}
    for s in stats:
        value = F.when(valid, F.col(s))
        prior |= {f"s_{s}": total(value), f"n_{s}": number(value)}
        older |= {f"bs_{s}": total(value), f"bn_{s}": number(value)}
    prior |= {"n_all": number(), "n_valid": _num(valid), "last_day": highest(F.col(DAY))}
    older |= {"bn_all": number(), "bn_valid": _num(valid)}
    recent = {"v": Recent(5, {s: F.col(s) for s in stats}, valid)} if stats else {}
    return prior, recent, {MOMENTUM_DAYS: older, ACTIVITY_DAYS: {"b2_all": number()}}


def stats_behind(wanted) -> list[str]:
    """The statistics whose windows the wanted features are made of."""
    names = set(wanted)
    mixed = ["distance_pct", "clinch_pct", "ground_pct"] if names & set(MIXES) else []
    windows = {s: [window_col(w, s) for w in WINDOWS] + [trend_col(a, b, s) for a, b in TRENDS] for s in STAT_COLS}
    return [s for s, made in windows.items() if s in mixed or names & set(made)]


#: Statistics that can be negative: differences, and defense where more landed than was attempted.
SIGNED = ("_diff", "_defense")


def performance_columns(stats=STAT_COLS) -> dict[str, Column]:
    c = F.col
    in_window = c("n_valid") - c("bn_valid")
    out = {}
    for s in stats:
        career = _avg(s)
        inside = c(f"s_{s}") - F.coalesce(c(f"bs_{s}"), F.lit(0.0))
        if not s.endswith(SIGNED):
            # two long sums of the same values may differ in their last digit, which must not show as less than none
            inside = F.when(inside < 0, 0.0).otherwise(inside)
        momentum = m.ratio(inside, c(f"n_{s}") - c(f"bn_{s}"))
        none = c("n_valid") == 0
        out[window_col("career", s)] = career
        out[window_col("momentum", s)] = F.when(in_window == 0, career).otherwise(momentum)
        out[window_col("last3", s)] = F.when(none, career).otherwise(m.mean_of(_recent("v", 3, s)))
        out[window_col("last5", s)] = F.when(none, career).otherwise(m.mean_of(_recent("v", 5, s)))
    return out


def activity_columns() -> dict[str, Column]:
    c = F.col
    gap = c(DAY) - c("last_day")
    none = c("n_valid") == 0
    return {
        "days_since_last_fight": gap,
        "fights_in_last_18mo": (c("n_all") - c("bn_all")).cast("int"),
        "fights_in_last_24mo": (c("n_all") - c("b2_all")).cast("int"),
        "stale_flag": F.coalesce(gap > STALE_DAYS, F.lit(False)),
        "used_career_fallback_momentum": c("n_valid") - c("bn_valid") == 0,
        "used_career_fallback_last3": none,
        "used_career_fallback_last5": none,
        "debut_flag": c("n_all") == 0,
        "career_fights_count": c("n_valid").cast("int"),
        "last3_fights_count": F.least(c("n_valid"), F.lit(3)).cast("int"),
        "last5_fights_count": F.least(c("n_valid"), F.lit(5)).cast("int"),
    }


def trend_columns(stats=STAT_COLS) -> dict[str, Column]:
    return {
        trend_col(a, b, s): F.col(window_col(a, s)) - F.col(window_col(b, s)) for a, b in TRENDS for s in stats
    }


MIXES = ["career_mix_entropy", "last5_mix_entropy"]


def mix_columns() -> dict[str, Column]:
    def mix(w):
        return m.evenness(*[F.col(window_col(w, f"{p}_pct")) for p in ("distance", "clinch", "ground")])

    return dict(zip(MIXES, (mix("career"), mix("last5"))))


# -- record -----------------------------------------------------------------


def record_inputs():
    res, how = F.col("result"), F.col("method_group")
    prior = {
        "career_wins": _num(res == "W"),
        "career_losses": _num(res == "L"),
        "career_draws": _num(res == "D"),
        "career_no_contests": _num(res == "NC"),
        "w_ko": _num((res == "W") & (how == "KO_TKO")),
        "w_sub": _num((res == "W") & (how == "SUB")),
        "w_dec": _num((res == "W") & (how == "DEC")),
        "num_five_round_fights": _num(F.col("scheduled_rounds") == 5),
        "num_title_fights": _num(F.col("is_title")),
        "s_rounds": total(F.col("final_round")),
        "n_rounds": number(F.col("final_round")),
    }
    values = {"result": res, "how": how, "klass": F.col("weight_class_norm")}
    return prior, {"any": Recent(5, values)}


def record_columns() -> dict[str, Column]:
    c = F.col
    results = _recent("any", 5, "result")
    methods = _recent("any", 5, "how")

    def won_by(group):
        return _hits([(r == "W") & (h == group) for r, h in zip(results, methods)])

    ko5, sub5, dec5 = won_by("KO_TKO"), won_by("SUB"), won_by("DEC")
    classified = c("w_ko") + c("w_sub") + c("w_dec")
    return {
        "last_3_wins": _hits([r == "W" for r in results[:3]]),
        "last_3_losses": _hits([r == "L" for r in results[:3]]),
        "last_5_wins": _hits([r == "W" for r in results]),
        "last_5_losses": _hits([r == "L" for r in results]),
        "career_finish_rate": m.ratio(c("w_ko") + c("w_sub"), c("career_wins")),
        "career_decision_rate": m.ratio(c("w_dec"), c("career_wins")),
        "career_ko_rate": m.ratio(c("w_ko"), classified),
        "career_sub_rate": m.ratio(c("w_sub"), classified),
        "career_method_entropy": m.evenness(c("w_ko"), c("w_sub"), c("w_dec")),
        "last5_ko_rate": m.ratio(ko5, ko5 + sub5 + dec5),
        "last5_sub_rate": m.ratio(sub5, ko5 + sub5 + dec5),
        "last5_decision_rate": m.ratio(dec5, ko5 + sub5 + dec5),
        "last5_method_entropy": m.evenness(ko5, sub5, dec5),
        "avg_rounds_fought": m.ratio(c("s_rounds"), c("n_rounds")),
        "career_win_pct": m.ratio(c("career_wins"), c("career_wins") + c("career_losses")),
    }


def streak_inputs():
    """Position of the last row that breaks a run; needs n_all from the first pass."""
    here = F.col("n_all") + 1
    res = F.col("result")
    return {
        "broke_w": highest(F.when(~res.eqNullSafe(F.lit("W")), here)),
        "broke_l": highest(F.when(~res.eqNullSafe(F.lit("L")), here)),
    }


def streak_columns() -> dict[str, Column]:
    def run(broke):
        return (F.col("n_all") - F.coalesce(F.col(broke), F.lit(0))).cast("int")

    return {"win_streak": run("broke_w"), "loss_streak": run("broke_l")}


# -- weight class -----------------------------------------------------------


def class_columns() -> dict[str, Column]:
    """Needs n_in_class (earlier bouts in this class) and the previous bout's class."""
    here, last = F.col("weight_class_norm"), F.col("any_1.klass")
    step = F.signum(m.class_rank(here) - m.class_rank(last)).cast("int")
    return {
        "first_time_in_class": here.isNull() | (F.col("n_in_class") == 0),
        "n_prior_in_class": F.when(here.isNull(), 0).otherwise(F.col("n_in_class")).cast("int"),
        "switched_class": F.coalesce(here != last, F.lit(False)),
        "class_move": step,
    }


def with_class_counts(rows: DataFrame) -> DataFrame:
    """Earlier bouts of the fighter in the same class; fighter and class together are the entity."""
    line = Timeline.of(rows, ENTITY + ["weight_class_norm"], ORDER)
    return line.with_known(prior={"n_in_class": number()}).df


# -- cardio -----------------------------------------------------------------

# subset name -> (condition, columns averaged over it)
def cardio_subsets() -> dict[str, tuple[Column, list[str]]]:
    valid = F.col("is_valid_for_stats")
    return {
        "r3": (valid & F.col("reached_round_3"), ["late_td_landed", "late_kd", "late_ctrl_seconds"]),
        "c3": (valid & F.col("completed_round_3"), ["cardio_r3_r1_att", "cardio_r3_r1_landed"]),
        "dist": (
            valid & F.col("went_the_distance"),
            ["cardio_distance_att", "cardio_distance_landed", "cardio_consec_att"],
        ),
        "stop": (valid & F.col("cardio_five_stoppage_att").isNotNull(), ["cardio_five_stoppage_att"]),
        "obs": (valid & F.col("cardio_observed_att").isNotNull(), ["cardio_observed_att"]),
    }


def cardio_inputs():
    prior, recent = {}, {}
    for name, (cond, cols) in cardio_subsets().items():
        prior[f"n_{name}"] = _num(cond)
        for col in cols:
            value = F.when(cond, F.col(col))
            prior |= {f"s_{col}": total(value), f"n_{col}": number(value)}
        if name != "stop":
            recent[name] = Recent(5, {col: F.col(col) for col in cols}, cond)
    return prior, recent


def cardio_columns() -> dict[str, Column]:
    def last(subset, n, col):
        return m.mean_of(_recent(subset, n, col))

    n = {k: F.col(f"n_{k}").cast("int") for k in ("r3", "c3", "dist", "stop", "obs")}
    out = {
        "career_n_r3": n["r3"],
        "career_n_r3_complete": n["c3"],
        "career_n_distance": n["dist"],
        "career_n_five_stoppage": n["stop"],
        "career_n_observed": n["obs"],
        "last5_n_r3": F.least(n["r3"], F.lit(5)),
        "last5_n_r3_complete": F.least(n["c3"], F.lit(5)),
        "last3_n_r3_complete": F.least(n["c3"], F.lit(3)),
        "last5_n_distance": F.least(n["dist"], F.lit(5)),
        "last5_n_observed": F.least(n["obs"], F.lit(5)),
        "career_cardio_r3_r1_att_avg": _avg("cardio_r3_r1_att"),
        "career_cardio_r3_r1_landed_avg": _avg("cardio_r3_r1_landed"),
        "career_late_td_avg": _avg("late_td_landed"),
        "career_late_kd_avg": _avg("late_kd"),
        "career_late_ctrl_avg": _avg("late_ctrl_seconds"),
        "career_cardio_distance_att_avg": _avg("cardio_distance_att"),
        "career_cardio_distance_landed_avg": _avg("cardio_distance_landed"),
        "career_cardio_consec_att_avg": _avg("cardio_consec_att"),
        "career_cardio_five_stoppage_att_avg": _avg("cardio_five_stoppage_att"),
        "career_cardio_observed_att_avg": _avg("cardio_observed_att"),
        "last5_cardio_r3_r1_att_avg": last("c3", 5, "cardio_r3_r1_att"),
        "last5_cardio_r3_r1_landed_avg": last("c3", 5, "cardio_r3_r1_landed"),
        "last3_cardio_r3_r1_att_avg": last("c3", 3, "cardio_r3_r1_att"),
        "last5_late_td_avg": last("r3", 5, "late_td_landed"),
        "last5_late_kd_avg": last("r3", 5, "late_kd"),
        "last5_late_ctrl_avg": last("r3", 5, "late_ctrl_seconds"),
        "last5_cardio_distance_att_avg": last("dist", 5, "cardio_distance_att"),
        "last5_cardio_consec_att_avg": last("dist", 5, "cardio_consec_att"),
        "last3_cardio_distance_att_avg": last("dist", 3, "cardio_distance_att"),
        "last5_cardio_observed_att_avg": last("obs", 5, "cardio_observed_att"),
    }
    for stat in ("cardio_r3_r1_att", "cardio_distance_att", "cardio_observed_att"):
        out[f"trend_last5_vs_career_{stat}"] = out[f"last5_{stat}_avg"] - out[f"career_{stat}_avg"]
    return out


# -- opponents --------------------------------------------------------------

ASOF = {
    "career_win_pct": "opp_asof_win_pct",
    "last5_win_pct": "opp_asof_last5_win_pct",
    "career_finish_rate": "opp_asof_finish_rate",
    "career_ko_rate": "opp_asof_ko_rate",
    "n_decided": "opp_asof_n_decided",
    "n_fights": "opp_asof_n_fights",
    "debut_flag": "opp_asof_debut",
}


def opponent_asof(rows: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """The opponent's own pre-bout record in the same bout; a narrow join on (bout, corner).

    records: where the opponents' records are, if rows hold only some fighters.
    """
    c = F.col
    decided = c("career_wins") + c("career_losses")
    theirs = (rows if records is None else records).select(
        "fight_id",
        c("fighter_id").alias("opponent_id"),
        *[c(x).alias(ASOF[x]) for x in ASOF if not x.startswith("n_")],
        decided.cast("int").alias("opp_asof_n_decided"),
        (decided + c("career_draws") + c("career_no_contests")).cast("int").alias("opp_asof_n_fights"),
    )
    keys = ["fight_id", "opponent_id"]
    out = rows.select("fighter_id", *ORDER, *keys, *[x for x in CARRIED if x in rows.columns]).join(theirs, keys, "left")
    return out.withColumns(
        {
            "opp_asof_n_decided": F.coalesce("opp_asof_n_decided", F.lit(0)),
            "opp_asof_n_fights": F.coalesce("opp_asof_n_fights", F.lit(0)),
            "opp_asof_debut": F.coalesce("opp_asof_debut", F.lit(False)),
        }
    )


#: Worked out on the narrow rows of the record and carried along with the schedule.
CARRIED = ["n_in_class"]
SCHEDULE = {
    "avg_opp_win_pct": "opp_asof_win_pct",
    "avg_opp_last5_win_pct": "opp_asof_last5_win_pct",
    "avg_opp_finish_rate": "opp_asof_finish_rate",
    "avg_opp_n_fights": "opp_asof_n_fights",
}


def schedule_strength(asof: DataFrame, sized_from: DataFrame | None = None) -> DataFrame:
    """Average pre-bout quality of the opponents met so far."""
    prior = {}
    for col in SCHEDULE.values():
        prior |= {f"s_{col}": total(F.col(col)), f"n_{col}": number(F.col(col))}
    recent = {"met": Recent(5, {col: F.col(col) for col in SCHEDULE.values()})}
    line = Timeline.of(asof, ENTITY, ORDER, sized_from=sized_from).with_known(prior=prior, recent=recent)
    out = {f"career_{name}": _avg(col) for name, col in SCHEDULE.items()}
    for name in ("avg_opp_win_pct", "avg_opp_last5_win_pct", "avg_opp_finish_rate"):
        out[f"last5_{name}"] = m.mean_of(_recent("met", 5, SCHEDULE[name]))
    out["last3_avg_opp_win_pct"] = m.mean_of(_recent("met", 3, "opp_asof_win_pct"))
    out["career_n_opp_known"] = F.col("n_opp_asof_win_pct").cast("int")
    out["last5_n_opp_known"] = _hits([x.isNotNull() for x in _recent("met", 5, "opp_asof_win_pct")])
    kept = ["fighter_id", "fight_id", *ASOF.values(), *[x for x in CARRIED if x in asof.columns]]
    return line.df.select(*kept, *[v.alias(k) for k, v in out.items()])


# -- everything -------------------------------------------------------------


def own_features(rows: DataFrame, kept: tuple[str, ...] = (), sized_from: DataFrame | None = None, wanted=FEATURE_COLS) -> DataFrame:
    """The features that need only the fighter's own earlier rows, and the columns to keep.

    n_in_class is worked out unless the rows have it. sized_from: a cheaper table with as many rows per fighter.
    Statistics and cardio of which no feature is wanted are left out of the plan, which has some 800 windows with all.
    """
    stats, cardio = stats_behind(wanted), cardio_columns()
    cardio = cardio if set(wanted) & set(cardio) else {}
    p1, r1, before = performance_inputs(stats)
    p2, r2 = record_inputs()
    p3, r3 = cardio_inputs() if cardio else ({}, {})
    counted = rows if "n_in_class" in rows.columns else with_class_counts(rows)
    line = Timeline.of(counted, ENTITY, ORDER, DAY, sized_from=rows if sized_from is None else sized_from)
    line = line.with_known(prior=p1 | p2 | p3, recent=r1 | r2 | r3, before=before)
    line = line.with_known(prior=streak_inputs())
    ints = ["career_wins", "career_losses", "career_draws", "career_no_contests",
            "num_five_round_fights", "num_title_fights"]
    first = (
        performance_columns(stats) | activity_columns() | record_columns() | streak_columns()
        | class_columns() | cardio
    )
    flat = line.df.select(
        *FEATURE_KEYS, *ORDER, *kept, *[F.col(c).cast("int").alias(c) for c in ints], *[v.alias(k) for k, v in first.items()]
    )
    mixes = mix_columns() if set(wanted) & set(MIXES) else {}
    second = trend_columns(stats) | mixes | {
        "last5_win_pct": m.ratio(F.col("last_5_wins"), F.col("last_5_wins") + F.col("last_5_losses"))
    }
    return flat.withColumns(second)


def own_record(rows: DataFrame) -> DataFrame:
    """The few columns that opponents are judged by, and n_in_class, from narrow rows."""
    prior, recent = record_inputs()
    narrow = cut(rows.select(
        *FEATURE_KEYS, *ORDER, "method_group", "final_round", "weight_class_norm", "is_title", "scheduled_rounds"
    ), "record-inputs")
    line = Timeline.of(with_class_counts(narrow), ENTITY, ORDER, sized_from=narrow)
    line = line.with_known(prior=prior | {"n_all": number()}, recent=recent)
    cols = record_columns()
    wins, losses = cols["last_5_wins"], cols["last_5_losses"]
    shown = {c: cols[c] for c in ("career_win_pct", "career_finish_rate", "career_ko_rate")}
    shown |= {"last5_win_pct": m.ratio(wins, wins + losses), "debut_flag": F.col("n_all") == 0}
    counts = ["career_wins", "career_losses", "career_draws", "career_no_contests"]
    return line.df.select(*FEATURE_KEYS, *ORDER, *CARRIED, *counts, *[v.alias(k) for k, v in shown.items()])


def with_schedule(rows: DataFrame, schedule: DataFrame, sized_from: DataFrame | None = None, wanted=FEATURE_COLS) -> DataFrame:
    """The wanted features of rows; schedule: (fighter_id, fight_id) with what comes from narrow rows.

    The schedule joins the inputs of the windows, not their much wider results, which no exchange moves.
    """
    kept = tuple(c for c in schedule.columns if c not in ("fighter_id", "fight_id", *CARRIED))
    made = own_features(rows.join(schedule, ["fighter_id", "fight_id"], "left"), kept, sized_from, wanted)
    return made.select(*FEATURE_KEYS, *[c for c in FEATURE_COLS if c in set(wanted)])


def stored_schedule(rows: DataFrame) -> DataFrame:
    """What comes from narrow rows, written once: counts within a class, the opponents' records and the schedule's strength.

    The opponent step joins records with themselves, the schedule step windows over that join.
    """
    record = cut(own_record(rows), "own-record")
    return cut(schedule_strength(opponent_asof(record), sized_from=record), "schedule")


def build_features(rows: DataFrame) -> DataFrame:
    """One row per (fighter, bout) with every pre-bout feature.

    The input rows are shuffled to meet the stored schedule, then once for all windows.
    """
    schedule = stored_schedule(rows)
    return with_schedule(rows, schedule, sized_from=schedule)


assert set(WINDOW_COLS) | set(TREND_COLS) <= set(FEATURE_COLS) and len(WINDOWS) == 4
