"""Every registered query: a Spark callable and, where SQL can say it, the checking SQL."""

import re
import uuid
from datetime import date

from pyspark.sql import functions as F

import oracle as o
from ringside.columns import DIFF_COLS, EXPECTED_RATES, FEATURE_COLS, LABEL_COLS, STAT_COLS, TREND_COLS, window_col
from ringside.functions import parse, scores
from ringside.functions.scores import Eras
from ringside.operators import audit, card, corners, history, ledger, model_rows, pages, views
from ringside.operators.upsert import upsert
from ringside.plans import learn, refresh
from ringside.plans.build import BY, Store
from ringside.session import cut, shared_dir
from ringside.sources import payload
from ringside.sources.binding import BOUT_DOC, CARD, CARD_DATE, PICK, SHARED_NAMES, bench, documents, exprs

QUERIES = {}
ORACLES = {}


def register(name, run, sql=None):
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def rounded(df, keep=()):
    """Doubles to six decimals, so that the order of a sum does not show.

    The checking SQL adds the same nudge, which keeps exact halves from going either way.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append((F.round(c + 3.1e-8, 6) + 0.0).alias(f.name) if f.dataType.simpleString() == "double" and f.name not in keep else c)
    return df.select(*out)


KEYS = ["fighter_id", "fight_id"]


def feature_query(name, cols, exact=()):
    shown = ", ".join(c if c in exact else f"{o.r6(c)} as {c}" for c in cols)
    register(
        name,
        lambda spark, d: rounded(bench(spark, d).features_with(cols).select(*KEYS, *cols)),
        o.with_(f"select fighter_id, fight_id, {shown} from features", "features"),
    )


# -- facts ------------------------------------------------------------------

register(
    "fight_facts",
    lambda spark, d: rounded(corners.fight_facts(bench(spark, d).eligible)),
    o.with_(f"select {', '.join(o.r6(c) + ' as ' + c if c == 'fight_seconds' else c for c in corners.FIGHT_FACT_COLS)} "
            "from fight_facts", "fight_facts"),
)
register(
    "corner_facts",
    lambda spark, d: rounded(
        corners.corner_facts(
            bench(spark, d).eligible, bench(spark, d).fight_facts, bench(spark, d).fight_totals,
            bench(spark, d).round_stats,
        ).select(*corners.CORNER_FACT_COLS)
    ),
    o.with_(f"select {o.CORNER_SHOWN} from corner_facts", "corner_facts"),
)
_round_cols = [c for c in corners.ROUND_STATS]
register(
    "round_facts",
    lambda spark, d: corners.round_facts(bench(spark, d).eligible, bench(spark, d).round_stats),
    o.with_("select r.fight_id, c.fighter_id, r.round_number, c.is_fighter1, "
            + ", ".join(f"r.{c}" for c in _round_cols)
            + " from corner_rounds r join corner_own c on c.fight_id = r.fight_id and c.side = r.side",
            "corner_rounds", "corner_own"),
)
register(
    "round_totals",
    lambda spark, d: corners.round_totals(corners.parsed_rounds(bench(spark, d).round_stats)).select(
        "fight_id", *[F.col(f"s{s}_{c}_sum").alias(f"s{s}_{c}") for s in (1, 2) for c in o._sums]
    ),
    o.with_("select a.fight_id, " + ", ".join(f"{t}.{c} as s{s}_{c}" for s, t in ((1, "a"), (2, "b")) for c in o._sums)
            + " from corner_sums a join corner_sums b using (fight_id) where a.side = 1 and b.side = 2", "corner_sums"),
)

# -- pre-bout features ------------------------------------------------------

for _w in ("career", "momentum", "last3", "last5"):
    feature_query(f"{_w}_means", [window_col(_w, s) for s in STAT_COLS])
feature_query("form_trends", TREND_COLS)
feature_query("activity", list(o.ACTIVITY), exact=o.ACTIVITY)
feature_query("record_and_streaks", list(o.RECORD), exact=[c for c in o.RECORD if c != "avg_rounds_fought"])
feature_query("win_method_rates", list(o.RATES))
feature_query("class_changes", list(o.CLASS), exact=o.CLASS)
feature_query("style_mix", list(o.MIX))
feature_query("cardio_history", [*o.CARDIO, *o.CARDIO_TRENDS], exact=[c for c in o.CARDIO if "_n_" in c])
_asof = [c for c in FEATURE_COLS if c.startswith("opp_asof")]
feature_query("opponent_asof", _asof, exact=["opp_asof_n_fights", "opp_asof_n_decided", "opp_asof_debut"])
feature_query("schedule_strength", list(o.SOS), exact=["career_n_opp_known", "last5_n_opp_known"])


#: The state before a load: bouts from this day on are not known yet, title bouts of the year were still under review.
LOAD_DAY, REVIEW_DAY = "2001-07-01", "2001-01-01"


def _before_load(rows):
    review = F.col("is_title") & (F.col("event_date") >= F.lit(REVIEW_DAY).cast("date"))
    known = rows.filter(F.col("event_date") < F.lit(LOAD_DAY).cast("date"))
    return known.withColumns({"result": F.when(review, "NC").otherwise(F.col("result")),
                              "is_valid_for_stats": F.col("is_valid_for_stats") & ~review})


def _features_after_load(spark, d):
    """Features stored for the state before, brought up to date by change."""
    now = bench(spark, d).stored_corner_facts
    before, after = history.load_history(_before_load(now)), history.load_history(now)
    store = Store(spark, f"{shared_dir(spark).rstrip('/')}/after-load-{uuid.uuid4().hex}")
    store.replace_all({"fighter_fight_features": history.build_features(before)}, BY)
    refresh.refresh_features(store, before, after)
    return store.read("fighter_fight_features")


_after_exact = [*o.ACTIVITY, *[c for c in o.RECORD if c != "avg_rounds_fought"], *o.CLASS, *[c for c in o.CARDIO if "_n_" in c],
                "opp_asof_n_fights", "opp_asof_n_decided", "opp_asof_debut", "career_n_opp_known", "last5_n_opp_known"]
_after_cols = list(dict.fromkeys([
    *o.ACTIVITY, *o.RECORD, *o.RATES, *o.CLASS, *o.MIX, *o.CARDIO, *o.CARDIO_TRENDS, *_asof, *o.SOS,
    *[window_col(w, s) for w in ("career", "momentum", "last3", "last5") for s in STAT_COLS]]))
register(
    "features_after_load",
    lambda spark, d: rounded(_features_after_load(spark, d).select(*KEYS, *_after_cols)),
    o.with_("select fighter_id, fight_id, " + ", ".join(c if c in _after_exact else f"{o.r6(c)} as {c}" for c in _after_cols)
            + " from features", "features"),
)

# -- training rows ----------------------------------------------------------

_products = [p for p, *_ in EXPECTED_RATES] + ["prod_reach_x_opp_distance_pct", "prod_ground_x_td_att_pm"]
TRAIN_SHOWN = (
    ["fight_id", "orientation", "event_date", "a_fighter_id", "b_fighter_id", "weight_class_norm", "is_title",
     "is_women", "scheduled_rounds", "y_a_win", "y_method_group", "y_outcome_type", "y_winner_id", "a_height", "b_reach"]
    + ["diff_height", "diff_reach", "a_ape_index", "b_ape_index", "diff_ape_index"]
    + [f"diff_{c}" for c in DIFF_COLS]
    + [f"y_{s}_{c}" for s in "ab" for c in LABEL_COLS]
    + _products
    + ["a_debut_flag", "b_debut_flag", "a_career_win_pct", "b_career_win_pct", "a_win_streak"]
)
_PLAIN = {
    "fight_id", "orientation", "event_date", "a_fighter_id", "b_fighter_id", "weight_class_norm", "is_title", "is_women",
    "scheduled_rounds", "y_a_win", "y_method_group", "y_outcome_type", "y_winner_id", "a_debut_flag", "b_debut_flag",
    "a_win_streak", "b_reach", "diff_reach", "diff_days_since_last_fight", "diff_career_fights_count",
    "diff_win_streak", "diff_loss_streak", "diff_career_wins", "diff_career_losses", "diff_num_five_round_fights",
    "diff_num_title_fights", "diff_career_n_r3_complete", "diff_career_n_distance", "diff_career_n_observed",
}


def train_sql(cols, where="", name="model_train"):
    shown = ", ".join(c if c in _PLAIN else f"{o.r6(c)} as {c}" for c in cols)
    return o.with_(f"select {shown} from {name} {where}", name)


register(
    "training_rows",
    lambda spark, d: rounded(bench(spark, d).stored_train_with(*TRAIN_SHOWN).select(*TRAIN_SHOWN)),
    train_sql(TRAIN_SHOWN),
)
_body = ["f1_height", "f2_reach", "f1_ape_index", "diff_ape_index"]
register(
    "model_rows",
    lambda spark, d: rounded(
        model_rows.model_rows(
            bench(spark, d).features_with(["career_win_pct"]), bench(spark, d).fight_facts, bench(spark, d).corner_facts,
            bench(spark, d).fighter_bio,
        ).select("fight_id", "y_fighter1_win", "y_f1_result", "y_f2_result", *_body, "f1_career_win_pct",
                 "f2_career_win_pct", "diff_career_win_pct", "y_f1_pace", "y_f2_pace")
    ),
    o.with_(
        "select m.fight_id, m.y_a_win as y_fighter1_win, ca.result as y_f1_result, cb.result as y_f2_result, "
        + ", ".join(f"{o.r6(e)} as {n}" for n, e in (
            ("f1_height", "a_height"), ("f1_ape_index", "a_ape_index"), ("diff_ape_index", "diff_ape_index"),
            ("f1_career_win_pct", "a_career_win_pct"), ("f2_career_win_pct", "b_career_win_pct"),
            ("diff_career_win_pct", "diff_career_win_pct"), ("y_f1_pace", "y_a_pace"), ("y_f2_pace", "y_b_pace")))
        + ", b_reach as f2_reach from model_train m "
        "join corner_facts ca on ca.fight_id = m.fight_id and ca.is_fighter1 "
        "join corner_facts cb on cb.fight_id = m.fight_id and not cb.is_fighter1 where orientation = 'page'",
        "model_train", "corner_facts"),
)
register(
    "matchup_products",
    lambda spark, d: rounded(bench(spark, d).train_with(*_products).select("fight_id", "orientation", *_products)),
    train_sql(["fight_id", "orientation", *_products]),
)

# -- audit ------------------------------------------------------------------

AUDIT_DAY = "2001-06-01"


_AUDITS = {}


def audit_query(name, sql, *needs):
    _AUDITS[name] = (sql, needs)
    run = audit.checks(AUDIT_DAY)[name]
    register(f"audit_{name}", lambda spark, d: rounded(run(bench(spark, d).audit_tables())),
             o.with_(sql, *needs) if needs else sql)


def _counts(pairs):
    return " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {t}" for n, t in pairs)


def _cover(table, cols, total="total"):
    return f"select count(*) as {total}, " + ", ".join(f"count({c}) as {n}" for n, c in cols) + f" from {table}"


def _missing(name, child, key, parent, parent_key="fight_id"):
    return (f"select count(*) as {name} from {child} c left join {parent} p on c.{key} = p.{parent_key} "
            f"where c.{key} is not null and p.{parent_key} is null")


audit_query("row_counts", _counts([
    ("events", "bevents"), ("fighters", "fighters"), ("fights", "fights"), ("fight_metadata", "fight_metadata"),
    ("fight_totals", "fight_totals"), ("round_stats", "round_stats"), ("judge_scores", "judge_scores"),
    ("fighter_bio", "fighter_bio"), ("fighter_performance_stats", "snapshot"), ("fighter_fight_features", "features"),
]), "bevents", "fighters", "fights", "fight_metadata", "fight_totals", "round_stats", "judge_scores", "fighter_bio",
    "snapshot", "features")
audit_query("self_fights", "select count(*) as self_fight_count from fights where fighter1_id = fighter2_id", "fights")
audit_query("distinct_urls", "select count(*) as total_fighters, count(distinct fighter_url) as distinct_urls "
            "from fighters", "fighters")
audit_query("shared_names", "select fighter_name, count(*) as row_count from fighters group by 1 having count(*) > 1",
            "fighters")
audit_query("missing_event", "select count(*) as fights_missing_event from fights where event_id not in "
            "(select event_id from bevents)", "fights", "bevents")
for _n in (1, 2):
    audit_query(f"missing_fighter{_n}", _missing(f"fights_missing_fighter{_n}", "fights", f"fighter{_n}_id", "fighters",
                                                  "fighter_id"), "fights", "fighters")
audit_query("missing_totals", _missing("fights_missing_totals", "fights", "fight_id", "fight_totals"),
            "fights", "fight_totals")
audit_query("missing_metadata", _missing("fights_missing_metadata", "fights", "fight_id", "fight_metadata"),
            "fights", "fight_metadata")
audit_query("missing_rounds", _missing("fights_missing_round_stats", "fights", "fight_id", "round_stats"),
            "fights", "round_stats")
audit_query("too_many_rounds", "select fight_id, count(*) as round_row_count from round_stats group by 1 "
            "having count(*) > 5", "round_stats")
audit_query("round_number_range", "select fight_id, round_number from round_stats where round_number > 5 "
            "or round_number < 1", "round_stats")
audit_query("rounds_past_official", "select r.fight_id, max(round_number) as max_recorded_round, f.round as "
            "official_final_round from round_stats r join fights f using (fight_id) group by r.fight_id, f.round "
            "having max(round_number) > f.round", "round_stats", "fights")
audit_query("round_count_gaps", "select fight_id, official_final_round, recorded_rounds from (select f.fight_id, "
            "f.round as official_final_round, count(r.fight_id) as recorded_rounds from fights f left join round_stats r "
            "using (fight_id) group by f.fight_id, f.round having count(r.fight_id) <> f.round) "
            "order by abs(recorded_rounds - official_final_round) desc, fight_id limit 30", "round_stats", "fights")
audit_query("totals_coverage", _cover("fight_totals", [("has_sig_str", "fighter1_sig_str"), (
    "has_sig_str_pct", "fighter1_sig_str_percent")] + [(f"has_{p}", f"fighter1_{p}") for p in (
        "head", "body", "leg", "distance", "clinch", "ground")]), "fight_totals")
audit_query("rounds_coverage", _cover("round_stats", [(f"has_{c}", f"fighter1_{c}") for c in (
    "kd", "sig_str", "td", "sub_att", "ctrl")] + [("has_raw_round", "raw_round")]), "round_stats")
audit_query("metadata_coverage", _cover("fight_metadata", [("has_title", "page_title"),
                                                            ("has_canonical", "canonical_url")]), "fight_metadata")
audit_query("fights_coverage", _cover("fights", [(f"has_{c}", c) for c in (
    "referee", "method", "weight_class", "finish_details")]), "fights")
audit_query("judges_coverage", _cover("judge_scores", [("has_name", "judge_name"), ("has_score", "score")]),
            "judge_scores")
audit_query("events_coverage", _cover("bevents", [("has_location", "event_location"), ("has_headline", "headline")]),
            "bevents")
audit_query("bio_coverage", _cover("fighter_bio", [("has_height", "height"), ("has_reach", "reach"),
                                                    ("has_style", "fighting_style")]), "fighter_bio")
audit_query("snapshot_coverage", _cover("snapshot", [("has_sig", "landed"), ("has_td_def", "defense")]), "snapshot")
audit_query("features_coverage", _cover("features", [
    ("has_momentum_sig_str", "momentum_sig_str_landed_avg"), ("has_career_sig_str", "career_sig_str_landed_avg"),
    ("has_momentum_td", "momentum_td_landed_avg")]), "features")
audit_query("odd_percent_text", "select fight_id, fighter1_sig_str_percent from fight_totals where "
            "fighter1_sig_str_percent is not null and not regexp_matches(fighter1_sig_str_percent, '^[0-9]{1,3}%$') "
            "and fighter1_sig_str_percent not in ('---','--') order by fight_id limit 20", "fight_totals")
audit_query("landed_above_attempted", "select fight_id, fighter1_sig_str from fight_totals where "
            "regexp_matches(fighter1_sig_str, '^[0-9]+ of [0-9]+$') and cast(split_part(fighter1_sig_str, ' of ', 1) as int) "
            "> cast(split_part(fighter1_sig_str, ' of ', 2) as int) order by fight_id limit 20", "fight_totals")
audit_query("events_in_future", f"select event_id, headline, event_date from bevents where event_date > "
            f"date '{AUDIT_DAY}' + interval 30 days order by event_date desc, event_id limit 20", "bevents")
audit_query("events_too_early", "select event_id, headline, event_date from bevents where event_date < "
            "date '1993-11-01' order by event_date, event_id limit 20", "bevents")
audit_query("body_out_of_range", "select fighter_id, height, reach from fighter_bio where (height < 48 or height > 90) "
            "or (reach < 48 or reach > 100)", "fighter_bio")
audit_query("feature_rows_per_fight", "select f.fight_id, count(x.fight_id) as feature_row_count from fights f "
            "left join features x using (fight_id) group by 1 having count(x.fight_id) <> 2 order by 1 limit 30",
            "fights", "features")
audit_query("feature_row_total", "select (select count(*) from fights) * 2 as expected_feature_rows, "
            "(select count(*) from features) as actual_feature_rows", "fights", "features")
audit_query("percent_average_range", f"select fighter_id, fight_id, {o.r6('momentum_sig_str_percent_avg')} as "
            "momentum_sig_str_percent_avg from features where momentum_sig_str_percent_avg < 0 or "
            "momentum_sig_str_percent_avg > 100", "features")
audit_query("negative_momentum", "select fighter_id, fight_id, momentum_sig_str_landed_avg from features where "
            "momentum_sig_str_landed_avg < 0", "features")
audit_query("outcomes", "select outcome_type, count(*) as fight_count from fights group by 1", "fights")
audit_query("winner_not_in_bout", "select count(*) as winner_not_in_bout from fights where winner_id is not null and "
            "winner_id is distinct from fighter1_id and winner_id is distinct from fighter2_id", "fights")
audit_query("decisive_without_winner", "select count(*) as decisive_missing_winner from fights where "
            "outcome_type='decisive' and winner_id is null", "fights")
audit_query("fact_counts", _counts([("fight_facts", "fight_facts"), ("fighter_fight_facts", "corner_facts"), (
    "fighter_round_facts", "(select r.* from corner_rounds r join fight_facts using (fight_id))")]),
    "fight_facts", "corner_facts", "corner_rounds")
audit_query("method_groups", "select method_group, count(*) as row_count from fight_facts group by 1", "fight_facts")
audit_query("fights_without_facts", "select count(*) as fights_missing_fight_facts from fights f join bevents e using "
            "(event_id) left join fight_facts x on x.fight_id = f.fight_id where x.fight_id is null",
            "fights", "bevents", "fight_facts")
audit_query("not_two_corners", "select count(*) as fights_without_exactly_2_corner_facts from (select fight_id from "
            "corner_facts group by 1 having count(*) <> 2)", "corner_facts")
audit_query("valid_flag_mismatch", "select count(*) as invalid_flag_mismatch from fight_facts where (method_group in "
            "('NC','DQ')) = is_valid_for_stats", "fight_facts")
audit_query("nc_not_grouped", "select count(*) as nc_method_not_grouped from fight_facts where method_raw in "
            "('Overturned','Could Not Continue') and method_group is distinct from 'NC'", "fight_facts")
audit_query("model_row_count", "select count(*) as model_rows from model_train where orientation='page'", "model_train")
audit_query("model_rows_without_label", "select count(*) as model_rows_missing_label from model_train where "
            "orientation='page' and y_method_group is null", "model_train")
audit_query("outcome_labels", "select y_outcome_type, y_a_win as y_fighter1_win, count(*) as row_count from model_train "
            "where orientation='page' group by 1, 2", "model_train")
audit_query("rates_coverage", _cover("corner_facts", [
    ("has_absorbed", "sig_str_absorbed"), ("has_str_def", "strike_defense"), ("has_td_def", "td_defense"),
    ("has_slpm", "sig_str_landed_pm"), ("has_pace", "pace")], "n"), "corner_facts")
audit_query("absorbed_mismatch", "select count(*) as absorbed_mismatch from corner_facts a join corner_facts b on "
            "a.fight_id = b.fight_id and a.opponent_id = b.fighter_id where a.sig_str_absorbed is distinct from "
            "b.sig_str_landed", "corner_facts")
audit_query("negative_pace", "select count(*) as negative_pace from corner_facts where pace < 0 or sig_str_landed_pm < 0",
            "corner_facts")
audit_query("defense_range", "select count(*) as defense_out_of_range from corner_facts where strike_defense < 0 or "
            "strike_defense > 100 or td_defense < 0 or td_defense > 100", "corner_facts")
audit_query("debuts", "select count(*) filter (where debut_flag) as debuts, count(*) filter (where debut_flag and "
            "last5_sig_str_landed_pm_avg is not null) as debuts_with_last5_rate, count(*) filter (where not debut_flag "
            "and last5_fights_count = 0) as nondebut_empty_last5 from features", "features")
audit_query("orientation_labels", "select orientation, y_a_win, count(*) as row_count from model_train group by 1, 2",
            "model_train")
audit_query("train_rows", "select count(*) as train_rows from model_train", "model_train")
audit_query("train_wins", "select count(*) as train_wins from model_train where y_a_win = 1", "model_train")



def _violations_sql():
    """All that the defect checks find: the numbers they report, or the rows they list, without the cut of a report."""
    parts = [f"select '{n}' as \"check\", cast(({_AUDITS[n][0]}) as bigint) as found" for n in audit.MUST_BE_ZERO]
    parts += [f"select '{n}' as \"check\", (select count(*) from ({_AUDITS[n][0].rsplit(' limit ', 1)[0]})) as found"
              for n in audit.MUST_BE_EMPTY]
    needs = dict.fromkeys(x for n in [*audit.MUST_BE_ZERO, *audit.MUST_BE_EMPTY] for x in _AUDITS[n][1])
    return " union all ".join(parts), list(needs)


_violations = _violations_sql()
register("audit_violations", lambda spark, d: audit.violations(bench(spark, d).audit_tables(), AUDIT_DAY),
         o.with_(_violations[0], *_violations[1]))

# The bound tables are clean where these checks look; the same checks on damaged copies, the damage phrased for both engines.
_DAMAGE = {
    "fights": ("fights", {"round": "case when fight_id%13=0 then round - 1 else round end"}),
    "fight_totals": ("fight_totals", {
        "fighter1_sig_str_percent": "case when fight_id%17=0 then 'n/a' else fighter1_sig_str_percent end",
        "fighter1_sig_str": "case when fight_id%19=0 then '9 of 2' else fighter1_sig_str end"}),
    "events": ("bevents", {"event_date": "case when event_id%101=0 then date '1990-01-01' else event_date end"}),
    "fighter_bio": ("fighter_bio", {"height": "case when fighter_id%97=0 then height - 50 else height end"}),
    "fighter_fight_features": ("features", {
        "momentum_sig_str_percent_avg": "case when fight_id%23=0 then momentum_sig_str_percent_avg + 100 else momentum_sig_str_percent_avg end",
        "momentum_sig_str_landed_avg": "case when fight_id%29=0 then cast(-1 as double) else momentum_sig_str_landed_avg end"}),
}
for _name, _damage in _DAMAGE.values():
    o.cte(f"bad_{_name}", [_name], f"select * exclude ({', '.join(_damage)}), {o.cols(_damage)} from {_name}")


def _damaged(spark, d):
    good = bench(spark, d).audit_tables()
    bad = {t: good[t].withColumns({c: F.expr(e) for c, e in damage.items()}) for t, (_, damage) in _DAMAGE.items()}
    whole = ("round_stats", "fighters", "fight_facts", "fighter_fight_facts", "fight_model_rows")
    return bad | {t: good[t] for t in whole}


def _damaged_sql(sql, needs):
    bad = {n for n, _ in _DAMAGE.values()}
    for n in bad:
        sql = re.sub(rf"\b{n}\b", f"bad_{n}", sql)
    return o.with_(sql, *[f"bad_{n}" if n in bad else n for n in needs])


def _damaged_query(name):
    run = audit.checks(AUDIT_DAY)[name]
    register(f"audit_damaged_{name}", lambda spark, d: rounded(run(_damaged(spark, d))), _damaged_sql(*_AUDITS[name]))


for _name in ("rounds_past_official", "round_count_gaps", "odd_percent_text", "landed_above_attempted", "events_too_early",
              "body_out_of_range", "percent_average_range", "negative_momentum"):
    _damaged_query(_name)
register("audit_damaged_violations", lambda spark, d: audit.violations(_damaged(spark, d), AUDIT_DAY), _damaged_sql(*_violations))
register(
    "corner_rejects",
    lambda spark, d: corners.corner_rejects(bench(spark, d).eligible),
    o.with_("select fight_id, fighter1_id as fighter_id, 'same competitor twice' as reason from fights "
            "where fighter1_id = fighter2_id", "fights"),
)

# -- ingestion --------------------------------------------------------------

EMPTY_PEOPLE = "fighter_id long, fighter_name string, fighter_url string"


_LOADED = {}


def _two_loads(spark, d):
    """First versions of all documents, then the repeated ones on top; each table loaded once per folder, when it is read."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _LOADED:
        docs = documents(bench(spark, d).raw("orders"))
        nobody = spark.createDataFrame([], EMPTY_PEOPLE)
        first = payload.load_rows(docs.filter("version = 1"), nobody, counted=False)[0].written()

        def again(name):
            if "rows" not in found:
                found["rows"] = payload.load_rows(docs.filter("version = 2"), first["fighters"], counted=False)[0].written()
            return found["rows"][name]

        found = {}
        _LOADED[key] = payload.apply_load(first, payload.Tables({n: lambda n=n: again(n) for n in first}))
    return _LOADED[key]


o.cte("docs", [], f"select o_orderkey, version, {o.cols(BOUT_DOC)}, o_orderkey*10+version as seq from orders, "
      "(values (1),(2)) t(version) where version = 1 or o_orderkey%10=3")
o.cte("good_docs", ["docs"], "select * from docs where o_orderkey%101<>0 and o_orderkey%103<>0")
o.cte("newest", ["good_docs"], "select * from good_docs g where version = (select max(version) from good_docs h where "
      "h.o_orderkey = g.o_orderkey)")
# people without a URL are the ones whose name nobody with a URL bears
o.cte("people", ["good_docs"], "select distinct name1 as fighter_name, url1 as fighter_url from good_docs union "
      "select distinct name2, url2 from good_docs where url2 is not null union select distinct name2, null from "
      "good_docs where url2 is null and name2 not in (select name1 from good_docs union select name2 from good_docs "
      "where url2 is not null)")

register(
    "ingest_fights",
    lambda spark, d: _ingested_fights(_two_loads(spark, d)),
    o.with_("select fight_url, event_url, weight_class, case when version=2 then 'Decision' else 'KO/TKO' end as method, "
            "n_rounds as round, name1, name2, "
            "case o_orderkey%6 when 0 then case when url2 is null then 'unknown' else 'decisive' end "
            "when 1 then case when url2 is null then 'unknown' else 'decisive' end "
            "when 2 then case when url2 is null then 'unknown' else 'draw' end "
            "when 3 then case when url2 is null then 'unknown' else 'no_contest' end else 'unknown' end as outcome_type, "
            "case when url2 is null then null when o_orderkey%6=0 then name1 when o_orderkey%6=1 then name2 end as winner "
            "from newest where url2 is null or url1 <> url2", "newest"),
)


def _ingested_fights(t):
    who = t["fighters"].select("fighter_id", "fighter_name")

    def named(rows, key, name):
        return rows.join(who.withColumnsRenamed({"fighter_id": key, "fighter_name": name}), key, "left")

    rows = t["fights"].join(t["events"].select("event_id", "event_url"), "event_id")
    rows = named(named(named(rows, "fighter1_id", "name1"), "fighter2_id", "name2"), "winner_id", "winner")
    rows = rows.filter("fighter1_id <> fighter2_id")  # the checking SQL does not say how statuses of one URL clash
    return rows.select("fight_url", "event_url", "weight_class", "method", "round", "name1", "name2", "outcome_type", "winner")


def _with_url(t, name):
    return t[name].join(t["fights"].select("fight_id", "fight_url"), "fight_id").drop("fight_id")


register(
    "ingest_rounds",
    lambda spark, d: _with_url(_two_loads(spark, d), "round_stats").select(
        "fight_url", "round_number", "fighter1_kd", "fighter2_sig_str", "fighter1_ctrl"),
    o.with_("select fight_url, r as round_number, cast((o_orderkey+r)%3 as string) as fighter1_kd, "
            "cast((o_orderkey+r)%20 as string) || ' of ' || cast((o_orderkey+r)%20+2 as string) as fighter2_sig_str, "
            "'0:' || lpad(cast((o_orderkey*r)%60 as string), 2, '0') as fighter1_ctrl from newest, "
            "(select unnest(range(1,6)) as r) where r <= case when version=2 then 1 else n_rounds end", "newest"),
)
register(
    "ingest_totals",
    lambda spark, d: _with_url(_two_loads(spark, d), "fight_totals").select(
        "fight_url", "fighter1_sig_str", "fighter2_sig_str", "fighter1_head"),
    o.with_("select fight_url, cast(o_orderkey%40 as string) || ' of 50' as fighter1_sig_str, '---' as fighter2_sig_str, "
            "cast(null as string) as fighter1_head from newest", "newest"),
)
register(
    "ingest_judges",
    lambda spark, d: _with_url(_two_loads(spark, d), "judge_scores"),
    o.with_("select fight_url, 'J' || cast((o_orderkey+j)%20 as string) as judge_name, cast(26+j as string) || ' - 28' "
            "as score from newest, (values (1),(2),(3)) t(j) where (o_orderkey+j)%7<>0", "newest"),
)
register(
    "ingest_metadata",
    lambda spark, d: _with_url(_two_loads(spark, d), "fight_metadata"),
    o.with_("select fight_url, 'Bout' as page_title, 'doc' as source, fight_url as canonical_url, "
            "'{\"url\":\"' || fight_url || '\",\"page_title\":\"Bout\",\"source\":\"doc\"}' as raw_metadata from newest",
            "newest"),
)
register(
    "ingest_events",
    lambda spark, d: _two_loads(spark, d)["events"].drop("event_id"),
    o.with_("select event_url, arg_max(headline, seq) as headline, date '1999-01-02' as event_date, 'Hall' as "
            "event_location from (select * from good_docs where version=2 or event_url not in (select event_url from "
            "good_docs where version=2)) group by 1", "good_docs"),
)
register(
    "ingest_people",
    lambda spark, d: _two_loads(spark, d)["fighters"].drop("fighter_id"),
    o.with_("select * from people", "people"),
)


def _named_loads(spark, d):
    """The same two loads of people who share names, told apart as one insert after the other would."""
    docs = documents(bench(spark, d).raw("orders"), **SHARED_NAMES)
    both = ("fighters", "fights")
    nobody, one_by_one = spark.createDataFrame([], EMPTY_PEOPLE), {"unique_names": False, "counted": False}
    first = payload.load_rows(docs.filter("version = 1"), nobody, **one_by_one)[0].written(both)
    again = payload.load_rows(docs.filter("version = 2"), first["fighters"], **one_by_one)[0].written(both)
    return payload.Tables({n: lambda n=n: upsert(first[n], again[n], payload.KEYS[n]) for n in both})


def _corners_by_name(spark, d):
    t = _named_loads(spark, d)
    rows = t["fights"].select("fight_url", "fighter1_id", "fighter2_id")
    for s in (1, 2):
        who = t["fighters"].toDF(f"fighter{s}_id", f"name{s}", f"url{s}")
        rows = rows.join(who, f"fighter{s}_id", "left")
    return rows.select("fight_url", "name1", "url1", "name2", "url2")


# the first mention of a name puts it on file, with or without a URL; its later bearers are taken for that person
o.cte("mentions", [], "select o_orderkey, version, 1 as side, {name1} as fighter_name, url1 as fighter_url from d union all "
      "select o_orderkey, version, 2, {name2}, url2 from d".format(**SHARED_NAMES).replace(
          "from d", f"from (select *, {o.cols({k: v for k, v in BOUT_DOC.items() if k in ('url1', 'url2')})} from orders, "
          "(values (1),(2)) t(version) where (version = 1 or o_orderkey%10=3) and o_orderkey%101<>0 and o_orderkey%103<>0) d"))
o.cte("people_by_name", ["mentions"], "select fighter_name, arg_min({'u': fighter_url}, version * 1000000000000 + o_orderkey * 10 + "
      "side).u as fighter_url from mentions group by 1")
register(
    "ingest_people_by_name",
    lambda spark, d: _named_loads(spark, d)["fighters"].drop("fighter_id"),
    o.with_("select * from people_by_name", "people_by_name"),
)
register(
    "ingest_corners_by_name",
    _corners_by_name,
    o.with_("select 'http://bouts.test/d/' || cast(a.o_orderkey as string) as fight_url, p.fighter_name as name1, p.fighter_url as "
            "url1, q.fighter_name as name2, q.fighter_url as url2 from mentions a join mentions b on b.o_orderkey = a.o_orderkey and "
            "b.side = 2 and b.version = 1 join people_by_name p on p.fighter_name = a.fighter_name join people_by_name q on "
            "q.fighter_name = b.fighter_name where a.side = 1 and a.version = 1", "mentions", "people_by_name"),
)
register(
    "ingest_counts",
    lambda spark, d: payload.load_rows(
        documents(bench(spark, d).raw("orders")).filter("version = 1"), spark.createDataFrame([], EMPTY_PEOPLE))[2],
    o.with_("""select 'events' as what, count(*) as n from g union all select 'fights', count(*) from g
     union all select 'fighters', 2*count(*) from g
     union all select 'distinct_fighters', count(*) from (select name1, url1 from g union select name2, url2 from g)
     union all select 'round_stats', cast(sum(n_rounds) as bigint) from g
     union all select 'judge_scores', count(*) from g, (values (1),(2),(3)) t(j) where (o_orderkey+j)%7<>0""".replace(
         "from g", "from (select * from good_docs where version=1) g"), "good_docs"),
)
register(
    "ingest_set_aside",
    lambda spark, d: payload.read_documents(documents(bench(spark, d).raw("orders")))[1].select("seq"),
    o.with_("select seq from docs where o_orderkey%101=0 or o_orderkey%103=0", "docs"),
)
_first_number = "try_cast(nullif(regexp_extract(replace({0}, ',', ''), '(-?[0-9]+)', 1), '') as int)"
_first_decimal = "try_cast(nullif(regexp_extract({0}, '(-?[0-9]+([.][0-9]+)?)', 1), '') as double)"
register(
    "snapshot_stats",
    lambda spark, d: bench(spark, d).performance_stats.select(
        "fighter_id", "sig_strikes_landed", "sig_strikes_attempted", "sig_strikes_landed_per_min", "takedown_defense",
        "average_fight_time", "ko_percent", "ko_count", "takedowns_landed"),
    o.with_(f"select fighter_id, {_first_number.format('landed')} as sig_strikes_landed, "
            f"{_first_number.format('attempted')} as sig_strikes_attempted, "
            f"{_first_decimal.format('per_min')} as sig_strikes_landed_per_min, "
            f"{_first_decimal.format('defense')} as takedown_defense, "
            "case len(string_split(avg_time, ':')) when 2 then cast(split_part(avg_time,':',1) as double)*60+"
            "cast(split_part(avg_time,':',2) as double) when 3 then 3600+120+cast(split_part(avg_time,':',3) as double) "
            f"else {_first_decimal.format('avg_time')} end as average_fight_time, "
            f"{_first_decimal.format('defense')} as ko_percent, {_first_number.format('landed')} as ko_count, "
            "cast(null as int) as takedowns_landed from snapshot", "snapshot"),
)
register(
    "event_props",
    lambda spark, d: bench(spark, d).raw("events").select(
        "event_id", parse.json_or_null(F.col("props"), "k int")["k"].alias("k")),
    "select event_id, cast(json_extract(props, '$.k') as int) as k from events",
)

# -- ledger -----------------------------------------------------------------

NOW = "2002-01-01 00:00:00"
LEDGER_SHOWN = ["event_url", "event_date", "fighter_a_name", "fighter_b_name", "fighter_a_id", "pick", "is_tossup",
                "is_high_conf_66", "p_a", "fight_id", "outcome_type", "winner_side", "pick_correct"]


def _ledger(spark, d):
    b = bench(spark, d)
    empty = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    done = ledger.completed_fights(b.fights, b.events, b.fighters)
    return ledger.run_cycle(empty, b.predictions, done, F.lit(NOW).cast("timestamp"))


_pick_cols = ("case when fight_id%5<2 or {s}_id=0 then null else {s}_id end as {s}id, case when fight_id%5=0 then null else "
              "w{s}.fighter_url end as {s}url, w{s}.fighter_name as {s}name")
o.cte("picks", ["fights", "fighters"], f"select fight_id as src, replace(rtrim(event_url, '/'), 'https://', 'http://') as "
      f"event_url, event_date, p_a, {_pick_cols.format(s='a')}, {_pick_cols.format(s='b')} from "
      f"(select fight_id, {o.cols(PICK, days=o.DAYS)} from fights where fighter1_id <> fighter2_id) "
      "join fighters wa on wa.fighter_id = a_id join fighters wb on wb.fighter_id = b_id")
o.cte("keyed", ["picks"], "select *, coalesce(event_url,'') || '|' || coalesce(cast(event_date as string), '0001-01-01') "
      "|| '|' || least(coalesce(aurl, aname), coalesce(burl, bname)) || '|' || "
      "greatest(coalesce(aurl, aname), coalesce(burl, bname)) as k from picks")
# one pick per pairing: the largest p_a of a load
o.cte("logged", ["keyed"], "select * from (select *, row_number() over (partition by k order by p_a desc) as r, "
      "round(p_a*100, 1) as pct from keyed) where r = 1")
o.cte("named_fights", ["fights", "fighters", "bevents"], "select f.*, e.event_url, e.event_date as event_day, w1.fighter_url as u1, w2.fighter_url as u2, "
      "w1.fighter_name as n1, w2.fighter_name as n2 from (select * exclude (event_date) from fights) f join bevents e using (event_id) "
      "left join fighters w1 on w1.fighter_id = fighter1_id left join fighters w2 on w2.fighter_id = fighter2_id")


def _is(s, n):
    return (f"(coalesce(l.{s}id = f.fighter{n}_id, false) or coalesce(l.{s}url = f.u{n}, false) or l.{s}name = f.n{n})")


def _matches_sql(logged, where="true"):
    return (f"select l.k, min(f.fight_id) as fight_id from (select l.*, e.event_id from {logged} l "
            f"join bevents e on e.event_date = l.event_date union select l.*, e.event_id from {logged} l join bevents e on "
            f"e.event_url = l.event_url) l join named_fights f on f.event_id = l.event_id where {where} and (({_is('a', 1)} and "
            f"{_is('b', 2)}) or ({_is('a', 2)} and {_is('b', 1)})) group by 1")


_side = ("case when f.outcome_type <> 'decisive' or f.winner_id is null then null when l.aid = f.winner_id then 'A' "
         "when l.bid = f.winner_id then 'B' "
         + " ".join(f"when f.fighter{n}_id = f.winner_id and {_is(s, n)} then '{s.upper()}'"
                    for n in (1, 2) for s in "ab") + " end")


def _scored_sql(logged, matches):
    return ("select l.*, case when pct = 50 then 'TOSSUP' when pct > 50 then 'A' else 'B' end as pick, pct = 50 as tossup, "
            f"pct <> 50 and (pct >= 66 or pct <= 34) as high, f.fight_id, f.outcome_type, {_side} as side "
            f"from {logged} l left join {matches} m on m.k = l.k left join named_fights f on f.fight_id = m.fight_id")


o.cte("matches", ["logged", "named_fights", "bevents"], _matches_sql("logged"))
o.cte("scored", ["logged", "matches", "named_fights"], _scored_sql("logged", "matches"))
_correct = "case when side is not null and pick in ('A','B') then pick = side end"
register(
    "pick_ledger",
    lambda spark, d: rounded(_ledger(spark, d)[0].select(*LEDGER_SHOWN)),
    o.with_(f"select event_url, event_date, aname as fighter_a_name, bname as fighter_b_name, aid as fighter_a_id, pick, "
            f"tossup as is_tossup, high as is_high_conf_66, {o.r6('p_a')} as p_a, fight_id, outcome_type, side as "
            f"winner_side, {_correct} as pick_correct from scored", "scored"),
)
register(
    "pick_ledger_summary",
    lambda spark, d: _ledger(spark, d)[1],
    o.with_("select count(*) as n_logged, count(*) filter (where fight_id is null) as n_pending, "
            "count(*) filter (where tossup) as n_tossup, count(*) filter (where tossup and fight_id is not null) as "
            f"n_tossup_scored, count({_correct}) as n_picks_scored, count(*) filter (where {_correct}) as n_correct, "
            f"count({_correct}) filter (where high) as n_high_scored, count(*) filter (where high and {_correct}) as "
            "n_high_correct, count(*) filter (where outcome_type in ('draw','no_contest')) as n_void from scored", "scored"),
)

#: The first cycle knows the results before this day; the second knows all and gets predictions the other way round.
CYCLE_DAY, LATER = "2000-07-01", "2002-02-01 00:00:00"


def _second_cycle(spark, d):
    b = bench(spark, d)
    done = ledger.completed_fights(b.fights, b.events, b.fighters)
    early = done.filter(F.col("event_date") < F.lit(CYCLE_DAY).cast("date"))
    empty = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    first, _ = ledger.run_cycle(empty, b.predictions, early, F.lit(NOW).cast("timestamp"))
    other = b.predictions.withColumn("p_a", 1 - F.col("p_a"))
    return ledger.run_cycle(first, other, done, F.lit(LATER).cast("timestamp"))[0]


o.cte("turned", ["keyed"], "select * from (select * exclude (q), row_number() over (partition by k order by p_a desc) as r, "
      "round(p_a*100, 1) as pct from (select * exclude (p_a), p_a as q, 1 - p_a as p_a from keyed)) where r = 1")
o.cte("frozen", ["logged", "named_fights", "bevents"], _matches_sql("logged", f"f.event_date < date '{CYCLE_DAY}'").replace(
    "f.event_date", "cast(f.event_day as date)"))
# what was pending is scored before the new card is logged: only pairings without a bout take the later prediction
o.cte("two_cycles", ["logged", "turned", "matches"], "select *, true as early from logged where k in (select k from matches) union all "
      "by name select *, false as early from turned where k not in (select k from matches)")
o.cte("matched_again", ["two_cycles", "named_fights", "bevents"], _matches_sql("two_cycles"))
o.cte("scored_again", ["two_cycles", "matched_again", "named_fights"], _scored_sql("two_cycles", "matched_again"))
register(
    "pick_ledger_second_cycle",
    lambda spark, d: rounded(_second_cycle(spark, d).select(
        *LEDGER_SHOWN, (F.col("predicted_at") < F.lit(LATER).cast("timestamp")).alias("first_prediction"),
        (F.col("scored_at") < F.lit(LATER).cast("timestamp")).alias("frozen_at_first"))),
    o.with_(f"select event_url, event_date, aname as fighter_a_name, bname as fighter_b_name, aid as fighter_a_id, pick, "
            f"tossup as is_tossup, high as is_high_conf_66, {o.r6('p_a')} as p_a, fight_id, outcome_type, side as "
            f"winner_side, {_correct} as pick_correct, early as first_prediction, case when fight_id is not null then k in (select k from frozen) end as "
            "frozen_at_first from scored_again", "scored_again", "frozen"),
)

# -- upcoming card ----------------------------------------------------------


def _card(spark, d):
    b = bench(spark, d)
    return card.resolve_card(b.card, b.fighters)


o.cte("card_sides", [], f"select {o.cols(CARD)}, p_partkey from part")
o.cte("resolved", ["card_sides", "fighters"], "select c.*, coalesce(u.fighter_id, n.id, -(1000 + 2*bout_no + slot)) as fighter_id, "
      "u.fighter_id is null and n.id is null as missing from card_sides c left join fighters u on "
      "rtrim(replace(c.link, 'https:', 'http:'), '/') = u.fighter_url left join (select lower(fighter_name) as k, "
      "min(fighter_id) as id from fighters group by 1 having count(*) = 1) n on n.k = lower(c.person)")
_klass = ("case a.bout_no%3 when 0 then 'Lightweight' when 1 then 'Heavyweight' end as weight_class_norm, "
          "a.bout_no%3 = 1 as is_title, case when a.bout_no%50=0 or a.bout_no%3=1 then 5 else 3 end as scheduled_rounds")
register(
    "card_resolution",
    lambda spark, d: _card(spark, d).select(
        "bout_no", "fighter_a_id", "fighter_b_id", "a_missing", "b_missing", "weight_class_norm", "is_title",
        "scheduled_rounds"),
    o.with_(f"select a.bout_no, a.fighter_id as fighter_a_id, b.fighter_id as fighter_b_id, a.missing as a_missing, "
            f"b.missing as b_missing, {_klass} from resolved a join resolved b using (bout_no) where a.slot=0 and b.slot=1",
            "resolved"),
)
_card_aggs = {
    "career_fights_count": "count(*) filter (where p.is_valid_for_stats)",
    "career_wins": "count(*) filter (where p.result = 'W')",
    "days_since_last_fight": f"datediff('day', max(p.event_date), date '{CARD_DATE}')",
    "fights_in_last_18mo": f"count(*) filter (where p.event_date >= date '{CARD_DATE}' - 540)",
    "career_sig_str_landed_avg": "avg(p.sig_str_landed) filter (where p.is_valid_for_stats)",
    "career_pace_avg": "avg(p.pace) filter (where p.is_valid_for_stats)",
    "career_avg_opp_win_pct": "avg(p.opp_asof_win_pct)",
    "last5_avg_opp_win_pct": "avg(p.opp_asof_win_pct) filter (where p.back <= 5)",
    "debut_flag": "count(p.fight_id) = 0",
}
_card_exact = {"career_fights_count", "career_wins", "days_since_last_fight", "fights_in_last_18mo", "debut_flag"}


def _card_features(spark, d):
    b = bench(spark, d)
    return card.card_features(
        history.load_history(b.stored_corner_facts), _card(spark, d), F.lit(CARD_DATE).cast("date"))


register(
    "card_features",
    lambda spark, d: rounded(_card_features(spark, d).select("fighter_id", "fight_id", *_card_aggs)),
    o.with_("select r.fighter_id, -(r.bout_no+1) as fight_id, " + ", ".join(
        f"{e if n in _card_exact else o.r6(e)} as {n}" for n, e in _card_aggs.items())
        + " from resolved r left join (select h.*, m.opp_asof_win_pct, row_number() over (partition by h.fighter_id "
        "order by h.rn desc) as back from history h join met m on m.fighter_id = h.fighter_id and m.fight_id = h.fight_id) p "
        "on p.fighter_id = r.fighter_id group by r.fighter_id, r.bout_no, r.slot", "resolved", "history", "met"),
)


def _pseudo(rows, k=37):
    """A stand-in score that SQL can repeat: a hash of bout and orientation."""
    turn = F.when(F.col("orientation") == "page", 11).otherwise(5)
    return rows.withColumn("p", ((F.col("fight_id") * k + turn) % 1000) / 1000.0)


def _pseudo_sql(k=37):
    return f"((fight_id*{k} + case when orientation='page' then 11 else 5 end)%1000)/1000.0"


register(
    "symmetric_probability",
    lambda spark, d: rounded(card.symmetric(
        _pseudo(bench(spark, d).train_with()).select(
            "fight_id", "orientation", "p", F.col("y_a_pace").alias("slpm"), (F.col("y_a_td_diff")).alias("td"),
            F.col("y_a_ctrl_diff").alias("ctrl")))),
    o.with_(f"select fight_id, {o.r6('0.5*(p.p + 1 - s.p)')} as p_a, {o.r6('1 - 0.5*(p.p + 1 - s.p)')} as p_b, "
            + ", ".join(f"{o.r6(e)} as {n}" for n, e in (
                ("slpm_a", "p.y_a_pace"), ("slpm_b", "s.y_a_pace"),
                ("td_a", "case when p.y_a_td_diff is not null then greatest(p.y_a_td_diff,0) end"),
                ("td_b", "case when s.y_a_td_diff is not null then greatest(s.y_a_td_diff,0) end"),
                ("ctrl_a", "case when p.y_a_ctrl_diff is not null then greatest(p.y_a_ctrl_diff,0) end"),
                ("ctrl_b", "case when s.y_a_ctrl_diff is not null then greatest(s.y_a_ctrl_diff,0) end")))
            + f" from (select *, {_pseudo_sql()} as p from model_train where orientation='page') p join (select *, {_pseudo_sql()} as p "
            "from model_train where orientation='swapped') s using (fight_id)", "model_train"),
)

# -- scores and views -------------------------------------------------------

ERAS = Eras(date(1996, 1, 1), date(2000, 1, 1), date(2001, 1, 1))
_era_sql = ("case when event_date < date '1996-01-01' then 'pre-fit' when event_date < date '2000-01-01' then 'FIT' "
            "when event_date < date '2001-01-01' then 'VAL' else 'TEST' end")
_q = "least(greatest(p,1e-6),1-1e-6)"
_loss = f"avg(-case when y=1 then ln({_q}) else ln(1-{_q}) end)"
_acc = "avg(case when (p>=0.5) = (y=1) then 1.0 else 0.0 end)"
_brier = f"avg(({_q}-y)*({_q}-y))"


def _labelled(era=None, k=37, page=True):
    cond = ["y_a_win is not null"] + (["orientation='page'"] if page else [])
    if era:
        cond.append(f"{_era_sql} = '{era}'")
    return f"(select *, y_a_win as y, {_pseudo_sql(k)} as p from model_train where {' and '.join(cond)})"


def _scores_sql(src):
    return (f"count(*) as n, {o.r6(_loss)} as logloss, {o.r6(_acc)} as acc, {o.r6(_brier)} as brier, "
            "count(*) filter (where sure) as n_conf, "
            f"case when count(*) filter (where sure) >= 20 then {o.r6(_acc + ' filter (where sure)')} end as acc_conf, "
            "count(*) filter (where high) as n_66, "
            f"case when count(*) filter (where high) >= 10 then {o.r6(_acc + ' filter (where high)')} end as acc_66 from "
            f"(select *, abs({_q}-0.5) >= 0.1 as sure, {_q} >= 0.66 or {_q} <= 1-0.66 as high from {src})")


register(
    "win_scores",
    lambda spark, d: rounded(scores.win_scores(_pseudo(ERAS.slice(bench(spark, d).train_with(), "TEST")))),
    o.with_(f"select {_scores_sql(_labelled('TEST'))}", "model_train"),
)
_vet = ("not a_debut_flag and not b_debut_flag and a_career_fights_count >= 5 and b_career_fights_count >= 5")
register(
    "win_baselines",
    lambda spark, d: rounded(scores.win_baselines(_pseudo(ERAS.slice(bench(spark, d).train_with(*_HISTORY, "a_career_win_pct"), "TEST")))),
    o.with_("select count(*) as n_test, " + ", ".join(f"{o.r6(e)} as {n}" for n, e in (
        ("coin_logloss", "-ln(0.5)"), ("fav_logloss", "avg(-case when y=1 then ln(fav) else ln(1-fav) end)"),
        ("fav_acc", "avg(case when y = (fav=0.62)::int then 1.0 else 0.0 end)"),
        ("logloss", _loss), ("acc", _acc), ("brier", _brier),
        ("veteran_logloss", _loss + " filter (where vet)"), ("veteran_acc", _acc + " filter (where vet)")))
        + ", count(*) filter (where vet) as veteran_n from (select *, case when a_career_win_pct is null or b_career_win_pct is null "
        f"then 0.5 when a_career_win_pct > b_career_win_pct then 0.62 else 0.38 end as fav, {_vet} as vet from "
        f"{_labelled('TEST')})", "model_train"),
)
_bins = "case " + " ".join(f"when {_q} >= {lo} and {_q} < {hi} then {lo}::double" for lo, hi in zip(scores.EDGES, scores.EDGES[1:])) + " end"
register(
    "calibration",
    lambda spark, d: rounded(scores.calibration(_pseudo(scores.page_only(ERAS.slice(bench(spark, d).train_with(), "TEST"))))),
    o.with_(f"select {o.r6(_bins)} as bin_low, count(*) as n, {o.r6(f'avg({_q})')} as mean_pred, {o.r6('avg(y)')} as actual from "
            f"{_labelled('TEST')} group by {_bins}", "model_train"),
)
register(
    "era_summary",
    lambda spark, d: scores.era_summary(bench(spark, d).train_with(), ERAS),
    o.with_(f"select {_era_sql} as era, count(*) as n_rows, count(distinct fight_id) as n_fights, min(event_date) as first_date, "
            "max(event_date) as last_date from model_train group by 1", "model_train"),
)
register(
    "sample_weights",
    lambda spark, d: _sample_weights(bench(spark, d).train_with(*_HISTORY)),
    o.with_("select fight_id, orientation, case when a_debut_flag or b_debut_flag then 0.35 when "
            "least(a_career_fights_count, b_career_fights_count) < 5 or a_career_n_opp_known = 0 then 0.55 else 1.0 "
            f"end::double as weight, {_vet} as veterans from model_train", "model_train"),
)
register(
    "baseline_error",
    lambda spark, d: _baseline_error(bench(spark, d).train_with("a_career_td_landed_avg")),
    o.with_(f"select count(*) as n, {o.r6('avg(abs(y_a_td_landed - p*4))')} as mae, "
            f"{o.r6('avg(abs(y_a_td_landed - coalesce(a_career_td_landed_avg, (select quantile_cont(y_a_td_landed, 0.5) from model_train where ' + _era_sql + chr(61) + chr(39) + 'FIT' + chr(39) + '))))')} "
            f"as baseline_mae from (select *, {_pseudo_sql()} as p from model_train where orientation='page' and {_era_sql}='TEST' "
            "and y_a_td_landed is not null)", "model_train"),
)


#: What weights and veterans are told from.
_HISTORY = ["a_career_fights_count", "a_debut_flag", "a_career_n_opp_known"]


def _sample_weights(train):
    return train.select("fight_id", "orientation", scores.sample_weight(train).alias("weight"),
                        scores.both_veterans(train).alias("veterans"))


def _baseline_error(train):
    fill = scores.exact_percentile(ERAS.slice(train, "FIT"), F.col("y_a_td_landed"), 0.5)
    test = _pseudo(scores.page_only(ERAS.slice(train, "TEST"))).withColumn("guess", F.col("p") * 4)
    return rounded(scores.absolute_error(test, "guess", "y_a_td_landed", "a_career_td_landed_avg", fill or 0.0))


_page = "(select *, year(event_date) as year from model_train where orientation='page')"
register(
    "view_bouts_per_year",
    lambda spark, d: views.bouts_per_year(bench(spark, d).train_with(), ERAS),
    o.with_(f"select year, count(*) as fights, case when year < 1996 then 'pre-fit' when year < 2000 then 'FIT' when year < 2001 "
            f"then 'VAL' else 'TEST' end as era from {_page} group by 1", "model_train"),
)
o.cte("yearly", ["model_train"], "select year(event_date) as year, avg(y_a_win) filter (where orientation='page') as page_rate, "
      "count(*) filter (where orientation='page') as page_n, avg(y_a_win) as pooled_rate from model_train where y_a_win is not null group by 1")
register(
    "view_slot_a_win_rate",
    lambda spark, d: rounded(views.slot_a_win_rate(bench(spark, d).train_with())),
    o.with_(f"select year, {o.r6('page_rate')} as page_rate, page_n, {o.r6('pooled_rate')} as pooled_rate from yearly", "yearly"),
)
register(
    "view_slot_a_spans",
    lambda spark, d: rounded(views.slot_a_win_rate_spans(bench(spark, d).train_with(), 1998, 1999)),
    o.with_(f"select {o.r6('avg(page_rate) filter (where year < 1998)')} as page_early, "
            f"{o.r6('avg(page_rate) filter (where year >= 1999)')} as page_late, "
            f"{o.r6('avg(pooled_rate) filter (where year >= 1999)')} as pooled_late from yearly", "yearly"),
)
_null_sql = " union all ".join(
    f"select year, '{c}' as measure, {o.r6(f'100.0*avg(case when {c} is null then 1 else 0 end)')} as percent from {_page} group by 1"
    for c in views.MISSING_COLS
) + f" union all select year, 'debut_a', {o.r6('100.0*avg(a_debut_flag::int)')} from {_page} group by 1"
register(
    "view_null_rates",
    lambda spark, d: rounded(views.null_rates(bench(spark, d).train_with(*views.MISSING_COLS, "a_debut_flag"))),
    o.with_(_null_sql, "model_train"),
)
register(
    "view_career_and_form",
    lambda spark, d: rounded(views.career_and_form(bench(spark, d).train_with(
        "a_career_sig_str_landed_pm_avg", "a_last5_sig_str_landed_pm_avg", "a_debut_flag", "a_used_career_fallback_last5"), ERAS)),
    o.with_(f"select {o.r6('corr(x, z)')} as r, count(*) as n, count(*) filter (where y_a_win=1) as n_won, "
            f"count(*) filter (where y_a_win=0) as n_lost, (select {o.r6('least(greatest(quantile_cont(v, 0.99), 8.0), 12.0)')} from "
            "(select x as v from f union all select z from f)) as axis_limit from f".replace(
                "from f", "from (select a_career_sig_str_landed_pm_avg as x, a_last5_sig_str_landed_pm_avg as z, y_a_win from "
                "model_train where orientation='page' and event_date >= date '1996-01-01' and not a_debut_flag and not "
                "a_used_career_fallback_last5 and a_career_sig_str_landed_pm_avg is not null and "
                "a_last5_sig_str_landed_pm_avg is not null and y_a_win is not null)"), "model_train"),
)
register(
    "view_expected_and_actual",
    lambda spark, d: rounded(views.expected_and_actual(bench(spark, d).train_with("prod_expected_td_pm"), ERAS)),
    o.with_("select " + ", ".join(f"{o.r6(e)} as {n}" for n, e in (
        ("slope", "regr_slope(y, x)"), ("intercept", "regr_intercept(y, x)"), ("r", "corr(x, y)"),
        ("x_p01", "quantile_cont(x, 0.01)"), ("x_p99", "quantile_cont(x, 0.99)"), ("x_p995", "quantile_cont(x, 0.995)"),
        ("y_p995", "quantile_cont(y, 0.995)"))) + ", count(*) as n from (select prod_expected_td_pm as x, y_a_td_landed as y "
        "from model_train where orientation='page' and event_date >= date '1996-01-01' and prod_expected_td_pm is not null "
        "and y_a_td_landed is not null)", "model_train"),
)
register(
    "view_score_histogram",
    lambda spark, d: views.score_histogram(_pseudo(scores.page_only(ERAS.slice(bench(spark, d).train_with(), "TEST")))),
    o.with_(f"select cast(least(floor((q - lo) / ((hi - lo)/20)), 19) as int) as bin, count(*) as n from (select q, min(q) over () as lo, "
            f"max(q) over () as hi from (select {_q} as q from (select {_pseudo_sql()} as p from model_train where orientation='page' "
            f"and {_era_sql}='TEST'))) group by 1", "model_train"),
)


def _shapes(train):
    rows = _pseudo(ERAS.slice(train, "TEST"))
    return rows.withColumns({"stack_a_slpm": F.col("p") * 10, "stack_a_td": F.col("p") * 4 - 1, "stack_a_ctrl": F.col("p") * 300})


def _shape_sql(name, pred, actual, base):
    return (f"select '{name}' as target, count(*) as n, {o.r6(f'avg(abs({actual} - {pred}))')} as mae, "
            f"{o.r6(f'avg(abs({actual} - coalesce({base}, med)))')} as baseline_mae from (select *, "
            f"(select quantile_cont({base}, 0.5) from t0 where {actual} is not null) as med from t0 where {actual} is not null)")


o.cte("t0", ["model_train"], f"select *, {_pseudo_sql()} as p from model_train where orientation='page' and {_era_sql}='TEST'")
register(
    "view_shape_errors",
    lambda spark, d: rounded(views.shape_errors(_shapes(bench(spark, d).train_with(*[base for *_, base, _ in views.SHAPES])))),
    o.with_(" union all ".join([
        _shape_sql("slpm", "p*10", "y_a_sig_str_landed_pm", "a_career_sig_str_landed_pm_avg"),
        _shape_sql("td", "greatest(p*4-1, 0)", "y_a_td_landed", "a_career_td_landed_avg"),
        _shape_sql("ctrl", "greatest(p*300, 0)", "y_a_ctrl_seconds", "a_career_ctrl_seconds_avg")]), "t0"),
)
RECIPES = {"baseline": 37, "drop_last3": 41, "drop_bio": 53, "add_td_products (+4)": 61}


def _recipe_results(train):
    out = None
    for name, k in RECIPES.items():
        parts = []
        for era in ("VAL", "TEST"):
            s = scores.win_scores(_pseudo(ERAS.slice(train, era), k))
            parts.append(s.select(*[F.col(c).alias(f"{era.lower()}_{c}") for c in ("logloss", "acc")]))
        both = parts[0].unionByName(parts[1], allowMissingColumns=True).agg(
            *[F.max(f"{e}_{c}").alias(f"{e}_{c}") for e in ("val", "test") for c in ("logloss", "acc")])
        row = both.select(F.lit(name).alias("recipe"), F.lit(k).alias("n_features"), "*")
        out = row if out is None else out.unionByName(row)
    return out


_recipe_sql = " union all ".join(
    f"select '{name}' as recipe, {k} as n_features, v.ll as val_logloss, v.acc as val_acc, t.ll as test_logloss, t.acc as test_acc "
    f"from (select {_loss} as ll, {_acc} as acc from {_labelled('VAL', k)}) v, (select {_loss} as ll, {_acc} as acc from "
    f"{_labelled('TEST', k)}) t" for name, k in RECIPES.items())
o.cte("recipes", ["model_train"], _recipe_sql)
register(
    "view_ablation",
    lambda spark, d: rounded(views.ablation_comparison(_recipe_results(bench(spark, d).train_with()))),
    o.with_("select case recipe when 'baseline' then 'baseline (stacked win)' when 'drop_last3' then 'drop last-3' when 'drop_bio' "
            "then 'drop height/reach' else 'add TD matchup products' end as label, n_features, "
            + ", ".join(f"{o.r6(c)} as {c}" for c in ("val_logloss", "val_acc", "test_logloss", "test_acc"))
            + f", {o.r6('test_logloss - b')} as delta_test_logloss, test_logloss < b as better_logloss, test_acc > a as better_acc from "
            "recipes, (select test_logloss as b, test_acc as a from recipes where recipe='baseline')", "recipes"),
)

# -- stored pages -----------------------------------------------------------

_n = lambda pat: f"len(regexp_extract_all(html, '{pat}'))"
register(
    "page_tables",
    lambda spark, d: pages.table_profile(bench(spark, d).raw("pages")),
    f"select page_id, {_n('(?i)<table[^>]*>')} as n_tables, {_n('(?i)<table>')} as n_classless_tables, {_n('(?i)<tr[ >]')} as n_rows, "
    f"{_n('(?i)<th[ >]')} as n_header_cells, {_n('(?i)<td[ >]')} as n_data_cells, {_n('(?i)<section[ >]')} as n_sections from pages",
)
_strip = "trim(regexp_replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
register(
    "page_links",
    lambda spark, d: pages.links(bench(spark, d).raw("pages")),
    "select page_id, i - 1 as link_no, " + _strip.format("regexp_extract(a, '(?is)<a\\b([^>]*)>(.*?)</a>', 2)") + " as text, "
    "nullif(regexp_extract(a, '(?i)^<a\\b[^>]*href\\s*=\\s*\"([^\"]*)\"', 1), '') as href, "
    "nullif(regexp_extract(a, '(?i)^<a\\b[^>]*class\\s*=\\s*\"([^\"]*)\"', 1), '') as link_class "
    "from (select page_id, unnest(l) as a, cast(unnest(range(1, len(l)+1)) as int) as i from (select page_id, "
    "regexp_extract_all(html, '(?is)<a\\b([^>]*)>(.*?)</a>') as l from pages))",
)
register(
    "page_status_nodes",
    lambda spark, d: pages.status_nodes(bench(spark, d).raw("pages")),
    "select page_id, lower(trim(t)) as status, count(*) as n from (select page_id, unnest(regexp_split_to_array(html, '<[^>]*>')) as t "
    "from pages) where lower(trim(t)) in ('w','l','d','nc') group by 1, 2",
)
register(
    "page_headings",
    lambda spark, d: pages.headings(bench(spark, d).raw("pages")),
    "select page_id, i - 1 as heading_no, " + _strip.format("h") + " as heading from (select page_id, unnest(l) as h, "
    "cast(unnest(range(1, len(l)+1)) as int) as i from (select page_id, regexp_extract_all(html, "
    "'(?is)<h[23]\\b[^>]*>(.*?)</h[23]>', 1) as l from pages))",
)

def _order_pages(spark, d):
    """Orders as pages: a table with a class, one without that holds another, a title, a status, and an unclosed table."""
    b = bench(spark, d)
    cells = F.format_string("<tr class='l%s'><td>%s</td><td> %s <b>of</b> 50<br>&amp; more</td></tr>", "l_returnflag", "l_linenumber",
                            F.col("l_partkey"))
    place = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    lines = b.raw("lineitem").select("l_orderkey", F.struct(*place, cells.alias("html")).alias("line"))
    rows = lines.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["html"]), "").alias("rows"))
    orders = b.raw("orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey"))
    html = F.concat(
        F.lit("<section><h2>Order <i>no</i> "), F.col("o_orderkey").cast("string"), F.lit("</h2></section><i> "), F.col("o_orderstatus"),
        F.lit(" </i><i>NC</i><table class='t'><tr><td>classed</td></tr></table><TABLE><thead><tr><th>line</th><th>part</th></tr></thead>"),
        F.col("rows"), F.lit("<tr><td>inner <table><tr><td>"), F.col("o_custkey").cast("string"),
        F.lit("</td></tr></table> end</td></tr></TABLE></p><table><tr><td>open"))
    return orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


def _page_rows(spark, d):
    found = pages.table_rows(_order_pages(spark, d))
    return found.select("page_id", "table_no", "row_no", "row_class", F.array_join("tags", ",").alias("tags"), F.array_join("texts", "|").alias("texts"))


_order_lines = ("(select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_returnflag) as i, "
                "count(*) over (partition by l_orderkey) as n from lineitem)")
_heads = f"(select o_orderkey, any_value(o_custkey) as cust, any_value(n) as n from orders join {_order_lines} on l_orderkey = o_orderkey group by 1)"
register(
    "page_rows", _page_rows,
    " union all ".join([
        "select o_orderkey as page_id, 1 as table_no, 0 as row_no, null as row_class, 'th,th' as tags, 'line|part' as texts from " + _heads,
        "select l_orderkey, 1, cast(i as int), 'l' || l_returnflag, 'td,td', l_linenumber || '|' || l_partkey || ' of 50 & more' from "
        f"{_order_lines} where l_orderkey in (select o_orderkey from orders)",
        f"select o_orderkey, 1, cast(n + 1 as int), null, 'td,td', 'inner ' || cust || ' end|' || cust from {_heads}",
        f"select o_orderkey, 1, cast(n + 2 as int), null, 'td', cast(cust as varchar) from {_heads}",
        f"select o_orderkey, 2, 0, null, 'td', cast(cust as varchar) from {_heads}",
        f"select o_orderkey, 3, 0, null, 'td', 'open' from {_heads}"]),
)
register(
    "page_order_headings",
    lambda spark, d: pages.headings(_order_pages(spark, d)),
    f"select o_orderkey as page_id, cast(0 as int) as heading_no, 'Order no ' || o_orderkey as heading from {_heads}",
)
register(
    "page_order_status",
    lambda spark, d: pages.status_nodes(_order_pages(spark, d)),
    f"select o_orderkey as page_id, 'nc' as status, cast(1 as bigint) as n from {_heads}",
)
register(
    "corner_checks",
    lambda spark, d: pages.corner_check_counts(pages.corner_checks(_doc_corners(spark, d))),
    o.with_("select count(*) filter (where a) as people_passed, count(*) filter (where not a) as people_failed, "
            "count(*) filter (where r) as results_passed, count(*) filter (where not r) as results_failed from (select "
            "coalesce(name1 <> name2 and url1 <> url2 and name2 <> '', false) as a, coalesce(url1 <> url2 and "
            "status1 is not null, false) as r from docs where version=1)", "docs"),
)


def _doc_corners(spark, d):
    orders = bench(spark, d).raw("orders")
    rows = orders.select("o_orderkey", *exprs(BOUT_DOC))
    result = F.expr("map_filter(map(url1, status1, coalesce(nullif(url2, url1), 'none'), status2), (k, v) -> v is not null)")
    return rows.select("fight_url", "name1", "url1", "name2", "url2", result.alias("result"))

# -- models: SQL cannot grow trees, but it can say which rows are fitted, scored and predicted ---------------

SMALL = learn.Boost(trees=3, depth=3)


def _learn_cols(train):
    """All features of the recipe but the text ones' codes, which are features too."""
    return learn.feature_columns(train.columns, "win")


def _slices(spark, d):
    train = bench(spark, d).stored_model_train
    return [ERAS.slice(train, e) for e in ("FIT", "VAL", "TEST")]


def _win_model(spark, d):
    fit, val, test = _slices(spark, d)
    model = learn.fit(fit, _learn_cols(fit), "y_a_win", SMALL, val=val, kind="win")
    found = scores.win_baselines(model.predict(scores.page_only(test)))
    return rounded(found.select("n_test", "coin_logloss", "fav_logloss", "fav_acc", "veteran_n",
                                F.expr("logloss > 0 and logloss < 2 and brier between 0 and 1").alias("scored")))


def _stat_model(spark, d):
    fit, val, test = _slices(spark, d)
    found = learn.stat_scores(fit, val, test, _learn_cols(fit), "y_a_td_landed", "a_career_td_landed_avg", SMALL)[1]
    return rounded(found.select("n", "baseline_mae", F.expr("mae > 0 and trees between 1 and 3").alias("scored")))


def _walk_forward(spark, d):
    fit = _slices(spark, d)[0]
    return learn.walk_forward(fit, _learn_cols(fit), "y_a_td_landed", SMALL)


def _win_model_scores(spark, d):
    """The winner model's losses next to its baselines, and its trees."""
    return learn.win_models(*_slices(spark, d), _learn_cols(bench(spark, d).stored_model_train), SMALL)[1]


def _win_predictions(spark, d):
    fit, val, test = _slices(spark, d)
    model = learn.fit(fit, _learn_cols(fit), "y_a_win", SMALL, val=val, kind="win")
    return model.predict(test).select(*learn.KEYS, "y_a_win", "p")


def _stat_model_scores(spark, d):
    """The takedown model's error next to the career average, and its trees: the whole number and depth, stopped early."""
    fit, val, test = _slices(spark, d)
    label, base, recipe = learn.STAT_TARGETS["td"]
    return learn.stat_scores(fit, val, test, learn.feature_columns(fit.columns, recipe), label, base, learn.Boost())[1]


def _ablation(spark, d):
    """All recipes, without the stack's columns, which a trained stack would add."""
    parts = _slices(spark, d)
    base = _learn_cols(parts[0])
    return learn.ablate(spark, *parts, learn.ablation_recipes(base, learn.feature_columns(parts[0].columns)), SMALL)


def _fold_plan(spark, d):
    plan = learn.fold_plan(bench(spark, d).train_with(), "y_a_td_landed")
    return spark.createDataFrame([(f.year, f.rows, f.inner_fit, f.inner_val, f.mode) for f in plan],
                                 "year int, n_before long, inner_fit long, inner_val long, mode string")


def _fold_sql(where="true"):
    """Folds of the training rows: counts before each year, the inner slice's edge six months before the last of them."""
    return f"""(select year, n_before, inner_fit, n_before - inner_fit as inner_val, case when n_before < 250 then 'none'
      when inner_fit < 200 or n_before - inner_fit < 50 then 'fixed' else 'stopped' end as mode from (
      select y.year, count(t.event_date) as n_before,
        count(t.event_date) filter (where t.event_date < y.last - interval 6 months) as inner_fit
      from (select a.year, max(b.event_date) as last from (select distinct cast(year(event_date) as int) as year
            from model_train where {where}) a left join (select event_date from model_train where y_a_td_landed is not null
            and {where}) b on year(b.event_date) < a.year group by 1) y
      left join (select event_date from model_train where y_a_td_landed is not null and {where}) t
        on year(t.event_date) < y.year group by 1))"""


_fit_era = f"{_era_sql} = 'FIT'"
register("fold_plan", _fold_plan, o.with_(f"select * from {_fold_sql()}", "model_train"))
register(
    "win_model", _win_model,
    o.with_("select count(*) as n_test, " + ", ".join(f"{o.r6(e)} as {n}" for n, e in (
        ("coin_logloss", "-ln(0.5)"), ("fav_logloss", "avg(-case when y=1 then ln(fav) else ln(1-fav) end)"),
        ("fav_acc", "avg(case when y = (fav=0.62)::int then 1.0 else 0.0 end)")))
        + ", count(*) filter (where vet) as veteran_n, true as scored from (select *, case when a_career_win_pct is null or "
        "b_career_win_pct is null then 0.5 when a_career_win_pct > b_career_win_pct then 0.62 else 0.38 end as fav, "
        f"{_vet} as vet from {_labelled('TEST')})", "model_train"),
)
register(
    "stat_model", _stat_model,
    o.with_(f"select count(*) as n, {o.r6('avg(abs(y_a_td_landed - coalesce(a_career_td_landed_avg, fill)))')} as baseline_mae, "
            "true as scored from model_train, (select quantile_cont(y_a_td_landed, 0.5) as fill from model_train where "
            f"{_fit_era}) where orientation='page' and {_era_sql}='TEST' and y_a_td_landed is not null", "model_train"),
)
# what the models say; SQL cannot, tests compare it with plain refits
register("win_model_scores", _win_model_scores)
register("win_predictions", _win_predictions)
register("stat_model_scores", _stat_model_scores)
register("walk_forward_predictions", _walk_forward)
register("ablation", _ablation)
register(
    "walk_forward",
    lambda spark, d: _walk_forward(spark, d).select(*learn.KEYS, F.col("pred").isNotNull().alias("predicted")),
    o.with_(f"select fight_id, orientation, mode <> 'none' as predicted from model_train join {_fold_sql(_fit_era)} f "
            f"on f.year = year(event_date) where {_fit_era}", "model_train"),
)
register(
    "stacked_columns",
    lambda spark, d: rounded(learn.with_stack(
        bench(spark, d).train_with().select("fight_id", "orientation"),
        _pseudo(bench(spark, d).train_with()).select("fight_id", "orientation", F.col("p").alias("slpm"),
                                                    (F.col("p") * 2).alias("td"), (F.col("p") * 3).alias("ctrl")))),
    o.with_("select a.fight_id, a.orientation, " + ", ".join(
        f"{o.r6(f'a.p*{i}')} as stack_a_{n}, {o.r6(f'b.p*{i}')} as stack_b_{n}, {o.r6(f'a.p*{i} - b.p*{i}')} as stack_diff_{n}"
        for i, n in ((1, "slpm"), (2, "td"), (3, "ctrl")))
        + f" from (select *, {_pseudo_sql()} as p from model_train) a join (select *, {_pseudo_sql()} as p from model_train) b "
        "on a.fight_id = b.fight_id and a.orientation <> b.orientation", "model_train"),
)
