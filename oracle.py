"""The checking SQL: the same results phrased apart from the engine, for DuckDB.

Windows are phrased as a join of each row with the fighter's earlier rows, the
opponent's numbers as a self-join, and the mirror as a UNION ALL.
"""

from ringside.columns import (
    CARDIO_FACT_COLS, DIFF_COLS, FEATURE_COLS, LABEL_COLS, OPPONENT_RATE_COLS, STAT_COLS, TRENDS, WINDOWS,
)
from ringside.operators.corners import CORNER_FACT_COLS, COUNT_CELLS, PAIR_CELLS, STRIKE_PARTS
from ringside.sources import binding as b

DAYS = "datediff('day', date '1970-01-01', event_date)"


def cols(table, **fill):
    return ", ".join(f"{(e.format(**fill) if fill else e)} as {n}" for n, e in table.items())


def x_of_y(c, i):
    return f"try_cast(nullif(regexp_extract({c}, '([0-9]+) of ([0-9]+)', {i}), '') as double)"


def cnt(c):
    return f"try_cast({c} as double)"


def clock(c):
    return f"(try_cast(split_part({c}, ':', 1) as double) * 60 + try_cast(split_part({c}, ':', 2) as double))"


def share(a, w):
    return f"case when {w} > 0 then 100.0*{a}/{w} end"


def div(a, w):
    return f"case when {w} > 0 then ({a})*1.0/({w}) end"


def even(*parts):
    t = "(" + " + ".join(f"greatest(coalesce({p},0),0)" for p in parts) + ")"
    terms = " + ".join(f"case when {p} > 0 then -({p}/{t})*log2({p}/{t}) else 0 end" for p in parts)
    return f"case when {t} > 0 then ({terms})/log2(3) end"


def r6(c):
    """Six decimals. The same nudge on both sides keeps exact halves from going either way."""
    return f"round({c}+3.1e-8,6)+0.0"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, needs, sql):
    CTES[name] = (needs, sql)


def with_(main, *needs):
    """WITH clause holding what ``needs`` depends on, in order."""
    order = []

    def add(n):
        for d in CTES[n][0]:
            add(d)
        if n not in order:
            order.append(n)

    for n in needs:
        add(n)
    parts = ",\n".join(f"{n} as materialized ({CTES[n][1]})" for n in order)
    return f"with {parts}\n{main}"


# -- bound inputs -----------------------------------------------------------

cte("lines", [], f"select {cols(b.LINE)} from (select *, row_number() over (partition by l_orderkey order by "
    f"{', '.join(b.LINE_ORDER)}) as p from lineitem)")
cte("per_fight", ["lines"], f"select fight_id, {cols(b.FIGHT_AGGS)} from lines group by fight_id")
cte("fights", ["per_fight"], f"select *, {DAYS} as event_id from (select {cols(b.FIGHT)} from orders join "
    "(select fight_id as fid, * exclude (fight_id) from per_fight where f2 is not null) on o_orderkey = fid)")
cte("bevents", ["fights"], f"select distinct {cols(b.EVENT, days=DAYS)}, event_date from fights")
cte("round_stats", ["lines", "per_fight"],
    f"select fight_id, round_number, {cols(b.ROUND_AGGS)} from lines where fight_id in "
    "(select fight_id from per_fight where f2 is not null) group by fight_id, round_number")
cte("fight_totals", ["per_fight"],
    f"select {cols(b.TOTALS)} from per_fight where f2 is not null and {b.TOTALS_WHERE}")
cte("fighters", [], f"select {cols(b.FIGHTER)} from part")
cte("fighter_bio", [], f"select {cols(b.BIO)} from part")
cte("fight_metadata", ["fights"], f"select {cols(b.METADATA)} from fights where fight_id%29<>0")
cte("judge_scores", ["fights"], f"select {cols(b.JUDGE)} from fights, (values (1),(2),(3)) t(j) "
    "where method like 'Decision%'")
cte("snapshot", [], f"select {cols(b.SNAPSHOT)} from part")

# -- facts ------------------------------------------------------------------

GROUP = ("case when method='Overturned' or outcome_type='no_contest' then 'NC' when method='DQ' then 'DQ' "
         "when method like 'Decision%' then 'DEC' when method like '%KO%' then 'KO_TKO' "
         "when method='Submission' then 'SUB' else 'OTHER' end")
SECONDS = f"(greatest(round,1)-1)*300.0 + {clock('time')}"
cte("fight_facts", ["fights"], f"""
select fight_id, event_id, event_date, weight_class as weight_class_raw,
 case when weight_class like '%Title%' then 'Lightweight' when weight_class like 'Women%' then 'Women''s Strawweight'
      when weight_class like 'Catch%' then 'Catch Weight' else weight_class end as weight_class_norm,
 coalesce(weight_class like '%Title%', false) as is_title,
 coalesce(weight_class like 'Women%', false) as is_women,
 time_format as time_format_raw,
 case when time_format like '5 Rnd%' then 5 when time_format like '3 Rnd%' then 3 end as scheduled_rounds,
 round as final_round, {SECONDS} as fight_seconds, method as method_raw, {GROUP} as method_group,
 outcome_type, winner_id, {GROUP} not in ('NC','DQ') as is_valid_for_stats
from fights""")

_nums = ", ".join(
    [f"{x_of_y(c, 1)} as {c}_landed, {x_of_y(c, 2)} as {c}_attempted" for c in PAIR_CELLS]
    + [f"{cnt(c)} as {c}" for c in COUNT_CELLS] + [f"{clock('ctrl')} as ctrl_seconds"]
    + [f"{x_of_y('parts->>' + chr(39) + p + chr(39), 1)} as {p}_landed, "
       f"{x_of_y('parts->>' + chr(39) + p + chr(39), 2)} as {p}_attempted" for p in STRIKE_PARTS])
cte("corner_rounds", ["round_stats"], " union all ".join(
    f"select fight_id, round_number, {s} as side, {_nums} from (select fight_id, round_number, "
    + ", ".join(f"fighter{s}_{c} as {c}" for c in [*PAIR_CELLS, *COUNT_CELLS, "ctrl"])
    + f", raw_round::json->'significant_strikes'->'fighter{s}' as parts from round_stats)" for s in (1, 2)))

_sums = [f"{c}_{k}" for c in PAIR_CELLS for k in ("landed", "attempted")] + COUNT_CELLS + ["ctrl_seconds"]
cte("corner_sums", ["corner_rounds"], "select fight_id, side, " + ", ".join(
    [f"sum({c}) as {c}" for c in _sums]
    + [f"max(case when round_number={n} then sig_str_{k} end) as r{n}_{k}" for n in range(1, 6)
       for k in ("landed", "attempted")]
    + [f"sum(coalesce({c},0)) filter (where round_number>={f}) as late{f}_{c}" for f in (3, 4)
       for c in ("td_landed", "td_attempted", "kd", "ctrl_seconds")]
) + " from corner_rounds group by 1, 2")

cte("corner_totals", ["fight_totals"], " union all ".join(
    f"select fight_id, {s} as side, " + ", ".join(
        f"{x_of_y(f'fighter{s}_{c}', 1)} as tot_{c}_landed, {x_of_y(f'fighter{s}_{c}', 2)} as tot_{c}_attempted"
        for c in ["sig_str", *STRIKE_PARTS]) + " from fight_totals" for s in (1, 2)))

cte("corner_own", ["fight_facts", "corner_sums", "corner_totals", "fights"], f"""
select ff.*, s.side, case s.side when 1 then f.fighter1_id else f.fighter2_id end as fighter_id,
 case s.side when 1 then f.fighter2_id else f.fighter1_id end as opponent_id, s.side = 1 as is_fighter1,
 case when t.tot_sig_str_landed is null then c.sig_str_landed else t.tot_sig_str_landed end as sig_str_landed,
 case when t.tot_sig_str_landed is null then c.sig_str_attempted else t.tot_sig_str_attempted end as sig_str_attempted,
 {', '.join(f't.tot_{p}_{k} as {p}_{k}' for p in STRIKE_PARTS for k in ('landed', 'attempted'))},
 c.* exclude (fight_id, side, sig_str_landed, sig_str_attempted)
from fight_facts ff join fights f using (fight_id) cross join (values (1),(2)) s(side)
left join corner_sums c on c.fight_id = ff.fight_id and c.side = s.side
left join corner_totals t on t.fight_id = ff.fight_id and t.side = s.side""")

_pm = lambda x: f"case when a.fight_seconds > 0 then {x}/(a.fight_seconds/60.0) end"
_five = "coalesce(scheduled_rounds = 5, false)"
_done = lambda n: (f"coalesce((r{n}_attempted is not null or r{n}_landed is not null) and (final_round > {n} or "  # noqa: E731
                   f"(final_round = {n} and fight_seconds - {(n - 1) * 300} >= 290)), false)")
cte("corner_linked", ["corner_own"], f"""
select a.*, case when a.outcome_type='draw' then 'D' when a.outcome_type='no_contest' then 'NC'
   when a.winner_id = a.fighter_id then 'W' when a.winner_id is not null then 'L' end as result,
 {share('a.sig_str_landed', 'a.sig_str_attempted')} as sig_str_percent,
 {share('a.td_landed', 'a.td_attempted')} as td_percent,
 {', '.join(share(f'a.{p}_landed', 'a.sig_str_landed') + f' as {p}_pct' for p in ('distance', 'clinch', 'ground'))},
 o.sig_str_landed as sig_str_absorbed, o.sig_str_attempted as sig_str_opp_attempted,
 100.0 - ({share('o.sig_str_landed', 'o.sig_str_attempted')}) as strike_defense,
 o.td_landed as td_absorbed, o.td_attempted as td_opp_attempted,
 100.0 - ({share('o.td_landed', 'o.td_attempted')}) as td_defense,
 o.kd as kd_absorbed, o.ctrl_seconds as ctrl_against_seconds,
 a.sig_str_landed - o.sig_str_landed as sig_str_diff, a.td_landed - o.td_landed as td_diff,
 a.ctrl_seconds - o.ctrl_seconds as ctrl_diff,
 case when a.fight_seconds > 0 then a.fight_seconds/60.0 end as fight_minutes,
 {_pm('o.sig_str_landed')} as sig_str_absorbed_pm,
 {', '.join(_pm(f'a.{x}') + f' as {x}_pm' for x in ('sig_str_landed', 'sig_str_attempted', 'td_landed',
                                                     'td_attempted', 'kd', 'sub_att', 'ctrl_seconds'))},
 {_pm("(case when a.sig_str_attempted is null and a.td_attempted is null then null else "
      "coalesce(a.sig_str_attempted,0)+coalesce(a.td_attempted,0) end)")} as pace
from corner_own a join corner_own o on o.fight_id = a.fight_id and o.fighter_id = a.opponent_id
where a.fighter_id <> a.opponent_id""")

cte("corner_flags", ["corner_linked"], f"""
select *, r3_attempted is not null or r3_landed is not null as reached_round_3,
 r5_attempted is not null or r5_landed is not null as reached_round_5,
 {_done(3)} as completed_round_3, {_done(5)} as completed_round_5,
 case when {_five} then {_done(5)} else {_done(3)} end as went_the_distance,
 cast(case when lc < 1 then null when lc > 5 then 5 else lc end as int) as last_completed_round
from (select *, final_round - case when coalesce(fight_seconds - (final_round-1)*300 >= 290, false)
        then 0 else 1 end as lc from corner_linked)""")

_late = {"late_td_landed": "td_landed", "late_td_attempted": "td_attempted", "late_kd": "kd",
         "late_ctrl_seconds": "ctrl_seconds"}


def _cardio_level(k):
    pair = [f"case when r{n}_{k} > 0 then r{n + 1}_{k}/r{n}_{k} end" for n in range(1, 5)]
    short = "att" if k == "attempted" else "landed"
    five = f"[{', '.join(pair)}]"
    three = f"[{', '.join(pair[:2])}]"
    return (f"case when reached_round_3 and r1_{k} > 0 then r3_{k}/r1_{k} end as cardio_r3_r1_{short}, "
            f"case when reached_round_5 and r1_{k} > 0 then r5_{k}/r1_{k} end as cardio_r5_r1_{short}, "
            f"case when went_the_distance then case when {_five} then list_avg({five}) else list_avg({three}) end end "
            f"as cardio_consec_{short}, "
            f"case when last_completed_round >= 2 and r1_{k} > 0 then "
            f"list_extract([r1_{k}, r2_{k}, r3_{k}, r4_{k}, r5_{k}], last_completed_round)/r1_{k} end "
            f"as cardio_last_full_r1_{short}")


def _cardio_top(short):
    whole = f"case when {_five} then cardio_r5_r1_{short} else cardio_r3_r1_{short} end"
    stop = (f"case when {_five} and not went_the_distance and coalesce(last_completed_round >= 3, false) "
            f"then cardio_last_full_r1_{short} end")
    return (f"case when went_the_distance then {whole} end as cardio_distance_{short}, "
            f"{stop} as cardio_five_stoppage_{short}, "
            f"case when went_the_distance then {whole} else {stop} end as cardio_observed_{short}")


cte("corner_facts", ["corner_flags"], f"""
select *, {_cardio_top('att')}, {_cardio_top('landed')},
 {', '.join(f'r{n}_{k} as r{n}_sig_str_{k}' for n in (1, 3, 5) for k in ('attempted', 'landed'))},
 {', '.join(f"case when {_five} then case when reached_round_5 then late4_{c} end when reached_round_3 then late3_{c} end as {n}" for n, c in _late.items())}
from (select *, {_cardio_level('attempted')}, {_cardio_level('landed')} from corner_flags)""")

# -- features ---------------------------------------------------------------

cte("history", ["corner_facts"], f"""
select *, {DAYS} as day_no, row_number() over (partition by fighter_id order by event_date, fight_id) as rn,
 {even('distance_pct', 'clinch_pct', 'ground_pct')} as style_entropy,
 case when td_landed > 0 then ctrl_seconds/td_landed end as ctrl_per_td,
 case when ctrl_seconds > 0 then ground_landed/(ctrl_seconds/60.0) end as ground_per_ctrl_min,
 case when td_landed > 0 then sub_att/td_landed end as sub_per_td
from corner_facts""")
_subs = {
    "v": "p.is_valid_for_stats",
    "r3": "p.is_valid_for_stats and p.reached_round_3",
    "c3": "p.is_valid_for_stats and p.completed_round_3",
    "dist": "p.is_valid_for_stats and p.went_the_distance",
    "stop": "p.is_valid_for_stats and p.cardio_five_stoppage_att is not null",
    "obs": "p.is_valid_for_stats and p.cardio_observed_att is not null",
}
# every row with each of its fighter's earlier rows, and how many such rows ago each was
cte("earlier", ["history"], "select h.fighter_id as me, h.fight_id as bout, h.day_no as today, "
    "h.weight_class_norm as klass, h.rn - p.rn as ago, p.*, "
    + ", ".join(f"({c}) as in_{n}" for n, c in _subs.items()) + ", " + ", ".join(
        f"case when {c} then row_number() over (partition by h.fighter_id, h.fight_id, ({c}) order by p.rn desc) end "
        f"as ago_{n}" for n, c in _subs.items())
    + " from history h join history p on p.fighter_id = h.fighter_id and p.rn < h.rn")


def feature_sql(aggs: dict[str, str], outer: dict[str, str] | None = None, extra: str = "") -> str:
    inner = ", ".join(f"{e} as {n}" for n, e in aggs.items())
    shown = outer if outer is not None else {n: n for n in aggs}
    picked = ", ".join(f"{e} as {n}" for n, e in shown.items())
    return (f"select h.fighter_id, h.fight_id, {picked} from history h left join "
            f"(select me, bout, {inner} from earlier group by 1, 2) e on e.me = h.fighter_id and e.bout = h.fight_id {extra}")


IN_WINDOW = {"career": "in_v", "momentum": "in_v and day_no >= today - 540",
             "last3": "ago_v <= 3", "last5": "ago_v <= 5"}


def window_aggs(windows, stats=STAT_COLS):
    out = {}
    for w in windows:
        for s in stats:
            own = f"avg({s}) filter (where {IN_WINDOW[w]})"
            if w != "career":
                own = f"case when count(*) filter (where {IN_WINDOW[w]}) = 0 then avg({s}) filter (where in_v) else {own} end"
            out[f"{w}_{s}_avg"] = own
    return out


def trend_exprs(stats=STAT_COLS):
    return {f"trend_{a}_vs_{b_}_{s}": f"{a}_{s}_avg - {b_}_{s}_avg" for a, b_ in TRENDS for s in stats}


MIX = {f"{w}_mix_entropy": even(*[f"{w}_{p}_pct_avg" for p in ("distance", "clinch", "ground")])
       for w in ("career", "last5")}

ACTIVITY_AGGS = {
    "last_day": "max(day_no)", "n_all": "count(*)", "n_v": "count(*) filter (where in_v)",
    "n540": "count(*) filter (where day_no >= today-540)", "n720": "count(*) filter (where day_no >= today-720)",
    "n540v": "count(*) filter (where in_v and day_no >= today-540)",
}
ACTIVITY = {
    "days_since_last_fight": "h.day_no - last_day", "fights_in_last_18mo": "coalesce(n540,0)",
    "fights_in_last_24mo": "coalesce(n720,0)", "stale_flag": "coalesce(h.day_no - last_day > 365, false)",
    "used_career_fallback_momentum": "coalesce(n540v,0) = 0",
    "used_career_fallback_last3": "coalesce(n_v,0) = 0", "used_career_fallback_last5": "coalesce(n_v,0) = 0",
    "debut_flag": "n_all is null", "career_fights_count": "coalesce(n_v,0)",
    "last3_fights_count": "least(coalesce(n_v,0),3)", "last5_fights_count": "least(coalesce(n_v,0),5)",
}
RECORD_AGGS = {
    "w": "count(*) filter (where result='W')", "l": "count(*) filter (where result='L')",
    "d": "count(*) filter (where result='D')", "nc": "count(*) filter (where result='NC')",
    "w3": "count(*) filter (where result='W' and ago<=3)", "l3": "count(*) filter (where result='L' and ago<=3)",
    "w5": "count(*) filter (where result='W' and ago<=5)", "l5": "count(*) filter (where result='L' and ago<=5)",
    "nf": "count(*) filter (where scheduled_rounds=5)", "nt": "count(*) filter (where is_title)",
    "rounds": "avg(final_round)", "n_r": "count(*)",
    "not_w": "min(ago) filter (where result is null or result<>'W')",
    "not_l": "min(ago) filter (where result is null or result<>'L')",
} | {f"{g}{n}": f"count(*) filter (where result='W' and method_group='{m_}'{c})"
     for g, m_ in (("ko", "KO_TKO"), ("su", "SUB"), ("de", "DEC")) for n, c in (("", ""), ("5", " and ago<=5"))}
RECORD = {
    "career_wins": "coalesce(w,0)", "career_losses": "coalesce(l,0)", "career_draws": "coalesce(d,0)",
    "career_no_contests": "coalesce(nc,0)", "last_3_wins": "coalesce(w3,0)", "last_3_losses": "coalesce(l3,0)",
    "last_5_wins": "coalesce(w5,0)", "last_5_losses": "coalesce(l5,0)",
    "num_five_round_fights": "coalesce(nf,0)", "num_title_fights": "coalesce(nt,0)", "avg_rounds_fought": "rounds",
    "win_streak": "coalesce(not_w - 1, n_r, 0)", "loss_streak": "coalesce(not_l - 1, n_r, 0)",
}
RATES = {
    "career_finish_rate": div("ko+su", "w"), "career_decision_rate": div("de", "w"),
    "career_ko_rate": div("ko", "ko+su+de"), "career_sub_rate": div("su", "ko+su+de"),
    "career_method_entropy": even("ko", "su", "de"),
    "last5_ko_rate": div("ko5", "ko5+su5+de5"), "last5_sub_rate": div("su5", "ko5+su5+de5"),
    "last5_decision_rate": div("de5", "ko5+su5+de5"), "last5_method_entropy": even("ko5", "su5", "de5"),
    "career_win_pct": div("w", "w+l"), "last5_win_pct": div("w5", "w5+l5"),
}
CLASS_AGGS = {"same": "count(*) filter (where weight_class_norm = klass)",
              "last_class": "max(weight_class_norm) filter (where ago=1)"}
_rank = lambda c: (f"case {c} when 'Flyweight' then 0 when 'Lightweight' then 3 when 'Welterweight' then 4 "  # noqa: E731
                   f"when 'Heavyweight' then 7 when 'Women''s Strawweight' then 0 end")
CLASS = {
    "first_time_in_class": "h.weight_class_norm is null or coalesce(same,0)=0",
    "n_prior_in_class": "case when h.weight_class_norm is null then 0 else coalesce(same,0) end",
    "switched_class": "coalesce(h.weight_class_norm <> last_class, false)",
    "class_move": f"cast(sign(({_rank('h.weight_class_norm')}) - ({_rank('last_class')})) as int)",
}
CARDIO_AGGS = {
    "career_n_r3": "count(*) filter (where in_r3)", "career_n_r3_complete": "count(*) filter (where in_c3)",
    "career_n_distance": "count(*) filter (where in_dist)", "career_n_five_stoppage": "count(*) filter (where in_stop)",
    "career_n_observed": "count(*) filter (where in_obs)",
    "last5_n_r3": "count(*) filter (where ago_r3<=5)", "last5_n_r3_complete": "count(*) filter (where ago_c3<=5)",
    "last3_n_r3_complete": "count(*) filter (where ago_c3<=3)", "last5_n_distance": "count(*) filter (where ago_dist<=5)",
    "last5_n_observed": "count(*) filter (where ago_obs<=5)",
    "career_cardio_five_stoppage_att_avg": "avg(cardio_five_stoppage_att) filter (where in_stop)",
    "career_cardio_observed_att_avg": "avg(cardio_observed_att) filter (where in_obs)",
    "last5_cardio_observed_att_avg": "avg(cardio_observed_att) filter (where ago_obs<=5)",
    "last3_cardio_r3_r1_att_avg": "avg(cardio_r3_r1_att) filter (where ago_c3<=3)",
    "last3_cardio_distance_att_avg": "avg(cardio_distance_att) filter (where ago_dist<=3)",
    "career_cardio_distance_landed_avg": "avg(cardio_distance_landed) filter (where in_dist)",
}
for _w, _t in (("career", "in_{0}"), ("last5", "ago_{0}<=5")):
    for _sub, _cols in (("c3", ("cardio_r3_r1_att", "cardio_r3_r1_landed")),
                        ("dist", ("cardio_distance_att", "cardio_consec_att"))):
        for _x in _cols:
            CARDIO_AGGS[f"{_w}_{_x}_avg"] = f"avg({_x}) filter (where {_t.format(_sub)})"
    for _x, _y in (("td", "late_td_landed"), ("kd", "late_kd"), ("ctrl", "late_ctrl_seconds")):
        CARDIO_AGGS[f"{_w}_late_{_x}_avg"] = f"avg({_y}) filter (where {_t.format('r3')})"
CARDIO = {n: (f"coalesce({n},0)" if "_n_" in n else n) for n in CARDIO_AGGS}
CARDIO_TRENDS = {f"trend_last5_vs_career_{s}": f"last5_{s}_avg - career_{s}_avg"
                 for s in ("cardio_r3_r1_att", "cardio_distance_att", "cardio_observed_att")}

cte("rates", ["history", "earlier"], feature_sql(RECORD_AGGS, RECORD | RATES))
cte("met", ["history", "rates"], """
select h.fighter_id, h.fight_id, h.rn, o.career_win_pct as opp_asof_win_pct,
 o.last5_win_pct as opp_asof_last5_win_pct, o.career_finish_rate as opp_asof_finish_rate,
 o.career_ko_rate as opp_asof_ko_rate, o.career_wins+o.career_losses as opp_asof_n_decided,
 o.career_wins+o.career_losses+o.career_draws+o.career_no_contests as opp_asof_n_fights,
 g.rn = 1 as opp_asof_debut
from history h join rates o on o.fight_id = h.fight_id and o.fighter_id = h.opponent_id
join history g on g.fight_id = h.fight_id and g.fighter_id = h.opponent_id""")
SOS = {}
for _w, _c in (("career", "true"), ("last5", "a.rn - p.rn <= 5")):
    for _x in ("win_pct", "last5_win_pct", "finish_rate"):
        SOS[f"{_w}_avg_opp_{_x}"] = f"avg(p.opp_asof_{_x}) filter (where {_c})"
    SOS[f"{_w}_n_opp_known"] = f"count(p.opp_asof_win_pct) filter (where {_c})"
SOS["career_avg_opp_n_fights"] = "avg(p.opp_asof_n_fights)"
SOS["last3_avg_opp_win_pct"] = "avg(p.opp_asof_win_pct) filter (where a.rn - p.rn <= 3)"
cte("sos", ["met"], "select a.fighter_id, a.fight_id, " + ", ".join(f"{e} as {n}" for n, e in SOS.items())
    + " from met a left join met p on p.fighter_id = a.fighter_id and p.rn < a.rn group by 1, 2")

ALL_AGGS = window_aggs(WINDOWS) | ACTIVITY_AGGS | CLASS_AGGS | CARDIO_AGGS
cte("features", ["history", "earlier", "rates", "met", "sos"], "select h.fighter_id, h.fight_id, h.opponent_id, "
    "h.event_date, h.is_fighter1, h.result, " + ", ".join(
        f"{e} as {n}" for n, e in (
            {n: n for n in window_aggs(WINDOWS)} | trend_exprs() | MIX | ACTIVITY | CLASS | CARDIO | CARDIO_TRENDS
        ).items())
    + ", " + ", ".join(f"r.{n}" for n in [*RECORD, *RATES])
    + ", o.* exclude (fighter_id, fight_id, rn), s.* exclude (fighter_id, fight_id)"
    + " from history h left join (select me, bout, " + ", ".join(f"{e} as {n}" for n, e in ALL_AGGS.items())
    + " from earlier group by 1, 2) e on e.me = h.fighter_id and e.bout = h.fight_id"
    + " join rates r on r.fighter_id = h.fighter_id and r.fight_id = h.fight_id"
    + " join met o on o.fighter_id = h.fighter_id and o.fight_id = h.fight_id"
    + " join sos s on s.fighter_id = h.fighter_id and s.fight_id = h.fight_id")

BODY = ["height", "reach", "ape_index"]
cte("body", ["fighter_bio"], "select *, reach - height as ape_index from fighter_bio")


def model_side(slot1, slot2, me, other, orientation):
    """One orientation of the training rows; ``me`` and ``other`` are the corner flags."""
    out = [f"ff.fight_id, ff.event_date, ff.weight_class_norm, ff.is_title, ff.is_women, ff.scheduled_rounds, "
           f"'{orientation}' as orientation, a.fighter_id as a_fighter_id, b.fighter_id as b_fighter_id"]
    for n in BODY:
        out.append(f"ba.{n} as a_{n}, bb.{n} as b_{n}, ba.{n} - bb.{n} as diff_{n}")
    out += [f"a.{n} as a_{n}, b.{n} as b_{n}" for n in FEATURE_COLS]
    out += [f"a.{n} - b.{n} as diff_{n}" for n in DIFF_COLS]
    out.append("ff.method_group as y_method_group, ff.outcome_type as y_outcome_type, ff.winner_id as y_winner_id")
    out.append("case when ff.winner_id = a.fighter_id then 1 when ff.winner_id = b.fighter_id then 0 end as y_a_win")
    out += [f"ca.{n} as y_a_{n}, cb.{n} as y_b_{n}" for n in LABEL_COLS]
    td = "a.career_td_attempted_pm_avg"
    out += [
        f"{td}*(1-b.career_td_defense_avg/100) as prod_expected_td_pm",
        f"{td}*(1-b.last5_td_defense_avg/100) as prod_expected_td_pm_vs_recent_def",
        "a.last5_td_attempted_pm_avg*(1-b.last5_td_defense_avg/100) as prod_last5_expected_td_pm",
        "a.career_sig_str_attempted_pm_avg*(1-b.career_strike_defense_avg/100) as prod_expected_sig_pm",
        "a.last5_sig_str_attempted_pm_avg*(1-b.last5_strike_defense_avg/100) as prod_last5_expected_sig_pm",
        "ba.reach*b.career_distance_pct_avg as prod_reach_x_opp_distance_pct",
        f"a.career_ground_pct_avg*{td} as prod_ground_x_td_att_pm",
    ]
    return ("select " + ", ".join(out) + " from fight_facts ff "
            f"join features a on a.fight_id = ff.fight_id and a.is_fighter1 = {me} "
            f"join features b on b.fight_id = ff.fight_id and b.is_fighter1 = {other} "
            "join corner_facts ca on ca.fight_id = ff.fight_id and ca.fighter_id = a.fighter_id "
            "join corner_facts cb on cb.fight_id = ff.fight_id and cb.fighter_id = b.fighter_id "
            "left join body ba on ba.fighter_id = a.fighter_id left join body bb on bb.fighter_id = b.fighter_id")


cte("model_train", ["fight_facts", "features", "corner_facts", "body"],
    model_side("f1", "f2", "true", "false", "page") + " union all "
    + model_side("f2", "f1", "false", "true", "swapped"))

CORNER_TEXT = ["fighter_id", "fight_id", "opponent_id", "is_fighter1", "event_date", "result", "is_valid_for_stats",
               "method_group", "final_round", "reached_round_3", "completed_round_3", "reached_round_5",
               "completed_round_5", "went_the_distance", "last_completed_round"]
CORNER_SHOWN = ", ".join(c if c in CORNER_TEXT else f"{r6(c)} as {c}" for c in CORNER_FACT_COLS)
assert set(OPPONENT_RATE_COLS) | set(CARDIO_FACT_COLS) <= set(CORNER_FACT_COLS)
