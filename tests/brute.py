"""Slow row-by-row restatement of the pre-bout features, written apart from the engine."""

import math
from collections import defaultdict

from ringside.columns import STAT_COLS


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def evenness(parts):
    parts = [max(p or 0.0, 0.0) for p in parts]
    total = sum(parts)
    if total <= 0:
        return None
    return -sum(p / total * math.log2(p / total) for p in parts if p > 0) / math.log2(3)


def histories(rows):
    by_fighter = defaultdict(list)
    for r in rows:
        by_fighter[r["fighter_id"]].append(r)
    for line in by_fighter.values():
        line.sort(key=lambda r: (r["day_no"], r["fight_id"]))
    return by_fighter


RANKS = {"Flyweight": 0, "Lightweight": 3, "Welterweight": 4, "Heavyweight": 7, "Women's Strawweight": 0}


def mix(methods):
    known = [x for x in methods if x in ("KO_TKO", "SUB", "DEC")]
    if not known:
        return None, None, None, None
    n = len(known)
    counts = [known.count(g) for g in ("KO_TKO", "SUB", "DEC")]
    return counts[0] / n, counts[1] / n, counts[2] / n, evenness(counts)


def own(row, prior):
    valid = [p for p in prior if p["is_valid_for_stats"]]
    trailing = [p for p in prior if p["day_no"] >= row["day_no"] - 540]
    momentum = [p for p in trailing if p["is_valid_for_stats"]]
    out = {"debut_flag": not prior}
    gap = row["day_no"] - prior[-1]["day_no"] if prior else None
    out["days_since_last_fight"] = gap
    out["stale_flag"] = gap is not None and gap > 365
    out["fights_in_last_18mo"] = len(trailing)
    out["fights_in_last_24mo"] = sum(p["day_no"] >= row["day_no"] - 720 for p in prior)
    out["career_fights_count"] = len(valid)
    out["last3_fights_count"], out["last5_fights_count"] = min(len(valid), 3), min(len(valid), 5)
    sets = {"career": valid, "momentum": momentum, "last3": valid[-3:], "last5": valid[-5:]}
    for w, members in sets.items():
        if w != "career":
            out[f"used_career_fallback_{w}"] = not members
        for s in STAT_COLS:
            out[f"{w}_{s}_avg"] = mean([p[s] for p in (members or valid)])
    for a, b in (("last5", "career"), ("last3", "last5")):
        for s in STAT_COLS:
            x, y = out[f"{a}_{s}_avg"], out[f"{b}_{s}_avg"]
            out[f"trend_{a}_vs_{b}_{s}"] = None if x is None or y is None else x - y
    for w in ("career", "last5"):
        out[f"{w}_mix_entropy"] = evenness([out[f"{w}_{p}_pct_avg"] for p in ("distance", "clinch", "ground")])

    results = [p["result"] for p in prior]
    for letter, name in (("W", "wins"), ("L", "losses"), ("D", "draws"), ("NC", "no_contests")):
        out[f"career_{name}"] = results.count(letter)
    for n in (3, 5):
        out[f"last_{n}_wins"] = results[-n:].count("W")
        out[f"last_{n}_losses"] = results[-n:].count("L")
    for letter, name in (("W", "win_streak"), ("L", "loss_streak")):
        run = 0
        while run < len(results) and results[-1 - run] == letter:
            run += 1
        out[name] = run
    won = [p["method_group"] for p in prior if p["result"] == "W"]
    out["career_finish_rate"] = sum(g in ("KO_TKO", "SUB") for g in won) / len(won) if won else None
    out["career_decision_rate"] = won.count("DEC") / len(won) if won else None
    out["career_ko_rate"], out["career_sub_rate"], _, out["career_method_entropy"] = mix(won)
    recent = [p["method_group"] for p in prior[-5:] if p["result"] == "W"]
    (out["last5_ko_rate"], out["last5_sub_rate"], out["last5_decision_rate"],
     out["last5_method_entropy"]) = mix(recent)
    out["num_five_round_fights"] = sum(p["scheduled_rounds"] == 5 for p in prior)
    out["num_title_fights"] = sum(bool(p["is_title"]) for p in prior)
    out["avg_rounds_fought"] = mean([p["final_round"] for p in prior])
    for w, wins, losses in (
        ("career", out["career_wins"], out["career_losses"]),
        ("last5", out["last_5_wins"], out["last_5_losses"]),
    ):
        out[f"{w}_win_pct"] = wins / (wins + losses) if wins + losses else None

    here = row["weight_class_norm"]
    same = [p for p in prior if here is not None and p["weight_class_norm"] == here]
    out["n_prior_in_class"], out["first_time_in_class"] = len(same), not same
    last = prior[-1]["weight_class_norm"] if prior else None
    out["switched_class"] = bool(here and last and here != last)
    move = None
    if prior and here in RANKS and last in RANKS:
        move = (RANKS[here] > RANKS[last]) - (RANKS[here] < RANKS[last])
    out["class_move"] = move

    reached = [p for p in valid if p["reached_round_3"]]
    done = [p for p in valid if p["completed_round_3"]]
    dist = [p for p in valid if p["went_the_distance"]]
    stop = [p for p in valid if p["cardio_five_stoppage_att"] is not None]
    obs = [p for p in valid if p["cardio_observed_att"] is not None]
    get = lambda rows, c: mean([r[c] for r in rows])
    out["career_n_r3"], out["career_n_r3_complete"] = len(reached), len(done)
    out["last5_n_r3"], out["last5_n_r3_complete"] = len(reached[-5:]), len(done[-5:])
    out["last3_n_r3_complete"] = len(done[-3:])
    for short, col in (("td", "late_td_landed"), ("kd", "late_kd"), ("ctrl", "late_ctrl_seconds")):
        out[f"career_late_{short}_avg"] = get(reached, col)
        out[f"last5_late_{short}_avg"] = get(reached[-5:], col)
    for k in ("att", "landed"):
        out[f"career_cardio_r3_r1_{k}_avg"] = get(done, f"cardio_r3_r1_{k}")
        out[f"last5_cardio_r3_r1_{k}_avg"] = get(done[-5:], f"cardio_r3_r1_{k}")
        out[f"career_cardio_distance_{k}_avg"] = get(dist, f"cardio_distance_{k}")
    out["last3_cardio_r3_r1_att_avg"] = get(done[-3:], "cardio_r3_r1_att")
    out["career_n_distance"], out["last5_n_distance"] = len(dist), len(dist[-5:])
    out["last5_cardio_distance_att_avg"] = get(dist[-5:], "cardio_distance_att")
    out["last3_cardio_distance_att_avg"] = get(dist[-3:], "cardio_distance_att")
    out["career_cardio_consec_att_avg"] = get(dist, "cardio_consec_att")
    out["last5_cardio_consec_att_avg"] = get(dist[-5:], "cardio_consec_att")
    out["career_n_five_stoppage"] = len(stop)
    out["career_cardio_five_stoppage_att_avg"] = get(stop, "cardio_five_stoppage_att")
    out["career_n_observed"], out["last5_n_observed"] = len(obs), len(obs[-5:])
    out["career_cardio_observed_att_avg"] = get(obs, "cardio_observed_att")
    out["last5_cardio_observed_att_avg"] = get(obs[-5:], "cardio_observed_att")
    for s in ("cardio_r3_r1_att", "cardio_distance_att", "cardio_observed_att"):
        x, y = out[f"last5_{s}_avg"], out[f"career_{s}_avg"]
        out[f"trend_last5_vs_career_{s}"] = None if x is None or y is None else x - y
    return out


def features(rows):
    """{(fighter, bout): features} for history rows given as dicts."""
    lines = histories(rows)
    out = {}
    for fighter, line in lines.items():
        for i, row in enumerate(line):
            out[fighter, row["fight_id"]] = own(row, line[:i])
    for row in rows:
        mine = out[row["fighter_id"], row["fight_id"]]
        theirs = out.get((row["opponent_id"], row["fight_id"]))
        t = theirs or {}
        mine["opp_asof_win_pct"] = t.get("career_win_pct")
        mine["opp_asof_last5_win_pct"] = t.get("last5_win_pct")
        mine["opp_asof_finish_rate"] = t.get("career_finish_rate")
        mine["opp_asof_ko_rate"] = t.get("career_ko_rate")
        mine["opp_asof_n_decided"] = t.get("career_wins", 0) + t.get("career_losses", 0)
        mine["opp_asof_n_fights"] = (
            mine["opp_asof_n_decided"] + t.get("career_draws", 0) + t.get("career_no_contests", 0)
        )
        mine["opp_asof_debut"] = bool(t.get("debut_flag", False))
    for fighter, line in lines.items():
        past = []
        for row in line:
            mine = out[fighter, row["fight_id"]]
            for n, w in ((None, "career"), (5, "last5"), (3, "last3")):
                seen = past if n is None else past[-n:]
                mine[f"{w}_avg_opp_win_pct"] = mean([p["opp_asof_win_pct"] for p in seen])
                mine[f"{w}_avg_opp_last5_win_pct"] = mean([p["opp_asof_last5_win_pct"] for p in seen])
                mine[f"{w}_avg_opp_finish_rate"] = mean([p["opp_asof_finish_rate"] for p in seen])
                mine[f"{w}_avg_opp_n_fights"] = mean([p["opp_asof_n_fights"] for p in seen])
                mine[f"{w}_n_opp_known"] = sum(p["opp_asof_win_pct"] is not None for p in seen)
            past.append(mine)
    return out
