"""One row per bout with both corners' features, and its mirrored form for training."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.columns import DIFF_COLS, EXPECTED_RATES, FEATURE_COLS, LABEL_COLS

BODY = ["height", "reach", "ape_index"]
BOUT = ["weight_class_norm", "is_title", "is_women", "scheduled_rounds"]
SHARED_LABELS = ["y_method_group", "y_outcome_type", "y_winner_id"]


PRODUCT_PARTS = {name: [attack, defense] for name, attack, defense in EXPECTED_RATES} | {
    "prod_reach_x_opp_distance_pct": ["reach", "career_distance_pct_avg"],
    "prod_ground_x_td_att_pm": ["career_ground_pct_avg", "career_td_attempted_pm_avg"],
}


def features_behind(cols) -> list[str]:
    """The features that columns of the training rows are made of."""
    names = {re.sub("^(a|b|diff)_", "", c) for c in cols} | {p for c in cols for p in PRODUCT_PARTS.get(c, [])}
    return [c for c in FEATURE_COLS if c in names]


def _prefixed(rows: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    return rows.select("fight_id", *[F.col(c).alias(f"{prefix}{c}") for c in cols])


def _bodies(features: DataFrame, bio: DataFrame) -> DataFrame:
    """(fight_id, f1_height, ..., f2_ape_index): body data meets the corners as ids, before anything wide does."""
    body = bio.select("fighter_id", "height", "reach", (F.col("reach") - F.col("height")).alias("ape_index"))
    ids = features.select("fight_id", "fighter_id", "is_fighter1").join(body, "fighter_id", "left")
    sides = {1: F.col("is_fighter1"), 2: ~F.col("is_fighter1")}
    return ids.groupBy("fight_id").agg(*[F.max(F.when(on, F.col(c))).alias(f"f{n}_{c}") for n, on in sides.items() for c in BODY])


def paired(features: DataFrame, bio: DataFrame, beside: DataFrame | None = None) -> DataFrame:
    """Both corners side by side in page order, with body data and differences of the features there are.

    Wide rows meet by bout only; where the features are stored in buckets of the bout, they are not exchanged at all.
    beside: narrow rows of the bouts. All that is narrow meets first, and one side's features after it: every join copies
    whole rows, and so two of them do, not one for each table.
    """
    have = set(features.columns)
    made = [c for c in FEATURE_COLS if c in have]
    f1 = _prefixed(features.filter("is_fighter1"), ["fighter_id", "event_date", *made], "f1_").withColumnRenamed("f1_event_date", "event_date")
    f2 = _prefixed(features.filter("not is_fighter1"), ["fighter_id", *made], "f2_")
    bodies = _bodies(features, bio)
    narrow = bodies if beside is None else bodies.join(beside, "fight_id")
    diffs = [(F.col(f"f1_{c}") - F.col(f"f2_{c}")).alias(f"diff_{c}") for c in BODY + DIFF_COLS if c in BODY or c in have]
    shown = list(dict.fromkeys([*f1.columns, *f2.columns, *bodies.columns]))
    more = [c for c in narrow.columns if c not in bodies.columns]
    return f1.join(f2.join(narrow, "fight_id"), "fight_id").select(*shown, *diffs, *more)


def model_rows(features: DataFrame, facts: DataFrame, corners: DataFrame, bio: DataFrame) -> DataFrame:
    """Pre-bout features of both corners plus this bout's outcome as labels."""
    bout = facts.select(
        "fight_id",
        *BOUT,
        F.col("method_group").alias("y_method_group"),
        F.col("outcome_type").alias("y_outcome_type"),
        F.col("winner_id").alias("y_winner_id"),
    )
    labels = ["result", *LABEL_COLS]
    y1 = _prefixed(corners.filter("is_fighter1"), labels, "y_f1_")
    y2 = _prefixed(corners.filter("not is_fighter1"), labels, "y_f2_")
    rows = paired(features, bio, bout.join(y1, "fight_id").join(y2, "fight_id"))
    won = F.when(F.col("y_winner_id") == F.col("f1_fighter_id"), 1).when(
        F.col("y_winner_id") == F.col("f2_fighter_id"), 0
    )
    return rows.select("*", won.alias("y_fighter1_win"))


def products(a: str, b: str) -> dict:
    """Matchup terms: what one side attempts, thinned by what the other side lets through."""
    out = {
        name: F.col(f"{a}_{attack}") * (1.0 - F.col(f"{b}_{defense}") / 100.0) for name, attack, defense in EXPECTED_RATES
    }
    out["prod_reach_x_opp_distance_pct"] = F.col(f"{a}_reach") * F.col(f"{b}_career_distance_pct_avg")
    out["prod_ground_x_td_att_pm"] = F.col(f"{a}_career_ground_pct_avg") * F.col(f"{a}_career_td_attempted_pm_avg")
    return {name: term.alias(name) for name, term in out.items()}


def mirrored(rows: DataFrame) -> DataFrame:
    """Each bout twice, corners swapped the second time, from one pass over the rows.

    Slot A and B are then exchangeable: differences change sign, the label flips,
    and an undecided bout keeps its missing label. Each column is an expression of
    its own, so that what a query does not read is not worked out either.
    """
    c, swapped, have = F.col, F.col("__swapped"), set(rows.columns)

    def slot(this, other):
        return F.when(swapped, c(other)).otherwise(c(this))

    cols = ["fight_id", "event_date", *BOUT, F.when(swapped, "swapped").otherwise("page").alias("orientation")]
    for name in [n for n in ["fighter_id", *BODY, *FEATURE_COLS] if f"f1_{n}" in have]:
        cols += [slot(f"f1_{name}", f"f2_{name}").alias(f"a_{name}"), slot(f"f2_{name}", f"f1_{name}").alias(f"b_{name}")]
    cols += [F.when(swapped, -c(f"diff_{name}")).otherwise(c(f"diff_{name}")).alias(f"diff_{name}") for name in BODY + DIFF_COLS
             if f"diff_{name}" in have]
    if "y_fighter1_win" in have:
        win = c("y_fighter1_win")
        cols += [*SHARED_LABELS, F.when(swapped, 1 - win).otherwise(win).alias("y_a_win")]
        for name in LABEL_COLS:
            cols += [slot(f"y_f1_{name}", f"y_f2_{name}").alias(f"y_a_{name}"), slot(f"y_f2_{name}", f"y_f1_{name}").alias(f"y_b_{name}")]
    both = rows.withColumn("__swapped", F.explode(F.array(F.lit(False), F.lit(True))))
    known = [name for name, parts in PRODUCT_PARTS.items() if all(f"f1_{p}" in have for p in parts)]
    return both.select(*cols).select("*", *[p for name, p in products("a", "b").items() if name in known])
