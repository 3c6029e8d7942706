"""Quality of predictions as aggregates; every function is one pass over the rows."""

import math
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringside.session import cut

# Clipping, calibration edges, confidence limits, weights and baseline odds.
CLIP = 1e-6
EDGES = [0.0, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.80, 1.01]
CONF_GAP, HIGH_CONF = 0.10, 0.66
MIN_CONF_ROWS, MIN_HIGH_ROWS = 20, 10
VETERAN_BOUTS = 5
THIN_WEIGHT, DEBUT_WEIGHT = 0.55, 0.35
FAVOURITE_P, UNDERDOG_P = 0.62, 0.38


@dataclass(frozen=True)
class Eras:
    fit: date = date(2015, 1, 1)
    val: date = date(2024, 1, 1)
    test: date = date(2025, 1, 1)

    def name(self, day: Column, before: str = "pre-fit") -> Column:
        return (
            F.when(day < F.lit(self.fit), before)
            .when(day < F.lit(self.val), "FIT")
            .when(day < F.lit(self.test), "VAL")
            .otherwise("TEST")
        )

    def slice(self, rows: DataFrame, era: str) -> DataFrame:
        d = F.col("event_date")
        cond = {
            "FIT": (d >= F.lit(self.fit)) & (d < F.lit(self.val)),
            "VAL": (d >= F.lit(self.val)) & (d < F.lit(self.test)),
            "TEST": d >= F.lit(self.test),
        }[era]
        return rows.filter(cond)


def era_summary(rows: DataFrame, eras: Eras) -> DataFrame:
    return rows.groupBy(eras.name(F.col("event_date")).alias("era")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("fight_id").alias("n_fights"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def page_only(rows: DataFrame) -> DataFrame:
    return rows.filter("orientation = 'page'") if "orientation" in rows.columns else rows


def _or(name, default, rows) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in rows.columns else F.lit(default)


def sample_weight(rows: DataFrame) -> Column:
    """Debuts count least, thin histories less; only while learning."""
    least = F.least(_or("a_career_fights_count", 0, rows), _or("b_career_fights_count", 0, rows))
    debut = _or("a_debut_flag", False, rows) | _or("b_debut_flag", False, rows)
    thin = (least < VETERAN_BOUTS) | (_or("a_career_n_opp_known", 0, rows) == 0)
    return F.when(debut, DEBUT_WEIGHT).when(thin, THIN_WEIGHT).otherwise(1.0)


def both_veterans(rows: DataFrame) -> Column:
    counts = [_or(f"{s}_career_fights_count", 0, rows) >= VETERAN_BOUTS for s in "ab"]
    return ~_or("a_debut_flag", False, rows) & ~_or("b_debut_flag", False, rows) & counts[0] & counts[1]


def clipped(p: Column) -> Column:
    return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP)))


def log_loss(y: Column, p: Column) -> Column:
    q = clipped(p)
    return F.avg(-F.when(y == 1, F.ln(q)).otherwise(F.ln(1 - q)))


def accuracy(y: Column, p: Column, where: Column | None = None) -> Column:
    hit = ((p >= 0.5).cast("int") == y).cast("double")
    return F.avg(hit if where is None else F.when(where, hit))


def brier(y: Column, p: Column) -> Column:
    q = clipped(p)
    return F.avg((q - y) * (q - y))


def win_scores(rows: DataFrame, p: str = "p", y: str = "y_a_win") -> DataFrame:
    """Loss, accuracy, Brier and the confidence slices on labelled page rows."""
    page = page_only(rows).filter(F.col(y).isNotNull())
    label, q = F.col(y), clipped(F.col(p))
    sure = F.abs(q - 0.5) >= CONF_GAP
    high = (q >= HIGH_CONF) | (q <= 1 - HIGH_CONF)
    out = page.agg(
        F.count(F.lit(1)).alias("n"),
        log_loss(label, q).alias("logloss"),
        accuracy(label, q).alias("acc"),
        brier(label, q).alias("brier"),
        F.count_if(sure).alias("n_conf"),
        accuracy(label, q, sure).alias("acc_conf"),
        F.count_if(high).alias("n_66"),
        accuracy(label, q, high).alias("acc_66"),
    )
    return out.withColumns(
        {
            "acc_conf": F.when(F.col("n_conf") >= MIN_CONF_ROWS, F.col("acc_conf")),
            "acc_66": F.when(F.col("n_66") >= MIN_HIGH_ROWS, F.col("acc_66")),
        }
    )


def win_baselines(rows: DataFrame, p: str = "p", y: str = "y_a_win") -> DataFrame:
    """The model next to a coin flip and "the higher career win share wins", whole and veterans only."""
    page = page_only(rows).filter(F.col(y).isNotNull())
    label, vet = F.col(y), both_veterans(page)
    a, b = F.col("a_career_win_pct"), F.col("b_career_win_pct")
    known = a.isNotNull() & b.isNotNull()
    favourite = F.when(known & (a > b), FAVOURITE_P).when(known, UNDERDOG_P).otherwise(0.5)
    picked = F.when(known & (a > b), 1).otherwise(0)
    model = F.col(p)
    return page.agg(
        F.count(F.lit(1)).alias("n_test"),
        log_loss(label, F.lit(0.5)).alias("coin_logloss"),
        log_loss(label, favourite).alias("fav_logloss"),
        F.avg((picked == label).cast("double")).alias("fav_acc"),
        log_loss(label, model).alias("logloss"),
        accuracy(label, model).alias("acc"),
        brier(label, model).alias("brier"),
        F.count_if(vet).alias("veteran_n"),
        log_loss(label, F.when(vet, model)).alias("veteran_logloss"),
        accuracy(label, model, vet).alias("veteran_acc"),
    )


def calibration(rows: DataFrame, p: str = "p", y: str = "y_a_win") -> DataFrame:
    """Mean prediction against actual rate in uneven, left-closed bins."""
    q = clipped(F.col(p))
    low = F.lit(None).cast("double")
    for lo, hi in zip(EDGES, EDGES[1:]):
        low = F.when((q >= lo) & (q < hi), F.lit(lo)).otherwise(low)
    labelled = rows.filter(F.col(y).isNotNull())
    return labelled.groupBy(low.alias("bin_low")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(q).alias("mean_pred"), F.avg(F.col(y).cast("double")).alias("actual")
    )


def absolute_error(rows: DataFrame, pred: str, actual: str, base: str, fill: Column | float, floor=None) -> DataFrame:
    """MAE of a prediction and of a baseline column whose gaps take ``fill``."""
    used = rows.filter(F.col(pred).isNotNull() & F.col(actual).isNotNull())
    guess = F.col(pred) if floor is None else F.greatest(F.col(pred), F.lit(floor))
    stand = F.coalesce(F.col(base).cast("double"), fill if isinstance(fill, Column) else F.lit(float(fill)))
    return used.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(F.col(actual) - guess)).alias("mae"),
        F.avg(F.abs(F.col(actual) - stand)).alias("baseline_mae"),
    )


def exact_percentile(rows: DataFrame, value: Column, p: float) -> float | None:
    """Exact percentile with linear interpolation; see exact_percentiles."""
    return exact_percentiles(rows, {"p": (value, p)})["p"]


def exact_percentiles(rows: DataFrame, wanted: dict[str, tuple[Column, float]]) -> dict[str, float | None]:
    """Exact percentiles of any number of values at once, with linear interpolation, the same way at any size.

    One table of ranges serves all ranks: equal values of a column are counted together, the distinct ones
    range-partitioned by (column, value) and written once. The counts per range say which ranges hold the wanted ranks; a
    running count inside these ranges alone finds all values in one job.
    """
    columns: dict[str, int] = {}
    places = {name: columns.setdefault(str(value), len(columns)) for name, (value, _) in wanted.items()}
    values = {places[name]: value for name, (value, _) in wanted.items()}
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("c"), v.cast("double").alias("v")) for c, v in values.items()]))
    counted = rows.select(each).filter("v is not null").groupBy("c", "v").count()
    ranged = cut(counted.repartitionByRange("c", "v").withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("c", "part").agg(F.sum("count").alias("n")).orderBy("part").collect()  # one row per range and column
    spots = {}
    for name, (_, p) in wanted.items():
        own = [r for r in sizes if r["c"] == places[name]]
        want = p * (sum(r["n"] for r in own) - 1)
        if own:
            spots[name] = [_spot(own, rank) for rank in (math.floor(want), math.ceil(want))], want - math.floor(want)
    if not spots:
        return dict.fromkeys(wanted)
    upto = F.sum("count").over(Window.partitionBy("c", "part").orderBy("v"))
    parts = sorted({(c, part) for two, _ in spots.values() for c, part, _ in two})
    held = [(F.col("c") == c) & (F.col("part") == part) for c, part in parts]
    inside = ranged.filter(reduce(lambda a, b: a | b, held)).withColumn("upto", upto)
    found = inside.agg(*[F.min(F.when((F.col("c") == c) & (F.col("part") == part) & (F.col("upto") > rest), F.col("v"))).alias(f"{i}_{name}")
                         for name, (two, _) in spots.items() for i, (c, part, rest) in enumerate(two)]).first()
    out = dict.fromkeys(wanted)
    for name, (_, share) in spots.items():
        low, high = found[f"0_{name}"], found[f"1_{name}"]
        out[name] = low if low == high else low + (high - low) * share
    return out


def _spot(sizes: list, rank: int) -> tuple[int, int, int]:
    """Column and range that hold a rank, and the rank inside the range."""
    for r in sizes:
        if rank < r["n"]:
            return r["c"], r["part"], rank
        rank -= r["n"]
    raise ValueError("a rank beyond the rows")
