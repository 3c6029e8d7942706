"""Upcoming bouts scored as of their date, without touching the stored history."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.functions import measures as m
from ringside.functions import parse
from ringside.operators import history, model_rows

# Where ids of unknown fighters start.
FIRST_UNKNOWN_ID = -1000
# The order of bouts on a day has one digit more than a bout id, so that upcoming bouts come after any id.
DAY_ORDER = "decimal(20,0)"
AFTER_HISTORY = Decimal(2**63)


def resolve_card(bouts: DataFrame, fighters: DataFrame) -> DataFrame:
    """Fighter ids by URL, then by a name only one fighter has, else a negative id.

    ``bouts``: bout_no, fighter_{a,b}_{name,url}, weight_class_raw, is_main.
    """
    urls = fighters.select(parse.url_key(F.col("fighter_url")).alias("k"), "fighter_id").filter("k is not null")
    urls = urls.groupBy("k").agg(F.max("fighter_id").alias("by_url"))
    names = fighters.select(F.lower(F.trim("fighter_name")).alias("k"), "fighter_id").filter("k <> ''")
    names = names.groupBy("k").agg(F.min("fighter_id").alias("by_name"), F.count(F.lit(1)).alias("n"))
    names = names.filter("n = 1").drop("n")
    rows = bouts
    for i, s in enumerate("ab"):
        u = urls.withColumnsRenamed({"k": f"u_{s}", "by_url": f"by_url_{s}"})
        n = names.withColumnsRenamed({"k": f"n_{s}", "by_name": f"by_name_{s}"})
        rows = rows.withColumn(f"u_{s}", parse.url_key(F.col(f"fighter_{s}_url")))
        rows = rows.withColumn(f"n_{s}", F.lower(F.trim(f"fighter_{s}_name")))
        rows = rows.join(u, f"u_{s}", "left").join(n, f"n_{s}", "left")
        unknown = F.lit(FIRST_UNKNOWN_ID) - (F.col("bout_no") * 2 + i)
        found = F.coalesce(F.col(f"by_url_{s}"), F.col(f"by_name_{s}"))
        rows = rows.withColumn(f"fighter_{s}_id", F.coalesce(found.cast("long"), unknown.cast("long")))
        rows = rows.withColumn(f"{s}_missing", found.isNull()).drop(f"u_{s}", f"n_{s}", f"by_url_{s}", f"by_name_{s}")
    main = F.coalesce(F.col("is_main"), F.lit(False))
    raw = F.col("weight_class_raw")
    raw = F.when(main & ~F.lower(raw).contains("title"), F.concat(raw, F.lit(" Bout"))).otherwise(raw)
    return rows.withColumns(
        {
            "weight_class_norm": m.class_name(raw),
            "is_title": m.is_title(raw),
            "is_women": m.is_women(raw),
            "scheduled_rounds": F.when(main | m.is_title(raw), 5).otherwise(3),
            "fight_id": (-(F.col("bout_no") + 1)).cast("long"),
        }
    )


def relevant_history(rows: DataFrame, card: DataFrame) -> DataFrame:
    """History of the card's fighters and of everyone they have met.

    Schedule strength looks at the opponents' records as of past bouts, so the
    opponents' own histories are needed too; nobody else's is.
    """
    pair = F.array("fighter_a_id", "fighter_b_id")
    named = card.select(F.explode(pair).alias("fighter_id")).distinct()
    met = rows.join(named, "fighter_id", "left_semi").select(F.col("opponent_id").alias("fighter_id"))
    return rows.join(named.unionByName(met).distinct(), "fighter_id", "left_semi")


def with_upcoming(rows: DataFrame, card: DataFrame, event_date: Column) -> DataFrame:
    """Two synthetic rows per upcoming bout, not valid for statistics, last on their day."""

    def corner(me, other, first):
        return F.struct(
            F.col(f"fighter_{me}_id").alias("fighter_id"),
            F.col(f"fighter_{other}_id").alias("opponent_id"),
            F.lit(first).alias("is_fighter1"),
        )

    dated = card.withColumn("event_date", event_date)
    no = F.lit(False)
    extra = dated.select(
        "fight_id", "event_date", "weight_class_norm", "is_title", "scheduled_rounds",
        F.unix_date("event_date").alias("day_no"),
        (F.lit(AFTER_HISTORY) + F.col("bout_no")).cast(DAY_ORDER).alias("bout_order"),
        *[no.alias(c) for c in ("is_valid_for_stats", "reached_round_3", "completed_round_3", "went_the_distance")],
        F.inline(F.array(corner("a", "b", True), corner("b", "a", False))),
    )
    past = rows.withColumn("bout_order", F.col("bout_order").cast(DAY_ORDER))
    return past.unionByName(extra, allowMissingColumns=True)


def card_features(rows: DataFrame, card: DataFrame, event_date: Column) -> DataFrame:
    """Pre-bout features of both corners of every upcoming bout."""
    combined = with_upcoming(relevant_history(rows, card), card, event_date)
    return history.build_features(combined).filter("fight_id < 0")


def card_rows(features: DataFrame, card: DataFrame, bio: DataFrame) -> DataFrame:
    """Both orientations of every upcoming bout in the shape of the training rows."""
    rows = model_rows.paired(features, bio).join(card.select("fight_id", *model_rows.BOUT), "fight_id")
    return model_rows.mirrored(rows)


def symmetric(scored: DataFrame) -> DataFrame:
    """One row per bout: the win probability averaged over both corner orders.

    ``scored``: fight_id, orientation, p, slpm, td, ctrl, each for slot A.
    """

    def at(orientation, c):
        return F.max(F.when(F.col("orientation") == orientation, F.col(c)))

    p_a = 0.5 * (at("page", "p") + 1.0 - at("swapped", "p"))
    out = [p_a.alias("p_a"), (1.0 - p_a).alias("p_b")]
    for c, floor in (("slpm", False), ("td", True), ("ctrl", True)):
        for s, orientation in (("a", "page"), ("b", "swapped")):
            v = at(orientation, c)
            out.append((F.when(v.isNotNull(), F.greatest(v, F.lit(0.0))) if floor else v).alias(f"{c}_{s}"))
    return scored.groupBy("fight_id").agg(*out)


def card_lines(predictions: DataFrame) -> DataFrame:
    """Display texts of predicted bouts."""
    c = F.col
    return predictions.withColumns(
        {f"show_p_{s}": m.show_percent(c(f"p_{s}")) for s in "ab"}
        | {f"show_slpm_{s}": m.show_number(c(f"slpm_{s}")) for s in "ab"}
        | {f"show_td_{s}": m.show_number(c(f"td_{s}")) for s in "ab"}
        | {f"show_ctrl_{s}": m.show_clock(c(f"ctrl_{s}")) for s in "ab"}
    )


def single_bout(spark, a_name, b_name, a_url=None, b_url=None, weight_class=None, is_main=False) -> DataFrame:
    """A card of one bout, for a question about two fighters as of a date."""
    schema = (
        "bout_no int, fighter_a_name string, fighter_a_url string, fighter_b_name string, "
        "fighter_b_url string, weight_class_raw string, is_main boolean"
    )
    return spark.createDataFrame([(0, a_name, a_url, b_name, b_url, weight_class, is_main)], schema)
