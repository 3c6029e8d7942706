"""Output late in a bout against output early in it, aware of where the bout was cut short."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.functions import measures as m

# A round counts as complete from this many seconds of its slot on.
SLOT_SECONDS = 300.0
FULL_ROUND_SECONDS = 290.0


def _yes(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def _reached(n: int) -> Column:
    return F.col(f"r{n}_attempted").isNotNull() | F.col(f"r{n}_landed").isNotNull()


def _completed(n: int) -> Column:
    last, sec = F.col("final_round"), F.col("fight_seconds")
    full = (last == n) & (sec - (n - 1) * SLOT_SECONDS >= FULL_ROUND_SECONDS)
    return _yes(_reached(n) & ((last > n) | _yes(full)))


def last_completed_round(final_round: Column, seconds: Column) -> Column:
    in_last = seconds - (final_round - 1) * SLOT_SECONDS
    last = F.when(_yes(in_last >= FULL_ROUND_SECONDS), final_round).otherwise(final_round - 1)
    return F.when(last > 5, 5).when(last >= 1, last).cast("int")


def round_to_round(kind: str, five: Column) -> Column:
    """Mean of output ratios of neighbouring rounds; two pairs, or four in a five-rounder."""
    pairs = [m.ratio(F.col(f"r{n + 1}_{kind}"), F.col(f"r{n}_{kind}")) for n in range(1, 5)]
    return m.mean_of(pairs[:2] + [F.when(five, p) for p in pairs[2:]])


def with_cardio(rows: DataFrame) -> DataFrame:
    five = _yes(F.col("scheduled_rounds") == 5)
    flags = {
        "reached_round_3": _reached(3),
        "completed_round_3": _completed(3),
        "reached_round_5": _reached(5),
        "completed_round_5": _completed(5),
        "went_the_distance": F.when(five, _completed(5)).otherwise(_completed(3)),
        "last_completed_round": last_completed_round(F.col("final_round"), F.col("fight_seconds")),
    }
    rows = rows.withColumns(flags)

    went, last = F.col("went_the_distance"), F.col("last_completed_round")
    stopped_five = _yes(five & ~went & (last >= 3))
    out = {}
    for short, kind in (("att", "attempted"), ("landed", "landed")):
        first = F.col(f"r1_{kind}")
        r3 = F.when(F.col("reached_round_3"), m.ratio(F.col(f"r3_{kind}"), first))
        r5 = F.when(F.col("reached_round_5"), m.ratio(F.col(f"r5_{kind}"), first))
        whole = F.when(went, F.when(five, r5).otherwise(r3))
        outputs = F.array(*[F.col(f"r{n}_{kind}") for n in range(1, 6)])
        at_last = F.when(last >= 2, m.ratio(F.try_element_at(outputs, last), first))
        stopped = F.when(stopped_five, at_last)
        out |= {
            f"r1_sig_str_{kind}": first,
            f"r3_sig_str_{kind}": F.col(f"r3_{kind}"),
            f"r5_sig_str_{kind}": F.col(f"r5_{kind}"),
            f"cardio_r3_r1_{short}": r3,
            f"cardio_r5_r1_{short}": r5,
            f"cardio_distance_{short}": whole,
            f"cardio_consec_{short}": F.when(went, round_to_round(kind, five)),
            f"cardio_last_full_r1_{short}": at_last,
            f"cardio_five_stoppage_{short}": stopped,
            f"cardio_observed_{short}": F.when(went, whole).otherwise(stopped),
        }
    for cell, name in (
        ("td_landed", "late_td_landed"), ("td_attempted", "late_td_attempted"),
        ("kd", "late_kd"), ("ctrl_seconds", "late_ctrl_seconds"),
    ):
        out[name] = F.when(five & F.col("reached_round_5"), F.col(f"late4_{cell}")).when(
            ~five & F.col("reached_round_3"), F.col(f"late3_{cell}")
        )
    return rows.withColumns(out)
