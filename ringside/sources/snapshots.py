"""Bio and career-snapshot cells of a fighter page, parsed into typed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.functions import parse

# Fixed values: (column, key in the scraped mapping, kind of cell).
SNAPSHOT_CELLS = [
    ("sig_strikes_landed", "Sig. Strikes Landed", "int"),
    ("sig_strikes_attempted", "Sig. Strikes Attempted", "int"),
    ("takedowns_landed", "Takedowns Landed", "int"),
    ("takedowns_attempted", "Takedowns Attempted", "int"),
    ("sig_strikes_landed_per_min", "Sig. Str. LandedPer Min", "float"),
    ("sig_strikes_absorbed_per_min", "Sig. Str. AbsorbedPer Min", "float"),
    ("takedown_avg_per_15_min", "Takedown avgPer 15 Min", "float"),
    ("submission_avg_per_15_min", "Submission avgPer 15 Min", "float"),
    ("sig_strikes_defense", "Sig. Str. Defense", "float"),
    ("takedown_defense", "Takedown Defense", "float"),
    ("knockdown_avg", "Knockdown Avg", "float"),
    ("average_fight_time", "Average fight time", "clock"),
]
MIX_NAMES = [
    ("standing", "standing"), ("clinch", "clinch"), ("ground", "ground"),
    ("head", "head"), ("body", "body"), ("leg", "leg"),
    ("ko", "ko/tko"), ("dec", "dec"), ("sub", "sub"),
]
BIO_CELLS = [
    ("status", "text"), ("place_of_birth", "text"), ("trains_at", "text"), ("fighting_style", "text"),
    ("age", "int"), ("height", "float"), ("weight", "float"), ("reach", "int"), ("leg_reach", "float"),
    ("octagon_debut", "day"),
]

CELLS = SNAPSHOT_CELLS + [
    (f"{col}_{what}", f"{key}_{what}", kind)
    for col, key in MIX_NAMES
    for what, kind in (("count", "int"), ("percent", "float"))
]

READERS = {
    "int": parse.bio_int,
    "float": parse.bio_float,
    "clock": parse.bio_clock,
    "day": parse.day,
    "text": lambda cell: cell,
}


def performance_stats(pages: DataFrame, stats: str = "stats") -> DataFrame:
    """fighter_id plus a text map of scraped cells, to 30 numeric columns."""
    return pages.select(
        "fighter_id",
        *[READERS[kind](F.try_element_at(F.col(stats), F.lit(key))).alias(col) for col, key, kind in CELLS],
    )


def bio(pages: DataFrame, cells: str = "bio") -> DataFrame:
    """fighter_id plus a text map of bio cells, to typed columns and the archived JSON."""
    typed = [READERS[kind](F.try_element_at(F.col(cells), F.lit(col))).alias(col) for col, kind in BIO_CELLS]
    return pages.select("fighter_id", *typed, F.to_json(cells).alias("raw_bio"))
