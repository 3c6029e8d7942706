"""Text cells to numbers, as column expressions. Unknown is always NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "no reading", and the cell patterns.
NO_READING = ["", "---", "--", "nan"]
X_OF_Y = r"(?i)(\d+)\s*of\s*(\d+)"
SIGNED_INT = r"(-?\d+)"
SIGNED_DECIMAL = r"(-?\d+(?:\.\d+)?)"
ROUNDS = r"(?i)(\d+)\s*rnd"
SLOT_LIST = r"\(([^)]+)\)"
SLOT = r"^\d+(\.\d+)?$"


def _group(text: Column, pattern: str, index: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


def _reading(cell: Column) -> Column:
    text = F.trim(cell)
    return F.when(~text.isin(NO_READING), text)


def landed(cell: Column) -> Column:
    """The 24 of "24 of 66"."""
    return _group(cell, X_OF_Y, 1).try_cast("double")


def attempted(cell: Column) -> Column:
    """The 66 of "24 of 66"."""
    return _group(cell, X_OF_Y, 2).try_cast("double")


def percent(cell: Column) -> Column:
    return _group(_reading(cell), SIGNED_DECIMAL).try_cast("double")


def count(cell: Column) -> Column:
    return _group(F.regexp_replace(_reading(cell), ",", ""), SIGNED_INT).try_cast("double")


def clock_seconds(cell: Column) -> Column:
    """M:SS or H:MM:SS in seconds; a cell without a colon is taken as seconds."""
    text = _reading(cell)
    parts = F.transform(F.split(text, ":"), lambda p: F.trim(p).try_cast("double"))
    h, m, s = (F.try_element_at(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(~text.contains(":"), _group(text, SIGNED_DECIMAL).try_cast("double"))
        .when(F.size(parts) == 2, h * 60.0 + m)
        .when(F.size(parts) == 3, h * 3600.0 + m * 60.0 + s)
    )


def bio_int(cell: Column) -> Column:
    return _group(F.regexp_replace(F.trim(cell), ",", ""), SIGNED_INT).try_cast("int")


def bio_float(cell: Column) -> Column:
    return _group(F.regexp_replace(F.trim(cell), "[,%]", ""), SIGNED_DECIMAL).try_cast("double")


def bio_clock(cell: Column) -> Column:
    """Like clock_seconds, but any other number of parts falls back to the first number."""
    text = F.trim(cell)
    parts = F.transform(F.split(text, ":"), lambda p: F.trim(p).try_cast("double"))
    bad = F.exists(parts, lambda p: p.isNull())
    h, m, s = (F.try_element_at(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(text.contains(":") & bad, F.lit(None).cast("double"))
        .when(F.size(parts) == 2, h * 60.0 + m)
        .when(F.size(parts) == 3, h * 3600.0 + m * 60.0 + s)
        .otherwise(bio_float(cell))
    )


def _has_limit(fmt: Column) -> Column:
    return ~F.lower(fmt).contains("no time limit")


def scheduled_rounds(fmt: Column) -> Column:
    return F.when(_has_limit(fmt), _group(fmt, ROUNDS).try_cast("int"))


def round_minutes(fmt: Column) -> Column:
    """Minutes of each slot; an empty array when the format names none."""
    slots = F.transform(F.split(F.regexp_extract(fmt, SLOT_LIST, 1), "-"), lambda p: F.trim(p))
    minutes = F.transform(F.filter(slots, lambda p: p.rlike(SLOT)), lambda p: p.try_cast("double"))
    none = F.array().cast("array<double>")
    return F.coalesce(F.when(_has_limit(fmt), minutes), none)


def bout_seconds(final_round: Column, clock: Column, fmt: Column) -> Column:
    """Full slots before the final round plus the clock in it; slots default to 5 minutes."""
    seconds = clock_seconds(clock)
    rounds = final_round.cast("int")
    minutes = round_minutes(fmt)
    before = F.aggregate(
        F.sequence(F.lit(1), F.greatest(rounds - 1, F.lit(1))),
        F.lit(0.0),
        lambda total, slot: total + 60.0 * F.coalesce(F.try_element_at(minutes, slot), F.lit(5.0)),
    )
    return (
        F.when(rounds.isNull() | (rounds <= 1), seconds)
        .when(seconds.isNull(), F.when(before > 0, before))
        .otherwise(before + seconds)
    )


def json_or_null(text: Column, schema: str) -> Column:
    """Parsed JSON, or NULL for text that is not JSON."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def strike_cell(raw_round: Column, side: int, part: str) -> Column:
    """One corner's cell (distance, head, ...) inside a round's stored JSON."""
    return F.get_json_object(raw_round, f"$.significant_strikes.fighter{side}.{part}")


def strikes_of(raw_round: Column, side: int) -> Column:
    """One corner's cells inside a round's stored JSON, as JSON of their own."""
    return F.get_json_object(raw_round, f"$.significant_strikes.fighter{side}")


def text_for_cells(raw_round: Column) -> Column:
    """Whether the JSON has a text in the place of the corners or of their cells; such a text is not read as JSON."""
    return F.coalesce(raw_round.rlike(r'"(significant_strikes|fighter[12])"\s*:\s*"'), F.lit(False))


def url_key(url: Column) -> Column:
    text = F.regexp_replace(F.trim(url), "https://", "http://")
    return F.nullif(F.regexp_replace(text, "/+$", ""), F.lit(""))


def name_key(name: Column) -> Column:
    """Lower case with single blanks; the empty string when there is no name."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " ")))


def day(text: Column, fallback: Column | None = None) -> Column:
    """An ISO prefix or a 'June 3, 2024' text as a date, else the fallback."""
    t = F.trim(text)
    found = F.coalesce(
        F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"), F.try_to_date(t, "MMMM d, yyyy")
    )
    return found if fallback is None else F.coalesce(found, fallback)


def positive_id(value: Column) -> Column:
    number = value.try_cast("long")
    return F.when(number > 0, number)
