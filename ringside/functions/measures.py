"""Ratios, entropies and bout classification as column expressions.

Shares and accuracies run from 0 to 100, rates of wins from 0 to 1.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Method words, outcome words, weight-class wording and ranks.
NC_WORDS = ["overturned", "could not continue", "no contest"]
INVALID_GROUPS = ["NC", "DQ"]
CLASS_RANKS = {
    "Flyweight": 0, "Bantamweight": 1, "Featherweight": 2, "Lightweight": 3,
    "Welterweight": 4, "Middleweight": 5, "Light Heavyweight": 6, "Heavyweight": 7,
    "Women's Strawweight": 0, "Women's Flyweight": 1,
    "Women's Bantamweight": 2, "Women's Featherweight": 3,
}
WOMEN = r"(?i)women'?s"
CLASS_NOISE = [r"(?i)\s+bout\s*$", r"(?i)^UFC\s+", r"(?i)\s+title$"]
TOSSUP_PCT = 50.0
HIGH_CONF_PCT = 66.0
LOG2_OF_3 = math.log2(3.0)


def ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den)


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole)


def per_minute(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, amount / (seconds / 60.0))


def mean_of(values: list[Column]) -> Column:
    """Mean of the non-null ones, NULL if there is none."""
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    n = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    return F.when(n > 0, total / n)


def evenness(*parts: Column) -> Column:
    """Shannon entropy of three parts over log2(3): 0 one-sided, 1 even, NULL when all are empty."""
    sizes = [F.when(p > 0, p.cast("double")).otherwise(0.0) for p in parts]
    total = sizes[0] + sizes[1] + sizes[2]

    def term(size):
        p = size / total
        return F.when(size > 0, -p * F.log2(p)).otherwise(0.0)

    return F.when(total > 0, (term(sizes[0]) + term(sizes[1]) + term(sizes[2])) / LOG2_OF_3)


def method_group(method: Column, outcome: Column) -> Column:
    text = F.lower(F.trim(F.coalesce(method, F.lit(""))))
    ended = F.lower(F.trim(F.coalesce(outcome, F.lit(""))))
    voided = ended == "no_contest"
    for word in NC_WORDS:
        voided = voided | text.contains(word)
    return (
        F.when(voided, "NC")
        .when((text == "dq") | text.contains("disqual"), "DQ")
        .when(text.startswith("decision"), "DEC")
        .when(text.startswith("ko") | text.contains("tko") | text.contains("doctor"), "KO_TKO")
        .when(text.contains("submission"), "SUB")
        .otherwise("OTHER")
    )


def counts_for_stats(group: Column) -> Column:
    return ~group.isin(INVALID_GROUPS)


def class_name(raw: Column) -> Column:
    text = F.trim(raw)
    for noise in CLASS_NOISE:
        text = F.regexp_replace(text, noise, "")
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def is_title(raw: Column) -> Column:
    return F.coalesce(F.lower(raw).contains("title"), F.lit(False))


def is_women(raw: Column) -> Column:
    return F.coalesce(raw.rlike(WOMEN), F.lit(False))


def class_rank(name: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in CLASS_RANKS.items() for x in pair])
    return F.try_element_at(ranks, name)


def corner_result(fighter: Column, winner: Column, outcome: Column) -> Column:
    ended = F.lower(F.trim(F.coalesce(outcome, F.lit(""))))
    return (
        F.when(ended == "draw", "D")
        .when(ended == "no_contest", "NC")
        .when(fighter == winner, "W")
        .when(fighter != winner, "L")
    )


def known_result(result: Column) -> Column:
    text = F.upper(F.trim(result))
    return F.when(text.isin("W", "L", "D", "NC"), text)


def outcome_of(status1: Column, status2: Column) -> Column:
    """Bout outcome from the two corners' status letters."""
    pair = F.concat_ws("/", status1, status2)
    return (
        F.when(pair.isin("W/L", "L/W"), "decisive")
        .when(pair == "D/D", "draw")
        .when(pair == "NC/NC", "no_contest")
        .otherwise("unknown")
    )


def pick_of(p_a: Column) -> dict[str, Column]:
    """Pick, toss-up and confidence flags from the displayed one-decimal percents."""
    p = F.when(p_a.isNotNull(), F.least(F.greatest(p_a, F.lit(0.0)), F.lit(1.0)))
    q = 1.0 - p
    pct_a, pct_b = F.bround(p * 100.0, 1), F.bround(q * 100.0, 1)
    tossup = (pct_a == TOSSUP_PCT) | (pct_b == TOSSUP_PCT)
    return {
        "p_a": p,
        "p_b": q,
        "pick": F.when(tossup, "TOSSUP").when(pct_a > TOSSUP_PCT, "A").otherwise("B"),
        "is_tossup": tossup,
        "is_high_conf_66": ~tossup & (F.greatest(pct_a, pct_b) >= HIGH_CONF_PCT),
    }


def match_key(event_url, event_date, a_url, a_name, b_url, b_name) -> Column:
    """A key for a pairing that does not depend on which corner is named first."""
    from ringside.functions.parse import name_key, url_key

    a = F.coalesce(url_key(a_url), name_key(a_name))
    b = F.coalesce(url_key(b_url), name_key(b_name))
    when = F.coalesce(F.date_format(event_date, "yyyy-MM-dd"), F.lit("0001-01-01"))
    event = F.coalesce(url_key(event_url), F.lit(""))
    return F.concat_ws("|", event, when, F.least(a, b), F.greatest(a, b))


def show_percent(p: Column) -> Column:
    return F.when(p.isNull(), "n/a").otherwise(F.format_string("%.1f%%", 100.0 * p))


def show_number(x: Column, digits: int = 1) -> Column:
    return F.when(x.isNull(), "n/a").otherwise(F.format_string(f"%.{digits}f", x))


def show_clock(seconds: Column) -> Column:
    """Whole seconds as m:ss, negative readings shown as 0:00."""
    s = F.bround(F.greatest(seconds, F.lit(0.0)), 0).cast("long")
    shown = F.concat((F.floor(s / 60)).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))
    return F.when(seconds.isNull(), "n/a").otherwise(shown)


def show_hits(correct: Column, total: Column) -> Column:
    return F.when(F.coalesce(total, F.lit(0)) == 0, "n/a").otherwise(
        F.format_string("%.1f%%", 100.0 * correct / total)
    )
