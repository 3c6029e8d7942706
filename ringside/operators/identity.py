"""Who is who in a load, as inserting its people one after the other would decide it.

The rule of one insert: a person with a URL that is on file is that fighter; else a
name on file decides; else the person is new, and name and URL are on file from then
on. Whom a name or URL stands for thus depends on what was inserted before.

Worked out for all mentions at once: a newcomer registers at a mention whose name and
URL are both free. Take names and URLs as the two sides of a graph and mentions as
its edges, in the order of the load; the registrations are the matching that a pass
in this order takes. An edge that comes before all others at its name and at its URL
is in it, whatever the rest; edges at a name or URL that is taken are not. Taking the
former and dropping the latter is repeated on what is left, which soon is nothing:
only chains of namesakes that each borrow the next one's URL need another round.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.session import cut


def _on_file() -> Column:
    """A place before every mention of any load."""
    return F.struct(F.lit(-(2**63)).cast("bigint").alias("seq"), F.lit(0).alias("place"), F.lit(0).alias("side"))


def _surrogate() -> Column:
    return F.xxhash64(F.coalesce("fighter_url", "fighter_name")).bitwiseAND(F.lit(2**63 - 1))


def registrations(mentions: DataFrame, fighters: DataFrame) -> DataFrame:
    """(fighter_id, fighter_name, fighter_url, place) of the newcomers, in the mention that registers each.

    mentions: (fighter_name, fighter_url, place), place unique and ordered; a URL may be missing.
    """
    names, urls = fighters.select("fighter_name"), fighters.select("fighter_url")
    first = mentions.groupBy("fighter_name", "fighter_url").agg(F.min("place").alias("place"))
    left = cut(first.join(names, "fighter_name", "left_anti").join(urls, "fighter_url", "left_anti"), "mentions")
    taken = None
    while not left.isEmpty():
        by_name = left.groupBy("fighter_name").agg(F.min("place").alias("name_first"))
        by_url = left.filter("fighter_url is not null").groupBy("fighter_url").agg(F.min("place").alias("url_first"))
        free = left.join(by_name, "fighter_name").join(by_url, "fighter_url", "left").filter(
            (F.col("place") == F.col("name_first")) & (F.col("fighter_url").isNull() | (F.col("place") == F.col("url_first"))))
        free = cut(free.select("fighter_name", "fighter_url", "place"), "registrations")
        left = cut(left.join(free.select("fighter_name"), "fighter_name", "left_anti").join(
            free.select("fighter_url"), "fighter_url", "left_anti"), "mentions")
        taken = free if taken is None else taken.unionByName(free)
    return (left if taken is None else taken).select(_surrogate().alias("fighter_id"), "fighter_name", "fighter_url", "place")


def resolve(mentions: DataFrame, fighters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(people, newcomers). people: (fighter_name, fighter_url, by_url, url_from, by_name) of every pair that is mentioned.

    Someone mentioned at a place is by_url from the place url_from on, by_name before or where by_url is missing
    (``at_place``). Of several fighters on file under one name the smallest id stands for it.
    """
    new = cut(registrations(mentions, fighters), "newcomers")
    known = fighters.select("fighter_id", "fighter_name", "fighter_url", _on_file().alias("place")).unionByName(new)
    first = F.struct("place", "fighter_id")
    names = known.groupBy("fighter_name").agg(F.min(first)["fighter_id"].alias("by_name"))
    urls = known.filter("fighter_url is not null").groupBy("fighter_url").agg(F.min(first).alias("own"))
    pairs = mentions.select("fighter_name", "fighter_url").distinct()
    people = pairs.join(names, "fighter_name", "left").join(urls, "fighter_url", "left")
    return people.select("fighter_name", "fighter_url", F.col("own.fighter_id").alias("by_url"),
                         F.col("own.place").alias("url_from"), "by_name"), new.drop("place")


def at_place(place: Column) -> Column:
    """The fighter's id for a mention at this place, from the columns of people."""
    return F.when(place >= F.col("url_from"), F.col("by_url")).otherwise(F.col("by_name"))
