"""Scraped event payloads to the nine bout tables.

One JSON document per event. A document that cannot be read, or that holds a
bout without a URL or a fighter without a name, is set aside as a whole.
"""

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.functions import measures as m
from ringside.functions import parse
from ringside.operators import identity
from ringside.operators.upsert import latest, latest_of_few, replace_group, upsert
from ringside.session import cut

_CORNER = "struct<name:string,url:string,fighter_name:string,fighter_url:string>"
_TOTAL = "struct<" + ",".join(
    f"{c}:string" for c in
    ("sig_str", "sig_str_percent", "head", "body", "leg", "distance", "clinch", "ground")
) + ">"
_ROUND_CELLS = ["kd", "sig_str", "sig_str_percent", "total_str", "td", "td_percent", "sub_att", "rev", "ctrl"]
_ROUND = "struct<" + ",".join(f"{c}:string" for c in _ROUND_CELLS) + ">"
FIGHT_SCHEMA = (
    "struct<metadata:struct<url:string,page_title:string,source:string>,url:string,"
    "general_info:struct<weight_class:string,method:string,round:string,time:string,time_format:string,"
    "referee:string,finish_details:string>,"
    f"fighters:struct<fighter1:{_CORNER},fighter2:{_CORNER}>,fight_result:map<string,string>,"
    f"totals:struct<significant_strikes:struct<fighter1:{_TOTAL},fighter2:{_TOTAL}>>,"
    f"round_stats:array<struct<round:string,fighter1:{_ROUND},fighter2:{_ROUND},"
    "significant_strikes:map<string,map<string,string>>>>,"
    "judges:array<struct<judge:string,judge_name:string,score:string>>>"
)
# A bout is read twice from its text: into the fields above, and into its parts as they came, unknown keys included.
RAW_SCHEMA = "struct<metadata:string,totals:string,round_stats:array<string>>"
EVENT_SCHEMA = "url string, headline string, date string, location string, fights array<string>, broken string"
TOTAL_CELLS = ["sig_str", "sig_str_percent", "head", "body", "leg", "distance", "clinch", "ground"]


def surrogate(*natural: str) -> Column:
    """A positive id that is the same on every run."""
    return F.xxhash64(*natural).bitwiseAND(F.lit(2**63 - 1))


def first_of(*cells: str) -> Column:
    """The first cell that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cells])


def read_documents(docs: DataFrame, text: str = "payload", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Readable events and the documents set aside. ``seq`` is the load order.

    A text is parsed once: no filter is moved below an explode, where it would parse again for every test it makes.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    parsed = docs.withColumn("event", _once(F.from_json(text, EVENT_SCHEMA, options)))
    parsed = parsed.withColumn("event", _once(F.col("event").withField("fights", F.transform("event.fights", _both_ways))))

    def unread(number):
        return F.nullif(F.trim(number), F.lit("")).isNotNull() & parse.bio_int(number).isNull()

    def bad_fight(entry):
        f = entry["fight"]
        return (
            f.isNull()
            | F.coalesce(F.nullif(f["metadata"]["url"], F.lit("")), F.nullif(f["url"], F.lit(""))).isNull()
            | _no_name(f["fighters"]["fighter1"])
            | _no_name(f["fighters"]["fighter2"])
            | F.coalesce(unread(f["general_info"]["round"]), F.lit(False))
            | F.coalesce(F.exists(f["round_stats"], lambda r: unread(r["round"])), F.lit(False))
        )

    date = F.nullif(F.trim("event.date"), F.lit(""))

    bad = (
        F.col("event.broken").isNotNull()
        | F.nullif(F.col("event.url"), F.lit("")).isNull()
        | (date.isNotNull() & parse.day(date).isNull())
        | F.coalesce(F.exists("event.fights", bad_fight), F.lit(False))
    )
    flagged = parsed.withColumn("bad", F.coalesce(bad, F.lit(True)))
    good = flagged.filter("not bad").select(F.col(seq).alias("seq"), "event.*").drop("broken")
    return good, flagged.filter("bad").select(F.col(seq).alias("seq"), F.col(text).alias("payload"))


def _once(value: Column) -> Column:
    return F.explode(F.array(value))


def _both_ways(text: Column) -> Column:
    return F.struct(F.from_json(text, FIGHT_SCHEMA).alias("fight"), F.from_json(text, RAW_SCHEMA).alias("raw"))


def _no_name(corner: Column) -> Column:
    return F.coalesce(
        F.nullif(corner["fighter_name"], F.lit("")), F.nullif(corner["name"], F.lit(""))
    ).isNull()


def _place(side: int) -> Column:
    return F.struct(F.col("seq").cast("bigint").alias("seq"), F.col("place").cast("int").alias("place"), F.lit(side).alias("side"))


class Tables(Mapping):
    """Tables by name, each made when it is first asked for: who reads a few of a load's does not wait for the others."""

    def __init__(self, make: dict[str, Callable[[], DataFrame]]):
        self._make, self._made = make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)

    def written(self, names=None) -> "Tables":
        """The same tables, each written once when it is first asked for."""
        return Tables({n: lambda n=n: cut(self[n], n) for n in names or self})


@dataclass
class Batch:
    """Child relations of one load, keyed by natural keys; one row per key."""

    events: DataFrame
    seen: DataFrame  # every bout of every document, before repeats are dropped

    @cached_property
    def fights(self) -> DataFrame:
        """The last of each bout, written once, when a relation reads it."""
        return cut(latest_of_few(self.seen, ["fight_url"], ["seq", "place"]), "document-bouts")

    @classmethod
    def of(cls, good: DataFrame) -> "Batch":
        events = latest(
            good.select("seq", F.col("url").alias("event_url"), "headline", parse.day(F.col("date")).alias("event_date"),
                        F.col("location").alias("event_location")),
            ["event_url"], ["seq"],
        )
        seen = good.select("seq", F.col("url").alias("event_url"), F.posexplode("fights").alias("place", "entry"))
        seen = seen.select("seq", "event_url", "place", "entry.*")
        seen = seen.withColumn("fight_url", first_of("fight.metadata.url", "fight.url"))
        for s in (1, 2):
            seen = seen.withColumn(
                f"name{s}", first_of(f"fight.fighters.fighter{s}.fighter_name", f"fight.fighters.fighter{s}.name")
            ).withColumn(
                f"url{s}", first_of(f"fight.fighters.fighter{s}.fighter_url", f"fight.fighters.fighter{s}.url")
            )
        return cls(events, seen)

    # -- children ----------------------------------------------------------

    def people(self) -> DataFrame:
        """Distinct (name, url) pairs of both corners."""
        both = F.array(*[F.struct(F.col(f"name{s}").alias("fighter_name"), F.col(f"url{s}").alias("fighter_url"))
                         for s in (1, 2)])
        return self.seen.select(F.inline(both)).distinct()

    def mentions(self) -> DataFrame:
        """Every corner of every bout in load order: (fighter_name, fighter_url, place)."""
        both = F.array(*[F.struct(F.col(f"name{s}").alias("fighter_name"), F.col(f"url{s}").alias("fighter_url"),
                                  _place(s).alias("place")) for s in (1, 2)])
        return self.seen.select("seq", F.col("place").cast("int").alias("bout"), F.inline(both)).select(
            "fighter_name", "fighter_url", "place")

    def metadata(self) -> DataFrame:
        meta = F.col("fight.metadata")
        return self.fights.filter(meta.isNotNull()).select(
            "fight_url", meta["page_title"].alias("page_title"), meta["source"].alias("source"),
            meta["url"].alias("canonical_url"), F.col("raw.metadata").alias("raw_metadata"),
        )

    def totals(self) -> DataFrame:
        strikes = "fight.totals.significant_strikes"
        cells = [F.col(f"{strikes}.fighter{s}.{c}").alias(f"fighter{s}_{c}") for c in TOTAL_CELLS for s in (1, 2)]
        return self.fights.filter(F.col("fight.totals").isNotNull()).select(
            "fight_url", *cells, F.col("raw.totals").alias("raw_totals")
        )

    def rounds(self) -> DataFrame:
        both = F.arrays_zip(F.col("fight.round_stats").alias("r"), F.col("raw.round_stats").alias("raw"))
        rows = self.fights.select("fight_url", F.posexplode(both).alias("place", "b")).select("fight_url", "place", "b.*")
        cells = [F.col(f"r.fighter{s}.{c}").alias(f"fighter{s}_{c}") for c in _ROUND_CELLS for s in (1, 2)]
        flat = rows.select("fight_url", parse.bio_int(F.col("r.round")).alias("round_number"), "place", *cells,
                           F.col("raw").alias("raw_round"))
        return latest(flat, ["fight_url", "round_number"], ["place"]).drop("place")

    def judges(self) -> DataFrame:
        rows = self.fights.select("fight_url", F.posexplode("fight.judges").alias("place", "j"))
        named = rows.select("fight_url", first_of("j.judge", "j.judge_name").alias("judge_name"), "j.score", "place")
        named = named.filter("judge_name is not null")
        return latest(named, ["fight_url", "judge_name"], ["place"]).drop("place")


def resolve_people(people: DataFrame, fighters: DataFrame, unique_names: bool = True) -> DataFrame:
    """(name, url) of a load to fighter ids: by URL, then by name, else a new id.

    A name only decides when it belongs to exactly one known fighter, unless
    ``unique_names`` is off. People without URL are matched last, so that they
    also find fighters that this load adds.
    """
    with_url = people.filter("fighter_url is not null")
    by_url = fighters.filter("fighter_url is not null").select("fighter_url", F.col("fighter_id").alias("id_url"))
    found = with_url.join(by_url, "fighter_url", "left")
    found = _by_name(found, fighters, unique_names)
    found = found.select(
        "fighter_name", "fighter_url",
        F.coalesce("id_url", "id_name", surrogate("fighter_url")).alias("fighter_id"),
        F.coalesce("id_url", "id_name").isNull().alias("is_new"),
    )
    added = found.filter("is_new").select("fighter_id", "fighter_name", "fighter_url")
    known = fighters.select("fighter_id", "fighter_name", "fighter_url").unionByName(added)
    nameless = _by_name(people.filter("fighter_url is null"), known, unique_names)
    nameless = nameless.select(
        "fighter_name", "fighter_url",
        F.coalesce("id_name", surrogate("fighter_name")).alias("fighter_id"),
        F.col("id_name").isNull().alias("is_new"),
    )
    return found.unionByName(nameless)


def _by_name(people, fighters, unique_names):
    names = fighters.groupBy("fighter_name").agg(
        F.min("fighter_id").alias("id_name"), F.countDistinct("fighter_id").alias("__ids")
    )
    if unique_names:
        names = names.filter("__ids = 1")
    return people.join(names.drop("__ids"), "fighter_name", "left")


def with_outcome(fights: DataFrame) -> DataFrame:
    """Outcome and winning corner from the status letters keyed by fighter URL."""
    status = [F.try_element_at(F.col("fight.fight_result"), F.col(f"url{s}")) for s in (1, 2)]
    return fights.withColumns(
        {
            "outcome_type": m.outcome_of(*status),
            "winner_side": F.when((status[0] == "W") & (status[1] == "L"), 1).when(
                (status[1] == "W") & (status[0] == "L"), 2
            ),
        }
    )


def fight_rows(fights: DataFrame, people: DataFrame) -> DataFrame:
    """Bout rows with resolved corners and winner."""
    rows = with_outcome(fights)
    if "by_name" in people.columns:
        rows = _in_load_order(rows, people)
        people = None
    for s in (1, 2) if people is not None else ():
        ids = people.select(
            F.col("fighter_name").alias(f"name{s}"), F.col("fighter_url").alias(f"__url{s}"),
            F.col("fighter_id").alias(f"fighter{s}_id"),
        )
        same = (rows[f"name{s}"] == ids[f"name{s}"]) & rows[f"url{s}"].eqNullSafe(ids[f"__url{s}"])
        rows = rows.join(ids, same, "left").drop(ids[f"name{s}"], f"__url{s}")
    info = ["weight_class", "method", "round", "time", "time_format", "referee", "finish_details"]
    return rows.select(
        surrogate("fight_url").alias("fight_id"),
        surrogate("event_url").alias("event_id"),
        "fight_url",
        *[(parse.bio_int(F.col("fight.general_info.round")) if c == "round" else F.col(f"fight.general_info.{c}")).alias(c)
          for c in info],
        "fighter1_id",
        "fighter2_id",
        F.when(F.col("winner_side") == 1, F.col("fighter1_id"))
        .when(F.col("winner_side") == 2, F.col("fighter2_id")).alias("winner_id"),
        "outcome_type",
    )


def _in_load_order(rows: DataFrame, people: DataFrame) -> DataFrame:
    """rows with fighter1_id and fighter2_id as they were decided at the bout's place in the load."""
    for s in (1, 2):
        them = people.withColumnsRenamed({"fighter_name": f"__name{s}", "fighter_url": f"__url{s}"})
        same = (F.col(f"name{s}") == F.col(f"__name{s}")) & F.col(f"url{s}").eqNullSafe(F.col(f"__url{s}"))
        rows = rows.join(them, same, "left").withColumn(f"fighter{s}_id", identity.at_place(_place(s))).drop(*them.columns)
    return rows


def load_rows(docs: DataFrame, fighters: DataFrame, unique_names: bool = True,
              counted: bool = True) -> tuple[Tables, DataFrame, DataFrame | None]:
    """(rows per table, documents set aside, counters) of one load; nothing is written but what the tables share.

    A table is worked out when it is asked for, and so is what several share: the bouts, and who is who.
    unique_names: a name decides only where exactly one fighter on file bears it, and newcomers of one name stay apart.
    Otherwise people are told apart as one insert after the other would (``identity``). counted: False for a caller that
    reads no counters, which need the bouts.
    """
    good, aside = read_documents(docs)
    good = cut(good, "documents")  # parsed once, read by every child relation
    batch = Batch.of(good)

    @functools.cache
    def people() -> tuple[DataFrame, DataFrame]:
        """Everybody of the load, and the newcomers."""
        if unique_names:
            found = cut(resolve_people(batch.people(), fighters), "people")
            return found, found.filter("is_new").select("fighter_id", "fighter_name", "fighter_url")
        found, added = identity.resolve(batch.mentions(), fighters)
        return cut(found, "people"), added

    def keyed(d: DataFrame) -> DataFrame:
        return d.select(surrogate("fight_url").alias("fight_id"), *[c for c in d.columns if c != "fight_url"])

    rows = Tables({
        "events": lambda: batch.events.drop("seq").select(surrogate("event_url").alias("event_id"), "*"),
        "fighters": lambda: latest(people()[1], ["fighter_id"], ["fighter_name"]),
        "fights": lambda: fight_rows(batch.fights, people()[0]),
        "fight_metadata": lambda: keyed(batch.metadata()),
        "fight_totals": lambda: keyed(batch.totals()),
        "round_stats": lambda: keyed(batch.rounds()),
        "judge_scores": lambda: keyed(batch.judges()),
    })
    return rows, aside, counters(good, batch) if counted else None


def counters(good: DataFrame, batch: Batch) -> DataFrame:
    """One row of load counts; corner attempts as well as distinct people."""
    parts = [
        good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("events").alias("what"), "n"),
        batch.seen.agg(F.count(F.lit(1)).alias("n")).select(F.lit("fights").alias("what"), "n"),
        batch.seen.agg((2 * F.count(F.lit(1))).alias("n")).select(F.lit("fighters").alias("what"), "n"),
        batch.people().agg(F.count(F.lit(1)).alias("n")).select(F.lit("distinct_fighters").alias("what"), "n"),
        batch.rounds().agg(F.count(F.lit(1)).alias("n")).select(F.lit("round_stats").alias("what"), "n"),
        batch.judges().agg(F.count(F.lit(1)).alias("n")).select(F.lit("judge_scores").alias("what"), "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


KEYS = {
    "events": ["event_id"], "fighters": ["fighter_id"], "fights": ["fight_id"],
    "fight_metadata": ["fight_id"], "fight_totals": ["fight_id"], "judge_scores": ["fight_id", "judge_name"],
}


def apply_load(tables: Mapping[str, DataFrame], rows: Mapping[str, DataFrame]) -> Tables:
    """New state of every table. Rounds of a reloaded bout are replaced as a group."""
    made = {n: lambda n=n, keys=keys: upsert(tables[n], rows[n], keys) for n, keys in KEYS.items()}
    made["round_stats"] = lambda: replace_group(
        tables["round_stats"], rows["fights"].select("fight_id"), rows["round_stats"], "fight_id"
    )
    return Tables(made)
