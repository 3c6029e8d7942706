"""The benchmark tables read as bouts: part = competitor, order = bout, line = one side of a round.

The expressions are plain SQL text that Spark and DuckDB both read, so that the
checking SQL starts from the same inputs. Operators know nothing of this module.
"""

import re
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringside.columns import FEATURE_COLS
from ringside.operators import corners, history, model_rows
from ringside.operators.timeline import Timeline, number
from ringside.session import cut, cut_by, spread
from ringside.sources import snapshots

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
]

_LANDED = "cast(floor(l_quantity*((l_suppkey%9)+1)/10.0) as int)"
_ATTEMPTED = "cast(floor(l_quantity) as int)"


def _of(a: str, b: str) -> str:
    return f"cast({a} as string) || ' of ' || cast({b} as string)"


def _zone(i: int, key: str) -> str:
    return (
        f"case when {key}%3={i} then {_of(_LANDED, _ATTEMPTED)} else '0 of 0' end"
    )


ZONES = {"distance": (0, "l_suppkey"), "clinch": (1, "l_suppkey"), "ground": (2, "l_suppkey"),
         "head": (0, "l_partkey"), "body": (1, "l_partkey"), "leg": (2, "l_partkey")}

# p is the 1-based position of a line inside its order
LINE = {
    "fight_id": "l_orderkey",
    "p": "cast(p as int)",
    "round_number": "cast(floor((p+1)/2.0) as int)",
    "side": "cast(2-(p%2) as int)",
    "fighter_id": "l_partkey",
    "price": "l_extendedprice",
    "landed": f"case when l_suppkey%17=0 then null else {_LANDED} end",
    "attempted": f"case when l_suppkey%17=0 then null else {_ATTEMPTED} end",
    "zone": "cast(l_suppkey%3 as int)",
    "target": "cast(l_partkey%3 as int)",
    "sig_str": f"case when l_suppkey%17=0 then '---' else {_of(_LANDED, _ATTEMPTED)} end",
    "sig_str_percent": f"case when l_suppkey%17=0 or {_ATTEMPTED}=0 then '---' else "
                       f"cast(cast(floor(100.0*{_LANDED}/{_ATTEMPTED}) as int) as string) || '%' end",
    "total_str": _of(f"({_LANDED} + l_partkey%5)", f"({_ATTEMPTED} + l_partkey%5)"),
    "td": _of("(l_partkey%4)", "(l_partkey%4 + l_suppkey%3)"),
    "td_percent": "case when l_partkey%4 + l_suppkey%3 = 0 then '---' else "
                  "cast(cast(floor(100.0*(l_partkey%4)/(l_partkey%4 + l_suppkey%3)) as int) as string) || '%' end",
    "kd": "case when l_returnflag='N' then '---' else cast(l_suppkey%3 as string) end",
    "sub_att": "cast(l_partkey%2 as string)",
    "rev": "cast(l_linenumber%2 as string)",
    "ctrl": "case when l_partkey%11=0 then '--' else cast(l_suppkey%5 as string) || ':' || "
            "lpad(cast(l_partkey%60 as string), 2, '0') end",
    "parts": "'{' || " + " || ',' || ".join(
        f"'\"{n}\":\"' || {_zone(i, k)} || '\"'" for n, (i, k) in ZONES.items()) + " || '}'",
}

CELLS = ["kd", "sig_str", "sig_str_percent", "total_str", "td", "td_percent", "sub_att", "rev", "ctrl"]

ROUND_AGGS = {
    f"fighter{s}_{c}": f"max(case when side={s} then {c} end)" for c in CELLS for s in (1, 2)
} | {
    "raw_round": "'{\"round\":' || cast(round_number as string) || ',\"significant_strikes\":{\"fighter1\":' || "
                 "coalesce(max(case when side=1 then parts end), '{}') || ',\"fighter2\":' || "
                 "coalesce(max(case when side=2 then parts end), '{}') || '}}'"
}

SIDE_RAW = ["p", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber"]


def _at(side: int, cell: str) -> str:
    """The cell of one side of a round, from that side's numbers; NULL where the round has no such side."""
    text = LINE[cell].replace("l_returnflag='N'", f"s{side}_is_n")
    for name in SIDE_RAW:
        text = re.sub(rf"\b{name}\b", f"s{side}_{name}", text)
    return f"(case when s{side}_p is not null then {text} end)"


# a side has one line in a round, so its numbers say what ROUND_AGGS find among the cells
ROUND_RAW = {f"s{s}_{c}": f"max(case when side={s} then {c} end)" for c in SIDE_RAW for s in (1, 2)} | {
    f"s{s}_is_n": f"max(case when side={s} then l_returnflag='N' end)" for s in (1, 2)}
ROUND_CELLS = {n: re.sub(r"max\(case when side=(\d) then (\w+) end\)", lambda m: _at(int(m[1]), m[2]), e)
               for n, e in ROUND_AGGS.items()}

FIGHT_AGGS = {
    "f1": "max(case when p=1 then fighter_id end)",
    "f2": "max(case when p=2 then fighter_id end)",
    "price1": "max(case when p=1 then price end)",
    "price2": "max(case when p=2 then price end)",
    "last_round": "max(round_number)",
}
for _s in (1, 2):
    FIGHT_AGGS[f"l{_s}"] = f"sum(case when side={_s} then landed end)"
    FIGHT_AGGS[f"a{_s}"] = f"sum(case when side={_s} then attempted end)"
    for _n, (_i, _k) in ZONES.items():
        _c = "zone" if _k == "l_suppkey" else "target"
        for _v, _x in (("l", "landed"), ("a", "attempted")):
            FIGHT_AGGS[f"{_v}{_s}_{_n}"] = f"coalesce(sum(case when side={_s} and {_c}={_i} then {_x} end),0)"

_OUTCOME = ("case when o_orderkey%50=0 then 'draw' when o_orderkey%53=0 then 'no_contest' "
            "else 'decisive' end")

FIGHT = {
    "fight_id": "o_orderkey",
    "event_date": "cast(o_orderdate as date)",
    "fight_url": "'http://bouts.test/b/' || cast(o_orderkey as string)",
    "weight_class": "case o_custkey%8 when 0 then 'UFC Lightweight Title Bout' "
                    "when 1 then 'Women''s Strawweight Bout' when 2 then 'Lightweight' when 3 then 'Welterweight' "
                    "when 4 then 'Heavyweight' when 5 then 'Flyweight' when 6 then 'Catch Weight Bout' end",
    "method": "case o_orderpriority when '1-URGENT' then 'KO/TKO' when '2-HIGH' then 'Submission' "
              "when '3-MEDIUM' then 'Decision - Split' when '4-NOT SPECIFIED' then 'TKO - Doctor''s Stoppage' "
              "else case o_orderkey%4 when 0 then 'DQ' when 1 then 'Overturned' "
              "else 'Decision - Unanimous' end end",
    "round": "last_round",
    "time": "case when o_orderpriority='3-MEDIUM' then '5:00' else cast(o_orderkey%5 as string) || ':' || "
            "lpad(cast(o_orderkey%60 as string), 2, '0') end",
    "time_format": "case when o_orderkey%97=0 then 'No Time Limit' when o_orderkey%10=0 then "
                   "'5 Rnd (5-5-5-5-5)' else '3 Rnd (5-5-5)' end",
    "referee": "case when o_orderkey%13=0 then null else 'Ref ' || cast(o_custkey%40 as string) end",
    "finish_details": "case when o_orderkey%3=0 then null else o_orderpriority end",
    "fighter1_id": "f1",
    "fighter2_id": "f2",
    "outcome_type": _OUTCOME,
    "winner_id": f"case when {_OUTCOME} <> 'decisive' then null when price2 > price1 then f2 else f1 end",
}

TOTALS_WHERE = "fight_id%7<>0"
TOTALS = {"fight_id": "fight_id"}
for _s in (1, 2):
    TOTALS[f"fighter{_s}_sig_str"] = (
        f"case when fight_id%11=0 or a{_s} is null then '---' else {_of(f'l{_s}', f'a{_s}')} end"
    )
    TOTALS[f"fighter{_s}_sig_str_percent"] = (
        f"case when fight_id%11=0 or a{_s} is null or a{_s}=0 then '---' else "
        f"cast(cast(floor(100.0*l{_s}/a{_s}) as int) as string) || '%' end"
    )
    for _n in ZONES:
        TOTALS[f"fighter{_s}_{_n}"] = _of(f"l{_s}_{_n}", f"a{_s}_{_n}")
TOTALS["raw_totals"] = "'{\"significant_strikes\":{}}'"

EVENT = {
    "event_id": "{days}",
    "event_url": "'http://bouts.test/e/' || cast({days} as string)",
    "headline": "'Card ' || cast({days} as string)",
    "event_location": "case when {days}%5=0 then null else 'Hall ' || cast({days}%7 as string) end",
}

FIGHTER = {
    "fighter_id": "p_partkey",
    "fighter_name": "p_name || ' ' || p_brand",
    "fighter_url": "'http://bouts.test/f/' || cast(p_partkey as string)",
}
BIO = {
    "fighter_id": "p_partkey",
    "height": "cast(58+p_size%20 as double)",
    "reach": "cast(case when p_partkey%7=0 then null else 58+p_partkey%25 end as int)",
    "fighting_style": "case when p_partkey%9=0 then null else p_type end",
}
METADATA = {
    "fight_id": "fight_id",
    "page_title": "case when fight_id%19=0 then null else 'Bout ' || cast(fight_id as string) end",
    "source": "'binding'",
    "canonical_url": "fight_url",
    "raw_metadata": "'{\"source\":\"binding\"}'",
}
JUDGE = {
    "fight_id": "fight_id",
    "judge_name": "'Judge ' || cast((fight_id*j)%30 as string) || '-' || cast(j as string)",
    "score": "case when (fight_id+j)%23=0 then null else cast(27+(fight_id*j)%3 as string) || ' - 28' end",
}
# raw snapshot cells as a scrape would hold them
SNAPSHOT = {
    "fighter_id": "p_partkey",
    "landed": "cast(p_partkey%9 as string) || ',' || lpad(cast(p_size as string), 3, '0')",
    "attempted": "case when p_partkey%6=0 then '' else cast(p_partkey as string) || ' total' end",
    "per_min": "cast(p_size%7 as string) || '.' || lpad(cast(p_partkey%100 as string), 2, '0')",
    "defense": "case when p_partkey%8=0 then null else cast(p_size as string) || '%' end",
    "avg_time": "case p_partkey%4 when 0 then cast(p_size as string) || ':' || lpad(cast(p_partkey%60 as string),2,'0') "
                "when 1 then '1:02:' || lpad(cast(p_partkey%60 as string),2,'0') when 2 then 'n/a' "
                "else cast(p_size as string) end",
}
# a prediction for every completed bout, its corners named in either order
PICK = {
    "event_url": "case when fight_id%4=1 then null else 'https://bouts.test/e/' || cast({days} as string) || '/' end",
    "event_date": "case when fight_id%4=2 then null else event_date end",
    "a_id": "case when fight_id%2=0 then fighter1_id else fighter2_id end",
    "b_id": "case when fight_id%2=0 then fighter2_id else fighter1_id end",
    "p_a": "((fight_id*37)%1000)/1000.0",
}


# scraped documents: one event with one bout per order, some repeated, some unreadable
BOUT_DOC = {
    "k1": "o_custkey",
    "k2": "(o_custkey*7+1)%1000",
    "fight_url": "'http://bouts.test/d/' || cast(o_orderkey as string)",
    "event_url": "'http://bouts.test/x/' || cast(o_orderkey%500 as string)",
    "headline": "'Night ' || cast(o_orderkey as string)",
    "weight_class": "case when o_orderkey%8=0 then null else 'Lightweight Bout' end",
    "n_rounds": "cast(1 + o_orderkey%5 as int)",
    "name1": "'P' || cast(o_custkey as string)",
    "url1": "'http://bouts.test/p/' || cast(o_custkey as string)",
    "name2": "case when o_orderkey%103=0 then '' else 'P' || cast((o_custkey*7+1)%1000 as string) end",
    "url2": "case when o_orderkey%9=0 then null else "
            "'http://bouts.test/p/' || cast((o_custkey*7+1)%1000 as string) end",
    "status1": "case o_orderkey%6 when 0 then 'W' when 1 then 'L' when 2 then 'D' when 3 then 'NC' when 4 then 'W' end",
    "status2": "case o_orderkey%6 when 0 then 'L' when 1 then 'W' when 2 then 'D' when 3 then 'NC' when 4 then 'W' end",
}


def _corner_cells(side):
    return ("named_struct('kd', cast((o_orderkey+r)%3 as string), 'sig_str', cast((o_orderkey+r)%20 as string) || "
            f"' of ' || cast((o_orderkey+r)%20+{side} as string), 'ctrl', '0:' || "
            "lpad(cast((o_orderkey*r)%60 as string), 2, '0'))")


#: Names that up to three people share, each with a URL of their own.
SHARED_NAMES = {
    "name1": "'Q' || cast(o_custkey%600 as string)",
    "name2": "case when o_orderkey%103=0 then '' else 'Q' || cast((o_custkey*7+1)%1000%600 as string) end",
}


def documents(orders, **other):
    """(seq, version, payload) JSON texts; a tenth of the bouts come a second time with one round."""
    rows = spread(orders.select("o_orderkey", "o_custkey")).select("o_orderkey", *exprs(BOUT_DOC | other), F.expr(
        "explode(case when o_orderkey%10=3 then array(1,2) else array(1) end) as version"))
    event = f"""named_struct('url', event_url, 'headline', headline, 'date', '1999-01-02', 'location', 'Hall',
      'fights', array(named_struct(
        'metadata', named_struct('url', fight_url, 'page_title', 'Bout', 'source', 'doc'),
        'general_info', named_struct('weight_class', weight_class, 'method', case when version=2 then 'Decision' else
          'KO/TKO' end, 'round', n_rounds, 'time', '1:30', 'time_format', '3 Rnd (5-5-5)'),
        'fighters', named_struct('fighter1', named_struct('name', name1, 'url', url1),
                                 'fighter2', named_struct('name', name2, 'url', url2)),
        'fight_result', map_filter(map(url1, status1, coalesce(nullif(url2, url1), 'none'), status2),
                                   (k, v) -> v is not null),
        'totals', named_struct('significant_strikes', named_struct(
           'fighter1', named_struct('sig_str', cast(o_orderkey%40 as string) || ' of 50'),
           'fighter2', named_struct('sig_str', '---'))),
        'round_stats', transform(sequence(1, case when version=2 then 1 else n_rounds end), r -> named_struct(
           'round', r, 'fighter1', {_corner_cells(1)}, 'fighter2', {_corner_cells(2)})),
        'judges', transform(sequence(1, 3), j -> named_struct('judge', case when (o_orderkey+j)%7=0 then null else
           'J' || cast((o_orderkey+j)%20 as string) end, 'score', cast(26+j as string) || ' - 28')))))"""
    return rows.select(
        (F.col("o_orderkey") * 10 + F.col("version")).alias("seq"),
        "version",
        F.expr(f"case when o_orderkey%101=0 then '{{\"url\": [' else to_json({event}) end").alias("payload"),
    )


# an upcoming card: neighbouring parts meet
CARD_DATE = "2002-01-01"
CARD = {
    "bout_no": "cast(floor(p_partkey/2.0) as int)",
    "slot": "cast(p_partkey%2 as int)",
    "person": "case when p_partkey%11=0 then 'Nobody ' || cast(p_partkey as string) else p_name || ' ' || p_brand end",
    "link": "case when p_partkey%11=0 then 'http://bouts.test/none' when p_partkey%5=0 then null else "
            "'https://bouts.test/f/' || cast(p_partkey as string) || '/' end",
}


def exprs(table: dict[str, str], **fill) -> list:
    return [F.expr(e.format(**fill) if fill else e).alias(n) for n, e in table.items()]


SPARK_DAYS = "datediff(DAY, date'1970-01-01', event_date)"


class _Lazy(Mapping):
    """Attributes of an object as a mapping, read when asked for."""

    def __init__(self, owner, names: dict[str, str]):
        self.owner, self.names = owner, names

    def __getitem__(self, key):
        return getattr(self.owner, self.names[key])

    def __iter__(self):
        return iter(self.names)

    def __len__(self):
        return len(self.names)


class Bench:
    """Benchmark tables bound to the bout schema.

    Places of lines, bouts and events are written once and re-read. Wider tables are put together from them with the
    columns that a query reads, unless it asks for a stored layer.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._trains: dict[tuple[str, ...], DataFrame] = {}  # by the features they have; plans, not rows

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def placed(self) -> DataFrame:
        """Lines with their place p in the order, as numbers: cells of text are made from them where they are read.

        They lie in buckets of the order, so that bouts and rounds are put together without an exchange.
        """
        line = Timeline.of(self.raw("lineitem"), ["l_orderkey"], LINE_ORDER)
        placed = line.with_known(prior={"earlier": number()}).df.withColumn("p", F.col("earlier") + 1)
        return cut_by(placed.select(*LINE_ORDER, "l_orderkey", "p"), "lines", "l_orderkey")

    @cached_property
    def lines(self) -> DataFrame:
        return self.placed.select(*exprs(LINE))

    @cached_property
    def per_fight(self) -> DataFrame:
        return self.lines.groupBy("fight_id").agg(*exprs(FIGHT_AGGS))

    @cached_property
    def bouts(self) -> DataFrame:
        """What of orders and lines makes a bout, in buckets of the order."""
        both = self.raw("orders").join(
            self.per_fight.filter("f2 is not null"), F.col("o_orderkey") == F.col("fight_id")
        )
        named = set(re.findall(r"\w+", " ".join(FIGHT.values())))
        return cut_by(both.select(*[c for c in both.columns if c in named - {"fight_id"}]), "bouts", "o_orderkey")

    @cached_property
    def fights(self) -> DataFrame:
        return self.bouts.select(*exprs(FIGHT)).withColumn("event_id", F.expr(SPARK_DAYS))

    @cached_property
    def events(self) -> DataFrame:
        dates = self.fights.select("event_date").distinct()
        return cut(dates.select(*exprs(EVENT, days=SPARK_DAYS), "event_date"), "events")

    @cached_property
    def round_stats(self) -> DataFrame:
        sides = self.placed.select("*", F.expr(LINE["round_number"]).alias("round_number"), F.expr(LINE["side"]).alias("side"))
        rows = sides.withColumnRenamed("l_orderkey", "fight_id").groupBy("fight_id", "round_number").agg(*exprs(ROUND_RAW))
        bouts = self.per_fight.filter("f2 is not null").select("fight_id")
        return rows.join(bouts, "fight_id", "left_semi").select("fight_id", "round_number", *exprs(ROUND_CELLS))

    @cached_property
    def fight_totals(self) -> DataFrame:
        return self.per_fight.filter("f2 is not null").filter(TOTALS_WHERE).select(*exprs(TOTALS))

    @cached_property
    def fighters(self) -> DataFrame:
        return self.raw("part").select(*exprs(FIGHTER))

    @cached_property
    def fighter_bio(self) -> DataFrame:
        return self.raw("part").select(*exprs(BIO))

    @cached_property
    def fight_metadata(self) -> DataFrame:
        return self.fights.filter("fight_id%29<>0").select(*exprs(METADATA))

    @cached_property
    def judge_scores(self) -> DataFrame:
        decided = self.fights.filter("method like 'Decision%'")
        return decided.select("fight_id", F.explode(F.array(*[F.lit(j) for j in (1, 2, 3)])).alias("j")).select(
            *exprs(JUDGE)
        )

    @cached_property
    def snapshot(self) -> DataFrame:
        return self.raw("part").select(*exprs(SNAPSHOT))

    @cached_property
    def snapshot_pages(self) -> DataFrame:
        """Fighter pages as a text map of scraped cells."""
        cells = {"Sig. Strikes Landed": "landed", "Sig. Strikes Attempted": "attempted",
                 "Sig. Str. LandedPer Min": "per_min", "Takedown Defense": "defense",
                 "Average fight time": "avg_time", "ko/tko_percent": "defense", "ko/tko_count": "landed"}
        pairs = [x for k, c in cells.items() for x in (F.lit(k), F.col(c))]
        return self.snapshot.select("fighter_id", F.create_map(*pairs).alias("stats"))

    @cached_property
    def performance_stats(self) -> DataFrame:
        return snapshots.performance_stats(self.snapshot_pages)

    @cached_property
    def card(self) -> DataFrame:
        sides = self.raw("part").select(*exprs(CARD))

        def of(slot, c):
            return F.max(F.when(F.col("slot") == slot, F.col(c)))

        bouts = sides.groupBy("bout_no").agg(
            of(0, "person").alias("fighter_a_name"), of(0, "link").alias("fighter_a_url"),
            of(1, "person").alias("fighter_b_name"), of(1, "link").alias("fighter_b_url"),
        )
        return bouts.withColumns({
            "weight_class_raw": F.expr("case bout_no%3 when 0 then 'Lightweight' when 1 then "
                                       "'UFC Heavyweight Title Bout' else null end"),
            "is_main": F.expr("bout_no%50=0"),
        })

    @cached_property
    def predictions(self) -> DataFrame:
        """A logged prediction for every bout, naming its people by id, URL or name only."""
        rows = self.fights.filter("fighter1_id <> fighter2_id").select(
            "fight_id", *exprs(PICK, days=SPARK_DAYS))
        for s in "ab":
            who = self.fighters.select(F.col("fighter_id").alias(f"{s}_id"),
                                       F.col("fighter_name").alias(f"fighter_{s}_name"),
                                       F.col("fighter_url").alias(f"fighter_{s}_url"))
            rows = rows.join(who, f"{s}_id")
            rows = rows.withColumns({
                f"fighter_{s}_id": F.expr(f"case when fight_id%5<2 then null else {s}_id end"),
                f"fighter_{s}_url": F.expr(f"case when fight_id%5=0 then null else fighter_{s}_url end"),
            })
        return rows.withColumn("event_headline", F.lit("Card"))

    def audit_tables(self) -> Mapping[str, DataFrame]:
        """The tables under their stored names, each built when a check asks for it."""
        return _Lazy(self, {n: n for n in (
            "events", "fighters", "fights", "fight_metadata", "fight_totals", "round_stats", "judge_scores", "fighter_bio",
            "fight_facts")} | {
            "fighter_performance_stats": "performance_stats", "fighter_fight_features": "features",
            "fighter_fight_facts": "corner_facts", "fighter_round_facts": "round_facts",
            "fight_model_rows": "model_rows", "fight_model_train": "model_train",
        })

    # -- derived layers ----------------------------------------------------

    @cached_property
    def eligible(self) -> DataFrame:
        return corners.eligible_fights(self.fights.drop("event_date"), self.events)

    @cached_property
    def fight_facts(self) -> DataFrame:
        return corners.fight_facts(self.eligible)

    @cached_property
    def corner_facts(self) -> DataFrame:
        return corners.corner_facts(self.eligible, self.fight_facts, self.fight_totals, self.round_stats)

    @cached_property
    def round_facts(self) -> DataFrame:
        return corners.round_facts(self.eligible, self.round_stats)

    @cached_property
    def history(self) -> DataFrame:
        return history.load_history(self.corner_facts)

    @cached_property
    def schedule(self) -> DataFrame:
        return history.stored_schedule(self.history)

    def features_with(self, cols) -> DataFrame:
        """The features of these names: a plan of a few of them is put together in a small part of the time of all."""
        return history.with_schedule(self.history, self.schedule, self.schedule, cols)

    def train_with(self, *cols: str) -> DataFrame:
        """All training rows with the features that these of their columns are made of; keys, body data and labels always."""
        wanted = tuple(model_rows.features_behind(cols))
        if wanted not in self._trains:
            rows = model_rows.model_rows(self.features_with(wanted), self.fight_facts, self.corner_facts, self.fighter_bio)
            self._trains[wanted] = model_rows.mirrored(rows)
        return self._trains[wanted]

    def stored_train_with(self, *cols: str) -> DataFrame:
        """As ``train_with``, from stored corner facts: for most of the labels, which both sides and the windows read."""
        made = history.with_schedule(self.stored_history, self.stored_schedule, self.stored_schedule, model_rows.features_behind(cols))
        return model_rows.mirrored(model_rows.model_rows(made, self.fight_facts, self.stored_corner_facts, self.fighter_bio))

    @cached_property
    def features(self) -> DataFrame:
        return self.features_with(FEATURE_COLS)

    @cached_property
    def model_rows(self) -> DataFrame:
        return model_rows.model_rows(self.features, self.fight_facts, self.corner_facts, self.fighter_bio)

    @cached_property
    def model_train(self) -> DataFrame:
        return model_rows.mirrored(self.model_rows)

    # -- stored layers, for jobs that read most of their columns several times ------

    @cached_property
    def stored_corner_facts(self) -> DataFrame:
        return cut_by(self.corner_facts, "corner-facts", "fight_id")

    @cached_property
    def stored_history(self) -> DataFrame:
        return history.load_history(self.stored_corner_facts)

    @cached_property
    def stored_schedule(self) -> DataFrame:
        return history.stored_schedule(self.stored_history)

    @cached_property
    def stored_features(self) -> DataFrame:
        made = history.with_schedule(self.stored_history, self.stored_schedule, self.stored_schedule)
        return cut_by(made, "features", "fight_id")

    @cached_property
    def stored_model_rows(self) -> DataFrame:
        """The corner facts are read three times here, by the windows and for the labels of both sides: from their stored rows."""
        rows = model_rows.model_rows(self.stored_features, self.fight_facts, self.stored_corner_facts, self.fighter_bio)
        return cut(rows, "model-rows")

    @cached_property
    def stored_model_train(self) -> DataFrame:
        """The mirrored form is a projection of the stored rows and is not written again."""
        return model_rows.mirrored(self.stored_model_rows)


_OPEN: dict[tuple[str, str], Bench] = {}


def bench(spark: SparkSession, sf_dir: str) -> Bench:
    """One set of bound tables per application and folder, so that queries share the written layers."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Bench(spark, sf_dir)
    return _OPEN[key]
