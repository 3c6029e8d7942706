"""Predictions logged per pairing, scored once when the bout is completed, then frozen."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.functions import measures as m
from ringside.functions import parse
from ringside.operators.upsert import latest, upsert
from ringside.session import cut

LEDGER_SCHEMA = (
    "match_key string, event_url string, event_date date, event_headline string, "
    "fighter_a_name string, fighter_b_name string, fighter_a_url string, fighter_b_url string, "
    "fighter_a_id long, fighter_b_id long, p_a double, p_b double, pick string, is_tossup boolean, "
    "is_high_conf_66 boolean, predicted_at timestamp, fight_id long, outcome_type string, "
    "winner_side string, pick_correct boolean, scored_at timestamp"
)
LEDGER_COLS = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]


def new_picks(predictions: DataFrame, predicted_at: Column) -> DataFrame:
    """Ledger rows of card predictions, not yet scored; one row per pairing."""
    c = F.col
    key = m.match_key(
        c("event_url"), c("event_date"), c("fighter_a_url"), c("fighter_a_name"),
        c("fighter_b_url"), c("fighter_b_name"),
    )
    rows = predictions.withColumns(
        {"match_key": key, "predicted_at": predicted_at, "event_url": parse.url_key(c("event_url"))}
        | {f"fighter_{s}_url": parse.url_key(c(f"fighter_{s}_url")) for s in "ab"}
        | {f"fighter_{s}_id": parse.positive_id(c(f"fighter_{s}_id")) for s in "ab"}
        | m.pick_of(c("p_a"))
    )
    empty = {n: F.lit(None).cast(t) for n, t in (
        ("fight_id", "long"), ("outcome_type", "string"), ("winner_side", "string"),
        ("pick_correct", "boolean"), ("scored_at", "timestamp"),
    )}
    return latest(rows.withColumns(empty).select(*LEDGER_COLS), ["match_key"], ["predicted_at", "p_a"])


def log_picks(ledger: DataFrame, picks: DataFrame) -> DataFrame:
    """A rerun overwrites its picks; scored rows stay as they are."""
    return upsert(ledger, picks, ["match_key"], frozen=F.col("scored_at").isNotNull())


def completed_fights(fights: DataFrame, events: DataFrame, fighters: DataFrame) -> DataFrame:
    done = fights.filter("outcome_type is not null and outcome_type <> 'unknown'")
    rows = done.select("fight_id", "event_id", "winner_id", "outcome_type", "fighter1_id", "fighter2_id")
    rows = rows.join(events.select("event_id", "event_url", "event_date"), "event_id")
    for s in (1, 2):
        who = fighters.select(
            F.col("fighter_id").alias(f"fighter{s}_id"),
            F.col("fighter_name").alias(f"f{s}_name"),
            F.col("fighter_url").alias(f"f{s}_url"),
        )
        rows = rows.join(who, f"fighter{s}_id", "left")
    return rows


def _event_keys(url: Column, date: Column) -> Column:
    keys = F.array(F.concat(F.lit("u:"), parse.url_key(url)), F.concat(F.lit("d:"), date.cast("string")))
    return F.filter(keys, lambda k: k.isNotNull())


def _person_keys(ident: Column, url: Column, name: Column) -> Column:
    named = F.nullif(parse.name_key(name), F.lit(""))
    keys = F.array(
        F.concat(F.lit("i:"), F.nullif(ident.cast("long"), F.lit(0)).cast("string")),
        F.concat(F.lit("u:"), parse.url_key(url)),
        F.concat(F.lit("n:"), named),
    )
    return F.filter(keys, lambda k: k.isNotNull())


def _marked(keys: Column, name: str, mark) -> Column:
    return F.transform(keys, lambda x: F.named_struct(F.lit("key"), x, F.lit(name), F.lit(mark)))


def bout_postings(completed: DataFrame) -> DataFrame:
    """(identity, fight_id, corner): an inverted index from a person at an event to the bouts they stood in.

    A person has up to three keys (id, URL, name), so a bout has up to six postings of three numbers each; identity is a
    64-bit hash of event and key, and what it finds is verified.
    """
    c = F.col
    keys = {n: _person_keys(c(f"fighter{n}_id"), c(f"f{n}_url"), c(f"f{n}_name")) for n in (1, 2)}
    corners = F.concat(*[_marked(k, "corner", n) for n, k in keys.items()])
    each = completed.select("fight_id", "event_id", F.inline(corners))
    return each.select(F.xxhash64("event_id", "key").alias("identity"), "fight_id", "corner")


def match_picks(picks: DataFrame, completed: DataFrame, postings: DataFrame | None = None, ref: str = "match_key") -> DataFrame:
    """(ref, bout) of the picks that name a completed bout; the lowest bout id if several fit.

    "Same event by URL or date, same people by id, URL or name, in either corner": the events a pick can mean are found
    first, then its people's postings at them are intersected per (pick, bout). Bouts that remain are looked up once and
    verified. ref names the picks and must be unique among them.
    """
    c = F.col
    events = completed.select("event_id", F.explode(_event_keys(c("event_url"), c("event_date"))).alias("event_key")).distinct()
    sides = {s: _person_keys(*[c(f"fighter_{s}_{k}") for k in ("id", "url", "name")]) for s in "ab"}
    people = F.concat(*[_marked(k, "side", s) for s, k in sides.items()])
    meant = picks.select(ref, people.alias("people"), F.explode(_event_keys(c("event_url"), c("event_date"))).alias("event_key"))
    meant = meant.join(events, "event_key").dropDuplicates([ref, "event_id"]).select(ref, "event_id", F.inline("people"))
    asked = meant.select(ref, F.xxhash64("event_id", "key").alias("identity"), "side")
    hits = asked.join(bout_postings(completed) if postings is None else postings, "identity")
    stood = {f"{s}{n}": F.max((c("side") == s) & (c("corner") == n)).alias(f"{s}{n}") for s in "ab" for n in (1, 2)}
    met = hits.groupBy(ref, "fight_id").agg(*stood.values()).filter("(a1 and b2) or (a2 and b1)").select(ref, "fight_id")
    found = met.join(picks.drop("fight_id"), ref).join(completed.select("fight_id", F.struct(*completed.columns).alias("bout")), "fight_id")
    same = {(s, n): _same_person(s, n) for s in "ab" for n in (1, 2)}
    sure = found.filter(_same_event() & ((same["a", 1] & same["b", 2]) | (same["a", 2] & same["b", 1])))
    return sure.groupBy(ref).agg(F.min_by("bout", F.col("bout.fight_id")).alias("bout"))


def _same_event() -> Column:
    by_url = parse.url_key(F.col("event_url")) == parse.url_key(F.col("bout.event_url"))
    return F.coalesce(by_url, F.lit(False)) | F.coalesce(F.col("event_date") == F.col("bout.event_date"), F.lit(False))


def _same_person(side: str, n: int) -> Column:
    c = F.col
    by_id = c(f"fighter_{side}_id") == F.nullif(c(f"bout.fighter{n}_id").cast("long"), F.lit(0))
    by_url = parse.url_key(c(f"fighter_{side}_url")) == parse.url_key(c(f"bout.f{n}_url"))
    key = parse.name_key(c(f"fighter_{side}_name"))
    by_name = (key != "") & (key == parse.name_key(c(f"bout.f{n}_name")))
    yes = lambda x: F.coalesce(x, F.lit(False))
    return yes(by_id) | yes(by_url) | yes(by_name)


def winner_side() -> Column:
    """A or B from the winner's id, else from who stood in the winning corner."""
    won = F.col("bout.winner_id")
    side = F.when(F.col("fighter_a_id") == won, "A").when(F.col("fighter_b_id") == won, "B")
    for n in (1, 2):
        in_corner = F.col(f"bout.fighter{n}_id") == won
        side = side.when(in_corner & _same_person("a", n), "A").when(in_corner & _same_person("b", n), "B")
    return side


UNSCORED = [c for c in LEDGER_COLS if c not in ("fight_id", "outcome_type", "winner_side", "pick_correct", "scored_at")]


def _scored(scored_at: Column) -> list[Column]:
    """Columns that scoring fills, from a pick and its bout; only decisive, non-toss-up picks can be right."""
    side = F.when(F.col("bout.outcome_type") == "decisive", winner_side())
    right = F.when(side.isNotNull() & F.col("pick").isin("A", "B"), F.col("pick") == side)
    return [F.col("bout.fight_id").cast("long").alias("fight_id"), F.col("bout.outcome_type").alias("outcome_type"),
            side.alias("winner_side"), right.alias("pick_correct"), scored_at.alias("scored_at")]


def score_picks(ledger: DataFrame, completed: DataFrame, scored_at: Column) -> DataFrame:
    """Pending rows whose bout is completed, scored."""
    pending = ledger.filter("scored_at is null").drop("fight_id", "outcome_type")
    return pending.join(match_picks(pending, completed), "match_key").select(*UNSCORED, *_scored(scored_at)).select(*LEDGER_COLS)


def with_scores(ledger: DataFrame, scored: DataFrame) -> DataFrame:
    return upsert(ledger, scored, ["match_key"], frozen=F.col("scored_at").isNotNull())


def summary(ledger: DataFrame) -> DataFrame:
    scored, known = F.col("scored_at").isNotNull(), F.col("pick_correct").isNotNull()
    right, high = F.coalesce(F.col("pick_correct"), F.lit(False)), F.col("is_high_conf_66")
    return ledger.agg(
        F.count(F.lit(1)).alias("n_logged"),
        F.count_if(~scored).alias("n_pending"),
        F.count_if("is_tossup").alias("n_tossup"),
        F.count_if(scored & F.col("is_tossup")).alias("n_tossup_scored"),
        F.count_if(known).alias("n_picks_scored"),
        F.count_if(right).alias("n_correct"),
        F.count_if(high & known).alias("n_high_scored"),
        F.count_if(high & right).alias("n_high_correct"),
        F.count_if(scored & F.col("outcome_type").isin("draw", "no_contest")).alias("n_void"),
    )


def run_cycle(ledger, predictions, completed, now: Column) -> tuple[DataFrame, DataFrame]:
    """Score what is pending, log the new card, score again; the new ledger and its summary.

    Matching does not depend on the ledger, so old pending rows and new picks are matched together, once, and one
    grouping by pairing decides what becomes of them: a scored row stays, then an old pending row that finds its bout,
    then the new pick, scored or not, then an old pending row that is left alone. The ledger is written once.
    """
    completed = cut(completed, "completed")
    open_ = ledger.filter("scored_at is null").select(*UNSCORED, F.lit(0).alias("new")).unionByName(
        new_picks(predictions, now).select(*UNSCORED, F.lit(1).alias("new")))
    open_ = cut(open_.withColumn("ref", F.monotonically_increasing_id()), "open-picks")  # written, so that the numbers stay
    tried = open_.join(match_picks(open_, completed, ref="ref"), "ref", "left")
    empty = [F.when(F.col("bout").isNotNull(), c).alias(c_name) for c, c_name in zip(
        _scored(now), ("fight_id", "outcome_type", "winner_side", "pick_correct", "scored_at"))]
    tried = tried.select(*UNSCORED, *empty, F.when(F.col("new") == 1, 2).when(F.col("bout").isNotNull(), 3).otherwise(1).alias("rank"))
    held = ledger.filter("scored_at is not null").select(*LEDGER_COLS, F.lit(4).alias("rank"))
    row = F.struct(*[c for c in LEDGER_COLS if c != "match_key"])
    best = held.unionByName(tried).groupBy("match_key").agg(F.max_by(row, "rank").alias("row"))
    final = cut(best.select("match_key", "row.*").select(*LEDGER_COLS), "ledger")
    return final, summary(final)
