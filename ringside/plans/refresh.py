"""Features and model rows kept up to date by change.

A load changes some corner rows. A feature row depends on its fighter's own rows up
to it and, through schedule strength, on the records that the opponents met so far
had at the time; a record in turn depends on its owner's rows alone. So a change at
one place of a fighter's history can alter

* the fighter's rows from that place on, and
* of everybody who met the fighter there or later, the rows from that bout on,

and nothing else. These rows, and no others, are worked out and written. What is
read is the whole history of the fighters concerned and the narrow records of their
opponents.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.operators import history, model_rows
from ringside.operators.history import ORDER
from ringside.operators.upsert import BUCKET_ROWS
from ringside.plans import build
from ringside.plans.build import BY, Store
from ringside.session import cut

KEYS = ["fighter_id", "fight_id"]


def _place() -> Column:
    return F.struct(*ORDER)


def _marked(rows: DataFrame, side: int) -> DataFrame:
    """Keys and place of every history row, and a hash of all that features read of it."""
    return rows.select(*KEYS, *ORDER, F.xxhash64(*rows.columns).alias("hash"), F.lit(side).alias("side"))


def first_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(fighter_id, start): the first place where the fighter's history rows differ, for the fighters with any.

    before and after: history rows (``load_history``). A row that came, went, moved or altered is a difference; narrow
    rows are shuffled, once.
    """
    rows = _marked(before, 0).unionByName(_marked(after, 1)).groupBy(*KEYS, *ORDER).agg(
        F.count(F.lit(1)).alias("sides"), F.min("hash").alias("least"), F.max("hash").alias("most"))
    return rows.filter("sides <> 2 or least <> most").groupBy("fighter_id").agg(F.min(_place()).alias("start"))


def widened(changes: DataFrame, after: DataFrame) -> DataFrame:
    """(fighter_id, start) of all whose features can differ: the changed fighters and whoever met them from there on."""
    met = after.select("fighter_id", F.col("opponent_id"), *ORDER).join(
        changes.select(F.col("fighter_id").alias("opponent_id"), F.col("start").alias("theirs")), "opponent_id")
    later = met.filter(_place() >= F.col("theirs")).select("fighter_id", _place().alias("start"))
    return changes.unionByName(later).groupBy("fighter_id").agg(F.min("start").alias("start"))


def features_from(after: DataFrame, starts: DataFrame) -> DataFrame:
    """The feature rows of these fighters from their starts on, as a full build over ``after`` would give them."""
    fighters = starts.select("fighter_id")
    own = after.join(fighters, "fighter_id", "left_semi")
    concerned = own.select(F.col("opponent_id").alias("fighter_id")).union(fighters).distinct()
    records = cut(history.own_record(after.join(concerned, "fighter_id", "left_semi")), "some-records")
    ours = records.join(fighters, "fighter_id", "left_semi")
    schedule = cut(history.schedule_strength(history.opponent_asof(ours, records), sized_from=ours), "some-schedules")
    built = history.with_schedule(own, schedule)
    place = F.struct(F.unix_date("event_date").alias("day_no"), F.col("fight_id").cast("long").alias("bout_order"))
    late = built.join(starts, "fighter_id").filter(place >= F.col("start"))
    return late.select(*built.columns)


def refresh_features(store: Store, before: DataFrame, after: DataFrame) -> DataFrame:
    """Bring the stored features from the history rows ``before`` to ``after``; the (fighter_id, fight_id) that changed."""
    starts = cut(widened(first_changes(before, after), after), "starts")
    fresh = cut(features_from(after, starts), "some-features")
    stored = store.read("fighter_fight_features").select(*KEYS, F.unix_date("event_date").alias("day_no"),
                                                         F.col("fight_id").cast("long").alias("bout_order"))
    stale = stored.join(starts, "fighter_id").filter(_place() >= F.col("start")).select(*KEYS)
    stale = cut(stale, "stale-features")
    if not (fresh.isEmpty() and stale.isEmpty()):
        store.change("fighter_fight_features", fresh, KEYS, BY["fighter_fight_features"], gone=stale)
    return fresh.select(*KEYS).union(stale).distinct()


def refresh_model_tables(store: Store, bouts: DataFrame, bio: DataFrame) -> None:
    """Rows of these bouts in both model tables, worked out anew from the stored features and facts."""
    some = {t: store.read(t).join(bouts, "fight_id", "left_semi") for t in (
        "fighter_fight_features", "fight_facts", "fighter_fight_facts")}
    rows = cut(model_rows.model_rows(*some.values(), bio), "some-model-rows")
    store.change("fight_model_rows", rows, ["fight_id"], BY["fight_model_rows"], gone=bouts)
    store.change("fight_model_train", cut(model_rows.mirrored(rows), "some-train-rows"), ["fight_id", "orientation"],
                 BY["fight_model_train"], gone=bouts.select("fight_id", F.explode(F.array(F.lit("page"), F.lit("swapped"))).alias("orientation")))


def refresh(store: Store, bio: DataFrame, bucket_rows: int = BUCKET_ROWS) -> None:
    """After a load: facts anew, then only the features and model rows that the load can alter.

    Without stored features everything is built. Body data that changed for a fighter without a changed bout reaches the
    model rows with the next full build.
    """
    if not all(store.exists(t) for t in ("fighter_fight_facts", *BY)):
        return build.everything(store, bio, bucket_rows)
    old_corners, old_facts = store.read("fighter_fight_facts"), store.read("fight_facts")
    build.facts(store)
    corners, facts = store.read("fighter_fight_facts"), store.read("fight_facts")
    keys = refresh_features(store, history.load_history(old_corners), history.load_history(corners))
    bouts = keys.select("fight_id")
    for old, new in ((old_corners, corners), (old_facts, facts)):  # labels need no feature to change
        sides = [t.select("fight_id", F.xxhash64(*sorted(t.columns)).alias("h")) for t in (old, new)]
        counted = [t.groupBy("fight_id").agg(F.sum(F.col("h").cast("decimal(20,0)")).alias("h"), F.count(F.lit(1)).alias("c")) for t in sides]
        same = counted[0].intersect(counted[1]).select("fight_id")
        every = counted[0].select("fight_id").union(counted[1].select("fight_id")).distinct()
        bouts = bouts.union(every.join(same, "fight_id", "left_anti"))
    refresh_model_tables(store, cut(bouts.distinct(), "some-bouts"), bio)
