"""Full rebuilds: raw tables to facts, facts to features, features to training rows.

Every step reads and writes tables under one root folder. A write goes to a new
folder of its own, and a pointer that names the folder of every table is written
last: readers see all tables of a step as they were or as they are, and a write
that breaks off changes nothing.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ringside.operators import corners, history, model_rows
from ringside.operators.upsert import BUCKET, BUCKET_ROWS, latest, upsert, upsert_buckets, write_buckets
from ringside.session import cut
from ringside.sources import payload

RAW = ["events", "fighters", "fights", "fight_metadata", "fight_totals", "round_stats", "judge_scores"]
POINTERS = "_pointers"


class Store:
    """Tables as Parquet folders below a root that all executors can read; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        """A folder below the root, for what is no table."""
        return f"{self.root}/{name}"

    # -- pointers ----------------------------------------------------------

    def _folder(self, path: str):
        """The file system and the folder in it."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _last_pointer(self) -> int:
        """Number of the last pointer that was written to its end; 0 if there is none."""
        fs, where = self._folder(self.path(POINTERS))
        if not fs.exists(where):
            return 0
        names = [x.getPath().getName() for x in fs.listStatus(where)]
        done = [int(n) for n in names if n.isdigit() and fs.exists(self._folder(f"{self.path(POINTERS)}/{n}/_SUCCESS")[1])]
        return max(done, default=0)

    def tables(self) -> dict[str, str]:
        """The folder of every table, as the last pointer says."""
        last = self._last_pointer()
        return json.loads(self.spark.read.text(f"{self.path(POINTERS)}/{last}").first()[0]) if last else {}

    # -- tables ------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return name in self.tables()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(self.tables()[name])).drop(BUCKET)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        self.replace_all({name: df})
        return self.read(name)

    def replace_all(self, tables: dict[str, DataFrame], by: dict[str, list[str]] = {}, bucket_rows: int = BUCKET_ROWS) -> None:  # noqa: B006
        """Write every table once, to a new folder; then let them all take their names at once.

        Tables named in ``by`` are stored in buckets of these keys, so that ``change`` can rewrite some of them. They are
        counted first, by a plan without their columns, and not written twice for it.
        """
        now = self.tables()
        for name, df in tables.items():
            folder = f"{name}/{uuid.uuid4().hex}"
            if name in by:
                write_buckets(df, self.path(folder), by[name], bucket_rows)
            else:
                df.write.parquet(self.path(folder))
            now[name] = folder
        pointer = self.spark.createDataFrame([(json.dumps(now, sort_keys=True),)], "tables string").coalesce(1)
        pointer.write.text(f"{self.path(POINTERS)}/{self._last_pointer() + 1}")

    def change(self, name: str, updates: DataFrame, keys: list[str], by: list[str], gone: DataFrame | None = None) -> None:
        """Upsert into a table stored in buckets, in place: only touched buckets are read and written.

        A change that breaks off while buckets are exchanged is made whole by running it again.
        """
        upsert_buckets(self.spark, self.path(self.tables()[name]), updates, keys, by=by, gone=gone)

    def drop_old(self) -> int:
        """Delete the folders of tables that no longer bear their name; nothing may be reading them. Returns how many."""
        current, gone = self.tables(), 0
        for name, folder in current.items():
            fs, where = self._folder(self.path(name))
            for x in fs.listStatus(where):
                if x.getPath().getName() != folder.rsplit("/", 1)[1]:
                    gone += fs.delete(x.getPath(), True)
        return gone


def ingest(store: Store, documents: DataFrame, unique_names: bool = True) -> tuple[DataFrame, DataFrame]:
    """Load scraped documents into the raw tables; the counters and the documents set aside."""
    first = not store.exists("fighters")
    known = store.spark.createDataFrame([], "fighter_id long, fighter_name string, fighter_url string") if first \
        else store.read("fighters")
    rows, aside, counts = payload.load_rows(documents, known, unique_names)
    rows = {n: cut(df, f"load-{n}") for n, df in rows.items()}
    store.replace_all(rows if first else payload.apply_load({n: store.read(n) for n in RAW}, rows))
    return counts, aside


#: Keys of the buckets of tables that are kept up to date by change.
BY = {"fighter_fight_features": ["fighter_id"], "fight_model_rows": ["fight_id"], "fight_model_train": ["fight_id"]}


def facts(store: Store) -> None:
    """All three fact tables; readers see them change together."""
    eligible = corners.eligible_fights(store.read("fights"), store.read("events"))
    bouts, rounds = cut(corners.fight_facts(eligible), "fight-facts"), store.read("round_stats")
    store.replace_all({
        "fight_facts": bouts,
        "fighter_fight_facts": corners.corner_facts(eligible, bouts, store.read("fight_totals"), rounds),
        "fighter_round_facts": corners.round_facts(eligible, rounds),
    })


def features(store: Store, bucket_rows: int = BUCKET_ROWS) -> None:
    """Recompute all features and upsert them on (fighter, bout)."""
    built = history.build_features(history.load_history(store.read("fighter_fight_facts")))
    if store.exists("fighter_fight_features"):
        keys = ["fighter_id", "fight_id"]
        built = upsert(store.read("fighter_fight_features"), latest(built, keys, ["event_date"]), keys)
    store.replace_all({"fighter_fight_features": built}, BY, bucket_rows)


def model_tables(store: Store, bio: DataFrame, bucket_rows: int = BUCKET_ROWS) -> None:
    """Model rows and their mirrored form; readers see both change together."""
    rows = cut(model_rows.model_rows(
        store.read("fighter_fight_features"), store.read("fight_facts"), store.read("fighter_fight_facts"), bio), "model-rows")
    store.replace_all({"fight_model_rows": rows, "fight_model_train": model_rows.mirrored(rows)}, BY, bucket_rows)


def everything(store: Store, bio: DataFrame, bucket_rows: int = BUCKET_ROWS) -> None:
    facts(store)
    features(store, bucket_rows)
    model_tables(store, bio, bucket_rows)
