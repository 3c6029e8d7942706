"""Keyed writes on plain tables: last write wins, group resync, frozen rows.

Each function returns the table's new state. ``write_buckets`` stores a table so
that a later upsert rewrites only the key buckets that the update touches.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringside.session import cut

BUCKET = "key_bucket"
BUCKET_ROWS = 2_000_000
LAYOUT = "_layout"  # hidden from reads of the table


def latest(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by ``order``; reduced in each task before the shuffle."""
    whole = F.struct(*[F.col(c) for c in updates.columns if c not in keys])
    rank = F.struct(*[F.col(c) for c in order])
    picked = updates.groupBy(*keys).agg(F.max_by(whole, rank).alias("__row"))
    return picked.select(*keys, "__row.*").select(*updates.columns)


def latest_of_few(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As ``latest``, for wide rows: only those whose key comes again are reduced and shuffled, however many these are.

    ``updates`` is read three times.
    """
    again = cut(updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").select(*keys), "repeated")
    if again.isEmpty():
        return updates
    again = again.withColumnsRenamed({k: f"__again_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__again_{k}")) for k in keys]
    once = updates.join(again, same, "left_anti")
    return once.unionByName(latest(updates.join(again, same, "left_semi"), keys, order))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], frozen: Column | None = None) -> DataFrame:
    """Updates replace rows of the same key, except target rows that are ``frozen``.

    ``updates`` must hold one row per key; see ``latest``.
    """
    if frozen is None:
        return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)
    held = target.filter(F.coalesce(frozen, F.lit(False)))
    open_ = target.filter(~F.coalesce(frozen, F.lit(False)))
    kept = open_.join(updates.select(*keys), keys, "left_anti")
    new = updates.join(held.select(*keys), keys, "left_anti")
    return held.unionByName(kept).unionByName(new)


def replace_group(target: DataFrame, groups: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """All rows of the named groups go; exactly the new rows come in, maybe none."""
    return target.join(groups.select(key).distinct(), key, "left_anti").unionByName(updates)


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_buckets(df: DataFrame, path: str, keys: list[str], bucket_rows: int = BUCKET_ROWS) -> None:
    """Store a table partitioned by a hash of its key, in as many buckets as its rows ask for.

    The number of buckets is kept beside the data; a large bucket is split over several tasks.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    _bucketed(df, keys, buckets).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    df.sparkSession.createDataFrame([(str(buckets),)], "buckets string").coalesce(1).write.mode("overwrite").text(
        f"{path}/{LAYOUT}")


def upsert_buckets(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], frozen: Column | None = None,
                   by: list[str] | None = None, gone: DataFrame | None = None) -> None:
    """Upsert into a stored table, reading and rewriting only the touched buckets; all others keep their files.

    ``by`` are the keys the table was stored by, if they are only some of ``keys``; rows with the keys of ``gone`` are
    deleted first. The merged rows are written aside first, so that the table is never read while it is being
    overwritten. ``updates`` and ``gone`` are read several times.
    """
    by = by or keys
    buckets = int(spark.read.text(f"{path}/{LAYOUT}").first()[0])
    fresh = _bucketed(updates, by, buckets)
    touched = fresh.select(BUCKET)
    if gone is not None:
        removed = _bucketed(gone.select(*dict.fromkeys([*by, *keys])), by, buckets)
        touched = touched.union(removed.select(BUCKET))
    touched = touched.distinct()  # one small number per bucket
    target = spark.read.parquet(path).join(F.broadcast(touched), BUCKET, "left_semi")
    if gone is not None:
        target = target.join(removed.select(*keys).distinct(), keys, "left_anti")
    merged = cut(upsert(target, fresh.select(*target.columns), keys, frozen), "merged")
    emptied = [r[0] for r in touched.join(merged.select(BUCKET).distinct(), BUCKET, "left_anti").collect()] if gone is not None else []
    merged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        BUCKET
    ).parquet(path)
    for bucket in emptied:  # an overwrite leaves alone what it has no rows for
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={bucket}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
