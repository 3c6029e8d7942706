"""What the corpus operators share: reading, names that cannot clash, row keys, global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringside.session import cut

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that the input does not have yet, whatever it holds."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def keyed(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, k, text): k is a 64-bit hash of id and text.

    Rows that repeat an id with another text get another k; rows equal in both
    share it and get equal results, so joining results back on (id, k) is safe
    as long as the results hold one row per key. A null id is an id of its own.
    """
    t = whole_text(text)
    return df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`"), t).alias("k"), t.alias("text"))


def in_order(df: DataFrame, *by: str, name: str = "position") -> DataFrame:
    """Give every row its place (from 0) in the order of the given columns.

    Range-partitioned, so no task sees more than its range: places inside a
    range come from a window over that range, and what precedes it from one
    count per range. df should be narrow; it is written once, so that both uses
    see the same ranges.
    """
    spark = df.sparkSession
    ranged = cut(df.repartitionByRange(*[F.col(c) for c in by]).withColumn("_range", F.spark_partition_id()), "ordered")
    sizes = ranged.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*by)) - 1
    return (ranged.withColumn("_inside", inside).join(starts, "_range")
            .withColumn(name, F.col("_start") + F.col("_inside")).drop("_range", "_start", "_inside"))


def maybe_listed(rows: DataFrame, key: Column, listed: DataFrame, listed_key: Column, bits_each: int = 16) -> DataFrame:
    """rows whose key may be among the listed ones: all that are, and about one of bits_each of the others.

    For an exact join to follow: the rest of a wide table then needs no exchange. The filter is a bitmap over hashes of
    the keys, one row per 32,768 bits, 16 MB in all at most, which is what is broadcast; with more keys than it has room
    for more rows pass.
    """
    size = 1 << min(27, max(15, (max(1, listed.count()) * bits_each - 1).bit_length()))
    place = lambda k: F.pmod(F.xxhash64(k, F.lit(size)), F.lit(size))
    bucket, bit, bits = fresh(rows, "_bucket", "_bit", "_bits")
    at = listed.select(place(listed_key).alias("p"))
    maps = at.groupBy(F.bitmap_bucket_number("p").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias(bits))
    met = rows.withColumns({bucket: F.bitmap_bucket_number(place(key)), bit: F.bitmap_bit_position(place(key)).cast("int")})
    byte = F.conv(F.hex(F.expr(f"substring(`{bits}`, `{bit}` div 8 + 1, 1)")), 16, 10).cast("int")
    held = met.join(F.broadcast(maps), bucket).filter(F.call_function("shiftright", byte, F.col(bit) % 8).bitwiseAND(F.lit(1)) == 1)
    return held.select(*[F.col(f"`{c}`") for c in rows.columns])
