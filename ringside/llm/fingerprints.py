"""Operator 2: document fingerprints by SimHash, and block tables to find near ones.

Terms are pairs of neighbouring words (and the last word by itself). A term's
64-bit hash votes on every bit, for 1 or for 0, once per occurrence and with a
weight of 1 to 3: one more for each of the two words that is longer than three
characters, since short words are mostly the common ones. The fingerprint has
the bits that win.

Votes are counted two bits to a long, 32 sums per document, right where the
document's words are: the words are exploded and summed up again in one stage,
without moving them.

Block tables: 64 bits in six blocks. Two fingerprints that differ in at most
three bits agree in at least three blocks, so of the 20 tables, each keyed by
three blocks put in front, at least one holds both under the same key. Candidates
are verified by exact distance. DataFrame functions only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringside.llm.common import table, whole_text
from ringside.session import cut

RADIUS = 3
BLOCKS = 6
SHORT = 3
_LANES = 0x0000000100000001
_SPACE = r"[\x20\x09-\x0D]+"


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("bigint")


def voted(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, fp): the fingerprint of each row's text; keys must tell rows apart and text must not be null."""
    words = texts.select(*keys, F.split(F.lower(F.col(text)), _SPACE).alias("_w"))
    pairs = words.select(*keys, F.explode(F.arrays_zip(
        F.col("_w").alias("a"), F.slice("_w", F.lit(2), F.size("_w")).alias("b"))).alias("_t"))
    longer = lambda c: (F.coalesce(F.length(c), F.lit(0)) > SHORT).cast("bigint")
    votes = pairs.select(*keys, F.xxhash64("_t.a", "_t.b").alias("_h"), (longer("_t.a") + longer("_t.b") + 1).alias("_n"))
    sums = [F.sum(F.shiftright("_h", j).bitwiseAND(_long(_LANES)) * F.col("_n")).alias(f"_s{j}") for j in range(32)]
    summed = votes.groupBy(*keys).agg(F.sum("_n").alias("_all"), *sums)
    bits = _long(0)
    for j in range(32):
        low = F.col(f"_s{j}").bitwiseAND(_long(0xFFFFFFFF))
        high = F.shiftright(f"_s{j}", 32)
        bits = bits.bitwiseOR(F.when(low * 2 > F.col("_all"), _long(1 << j)).otherwise(_long(0)))
        bits = bits.bitwiseOR(F.when(high * 2 > F.col("_all"), _long(1 << (j + 32))).otherwise(_long(0)))
    return summed.select(*keys, bits.alias("fp"))


def likeness(x: Column, y: Column) -> Column:
    """Cosine of the angle that the share of differing bits stands for, at least 0; 1 for equal fingerprints."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(x.bitwiseXOR(y)) * F.lit(3.141592653589793 / 64)))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- block tables -----------------------------------------------------------

def _tables(radius: int, blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in itertools.combinations(masks, blocks - radius)]


def _filed(fps: DataFrame, name: str, radius: int, blocks: int) -> DataFrame:
    """Each fingerprint once per table: table number and the bits in front."""
    fronts = F.array(*[F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(_long(m)).alias("front"))
                       for n, m in enumerate(_tables(radius, blocks))])
    return fps.select(F.col("fp").alias(name), F.explode(fronts).alias("x")).select(name, "x.t", "x.front")


def near(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, distance): for every distinct fingerprint asked, all other distinct ones within the radius."""
    if not 0 <= radius < blocks:
        raise ValueError("more blocks than the radius are needed")
    asked = _filed(queries.select("fp").distinct(), "query", radius, blocks)
    held = _filed(fps.select("fp").distinct(), "other", radius, blocks)
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("other")))
    met = asked.join(held, ["t", "front"]).filter((distance <= radius) & (distance > 0))
    return met.select("query", F.col("other").alias("fp"), distance.alias("distance")).distinct()


# -- texts and their neighbours ---------------------------------------------

def _successors(ids: DataFrame) -> DataFrame:
    """(nameless, id, next_nameless, next_id): the next id in ascending order, a null id after all, the first after the last.

    Range-partitioned, with the first id of each range handed to the range before it.
    """
    ranged = cut(ids.repartitionByRange("nameless", "id").withColumn("range", F.spark_partition_id()), "ids")
    key = F.struct("nameless", "id")
    inside = ranged.withColumn("next", F.lead(key).over(Window.partitionBy("range").orderBy("nameless", "id")))
    # one row per range, not per id
    starts = ranged.groupBy("range").agg(F.min(key).alias("start"))
    order = Window.orderBy("range")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = starts.select("range", F.coalesce(F.lead("start").over(order), F.first("start").over(everything)).alias("after"))
    out = inside.join(starts, "range").withColumn("next", F.coalesce("next", "after"))
    return out.select("nameless", "id", "n", F.col("next.nameless").alias("next_nameless"), F.col("next.id").alias("next_id"))


def compared(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text.

    (doc_id, nameless, id, next_nameless, next_id, k, n_chars, edited_sha256, fp, edited_fp). The edited text has its last
    quarter of code points replaced by as many of the next id's text (all of it, if
    it is shorter). A null text counts as empty, an empty one has one empty word. Of rows that share
    an id, the one whose text has the least hash stands for it as a neighbour;
    all rows come back, repeated ones too. Other columns play no part.
    """
    i, t = F.col(f"`{id_col}`").cast("bigint"), whole_text(text)
    rows = docs.select(i.isNull().alias("nameless"), F.coalesce(i, F.lit(0).cast("bigint")).alias("id"), t.alias("text"))
    ids = rows.groupBy("nameless", "id").agg(F.max(F.floor(F.length("text") / 4)).alias("n"))
    after = cut(_successors(ids), "successors")
    # both uses of the texts read one exchange; only as much of a text as is asked for travels on
    by_id = rows.repartition("nameless", "id")
    ask = after.select(F.col("nameless").alias("to_nameless"), F.col("id").alias("to_id"), "n",
                       F.col("next_nameless").alias("nameless"), F.col("next_id").alias("id"))
    pieces = by_id.join(ask, ["nameless", "id"]).select(
        "to_nameless", "to_id", F.struct(F.xxhash64("text").alias("k"), F.substring("text", F.lit(1), F.col("n").cast("int")).alias("piece")).alias("p"))
    pieces = pieces.groupBy(F.col("to_nameless").alias("nameless"), F.col("to_id").alias("id")).agg(F.min("p").alias("p"))
    size = F.length("text")
    quarter = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - quarter), F.substring("p.piece", F.lit(1), quarter))
    both = by_id.join(pieces, ["nameless", "id"]).select("nameless", "id", F.xxhash64("text").alias("k"), size.alias("n_chars"),
                                                       "text", edited.alias("edited"))
    both = both.withColumn("row", F.monotonically_increasing_id()).withColumn("sha", F.sha2("edited", 256))
    keys = ["nameless", "id", "row", "k", "n_chars", "sha"]
    sides = both.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("s"))
    fps = voted(sides.select(*keys, "s.side", "s.t"), [*keys, "side"], "t")
    paired = fps.groupBy(*keys).agg(F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"),
                                    F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp"))
    return paired.select(F.when(~F.col("nameless"), F.col("id")).alias("doc_id"), "nameless", "id", "k",
                         F.col("n_chars").cast("bigint").alias("n_chars"), F.col("sha").alias("edited_sha256"), "fp", "edited_fp")


def with_next(rows: DataFrame) -> DataFrame:
    """compared() rows with the next id's fingerprint."""
    first = rows.groupBy("nameless", "id").agg(F.min(F.struct("k", "fp")).alias("f"), F.lit(0).alias("n"))
    after = _successors(first.select("nameless", "id", "n"))
    next_fp = after.drop("n").join(
        first.select(F.col("nameless").alias("next_nameless"), F.col("id").alias("next_id"), F.col("f.fp").alias("next_fp")),
        ["next_nameless", "next_id"]).select("nameless", "id", "next_fp")
    return rows.join(next_fp, ["nameless", "id"])


EVERY = 50


def op2(spark, sf_dir):
    """Fingerprints of every document and its edited text, their likeness, and what the block tables find.

    near_fingerprints: for documents whose id is divisible by 50, how many other
    distinct fingerprints lie within three bits of theirs; null for the rest.
    """
    rows = cut(compared(table(spark, sf_dir, "documents")), "compared")
    asked = rows.filter(F.col("doc_id") % EVERY == 0)
    found = near(asked, rows).groupBy(F.col("query").alias("fp")).agg(F.count(F.lit(1)).alias("found"))
    out = with_next(rows).join(found, "fp", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % EVERY == 0, F.coalesce("found", F.lit(0).cast("bigint"))).alias("near_fingerprints"))


QUERIES = {"op2_simhash_fingerprints": op2}
