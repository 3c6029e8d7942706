"""Operator 1: mixing sources to target weights, by Sainte-Lague apportionment.

1. Sizes: words per document, per source.
2. Targets: sources share a budget of words by weight; a target stops at a
   multiple of its source's size and the excess is shared again by weight.
3. Documents of a source are dealt to shards by a seeded hash. A shard's
   documents, in seeded order, form a line of words that is cut into blocks of
   equal length (give or take a word).
4. Sainte-Lague: the blocks of the whole mix go to the shards of all sources, which
   compete for them, one by one by the highest quotient votes / (2 seats + 1). A
   shard's votes are what its source's target asks of its blocks. Quotas are integers.
5. A shard takes each block quota // blocks times and a seeded choice of
   quota % blocks of them once more. A document's share is what its stretch of the
   line has in the blocks taken.

Everything but the table of sources and shards stays in Spark. That table has
one row per shard, of which there are at most MAX_SHARDS plus one per source; more
than MAX_SOURCES sources are an error.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringside.llm.common import WORD, fresh, table, whole_text
from ringside.session import cut

#: The weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCK = 64
SEED = 42
SHARD_ROWS = 2_000
MAX_SHARDS = 100_000
MAX_SOURCES = 100_000


def sizes(docs: DataFrame, source: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, k, named, source, size): words of every row; a null source is one of its own."""
    t = whole_text(text)
    s = F.col(f"`{source}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(t).alias("k"),
                       s.isNotNull().alias("named"), F.coalesce(s, F.lit("")).alias("source"),
                       F.regexp_count(t, F.lit(WORD)).cast("bigint").alias("size"))


def targets(size: np.ndarray, weights: np.ndarray, share: float = SHARE, cap: float = CAP) -> np.ndarray:
    """Each source's target: shares of share * all words by weight, at most cap * its size, the excess shared again."""
    size, weights = np.asarray(size, np.float64), np.asarray(weights, np.float64)
    out, free = np.zeros(len(size)), np.ones(len(size), bool)
    left = share * size.sum()
    while free.any():
        want = left * weights / weights[free].sum()
        over = free & (want >= cap * size)
        if not over.any():
            out[free] = want[free]
            break
        out[over] = cap * size[over]
        left = max(0.0, left - out[over].sum())
        free &= ~over
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2 s + 1), none above most; ties go to the earlier party.

    All seats that a divisor a little above the last quotient gives are handed
    out at once, the others one by one.
    """
    votes, most = np.asarray(votes, np.float64), np.asarray(most, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    out = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return out
    given = lambda d: np.minimum(most, np.floor(votes / d + 0.5)).astype(np.int64) * (votes > 0)
    low, high = votes.max() * 1e-12, votes.max() * 2.1
    for _ in range(100):
        middle = (low + high) / 2
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high)
    heap = [(-votes[i] / (2 * out[i] + 1), i) for i in range(len(votes)) if votes[i] > 0 and out[i] < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def quotas(shards: pd.DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> pd.DataFrame:
    """Plan per shard from (named, source, shard, words): source_size, target, blocks, quota.

    Sources count in code point order (that of their UTF-8 bytes), null last.
    """
    shards = shards.assign(order=[(not n, s.encode()) for n, s in zip(shards["named"], shards["source"])])
    shards = shards.sort_values(["order", "shard"], kind="stable").reset_index(drop=True)
    per = shards.groupby("order", sort=True)["words"].sum()
    weight = np.array([weights[i % len(weights)] for i in range(len(per))], np.float64)
    target = pd.Series(targets(per.to_numpy(), weight, share, cap), per.index)
    shards["source_size"], shards["target"] = shards["order"].map(per), shards["order"].map(target)
    words = shards["words"].to_numpy()
    shards["blocks"] = np.where(words > 0, np.maximum(1, (words + block // 2) // block), 0)
    n = shards["blocks"].to_numpy()
    votes = n * (shards["target"] / shards["source_size"].clip(lower=1)).to_numpy()
    shards["quota"] = sainte_lague(votes, round(float(votes.sum())), np.floor(cap * n).astype(np.int64))
    return shards.drop(columns="order")


def taken_words(size: np.ndarray, blocks: int, quota: int, seed: int) -> np.ndarray:
    """Words taken of each document of a line, given in order."""
    line = np.concatenate(([0], np.cumsum(size)))
    if blocks == 0 or quota == 0:
        return np.zeros(len(size), np.int64)
    edges = np.arange(blocks + 1, dtype=np.int64) * int(line[-1]) // blocks
    times = np.full(blocks, quota // blocks, np.int64)
    chosen = np.random.Generator(np.random.PCG64(seed)).permutation(blocks)[:quota % blocks]
    times[chosen] += 1
    before = np.concatenate(([0], np.cumsum(times * np.diff(edges))))
    at = np.clip(np.searchsorted(edges, line, side="right") - 1, 0, blocks - 1)
    upto = before[at] + (line - edges[at]) * times[at]
    return np.diff(upto)


def whole_copies(size: np.ndarray, taken: np.ndarray, seed: int) -> np.ndarray:
    """Copies of each document of a line: its share taken / size, rounded up or down so that the words add up.

    Longest first, a fraction is rounded up by a seeded draw whose chance is the
    fraction plus the words owed so far over the document's length. What a long
    document has too much or too little is thus made up for by shorter ones.
    """
    out = np.where(size > 0, taken // np.maximum(size, 1), 0)
    left = taken - out * size
    line = np.lexsort((np.arange(len(size)), -size))
    line = line[left[line] > 0]
    owed = 0
    for i, draw in zip(line, np.random.Generator(np.random.PCG64(seed)).random(len(line))):
        owed += int(left[i])
        if draw * size[i] < owed:
            out[i] += 1
            owed -= int(size[i])
    return out


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, k, size, source_size, target, taken) of every row.

    taken counts repeats and is at most cap times the size. A null or empty text
    has no words and is never taken; sources without a word get a target of 0.
    Rows with equal id and text are told apart by their place in the line.
    Reruns over equal rows agree, however they are partitioned. Columns other than
    id, text and source play no part. An empty table gives an empty table.
    """
    return _taken(docs, **how).select("doc_id", "k", "size", "source_size", "target", "taken")


def _taken(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, seed: int = SEED,
           shard_rows: int = SHARD_ROWS, source: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of mix with their source (named, source) and copies, their number of whole copies."""
    spark = docs.sparkSession
    rows = cut(sizes(docs, source, id_col, text), "sizes")
    per_source = cut(rows.groupBy("named", "source").agg(F.count(F.lit(1)).alias("docs")), "sources")
    sources, total = per_source.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    if sources > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    most = max(shard_rows, -(-total // MAX_SHARDS))
    counts = per_source.select("named", "source", F.ceil(F.col("docs") / most).cast("int").alias("shards"))
    place = F.xxhash64("doc_id", "k", F.lit(seed))
    dealt = rows.join(counts, ["named", "source"]).withColumn("order", place).withColumn(
        "shard", F.pmod(F.xxhash64("order"), F.col("shards")).cast("int")).drop("shards")
    words = dealt.groupBy("named", "source", "shard").agg(F.sum("size").alias("words")).toPandas()
    if words.empty:
        return rows.select("doc_id", "k", "size", F.col("size").alias("source_size"), F.lit(0.0).alias("target"),
                           F.col("size").alias("taken"), "named", "source", F.col("size").alias("copies"))
    plan = quotas(words, weights, share, cap, block)[
        ["named", "source", "shard", "source_size", "target", "blocks", "quota"]]
    plan = spark.createDataFrame(plan, "named boolean, source string, shard int, source_size long, target double, "
                                       "blocks long, quota long")

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id", "k"], kind="stable")
        name = f"{seed}/{pdf['named'].iat[0]}/{pdf['source'].iat[0]}/{pdf['shard'].iat[0]}"
        size = pdf["size"].to_numpy(np.int64)
        taken = taken_words(size, int(pdf["blocks"].iat[0]), int(pdf["quota"].iat[0]), zlib.crc32(name.encode()))
        copies = whole_copies(size, taken, zlib.crc32(f"{name}/copies".encode()))
        return pdf.assign(taken=taken, copies=copies)[
            ["doc_id", "k", "size", "source_size", "target", "taken", "named", "source", "copies"]]

    return dealt.join(plan, ["named", "source", "shard"]).groupBy("named", "source", "shard").applyInPandas(
        take, "doc_id bigint, k bigint, size bigint, source_size bigint, target double, taken bigint, "
              "named boolean, source string, copies bigint")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: every row as often as the mix takes it in whole copies, columns unchanged.

    A row comes as often as its share of words says, rounded up or down so that
    each source's words add up to its target (whole_copies). Copies of rows equal
    in id, text and source are dealt among them.
    """
    named, s, k, n, m, again, id_, key, has, of_ = fresh(
        docs, "_named", "_source", "_k", "_n", "_m", "_again", "_id", "_key", "_has", "_of")
    plan = _taken(docs, **how).groupBy("doc_id", "k", "named", "source").agg(
        F.sum("copies").alias(n), F.count(F.lit(1)).alias(m)).filter(F.col(n) > 0)
    plan = cut(plan.select(F.col("doc_id").alias(id_), F.col("k").alias(key), F.col("named").alias(has),
                           F.col("source").alias(of_), n, m), "copies")
    of = F.col(f"`{how.get('source', 'source')}`").cast("string")
    rows = docs.withColumns({named: of.isNotNull(), s: F.coalesce(of, F.lit("")), k: F.xxhash64(whole_text("text"))})
    met = rows.join(plan, rows["doc_id"].cast("bigint").eqNullSafe(F.col(id_)) & (rows[k] == F.col(key))
                    & (rows[named] == F.col(has)) & (rows[s] == F.col(of_)))
    met = met.select(*[rows[f"`{c}`"] for c in docs.columns], id_, key, has, of_, n, m)
    each = F.floor(F.col(n) / F.col(m))
    if not plan.filter(F.col(n) % F.col(m) > 0).isEmpty():  # rows that share an uneven number
        place = F.row_number().over(Window.partitionBy(id_, key, has, of_).orderBy(
            F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])))
        met = met.withColumn(again, place)
        each = each + (F.col(again) <= F.col(n) % F.col(m)).cast("int")
    met = met.withColumn(n, each.cast("int")).filter(F.col(n) > 0)
    return met.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mix(table(spark, sf_dir, "documents")).drop("k")


QUERIES = {"op1_mixed_sources": op1}
