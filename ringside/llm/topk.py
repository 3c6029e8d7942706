"""Operator 5: exact top-k by inner product, term at a time over all vectors.

Dimensions are the terms. Vectors are packed into blocks; a block of candidates
holds, per term, the postings (rows and weights). For each term the queries
that have it scatter its weighted postings into their rows of a dense score
array; a partition selection keeps k per query and block, and the blocks'
winners are merged by score and id.

Every block of queries meets every block of candidates: both carry (query block,
lane) and are joined on it, where a lane takes a share of the candidate blocks,
so no side is broadcast and no task sees more than one block of each kind at a
time. The work is queries times candidates, which is what exact search costs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringside.llm.common import table
from ringside.session import cut

SCALE = 1024
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
LANES = 64
#: Scores held at a time (queries x candidates).
SCORES = 1 << 21

_BLOCK = "ids binary, starts binary, rows binary, weights binary, dims int, largest bigint"
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * x) per component. Rows without an id, or with a null or non-finite component, are left out."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = vectors.filter(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & fine)
    # as doubles: integers of any size that a product below 2^63 can have are exact in them
    return kept.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v"))


def _pack(ids: np.ndarray, vectors: list) -> dict:
    """A block in postings form: for each term its rows and weights, rows ordered by id."""
    order = np.argsort(ids, kind="stable")
    dims = max((len(v) for v in vectors), default=0)
    dense = np.zeros((len(ids), dims))
    for row, i in enumerate(order):
        dense[row, :len(vectors[i])] = vectors[i]
    if np.abs(dense).max(initial=0) >= 2.0 ** 53:
        raise ArithmeticError("a component is too large for exact scores")
    weights = dense.T.astype(np.int64)
    term, rows = np.nonzero(weights)
    starts = np.searchsorted(term, np.arange(dims + 1))
    return {"ids": ids[order].astype("<i8").tobytes(), "starts": starts.astype("<i8").tobytes(),
            "rows": rows.astype("<i4").tobytes(), "weights": weights[term, rows].astype("<i8").tobytes(),
            "dims": dims, "largest": int(np.abs(weights).max(initial=0))}


def _packed(size: int):
    def pack(batches):
        ids, vectors = [], []
        for pdf in batches:
            ids += pdf["id"].tolist()
            vectors += pdf["v"].tolist()
            while len(ids) >= size:
                yield pd.DataFrame([_pack(np.array(ids[:size]), vectors[:size])])
                ids, vectors = ids[size:], vectors[size:]
        if ids:
            yield pd.DataFrame([_pack(np.array(ids), vectors)])

    return pack


class _Block:
    def __init__(self, ids, starts, rows, weights, dims, largest):
        self.ids, self.starts = np.frombuffer(ids, "<i8"), np.frombuffer(starts, "<i8")
        self.rows, self.weights = np.frombuffer(rows, "<i4"), np.frombuffer(weights, "<i8")
        self.dims, self.largest = int(dims), int(largest)

    def term(self, t: int):
        part = slice(self.starts[t], self.starts[t + 1])
        return self.rows[part], self.weights[part]


def _scores(queries: _Block, first: int, stop: int, candidates: _Block) -> np.ndarray:
    """Dense scores of some queries, accumulated one term at a time."""
    out = np.zeros((stop - first, len(candidates.ids)), np.int64)
    for t in range(min(queries.dims, candidates.dims)):
        asking, asked = queries.term(t)
        part = slice(*np.searchsorted(asking, (first, stop)))
        rows, weights = candidates.term(t)
        if part.start == part.stop or not len(rows):
            continue
        by_query = asking[part] - first
        product = asked[part][:, None] * weights[None, :]
        if len(rows) == out.shape[1] and len(by_query) == len(out):
            out += product
        elif len(rows) == out.shape[1]:
            out[by_query] += product
        else:
            out[np.ix_(by_query, rows)] += product
    return out


def _best(queries: _Block, candidates: _Block, k: int):
    """query id, candidate id, score of each query's k best in this block; ids ascend in a block, so ties go to the smaller."""
    if queries.largest * candidates.largest * max(1, min(queries.dims, candidates.dims)) >= 1 << 63:
        raise ArithmeticError("scores may not fit into 64 bits")
    step = max(1, SCORES // max(1, len(candidates.ids)))
    for first in range(0, len(queries.ids), step):
        stop = min(first + step, len(queries.ids))
        scores = _scores(queries, first, stop, candidates)
        own = np.searchsorted(candidates.ids, queries.ids[first:stop], side="left")
        end = np.searchsorted(candidates.ids, queries.ids[first:stop], side="right")
        for i, q in enumerate(queries.ids[first:stop]):
            row, ids = scores[i], candidates.ids
            if end[i] > own[i]:
                row, ids = np.delete(row, slice(own[i], end[i])), np.delete(ids, slice(own[i], end[i]))
            if len(row) > k:
                edge = np.partition(row, len(row) - k)[len(row) - k]
                above, tied = np.flatnonzero(row > edge), np.flatnonzero(row == edge)
                at = np.concatenate((above, tied[:k - len(above)]))
                row, ids = row[at], ids[at]
            yield np.full(len(ids), q), ids, row


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK, lanes: int = LANES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates among rows with another id, fewer if there are fewer.

    Both sides are (id, v) rows as quantised() makes them. Ties go to the smaller
    id. Rows that repeat a candidate's id are candidates each; an id that asks
    several times asks once, with its largest vector in array order. Vectors of
    different lengths are compared over the shorter one's. Scores are exact
    64-bit integers; input that could exceed them is an error.
    """
    asked = cut(queries.groupBy("id").agg(F.max("v").alias("v")), "queries")
    blocks = max(1, -(-asked.count() // query_block))

    def pack_queries(key, pdf):
        return pd.DataFrame([{"block": key[0], **_pack(pdf["id"].to_numpy(), pdf["v"].tolist())}])

    ask = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(
        pack_queries, f"block int, {_BLOCK}")
    ask = ask.select("block", F.struct(*_NAMES).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    every = candidates.mapInPandas(_packed(candidate_block), _BLOCK).select(
        F.struct(*_NAMES).alias("c"), F.pmod(F.xxhash64("ids", "weights"), F.lit(lanes)).cast("int").alias("lane"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    met = ask.join(every, ["block", "lane"]).select("q", "c")

    @F.pandas_udf("array<struct<query_id:bigint,vec_id:bigint,score:bigint>>")
    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.Series:
        out = []
        for i in range(len(q)):
            parts = list(_best(_Block(*q.iloc[i]), _Block(*c.iloc[i]), k))
            out.append([{"query_id": int(x), "vec_id": int(y), "score": int(z)} for p in parts for x, y, z in zip(*p)])
        return pd.Series(out, dtype=object)

    found = met.select(F.explode(best("q", "c")).alias("f")).select("f.*")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op5(spark, sf_dir):
    """The ten best of all vectors for every vector whose id is divisible by 100."""
    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("id") % 100 == 0))


QUERIES = {"op5_exact_top_k": op5}
ORACLES = {"op5_exact_top_k": """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""}
