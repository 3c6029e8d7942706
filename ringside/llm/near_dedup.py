"""Operator 10: SimHash near-duplicates by segment-popcount embedding.

A fingerprint is mapped to the bit counts of its segments. The Manhattan
distance of two such vectors never exceeds the Hamming distance of the
fingerprints, so fingerprints within the radius are close in that space: a grid
range join finds candidates there, the Manhattan distance drops most of them,
and the exact Hamming distance decides.

The grid join. The 64 bits are four blocks of eight 2-bit segments, and a
cell is the vector of bit counts of a block or of half a block. With at most
three differing bits, the four blocks' distances add up to at most 3, so either

* two blocks lie in the same cell (six choices of the two), or
* one block does and each of the others is at distance exactly 1, which leaves
  one half of each of them in the same cell (four choices of the block, and the
  halves of the next two blocks: four choices each).

Each fingerprint thus enters 22 projections of the grid and any linked pair
meets in at least one. A cell with many fingerprints is not paired with itself
in one place: its members are dealt into pieces and the pieces meet two by two,
each meeting returning a spanning forest of the links it finds, never all
pairs. No row, cell or partner is dropped.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.llm.common import WORD, fresh, table, whole_text
from ringside.llm.graph import components
from ringside.session import cut

RADIUS = 3
SHINGLE = 3
SEED = 42
#: A cell with more members than this is met piece by piece.
DENSE = 64
#: Members of a piece; a meeting of two pieces compares at most the square of this in one task.
PIECE = 16_384
#: Pairs compared at a time inside a meeting.
STRIP = 1_000_000

_WORD_BYTES = re.compile(WORD.encode())
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CHUNK = 1 << 16


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash, signed, of lower-cased word shingles hashed by XXH64 (seed 42); no words: 0."""
    words = _WORD_BYTES.findall(text.encode().translate(_LOWER))
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[i:i + _CHUNK], stops[i:i + _CHUNK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(text)


# -- embedding --------------------------------------------------------------

def segment_counts(fp: Column) -> Column:
    """Bit counts (0 to 2) of the 32 two-bit segments, side by side in a long, two bits each."""
    odd = F.lit(0x5555555555555555).cast("bigint")
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))  # their sum


def manhattan(x: Column, y: Column) -> Column:
    """Manhattan distance of two embeddings: counts are 0, 1 or 2, in two bits each.

    Written in unary (0: 00, 1: 01, 2: 11), a count's distance is the number of differing bits.
    """
    def unary(v):
        return v.bitwiseOR(F.shiftrightunsigned(v.bitwiseAND(F.lit(-0x5555555555555556).cast("bigint")), 1))

    return F.bit_count(unary(x).bitwiseXOR(unary(y)))


def _projections() -> list[int]:
    """The 22 masks over the embedding: bits of the cells that must agree."""
    block = lambda i: 0xFFFF << (16 * i)
    half = lambda i, h: 0xFF << (16 * i + 8 * h)
    masks = [block(i) | block(j) for i, j in itertools.combinations(range(4), 2)]
    for i in range(4):
        j, k = (i + 1) % 4, (i + 2) % 4
        masks += [block(i) | half(j, a) | half(k, b) for a in (0, 1) for b in (0, 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


PROJECTIONS = _projections()


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, fp): each fingerprint once per projection; the cell is a 64-bit hash of projection and counts."""
    counts = segment_counts(F.col("fp"))
    keys = F.array(*[F.xxhash64(F.lit(n), counts.bitwiseAND(F.lit(m).cast("bigint"))) for n, m in enumerate(PROJECTIONS)])
    return fps.select("fp", F.explode(keys).alias("cell"))


# -- links ------------------------------------------------------------------

def links(fps: DataFrame, radius: int = RADIUS, dense: int = DENSE, piece: int = PIECE) -> DataFrame:
    """Edges (a, b), a < b, between distinct fingerprints: with the input, their components are those of all links.

    Sparse cells return every link in them, dense ones a spanning forest per meeting of pieces.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the projections of the grid hold for a radius of 0 to 3")
    cells = _cells(fps)
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = cut(cells.join(sizes, "cell"), "cells")
    thin = met.filter(F.col("n") <= dense).select("cell", "fp")
    other = thin.select("cell", F.col("fp").alias("b"))
    ours = thin.select("cell", F.col("fp").alias("a"))
    near = (F.col("a") < F.col("b")) & \
        (manhattan(segment_counts(F.col("a")), segment_counts(F.col("b"))) <= radius) & \
        (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    sparse = ours.join(other, "cell").filter(near).select("a", "b")
    return sparse.union(_dense_links(met.filter(F.col("n") > dense), radius, piece)).distinct()


def _dense_links(members: DataFrame, radius: int, piece: int) -> DataFrame:
    """Meetings of pieces of crowded cells, one group per (cell, piece, piece)."""
    pieces = F.ceil(F.col("n") / piece).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), pieces).cast("int")
    dealt = members.withColumn("p", pieces).withColumn("i", own)
    meetings = dealt.select("cell", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias("j"))
    meetings = meetings.select("cell", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"),
                               "fp", (F.col("i") <= F.col("j")).alias("first"))
    return meetings.groupBy("cell", "i", "j").applyInPandas(
        lambda rows: _forest(rows, radius), "a bigint, b bigint")


def _unary(counts: np.ndarray) -> np.ndarray:
    return counts | ((counts & np.uint64(0xAAAAAAAAAAAAAAAA)) >> np.uint64(1))


def _counts(fp: np.ndarray) -> np.ndarray:
    odd = np.uint64(0x5555555555555555)
    return (fp & odd) + ((fp >> np.uint64(1)) & odd)


def _forest(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Spanning forest of the links between the two pieces (or inside the one)."""
    fp = np.unique(rows["fp"].to_numpy().view(np.uint64)) if rows["i"].iat[0] == rows["j"].iat[0] else None
    if fp is not None:
        left = right = fp
    else:
        first = rows["first"].to_numpy()
        left, right = rows["fp"].to_numpy().view(np.uint64)[first], rows["fp"].to_numpy().view(np.uint64)[~first]
    flat = np.concatenate([left, right]) if fp is None else left
    shift = len(left) if fp is None else 0
    parent = np.arange(len(flat))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out, embedded = [], _unary(_counts(right))
    own = _unary(_counts(left))
    strip = max(1, STRIP // max(1, len(right)))
    for s in range(0, len(left), strip):
        close = np.bitwise_count(own[s:s + strip, None] ^ embedded[None, :]) <= radius
        x, y = np.nonzero(close)
        exact = np.bitwise_count(left[x + s] ^ right[y]) <= radius
        x, y = x[exact] + s, y[exact] + shift
        # one vectorised pass throws out the links inside what is joined already
        while len(x):
            roots = _roots(parent)
            apart = roots[x] != roots[y]
            x, y = x[apart], y[apart]
            if not len(x):
                break
            low, high = np.minimum(roots[x], roots[y]), np.maximum(roots[x], roots[y])
            once = np.unique(high, return_index=True)[1]
            parent[high[once]] = low[once]
            out.append(np.stack([flat[x[once]], flat[y[once]]]))
    if not out:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    a, b = np.concatenate(out, axis=1).view(np.int64)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent.copy()
        parent[:] = up


# -- operator ---------------------------------------------------------------

def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, k, fp) of every row, written once; k is a hash of the text."""
    t = whole_text(text)
    return cut(docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(t).alias("k"),
                           fingerprint(t, shingle).alias("fp")), "fingerprints")


def classes(fps: DataFrame, radius: int = RADIUS, dense: int = DENSE, piece: int = PIECE) -> DataFrame:
    """(fp, root, head) for rows (doc_id, k, fp): head is the component's smallest (doc_id, k), null ids last.

    Equal fingerprints are one node, whatever their number.
    """
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "k")
    nodes = cut(fps.groupBy("fp").agg(F.min(order).alias("head")), "nodes")
    roots = components(links(nodes.select("fp"), radius, dense, piece))
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "head", F.coalesce("root", "fp").alias("root"))
    heads = grouped.groupBy("root").agg(F.min("head").alias("head"))
    return grouped.drop("head").join(heads, "root").select("fp", "root", "head")


def near_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id",
                    text: str = "text", **cells) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs.

    component_id is the smallest doc_id that links reach, null where all of a
    component's ids are null. Null and empty texts, and texts without a word,
    have fingerprint 0 and are linked like any other. Repeated rows come back as
    often as they came. Other columns play no part. An empty table gives an
    empty table.
    """
    fps = fingerprints(docs, shingle, id_col, text)
    found = classes(fps, radius, **cells).select("fp", F.col("head.doc_id").alias("component_id"))
    return fps.join(found, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, with all its columns: the smallest doc_id's, of equal ids the smallest text hash's.

    Nulls and empty texts count as in near_components; of rows with equal id and
    text one stays.
    """
    heads = classes(fingerprints(docs, shingle), radius).select("head.doc_id", "head.k").distinct()
    k, head_id, head_k = fresh(docs, "_k", "_head_id", "_head_k")
    marked = docs.withColumn(k, F.xxhash64(whole_text("text")))
    chosen = heads.select(F.col("doc_id").alias(head_id), F.col("k").alias(head_k))
    kept = marked.join(chosen, marked["doc_id"].eqNullSafe(F.col(head_id)) & (marked[k] == F.col(head_k)), "left_semi")
    return kept.dropDuplicates(["doc_id", k]).drop(k)


def op10(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    found = near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash_near_dedup": op10}
