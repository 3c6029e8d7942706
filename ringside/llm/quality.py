"""Operator 9: quality classifier, a factorisation machine.

A document's features are its hashed words, its structure statistics and
numbers known about it (metadata columns). The model adds, to a linear part,
all pairwise interactions with weights <v_i, v_j>; the sum over pairs is
computed in linear time as half of (sum of v_i x_i) squared minus the sum of
squares. The model is a fixed-size set of arrays (2^16 words by RANK floats by
default), trained from a bounded sample of labelled rows and applied to whole
texts in Arrow batches, without any shuffle of texts.

Features
* words: lower-cased runs of non-white-space, hashed by CRC-32 into 2^word_bits
  places; a place's value is 1 + log(count), all divided by their norm;
* structure: see STRUCTURE; each is cut into BINS steps at the training sample's
  quantiles, and the step is a feature of value 1 / sqrt(number of statistics);
* metadata: named numeric columns, cut in the same way; null is a step of its own.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.llm.common import WORD, fresh, table, whole_text

#: The structure statistics, in order.
STRUCTURE = ["words", "mean_word", "distinct_share", "top_word_share", "upper_share", "digit_share", "symbol_share",
             "symbol_word_share", "space_share", "lines", "repeated_line_share", "end_mark_share", "repeated_pair_share",
             "non_ascii_share"]
BINS = 24
RANK = 8
WORD_BITS = 16
#: At most so many labelled rows are fitted; they are the ones with the smallest hash of their id.
MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.3
SEED = 42

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[^\w\s.,;:'\"()\-!?]|[|]")


def structure(text: str, words: list[str], counts: dict[str, int]) -> list[float]:
    """The values of STRUCTURE for one text; all 0 for a text without words."""
    if not words:
        return [0.0] * len(STRUCTURE)
    n, chars = len(words), len(text)
    letters = sum(map(len, words))
    upper = len(text) - len(text.translate(_UPPER))
    digits = len(text) - len(text.translate(_DIGITS))
    symbols = len(_SYMBOL.findall(text))
    marked = sum(c for w, c in counts.items() if _ODD_WORD(w))
    lines = [x for x in text.split("\n") if x]
    pairs = set(zip(words, words[1:]))
    return [np.log1p(n), letters / n, len(counts) / n, max(counts.values()) / n, upper / chars, digits / chars,
            symbols / chars, marked / n, (chars - letters) / chars, np.log1p(len(lines)),
            1 - len(set(lines)) / max(1, len(lines)),
            sum(x[-1] in ".!?" for x in lines) / max(1, len(lines)), 1 - len(pairs) / max(1, n - 1),
            1 - len(text.encode("ascii", "ignore")) / chars]


_UPPER = dict.fromkeys(range(65, 91))
_DIGITS = dict.fromkeys(range(48, 58))
_ODD_WORD = re.compile(r"[^\w.,;:'\"()\-!?]|[!?]{2}").search


def count_words(words: list[str]) -> dict[str, int]:
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    return counts


def features(text: str, word_bits: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Places and values of the hashed words, and the structure statistics."""
    words = _WORD.findall(text)
    raw = count_words(words)
    stats = structure(text, words, raw)
    mask = (1 << word_bits) - 1
    places = np.fromiter((zlib.crc32(w.lower().encode()) & mask for w in raw), np.int64, len(raw))
    at, inverse = np.unique(places, return_inverse=True)
    values = 1 + np.log(np.maximum(1, np.bincount(inverse, weights=np.fromiter(raw.values(), np.float64, len(raw)))))
    norm = np.sqrt((values * values).sum()) if len(at) else 1.0
    return at, (values / norm).astype(np.float32), stats


@dataclass
class Machine:
    """The fitted arrays. Features are numbered: words first, then the steps of each statistic."""

    word_bits: int
    cuts: list[np.ndarray]
    bias: float = 0.0
    linear: np.ndarray = field(default=None, repr=False)
    factors: np.ndarray = field(default=None, repr=False)

    def step_features(self, stats: np.ndarray) -> np.ndarray:
        """(rows, statistics) -> numbers of the features that are on; NaN is the last step."""
        width, base = BINS + 1, 1 << self.word_bits
        cols = [np.where(np.isnan(stats[:, j]), BINS, np.searchsorted(c, stats[:, j], side="right"))
                + base + j * width for j, c in enumerate(self.cuts)]
        return np.stack(cols, axis=1)

    def size(self) -> int:
        return (1 << self.word_bits) + len(self.cuts) * (BINS + 1)

    def rows(self, feats: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of several rows as one flat sparse matrix: starts, feature numbers, values."""
        steps = self.step_features(np.array([f[2] for f in feats], np.float64).reshape(len(feats), -1))
        share = np.full(steps.shape[1], 1 / np.sqrt(max(1, steps.shape[1])), np.float32)
        at = [np.concatenate((f[0], s)) for f, s in zip(feats, steps)]
        starts = np.concatenate(([0], np.cumsum([len(a) for a in at])[:-1]))
        return starts, np.concatenate(at), np.concatenate([np.concatenate((f[1], share)) for f in feats])

    def margin(self, starts, at, x):
        """Linear part plus pair part by the sum-of-squares identity; also the factor sums for training."""
        v = self.factors[at] * x[:, None]
        sums = np.add.reduceat(v, starts)
        squares = np.add.reduceat((v * v).sum(1), starts)
        line = np.add.reduceat(self.linear[at] * x, starts)
        return self.bias + line + 0.5 * ((sums * sums).sum(1) - squares), sums

    def score(self, feats: list) -> np.ndarray:
        if not feats:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margin(*self.rows(feats))[0], -30, 30).astype(np.float64)))


def train(feats: list, labels: np.ndarray, word_bits: int = WORD_BITS, rank: int = RANK, steps: int = 2000,
          rate: float = 0.1, decay: float = 1e-5, batch: int = 128, seed: int = SEED) -> Machine:
    """Fit by AdaGrad on log loss: so many steps over seeded batches; equal input gives an equal machine."""
    rng = np.random.default_rng(seed)
    stats = np.array([f[2] for f in feats], np.float64)
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = [np.unique(np.nanquantile(c, points)) if np.isfinite(c).any() else np.zeros(0) for c in stats.T]
    m = Machine(word_bits, cuts)
    n = m.size()
    m.linear = np.zeros(n, np.float32)
    m.factors = rng.normal(0, 0.05, (n, rank)).astype(np.float32)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    m.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v = np.full(n, 1e-4, np.float32), np.full((n, rank), 1e-4, np.float32)
    order = np.zeros(0, np.int64)
    for _ in range(steps):
        if len(order) < batch:
            order = np.concatenate((order, rng.permutation(len(feats))))
        picked, order = order[:batch], order[batch:]
        starts, at, x = m.rows([feats[i] for i in picked])
        z, sums = m.margin(starts, at, x)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[picked]).astype(np.float32) / len(picked)
        lengths = np.diff(np.append(starts, len(at)))
        pull = np.repeat(error, lengths) * x
        by_place, inverse = np.unique(at, return_inverse=True)
        gw = np.bincount(inverse, pull, len(by_place)).astype(np.float32) + decay * m.linear[by_place]
        slope = pull[:, None] * (np.repeat(sums, lengths, axis=0) - m.factors[at] * x[:, None])
        gv = np.stack([np.bincount(inverse, slope[:, f], len(by_place)) for f in range(rank)], 1).astype(np.float32)
        gv += decay * m.factors[by_place]
        seen_w[by_place] += gw * gw
        seen_v[by_place] += gv * gv
        m.linear[by_place] -= rate * gw / np.sqrt(seen_w[by_place])
        m.factors[by_place] -= rate * gv / np.sqrt(seen_v[by_place])
        m.bias -= rate * float(error.sum())
    return m


def _with_metadata(feats, row):
    return feats[0], feats[1], [*feats[2], *row]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, metadata: tuple[str, ...] = (),
                  id_col: str = "doc_id") -> DataFrame:
    """At most max_rows labelled documents, those with the smallest hash of their id: (id, y, text, m0, ...).

    Only the chosen ids are joined to the texts. Rows whose id or label is null
    take no part, nor do ids whose labels contradict each other. Of documents that
    share an id the one with the smallest text hash is taken.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("y")).dropna().groupBy("id").agg(
        F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most")
    # max_rows bounds this side: an id and a number each
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_rows).select("id", F.col("y").cast("double").alias("y"))
    numbers = [F.col(f"`{c}`").cast("double").alias(f"m{i}") for i, c in enumerate(metadata)]
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text().alias("text"), *numbers)
    row = F.struct("text", *[f"m{i}" for i in range(len(numbers))])
    first = F.min_by(row, F.struct(F.xxhash64("text"), *[f"m{i}" for i in range(len(numbers))])).alias("row")
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.first("y").alias("y"), first).select("id", "y", "row.*")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS,
        metadata: tuple[str, ...] = (), word_bits: int = WORD_BITS, id_col: str = "doc_id", **settings) -> Machine | None:
    """Fit on labelled rows of docs; None where there is no labelled row (scores are then 0.5).

    Features are made where the texts are; one task gets the sparse features of at
    most max_rows rows, each of at most 2^word_bits places, and the driver the fitted arrays.
    """
    got = fitted(training_rows(docs, labels, label, max_rows, metadata, id_col), word_bits, **settings).collect()
    if not got:
        return None
    found, = got
    linear = np.frombuffer(found["linear"], "<f4")
    return Machine(word_bits, [np.array(c, np.float64) for c in found["cuts"]], found["bias"], linear,
                   np.frombuffer(found["factors"], "<f4").reshape(len(linear), -1))


def fitted(rows: DataFrame, word_bits: int = WORD_BITS, **settings) -> DataFrame:
    """The arrays of the machine that (id, y, text, m0, ...) teach, as one row; no row where there is none to learn from."""

    def sparse(batches):
        for pdf in batches:
            meta = pdf[[c for c in pdf.columns if c.startswith("m")]].to_numpy(np.float64)
            feats = [_with_metadata(features(t, word_bits), m) for t, m in zip(pdf["text"], meta)]
            yield pd.DataFrame({"id": pdf["id"], "y": pdf["y"],
                                "at": [f[0].astype("<u4").tobytes() for f in feats],
                                "x": [f[1].astype("<f4").tobytes() for f in feats],
                                "stats": [np.asarray(f[2], "<f8").tobytes() for f in feats]})

    def learn(batches):
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        got = pa.Table.from_batches(held).combine_chunks()
        # views into the table's buffers, nothing is copied
        parts = [[np.frombuffer(v.as_buffer(), kind) for v in got.column(c).chunk(0)] for c, kind in (("at", "<u4"), ("x", "<f4"), ("stats", "<f8"))]
        m = train(list(zip(*parts)), got.column("y").to_numpy(), word_bits, **settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.bias], pa.float64()), pa.array([m.linear.tobytes()], pa.binary()), pa.array([m.factors.tobytes()], pa.binary()),
             pa.array([[c.tolist() for c in m.cuts]], pa.list_(pa.list_(pa.float64())))], ["bias", "linear", "factors", "cuts"])

    feats = rows.mapInPandas(sparse, "id bigint, y double, at binary, x binary, stats binary")
    return feats.repartition(1).sortWithinPartitions("id").mapInArrow(
        learn, "bias double, linear binary, factors binary, cuts array<array<double>>")


def score(docs: DataFrame, machine: Machine | None, name: str = "score", metadata: tuple[str, ...] = ()) -> DataFrame:
    """docs with one more column: the chance (0 to 1) of label 1, for every row, null and empty texts included.

    All columns stay. A text is scored as a whole; equal texts with equal metadata get equal scores.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    if machine is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # arrays of a fixed size

    @F.pandas_udf("double")
    def of(texts: pd.Series, meta: pd.DataFrame) -> pd.Series:
        m = shared.value
        out = np.empty(len(texts))
        values = meta.to_numpy(np.float64)[:, 1:]
        for i in range(0, len(texts), 64):
            feats = [_with_metadata(features(t, m.word_bits), v) for t, v in zip(texts.iloc[i:i + 64], values[i:i + 64])]
            out[i:i + 64] = m.score(feats)
        return pd.Series(out)

    numbers = F.struct(F.lit(0.0).alias("n"), *[F.col(f"`{c}`").cast("double").alias(f"m{i}") for i, c in enumerate(metadata)])
    return docs.withColumn(name, of(whole_text(), numbers))


def held_out(id_col: str = "doc_id"):
    """True where CRC-32 of the id as text leaves 0 modulo 5; a null id is never learnt from, so it counts as held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


METADATA = ("n_chars",)


def _learnt(docs, labels):
    learn = labels.filter(~held_out())
    return fit(docs.filter(~held_out()), learn, "quality", metadata=METADATA)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier does not reject, with the columns they came with."""
    name = fresh(docs, "_score")[0]
    return score(docs, _learnt(docs, labels), name, METADATA).filter(F.col(name) >= threshold).drop(name)


def op9(spark, sf_dir):
    """Quality score of every document, learnt from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text", *METADATA), _learnt(docs, labels), "score", METADATA)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op9_quality_factorisation_machine": op9}
