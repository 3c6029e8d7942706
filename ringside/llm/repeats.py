"""Operator 3: repeated passages, by a depth-limited radix sort of suffixes.

Every 200-byte window that starts at two or more places is found, by sorting the
suffixes that begin the windows only as deep as the window goes, most
significant digit first. After each digit the groups of one fall out; groups
that are left after the last digit are exactly the repeated windows.

Sorting every suffix would move several hundred bytes per byte of text, so a
digit handles many neighbouring suffixes at once, and digits are taken outwards
from an anchor that equal windows share:

1. first digit, a gram of 24 bytes: a window's anchor is its leftmost gram of
   least code; neighbouring windows with one anchor form a run, about 90
   windows long. Runs alone with their gram hold no repeated window.
2. runs that cover equal bytes are repeated as wholes; one of each such kind goes
   on with the runs that share its gram only.
3. second digit, the bytes common to all windows of a sub-run (16 windows):
   sub-runs alone with theirs fall out, those that cover equal bytes are repeated.
4. last digit, the whole window, for the windows that are left.

Digits are compared by 64-bit codes, and every decision that two stretches are
equal rests on two independent ones (128 bits). Rows are (document, place,
codes): texts move once, keyed by document. Groups are counted with partial
sums; a digit shared by more than HOT rows is counted and joined back in a way
that Spark can split over tasks, others by a window over the digit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringside.llm import suffixes
from ringside.llm.common import table, whole_text
from ringside.session import cut

WINDOW = 200
STEP = 16
HOT = 200_000

#: place packs the first window's byte, the number of windows (at most the window's length) and the anchor's distance.
_RUN = "id bigint, k bigint, digit bigint, ext bigint, place bigint"
_BITS = 12


def _place(first, n, anchor):
    return ((np.asarray(first, np.int64) << _BITS | n) << _BITS) | (np.asarray(anchor) - first)


def _first_n_anchor(place: np.ndarray):
    low = (1 << _BITS) - 1
    first = place >> (2 * _BITS)
    return first, place >> _BITS & low, first + (place & low)


def by_row(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, k, text): id is never null, k tells rows with equal ids but other texts apart, and a null id from 0."""
    i, t = F.col(f"`{id_col}`").cast("bigint"), whole_text(text)
    return docs.select(F.coalesce(i, F.lit(0).cast("bigint")).alias("id"), F.xxhash64(i, t).alias("k"), t.alias("text"))


def _frame(ids, ks, parts, names):
    if not parts:
        return pd.DataFrame({"id": [], "k": [], **{n: [] for n in names}})
    lengths = [len(p[0]) for p in parts]
    out = {"id": np.repeat(np.array(ids, np.int64), lengths), "k": np.repeat(np.array(ks, np.int64), lengths)}
    out |= {n: np.concatenate([p[i] for p in parts]) for i, n in enumerate(names)}
    return pd.DataFrame(out)


def _emit(batches, of_text, names, at_most=400_000):
    """Frames of what of_text yields for each row, a bounded number of rows at a time."""
    ids, ks, parts, held = [], [], [], 0
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            for part in of_text(np.frombuffer(row.text.encode(), np.uint8), row):
                ids.append(row.id)
                ks.append(row.k)
                parts.append(part)
                held += len(part[0])
                if held >= at_most:
                    yield _frame(ids, ks, parts, names)
                    ids, ks, parts, held = [], [], [], 0
    if parts:
        yield _frame(ids, ks, parts, names)


def _runs(docs: DataFrame, window: int) -> DataFrame:
    def scan(batches):
        coder = suffixes.Coder(window)

        def of_text(data, _):
            for gram, ext, first, n, anchor in suffixes.runs(data, coder, window):
                yield gram, ext, _place(first, n, anchor)

        return _emit(batches, of_text, ["digit", "ext", "place"])

    long_enough = docs.select("id", "k", "text").filter(F.octet_length("text") >= window)
    return long_enough.mapInPandas(scan, _RUN)


def _lists(rows: DataFrame) -> DataFrame:
    """Places per document, in order; a document's list is no longer than its text."""
    return rows.groupBy("id", "k").agg(F.sort_array(F.collect_list("place")).alias("list"))


def _sub_runs(texts: DataFrame, rows: DataFrame, window: int, step: int) -> DataFrame:
    def scan(batches):
        coder = suffixes.Coder(window)

        def of_text(data, row):
            for core, ext, first, n in suffixes.sub_runs(data, coder, window, step, *_first_n_anchor(row.list)):
                yield core, ext, _place(first, n, first)

        return _emit(batches, of_text, ["digit", "ext", "place"])

    return texts.join(_lists(rows), ["id", "k"]).select("id", "k", "text", "list").mapInPandas(scan, _RUN)


def _windows(texts: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    def scan(batches):
        coder = suffixes.Coder(window)

        def of_text(data, row):
            first, n, _ = _first_n_anchor(row.list)
            for x, y, start in suffixes.window_codes(data, coder, window, first, n):
                yield x, y, _place(start, 1, start)

        return _emit(batches, of_text, ["x", "y", "place"])

    return texts.join(_lists(rows), ["id", "k"]).select("id", "k", "text", "list").mapInPandas(
        scan, "id bigint, k bigint, x bigint, y bigint, place bigint")


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digit").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")


def _sift(rows: DataFrame, sizes: DataFrame, hot: int, crowded: bool) -> DataFrame:
    """One digit's pass: rows that share it with others, as (id, k, place, whole, open).

    whole: another row covers equal bytes. open: goes on to the next digit, because the
    digit's group holds other bytes too; of rows with equal bytes only one goes on.
    crowded: whether a digit can have more than hot rows.
    """
    cols = ["id", "k", "place", (F.col("same") > 1).alias("whole"), (F.col("mixed") & F.col("head")).alias("open")]
    digit, both = Window.partitionBy("digit"), Window.partitionBy("digit", "ext")
    few, many = rows, None
    if crowded:  # hot digits leave before the others are brought together by digit
        hot_digits = sizes.filter(F.col("size") > hot).select("digit")
        few, many = rows.join(hot_digits, "digit", "left_anti"), rows.join(hot_digits, "digit", "left_semi")
    cold = few.join(sizes.select("digit"), "digit").withColumns({
        "same": F.count(F.lit(1)).over(both),
        "mixed": F.min("ext").over(digit) != F.max("ext").over(digit),
        "head": F.row_number().over(both.orderBy("id", "k", "place")) == 1}).select(*cols)
    if not crowded:
        return cold.filter("whole or open")
    who = F.struct("id", "k", "place")
    kinds = many.groupBy("digit", "ext").agg(F.count(F.lit(1)).alias("same"), F.min(who).alias("least"))
    digits = kinds.groupBy("digit").agg((F.min("ext") != F.max("ext")).alias("mixed"))
    warm = many.join(kinds.join(digits, "digit"), ["digit", "ext"]).withColumn("head", who == F.col("least"))
    return cold.union(warm.select(*cols)).filter("whole or open")


def repeated_spans(rows: DataFrame, texts: DataFrame, window: int = WINDOW, step: int = STEP, hot: int = HOT) -> DataFrame:
    """(id, k, stretches) of by_row() rows: lists of (first, n), n windows from byte first on that occur elsewhere too.

    texts: the same rows, partitioned by (id, k).
    """
    found = _runs(rows, window)
    grams = cut(_sizes(found), "grams")
    # a later digit holds the gram, so its groups are no larger
    crowded = not grams.filter(F.col("size") > hot).isEmpty()
    runs = cut(_sift(found, grams, hot, crowded), "runs")
    pieces = _sub_runs(texts, runs.filter("open"), window, step)
    sub = _sift(pieces, _sizes(pieces), hot, crowded)
    singles = _windows(texts, sub.filter("open"), window)
    twice = singles.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    found = singles.join(twice, ["x", "y"]).select("id", "k", "place")
    every = runs.filter("whole").select("id", "k", "place").union(sub.filter("whole").select("id", "k", "place")).union(found)
    return every.groupBy("id", "k").agg(F.collect_set("place").alias("places"))


def _ranges(places, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges that the windows of these places cover, neighbours joined: starts and stops."""
    first, n, _ = _first_n_anchor(np.sort(places))
    stop = np.maximum.accumulate(first + n + window - 1)
    new = np.concatenate(([True], first[1:] > stop[:-1]))
    return first[new], stop[np.append(np.flatnonzero(new)[1:], len(stop)) - 1]


def strip_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: removed byte ranges [start, stop) and the bytes that stay.

    A null text counts as empty and a text shorter than the window keeps all its
    bytes. Rows with equal id and text are two documents, so their windows are
    repeated. Matches never cross documents. kept is binary, since a range may
    end inside a character. Other columns play no part.
    """
    rows = by_row(docs, id_col, text)
    texts = rows.repartition("id", "k")  # one exchange, read by every later step
    joined = texts.join(repeated_spans(rows, texts, window, **how), ["id", "k"], "left")
    nameless = (F.col("id") == 0) & (F.col("k") != F.xxhash64(F.lit(0).cast("bigint"), F.col("text")))

    def remove(batches):
        for pdf in batches:
            spans, kept, sizes = [], [], []
            for t, places in zip(pdf["text"], pdf["places"]):
                data = t.encode()
                starts, stops = ([], []) if places is None else _ranges(np.asarray(places, np.int64), window)
                kept.append(b"".join([data[a:b] for a, b in zip([0, *stops], [*starts, len(data)])]))
                spans.append([{"start": int(a), "stop": int(b)} for a, b in zip(starts, stops)])
                sizes.append(len(data))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": sizes, "spans": spans, "kept": kept})

    return joined.select(F.when(~nameless, F.col("id")).cast("string").alias("doc_id"), "text", "places").mapInPandas(
        remove, "doc_id string, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary").withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))


def op3(spark, sf_dir):
    """What 200-byte repeats take out of every document."""
    out = strip_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op3_suffix_repeats": op3}
