import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ringside.llm import signature_join as sj

SCHEMA = "doc_id bigint, text string"


def plain_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def plain_classes(rows, part, whole):
    """component of every row by comparing all pairs."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and whole * len(a & sets[j]) >= part * len(a | sets[j]):
                root[max(up(i), up(j))] = min(up(i), up(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[up(i)] = min(ids.get(up(i), d), d)
    return Counter((d, len(s), ids.get(up(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def copies(seed, groups, size, rates, words=90):
    """Groups of texts that differ from one base by random words."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(words + g)]
        for _ in range(size):
            rate = rng.choice(rates)
            rows.append(" ".join(w if rng.random() > rate else f"x{rng.randrange(9999)}" for w in base))
    rng.shuffle(rows)
    return list(enumerate(rows))


def got(spark, rows, similarity=sj.CONTRACT, **how):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sj.near_classes(docs, similarity, **how).collect()
    for r in found:
        assert r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"])
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)


def test_thresholds_come_from_the_binomial_tail():
    assert sj.matches(10, 1, 2, 0.02) == 2  # P(0) + P(1) = 11 / 1024, with P(2) above 0.02
    assert sj.matches(64, 85, 100) < 0.85 * 64 < 64
    assert sj.matches(5, 1, 100) == 1


@pytest.mark.parametrize("similarity", [sj.CONTRACT, sj.GENERAL])
def test_classes_equal_all_pairs(spark, similarity):
    rows = copies(1, 14, 9, [0.0, 0.005, 0.01, 0.02, 0.04])
    assert got(spark, rows, similarity) == plain_classes(rows, *similarity)


@pytest.mark.parametrize("piece", [4, 16])
def test_long_lists_equal_all_pairs(spark, piece):
    rows = copies(2, 3, 50, [0.002, 0.01, 0.015, 0.02, 0.03])
    want = plain_classes(rows, 85, 100)
    assert len({c for _, _, c in want}) > 10
    assert got(spark, rows, piece=piece) == want


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 120])) for i in range(12)]
    want = plain_classes(rows, 85, 100)
    assert {c for _, _, c in want} == {0}
    assert got(spark, rows) == want


def test_common_passages_link_nothing(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, passage + " " + " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(40))) for i in range(300)]
    assert got(spark, rows, piece=16) == plain_classes(rows, 85, 100)


def test_edges_nulls_ties_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  two"), (5, "one  two"), (None, "ONE two"),
            (6, "one two three four five six"), (7, "é È one two three"), (8, "É È one two three"), (None, "alone here"),
            (9, "long word " * 30_000), (10, "long word " * 29_000)]
    assert got(spark, rows) == plain_classes(rows, 85, 100)


def test_at_the_threshold(spark):
    # 85 of 100 shingles shared links, 84 of 100 does not
    words = [f"w{i}" for i in range(200)]
    base = " ".join(words[:104])  # 100 shingles
    sub = " ".join(words[:89])  # the first 85 of them
    less = " ".join(words[:88])
    assert got(spark, [(1, base), (2, sub)]) == Counter({(1, 100, 1): 1, (2, 85, 1): 1})
    assert got(spark, [(1, base), (2, less)]) == Counter({(1, 100, 1): 1, (2, 84, 2): 1})


def test_empty_table_and_clashing_columns(spark):
    assert not got(spark, [])
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words are in this text")], SCHEMA)
    names = ["node", "n", "signature", "posted", "mark", "text2", "k", "_k", "_head_id", "_head_k", "head", "family", "hashes", "label", "token", "_bucket", "_bits"]
    wide = docs.select("*", *[F.lit("x").alias(c) for c in names])
    assert {(r["doc_id"], r["component_id"]) for r in sj.near_classes(wide).collect()} == {(1, 1), (2, 1), (3, 3)}
    kept = sj.keep_one(wide)
    assert kept.columns == wide.columns and {r["doc_id"] for r in kept.collect()} == {1, 3}


def test_keep_one_keeps_one_of_each_component(spark):
    rows = copies(3, 6, 8, [0.0, 0.01, 0.03]) + [(100, ""), (101, None), (101, None), (None, "the last of all")]
    want = plain_classes(rows, 4, 5)
    kept = [r["doc_id"] for r in sj.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()]
    heads = {c for _, n, c in want if n} | {100}
    assert Counter(kept) == Counter(heads)


def test_real_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert got(spark, rows) == plain_classes(rows, 85, 100)


def test_joins_by_node_see_one_row_a_node(spark):
    """A group of near copies shares many lists; spread over them, its rows would grow with every join by node."""
    docs = spark.createDataFrame(copies(5, 1, 60, [0.0, 0.01]), SCHEMA)
    rows = sj.sketches(docs)
    nodes = rows.filter("node is not null").select("node", "n", "posted").distinct()
    posted = sj.postings(nodes, sj.CONTRACT)
    assert 1 < posted.count() == posted.select("node").distinct().count() <= nodes.count()
    assert sj.in_lists(posted).count() > 5 * posted.count()
    assert {"token", "node", "n", "rank", "mask"} == set(sj.in_lists(posted).columns)
