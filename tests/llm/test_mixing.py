import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ringside.llm import mixing


def plain_seats(votes, seats, most):
    out = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if v > 0 and most[i] > 0]
    heapq.heapify(heap)
    while seats and heap:
        _, i = heapq.heappop(heap)
        out[i] += 1
        seats -= 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def test_seats_equal_one_by_one_handing_out():
    rng = random.Random(0)
    for _ in range(200):
        votes = [rng.choice([0, 1, 1, 2, rng.uniform(0, 50), rng.randint(0, 500)]) for _ in range(rng.randint(1, 12))]
        most = [rng.randint(0, 400) for _ in votes]
        seats = rng.randint(0, 600)
        assert mixing.sainte_lague(votes, seats, most).tolist() == plain_seats(votes, seats, most)


def test_targets_share_the_excess():
    got = mixing.targets([100, 1000, 10, 0], [5, 2, 1, 5])
    assert got[0] == 200 and got[2] == 20 and got[3] == 0 and got.sum() == pytest.approx(1665)
    assert mixing.targets([], []).tolist() == []


def test_taken_words_equal_marking_every_word():
    rng = np.random.default_rng(1)
    for blocks, quota in ((7, 3), (7, 14), (5, 8), (1, 1), (3, 0)):
        size = rng.integers(0, 30, 12)
        n = int(size.sum())
        edges = [i * n // blocks for i in range(blocks + 1)]
        times = np.full(blocks, quota // blocks)
        times[np.random.Generator(np.random.PCG64(9)).permutation(blocks)[:quota % blocks]] += 1
        marks = np.concatenate([np.full(b - a, t) for a, b, t in zip(edges, edges[1:], times)])
        stops = np.cumsum(size)
        want = [int(marks[s - z:s].sum()) for s, z in zip(stops, size)]
        assert mixing.taken_words(size, blocks, quota, 9).tolist() == want


def _shares(rows):
    per = defaultdict(int)
    for r in rows:
        per[r["target"], r["source_size"]] += r["taken"]
    return per


def test_query_holds_targets_and_caps(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.op1(spark, folder).collect()
    text = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter(text.keys())
    size = defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]][0]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        size[text[r["doc_id"]][1]] += r["size"]
    names = sorted(size, key=lambda s: s.encode())
    want = dict(zip(names, mixing.targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
    assert sum(want.values()) == pytest.approx(1.5 * sum(size.values()))
    taken = defaultdict(int)
    for r in rows:
        s = text[r["doc_id"]][1]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(want[s])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 64 for s in names)
    again = mixing.mix(docs.repartition(7), shard_rows=2000).drop("k").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_small_shards_nulls_and_clashing_columns(spark):
    rows = [(i, "w " * (i % 40), ["b", "a", None, "ü", "empty"][i % 5], 1) for i in range(300)]
    rows = [(d, None if s == "empty" else t, s, n) for d, t, s, n in rows] + [(None, "x y", "a", 1), (5, "x", "b", 1), (5, "x", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    out = mixing.mix(docs, shard_rows=10, block=8)
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for (target, _), taken in _shares(got).items():
        assert abs(taken - target) <= 0.05 * target + 8
    kept = mixing.mixed(docs, shard_rows=10, block=8)
    assert kept.columns == docs.columns and 0 < kept.count() <= 2 * len(rows)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="sources"):
        mixing.MAX_SOURCES, before = 1, mixing.MAX_SOURCES
        try:
            mixing.mix(docs)
        finally:
            mixing.MAX_SOURCES = before
