from collections import Counter, defaultdict

import numpy as np
import pytest

from ringside.llm import mixing


def _line(seed, n, ratio):
    rng = np.random.default_rng(seed)
    size = np.concatenate([rng.integers(5, 60, n), rng.integers(900, 6000, n)])
    rng.shuffle(size)
    blocks = int(size.sum()) // 64
    return size, mixing.taken_words(size, blocks, round(ratio * blocks), seed)


def test_whole_copies_keep_the_words_and_the_long_documents():
    for ratio in (0.1, 1 / 3, 0.45, 0.8, 1.2, 1.6, 2):
        size, taken = _line(3, 1000, ratio)
        copies = mixing.whole_copies(size, taken, 7)
        assert np.all(copies >= taken // size) and np.all(copies <= -(-taken // size))
        assert abs(int((copies * size).sum()) - int(taken.sum())) <= 6000
        long = size >= 900
        assert copies[long].mean() == pytest.approx(ratio, abs=0.05)


def test_chance_of_a_copy_is_the_share():
    size, taken = np.array([4000, 900, 300, 0]), np.array([1000, 1200, 150, 0])
    mean = np.mean([mixing.whole_copies(size, taken, seed) for seed in range(4000)], axis=0)
    assert mean[0] == pytest.approx(0.25, abs=0.03) and mean[3] == 0
    assert mixing.whole_copies(np.zeros(0, np.int64), np.zeros(0, np.int64), 1).tolist() == []


def test_mixed_meets_the_target_of_a_hot_source_with_long_documents(spark):
    rng, rows = np.random.default_rng(8), []
    for i in range(1500):  # c: weight 1, a third of the documents and more, most of them long
        source = "abcc"[i % 4]
        n = int(rng.integers(900, 4000)) if source == "c" and i % 8 else int(rng.integers(20, 600))
        rows.append((i, " ".join(["w"] * n) + f" {i}", source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {}
    size = {r[0]: len(r[1].split()) for r in rows}
    total = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    names = sorted(total)
    for s, t in zip(names, mixing.targets([total[s] for s in names], [5, 2, 1])):
        target[s] = t
    got, long = defaultdict(int), 0
    out = mixing.mixed(docs).select("doc_id", "source").collect()
    for r in out:
        got[r["source"]] += size[r["doc_id"]]
        long += r["source"] == "c" and size[r["doc_id"]] >= 900
    assert max(Counter(r["doc_id"] for r in out).values()) <= 2
    for s in names:
        assert got[s] == pytest.approx(target[s], rel=0.02), s
    assert long / sum(s == "c" and size[i] >= 900 for i, _, s in rows) == pytest.approx(target["c"] / total["c"], abs=0.06)
    again = mixing.mixed(docs.repartition(5)).select("doc_id", "source").collect()
    assert Counter(again) == Counter(out)


def test_rows_of_one_id_and_text(spark):
    rows = [(1, "a b c " * 50, s, j) for j, s in enumerate(["x"] * 7 + ["y"] * 5 + [None] * 4)] + [(None, "p q", "x", 99), (2, None, "x", 98)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, named int")
    out = mixing.mixed(docs).collect()
    assert set(map(tuple, out)) <= set(rows) and max(Counter(r["named"] for r in out).values()) <= 2
    want = defaultdict(int)
    for r in mixing._taken(docs).collect():
        want[r["source"] if r["named"] else None] += r["copies"]
    assert Counter(r["source"] for r in out) == Counter(want)
