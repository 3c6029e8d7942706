import math
import random

import pytest

from ringside.llm import topk


def plain(rows, k, every=100):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in fine if i % every == 0}):
        mine = max(v for i, v in fine if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in fine if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def _rows(seed=0, n=500):
    rng = random.Random(seed)
    rows = [(i * 10, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(n)]
    rows += [(7 + i, [0.5] * 6) for i in range(0, 300, 2)]  # a common vector: ties
    rows += [(None, [1.0] * 6), (11, None), (13, [1.0, None]), (17, [float("nan")] * 6), (19, [float("inf")] * 6), (200, []),
             (23, [1.0] * 9), (300, [1.0] * 3), (0, [0.1] * 6), (40, [0.1] * 6), (40, [0.1] * 6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"query_block": 7, "candidate_block": 33, "lanes": 3}])
def test_equals_brute_force(spark, how):
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    v = topk.quantised(df, "vec_id", "embedding")
    got = [tuple(r) for r in topk.top_k(v, v.filter("id % 100 = 0"), 10, **how).collect()]
    assert sorted(got) == plain(rows, 10)


def test_few_candidates_empty_tables_and_overflow(spark):
    df = spark.createDataFrame([(100, [1.0, -2.0], "a"), (1, [3.0, 0.25], "b")], "vec_id long, embedding array<float>, id string")
    v = topk.quantised(df, "vec_id", "embedding")
    assert [tuple(r) for r in topk.top_k(v, v.filter("id % 100 = 0")).collect()] == [(100, 1, 1, 1024 * 3 * 1024 - 2048 * 256)]
    assert topk.top_k(v.limit(0), v).count() == 0 and topk.top_k(v, v.limit(0)).count() == 0
    big = topk.quantised(spark.createDataFrame([(0, [1e12]), (1, [1e12])], "i long, v array<double>"), "i", "v")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(big, big).collect()


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in topk.op5(spark, folder).collect()) == plain(rows, 10)
