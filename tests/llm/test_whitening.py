import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringside.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def remaining(rows):
    """(ids, x) by plain Python: floors, drops."""
    ok = [(i, [float(np.float32(c)) for c in e]) for i, e in rows
          if e and all(c is not None and math.isfinite(c) for c in e)]
    wide = max((len(e) for _, e in ok), default=0)
    ok = [(i, [math.floor(1024 * c) + 100_000 for c in e]) for i, e in ok if len(e) == wide]
    return [i for i, _ in ok], [x for _, x in ok]


def plain(rows, most=8):
    ids, x = remaining(rows)
    n = len(x)
    sums = [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = sum(v > 1e-10 * values.sum() for v in values[:most])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return ids, n, deviation, centred @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def compare(spark, rows, most=8):
    ids, n, deviation, white, explained = plain(rows, most)
    got = defaultdict(list)
    for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA), most).collect():
        got[r["vec_id"]].append(r)
    assert sorted(got, key=str) == sorted(set(ids), key=str)
    sign = {}
    for i, d, w in zip(ids, deviation, white):
        own = sorted((r for r in got[i] if r["deviation"] == d), key=lambda r: r["component"])
        assert {r["component"] for r in own} == set(range(1, len(explained) + 1))
        for r in own:
            c = r["component"] - 1
            assert r["n"] == n and r["identity_error"] < 1e-9
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
            if abs(w[c]) > 1e-3:
                sign.setdefault(c, np.sign(w[c] * r["whitened"]))
            assert r["whitened"] * sign.get(c, 1) == pytest.approx(w[c], abs=1e-6)


def vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * np.linspace(2, 0.3, dims) + rng.normal(size=dims)
    return [(i, [float(c) for c in r]) for i, r in enumerate(x)]


@pytest.mark.parametrize("n,dims", [(60, 12), (200, 3), (5, 20), (2, 4)])
def test_equals_plain_whitening(spark, n, dims):
    compare(spark, vectors(n, n, dims))


def test_dropped_rows_null_and_repeated_ids(spark):
    rows = vectors(1, 40, 6)
    rows += [(100, None), (101, []), (102, [1.0, None] * 3), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5),
             (105, [1.0] * 5), (None, [0.5] * 6), (7, [9.0, -9.0, 1.0, 2.0, 3.0, 4.0])]
    compare(spark, rows)


def test_no_spread_one_row_and_empty_table(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_deviation_beyond_64_bits_is_null_and_the_rest_holds(spark):
    rows = [(i, [float(i * 2 ** 40), float(i % 3)]) for i in range(9)] + [(99, [3e38, 0.0])]  # the last leaves 64 bits itself
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == set(range(9))
    assert {r["deviation"] is None for r in got if r["vec_id"] in (0, 8)} == {True}
    w = sorted((r["vec_id"], r["whitened"]) for r in got if r["component"] == 1)
    want = (np.arange(9) - 4) / np.std(np.arange(9))
    assert np.allclose(np.abs([v for _, v in w]), np.abs(want), atol=1e-6)


def test_other_columns_play_no_part(spark):
    rows = vectors(3, 30, 4)
    docs = spark.createDataFrame(rows, SCHEMA)
    wide = docs.select("*", *[F.lit(1).alias(c) for c in ("id", "x", "n", "at", "lane", "m", "component")])
    plain_rows, wide_rows = (sorted(map(tuple, whitening.whiten(d).collect())) for d in (docs, wide))
    assert plain_rows == wide_rows


@pytest.mark.parametrize("values", [
    [5.0] * 20, [3.0, 3.0, 3.0, 1.0, 1.0, 0.0, 0.0], list(10.0 ** -np.linspace(0, 11, 30)),
    [1e6, 1e6 * (1 - 1e-10), 1e6 * (1 - 1e-13), *range(30)], [2.0], [2.0, 1.0]])
def test_spectrum_with_equal_close_and_tiny_eigenvalues(values):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0]
    v = q @ np.diag(values) @ q.T
    got, axes = whitening.leading(v)
    want = sorted(values, reverse=True)[:8]
    want = [w for w in want if w > 1e-9 * sum(values)]
    assert len(got) >= len(want)
    assert np.allclose(got[:len(want)], want, rtol=1e-12, atol=1e-13 * max(values) * len(values))
    assert np.allclose(axes @ axes.T, np.eye(len(got)), atol=1e-12)
    assert np.allclose(axes @ v, got[:, None] * axes, atol=1e-12 * max(values) * len(values))


def test_counts_equal_the_spectrum():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(25, 25))
    v = a + a.T
    diagonal, off = whitening.tridiagonal(v)
    w = np.linalg.eigvalsh(v)
    for shift in (*((w[1:] + w[:-1]) / 2), w[0] - 1, w[-1] + 1):
        assert whitening.above(diagonal, off, shift) == (w > shift).sum()


def test_query_equals_plain_whitening_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, n, deviation, white, explained = plain(rows)
    got = whitening.op11(spark, folder).toPandas()
    assert len(got) == 8 * len(ids) and got["identity_error"].max() < 1e-9
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.allclose(np.abs(table), np.abs(white), atol=1e-6)
    one = got.drop_duplicates("vec_id").set_index("vec_id").loc[ids]
    assert one["deviation"].tolist() == deviation and set(one["n"]) == {n}
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-9)
