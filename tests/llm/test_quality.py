import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from ringside.llm import quality


def test_pair_part_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = quality.Machine(4, [np.array([0.5])], 0.3, rng.normal(size=64).astype(np.float32), rng.normal(size=(64, 3)).astype(np.float32))
    feats = [(np.array([1, 5, 9]), np.array([.5, .2, .7], np.float32), [0.1]), (np.zeros(0, np.int64), np.zeros(0, np.float32), [np.nan])]
    starts, at, x = m.rows(feats)
    got, _ = m.margin(starts, at, x)
    for r, (a, b) in enumerate(zip(starts, [*starts[1:], len(at)])):
        want = m.bias + sum(m.linear[i] * v for i, v in zip(at[a:b], x[a:b])) + sum(
            float(m.factors[at[i]] @ m.factors[at[j]]) * x[i] * x[j] for i, j in itertools.combinations(range(a, b), 2))
        assert abs(got[r] - want) < 1e-4


def test_query_separates_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = quality.op9(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9
    assert all(r["predicted"] == 1 for r in held if r["quality"] == 1)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x"))
    one = quality.score(docs, quality._learnt(docs, labels), "s", ("n_chars",)).select("doc_id", "s").collect()
    two = quality.score(other, quality._learnt(other, turned), "s", ("n_chars",)).select("doc_id", "s").collect()
    assert dict(map(tuple, one)) == dict(map(tuple, two))


def test_nulls_empty_texts_and_tables(spark):
    docs = spark.createDataFrame([(1, "good words here. And more.", 5, 7), (2, None, None, 8), (None, "", 0, 9),
                                  (3, "w " * 200_000, None, 1), (3, "w " * 200_000, None, 1)],
                                 "doc_id long, text string, n_chars long, _score int")
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None)], "doc_id long, quality int")
    m = quality.fit(docs, labels, metadata=("n_chars",), steps=20)
    rows = quality.score(docs, m, "s", ("n_chars",)).collect()
    assert len(rows) == 5 and all(0 <= r["s"] <= 1 for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert quality.fit(docs, labels.limit(0)) is None
    assert [r["s"] for r in quality.score(docs, None, "s").collect()] == [0.5] * 5
    assert quality.score(docs.limit(0), m, "s", ("n_chars",)).count() == 0
    clash = quality.training_rows(docs, labels.union(labels.selectExpr("doc_id", "1 - quality")), "quality", 10)
    assert clash.count() == 0


def test_the_driver_gets_the_fitted_arrays_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = quality.training_rows(docs, labels, "quality", 500)
    learnt = sorted(rows.collect(), key=lambda r: r["id"])
    want = quality.train([quality.features(r["text"], 12) for r in learnt], np.array([r["y"] for r in learnt]), 12, steps=30)
    assert [len(r["linear"]) for r in quality.fitted(rows, 12, steps=30).collect()] == [want.linear.nbytes]
    got = quality.fit(docs, labels, max_rows=500, word_bits=12, steps=30)
    assert got.bias == want.bias and np.array_equal(got.linear, want.linear) and np.array_equal(got.factors, want.factors)
    assert all(np.array_equal(a, b) for a, b in zip(got.cuts, want.cuts, strict=True))
    assert quality.fitted(rows.limit(0)).count() == 0
