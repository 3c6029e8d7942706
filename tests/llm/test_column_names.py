"""Columns whose names the operators use themselves, as extra columns of their inputs.

The other operators' own tests add clashing names.
"""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ringside.llm import merkle, mixing, near_dedup, pii, quality, signature_join, whitening

FOLDER = "/root/testdata/sf0.001"
#: Every helper name in ringside/llm, and some common ones.
NAMES = ["_id", "_key", "_of", "_has", "_y", "_most", "_k", "_n", "_m", "_again", "_named", "_source", "_head_id", "_head_k", "_pii_seen",
         "_pii_kinds", "_pii_new", "_score", "_bucket", "_bit", "_bits", "id", "k", "fp", "node", "n", "head", "root", "size", "target",
         "taken", "copies", "shard", "place", "order", "words", "found", "score", "ids", "decoded", "position", "digest", "key", "value",
         "posted", "mark", "family", "token", "g", "leaf", "x", "row", "m0", "taken_", "named", "y"]


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return spark.createDataFrame(table.orderBy("doc_id").limit(60).collect(), table.schema)


def wide(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(NAMES) if c not in df.columns])


def rows(df, columns=None):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", [n for n in STAGES if "encod" not in n.lower()])
def test_stages(spark, docs, name):
    plain, more = (STAGES[name](spark, d, FOLDER) for d in (docs, wide(docs)))
    assert more.columns == wide(docs).columns
    assert rows(plain) == rows(more, docs.columns)


def test_last_stage(spark, docs):
    *_, (_, stage) = corpus_pipeline.STAGES
    assert rows(stage(spark, docs, FOLDER)) == rows(stage(spark, wide(docs), FOLDER))


@pytest.mark.parametrize("of", [
    mixing.mix, near_dedup.near_components, near_dedup.keep_one, signature_join.near_classes, signature_join.keep_one,
    lambda d: merkle.manifest(merkle.document_leaves(d)),
    lambda d: quality.training_rows(d, d.select("doc_id", (F.col("doc_id") % 2).alias("quality")), "quality", 9),
], ids=["mix", "near_components", "near_dedup.keep_one", "near_classes", "signature_join.keep_one", "manifest", "training_rows"])
def test_operators_on_documents(spark, docs, of):
    plain, more = of(docs), of(wide(docs))
    assert rows(plain) == rows(more, plain.columns)


def test_whitening(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    assert rows(whitening.whiten(vectors)) == rows(whitening.whiten(wide(vectors)))


def test_pseudonyms_found(spark, docs):
    assert "found" in NAMES and rows(pii.pseudonymise(docs), ["text"]) == rows(pii.pseudonymise(wide(docs)), ["text"])

