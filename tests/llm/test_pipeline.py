import re
from collections import Counter

import corpus_pipeline
from ringside.llm import mixing, pii

from .test_similar_texts import plain_heads

FOLDER = "/root/testdata/sf0.001"


def _stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, FOLDER), "test")
        out.append(docs)
    return out


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good, one, private, mix, tokens = _stages(spark)
    assert all(s.columns == docs.columns for s in (good, one, private, mix))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert all(i in kept for i, q in labels.items() if q == 1)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.2 * sum(q == 0 for q in labels.values())

    heads = plain_heads(sorted(kept.items()))
    assert {r["doc_id"] for r in one.collect()} == heads and len(heads) < len(kept)

    texts = {r["doc_id"]: r["text"] for r in private.collect()}
    assert set(texts) == heads
    for r in one.collect():
        if not re.search(r"[0-9@]", r["text"]):
            assert texts[r["doc_id"]] == r["text"]
        for m in re.findall(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}", r["text"]):
            assert m not in texts[r["doc_id"]]

    # each source's words come near its target, a document's copies near its share of them
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    copies = Counter(r["doc_id"] for r in mix.collect())
    source = {r["doc_id"]: r["source"] for r in private.collect()}
    names = sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    target = dict(zip(names, mixing.targets([total[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))])))
    share = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.mix(private).collect() if r["size"]}
    assert set(copies) <= set(size)
    for i, x in share.items():
        assert abs(copies[i] - x) < 1 and copies[i] <= 2
    for s in names:
        longest = max(size[i] for i in size if source[i] == s)
        assert abs(sum(size[i] * n for i, n in copies.items() if source[i] == s) - target[s]) <= longest + 64, s
    rows = tokens.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in mix.collect())
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_gives_the_last_stage(spark):
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == Counter(r["doc_id"] for r in _stages(spark)[-1].collect())


def test_stages_stand_nulls_and_an_empty_table(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(1, None, None, None, None), (None, "a b c +1 (988) 555-2485", "en", None, 3), (3, "", "en", "s", 0),
            (3, "", "en", "s", 0), (4, "plain words of a text " * 30, None, "s", None)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut(stage(spark, docs, FOLDER), "test")
        assert docs.count() <= 2 * len(data)
    assert pii.KINDS
