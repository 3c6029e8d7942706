import random
import re

import corpus_pipeline
from ringside.llm import signature_join as sj
from ringside.llm import similar_texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_similarity(a, b, k=5):
    def of(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()

    x, y = of(a), of(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def plain_heads(rows):
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if plain_similarity(a, b) >= 0.8:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i for i in root if root[i] == i}


def _variants(seed=5):
    """Texts with 0 to 12 of their 200 words replaced: similarities on both sides of 0.8."""
    rng, rows = random.Random(seed), []
    for group in range(25):
        base = [f"W{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(rng.choice([1, 2, 3, 9])):
            words = list(base)
            for p in rng.sample(range(200), rng.randint(0, 12)):
                words[p] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows + [(1000, ""), (1001, None), (1002, " \n"), (1003, "a b"), (1004, "A  b"), (1005, "a b c")]


def test_stage_keeps_one_of_all_texts_that_are_similar_by_four_fifths(spark):
    rows = _variants()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    want = plain_heads(rows)
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "").collect()} == want
    # list by list, with long lists
    for piece in (3, 6):
        assert {r["doc_id"] for r in similar_texts.keep_one(docs, piece=piece).collect()} == want, piece


def test_stage_equals_all_pairs_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_heads([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "").collect()} == want


def test_pairs_at_the_threshold_share_enough_coordinates():
    rng, part, whole = random.Random(2), *similar_texts.SIMILARITY
    for _ in range(400):
        base = [rng.randrange(10**9) for _ in range(300)]
        last, other = base, list(base)
        while plain_similarity(*(" ".join(map(str, x)) for x in (base, other))) >= 0.8:
            last, other = other, list(other)
            other[rng.randrange(300)] = rng.randrange(10**9)
        signs = [sj.signature(sj.shingle_set(" ".join(map(str, x)))) for x in (base, last)]
        for n in (sj.POSTED, sj.COORDINATES):
            assert (signs[0][:n] == signs[1][:n]).sum() >= sj.matches(n, part, whole)


def test_classes_of_operator_10_are_lists(spark):
    nodes = spark.createDataFrame([(1, 0b0), (2, 0b11), (3, 0b0), (4, 0xFFFF), (5, 0x0FFF0000)], "node long, mark long")
    lists = {}
    for r in similar_texts.simhash_lists(nodes).collect():
        lists.setdefault(r["token"], set()).add(r["node"])
    assert sorted(map(sorted, lists.values())) == [[1, 2, 3]]


def test_columns_repeats_and_null_ids(spark):
    rows = [(3, "a b c d e f", 1), (1, "a b c d e f", 2), (1, "a b c d e f", 2), (None, "a b c d e f", 3), (5, None, 4), (4, "", 5),
            (7, "quite another text", 6), (7, "and one more with that id", 7), (None, "alone here", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k int")
    kept = similar_texts.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["_k"] for r in kept.collect()) == [2, 5, 6, 7, 8]
    assert similar_texts.keep_one(docs.limit(0)).count() == 0
