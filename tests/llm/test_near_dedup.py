import random
import re

import numpy as np
import xxhash

from ringside.llm import near_dedup


def plain_simhash(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def plain_components(rows, radius=3):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return [(d, best.get(root(i))) for i, (d, _) in enumerate(rows)]


def _key(x):
    return [(-1 if v is None else v) for v in x]


def test_fingerprints_of_odd_texts(spark):
    texts = ["One two THREE four", "a", "", None, " \t\n", "É ÀB c d e", "x y", "a b c " * 30_000, "x y"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in near_dedup.near_components(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_simhash(t) for t in texts]


def _planted(seed=1):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(60):
        center = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 40])):
            fp = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                fp ^= 1 << b
            rows.append((n, fp))
            n += 1
    rng.shuffle(rows)
    rows[0] = (None, rows[0][1])
    return rows


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_equal_brute_force_sparse_and_dense(spark):
    rows = _planted()
    want = sorted(plain_components(rows), key=_key)
    fps = spark.createDataFrame([(d, 0, _signed(f)) for d, f in rows], "doc_id long, k long, fp long")
    for settings in ({}, {"dense": 3, "piece": 4}, {"dense": 1, "piece": 1000}):
        found = near_dedup.classes(fps, **settings).select("fp", "head.doc_id").withColumnRenamed("doc_id", "c")
        got = [(r["doc_id"], r["c"]) for r in fps.join(found, "fp").collect()]
        assert sorted(got, key=_key) == want, settings


def test_every_close_pair_meets_in_a_cell():
    rng = random.Random(3)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        x, y = near_dedup._counts(np.array([a, b], np.uint64))
        assert any(int(x) & m == int(y) & m for m in (p & (2**64 - 1) for p in near_dedup.PROJECTIONS))


def test_query_on_the_given_table(spark):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in near_dedup.op10(spark, "/root/testdata/sf0.001").collect()}
    rows = [(r["doc_id"], plain_simhash(r["text"])) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = dict(plain_components(rows))
    assert got == {d: (f"{f:016x}", want[d]) for d, f in rows}


def test_keep_one_and_edge_cases(spark):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (1, "a b c d", 2), (None, "a b c d", 3), (5, None, 4), (4, "", 5),
            (7, "quite another text", 6), (7, "and one more with that id", 7), (None, "alone here", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k int")
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["_k"] for r in kept.collect()) == [2, 5, 6, 7, 8]
    assert near_dedup.keep_one(docs.limit(0)).count() == 0
    assert near_dedup.near_components(docs.limit(0)).count() == 0
