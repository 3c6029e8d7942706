import hashlib
import random
from collections import Counter

import numpy as np

from ringside.llm import repeats, suffixes


def plain(texts, window):
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = True
        starts = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((len(t), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def _made(seed, window):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "ñ", "on", "a", "ch", "ing", "é"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (40, 60, 90, 300)]
    line = prose(25)[:window - 10]
    texts = ["", "short", prose(500), "a" * 1000, "ab" * 700, prose(40) * 9]
    for _ in range(30):
        parts = [rng.choice([prose(rng.randint(1, 80)), rng.choice(shared), line, rng.choice(shared)[13:-20]]) for _ in range(6)]
        texts.append(" ".join(parts))
    base = prose(600)
    for _ in range(12):
        words = base.split(" ")
        for i in rng.sample(range(len(words)), rng.choice([0, 1, 8, 30])):
            words[i] = word()
        texts.append(" ".join(words))
    return texts


def _check(spark, texts, window, **how):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = repeats.strip_repeats(docs, window, **how).collect()
    got = {r["doc_id"]: (r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]),
                         hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out}
    want = plain([(t or "").encode() for t in texts], window)
    assert [got[i] for i in range(len(texts))] == want


def test_equals_brute_force(spark):
    _check(spark, _made(1, 200), 200)


def test_equals_brute_force_with_every_digit_hot(spark):
    _check(spark, _made(2, 60), 60, hot=2, step=4)


def test_long_texts_cross_cores(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CORE", 1000)
    coder = suffixes.Coder(50)
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 6000).astype(np.uint8)
    parts = [np.concatenate(x) for x in zip(*suffixes.runs(data, coder, 50))]
    monkeypatch.setattr(suffixes, "CORE", 1 << 17)
    whole = [np.concatenate(x) for x in zip(*suffixes.runs(data, suffixes.Coder(50), 50))]
    assert all(np.array_equal(a, b) for a, b in zip(parts, whole))
    assert whole[3].sum() == len(data) - 49


def test_nulls_repeated_rows_and_empty_table(spark):
    long = "x1 y2 z3 " * 60
    rows = [(None, long + "tail", 1), (None, None, 2), (4, "q w e r t y " * 3, 3), (4, "abc" * 20 + "def" * 90, 4),
            (4, "abc" * 20 + "def" * 90, 4), (5, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]))
                 for r in repeats.strip_repeats(docs).collect())
    want = [(d is None, d or 0, n, gone) for (d, _, _), (n, gone, _, _) in zip(rows, plain([(r[1] or "").encode() for r in rows], 200))]
    assert got == sorted(want)
    assert repeats.strip_repeats(docs.limit(0)).count() == 0


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r[1:]) for r in repeats.op3(spark, "/root/testdata/sf0.001").collect()}
    want = plain([(r["text"] or "").encode() for r in docs], 200)
    assert [got[r["doc_id"]] for r in docs] == want
