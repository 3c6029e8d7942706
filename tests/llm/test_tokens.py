import random

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from ringside.llm import pieces, token_counts

ODD = ["", "  ", " a ", "▁", "a▁b", "▁▁ x", "\n\n", "<s> x </s>", "é﷽ ﬁ\x00z", " " * 40 + "y", "日本語 テキスト", "a　b", "\t tab",
       "12 3 4567", "x" * 3000, "\U0001F600 👍🏽", "word " * 20_000, "The cat sat, on the mat."]


def _texts(seed=0, n=60):
    rng = random.Random(seed)
    alphabet = [" ", " ", "▁", "\n", *"thereandizñé0123.,<s>", "日", "\x00", "👍"]
    return ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 120))) for _ in range(n)]


def test_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    texts = _texts()
    counter = token_counts.PieceCounter(token_counts.model_path())
    assert counter.apart
    assert counter.counts(texts) == [len(x) for x in model.encode(texts)]


def test_cache_is_filled_used_and_kept_apart_by_tokenizer(spark, tmp_path):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, None, 1), (3, "▁", 2), (3, "▁", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content int")
    cache, path = str(tmp_path / "cache"), token_counts.model_path()
    want = sorted((-1 if d is None else d, len((t or "").encode()), len(model.encode(t or ""))) for d, t, _ in rows)
    shown = lambda df: sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in df.collect())
    assert shown(token_counts.count_tokens(docs, path, cache)) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r[1] or "" for r in rows})
    assert shown(token_counts.count_tokens(docs.limit(5), path, cache)) == sorted(
        (i, len(t.encode()), len(model.encode(t))) for i, t in enumerate(ODD[:5]))
    assert spark.read.parquet(cache).count() == stored.count()
    # a stored count is believed; that of another tokenizer isn't
    spark.createDataFrame([(bytes(32), "other", 99)], "content binary, tokenizer string, n_tokens long").withColumn(
        "content", F.unhex(F.sha2(F.lit("new"), 256))).write.mode("append").parquet(cache)
    new = spark.createDataFrame([(1, "new")], "doc_id long, text string")
    assert token_counts.count_tokens(new, path, cache).first()["n_tokens"] == len(model.encode("new"))
    assert token_counts.count_tokens(docs.limit(0), path, cache).count() == 0


def test_counts_of_the_given_table(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r[1:]) for r in token_counts.op7(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: (len(r["text"].encode()), n, n > 4096) for r in docs for n in [len(model.encode(r["text"]))]}


def _plain_viterbi(p, segment):
    score = dict(zip(p.ids.tolist(), p.scores.tolist()))
    known = {p.spelled[i].decode(): i for i in score}
    best, way = [0.0], [[]]
    for end in range(1, len(segment) + 1):
        options = []
        for start in range(max(0, end - p.longest), end):
            piece = segment[start:end]
            if piece in known and "▁" not in piece:
                options.append((best[start] + score[known[piece]], way[start] + [known[piece]]))
        options.append((best[end - 1] + p.unknown, way[end - 1] + [p.byte_ids[b] for b in segment[end - 1].encode()]))
        top = max(o[0] for o in options)
        best.append(top)
        way.append(next(o[1] for o in options if o[0] == top))
    return way[-1]


def test_viterbi_equals_the_plain_one_and_round_trips():
    p = pieces.Pieces(token_counts.model_path())
    texts = [t for t in _texts(5, 200) if len(t) < 4000]
    ids = p.encode(texts)
    for t, i in zip(texts, ids):
        want = [x for s in pieces._SEGMENTS(" " + t) for x in _plain_viterbi(p, s)] if t else []
        assert i.tolist() == want, t
    everything = ODD + ["z" * 50_000]
    assert [p.decode(i.tolist()) for i in p.encode(everything)] == everything


def test_blocks_and_memo_do_not_change_ids(monkeypatch):
    texts = _texts(9)
    one = pieces.Pieces(token_counts.model_path()).encode(texts)
    monkeypatch.setattr(pieces, "BLOCK", 40)
    monkeypatch.setattr(pieces, "MEMO", 5)
    small = pieces.Pieces(token_counts.model_path())
    two = [x for t in texts for x in small.encode([t])]
    assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_query_round_trips(spark):
    rows = pieces.op6(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "a b", 3), (1, "a b", 3)], "doc_id long, text string, ids int")
    path = token_counts.model_path()
    got = pieces.encode(docs, path).collect()
    assert all(r["t"] == r["text"] for r in pieces.encode(docs, path).withColumn("t", pieces.decoded(F.col("ids"), path)).collect())
    assert sorted(len(r["ids"]) for r in got) == [0, 0, 2, 2]
    assert pieces.encode(docs.limit(0), token_counts.model_path()).count() == 0
