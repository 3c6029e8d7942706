import hashlib
import random
import re

import xxhash

from ringside.llm import fingerprints


def _pair_hash(a, b):
    # Spark chains: the hash of the first value seeds the second; a null leaves the seed
    h = xxhash.xxh64_intdigest(a.encode(), 42)
    return h if b is None else xxhash.xxh64_intdigest(b.encode(), h)


def plain(text):
    words = re.split(r"[\x20\x09-\x0D]+", (text or "").lower())
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None]):
        n = 1 + (len(a) > 3) + (len(b or "") > 3)
        total += n
        h = _pair_hash(a, b)
        for i in range(64):
            votes[i] += n * (h >> i & 1)
    return sum(1 << i for i in range(64) if votes[i] * 2 > total)


def _expected(rows):
    named = sorted({r[0] for r in rows if r[0] is not None})
    ids = named + ([None] if any(r[0] is None for r in rows) else [])
    first = {i: min((xxhash.xxh64_intdigest((t or "").encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest((t or "").encode(), 42) >> 63), t or "")
                    for d, t in rows if d == i)[1] for i in ids}
    out = []
    for d, t in rows:
        t, after = t or "", first[ids[(ids.index(d) + 1) % len(ids)]]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        out.append((d is None, d or 0, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain(t), plain(edited), plain(after)))
    return sorted(out)


def _got(rows):
    wide = fingerprints.with_next(fingerprints.cut(rows, "test")).collect()
    u = lambda x: x & (2**64 - 1)
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], u(r["fp"]), u(r["edited_fp"]),
                   u(r["next_fp"])) for r in wide)


def test_equals_brute_force_on_odd_rows(spark):
    rows = [(5, "Über die Straße gehen wir, und das ist gut so"), (9, "one"), (2, ""), (3, None), (40, "a b c d e f g h" * 400),
            (None, "no name here at all"), (5, "the same id and another text"), (9, "one"), (9, "one"), (-4, " lead and trail "),
            (41, "👍 emoji 👍 text wide space")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, id int")
    assert _got(fingerprints.compared(docs)) == _expected(rows)
    assert fingerprints.compared(docs.limit(0)).count() == 0


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {e[1]: e for e in _expected(rows)}
    got = fingerprints.op2(spark, folder).collect()
    assert len(got) == len(rows)
    fps = {e[4] for e in want.values()}
    for r in got:
        e = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (e[2], e[3], f"{e[4]:016x}", f"{e[5]:016x}")
        assert 0 <= r["near_next"] <= 1 and (r["near_next"] == 1) == (e[4] == e[6])
        n = sum(0 < (e[4] ^ f).bit_count() <= 3 for f in fps) if r["doc_id"] % 50 == 0 else None
        assert r["near_fingerprints"] == n
    assert sum(r["near_edited"] for r in got) > 2.5 * sum(r["near_next"] for r in got)


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps)[:60]:
        for _ in range(4):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 5)):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for radius in (0, 2, 3):
        got = {(r["query"], r["fp"], r["distance"]) for r in fingerprints.near(df, df, radius).collect()}
        want = {(a, b, d) for a in signed for b in signed for d in [((a ^ b) & (2**64 - 1)).bit_count()] if 0 < d <= radius}
        assert got == want


def test_plan_holds_no_python(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = fingerprints.compared(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
