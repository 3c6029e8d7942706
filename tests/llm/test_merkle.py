import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ringside.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_paths(leaves, fanout):
    """(root, [(left, right) per level] of every leaf) of one tree."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            first = p - p % fanout
            paths[i].append(("".join(nodes[first:p]), "".join(nodes[p + 1:first + fanout])))
            at[i] = p // fanout
        nodes = [h("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain_manifest(rows, fanout=3):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found = []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
        found.append((own, *plain_paths([plain_leaf(r, r[1]) for r in own], fanout)))
    root, tops = plain_paths([f[1] for f in found], fanout)
    out = []
    for (own, subroot, paths), top in zip(found, tops):
        for r, path in zip(own, paths):
            bad = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            d = plain_leaf(r, r[1].replace("\n", "") if bad else r[1])
            for left, right in path + top:
                d = h(left + d + right)
            out.append((r[0], plain_leaf(r, r[1]), subroot, root, h("".join(a + b for a, b in path + top)), d, d == root))
    return out


def got(spark, rows, **how):
    found = merkle.manifest(merkle.document_leaves(spark.createDataFrame(rows, SCHEMA)), **how)
    out = found.select("id", "leaf", "subroot", "root", merkle.path_digest().alias("p"),
                       merkle.fold(F.coalesce("other", "leaf")).alias("f"))
    return [(*r, r["f"] == r["root"]) for r in out.collect()]


def some(seed, sizes):
    rng, rows, i = random.Random(seed), [], 0
    for s, n in sizes.items():
        for _ in range(n):
            i += 1
            text = rng.choice([None, "", "one line", "two\nlines", "é\n\nü", "x\n"])
            rows.append((i * 7 % 1009, text, rng.choice(["en", None]), s, rng.choice([None, 0, 12])))
    rng.shuffle(rows)
    return rows


def same(a, b):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(a, key=key) == sorted(b, key=key)


@pytest.mark.parametrize("fanout,height", [(3, 7), (3, 1), (3, 0), (2, 2)])
def test_manifest_equals_plain_trees(spark, fanout, height):
    # counts around powers of three: whole and partial last subtrees, on several levels of the butterfly
    rows = some(1, {"hot": 100, "a": 1, None: 27, "b": 28, "c": 9, "é": 10, "z": 2, "": 3})
    want = plain_manifest(rows, fanout)
    same(got(spark, rows, fanout=fanout, height=height), want)
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 13, 28, 55, 82])
def test_one_group_of_any_size(spark, n):
    rows = some(n, {"s": n})
    same(got(spark, rows, height=0), plain_manifest(rows))


def test_null_and_repeated_ids_and_rows(spark):
    rows = [(None, "a\nb", None, None, None)] * 3 + [(5, "t\n", "en", "s", 1)] * 30 + [(5, "u\n", "en", "s", 1), (None, None, None, "s", None)]
    same(got(spark, rows, height=1), plain_manifest(rows))


def test_empty_table_long_text_and_other_columns(spark):
    assert got(spark, []) == []
    rows = [(2, "long\n" * 200_000, "en", "s", 5), (4, "x", "en", "s", 1)]
    same(got(spark, rows), plain_manifest(rows))
    wide = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit(1).alias(c) for c in ("g", "id", "leaf", "other", "salt", "range", "place", "total", "block", "lefts")])
    assert {r["leaf"] for r in merkle.manifest(merkle.document_leaves(wide)).collect()} == {w[1] for w in plain_manifest(rows)}


def test_query_equals_plain_trees_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")).collect()]
    same([tuple(r) for r in merkle.op12(spark, folder).collect()], plain_manifest(rows))
