import random

from pyspark.sql import functions as F

from ringside.llm import graph


def _plain(edges):
    root = {}

    def of(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((of(a), of(b)))
        root[b] = a
    return {x: of(x) for x in root}


def test_many_tasks_do_not_repeat_the_nodes_of_a_dense_graph(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(6000)]
    pairs = spark.createDataFrame(edges, "a bigint, b bigint").repartition(32)
    n = graph._unsettled(pairs.filter("a <> b"))
    assert n == sum(a != b for a, b in edges)
    assert graph._contracted(pairs.filter("a <> b"), n).count() <= 300
    want = _plain(e for e in edges if e[0] != e[1])
    assert {r["node"]: r["root"] for r in graph.components(pairs).collect()} == want


def test_components_over_more_edges_than_a_task_takes(spark, monkeypatch):
    monkeypatch.setattr(graph, "EDGES", 64)
    rng = random.Random(4)
    edges = [(rng.randrange(900), rng.randrange(900)) for _ in range(700)] + [(i, i + 1) for i in range(1000, 1200)]
    pairs = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    got = graph.components(pairs)
    assert {r["node"]: r["root"] for r in got.collect()} == _plain(e for e in edges if e[0] != e[1])
    assert got.count() == got.select("node").distinct().count()
    assert graph._unsettled(pairs.limit(0)) == 0 and graph._unsettled(pairs.select(F.lit(1).alias("a"), "b").filter("b > 1").distinct()) == 0
