import random

from pyspark.sql import functions as F

from clickweave.llm.common import bounded_broadcast, components, running_total


def test_running_total_over_hot_and_null_keys(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    got = {r["i"]: (r["before"], r["n"]) for r in running_total(df, ["k"], ["i"], {"before": F.col("v"), "n": F.lit(1)}).collect()}
    sums = {}
    for k, i, v in rows:
        s, n = sums.get(k, (0, 0))
        assert got[i] == (s, n)
        sums[k] = (s + v, n + 1)


def test_running_total_without_keys_and_rows(spark):
    df = spark.range(20).select((19 - F.col("id")).alias("x"))
    assert {(r["x"], r["r"]) for r in running_total(df, [], ["x"], {"r": F.lit(1)}).collect()} == {(i, i) for i in range(20)}
    assert running_total(df.limit(0), [], ["x"], {"r": F.lit(1)}).count() == 0


def _union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_components_of_random_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, rng.randint(1, 60)) for _ in range(40)]
    edges += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    edges = [(a, b) for a, b in edges if a != b]
    got = components(spark.createDataFrame(edges, "a int, b int"))
    assert {(r["node"], r["component"]) for r in got.collect()} == set(_union_find(edges).items())


def test_components_without_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "a int, b int")).count() == 0


def test_broadcast_is_bounded(spark):
    small, large = spark.range(3), spark.range(30)
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(bounded_broadcast(small, 3)).lower()
    assert "broadcast" not in plan(bounded_broadcast(large, 3)).lower()
