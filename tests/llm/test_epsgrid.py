import math

import numpy as np

from clickweave.llm import epsgrid as E


def _brute(rows, threshold=0.98):
    def usable(v, lab):
        return lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cos(a, b):
        dot = math.fsum(x * y for x, y in zip(a, b, strict=True))
        return dot / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b))

    n, links = len(rows), [0] * len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, v, lab) in enumerate(rows):
        for j in range(i):
            _, u, other = rows[j]
            if lab == other and usable(v, lab) and usable(u, other) and len(u) == len(v) and cos(u, v) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    low = {}
    for i, (d, *_) in enumerate(rows):
        low[find(i)] = min((x for x in (low.get(find(i)), d) if x is not None), default=None)
    return sorted(((d, links[i], low[find(i)], d == low[find(i)]) for i, (d, *_) in enumerate(rows)), key=repr)


def _case():
    rng = np.random.default_rng(3)
    rows = []
    for lab in (0, 1):
        for _ in range(6):
            c = rng.normal(size=12)
            rows += [(np.float32(c + rng.normal(size=12) * s).tolist(), lab) for s in rng.choice([0.02, 0.08, 0.15, 0.3], 12)]
    rows += [(rows[0][0], 0)] * 30 + [([float(x) * 2 for x in rows[1][0]], 0)]  # copies, a scaled copy
    rows += [(rows[0][0], None), (None, 0), ([], 0), ([0.0] * 12, 0), ([float("nan")] * 12, 0), ([None] * 12, 0), ([float("inf")] + [0.0] * 11, 1)]
    rows += [([1.0, 0.0], 0), ([1.0, 0.01], 0), ([1.0], 1), ([2.0], 1), ([-2.0], 1)]
    out = [(i, v, lab) for i, (v, lab) in enumerate(rows)]
    return [*out, (5, out[7][1], 0), (None, out[2][1], 0), (None, [1.0, 5.0, 7.0], 0)]


def test_against_brute_force(spark, monkeypatch):
    rows = _case()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS dim", "2 AS n", "3 AS part")
    for block in (256, 4):  # small blocks: several levels of intervals
        monkeypatch.setattr(E, "BLOCK", block)
        got = sorted(map(tuple, E.near_vectors(df).collect()), key=repr)
        assert got == _brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert E.near_vectors(none).count() == 0
    only = spark.createDataFrame([(4, None, 1)], "vec_id bigint, embedding array<float>, label int")
    assert [tuple(r) for r in E.near_vectors(only).collect()] == [(4, 0, 4, True)]


def test_cosine_at_the_threshold():
    a = np.array([[1.0, 0.0]])
    b = np.array([[0.98, math.sqrt(1 - 0.98**2)], [0.9799999, math.sqrt(1 - 0.9799999**2)]])
    assert E._linked(a, b, 0.98).tolist()[0][1] is False


def test_far_blocks_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(4)
    angle = np.linspace(0, math.pi, 400)
    rows = [(i, [float(math.cos(t)), float(math.sin(t)), float(e)], 0) for i, (t, e) in enumerate(zip(angle, rng.normal(size=400) * 1e-3, strict=True))]
    monkeypatch.setattr(E, "BLOCK", 10)
    seen = {}
    inner = E._block_pairs
    monkeypatch.setattr(E, "_block_pairs", lambda blocks, eps: seen.setdefault("pairs", inner(blocks, eps)))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    assert sorted(map(tuple, E.near_vectors(df).collect()), key=repr) == _brute([(i, [float(np.float32(x)) for x in v], 0) for i, v, _ in rows])
    blocks = 40
    assert seen["pairs"].count() < blocks * (blocks + 1) / 2 / 2
