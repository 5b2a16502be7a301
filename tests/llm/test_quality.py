import random

import numpy as np
import pyarrow as pa

from clickweave.llm import quality as Q


def _corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        kind = rng.random()
        w = [word() for _ in range(rng.choice([20, 60, 200]))]
        toxic = kind < 0.15
        poor = 0.15 <= kind < 0.35
        if toxic:
            for _ in range(rng.randint(2, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "Moron,", "scumhead", "scumface"]))
        if poor:
            w = [x + rng.choice(["$$$", "%%%", "###"]) for x in w]
        rows.append((seed * 10_000 + i, " ".join(w), "s"))
        labels.append((seed * 10_000 + i, int(not poor), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, documents):
    rows, labels = _corpus(900, 1)
    lab = spark.createDataFrame([*labels, (labels[0][0], None, None), (None, 1, 0), (5_000_000, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = Q.fit(documents(rows), lab)
    assert np.all(np.diff(model.thresholds) > 0)
    held, truth = _corpus(400, 2)
    got = {r["doc_id"]: r for r in Q.score(documents(held), model).collect()}
    right = sum(got[d]["keep"] == (q == 1 and t == 0) for d, q, t in truth)
    assert right / len(truth) > 0.95
    mean = lambda g: np.mean([got[d]["expected_grade"] for d, q, t in truth if (0 if t else 1 if not q else 2) == g])
    assert mean(0) < mean(1) < mean(2)
    kept = Q.selected(documents(held), model)
    assert kept.columns == documents(held).columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["keep"]}


def test_edges(spark, documents):
    rows, labels = _corpus(60, 3)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    odd = documents([(1, None, "s"), (2, "", "s"), (None, "x", "s"), (2, "", "s"), (3, "word " * 300_000, "s")])
    model = Q.fit(documents(rows), lab)
    got = Q.score(odd, model).collect()
    assert len(got) == 5 and len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert Q.score(documents([]), model).count() == 0
    for labels_ in (lab.limit(0), lab.where("quality = 1 AND toxic = 0")):
        assert all(r["keep"] for r in Q.score(odd, Q.fit(documents(rows), labels_)).collect())


def test_gradient():
    rng = np.random.default_rng(0)
    batch = pa.RecordBatch.from_pydict({"grade": pa.array([0, 1, 2, 1], pa.int32()), "words": [[1, 3], [3], [], [2, 9]], "shapes": rng.random((4, 5)).tolist()})
    buckets, x = np.array([1, 2, 3]), rng.normal(size=10)
    f = lambda v: Q._loss(buckets, np.sort(v[:2]) + [0, 0.5], v[7:], v[2:7], batch)[0]
    x[:2] = np.sort(x[:2])
    grad = Q._loss(buckets, x[:2] + [0, 0.5], x[7:], x[2:7], batch)[1]
    for i in range(10):
        d = np.zeros(10)
        d[i] = 1e-6
        assert abs((f(x + d) - f(x - d)) / 2e-6 - grad[i]) < 1e-4


def test_features_of_long_texts_in_pieces(monkeypatch):
    from clickweave.llm import words as W

    raw, off = W.text_bytes(pa.array(["Ab, cd! " * 200, "", "x y"]))
    whole = Q._shapes(raw, off), [(i, j, r.tolist(), b.tolist()) for i, j, r, b in Q._distinct(raw, off)]
    monkeypatch.setattr(W, "PIECE", 64)
    assert np.allclose(Q._shapes(raw, off), whole[0])
    assert sorted(b for *_, bs in Q._distinct(raw, off) for b in bs.tolist()) == sorted(whole[1][0][3])
