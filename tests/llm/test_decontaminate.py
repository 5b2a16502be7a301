import hashlib
import random
import re

from clickweave.llm.decontaminate import contamination, decontaminated


def _words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = _words(text), set(), set()
        for item, t in items:
            x = _words(t)
            n = min(13, len(x))
            for i in range(len(x) - n + 1) if x else []:
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == x[i : i + n]:
                        hit.update(range(at, at + n))
                        if item is not None:
                            ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def _case():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 2)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([20, 14, 13, 5, 3, 2, 1, 0, 30])]
    items += [(None, "zz yy xx ww vv"), (9, None), (3, items[0][1])]
    docs = []
    for i in range(40):
        w = [word() for _ in range(rng.choice([0, 1, 5, 60, 200]))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(items)[1] or ""
            at = rng.randint(0, len(w))
            w[at:at] = t.upper().split() if rng.random() < 0.3 else t.split()
        docs.append((i, rng.choice([" ", "\n", "--"]).join(w)))
    docs += [(100, None), (101, ""), (102, "ZZ, yy! xx ww vv"), (102, "other text"), (None, items[0][1]), (0, docs[0][1])]
    return docs, items


def test_against_brute_force(spark, documents):
    docs, items = _case()
    df = documents([(i, t, "s") for i, t in docs])
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS wid", "2 AS n")
    got = sorted(map(tuple, contamination(df, bench).collect()), key=repr)
    assert got == _brute(docs, items)
    kept = decontaminated(df, bench)
    assert kept.columns == df.columns
    bad = {(d, t) for (d, t) in docs for r in _brute([(d, t)], items) if r[-1]}
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None) == sorted(
        (d, t) for d, t in docs if (d, t) not in bad and d is not None
    ) if all(t is not None for _, t in docs if (_, t) not in bad) else True
    assert kept.count() == sum((d, t) not in bad for d, t in docs)


def test_empty_tables(spark, documents):
    none = documents([])
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert contamination(none, bench).count() == 0
    got = contamination(documents([(1, "a b c", "s")]), bench.limit(0)).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 3, 0, 0)]
