import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clickweave.llm import common
from clickweave.llm import naming as N

SPACES = dict.fromkeys(map(ord, " \t\n\x0b\f\r"))


def _norm(t):
    return (t or "").translate(SPACES)


def _brute(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(_norm(t), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t, _ in rows:
        g = groups[_norm(t)]
        first = min(g, key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, first[2], len(g), hashlib.sha256(_norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def _case():
    rng = random.Random(3)
    texts = ["", None, " \n", "a", "a ", "b", "é x", "é  x", "ab" * 50, "ab" * 50 + "c", "ab" * 49 + "ba", "x" * 64, "x" * 128, "x" * 129]
    for n in (31, 32, 33, 64, 65, 500, 3000):  # around whole blocks
        t = "".join(rng.choice("abc déf中\U0001f600") for _ in range(n))
        texts += [t, t.replace(" ", "\t\t"), t + " ", t[:-1] + "!", "!" + t[1:]]
    texts += ["the common text " * 9] * 60
    rng.shuffle(texts)
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    return rows + [(4, texts[4], "s"), (4, texts[4], "s"), (None, texts[7], "s"), (None, "without an id", "s")]


@pytest.mark.parametrize("block", [8, 32, 2048])
def test_against_brute_force(spark, documents, block):
    rows = _case()
    got = N.exact_duplicates(documents(rows), block=block).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == _brute(rows)
    names = {}
    for r in got:  # one identity a text, one text an identity; one row of each stays
        names.setdefault((r["level"], r["name"]), []).append(r)
    assert len(names) == len({_norm(t) for _, t, _ in rows})
    for g in names.values():
        assert len({r["text_sha256"] for r in g}) == 1 and sum(r["kept"] for r in g) == 1
        assert all(r["doc_id"] == r["keep_id"] for r in g if r["kept"])


def test_blocks_that_share_a_key_are_told_apart(spark, documents, monkeypatch):
    """The first seed gives few keys, so different blocks share some: the next seed is taken."""
    seeds = []

    def few(block, seed):
        seeds.append(seed)
        return (F.pmod(F.xxhash64(block), F.lit(3)), F.lit(0).cast("long")) if seed == 0 else (F.xxhash64(F.lit(seed), block), F.lit(0).cast("long"))

    monkeypatch.setattr(N, "_block_key", few)
    rows = _case()
    got = N.exact_duplicates(documents(rows), block=16).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == _brute(rows)
    assert set(seeds) == {0, 1}


def test_one_row_of_each_text_stays(spark, documents):
    rows = _case()
    df = documents(rows)
    got = N.deduplicated(df)
    assert got.columns == df.columns
    kept = [(r["doc_id"], _norm(r["text"])) for r in got.collect()]
    assert sorted(kept, key=repr) == sorted({(f[1], _norm(t)) for (_, t, _), f in zip(rows, [x for r in rows for x in _brute_of(rows, r)], strict=True)}, key=repr)
    assert N.deduplicated(documents([])).count() == 0 and N.exact_duplicates(documents([])).count() == 0


def _brute_of(rows, row):
    same = [(-len(t or ""), i is None, i or 0, i) for i, t, _ in rows if _norm(t) == _norm(row[1])]
    return [(None, min(same, key=lambda x: x[:3])[3])]


def test_lookup_joins_hot_keys_where_they_lie(spark, monkeypatch):
    rows = common.stage(spark.range(40000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k")), "rows")
    values = common.stage(rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2), "values")
    out = common.lookup(rows, values, ["k"], "n")
    assert out.columns == ["id", "k", "v"] and out.count() == 40000 and out.where("v <> 2 * k").isEmpty()
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
