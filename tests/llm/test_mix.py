import hashlib
import random

from clickweave.llm import mix as X


def _targets(per, share=1.5, repeat=2):
    """The contract's rule, step by step."""
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, out, open_ = share * sum(per.values()), {}, set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] >= repeat * per[s]}
        if not full:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in full:
            out[s] = repeat * per[s]
            left -= out[s]
        open_ -= full
    return out


def _docs():
    rng = random.Random(11)
    rows = []
    for i in range(300):
        s = rng.choice(["a", "a", "a", "B", "é", "zz", None, "q"])
        rows.append((i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 5, 40]))), s))
    rows += [(900, None, "a"), (901, "", "none"), (902, None, "none")] + [(5, rows[5][1], rows[5][2])] * 4
    return rows


def test_targets_and_draw(spark, documents):
    rows = _docs()
    sized = X.sizes(documents(rows))
    per = {}
    for _, t, s in rows:
        per[s] = per.get(s, 0) + len((t or "").split())
    got = {r["source"]: r for r in X.targets(sized).collect()}
    want = _targets(per)
    assert set(got) == set(want)
    for s, r in got.items():
        assert r["source_size"] == per[s] and abs(r["target"] - want[s]) < 1e-6
    taken = {}
    for r in X.draw(sized).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"]
    for s in per:
        assert abs(taken.get(s, 0) - want[s]) <= 40


def test_tree_sums_are_exact(spark):
    blocks = spark.createDataFrame([("a", 50), ("b", 7), (None, 1), ("c", 0)], "source string, blocks bigint")
    for shards in (1, 5, 8):
        got = X.quotas(blocks, shards).collect()
        per_source, per_shard = {}, {}
        for r in got:
            per_source.setdefault(r["source"], []).append((r["shard"], r["quota"], r["first"]))
            per_shard[r["shard"]] = per_shard.get(r["shard"], 0) + r["quota"]
        assert {s: sum(q for _, q, _ in v) for s, v in per_source.items()} == {"a": 50, "b": 7, None: 1}
        assert max(per_shard.values()) - min(per_shard.get(i, 0) for i in range(shards)) <= max(1, shards.bit_length())
        for v in per_source.values():  # disjoint runs
            at = 0
            for _, q, first in sorted(v):
                assert first == at
                at += q


def test_counts_are_hypergeometric(spark):
    """Mean and variance of the left half's count over many seeds."""
    blocks = spark.createDataFrame([("a", 20), ("b", 20)], "source string, blocks bigint")
    got = []
    for seed in range(12):
        rows = X.quotas(blocks, 2, f"s{seed}").where("source = 'a' AND shard = 0").collect()
        got.append(rows[0]["quota"] if rows else 0)
    mean = sum(got) / len(got)
    assert abs(mean - 10) < 2.0 and len(set(got)) > 1


def test_mix_repeats_and_keeps_columns(spark, documents):
    df = documents(_docs())
    mix = X.mixed(X.sizes(df), shards=3)
    placed = mix.collect()
    assert {r["shard"] for r in placed} == {0, 1, 2}
    again = X.mixed(X.sizes(df.repartition(5)), shards=3).collect()
    key = lambda r: (r["doc_id"], r["pass"], r["shard"], r["key"], r["th"])
    assert sorted(map(key, placed), key=repr) == sorted(map(key, again), key=repr)
    rows = X.mixed_documents(df)
    assert rows.columns == df.columns and rows.count() == len(placed)
    assert max(r["count"] for r in rows.where("doc_id <> 5").groupBy("doc_id").count().collect()) <= 2


def test_query_over_repeated_rows(spark, documents, tmp_path):
    df = documents(_docs(), extra=False)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = X.op6_mix(spark, str(tmp_path)).collect()
    assert len(rows) == df.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    empty = tmp_path / "empty"
    df.limit(0).write.parquet(str(empty / "documents.parquet"))
    assert X.op6_mix(spark, str(empty)).count() == 0


def test_permutation_key_is_md5(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, th string")
    assert df.select(X.hash_order("mix", "doc_id", "th")).first()[0] == hashlib.md5(b"mix|1|x").hexdigest()


def test_written_shards_hold_the_mix_in_its_order(spark, documents, tmp_path):
    df = documents(_docs()).selectExpr("*", "1 AS shard", "2 AS place", "3 AS row")
    X.write_mixed(df, str(tmp_path / "mix"), shards=3)
    want = {}
    for r in X.mixed(X.sizes(df), shards=3).collect():
        want.setdefault(r["shard"], []).append((r["key"], r["doc_id"]))
    quotas = []
    for shard in range(3):
        rows = X.read_mixed(spark, str(tmp_path / "mix"), shard)
        assert rows.columns == df.columns
        assert [r["doc_id"] for r in rows.collect()] == [d for _, d in sorted(want[shard], key=lambda x: x[0])]
        quotas.append(sum(len(r["text"].split()) for r in rows.collect()))
    assert max(quotas) < 1.3 * min(quotas)  # block quotas are even, blocks about equal
