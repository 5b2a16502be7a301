import os

import corpus_pipeline
from clickweave.llm import catalog, common, decontaminate, minhash, mix, quality

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    """Each stage works on what its predecessor kept; its decisions take effect."""
    docs = common.table(spark, SF, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(common.stage(stage(spark, kept[-1], SF), f"test-{name}"))
    assert all(k.columns == docs.columns for k in kept[:-1])
    ids = [sorted(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    labels = common.table(spark, SF, "labels")
    model = quality.fit(docs, labels)
    assert ids[1] == sorted(r["doc_id"] for r in quality.score(docs, model).where("keep").collect())
    found = minhash.near_duplicates(kept[1])
    assert ids[2] == sorted(r["doc_id"] for r in found.where("kept").collect())
    found = decontaminate.contamination(kept[2], common.table(spark, SF, "benchmark"))
    assert ids[3] == sorted(r["doc_id"] for r in found.where("NOT contaminated").collect())
    drawn = mix.draw(mix.sizes(kept[3]))
    assert ids[4] == sorted(r["doc_id"] for r in drawn.select("doc_id").collect())
    assert ids[5] == ids[4]
    rows = kept[5].orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == ids[4] and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))


def test_oracles_match(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in catalog.ORACLE.items():
        got = catalog.QUERIES[name](spark, SF).toPandas()
        want = con.execute(sql).df()
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        rows = [sorted(map(repr, x[cols].astype(object).itertuples(index=False, name=None))) for x in (got, want)]
        assert rows[0] == rows[1], name


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in catalog.QUERIES) == list(range(1, 14))
    assert os.path.exists(os.path.join(os.path.dirname(corpus_pipeline.__file__), "__spark_entry__.py"))
