"""ML: exact AUC forms agree with each other and with a brute-force count; save/load keeps scores;
importances are sorted; hash split is reproducible; drift of identical periods is zero."""

import os

import pytest
from pyspark.sql import functions as F

from clickweave.operators import ml
from clickweave.operators.metrics import oot_split
from clickweave.plans import medallion as m

from testdata import SF_SMALL


def _brute_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_frame_matches_bruteforce_and_evaluator(spark):
    st = m.staged(spark, SF_SMALL).filter(F.col("price").isNotNull())
    st = st.withColumn("y", F.col("event_type") == "purchase")
    rows = [(r.price, r.y) for r in st.select("price", "y").collect()]
    frame = ml.roc_auc_frame(st, "price", "y").collect()[0]
    assert frame.roc_auc == pytest.approx(_brute_auc(rows), abs=1e-9)
    ev = ml.evaluate(st.select(F.col("price").alias("score"), F.col("y").cast("int").alias("is_purchased")))
    assert ev["roc_auc"] == pytest.approx(frame.roc_auc, abs=1e-9)
    assert 0 <= ev["pr_auc"] <= 1


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_auc_frame_independent_of_buckets(spark, buckets):
    df = spark.createDataFrame([(0.1, 1), (0.1, 0), (0.5, 1), (0.3, 0), (0.9, 1), (0.2, 0)], "s double, y int")
    got = ml.roc_auc_frame(df, "s", "y", buckets=buckets).collect()[0].roc_auc
    assert got == pytest.approx(_brute_auc([(r.s, r.y) for r in df.collect()]), abs=1e-9)


def test_model_roundtrip_and_importances(spark, tmp_dir):
    feats = ml.prepare(m.features(spark, SF_SMALL, 43200))
    train, oot = ml.temporal_split(feats, m.OOT_CUTOFF)
    model = ml.fit(ml.build_gbt(max_iter=5), train)
    path = os.path.join(tmp_dir, "model")
    ml.save_model(model, path)
    again = ml.load_model(path)
    a = ml.score(model, oot).orderBy("computed_session_id").collect()
    b = ml.score(again, oot).orderBy("computed_session_id").collect()
    assert a == b
    imp = ml.feature_importance(model)
    assert [v for _, v in imp] == sorted((v for _, v in imp), reverse=True)
    assert abs(sum(v for _, v in imp) - 1.0) < 1e-6
    report = ml.metrics_report(spark, ml.evaluate(ml.score(model, oot)), imp)
    ml.write_metrics(report, os.path.join(tmp_dir, "report"))
    back = spark.read.json(os.path.join(tmp_dir, "report")).collect()[0]
    assert len(back.feature_importance) == 9


def test_random_forest_trains(spark):
    feats = ml.prepare(m.features(spark, SF_SMALL, 43200))
    model = ml.fit(ml.build_random_forest(num_trees=10), feats)
    assert ml.score(model, feats).count() == feats.count()


def test_hash_split_is_reproducible(spark):
    feats = m.features(spark, SF_SMALL, 1800)
    a, b = ml.hash_split(feats)
    a2, _ = ml.hash_split(feats.repartition(7))
    ids = {r.computed_session_id for r in a.collect()}
    assert ids == {r.computed_session_id for r in a2.collect()}
    assert a.count() + b.count() == feats.count()


def test_random_split_covers_all(spark):
    feats = m.features(spark, SF_SMALL, 1800)
    a, b = ml.random_split(feats)
    assert a.count() + b.count() == feats.count()


def test_drift_zero_for_identical_periods(spark):
    feats = m.features(spark, SF_SMALL, 43200)
    both = feats.withColumn("data_split", F.lit("train")).unionByName(feats.withColumn("data_split", F.lit("oot")))
    assert all(abs(r.psi) < 1e-9 for r in ml.drift_psi(both).collect())
    real = ml.drift_psi(oot_split(feats, m.OOT_CUTOFF)).collect()
    assert len(real) == 9 and all(r.psi >= 0 for r in real)


def test_quantile_drift(spark):
    feats = m.features(spark, SF_SMALL, 43200)
    both = feats.withColumn("data_split", F.lit("train")).unionByName(feats.withColumn("data_split", F.lit("oot")))
    assert all(abs(r.psi) < 1e-9 for r in ml.drift_psi(both, binning="quantile").collect())
    real = ml.drift_psi(oot_split(feats, m.OOT_CUTOFF), binning="quantile").collect()
    assert len(real) == 9 and all(r.psi >= 0 for r in real)
    assert sum(r.n_base for r in real) == 9 * oot_split(feats, m.OOT_CUTOFF).filter("data_split = 'train'").count()


@pytest.mark.parametrize("name, source", [("l5_validation_auc", "_validation"), ("k11_oot_report", "_oot_report")])
def test_reports_are_recomputed_beside_their_figures(spark, monkeypatch, name, source):
    from clickweave.plans import catalog

    scored = spark.createDataFrame([("a", 1, 0.9, 1), ("b", 0, 0.4, 0), ("c", 1, 0.3, 0), ("d", 0, 0.1, 0)], "computed_session_id string, is_purchased int, score double, prediction int")
    figures, weights = ml.evaluate(scored), [("x", 0.75), ("y", 0.25)]
    for wrong in (False, True):
        report = ml.metrics_report(spark, figures | ({"roc_auc": 0.5} if wrong else {}), weights)
        monkeypatch.setattr(catalog, source, lambda spark, sf_dir, report=report: (report, scored))
        row = catalog.QUERIES[name](spark, "").first()
        assert row.roc_auc == (0.5 if wrong else pytest.approx(_brute_auc([(0.9, 1), (0.4, 0), (0.3, 1), (0.1, 0)])))
        assert [tuple(x) for x in row.feature_importance] == weights
        assert (row.n_features, row.auc_in_range, row.auc_recomputed, row.importances_sum_to_one, row.ranked) == (2, True, not wrong, True, True)


@pytest.mark.parametrize("name", ["l5_validation_auc", "k11_oot_report"])
def test_reports_rest_on_every_row_of_their_period(spark, monkeypatch, name):
    from clickweave.plans import catalog
    from clickweave.sources.schema import FEATURE_COLUMNS

    rows = [(f"{i}_1", f"2024-01-{20 + i % 8}", i * 37 % 100 < 30 + i % 9 * 5, *(float((i * (c + 3)) % 11 + i % 9) for c in range(9))) for i in range(240)]
    schema = "computed_session_id string, day string, is_purchased boolean, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    rows = spark.createDataFrame(rows, schema).withColumn("session_start", F.col("day").cast("timestamp_ntz"))
    rows = ml.prepare(rows)
    fit, build, fits = ml.fit, ml.build_gbt, []

    def kept(pipeline, train):
        fits.append((fit(pipeline, train), sorted(r.computed_session_id for r in train.collect())))
        return fits[-1][0]

    monkeypatch.setattr(catalog, "_model_input", lambda spark, sf_dir, timeout=None: rows)
    monkeypatch.setattr(ml, "build_gbt", lambda **kw: build(max_iter=2, max_depth=2, **kw))
    monkeypatch.setattr(ml, "fit", kept)
    row = catalog.QUERIES[name](spark, "").first()
    period, oot = ml.temporal_split(rows, m.OOT_CUTOFF)
    train, held_out = ml.hash_split(period)
    [(model, ids)] = fits
    assert ids == sorted(r.computed_session_id for r in train.collect())
    scored = [(r.score, r.is_purchased) for r in ml.score(model, oot if name == "k11_oot_report" else held_out).collect()]
    assert row.roc_auc == pytest.approx(_brute_auc(scored), abs=1e-8)
    assert [tuple(x) for x in row.feature_importance] == ml.feature_importance(model)
    assert (row.n_features, row.auc_in_range, row.auc_recomputed, row.importances_sum_to_one, row.ranked) == (9, True, True, True, True)
