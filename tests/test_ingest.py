"""Bronze ingest on the hostile CSV fixture (C1): the reject/clean split must not depend on the
projection (M2), rejects + clean = input, NULL price is clean (D1) unless the reference's
three-valued rule is asked for (R1), and re-ingesting a batch replaces it (D7)."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from clickweave.plans.bronze import bronze_frames, ingest
from clickweave.operators.ingest import parse_event_time
from clickweave.sources.csv_events import read_raw_events

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
ROWS = [
    "2019-10-01 00:00:00 UTC,view,1,10,electronics.smartphone,apple,100.5,1,s1",  # good
    "2019-10-01 00:01:00 UTC,view,2,10,electronics.smartphone,apple,-1,1,s1",  # negative price
    "2019-10-01 00:02:00 UTC,view,3,10,electronics,samsung,,2,s2",  # empty price -> clean
    "2019-10-01 00:03:00 UTC,cart,4,10,,,5.0,,s3",  # empty user -> reject
    "2019-10-01 00:04:00 UTC,view,abc,10,,,5.0,3,s4",  # text in product_id -> corrupt
    "2019-10-01 00:05:00 UTC,view,5,10,x,y",  # short row -> corrupt
    "2019-10-01 00:06:00 UTC,view,6,10,x,y,7.0,4,s5,extra",  # extra token -> corrupt
    "not a time,view,7,10,x,y,8.0,5,s6",  # unparseable time -> clean, NULL timestamp
    "2019-10-01 00:08:00 UTC,purchase,8,10,x,y,-3,,s7",  # negative price and empty user
    "2019-10-01 00:09:00 UTC,,,10,x,y,9.0,6,s8",  # empty event_type and product_id -> clean
]


@pytest.fixture()
def hostile_csv(tmp_dir):
    path = os.path.join(tmp_dir, "events-2019-10.csv.gz")
    with gzip.open(path, "wt") as fh:
        fh.write("\n".join([HEADER, *ROWS]) + "\n")
    return path


def test_split_is_projection_stable(spark, hostile_csv):
    res = bronze_frames(spark, hostile_csv)
    assert res.rejects.count() == 6
    assert res.clean.count() == 4
    assert len(res.clean.collect()) == 4
    assert res.clean.select("user_id").count() == 4
    assert len(res.rejects.select("reject_reason").collect()) == 6


def test_reject_reasons(spark, hostile_csv):
    res = bronze_frames(spark, hostile_csv)
    reasons = sorted(r.reject_reason for r in res.rejects.collect())
    assert sum("corrupt_record" in r for r in reasons) == 3
    assert "corrupt_record,null_user_id" in reasons  # the short row also lacks its user
    assert "null_user_id,negative_price" in reasons
    assert "negative_price" in reasons and "null_user_id" in reasons


def test_reference_null_semantics_lose_the_null_price_row(spark, hostile_csv):
    res = bronze_frames(spark, hostile_csv, strict_reference_nulls=True)
    assert (res.rejects.count(), res.clean.count()) == (6, 3)


def test_unprojected_csv_read_is_unstable(spark, hostile_csv):
    """Documents the trap staging avoids (M2): a pruned CSV read misses corrupt lines."""
    raw = read_raw_events(spark, hostile_csv, with_batch=False)
    full = raw.filter(F.col("_corrupt_record").isNotNull()).collect()
    assert len(full) == 3


def test_batch_tag_and_time(spark, hostile_csv):
    res = bronze_frames(spark, hostile_csv)
    rows = res.clean.orderBy("product_id").collect()
    assert {r.batch for r in rows} == {"events-2019-10_csv_gz"}
    good = [r for r in rows if r.product_id == 1][0]
    assert str(good.event_timestamp) == "2019-10-01 00:00:00"
    assert str(good.event_date) == "2019-10-01"
    assert sum(r.event_timestamp is None for r in rows) == 1


def test_time_parse_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00 UTC",)], "event_time string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = parse_event_time(df).collect()[0].event_timestamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    utc = parse_event_time(df).collect()[0].event_timestamp
    assert ny == utc and str(utc) == "2019-10-01 00:00:00"


def test_ingest_is_batch_idempotent(spark, hostile_csv, tmp_dir):
    table = os.path.join(tmp_dir, "bronze")
    dlq = os.path.join(tmp_dir, "dlq")
    ingest(spark, hostile_csv, table, table_name=None, dlq_dir=dlq)
    ingest(spark, hostile_csv, table, table_name=None)
    assert spark.read.parquet(table).count() == 4
    assert spark.read.parquet(dlq).filter(F.col("batch") == "events-2019-10_csv_gz").count() == 6


def test_ingest_creates_catalog_table(spark, hostile_csv, tmp_dir):
    table = os.path.join(tmp_dir, "bronze_cat")
    ingest(spark, hostile_csv, table, table_name="bronze_events_t")
    assert spark.table("default.bronze_events_t").count() == 4


def test_strict_rules_reject_missing_required_and_bad_time(spark, hostile_csv):
    from clickweave.operators.ingest import strict_rules

    res = bronze_frames(spark, hostile_csv, extra_rules=strict_rules())
    assert (res.rejects.count(), res.clean.count()) == (8, 2)
    reasons = " ".join(r.reject_reason for r in res.rejects.collect())
    assert "unparseable_time" in reasons and "null_event_type" in reasons and "null_product_id" in reasons
