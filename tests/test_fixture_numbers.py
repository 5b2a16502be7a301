"""The expected values FIXTURES.md states for sf0.01 (adapter + reject rules + sessionize + metrics),
checked against the library end to end."""

import pytest
from pyspark.sql import functions as F

from clickweave.operators.sessions import session_match_rate
from clickweave.plans import medallion as m

from testdata import SF_CHECK

# Fixed values (from FIXTURES.md, sf0.01): timeout -> sessions, sum distinct_products, purchased
# sessions, sum duration_sec, max duration_sec, sessions without a priced view, match rate.
EXPECTED = {
    1800: (9345, 9777, 1915, 390988, 3396, 7450, 0.299241),
    43200: (3296, 9602, 1379, 115820221, 340157, 1917, 0.84557),
}


def test_adapter_counts(spark):
    clicks = m.clicks(spark, SF_CHECK)
    row = clicks.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.count_if(F.col("category_code").isNull()).alias("null_code"),
        F.count_if(F.col("user_session").isNull()).alias("null_session"),
    ).collect()[0]
    assert (row.n, row.null_price, row.null_code, row.null_session) == (10000, 113, 980, 141)
    assert m.rejected_clicks(spark, SF_CHECK).count() == 222
    assert m.clean_clicks(spark, SF_CHECK).count() == 9778


@pytest.mark.parametrize("timeout", [1800, 43200])
def test_session_numbers(spark, timeout):
    met = m.metrics(spark, SF_CHECK, timeout)
    r = met.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("distinct_products").alias("dp"),
        F.count_if("is_purchased").alias("purchased"),
        F.sum("session_duration_sec").alias("dur"),
        F.max("session_duration_sec").alias("max_dur"),
        F.count_if(F.col("avg_price_viewed").isNull()).alias("no_priced_view"),
    ).collect()[0]
    rate = session_match_rate(m.silver(spark, SF_CHECK, timeout, with_sequence=False)).collect()[0].match_rate
    got = (r.sessions, r.dp, r.purchased, r.dur, r.max_dur, r.no_priced_view)
    assert got == EXPECTED[timeout][:6]
    assert rate == pytest.approx(EXPECTED[timeout][6], abs=1e-5)
