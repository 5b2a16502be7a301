"""Plan assertions: no Python evaluation anywhere, one event-level exchange for the flagship,
no per-user window over event rows (skew), pruned scans with pushed filters."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from clickweave.operators.sessions import sessionize
from clickweave.plans import catalog
from clickweave.plans.medallion import staged

from testdata import SF_CHECK

#: Queries with an oracle that are plans, not jobs that write tables or fit models first.
_JOBS = ("s1_", "s3_", "s4_", "k1_", "k3_", "k4_upsert_table", "k4_upsert_files", "k7", "k9", "k10", "k11", "k12", "t2", "e2", "e3", "l1", "l2", "l5", "l8", "t1_running", "t1_late", "p16_stream", "a13_distinct", "q2_write")
NON_ML = [k for k in catalog.ORACLE if not k.startswith(_JOBS)]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def nodes(text: str, name: str):
    """(header, body) of every formatted-plan node called ``name``."""
    out = []
    for m in re.finditer(rf"^\(\d+\) {name}.*?(?=^\(\d+\) |\Z)", text, re.S | re.M):
        out.append(m.group(0))
    return out


@pytest.mark.parametrize("name", NON_ML)
def test_no_python_in_plan(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_CHECK))
    assert "PythonUDF" not in text and "EvalPython" not in text and "MapInPandas" not in text


def test_flagship_moves_events_once(spark):
    """The plan for tables too large to be broadcast (the test tables are not); the adapter's own join with
    ``part``, which makes clicks of the driver's events, is left aside."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan_text(entry.queries()["a1_session_metrics"](spark, SF_CHECK))
    finally:
        spark.conf.set(key, old)
    event_level = [n for n in nodes(text, "Exchange") if "event_type" in n.split("Arguments")[0] and "hashpartitioning(cast(k#" not in n]
    assert len(event_level) == 1, event_level
    assert "hashpartitioning(user_id" in event_level[0] and "_chunk" in event_level[0]


@pytest.mark.parametrize("name", ["w4_sessionize_30m", "w5_event_sequence", "a1_session_metrics", "h1_incremental_sessions"])
def test_no_user_only_window_over_events(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_CHECK))
    for w in nodes(text, "Window"):
        inputs = w.split("Arguments")[0]
        if "event_type" in inputs or "src_event_id" in inputs:
            args = w.split("Arguments", 1)[1]
            assert "_chunk" in args, w


def test_event_sequence_sorts_events_once(spark):
    """One sort of the events by (user, chunk, time) serves the window and the join with the chunks."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan_text(sessionize(staged(spark, SF_CHECK), 1800))
    finally:
        spark.conf.set(key, old)
    of_events = lambda name: [n for n in nodes(text, name) if "event_type" in n.split("Arguments")[0]]
    by_chunk = [n for n in of_events("Sort") if "_chunk" in n]
    assert len(by_chunk) == 1, by_chunk
    assert len([n for n in of_events("Exchange") if "_chunk" in n]) == 1
    assert len(of_events("Window")) == 1 and "_chunk" in of_events("Window")[0]


def test_scans_are_pruned_and_filtered(spark):
    text = plan_text(entry.queries()["a1_session_metrics"](spark, SF_CHECK))
    scans = nodes(text, "Scan parquet")
    part = [s for s in scans if "part.parquet" in s]
    assert part and all("p_retailprice" not in s and "p_size" not in s for s in part)
    events = [s for s in scans if "events.parquet" in s]
    assert events and all("PushedFilters" in s for s in events)


@pytest.mark.parametrize("name,sides", [("j1_bucketed_attach", 2), ("j3_bucketed_orphans", 2), ("k4_bucketed_upsert", 2)])
def test_bucketed_joins_move_no_rows(spark, name, sides):
    text = plan_text(entry.queries()[name](spark, SF_CHECK))
    assert not nodes(text, "Exchange") and not nodes(text, "BroadcastExchange"), text
    assert len(nodes(text, "SortMergeJoin")) == 1 and text.count("Bucketed: true") >= sides
