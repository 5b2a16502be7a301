"""The raw schema as a reader sees it: types, NULLs and the corrupt-line flag of a small CSV."""

import os

from clickweave.sources.csv_events import read_raw_events
from clickweave.sources.schema import CORRUPT_COLUMN, RAW_EVENT_SCHEMA

# name, Spark type, may be NULL
LAYOUT = [
    ("event_time", "string", False), ("event_type", "string", False), ("product_id", "int", False), ("category_id", "string", True),
    ("category_code", "string", True), ("brand", "string", True), ("price", "float", True), ("user_id", "int", False),
    ("user_session", "string", True), (CORRUPT_COLUMN, "string", True),
]


def test_raw_layout():
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in RAW_EVENT_SCHEMA] == LAYOUT


def test_a_small_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clicks.csv")
    with open(path, "w") as f:
        f.write(",".join(n for n, *_ in LAYOUT[:-1]) + "\n")
        f.write("2019-10-01 00:00:00 UTC,view,7,c1,a.b,x,1.5,3,s1\n")
        f.write("2019-10-01 00:00:01 UTC,cart,8,,,,,4,\n")
        f.write("2019-10-01 00:00:02 UTC,cart,not a number,c1,a.b,x,1.5,3,s1\n")
    good, sparse, broken = sorted(read_raw_events(spark, path).collect(), key=lambda r: r.event_time)
    assert (good.product_id, good.price, good.user_id, good[CORRUPT_COLUMN]) == (7, 1.5, 3, None)
    assert [sparse[c] for c in ("category_id", "category_code", "brand", "price", "user_session")] == [None] * 5
    assert broken.product_id is None and "not a number" in broken[CORRUPT_COLUMN]
