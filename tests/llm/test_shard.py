import itertools
import zlib

from pyspark.sql import functions as F

from clickweave.llm import shard as S


def test_curve_visits_neighbours(spark):
    for n, bits in ((1, 3), (2, 3), (3, 2), (4, 2)):
        cells = list(itertools.product(range(1 << bits), repeat=n))
        df = spark.createDataFrame(cells, [f"x{i}" for i in range(n)])
        got = sorted(df.withColumn("h", S.hilbert_index([F.col(f"x{i}") for i in range(n)], bits)).collect(), key=lambda r: r["h"])
        assert [r["h"] for r in got] == list(range(len(cells)))
        assert all(sum(abs(a[i] - b[i]) for i in range(n)) == 1 for a, b in zip(got, got[1:], strict=False))


def test_cells_keep_order(spark):
    values = [None, "src0", "src1", "src10", "src19", "src2", "src9", "srcé"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "s string, n bigint")
    got = {r["s"]: r["c"] for r in df.withColumn("c", S.cells(df, ["s"])[0]).collect()}
    assert got[None] == 0
    order = sorted(v for v in values if v)
    assert [got[v] for v in order] == sorted(got[v] for v in order) and len(set(got.values())) == len(values)
    nums = [r["c"] for r in df.withColumn("c", S.cells(df, ["n"])[0]).orderBy("n").collect()]
    assert nums == sorted(nums) and nums[0] == 1


def test_shards_are_runs_of_equal_counts(spark, documents):
    rows = [(i, "x" * (i * 7 % 50), f"s{i % 5}") for i in range(101)] + [(3, None, None), (3, "é", "s1"), (3, "é", "s1"), (None, "", "s2")]
    df = documents(rows)
    got = S.curve_shards(df).collect()
    per = {}
    for r in got:
        per.setdefault(r["shard"], []).append(r)
    assert set(per) == set(range(8)) and len(got) == len(rows)
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    for rs in per.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    last = [max(r["curve"] for r in per[i]) for i in range(8)]
    assert all(last[i] <= min(r["curve"] for r in per[i + 1]) for i in range(7))
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    assert S.curve_shards(documents([])).count() == 0
    assert [r["shard"] for r in S.curve_shards(documents(rows[:3])).collect()]


def test_written_shards_and_pruning(spark, documents, tmp_path):
    df = documents([(i, "x" * (i % 40), f"s{i % 9}") for i in range(300)], extra=False)
    S.write_shards(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    assigned = S.curve_shards(df)
    left = {r["shard"] for r in S.prune(S.shard_boxes(assigned), source=("s1", "s1"), n_chars=(0, 3)).collect()}
    need = {r["shard"] for r in assigned.where("source = 's1' AND n_chars <= 3").collect()}
    assert need <= left and len(left) < 8


def test_every_row_goes_to_the_shard_it_was_given(spark, tmp_path):
    """Repeated rows are dealt over shards too; columns may have any names."""
    rows = [(i % 7, "same" if i % 3 else f"t{i}", "en", "s", i % 2) for i in range(90)] + [(None, None, None, None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df = df.selectExpr("*", "1 AS shard", "2 AS _c", "3 AS _d", "4 AS _curve", "5 AS row", "6 AS slot", "7 AS `a.b`")
    assert S.write_shards(df, str(tmp_path / "out")) == "shard_"
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.drop("shard_").collect())) == sorted(map(repr, df.collect()))
    key = lambda r: (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
    want = sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in S.curve_shards(df).collect()), key=repr)
    assert sorted(((*key(r), r["shard_"]) for r in back.collect()), key=repr) == want


def test_the_curve_nests_in_sub_cubes(spark):
    """Every aligned sub-cube is one run of the curve, as in the recursive definition, at every size."""
    for n, bits in ((2, 4), (3, 3)):
        cells = list(itertools.product(range(1 << bits), repeat=n))
        df = spark.createDataFrame(cells, [f"x{i}" for i in range(n)])
        place = {tuple(r)[:n]: r["h"] for r in df.withColumn("h", S.hilbert_index([F.col(f"x{i}") for i in range(n)], bits)).collect()}
        for b in range(1, bits):
            cubes = {}
            for c in cells:
                cubes.setdefault(tuple(v >> b for v in c), []).append(place[c])
            for hs in cubes.values():
                assert max(hs) - min(hs) + 1 == len(hs) == 1 << (n * b) and min(hs) % len(hs) == 0
