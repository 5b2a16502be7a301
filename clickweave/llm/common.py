"""Shared pieces of the operators: staged tables, distributed running totals, components.

Staged tables are written under ``spark.checkpoint.dir`` (a folder all executors share), so a lost
executor costs at most the stage that was running.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave import session
from clickweave.session import ensure_checkpoint_dir, scratch_path

#: Rows of a small key table that a task may hold as a broadcast (counted before it is used).
BROADCAST_ROWS = 500_000


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let the Python workers import this package, wherever they run: once a session, a zip of its
    sources goes to the shared scratch folder and from there to the executors."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in (root / "__init__.py", root / "session.py", *sorted((root / "llm").glob("*.py"))):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    ensure_checkpoint_dir(spark)
    uri = scratch_path(spark, "llm-code") + ".zip"
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_output_stream(path) as out:
        out.write(packed.getbuffer())
    spark.sparkContext.addPyFile(uri)
    _shipped.add(app)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared scratch folder."""
    ship_code(spark)
    ensure_checkpoint_dir(spark)
    return scratch_path(spark, f"llm-{name}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here. ``release``
    frees it once nothing reads it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*staged: DataFrame) -> None:
    """Delete staged tables (as ``stage`` returned them) that nothing reads any more."""
    for df in staged:
        session.release(df.sparkSession, df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; else ``df``, for a shuffled
    join. ``df`` should be staged, since it is counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def hash_order(seed: str, *cols: Column | str) -> Column:
    """A pseudo-random but reproducible sort key (md5 hex, so that any engine can recompute it)."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    totals: dict[str, Column],
    *,
    name: str = "running",
) -> DataFrame:
    """Add to each row, for each ``out: value`` of ``totals``, the sum of ``value`` over the rows
    of its ``keys`` that precede it in ``order`` (exclusive prefix sum; nulls are a key of their own).

    No task needs a whole key: rows are dealt into ranges of (keys, order); each range sums what it
    has, ranges are offset by the totals of the ranges before them (one row per key and range).
    ``order`` must be total up to rows that may change places. Columns of ``df`` stay; ``df``
    should be narrow, as its rows are staged once.
    """
    spark = df.sparkSession
    by = [F.col(k) for k in keys]
    vals = {f"_v{i}": v.cast("long") for i, v in enumerate(totals.values())}
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = stage(
        df.withColumns({**vals, **{f"_o{i}": o for i, o in enumerate(ords)}})
        .repartitionByRange(shuffle_parts(spark), *by, *[F.col(f"_o{i}") for i in range(len(ords))])
        .withColumn("_range", F.spark_partition_id()),
        name,
    )
    w = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(*[F.sum(v).alias(v) for v in vals])
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_range").alias("_at"),
            *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_b{v}") for v in vals],
        )
    )
    offsets = bounded_broadcast(stage(offsets, f"{name}-offsets"))
    on = F.col("_range") == F.col("_at")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    local = (
        Window.partitionBy(*by, "_range")
        .orderBy(*[f"_o{i}" for i in range(len(ords))])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    out = ranged.withColumns({f"_l{v}": F.coalesce(F.sum(v).over(local), F.lit(0)) for v in vals}).join(offsets, on)
    return out.select(
        *df.columns, *[(F.col(f"_b_v{i}") + F.col(f"_l_v{i}")).alias(o) for i, o in enumerate(totals)]
    )


def lookup(rows: DataFrame, values: DataFrame, keys: Sequence[str], count: str, *, name: str = "lookup") -> DataFrame:
    """``rows`` with the other columns of ``values``, which has each of the rows' ``keys`` once (no
    nulls) and in ``count`` the number of rows that hold it; rows without one go.

    Keys of more than a share of all rows are joined where their rows lie: each has over
    1 / (2 p) of the rows, p the shuffle partitions, so at most 2 p of them are broadcast. The
    others are shuffled. ``rows`` and ``values`` should be staged.
    """
    spark = rows.sparkSession
    total = values.agg(F.sum(count)).first()[0] or 0
    bound = max(1000, int(total) // (2 * shuffle_parts(spark)))
    value = values.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    match = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    drop = [f"_k{i}" for i in range(len(keys))]
    hot = stage(value.where(F.col(count) > bound), f"{name}-hot")
    cold = rows.join(value.where(F.col(count) <= bound), match)
    if hot.isEmpty():
        return cold.drop(count, *drop)
    rest = rows.join(F.broadcast(hot.select(*drop)), match, "left_anti").join(value.where(F.col(count) <= bound), match)
    return rest.unionByName(rows.join(F.broadcast(hot), match)).drop(count, *drop)


def without(documents: DataFrame, keys: dict[str, Column], drop: DataFrame, once: DataFrame) -> DataFrame:
    """The rows and columns of ``documents`` less those whose ``keys`` (name: value) are in ``drop``, and
    all but one of each of the keys in ``once``. Columns of any name pass."""
    names = list(keys)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *[v.alias(k) for k, v in keys.items()])
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"x.{k}")) for k in names]
    left = rows.alias("d").join(bounded_broadcast(stage(drop.select(*names).distinct(), "drop")).alias("x"), on, "left_anti")
    once = stage(once.select(*names).distinct(), "once")
    if once.isEmpty():
        return left.select("row.*")
    once = bounded_broadcast(once)
    twice = left.alias("d").join(once.alias("x"), on, "left_semi").withColumn("place", F.xxhash64("row.*"))
    least = twice.groupBy(*names).agg(F.min("place").alias("place"))  # the same row at every run
    twice = twice.alias("d").join(least.alias("x"), [*on, F.col("d.place") == F.col("x.place")], "left_semi").dropDuplicates(names)
    return left.alias("d").join(once.alias("x"), on, "left_anti").select("row").unionByName(twice.select("row")).select("row.*")


#: Ways a node's links are split in ``components``, so that no task joins a whole hub.
SALTS = 8


def _lowest(edges: DataFrame, low: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m``, the value ``low`` (u, m) has for u."""
    many = low.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(many, ["u", "_salt"]).drop("_salt")


def components(links: DataFrame, a: str = "a", b: str = "b", *, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``links``, for every node that has one.

    Alternates large-star and small-star steps: every node's neighbours are hooked to its smallest
    one, until the links form stars. Each round is staged; the links of a hub are dealt over
    ``SALTS`` keys where they are joined. Links never leave the executors.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    for _ in range(max_rounds):
        ends = F.explode(F.array(*[F.struct(F.col(c).alias("node"), F.lit(i).alias("child")) for c, i in (("u", 1), ("v", 0))]))
        roles = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.child").alias("up"), F.min("e.child").alias("root"))
        if roles.where("up > 1 OR (up = 1 AND root = 0)").isEmpty():  # stars only
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _lowest(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _lowest(large, low).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
