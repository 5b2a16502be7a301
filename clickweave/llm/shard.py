"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``BITS`` bits in an order-preserving way: numbers by the logarithm of
their distance from the minimum, strings by the first bytes after the prefix that all values share.
The bounds come from one aggregate of minima and maxima. Rows are ordered by the curve index of
their cells (Skilling's transpose form, as bit operations in a fold over the bits), and the order is
cut into runs: shards whose row counts differ by at most one. Neighbours on the curve are
neighbours in every dimension, so each shard covers a small box and filters on any of the
dimensions skip most shards (``shard_boxes``, ``prune``).

The global order is a distributed running count; no task sees more than its range. Only ids, sizes
and dimensions are shuffled to assign shards, texts only to write them.

Defined results: nulls take cell 0 of their dimension, before all values; equal cells are ordered by
doc_id (nulls first), then text hash; repeated rows take neighbouring slots; an empty table gives no
rows; extra columns are kept by ``write_shards`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import bounded_broadcast, running_total, stage, table

BITS, SHARDS = 16, 8
DIMENSIONS = ("lang", "source", "n_chars")
_PREFIX_BYTES = 6


def _code(c: Column, skip: int) -> Column:
    """The bytes of a string after its first ``skip`` characters, as a number (six bytes)."""
    rest = F.substring(F.hex(F.encode(F.substring(c, skip + 1, 2**31 - 1 - skip), "UTF-8")), 1, 2 * _PREFIX_BYTES)
    return F.conv(F.rpad(rest, 2 * _PREFIX_BYTES, "0"), 16, 10).cast("double")


def cells(df: DataFrame, dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS) -> list[Column]:
    """The cell number of each dimension: 0 for null, else 1 .. 2^bits - 1."""
    strings = {c for c, kind in df.dtypes if c in dimensions and kind == "string"}
    low_high = df.agg(*[f(F.col(c)).alias(f"{f.__name__}_{i}") for i, c in enumerate(dimensions) for f in (F.min, F.max)]).first()
    top, out = (1 << bits) - 2, []
    for i, c in enumerate(dimensions):
        lo, hi = low_high[2 * i], low_high[2 * i + 1]
        if lo is None or lo == hi:
            out.append(F.when(F.col(c).isNull(), 0).otherwise(1).cast("long"))
            continue
        if c in strings:
            skip = next((k for k, (a, b) in enumerate(zip(lo, hi, strict=False)) if a != b), min(len(lo), len(hi)))
            a, b = (int(x[skip:].encode()[:_PREFIX_BYTES].ljust(_PREFIX_BYTES, b"\0").hex(), 16) for x in (lo, hi))
            share = (_code(F.col(c), skip) - a) / max(1, b - a)
        else:
            span = F.log1p(F.lit(float(hi) - float(lo)))
            share = F.log1p(F.col(c).cast("double") - float(lo)) / span
        out.append(F.when(F.col(c).isNull(), 0).otherwise(1 + F.floor(F.least(share, F.lit(1.0)) * top)).cast("long"))
    return out


def hilbert_index(cols: Sequence[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve through the grid of ``cols`` (each below 2^bits)."""
    n = len(cols)
    start = F.array(*[c.cast("long") for c in cols])
    # (bit, dimension) pairs, most significant bit first
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def step(x: Column, s: Column) -> Column:
        p, first, own = s["q"] - 1, x[0], F.get(x, s["i"])
        swap = first.bitwiseXOR(own).bitwiseAND(p)
        invert = own.bitwiseAND(s["q"]) != 0
        new_first = F.when(invert, first.bitwiseXOR(p)).otherwise(first.bitwiseXOR(swap))
        return F.transform(
            x, lambda v, k: F.when(k == 0, new_first).when((k == s["i"]) & ~invert, v.bitwiseXOR(swap)).otherwise(v)
        )

    turned = F.aggregate(steps, start, step)
    # Gray code across dimensions, then the correction carried by the last one
    gray = F.aggregate(
        F.sequence(F.lit(1), F.lit(n - 1)) if n > 1 else F.array().cast("array<int>"),
        turned,
        lambda x, i: F.transform(x, lambda v, k: F.when(k == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v)),
    )
    carry = F.aggregate(
        F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]),
        F.struct(F.lit(0).cast("long").alias("t"), gray.alias("x")),
        lambda a, q: F.struct(
            F.when(F.get(a["x"], F.lit(n - 1)).bitwiseAND(q) != 0, a["t"].bitwiseXOR((q - 1).cast("long"))).otherwise(a["t"]).alias("t"), a["x"].alias("x")
        ),
        lambda a: F.transform(a["x"], lambda v: v.bitwiseXOR(a["t"])),
    )
    bit_places = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.aggregate(
        bit_places,
        F.struct(F.lit(0).cast("long").alias("h"), carry.alias("x")),
        lambda a, s: F.struct(
            (2 * a["h"] + (F.get(a["x"], s["i"]).bitwiseAND(s["q"]) != 0).cast("long")).alias("h"), a["x"].alias("x")
        ),
        lambda a: a["h"],
    )


def curve_shards(
    df: DataFrame, *, dimensions: Sequence[str] = DIMENSIONS, shards: int = SHARDS, bits: int = BITS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, dimensions, curve (index), shard, slot (from 0 within the shard);
    shards are runs of the curve with row counts at most one apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"),
        *[F.col(d).alias(f"dim{i}") for i, d in enumerate(dimensions)],
    )
    narrow = stage(narrow, "metadata")
    names = [f"dim{i}" for i in range(len(dimensions))]
    placed = narrow.withColumn("curve", hilbert_index(cells(narrow, names, bits), bits))
    ranked = running_total(placed, [], ["curve", "doc_id", "text_crc32"], {"rank": F.lit(1)}, name="curve")
    n = narrow.count()
    out = ranked.withColumn("shard", F.expr(f"(rank * {shards}) DIV {max(n, 1)}").cast("int"))
    first_rank = F.expr(f"(shard * {n}L + {shards - 1}) DIV {shards}")  # the least rank of the shard
    out = out.withColumn("slot", F.col("rank") - first_rank)
    return out.select("doc_id", "size", "text_crc32", *[F.col(a).alias(b) for a, b in zip(names, dimensions, strict=True)], "curve", "shard", "slot")


def write_shards(df: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", dimensions: Sequence[str] = DIMENSIONS, **parameters) -> str:
    """Write the rows of ``df`` to the shards ``curve_shards`` gives them, ``path/shard=<n>/``, rows of a file in
    curve order; returns the partition column's name, ``shard`` with as many ``_`` as ``df`` forces. Rows
    that are alike in id, text and dimensions change places at most among themselves."""
    assigned = curve_shards(df, doc_id=doc_id, text=text, dimensions=dimensions, **parameters)
    names = ["doc_id", "size", "text_crc32", *[f"dim{i}" for i in range(len(dimensions))]]
    assigned = stage(assigned.toDF(*names, "curve", "shard", "slot"), "assigned")
    body = F.coalesce(F.col(text), F.lit(""))
    values = [F.col(doc_id), F.octet_length(body).cast("long") + 1, F.crc32(body), *[F.col(d) for d in dimensions]]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[v.alias(k) for k, v in zip(names, values, strict=True)])
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"x.{k}")) for k in names]
    again = stage(assigned.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names), "again")
    once, repeated = rows, not again.isEmpty()
    if repeated:
        few = bounded_broadcast(again).alias("x")
        once = rows.alias("d").join(few, on, "left_anti")
        marked = stage(rows.alias("d").join(few, on, "left_semi").withColumn("at", F.monotonically_increasing_id()), "repeated")
        marked = running_total(marked, names, ["at"], {"twin": F.lit(1)}, name="row-twins")
        places = running_total(assigned.alias("d").join(few, on, "left_semi"), names, ["shard", "slot"], {"twin": F.lit(1)}, name="place-twins")
        twice = marked.alias("d").join(places.alias("x"), [*on, F.col("d.twin") == F.col("x.twin")]).select("d.row", "x.shard", "x.curve", "x.slot")
        assigned = assigned.alias("d").join(few, on, "left_anti")
    out = once.alias("d").join(assigned.alias("x"), on).select("d.row", "x.shard", "x.curve", "x.slot")
    out = out.unionByName(twice) if repeated else out
    name = "shard"
    while name in df.columns:
        name += "_"
    out = out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out.select("row.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(path)
    return name


def shard_boxes(assigned: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """(shard, rows, min and max of each dimension): what a reader prunes by."""
    bounds = [f(d).alias(f"{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max)]
    return assigned.groupBy("shard").agg(F.count("*").alias("rows"), *bounds)


def prune(boxes: DataFrame, **ranges) -> DataFrame:
    """The shards that may hold rows with each named dimension in its (low, high) range."""
    for d, (lo, hi) in ranges.items():
        boxes = boxes.where((F.col(f"max_{d}") >= F.lit(lo)) & (F.col(f"min_{d}") <= F.lit(hi)))
    return boxes.select("shard")


def op4_hilbert(spark, sf_dir):
    return curve_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
