"""Embedding near-duplicates: epsilon grid order join.

Vectors of one label are linked if their cosine reaches ``THRESHOLD``; for unit vectors that is a
Euclidean distance of at most eps = sqrt(2 - 2 * THRESHOLD), in every orthogonal projection too.

1. Equal vectors of a label collapse to one with a count, so copies are never paired.
2. Unit vectors are sorted by their grid cells (width eps) on ``LEAD`` leading principal directions
   and cut into blocks of at most ``BLOCK`` rows. The directions come from a bounded sample
   (``SAMPLE`` vectors); they only steer the order, every result is exact with any of them.
3. Sequence intervals are joined recursively: an interval of FANOUT^k blocks is paired with another
   only if the gap between their bounding boxes is at most eps, down to pairs of blocks.
4. A pair of blocks is multiplied in double precision. It returns a count of links per vector and
   a spanning forest of the links (at most one edge a vector), never the pairs themselves. Cosines
   within 1e-9 of the threshold are recomputed with exact sums.
5. Components over the forests.

Defined results: a null label or vector, an empty or zero vector and one with null or non-finite
components link with nothing; vectors of different length do not link; rows with equal vec_id are
counted as rows, each gets its result; a null vec_id orders after all others; extra columns are
not read.
"""

from __future__ import annotations

from math import fsum, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import components, lookup, running_total, ship_code, shuffle_parts, stage, table

THRESHOLD = 0.98
LEAD, BLOCK, BLOCK_BYTES, FANOUT, SAMPLE = 4, 256, 1 << 21, 8, 20_000
_CELLS = [f"c{i}" for i in range(LEAD)]
_LO, _HI = [f"lo{i}" for i in range(LEAD)], [f"hi{i}" for i in range(LEAD)]


def _rows(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(dims: np.ndarray):
    for d in np.unique(dims):
        yield int(d), np.flatnonzero(dims == d)


def principal(vectors: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Leading directions (dim x LEAD) of the commonest vector length, from about ``sample`` rows.
    The driver adds up one small matrix per task."""
    top = vectors.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if top is None:
        return None
    dim, buckets = top["dim"], 1 << 20
    share = max(1, min(buckets, int(buckets * sample / top["n"])))

    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                u = _unit(_rows(b.column(0), dim))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["m"])

    picked = vectors.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("fp"), F.lit(buckets)) < share)).select("vec").coalesce(8)
    parts = picked.mapInArrow(run, "m binary").collect()
    total = sum(np.frombuffer(r["m"]).reshape(dim, dim) for r in parts)
    return np.linalg.eigh(total)[1][:, ::-1][:, :LEAD]


def _project(u: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    if axes is not None and len(axes) == u.shape[1]:
        p = u @ axes
    else:
        p = u[:, :LEAD]  # another orthonormal choice
    return np.pad(p, ((0, 0), (0, LEAD - p.shape[1])))


def _ordered(vectors: DataFrame, axes, eps: float) -> DataFrame:
    """Vectors with their cells, sorted by (label, dim, cells) within range partitions."""

    def run(batches):
        for b in batches:
            cells = np.zeros((b.num_rows, LEAD), np.int64)
            for d, at in _by_dim(b.column(3).to_numpy()):
                u = _unit(_rows(b.column(4).take(pa.array(at)), d))
                cells[at] = np.floor(_project(u, axes) / eps)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(cells[:, i]) for i in range(LEAD)]], names=[*b.schema.names, *_CELLS])

    kind = vectors.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + "".join(f", {c} bigint" for c in _CELLS)
    order = ["label", "dim", *_CELLS, "fp"]
    return (
        vectors.mapInArrow(run, schema)
        .repartitionByRange(shuffle_parts(vectors.sparkSession), *order)
        .sortWithinPartitions(*order)
    )


def _blocks(ordered: DataFrame, axes, label_type: str) -> DataFrame:
    """One row per block: bid, label, dim, fps, counts, unit vectors as bytes, bounding box."""

    def cut(batches):
        label = dim = None
        held: list[tuple] = []
        for b in batches:
            rows = zip(*(b.column(b.schema.names.index(c)).to_pylist() for c in ("label", "dim", "fp", "n", "vec")), strict=True)
            for lab, d, fp, n, v in rows:
                if held and ((lab, d) != (label, dim) or len(held) >= max(1, min(BLOCK, BLOCK_BYTES // (8 * d)))):
                    yield label, dim, held
                    held = []
                label, dim = lab, d
                held.append((fp, n, v))
        if held:
            yield label, dim, held

    def run(batches):
        for k, (label, dim, held) in enumerate(cut(batches)):
            raw = np.array([v for _, _, v in held], np.float64)
            p = _project(_unit(raw), axes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()), pa.array([label], LABEL), pa.array([dim], pa.int32()), pa.array([[f for f, _, _ in held]], pa.list_(pa.binary())),
                 pa.array([[n for _, n, _ in held]], pa.list_(pa.int64())), pa.array([raw.tobytes()], pa.binary()),
                 *[pa.array([x]) for x in p.min(axis=0)], *[pa.array([x]) for x in p.max(axis=0)]],
                names=["k", "label", "dim", "fps", "counts", "mat", *_LO, *_HI],
            )

    LABEL = pa.string()
    box = ", ".join(f"{c} double" for c in (*_LO, *_HI))
    texts = ordered.withColumn("label", F.col("label").cast("string"))
    out = texts.mapInArrow(run, f"k bigint, label string, dim int, fps array<binary>, counts array<bigint>, mat binary, {box}")
    return stage(out.withColumn("part", F.spark_partition_id()), "blocks")


def _near(eps: float):
    gaps = [F.greatest(F.col(f"b_{lo}") - F.col(f"a_{hi}"), F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.lit(0.0)) for lo, hi in zip(_LO, _HI, strict=True)]
    return sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b) with a <= b: pairs of blocks that may hold a link, by descent over intervals."""
    narrow = blocks.select("label", "dim", "part", "k", *_LO, *_HI)
    seq = stage(running_total(narrow, ["label", "dim"], ["part", "k"], {"seq": F.lit(1)}, name="sequence"), "sequence")
    most = seq.agg(F.max("seq")).first()[0]
    levels = [seq.withColumnRenamed("seq", "node")]
    levels_n = 0
    while most and most >= FANOUT**levels_n:
        levels_n += 1
    for _ in range(levels_n):
        up = levels[-1].withColumn("node", F.floor(F.col("node") / FANOUT)).groupBy("label", "dim", "node")
        levels.append(stage(up.agg(*[F.min(c).alias(c) for c in _LO], *[F.max(c).alias(c) for c in _HI]), "interval"))
    pairs = levels[-1].select("label", "dim", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        kids = level.select("label", "dim", F.floor(F.col("node") / FANOUT).alias("up"), "node", *_LO, *_HI)
        left = kids.select("label", "dim", F.col("up").alias("a"), F.col("node").alias("a_node"), *[F.col(c).alias(f"a_{c}") for c in (*_LO, *_HI)])
        right = kids.select("label", "dim", F.col("up").alias("b"), F.col("node").alias("b_node"), *[F.col(c).alias(f"b_{c}") for c in (*_LO, *_HI)])
        both = pairs.join(left, ["label", "dim", "a"]).join(right, ["label", "dim", "b"])
        both = both.where((F.col("a_node") <= F.col("b_node")) & _near(eps))
        pairs = stage(both.select("label", "dim", F.col("a_node").alias("a"), F.col("b_node").alias("b")), "pairs")
    at = seq.select("label", "dim", "seq", "part", "k")
    out = pairs.join(at.select("label", "dim", F.col("seq").alias("a"), F.col("part").alias("part_a"), F.col("k").alias("k_a")), ["label", "dim", "a"])
    out = out.join(at.select("label", "dim", F.col("seq").alias("b"), F.col("part").alias("part_b"), F.col("k").alias("k_b")), ["label", "dim", "b"])
    return stage(out.select("part_a", "k_a", "part_b", "k_b"), "block-pairs")


def _linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    c = _unit(a) @ _unit(b).T
    mask = c >= threshold
    for i, j in zip(*np.nonzero(np.abs(c - threshold) < 1e-9), strict=True):
        x, y = a[i].tolist(), b[j].tolist()
        top = fsum(p * q for p, q in zip(x, y, strict=True))
        mask[i, j] = top / sqrt(fsum(p * p for p in x) * fsum(q * q for q in y)) >= threshold
    return mask


def _forest(mask: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Edges (row of left, row of right) of a spanning forest of the links; in a block with itself
    both index that block."""
    out, rows, cols = [], np.ones(mask.shape[0], bool), np.ones(mask.shape[1], bool)
    for seed in range(mask.shape[0]):
        if not rows[seed] or (same and not cols[seed]):
            continue
        rows[seed] = False
        if same:
            cols[seed] = False
        queue = [(seed, 0)]
        while queue:
            x, side = queue.pop()
            new = np.flatnonzero(mask[x] & cols) if side == 0 else np.flatnonzero(mask[:, x] & rows)
            for y in new.tolist():
                out.append((x, y) if side == 0 else (y, x))
                queue.append((y, 0 if same else 1 - side))
            if side == 0:
                cols[new] = False
                if same:
                    rows[new] = False
            else:
                rows[new] = False
    return out


def _joined(blocks: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(fp, other, links): a partial count of links of ``fp``, or an edge (fp, other) of a forest."""
    cols = ["part", "k", "fps", "counts", "mat", "dim"]
    left = blocks.select(*[F.col(c).alias(f"{c}_a") for c in cols])
    right = blocks.select(*[F.col(c).alias(f"{c}_b") for c in cols])
    both = pairs.join(left, ["part_a", "k_a"]).join(right, ["part_b", "k_b"]).select(
        F.expr("part_a = part_b AND k_a = k_b").alias("same"), "fps_a", "counts_a", "mat_a", "fps_b", "counts_b", "mat_b", F.col("dim_a").alias("dim")
    )

    def run(batches):
        for t in batches:
            for same, fa, na, ma, fb, nb, mb, dim in zip(*(c.to_pylist() for c in t.columns), strict=True):
                a, b = (np.frombuffer(m).reshape(-1, dim) for m in (ma, mb))
                mask = _linked(a, b, threshold)
                if same:
                    mask |= np.eye(len(a), dtype=bool) | mask.T
                fps, other, links = [], [], []
                got = mask @ np.array(nb)
                for i in np.flatnonzero(got):
                    fps.append(fa[i])
                    other.append(None)
                    links.append(int(got[i]) - same)
                if not same:
                    got = mask.T @ np.array(na)
                    for j in np.flatnonzero(got):
                        fps.append(fb[j])
                        other.append(None)
                        links.append(int(got[j]))
                for i, j in _forest(mask, same):
                    fps.append(fa[i])
                    other.append(fb[j])
                    links.append(0)
                yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), pa.array(other, pa.binary()), pa.array(links, pa.int64())], names=["fp", "other", "links"])

    return stage(both.mapInArrow(run, "fp binary, other binary, links bigint"), "links")


def near_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (vec_id = component_id)."""
    ship_code(vectors.sparkSession)
    eps = sqrt(2 - 2 * threshold) + 1e-6
    vec = F.col("vec")
    usable = F.coalesce(
        F.col("label").isNotNull() & (F.size(vec) > 0)
        & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vec, lambda x: x != 0), F.lit(False),
    )
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    mark = F.unhex(F.md5(F.concat_ws("|", F.col("label").cast("string"), F.array_join(vec.cast("array<string>"), ","))))
    rows = rows.withColumn("fp", F.when(usable, mark))
    ids = rows.select("vec_id", "fp")
    one = rows.where("fp IS NOT NULL").groupBy("fp", "label", "vec").agg(F.count("*").alias("n"))
    one = stage(one.select("fp", "label", "n", F.size("vec").alias("dim"), "vec"), "vectors")
    axes = principal(one)
    blocks = _blocks(_ordered(one, axes, eps), axes, "string")
    found = _joined(blocks, _block_pairs(blocks, eps), threshold)
    counts = found.where("other IS NULL").groupBy("fp").agg(F.sum("links").alias("n_links"))
    comp = components(found.where("other IS NOT NULL").select(F.col("fp").alias("a"), F.col("other").alias("b")))
    per = one.select("fp", "n").join(counts, "fp", "left").join(comp.toDF("fp", "component"), "fp", "left")
    ids = stage(ids, "ids")
    least = ids.where("fp IS NOT NULL").groupBy("fp").agg(F.min("vec_id").alias("least"))
    per = per.join(least, "fp").select("fp", "n", "least", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "fp").alias("component"))
    per = stage(per, "per-vector")  # a row for each different vector
    low = stage(per.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("sets")), "lowest")
    named = stage(lookup(per.drop("least"), low, ["component"], "sets"), "named")
    out = lookup(ids.where("fp IS NOT NULL"), named, ["fp"], "n").select("vec_id", "n_links", "component_id")
    alone = ids.where("fp IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_epsgrid(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""
