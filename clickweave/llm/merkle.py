"""Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf, the SHA-256 of its length-framed fields. The leaves of a tree (here: of a
source) ascend by id; while several nodes remain, every ``FANOUT`` consecutive ones (the last run
may be shorter, even one) become their hash. The roots of the trees, in order of their names, are
the leaves of one more tree, whose root names the dataset.

Leaves are dealt to aligned partitions: ``FANOUT ** LOCAL`` consecutive leaves of a tree, that is a
whole subtree, however many rows a tree has. Each partition hashes its own subtree. Then the
partitions exchange roots as a butterfly does: in round r those whose numbers differ only in digit
r (to base ``FANOUT``) swap the roots of the subtrees they stand for, at most ``FANOUT`` of them, and
each hashes the common parent by itself. After as many rounds as the tree has upper levels every
partition holds the tree's root and all siblings on the way to it: its upper proof, with no pass
downwards. Where the last subtree of a level is incomplete, it has fewer partitions than its
neighbours; each of them then answers for several partners. The roots of the trees exchange theirs
in the same way. A round is one shuffle of one row a partition (not of rows of the data).

Defined results: null fields differ from empty ones; repeated rows are separate leaves; a null id
comes first, rows of equal id ascend by leaf; the null tree is a tree of its own and comes first; an
empty table has no rows and no root; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import BROADCAST_ROWS, bounded_broadcast, lookup, running_total, ship_code, stage, table

FANOUT = 16
#: Levels of the tree inside a partition.
LOCAL = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OUT = "id bigint, tree string, pos bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_STEP = "struct<before:string,after:string>"


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def framed(value: Column) -> Column:
    """A field of a leaf: its bytes' number, a colon and the value; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def levels(n: int, fanout: int = FANOUT) -> int:
    """Levels above ``n`` nodes."""
    up = 0
    while n > 1:
        n, up = -(-n // fanout), up + 1
    return up


def _runs(nodes: list[bytes], up: int, fanout: int) -> list[list[bytes]]:
    """The nodes of each level from the leaves up to ``up`` levels above them."""
    out = [nodes]
    for _ in range(up):
        below = out[-1]
        out.append([_hash(b"".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return out


def _beside(level: list[bytes], i: int, fanout: int) -> tuple[bytes, bytes]:
    """What stands before and after node ``i`` in its run."""
    start = i - i % fanout
    return b"".join(level[start:i]), b"".join(level[i + 1 : start + fanout])


def _local_levels(n: int, local: int, fanout: int) -> int:
    return min(local, levels(n, fanout))


def _subtree_roots(packed: DataFrame, local: int, fanout: int) -> DataFrame:
    """(tree, block, blocks, digest): the root of each partition's own subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for n, members in zip(b.column(2).to_pylist(), b.column(3), strict=True):
                nodes = [x.encode() for x in members.values.field("leaf").to_pylist()]
                digests.append(_runs(nodes, _local_levels(n, local, fanout), fanout)[-1][0].decode())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(digests)], names=["tree", "block", "n", "digest"])

    roots = packed.select("tree", "block", "n", "members").mapInArrow(run, "tree string, block bigint, n bigint, digest string")
    return roots.select("tree", "block", F.ceil(F.col("n") / fanout**local).cast("long").alias("blocks"), "digest")


def butterfly(partitions: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``partitions`` (tree, block, blocks, digest), numbered from 0 in each tree, with digest, now the
    root of the whole tree, and path: for each level what stands before and after the partition's
    own ancestor in its run.

    One exchange for each level of the tallest tree. In round r a partition stands for the
    subtree of ``span = fanout ** r`` partitions it belongs to, and meets those of the same place in
    the other subtrees of its run.
    """
    most = partitions.agg(F.max("blocks")).first()[0] or 0
    state = partitions.withColumn("path", F.array().cast(f"array<{_STEP}>"))
    span = 1
    while span < most:
        size = F.lit(span).cast("long")
        place, subtree = F.col("block") % size, F.floor(F.col("block") / size)
        last = F.floor((F.col("blocks") - 1) / size)  # the last subtree, maybe incomplete
        there = F.col("blocks") - last * size  # partitions that stand for it
        answers = F.when((F.col("blocks") > size) & (subtree == last), F.sequence(place, size - 1, there)).otherwise(F.array(place))
        sent = state.withColumns({"at": F.explode(answers), "digit": subtree % fanout, "run": F.floor(subtree / fanout)})
        met = Window.partitionBy("tree", "run", "at").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        beside = lambda side: F.array_join(F.transform(F.filter("met", side), lambda x: x["digest"]), "")
        swapped = sent.withColumn("met", F.collect_list(F.struct("digit", "digest")).over(met)).where(F.col("at") == place)
        step = F.struct(beside(lambda x: x["digit"] < F.col("digit")).alias("before"), beside(lambda x: x["digit"] > F.col("digit")).alias("after"))
        whole = F.sha2(beside(lambda x: F.lit(True)), 256)
        more = F.col("blocks") > size
        state = stage(
            swapped.select(
                "tree", "block", "blocks", F.when(more, whole).otherwise(F.col("digest")).alias("digest"),
                F.when(more, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
            ),
            "butterfly",
        )
        span *= fanout
    return state


def manifest(leaves: DataFrame, *, fanout: int = FANOUT, local: int = LOCAL, with_path: bool = False) -> DataFrame:
    """One row per row of ``leaves`` (id bigint, tree string, leaf string[, check string]): id, tree, pos
    (in its tree), leaf, subroot, root, proof_sha256 (hash of its siblings from the leaf up),
    folded_root (the root that ``check`` gives with those siblings, or the leaf itself where
    ``check`` is null), verified (whether that is the root)[, path: what stands before and after
    the leaf and its ancestors, level by level]. ``fold`` recomputes a root from a path.
    """
    ship_code(leaves.sparkSession)
    size = fanout**local
    check = F.col("check") if "check" in leaves.columns else F.lit(None).cast("string")
    rows = leaves.select("id", "tree", "leaf", check.alias("check"))
    rows = running_total(rows, ["tree"], ["id", "leaf"], {"pos": F.lit(1)}, name="leaves")
    trees = stage(rows.groupBy(F.col("tree").alias("t")).agg(F.count("*").alias("n")), "trees")
    rows = rows.withColumn("block", F.floor(F.col("pos") / size))
    packed = rows.groupBy("tree", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "id", "leaf", "check"))).alias("members"))  # at most ``size``
    packed = packed.join(bounded_broadcast(trees), F.col("tree").eqNullSafe(F.col("t"))).select("tree", "block", "n", "members")
    packed = stage(packed, "partitions")

    upper = butterfly(stage(_subtree_roots(packed, local, fanout), "subtrees"), fanout)
    upper = upper.select(F.col("tree").isNotNull().alias("named"), F.coalesce("tree", F.lit("")).alias("tree"), "block", "blocks", "digest", "path")
    upper = stage(upper, "upper")
    tops = upper.where("block = 0").select("named", "tree", "digest", "blocks")
    ranked = stage(running_total(tops, [], ["named", "tree"], {"rank": F.lit(1)}, name="ranks"), "ranked")
    count = ranked.count()
    tree_of_trees = ranked.select(F.lit(None).cast("string").alias("tree"), F.col("rank").alias("block"), F.lit(count).cast("long").alias("blocks"), "digest")
    above = butterfly(tree_of_trees, fanout).select("block", F.col("digest").alias("root"), F.col("path").alias("above"))
    above = ranked.select("named", "tree", "blocks", F.col("rank").alias("block")).join(above, "block").drop("block")
    proofs = lookup(upper.drop("blocks"), stage(above, "above"), ["named", "tree"], "blocks")
    proofs = proofs.select(
        F.when(F.col("named"), F.col("tree")).alias("t"), F.col("block").alias("b"), F.col("digest").alias("subroot"), "root", F.concat("path", "above").alias("path")
    )
    proofs = stage(proofs, "proofs")
    held = packed.join(_small(proofs), F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, n, subroot, root, path, members in zip(*(b.column(i).to_pylist() for i in range(5)), b.column(5), strict=True):
                members = members.values
                nodes = [x.encode() for x in members.field("leaf").to_pylist()]
                inner = _runs(nodes, _local_levels(n, local, fanout), fanout)
                on_top = [(s["before"].encode(), s["after"].encode()) for s in path]
                top, upper = b"".join(x + y for x, y in on_top), root.encode()
                steps = [[_beside(level, i, fanout) for i in range(len(level))] for level in inner[1:-1]]
                proof, folded, paths = [], [], []
                for i, (leaf, check) in enumerate(zip(nodes, members.field("check").to_pylist(), strict=True)):
                    way = [_beside(nodes, i, fanout)] if len(inner) > 1 else []
                    at = i
                    for level in steps:
                        at //= fanout
                        way.append(level[at])
                    proof.append(_hash(b"".join(x + y for x, y in way) + top).decode())
                    x = leaf if check is None else check.encode()
                    for before, after in way:
                        x = _hash(before + x + after)
                    for before, after in on_top:
                        x = _hash(before + x + after)
                    folded.append(x)
                    if with_path:
                        paths.append([{"before": x.decode(), "after": y.decode()} for x, y in way + on_top])
                m = len(nodes)
                columns = [
                    members.field("id"), pa.array([tree] * m, pa.string()), members.field("pos"), members.field("leaf"), pa.array([subroot] * m), pa.array([root] * m),
                    pa.array(proof), pa.array([x.decode() for x in folded]), pa.array([x == upper for x in folded]),
                ]
                names = ["id", "tree", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                if with_path:
                    columns.append(pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))))
                    names.append("path")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = held.select("tree", "n", "subroot", "root", "path", "members").mapInArrow(run, _OUT + f", path array<{_STEP}>" * with_path)
    return out


def _small(proofs: DataFrame) -> DataFrame:
    """A row of ``proofs`` holds some kilobytes: broadcast fewer of them."""
    return bounded_broadcast(proofs, BROADCAST_ROWS // 500)


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that ``leaf`` gives with what stands beside it and its ancestors."""
    x = leaf.encode()
    for before, after in path:
        x = _hash(before.encode() + x + after.encode())
    return x.decode()


def document_leaves(documents: DataFrame) -> DataFrame:
    """Leaves of ``documents`` by source. ``check``: where 5 divides the CRC-32 of the decimal
    doc_id, the leaf of the row with A-Z in its text lower-cased."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.translate(F.col("text"), _UPPER, _LOWER)
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return documents.select(
        F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("tree"), leaf_of(*fields).alias("leaf"),
        F.when(picked, leaf_of(*fields[:-1], tampered)).alias("check"),
    )


def op12_butterfly(spark, sf_dir):
    found = manifest(document_leaves(table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP12_SQL = r"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
digits AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents),
crcs(doc_id, s, k, c) AS (
  SELECT doc_id, s, 0, CAST(4294967295 AS BIGINT) FROM digits
  UNION ALL SELECT doc_id, s, k + 1, xor((SELECT t FROM crc_table)[xor(c % 256, ascii(s[k + 1])) + 1], c // 256) FROM crcs WHERE k < length(s)),
picked AS (SELECT doc_id FROM crcs WHERE k = length(s) AND xor(c, 4294967295) % 5 = 0),
f AS (
  SELECT doc_id, source, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN doc_id IN (SELECT doc_id FROM picked) THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS checked,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM f),
up(source, lvl, nodes) AS (
  SELECT source, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY source
  UNION ALL
  SELECT source, lvl + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1 : i + 16], ''))) FROM up WHERE len(nodes) > 1),
subroots AS (SELECT source, lvl AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank FROM up WHERE len(nodes) = 1),
top(lvl, nodes) AS (
  SELECT 0, list(subroot ORDER BY rank) FROM subroots
  UNION ALL
  SELECT lvl + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1 : i + 16], ''))) FROM top WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1),
every AS (
  SELECT source, lvl, nodes, FALSE AS above FROM up WHERE len(nodes) > 1
  UNION ALL SELECT s.source, s.height + t.lvl, t.nodes, TRUE FROM top t, subroots s WHERE len(t.nodes) > 1),
way AS (
  SELECT l.doc_id, e.lvl, e.nodes, CASE WHEN above THEN s.rank // CAST(16 ** (e.lvl - s.height) AS BIGINT) ELSE l.pos // CAST(16 ** e.lvl AS BIGINT) END AS i
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN every e ON l.source IS NOT DISTINCT FROM e.source),
beside AS (
  SELECT doc_id, lvl, array_to_string(nodes[i - i % 16 + 1 : i], '') AS before, array_to_string(nodes[i + 2 : i - i % 16 + 16], '') AS after FROM way),
steps AS (SELECT doc_id, list(before ORDER BY lvl) AS b, list(after ORDER BY lvl) AS a FROM beside GROUP BY 1),
folds(doc_id, k, x) AS (
  SELECT doc_id, 0, coalesce(checked, leaf) FROM leaves
  UNION ALL SELECT f.doc_id, k + 1, sha256(b[k + 1] || x || a[k + 1]) FROM folds f JOIN steps USING (doc_id) WHERE k < len(b)),
folded AS (SELECT doc_id, arg_max(x, k) AS folded_root FROM folds GROUP BY 1)
SELECT l.doc_id, l.leaf, s.subroot, r.root,
       sha256(coalesce(array_to_string(list_transform(range(len(b)), lambda k: b[k + 1] || a[k + 1]), ''), '')) AS proof_sha256, folded_root, folded_root = r.root AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN root r ON TRUE JOIN folded USING (doc_id) LEFT JOIN steps USING (doc_id)
"""
