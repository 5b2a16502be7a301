"""Mixing sources to target weights: multivariate-hypergeometric splitting tree.

Targets: sources (by code point, null last) weigh 3, 1, 2, repeating; they share ``SHARE`` of all
words, none more than ``REPEAT`` times what it has (the excess is reshared by weight, which is the
water level of ``_targets``).

Drawing: a source's documents form a sequence of ``REPEAT`` permuted passes. The sequence is cut
into blocks of about ``block`` words; its first blocks, up to the target, are its quota. All quota
blocks are dealt to the output shards by a tree: at each node exactly as many blocks as the left
half of its shards needs are drawn without replacement (lowest fresh hashes), the rest goes right,
so a child's vector of block counts by source is multivariate hypergeometric and all sums are
exact. A shard's quotas then claim disjoint runs of the permuted blocks of each source, and its rows
are shuffled by hash. Everything is a function of the rows and the seed, so reruns agree.

Permutations and running sums over a source go through ``running_total``: a source that holds most
rows is spread over all tasks.

Defined results: null or empty texts have size 0 and are never taken; a source without words has
target 0; the null source is a source of its own; repeated rows are separate rows (which of equal
rows is taken is arbitrary); extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.llm.common import bounded_broadcast, hash_order, running_total, stage, table

WEIGHTS, SHARE, REPEAT = (3, 1, 2), 1.5, 2
SHARDS, SEED = 8, "mix"
_WORD = r"[^\x20\x09-\x0D]+"


def sizes(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, th, size): number of words of each text; th tells texts of one id apart."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.md5(text).alias("th"), size.alias("size")
    )


def targets(sized: DataFrame, *, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """(source, source_size, target): one row per source.

    A source is full if ``repeat * size / weight`` lies at or below the water level, the words left
    over per weight of those above it; the level follows from running sums in order of that ratio.
    """
    per = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running_total(per.withColumn("last", F.col("source").isNull()), [], ["last", "source"], {"rank": F.lit(1)}, name="weights")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", pick).withColumn("cap", repeat * F.col("source_size"))
    ratio = F.col("cap") / F.col("weight")
    # sums over the sources with smaller ratios (ties in any fixed order give the same level)
    below = running_total(
        ranked.withColumn("ratio", ratio), [], ["ratio", "rank"], {"cap_below": F.col("cap"), "weight_below": F.col("weight")}, name="levels"
    )
    below = stage(below, "levels-out")
    words, all_weight = below.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (share * F.lit(words or 0) - F.col("cap_below")) / (F.lit(all_weight or 0) - F.col("weight_below"))
    # the first source, by ratio, whose ratio exceeds the level at its place sets the level for all
    above = below.withColumn("level", level).where("ratio > level")
    water = above.agg(F.min(F.struct("ratio", "rank", "level"))).first()[0]  # one number, or none if all are full
    target = F.least(F.col("cap"), F.lit(water["level"]) * F.col("weight")) if water else F.col("cap")
    return below.select("source", "source_size", target.cast("double").alias("target"))


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def draw(sized: DataFrame, *, repeat: int = REPEAT, seed: str = SEED, **weights) -> DataFrame:
    """One row per copy taken: the columns of ``sized``, source_size, target, pass, begin (words of
    the source's sequence before it). A copy is taken if its middle lies before the target, so
    each source misses its target by at most half a document."""
    goal = stage(targets(sized, repeat=repeat, **weights), "targets").toDF("src", "source_size", "target")
    copies = sized.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
    copies = copies.withColumn("key", hash_order(seed, "pass", "doc_id", "th"))
    run = running_total(copies, ["source"], ["pass", "key"], {"begin": F.col("size")}, name="permuted")
    taken = run.join(bounded_broadcast(goal), _same("source", "src")).where(F.col("begin") + F.col("size") / 2 <= F.col("target"))
    return taken.drop("src", "key")


def quotas(blocks: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(source, shard, quota, first): the splitting tree. ``blocks``: (source, blocks), the number
    of quota blocks. ``first``: blocks of the source claimed by the shards before."""
    every = blocks.where("blocks > 0").select("source", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    every = every.withColumns({"lo": F.lit(0), "hi": F.lit(shards)})
    level = 0
    while (1 << level) < shards:  # as many levels as the tree is deep
        level += 1
        every = every.withColumn("key", hash_order(f"{seed}-{level}", "source", "block"))
        nodes = every.groupBy("lo", "hi").agg(F.count("*").alias("n"))
        ranked = running_total(every, ["lo", "hi"], ["key", "source", "block"], {"rank": F.lit(1)}, name="tree")
        nodes = F.broadcast(stage(nodes, "nodes").toDF("l", "h", "n"))  # at most one row per shard
        mid = F.floor((F.col("lo") + F.col("hi") + 1) / 2).cast("int")
        need = F.floor(F.col("n") * (mid - F.col("lo")) / (F.col("hi") - F.col("lo")))
        left = F.col("rank") < need
        every = ranked.join(nodes, (F.col("lo") == F.col("l")) & (F.col("hi") == F.col("h"))).select(
            "source", "block", F.when(left, F.col("lo")).otherwise(F.when(F.col("hi") - F.col("lo") > 1, mid).otherwise(F.col("lo"))).alias("lo2"),
            F.when(left & (F.col("hi") - F.col("lo") > 1), mid).otherwise(F.col("hi")).alias("hi2"),
        )
        every = every.select("source", "block", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"))
    count = every.groupBy("source", F.col("lo").alias("shard")).agg(F.count("*").alias("quota"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return count.withColumn("first", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def mixed(sized: DataFrame, *, shards: int = SHARDS, block: int | None = None, seed: str = SEED, **weights) -> DataFrame:
    """``draw`` with shard and key (its place in the shard's order): the mix itself. ``block``: words in a block; by default the
    words taken over 64 blocks a shard."""
    taken = stage(draw(sized, seed=seed, **weights), "taken")
    if block is None:
        words = taken.agg(F.sum("size")).first()[0] or 0
        block = max(1, int(words) // (64 * shards))
    blocked = taken.withColumn("block", F.floor(F.col("begin") / block))
    have = blocked.groupBy("source").agg((F.max("block") + 1).alias("blocks"))
    plan = stage(quotas(have, shards, seed), "quotas")
    claimed = plan.select(
        F.col("source").alias("src"), "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("blk")
    )
    out = blocked.join(bounded_broadcast(stage(claimed, "claims")), _same("source", "src") & (F.col("block") == F.col("blk")))
    out = out.withColumn("key", hash_order(f"{seed}-place", "pass", "doc_id", "th"))
    return out.drop("src", "blk")


_KEY = ["doc_id", "th", "source"]


def _on(left: str, right: str):
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in _KEY]


def _repeated(sized: DataFrame) -> DataFrame:
    """Keys of rows that occur more than once."""
    return stage(sized.groupBy(*_KEY).agg(F.count("*").alias("n")).where("n > 1").select(*_KEY), "repeated")


def mixed_documents(documents: DataFrame, **parameters) -> DataFrame:
    """The rows of ``documents`` that the mix takes, a row for each copy, same columns. Rows with
    equal id, text and source are given out as copies of one of them."""
    cols = documents.columns
    sized = stage(sizes(documents), "sizes")
    mix = stage(mixed(sized, **parameters).select(*_KEY), "mix")
    docs = documents.select(
        F.struct(*[F.col(c) for c in cols]).alias("row"), F.col("doc_id"), F.md5("text").alias("th"), F.col("source").cast("string").alias("source")
    )
    again = _repeated(sized)
    if not again.isEmpty():
        twice = docs.alias("d").join(again.alias("x"), _on("d", "x"), "left_semi").dropDuplicates(_KEY)
        docs = docs.alias("d").join(again.alias("x"), _on("d", "x"), "left_anti").unionByName(twice)
    return mix.alias("m").join(docs.alias("d"), _on("m", "d")).select("d.row.*")


def _numbered(sized: DataFrame) -> DataFrame:
    """``sized`` with ``twin``, which numbers equal rows from 0."""
    again = _repeated(sized)
    if again.isEmpty():
        return sized.withColumn("twin", F.lit(0).cast("long"))
    marked = stage(sized.withColumn("at", F.monotonically_increasing_id()), "marked")
    twice = marked.alias("d").join(again.alias("x"), _on("d", "x"), "left_semi")
    twice = running_total(twice, _KEY, ["at"], {"twin": F.lit(1)}, name="twins")
    once = marked.alias("d").join(again.alias("x"), _on("d", "x"), "left_anti").withColumn("twin", F.lit(0).cast("long"))
    return stage(once.unionByName(twice).drop("at"), "numbered")


def write_mixed(documents: DataFrame, folder: str, **parameters) -> None:
    """Write the mix for training: ``folder/shard=<n>/`` holds the shard's rows (``row``: the columns of
    ``documents``, a row for each copy) in its shuffled order, the order of ``place``."""
    cols = [F.col(f"`{c}`") for c in documents.columns]
    sized = _numbered(stage(sizes(documents), "sizes"))
    taken = stage(mixed(sized, **parameters).select(*_KEY, "shard", F.col("key").alias("place")), "mix")
    docs = documents.select(F.struct(*cols).alias("row"), F.col("doc_id"), F.md5("text").alias("th"), F.col("source").cast("string").alias("source"))
    again = _repeated(sized)
    if not again.isEmpty():  # rows of equal key are given out as copies of one of them
        twice = docs.alias("d").join(again.alias("x"), _on("d", "x"), "left_semi").dropDuplicates(_KEY)
        docs = docs.alias("d").join(again.alias("x"), _on("d", "x"), "left_anti").unionByName(twice)
    rows = taken.alias("m").join(docs.alias("d"), _on("m", "d")).select("d.row", "m.place", "m.shard")
    rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").write.partitionBy("shard").parquet(folder)


def read_mixed(spark: SparkSession, folder: str, shard: int) -> DataFrame:
    """The rows of one shard in their order, with the columns of the documents."""
    return spark.read.parquet(folder).where(F.col("shard") == shard).orderBy("place").select("row.*")


def op6_mix(spark, sf_dir):
    """The contract's columns and ``shards``: the output shards that take the document's copies, first pass
    first, comma-joined (empty if none does)."""
    sized = _numbered(stage(sizes(table(spark, sf_dir, "documents")), "sizes"))
    goal = stage(targets(sized), "goals").toDF("src", "source_size", "target")
    dealt = F.transform(F.sort_array(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"].cast("string"))  # at most a copy a pass
    per = mixed(sized).groupBy(*_KEY, "twin").agg(F.sum("size").alias("taken"), F.array_join(dealt, ",").alias("shards"))
    out = sized.alias("d").join(stage(per, "per-document").alias("x"), [*_on("d", "x"), F.col("d.twin") == F.col("x.twin")], "left")
    out = out.select("d.doc_id", "d.size", "d.source", F.coalesce("x.taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("x.shards", F.lit("")).alias("shards"))
    return out.join(bounded_broadcast(goal), _same("source", "src")).select("doc_id", "size", "source_size", "target", "taken", "shards")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 2 * source_size AS cap, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3) + 1] AS weight FROM s),
levels AS (
  SELECT cap / weight AS ratio,
         (1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER below, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
  FROM w WINDOW below AS (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT min_by(level, ratio) AS water FROM levels WHERE ratio > level),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), CAST(coalesce((SELECT water FROM water) * weight, cap) AS DOUBLE)) AS target FROM w),
c AS (SELECT doc_id, source, size, p, md5('mix|' || p || '|' || doc_id || '|' || coalesce(md5(text), '')) AS k FROM d, (VALUES (0), (1)) v(p)),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY p, k ROWS UNBOUNDED PRECEDING) - size AS begin FROM c),
copies AS (
  SELECT r.doc_id, r.source, size, p, begin FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source WHERE size > 0 AND begin + size / 2 <= target),
cut AS (SELECT *, CAST(floor(begin / greatest(1, (SELECT sum(size) FROM copies) // 512)) AS BIGINT) AS block FROM copies),
n0 AS (SELECT source, unnest(range(max(block) + 1)) AS block, 0 AS lo, 8 AS hi FROM cut GROUP BY source),
k1 AS (
  SELECT *, (lo + hi + 1) // 2 AS mid, row_number() OVER (PARTITION BY lo, hi ORDER BY md5('mix-1|' || coalesce(source, '') || '|' || block)) - 1 AS rank,
         count(*) OVER (PARTITION BY lo, hi) AS n FROM n0),
n1 AS (
  SELECT source, block, CASE WHEN l THEN lo ELSE mid END AS lo, CASE WHEN l THEN mid ELSE hi END AS hi
  FROM (SELECT *, rank < n * (mid - lo) // (hi - lo) AS l FROM k1)),
k2 AS (
  SELECT *, (lo + hi + 1) // 2 AS mid, row_number() OVER (PARTITION BY lo, hi ORDER BY md5('mix-2|' || coalesce(source, '') || '|' || block)) - 1 AS rank,
         count(*) OVER (PARTITION BY lo, hi) AS n FROM n1),
n2 AS (
  SELECT source, block, CASE WHEN l THEN lo ELSE mid END AS lo, CASE WHEN l THEN mid ELSE hi END AS hi
  FROM (SELECT *, rank < n * (mid - lo) // (hi - lo) AS l FROM k2)),
k3 AS (
  SELECT *, (lo + hi + 1) // 2 AS mid, row_number() OVER (PARTITION BY lo, hi ORDER BY md5('mix-3|' || coalesce(source, '') || '|' || block)) - 1 AS rank,
         count(*) OVER (PARTITION BY lo, hi) AS n FROM n2),
n3 AS (
  SELECT source, block, CASE WHEN l THEN lo ELSE mid END AS lo, CASE WHEN l THEN mid ELSE hi END AS hi
  FROM (SELECT *, rank < n * (mid - lo) // (hi - lo) AS l FROM k3)),
quotas AS (SELECT source, lo AS shard, count(*) AS quota FROM n3 GROUP BY 1, 2),
runs AS (
  SELECT *, coalesce(sum(quota) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM quotas),
taken AS (
  SELECT c.doc_id, sum(c.size) AS taken, string_agg(CAST(q.shard AS VARCHAR), ',' ORDER BY p) AS shards
  FROM cut c JOIN runs q ON c.source IS NOT DISTINCT FROM q.source AND c.block >= q.first AND c.block < q.first + q.quota GROUP BY 1)
SELECT d.doc_id, d.size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, coalesce(shards, '') AS shards
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN taken USING (doc_id)
"""
