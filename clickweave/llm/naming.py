"""Exact duplicates by deterministic block naming.

Texts are normalised (white space deleted) and cut into blocks of ``BLOCK`` bytes. The distinct
blocks are sorted and numbered: a block's number is its name. Then adjacent names are paired, the
distinct pairs are sorted and numbered again, and so on, each round halving a document's names,
until each document has one. At every level equal names mean equal contents (numbers are given to
contents, never to hashes), so a document's last name with its level is a collision-free identity:
two texts are equal exactly if they have the same one.

Blocks are shuffled once, to find the distinct ones; equal blocks collapse before the shuffle. The
documents learn their blocks' names over a 128-bit key of each block, after it has been checked that
no two of the distinct blocks share a key (else the keys are drawn anew with another seed), so that
the texts need not travel a second time. Names and pairs that a large part of all rows hold are
joined where those rows lie (``common.lookup``).

Defined results: a null text counts as empty, empty texts are equal to each other; of equal texts the
one with the most code points stays, then the smallest doc_id (null last), then one of the repeated
rows; an empty table gives no rows; extra columns are not read, whatever their names. A text takes
one round more each time its length doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import lookup, release, stage, table, without

#: Bytes of a block.
BLOCK = 2048
_SPACES = " \t\n\x0b\f\r"


def normalised(text: Column) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _SPACES, "")


def _block_key(block: Column, seed: int) -> tuple[Column, Column]:
    """128 bits of a block, as two numbers."""
    return F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)


def _each_block(raw: Column, size: int, made) -> Column:
    """``made`` of every block of the bytes ``raw``; no bytes are one empty block."""
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(raw) / size).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda i: made(F.substring(raw, i * size + 1, F.lit(size))))


def _once(value: Column, made) -> Column:
    """``made(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), made)[0]


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The distinct ``keys`` in sorted order with a number of their own, ``name``, and the number
    of rows that hold them, ``n``. Every partition has a range of numbers to itself."""
    distinct = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return distinct.sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id())


def _block_names(text: DataFrame, size: int, tries: int = 8) -> tuple[DataFrame, int]:
    """((k1, k2, n, name) of the distinct blocks, seed): the keys have been found to tell the
    blocks apart."""
    raw = normalised(F.col("text")).cast("binary")
    blocks = text.select(F.explode(_once(raw, lambda t: _each_block(t, size, lambda b: b))).alias("block"))
    for seed in range(tries):
        k1, k2 = _block_key(F.col("block"), seed)
        names = stage(numbered(blocks, ["block"], "name").select(k1.alias("k1"), k2.alias("k2"), "n", "name"), "block-names")
        if names.groupBy("k1", "k2").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
            return names, seed
        release(names)
    raise RuntimeError("no seed tells the blocks apart")


def identities(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(row, doc_id, n_chars, text_sha256, level, name) per row of ``documents``: equal (level, name)
    means equal normalised texts. ``row`` numbers the rows arbitrarily."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names, seed = _block_names(docs, block)
    made = _once(
        normalised(F.col("text")).cast("binary"),
        lambda t: F.struct(
            F.sha2(t, 256).alias("sha"),
            _each_block(t, block, lambda b: F.struct(*(k.alias(c) for k, c in zip(_block_key(b, seed), ("k1", "k2"), strict=True)))).alias("keys"),
        ),
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), made.alias("m")
    )
    rows = stage(rows.select("row", "doc_id", "n_chars", F.col("m.sha").alias("text_sha256"), F.col("m.keys").alias("keys")), "rows")

    held = rows.select("row", F.size("keys").alias("count"), F.posexplode("keys").alias("pos", "k"))
    held = held.select("row", "count", "pos", F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2"))
    at = stage(lookup(held, names, ["k1", "k2"], "n").select("row", "count", "pos", "name"), "names")
    release(names)
    level, done = 0, [at.where("count = 1").select("row", F.lit(0).alias("level"), "name")]
    while not (open_ := at.where("count > 1")).isEmpty():  # one round more each time the longest text doubles
        level += 1
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = open_.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.first("count").alias("count"), side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b")
        )
        pairs = stage(pairs.withColumn("count", F.ceil(F.col("count") / 2).cast("int")), "pairs")
        names = stage(numbered(pairs, ["a", "b"], "name"), "pair-names")
        at = stage(lookup(pairs, names, ["a", "b"], "n").select("row", "count", "pos", "name"), "names")
        release(pairs, names)
        done.append(at.where("count = 1").select("row", F.lit(level).alias("level"), "name"))
    last = done[0]
    for more in done[1:]:
        last = last.unionByName(more)
    return rows.drop("keys").join(last, "row")


def exact_duplicates(documents: DataFrame, **parameters) -> DataFrame:
    """``identities`` with the group of each row: keep_id (doc_id of the row that stays),
    group_size, kept (whether this row stays)."""
    named = stage(identities(documents, **parameters), "identities")
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("null"), "doc_id", "row")
    groups = named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("first"))
    groups = groups.select("level", "name", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep"))
    groups = stage(groups.withColumn("n", F.col("group_size")), "groups")
    out = lookup(named, groups, ["level", "name"], "n")
    return out.withColumn("kept", F.col("row") == F.col("keep")).drop("keep")


def deduplicated(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows and columns of ``documents`` less all but one of each group of equal texts."""
    found = exact_duplicates(documents, doc_id=doc_id, text=text, block=block)
    key = ["doc_id", "n_chars", "text_sha256"]
    found = stage(found.groupBy(*key).agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "decided")
    values = F.col(doc_id).cast("long"), F.coalesce(F.length(text), F.lit(0)).cast("long"), F.sha2(normalised(F.col(text)).cast("binary"), 256)
    # rows that are alike in all that decides: one of them stays
    return without(documents, dict(zip(key, values, strict=True)), found.where("NOT kept"), found.where("kept AND n > 1"))


def op11_naming(spark, sf_dir):
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents),
g AS (
  SELECT t, count(*) AS group_size, first(doc_id ORDER BY n DESC, doc_id) AS keep_id FROM d GROUP BY t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
