"""Chat formatting: logged cumulative snapshots collapse to maximal conversations, then render.

A service that logs a conversation after every turn leaves snapshots that prefix each other. Each
turn gets a 128-bit hash keyed by its place; the running sums of these over a conversation are its
prefix hashes. A conversation whose (length, hash) also is a proper prefix of another one is dropped
by an anti-join; of conversations with equal turns the smallest id stays. What remains is rendered.

Turns are ordered by turn number, then content hash. Places and prefix hashes are distributed
running totals over narrow rows, prefixes are compared as (length, hash) keys that are aggregated
before they are joined, and a rendered conversation is given out in parts of ``PART`` turns, so
neither one long conversation nor a first turn shared by most of them meets in one task.

Defined results: repeated rows (same conversation, turn number, role and text) count once; rows of
equal turn number with other content are turns of their own; a null conv_id is a conversation of its
own; null turn numbers come first; a null role reads "unknown", a null text is empty but differs
from an empty one when turns are compared; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import running_total, stage, table

PART = 256
_H = ["h0", "h1", "h2", "h3"]


def _content_hash() -> Column:
    one = lambda c: F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0"))
    return F.md5(F.concat_ws("\x1f", one("role"), one("text")))


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, th, k, h0 .. h3): each turn with its place (from 1) and prefix hash."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _content_hash().alias("th")).distinct()
    placed = running_total(turns, ["conv_id"], ["turn", "th"], {"pos": F.lit(1)}, name="turns")
    own = F.md5(F.concat_ws("|", F.col("pos").cast("string"), "th"))
    for i, h in enumerate(_H):
        placed = placed.withColumn(f"own_{h}", F.conv(F.substring(own, 8 * i + 1, 8), 16, 10).cast("long"))
    sums = running_total(placed, ["conv_id"], ["pos"], {h: F.col(f"own_{h}") for h in _H}, name="prefixes")
    return sums.select("conv_id", "turn", "th", (F.col("pos") + 1).alias("k"), *[(F.col(h) + F.col(f"own_{h}")).alias(h) for h in _H])


def maximal(prefix: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that no other one extends, one of each group of
    equals."""
    last = prefix.groupBy("conv_id").agg(F.max(F.struct("k", *_H)).alias("z")).select("conv_id", "z.*")
    full = stage(last.groupBy("k", *_H).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")), "full")
    seen = prefix.groupBy("k", *_H).agg(F.count("*").alias("n"))
    # a key with more prefixes than conversations that end there is a proper prefix
    proper = seen.join(full.select("k", *_H, "copies"), ["k", *_H], "left").where(F.col("n") > F.coalesce("copies", F.lit(0)))
    kept = full.join(stage(proper.select("k", *_H), "proper"), ["k", *_H], "left_anti")
    return kept.select("conv_id", F.col("k").alias("n_turns"), "copies")


def render(conversations: DataFrame, *, part: int = PART) -> DataFrame:
    """(conv_id, part, n_turns, copies, text): the maximal conversations as training text; ``part``
    turns a row, in order of the part number."""
    prefix = stage(prefixes(conversations), "prefixes-out")
    kept = stage(maximal(prefix), "maximal")
    places = prefix.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("th").alias("h"), (F.col("k") - 1).alias("pos"))
    places = stage(
        places.join(kept, F.col("c").eqNullSafe(F.col("conv_id"))).select("c", "t", "h", "pos", "n_turns", "copies"), "places"
    )
    texts = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", _content_hash().alias("th"))
    texts = texts.dropDuplicates(["conv_id", "turn", "th"])
    rows = texts.join(places, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("th") == F.col("h")))
    body = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("<\\|"))  # no control marks from the text
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), body, F.lit("<|end|>\n"))
    rows = rows.select("conv_id", F.floor(F.col("pos") / part).cast("int").alias("part"), "n_turns", "copies", "pos", line.alias("line"))
    return rows.groupBy("conv_id", "part", "n_turns", "copies").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"])).alias("text")
    )


def op3_snapshots(spark, sf_dir):
    return render(table(spark, sf_dir, "conversations"))


OP3_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text,
         md5(coalesce('1' || role, '0') || chr(31) || coalesce('1' || text, '0')) AS th FROM conversations),
c AS (SELECT conv_id, list(th ORDER BY turn NULLS FIRST, th) AS l FROM t GROUP BY 1),
full_ AS (SELECT l, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY 1),
proper AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(generate_series(1, len(l) - 1)) AS k FROM c)),
kept AS (SELECT * FROM full_ ANTI JOIN proper USING (l)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, th) - 1 AS pos FROM t)
SELECT p.conv_id, CAST(pos // 256 AS INTEGER) AS part, CAST(len(any_value(l)) AS BIGINT) AS n_turns, CAST(any_value(copies) AS BIGINT) AS copies,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '<\|') || '<|end|>' || chr(10), '' ORDER BY pos) AS text
FROM p JOIN kept ON p.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY p.conv_id, pos // 256
"""
