"""Benchmark decontamination: prefix-filtered set join of item windows against whole documents.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window). It is
seen as the set of its shingles (``SHINGLE`` consecutive words, fewer in shorter items). A document
contains a window only if it contains every shingle of it, so one shingle is a sufficient prefix:
the rarest, by counts over all documents. Steps, all DataFrame operations:

1. matches: every document position whose shingle occurs in some window (equi-join on the shingle);
2. rarity: shingles ordered by their number of matches; each window keeps its rarest as prefix;
3. candidates: matches of prefixes give (document, start); the start must leave room for the
   window on both sides (position and length bounds);
4. verification: the shingles that cover the window must match at their exact places.

A shingle that occurs nowhere makes its windows drop out at step 3. Texts are read twice (matches,
word counts); only matches are shuffled.

Defined results: null or empty texts have no words and no hits; an item without words has no
window; items with a null id count for hits but not in the list of items; repeated documents each
get their row; other columns of the inputs, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import bounded_broadcast, stage, table

WINDOW = 13
SHINGLE = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; texts without other letters take the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAP), "")


def _windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, wid, ww): the windows of all items."""
    got = items.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("w")).where("size(w) > 0")
    got = got.select(
        "item_id",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))),
                lambda i: F.slice("w", i + 1, F.least(F.size("w"), F.lit(window))),
            )
        ).alias("ww"),
    )
    return got.select("item_id", F.unhex(F.md5(F.concat_ws(" ", "ww"))).alias("wid"), "ww").distinct()


def _covers(windows: DataFrame) -> DataFrame:
    """(wid, len, s, j, sh, cover): the shingles of each distinct window; ``cover`` marks a choice
    of shingles that holds each of its words."""
    one = windows.select("wid", "ww").distinct().withColumn("s", F.least(F.size("ww"), F.lit(SHINGLE)))
    one = one.select(
        "wid",
        F.size("ww").alias("len"),
        "s",
        F.posexplode(
            F.transform(F.sequence(F.lit(0), F.size("ww") - F.col("s")), lambda j: F.concat_ws(" ", F.slice("ww", j + 1, F.col("s"))))
        ).alias("j", "sh"),
    )
    return one.withColumn("cover", (F.col("j") % F.col("s") == 0) | (F.col("j") == F.col("len") - F.col("s")))


def _matches(docs: DataFrame, tokens: DataFrame, s: int) -> DataFrame:
    """(doc, th, n_words, s, pos, sh): document positions whose ``s`` words are a wanted shingle."""
    zipped = F.arrays_zip(
        F.sequence(F.lit(0), F.size("w") - s), *[F.slice("w", i + 1, F.size("w") - (s - 1)) for i in range(s)]
    )
    cols = [f"w{i}" for i in range(s)]
    grams = (
        docs.where(F.size("w") >= s)
        .select("doc", "th", F.size("w").alias("n_words"), F.inline(zipped).alias("pos", *cols))
        .withColumn("h", F.xxhash64(*cols))
    )
    parts = F.split("sh", " ")
    wanted = tokens.where(F.col("s") == s).select(F.xxhash64(*[parts[i] for i in range(s)]).alias("th_h"), "sh")
    hit = grams.join(bounded_broadcast(wanted), (F.col("h") == F.col("th_h")) & (F.concat_ws(" ", *cols) == F.col("sh")))
    return hit.select("doc", "th", "n_words", F.lit(s).alias("s"), "pos", "sh")


def occurrences(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> tuple[DataFrame, DataFrame]:
    """(found, windows): ``found`` has a row (doc, th, start, len, wid) for each place where a
    window occurs, ``windows`` the (item_id, wid) behind it. ``th`` is a hash of the text, so that
    different texts under one id stay apart."""
    windows = stage(_windows(items, item_id, item_text, window), "windows")
    covers = stage(_covers(windows), "covers")
    tokens = stage(covers.select("s", "sh").distinct(), "tokens")
    docs = documents.select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("th"), words(F.col(text)).alias("w")
    )
    sizes = sorted(r["s"] for r in tokens.select("s").distinct().collect())  # at most SHINGLE numbers
    found = None
    for s in sizes or [SHINGLE]:
        part = _matches(docs, tokens, s)
        found = part if found is None else found.unionByName(part)
    matches = stage(found.distinct(), "matches")

    seen = matches.groupBy("s", "sh").agg(F.count("*").alias("n"))
    prefix = (
        covers.join(seen, ["s", "sh"])
        .groupBy("wid", "len", "s")
        .agg(F.count("*").alias("have"), F.min(F.struct("n", "sh", "j")).alias("p"))
        .where(F.col("have") == F.col("len") - F.col("s") + 1)
        .select("wid", "len", "s", F.col("p.sh").alias("sh"), F.col("p.j").alias("j"))
    )
    prefix = stage(prefix, "prefix")
    start = F.col("pos") - F.col("j")
    candidates = (
        matches.join(bounded_broadcast(prefix), ["s", "sh"])
        .where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
        .select("doc", "th", start.alias("start"), "wid", "len", "s")
    )
    need = bounded_broadcast(stage(covers.where("cover").select("wid", "j", "sh"), "cover"))
    places = candidates.join(need, "wid").select(
        F.col("doc").alias("d"), F.col("th").alias("t"), "start", "wid", "len", F.col("s").alias("k"),
        (F.col("start") + F.col("j")).alias("p"), F.col("sh").alias("want"),
    )
    at = (
        F.col("d").eqNullSafe(F.col("doc")) & (F.col("t") == F.col("th")) & (F.col("p") == F.col("pos"))
        & (F.col("k") == F.col("s")) & (F.col("want") == F.col("sh"))
    )
    verified = (
        places.join(matches, at)
        .groupBy(F.col("d").alias("doc"), F.col("t").alias("th"), "start", "wid", "len", F.col("k"))
        .agg(F.count("*").alias("got"))
        .where(F.col("got") == F.ceil(F.col("len") / F.col("k")))
        .select("doc", "th", "start", "len", "wid")
    )
    return stage(verified, "found"), windows.select("item_id", "wid")


def _per_text(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, th, n_hit, n_items, items_sha256) of each text with an occurrence."""
    w = Window.partitionBy("doc", "th").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("doc", "th", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(w), F.lit(0)))
    hits = (
        spans.withColumn("new", F.greatest(fresh, F.lit(0)))
        .groupBy("doc", "th")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    ids = (
        found.select("doc", "th", "wid").distinct()
        .join(windows.where("item_id IS NOT NULL"), "wid")
        .groupBy("doc", "th")
        .agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
        .select(F.col("doc").alias("d"), F.col("th").alias("t"), "ids")
    )
    return hits.join(ids, F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left").select(
        "doc", "th", "n_hit", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"),
    )


def contamination(documents: DataFrame, items: DataFrame, **names) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated if a window occurs in it and at least a twentieth of its words lie
    inside occurrences."""
    found, windows = occurrences(documents, items, **names)
    per = stage(_per_text(found, windows), "hits")
    text = F.col(names.get("text", "text"))
    docs = documents.select(
        F.col(names.get("doc_id", "doc_id")).alias("doc_id"), F.xxhash64(text).alias("_th"), F.size(words(text)).cast("long").alias("n_words")
    )
    out = docs.join(per, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_th") == F.col("th")), "left")
    out = out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminated(documents: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The rows and columns of ``documents`` whose text is not contaminated."""
    found, windows = occurrences(documents, items, **names)
    per = stage(_per_text(found, windows).select("doc", "th", "n_hit"), "hits")
    text, doc_id = names.get("text", "text"), names.get("doc_id", "doc_id")
    d = documents.alias("d")
    on = F.col(f"d.{doc_id}").eqNullSafe(F.col("x.doc")) & (F.xxhash64(F.col(f"d.{text}")) == F.col("x.th"))
    bad = 20 * F.col("x.n_hit") >= F.size(words(F.col(f"d.{text}")))
    return d.join(bounded_broadcast(per).alias("x"), on & bad, "left_anti")


def op10_decontaminate(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n)),
occ AS (SELECT DISTINCT doc_id, i, n, item_id FROM grams JOIN win USING (n, t)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
