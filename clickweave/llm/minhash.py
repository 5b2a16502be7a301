"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of word shingles; two are linked if their Jaccard similarity reaches the
threshold. Steps:

1. signatures: ``BANDS * ROWS`` minima of multiply-shift hashes per distinct set (documents with
   equal sets collapse before anything is paired);
2. banding: sets that agree on all ``ROWS`` values of a band share a bucket. At similarity 0.8 a
   pair misses all 32 bands of 4 with probability (1 - 0.8^4)^32 = 5e-8;
3. first pass: each bucket pairs its members with its smallest member (linear in the bucket);
4. sequential verification: signatures are compared ``BATCH`` values at a time; a pair is pruned
   once the posterior probability (uniform prior) that its similarity reaches the threshold is
   below ``MISS``;
5. exact verification: survivors are confirmed on the shingle sets of the whole texts, compared word
   by word (not by hashes), in tasks that hold a centre and a chunk of its partners; components;
6. second pass: buckets whose members still lie in different components compare all members of
   different components. Members are dealt into hash blocks bounded in rows and bytes; a task sees
   two blocks of a bucket, never a whole one, and members of a bucket's commonest component do not meet each
   other. First the signatures alone tell which members have a likely partner there; only those bring their
   texts, are confirmed where they meet, and each task gives out no more links than join its components:
   a forest, however many pairs it has confirmed;
7. components over the confirmed links.

A pair that is already connected cannot change the result, so leaving it out loses nothing. Documents
whose sets have equal 128-bit fingerprints are one set from the start.

Defined results: null or empty texts have no shingles and link with nothing (their own component);
texts of fewer words than a shingle are one shingle; repeated rows are members of one group; a null
doc_id orders after all others (a group of null ids only has a null component and is kept); extra
columns are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as W
from clickweave.llm.common import bounded_broadcast, components, lookup, release, ship_code, stage, table, without

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
BATCH, MISS = 16, 1e-6
#: Members that meet in a task: two blocks of about so many at most, and of so many bytes of text.
BLOCK, BLOCK_BYTES = 1024, 8 << 20
_SETS = "fp binary, doc_id bigint, th bigint, n_bytes bigint, n_shingles bigint, sig binary, bands array<bigint>"
_ASCII_LOWER = bytes(W.LOWER)


def min_matches(threshold: float = THRESHOLD, batch: int = BATCH, total: int = BANDS * ROWS, miss: float = MISS) -> list[int]:
    """For n = batch, 2 batch, .. compared values: the fewest matches at which a pair goes on. With
    a uniform prior the similarity after m of n matches is Beta(m + 1, n - m + 1), whose upper tail
    at t is the binomial sum below."""
    out = []
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return W.mix(k * W.BASE) | np.uint64(1), W.mix(k * W.MIX1)


def signatures(shingles: np.ndarray, off: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """Minima of ``n`` hashes over each non-empty row of ``shingles`` (uint32, rows x n)."""
    mult, add = _hash_family(n)
    rows = len(off) - 1
    out = np.empty((rows, n), np.uint32)
    for i, j in W.groups(off * 8, 1 << 18):
        part, at = shingles[off[i] : off[j]], off[i:j] - off[i]
        tmp = np.empty_like(part)
        with np.errstate(over="ignore"):
            for k in range(n):
                np.multiply(part, mult[k], out=tmp)
                np.add(tmp, add[k], out=tmp)
                out[i:j, k] = np.minimum.reduceat(tmp, at) >> np.uint64(32)
    return out


def _distinct(s: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = [np.unique(s[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
    return (np.concatenate(rows) if rows else s[:0]), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def _fingerprints(s: np.ndarray, off: np.ndarray) -> list[bytes | None]:
    """16 bytes that name a set (its order-free sums under two scrambles); None for an empty one."""
    with np.errstate(over="ignore"):
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (W.mix(s + W.BASE), W.mix(s ^ W.MIX2))]
        both = np.stack([x[off[1:]] - x[off[:-1]] for x in sums], axis=1)
    raw = both.tobytes()
    return [raw[16 * i : 16 * i + 16] if off[i + 1] > off[i] else None for i in range(len(off) - 1)]


def _shingle_rows(col: pa.Array, size: int):
    raw, off = W.text_bytes(col)
    for i, j, hashes, woff in W.word_hashes(raw, off, W.SPACE):
        s, soff = W.shingle_hashes(hashes, woff, size)
        yield (i, j, *_distinct(s, soff))


def _list(values: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values.view(np.int64), kind))


def shingle_sets(documents: DataFrame, size: int) -> DataFrame:
    """(fp, doc_id, th, n_bytes, n_shingles, sig, bands) per document; th is a hash of the text."""

    def run(batches):
        mult = W.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for b in batches:
            for i, j, s, off in _shingle_rows(b.column(1), size):
                fps = _fingerprints(s, off)
                full = np.flatnonzero(np.diff(off) > 0)
                sig = signatures(s, np.concatenate([off[:-1][full], off[-1:]])) if len(full) else np.zeros((0, BANDS * ROWS), np.uint32)
                with np.errstate(over="ignore"):
                    bands = W.mix(sum(W.mix(sig[:, r::ROWS].astype(np.uint64) + np.uint64(r << 40)) for r in range(ROWS)) + mult)
                sigs, at = [None] * (j - i), np.zeros(j - i + 1, np.int64)
                for k, r in enumerate(full):
                    sigs[r] = sig[k].tobytes()
                    at[r + 1] = BANDS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps, pa.binary()), b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), b.column(3).slice(i, j - i),
                     pa.array(np.diff(off), pa.int64()), pa.array(sigs, pa.binary()), _list(bands.reshape(-1), np.cumsum(at), pa.int64())],
                    names=["fp", "doc_id", "th", "n_bytes", "n_shingles", "sig", "bands"],
                )

    size_of = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text"), size_of).mapInArrow(run, _SETS)


def _texts(documents: DataFrame, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, text): a whole text for each of the sets ``wanted`` (fp). Staged."""
    which = reps.join(wanted.distinct(), "fp", "left_semi").select(F.col("fp"), F.col("doc_id").alias("d"), F.col("th").alias("h"))
    which = bounded_broadcast(stage(which, "wanted"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.join(which, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("h")))
    return stage(docs.groupBy("fp").agg(F.first("text").alias("text")), "texts")


def exact_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, offsets per text) of the distinct shingles of each text. Equal numbers are equal runs of
    words: words are numbered by their bytes, runs by the numbers of their words."""
    known: dict[bytes, int] = {}
    words: list[int] = []
    count = []
    for t in texts:
        own = t.encode().translate(_ASCII_LOWER).split()  # at the bytes of [\x20\x09-\x0D]
        words += [known.setdefault(w, len(known) + 1) for w in own]
        if 0 < len(own) < size:  # a shorter text is one run, told by the zeros after it
            words += [0] * (size - len(own))
        count.append(max(len(own), size) if own else 0)
    word = np.array(words, np.int64)
    run = word
    for k in range(1, size):
        run = np.unique(run[:-1] * (len(known) + 1) + word[k:], return_inverse=True)[1] if len(run) > 1 else run[:0]
    count = np.array(count, np.int64)
    runs = np.maximum(0, count - size + 1)
    begin = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64) if len(count) else count
    own = run[W._ranges(begin, runs)]
    both = np.unique(np.repeat(np.arange(len(count)), runs) * (int(run.max(initial=0)) + 1) + own)
    row, name = np.divmod(both, int(run.max(initial=0)) + 1)
    return name, np.searchsorted(row, np.arange(len(count) + 1))


class _Verifier:
    """Tells which texts of a task are similar enough, on their full sets."""

    def __init__(self, texts: list[str], size: int, percent: int):
        self.names, self.off = exact_sets(texts, size)
        self.n, self.percent = np.diff(self.off), percent
        self.mark = np.zeros(int(self.names.max(initial=0)) + 1, bool)

    def similar(self, x: int, ys: np.ndarray) -> np.ndarray:
        """Those of ``ys`` that are linked with x."""
        own = self.names[self.off[x] : self.off[x + 1]]
        self.mark[own] = True
        held = np.concatenate([[0], np.cumsum(self.mark[self.names[W._ranges(self.off[ys], self.n[ys])]])])
        self.mark[own] = False
        at = np.concatenate([[0], np.cumsum(self.n[ys])])
        both = held[at[1:]] - held[at[:-1]]
        return ys[100 * both >= self.percent * (self.n[x] + self.n[ys] - both)]


def _passes(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs of signature rows go through all batches of the sequential test."""
    alive, got = np.arange(len(a)), np.zeros(len(a), np.int32)
    for k, m in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        got = got + (a[alive, at] == b[alive, at]).sum(axis=1)
        keep = got >= m
        alive, got = alive[keep], got[keep]
        if not len(alive):
            break
    ok = np.zeros(len(a), bool)
    ok[alive] = True
    return ok


def _sig_rows(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), BANDS * ROWS)


def _prune(stars: DataFrame, reps: DataFrame, least: list[int]) -> DataFrame:
    """The pairs (a, b) that the sequential test leaves. Staged."""
    centres = stars.groupBy("a").agg(F.count("*").alias("n")).join(reps.select(F.col("fp").alias("a"), F.col("sig").alias("sig_a")), "a")
    both = lookup(stars, stage(centres, "centres"), ["a"], "n").join(reps.select(F.col("fp").alias("b"), F.col("sig").alias("sig_b")), "b")

    def run(batches):
        for x in batches:
            if x.num_rows:
                ok = _passes(_sig_rows(x.column(2)), _sig_rows(x.column(3)), least)
                yield x.select([0, 1]).filter(pa.array(ok))

    return stage(both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary"), "pairs")


def _pair_table(pairs: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.binary()), "b": pa.array([b for _, b in pairs], pa.binary())})


def _confirmed_stars(documents: DataFrame, stars: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``stars`` whose full sets are similar enough. A task holds one centre a and
    a chunk of its partners. Staged."""
    sized = stage(stars.join(reps.select(F.col("fp").alias("b"), "n_bytes"), "b"), "star-sizes")
    per = sized.groupBy("a").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    per = stage(per.select("a", "n", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("chunks")), "star-chunks")
    ends = lookup(sized, per, ["a"], "n").select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), F.col("b").alias("fp"))
    centres = per.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("a").alias("fp"))
    ends = stage(ends.unionByName(centres), "star-ends")
    texts = _texts(documents, reps, ends.select("fp"))

    def run(t: pa.Table) -> pa.Table:
        fp, a = t.column("fp").to_pylist(), t.column("a")[0].as_py()
        centre = fp.index(a)
        others = np.array([i for i in range(len(fp)) if i != centre], np.int64)
        near = _Verifier(t.column("text").to_pylist(), size, percent).similar(centre, others)
        return _pair_table([(a, fp[y]) for y in near])

    links = stage(ends.join(texts, "fp").groupBy("a", "chunk").applyInArrow(run, "a binary, b binary"), "links")
    release(sized, per, ends, texts)
    return links


def _length_bound(na: str, nb: str, percent: int):
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def _meetings(members: DataFrame, reps: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, once for each task (key, i, strays, j)
    that they take part in. ``members``: key, band, fp, n_shingles, n_bytes, component.

    In each bucket the members of its commonest component (home) need not meet each other; the
    others (strays) meet the home members and each other, block against block."""
    per = members.groupBy("key", "component").agg(F.count("*").alias("c"), F.sum("n_bytes").alias("s"))
    sizes = per.groupBy("key").agg(F.sum("c").alias("n"), F.sum("s").alias("all"), F.max(F.struct("c", "component", "s")).alias("top")).where("n > top.c")
    blocks = lambda c, s: F.greatest(F.ceil(c / BLOCK), F.ceil(s / BLOCK_BYTES)).cast("int")
    sizes = sizes.select(
        "key", F.col("top.component").alias("home"), blocks(F.col("top.c"), F.col("top.s")).alias("p"),
        blocks(F.col("n") - F.col("top.c"), F.col("all") - F.col("top.s")).alias("q"), "n",
    )
    open_ = stage(sizes, "open-buckets")
    dealt = lookup(members, open_, ["key"], "n").withColumn("stray", F.col("component") != F.col("home"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("fp"), F.when(F.col("stray"), F.col("q")).otherwise(F.col("p"))).cast("int"))
    meet = lambda i, kind, j: F.struct(i.alias("i"), F.lit(kind).alias("strays"), j.alias("j"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = F.col("block")
    tasks = F.when(
        F.col("stray"),
        F.concat(
            F.transform(upto("p"), lambda j: meet(own, False, j)),
            F.transform(upto("q"), lambda k: meet(F.least(own, k), True, F.greatest(own, k))),
        ),
    ).otherwise(F.transform(upto("q"), lambda i: meet(i, False, own)))
    return dealt.select("key", F.inline(tasks), "stray", "block", "band", "fp", "n_shingles", "component").join(reps.select("fp", "sig"), "fp")


class _Meeting:
    """The members of one task and the pairs among them that signatures leave."""

    def __init__(self, t: pa.Table, percent: int, least: list[int]):
        self.sig, self.n = _sig_rows(t.column("sig").combine_chunks()), t.column("n_shingles").to_numpy()
        block, stray = t.column("block").to_numpy(), t.column("stray").to_numpy()
        (i, strays, j), self.band = (t.column(c)[0].as_py() for c in ("i", "strays", "j")), t.column("band")[0].as_py()
        names: dict = {}
        self.component = np.array([names.setdefault(c, len(names)) for c in t.column("component").to_pylist()])
        self.left = np.flatnonzero(stray & (block == i))
        self.right = np.flatnonzero((stray == strays) & (block == j))
        self.ordered = strays and i == j  # a block against itself
        self.percent, self.least = percent, least

    def partners(self, x: int) -> np.ndarray:
        """Members of other components (as they are now) that may be linked with x."""
        ys = self.right[self.right > x] if self.ordered else self.right
        n, sig = self.n, self.sig
        ys = ys[(self.component[ys] != self.component[x]) & (100 * np.minimum(n[ys], n[x]) >= self.percent * np.maximum(n[ys], n[x]))]
        if len(ys):
            ys = ys[_passes(np.broadcast_to(sig[x], (len(ys), sig.shape[1])), sig[ys], self.least)]
        if self.band and len(ys):  # the first band they share pairs them
            upto = self.band * ROWS
            ys = ys[~(sig[ys, :upto] == sig[x, :upto]).reshape(len(ys), self.band, ROWS).all(axis=2).any(axis=1)]
        return ys


def _second_pass(documents: DataFrame, members: DataFrame, reps: DataFrame, size: int, percent: int, least: list[int]) -> DataFrame:
    """Confirmed links that join the components of buckets' members: of each task a forest. Staged."""
    tasks = ["key", "i", "strays", "j"]
    meetings = _meetings(members, reps)

    def likely(t: pa.Table) -> pa.Table:
        meeting, hit = _Meeting(t, percent, least), np.zeros(len(t), bool)
        for x in meeting.left:
            ys = meeting.partners(x)
            hit[ys] = True
            hit[x] |= len(ys) > 0
        return t.filter(pa.array(hit))

    some = stage(meetings.groupBy(*tasks).applyInArrow(likely, meetings.schema), "likely")
    texts = _texts(documents, reps, some.select("fp"))

    def forest(t: pa.Table) -> pa.Table:
        meeting, fp = _Meeting(t, percent, least), t.column("fp").to_pylist()
        verifier = _Verifier(t.column("text").to_pylist(), size, percent)
        out = []
        for x in meeting.left:
            ys = meeting.partners(x)
            for y in verifier.similar(x, ys) if len(ys) else ys:
                a, b = meeting.component[x], meeting.component[y]
                if a != b:
                    meeting.component[meeting.component == b] = a
                    out.append((min(fp[x], fp[y]), max(fp[x], fp[y])))
        return _pair_table(out)

    links = stage(some.join(texts, "fp").groupBy(*tasks).applyInArrow(forest, "a binary, b binary"), "forest")
    release(some, texts)
    return links


def _groups(documents: DataFrame, size: int, threshold: float, miss: float) -> DataFrame:
    """One row per document: doc_id, th, n_shingles, component (a fingerprint), component_id, kept."""
    ship_code(documents.sparkSession)
    percent, least = round(100 * threshold), min_matches(threshold, miss=miss)
    docs = stage(shingle_sets(documents, size), "signatures")
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "th"))
    held = docs.where("fp IS NOT NULL").groupBy("fp").agg(
        F.count("*").alias("n"), least_row.alias("least"), *[F.first(c).alias(c) for c in ("n_bytes", "n_shingles", "sig", "bands")]
    )
    reps = stage(held.select("fp", "n", "least.doc_id", "least.th", "n_bytes", "n_shingles", "sig", "bands"), "sets")

    # most sets meet no other: of them only fingerprints and buckets move, their signatures once
    entries = reps.select("fp", F.posexplode("bands").alias("band", "key"))
    buckets = stage(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    sharing = stage(lookup(entries, buckets, ["key"], "n"), "sharing")
    least_fp = stage(sharing.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a")), "least")
    met = stage(reps.drop("n", "bands").join(sharing.select("fp").distinct(), "fp", "left_semi"), "met")
    members = lookup(sharing, least_fp, ["key"], "n").join(met.select("fp", "n_shingles", "n_bytes"), "fp")
    members = stage(members, "members")
    sizes = met.select(F.col("fp").alias("a"), F.col("n_shingles").alias("na"))
    stars = members.where("fp <> a").select("a", F.col("fp").alias("b"), "n_shingles").distinct().join(sizes, "a")
    stars = stage(stars.where(_length_bound("na", "n_shingles", percent)).select("a", "b"), "stars")
    pairs = _prune(stars, met, least)
    links = _confirmed_stars(documents, pairs, met, size, percent)
    comp = stage(components(links), "components")

    open_ = members.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "key", "band", "fp", "n_shingles", "n_bytes", F.coalesce("component", "fp").alias("component")
    )
    open_ = stage(open_, "open")
    more = _second_pass(documents, open_, met, size, percent, least)
    if not more.isEmpty():
        comp = stage(components(links.unionByName(more)), "components")

    sets = reps.select("fp", "n", "doc_id").join(comp.toDF("fp", "component"), "fp", "left")
    sets = stage(sets.withColumn("component", F.coalesce("component", "fp")), "named")
    lowest = stage(sets.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("sets")), "lowest")
    named = stage(lookup(sets.drop("doc_id"), lowest, ["component"], "sets"), "groups")
    out = lookup(docs.select("doc_id", "th", "n_shingles", "fp").where("fp IS NOT NULL"), named, ["fp"], "n").drop("fp")
    alone = docs.where("fp IS NULL").select("doc_id", "th", "n_shingles", F.lit(None).cast("binary").alias("component"), F.col("doc_id").alias("component_id"))
    release(members, buckets, sharing, least_fp, met, stars, pairs, open_, links, more, comp, reps, sets, lowest)
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(
    documents: DataFrame, *, size: int = SHINGLE, threshold: float = THRESHOLD, miss: float = MISS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over
    links, itself included), kept (doc_id = component_id)."""
    return _groups(documents, size, threshold, miss).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(
    documents: DataFrame, *, size: int = SHINGLE, threshold: float = THRESHOLD, miss: float = MISS
) -> DataFrame:
    """The rows and columns of ``documents`` less all but one document of each group (documents
    without words are no group: all stay). Where the kept doc_id occurs several times in its group,
    one of its rows stays."""
    found = stage(_groups(documents, size, threshold, miss).where("component IS NOT NULL"), "near-duplicates")
    rows = stage(found.groupBy("component", "doc_id", "th").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "rows")
    first = rows.groupBy("component").agg(F.min(F.when(F.col("kept"), F.col("th"))).alias("first"), F.count("*").alias("rows"))
    rows = lookup(rows, stage(first, "first"), ["component"], "rows")
    rows = rows.withColumn("stays", F.col("kept") & (F.col("th") == F.col("first")))  # of one id with several texts the first
    rows = stage(rows.select("doc_id", "th", "stays", "n"), "decided")
    keys = {"doc_id": F.col("doc_id").cast("long"), "th": F.xxhash64("text")}
    return without(documents, keys, rows.where("NOT stays"), rows.where("stays AND n > 1"))


def op7_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""
