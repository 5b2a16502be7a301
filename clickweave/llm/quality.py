"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < .. < K-1 share one weight vector w over hashed text features and have ordered
thresholds: P(grade <= k | x) = sigmoid(theta_k - w.x), theta_0 < theta_1 < ... The expected grade
is the sum of the tail probabilities P(grade >= k); selection is by the tail at a chosen grade.

Features of a whole text: presence of each lower-cased word (runs of letters and digits) and of word
beginnings of ``BEGINNINGS`` bytes, hashed to 2^``BITS`` buckets, and the share of words of each shape (classes of the first and last character,
length, whether the word repeats the one before).

Fitting: labelled rows, at most about ``SAMPLE`` of them chosen by hash (the documented bound; all
if there are fewer), become a staged feature table; a word gets a weight if at least ``MIN_ROWS``
sampled texts have it and their grades lie ``Z_LEAST`` standard errors off the mean. Each L-BFGS step is a Spark job in which every task returns one gradient; the driver
holds vectors of the size of the word list, never rows. Scoring reads every text once.

From ``labels`` (quality, toxic) the grades are 0 toxic, 1 poor, 2 good.

Defined results: null or empty texts have no features, their score is 0; rows without a usable
label do not train; several labels of a document give its lowest grade; a table without labels, or
with one grade only, keeps every document; repeated rows score alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as W
from clickweave.llm.common import ship_code, stage, table

#: Words longer than so many bytes also count by their first bytes.
BEGINNINGS = (4, 5, 6, 7, 8)
BITS, SAMPLE, MIN_ROWS, Z_LEAST = 22, 20_000, 8, 5.0
L2, STEPS = 1e-4, 40
GRADES = 3
#: Shapes: first class x last class x length class x repeats the word before.
_CLASSES, _LENGTHS = 7, 4
SHAPES = _CLASSES * _CLASSES * _LENGTHS * 2
#: What a row without text counts where batches are sliced: its shapes.
_ROW_BYTES = SHAPES // 4
_CLASS = np.full(256, 6, np.uint8)  # other ASCII
_CLASS[[ord(c) for c in ".,;:'-)(\""]] = 5
_CLASS[128:] = 4
for _i in range(128):
    if chr(_i).isdigit():
        _CLASS[_i] = 3
    elif chr(_i).isupper():
        _CLASS[_i] = 2
    elif chr(_i).islower():
        _CLASS[_i] = 1
_CLASS[[0x24, 0x25, 0x26, 0x2A, 0x23]] = 0


def _word_features(scan: W.Scan, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, buckets) of the words and of their beginnings, not yet distinct."""
    row = np.searchsorted(starts, scan.first, side="right") - 1
    shift = np.uint64(64 - BITS)
    yield row, (scan.hashes() >> shift).astype(np.int64)
    for n in BEGINNINGS:
        at = np.flatnonzero(scan.last - scan.first >= n)
        first = scan.first[at]
        yield row[at], (W.mix(scan.span_hashes(first, first + n) + np.uint64(n)) >> shift).astype(np.int64)


def _distinct(raw: np.ndarray, off: np.ndarray, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For groups of rows [i, j): (i, j, rows, buckets), each pair once; only buckets that are
    ``wanted``, if given."""
    for i, j, parts, starts in W.scans(raw, off, W.PUNCT):
        pairs = [np.empty(0, np.int64)]
        for part in parts:
            for row, bucket in _word_features(part, starts):
                if wanted is not None:
                    keep = wanted[bucket]
                    row, bucket = row[keep], bucket[keep]
                pairs.append(np.unique((row << BITS) | bucket))
        both = np.unique(np.concatenate(pairs))
        yield i, j, both >> BITS, both & ((1 << BITS) - 1)


def _shapes(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Share of the words of each shape, per row."""
    out = np.zeros((len(off) - 1, SHAPES))
    for i, j, parts, starts in W.scans(raw, off, W.SPACE):
        for part in parts:
            if not len(part.first):
                continue
            h, row = part.hashes(), np.searchsorted(starts, part.first, side="right") - 1
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (row[1:] == row[:-1])])
            length = np.minimum(np.log2(part.last - part.first + 1).astype(np.int64), _LENGTHS - 1)
            ends = _CLASS[part.raw[part.first]].astype(np.int64) * _CLASSES + _CLASS[part.raw[part.last]]
            shape = (ends * _LENGTHS + length) * 2 + again
            out[i:j] += np.bincount(row * SHAPES + shape, minlength=(j - i) * SHAPES).reshape(j - i, SHAPES)
    out /= np.maximum(1, out.sum(axis=1, keepdims=True))
    return out


@dataclass(frozen=True)
class OrdinalModel:
    """``buckets`` (sorted) and ``weights`` of words, weights of shapes, thresholds."""

    buckets: np.ndarray
    weights: np.ndarray
    shapes: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def sampled_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, grade) of about ``sample`` labelled documents at most."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    graded = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("grade IS NOT NULL AND doc_id IS NOT NULL")
    graded = stage(graded.groupBy("doc_id").agg(F.min("grade").alias("grade")), "graded")
    n, buckets = graded.count(), 1 << 30
    return graded.where(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) < int(min(1.0, sample / max(1, n)) * buckets))


def _features(rows: DataFrame) -> DataFrame:
    """(grade, words, shapes) of labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for grade, raw, off in ((p.column(0), *W.text_bytes(p.column(1))) for p in _parts(b, 1)):
                shapes, rows, buckets = _shapes(raw, off), [], []
                for i, _, row, found in _distinct(raw, off):
                    rows.append(row + i)
                    buckets.append(found.astype(np.int32))
                at = np.searchsorted(np.concatenate(rows), np.arange(len(off)))
                yield pa.RecordBatch.from_arrays(
                    [grade, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(buckets))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(off)) * SHAPES, pa.int32()), pa.array(shapes.astype(np.float32).reshape(-1)))],
                    names=["grade", "words", "shapes"],
                )

    return rows.select(F.col("grade").cast("int"), "text").mapInArrow(run, "grade int, words array<int>, shapes array<float>")


def _parts(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``W.PIECE`` bytes of its column ``text`` and few rows, so that what
    is held of a batch does not grow with it."""
    col = batch.column(text)
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    off = np.concatenate([[0], np.cumsum(size + _ROW_BYTES)])
    for i, j in W.groups(off):
        yield batch.slice(i, j - i)


def _loss(buckets: np.ndarray, thresholds: np.ndarray, weights: np.ndarray, shapes: np.ndarray, batch: pa.RecordBatch) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of a batch and its gradient in (thresholds, shapes, weights)."""
    grade, lists = batch.column(0).to_numpy(), batch.column(1)
    at = np.minimum(np.searchsorted(buckets, flat := lists.flatten().to_numpy()), max(0, len(buckets) - 1))
    known = buckets[at] == flat if len(buckets) else np.zeros(len(flat), bool)
    row = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))[known]
    at = at[known]
    x = batch.column(2).flatten().to_numpy().reshape(len(grade), -1).astype(np.float64)
    score = np.bincount(row, weights[at], minlength=len(grade)) + x @ shapes
    z = np.concatenate([[-np.inf], thresholds, [np.inf]])
    hi, lo = (1 / (1 + np.exp(-np.clip(z[g] - score, -500, 500))) for g in (grade + 1, grade))
    p = np.maximum(hi - lo, 1e-12)
    d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
    d_score = d_hi - d_lo  # of the loss
    g_theta = np.zeros(len(z))
    np.add.at(g_theta, grade + 1, -d_hi)
    np.add.at(g_theta, grade, d_lo)
    grad = np.concatenate([g_theta[1:-1], x.T @ d_score, np.bincount(at, d_score[row], minlength=len(weights))])
    return float(-np.log(p).sum()), grad


def fit(documents: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, min_rows: int = MIN_ROWS, z_least: float = Z_LEAST, l2: float = L2, steps: int = STEPS, grades: int = GRADES) -> OrdinalModel:
    """Fit on the labelled documents; see the module's text."""
    ship_code(documents.sparkSession)
    chosen = F.broadcast(sampled_labels(labels, sample).toDF("id", "grade"))  # bounded by ``sample``
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, F.col("doc_id") == F.col("id"))
    data = stage(_features(rows), "features")
    counts = {r["grade"]: r["n"] for r in data.groupBy("grade").agg(F.count("*").alias("n")).collect()}  # a row per grade
    total = sum(counts.values())
    if len(counts) < 2:
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.zeros(SHAPES), np.full(grades - 1, -30.0) - np.arange(grades - 1)[::-1])
    # counts of each word's texts, in all and up to each grade but the last
    upto = [sum(counts.get(g, 0) for g in range(k + 1)) / total for k in range(grades - 1)]
    words = data.select("grade", F.explode("words").alias("w")).groupBy("w").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("grade") <= k).alias(f"c{k}") for k in range(grades - 1)]
    )
    apart = [F.abs(F.col(f"c{k}") - F.col("n") * p) >= z_least * F.sqrt(F.col("n") * p * (1 - p)) for k, p in enumerate(upto) if 0 < p < 1]
    words = words.where((F.col("n") >= min_rows) & F.greatest(*apart, F.lit(False))).select("w")
    buckets = np.sort(words.toArrow().column(0).to_numpy()).astype(np.int64)  # at most 2^BITS numbers

    share = np.cumsum([counts.get(k, 0) + 0.5 for k in range(grades)])[:-1] / (total + grades / 2)
    theta = np.log(share / (1 - share))
    # thresholds are written as a first one and positive steps, so that they stay ordered
    start = np.concatenate([[theta[0]], np.log(np.maximum(np.diff(theta), 1e-3)), np.zeros(SHAPES + len(buckets))])
    k = grades - 1

    def unpack(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.concatenate([[v[0]], v[0] + np.cumsum(np.exp(np.clip(v[1:k], -20, 20)))]), v[k : k + SHAPES], v[k + SHAPES :]

    spread = data.repartition(min(8, max(1, total // 500)))
    spread = stage(spread, "training")

    def value(v: np.ndarray) -> tuple[float, np.ndarray]:
        thresholds, shapes, weights = unpack(v)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, grad = 0.0, np.zeros(len(v))
            for b in batches:
                for k in range(0, b.num_rows, 1000):
                    f, g = _loss(buckets, thresholds, weights, shapes, b.slice(k, 1000))
                    loss, grad = loss + f, grad + g
            yield pa.RecordBatch.from_pydict({"loss": [loss], "grad": pa.array([grad.tobytes()], pa.binary())})

        parts = spread.mapInArrow(run, "loss double, grad binary").collect()  # a row per task of the bounded sample
        grad = sum(np.frombuffer(r["grad"]) for r in parts) / total
        loss = sum(r["loss"] for r in parts) / total
        out = grad.copy()
        out[0] = grad[:k].sum()
        for i in range(1, k):
            out[i] = grad[i:k].sum() * np.exp(np.clip(v[i], -20, 20))
        out[k:] += l2 * v[k:]
        return loss + 0.5 * l2 * float(v[k:] @ v[k:]), out

    thresholds, shapes, weights = unpack(_lbfgs(value, start, steps))
    return OrdinalModel(buckets, weights, shapes, thresholds)


def _lbfgs(value, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    f, g = value(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, coef = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            coef.append(a)
            q -= a * y
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.abs(g).sum())
        for (s, y), a in zip(pairs, reversed(coef), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        rate = 1.0
        while True:
            x2 = x - rate * q
            f2, g2 = value(x2)
            if f2 <= f - 1e-4 * rate * float(g @ q) or rate < 1e-3:
                break
            rate /= 4
        if f2 > f or np.abs(g2).max() < 1e-6:
            return x2 if f2 <= f else x
        if (x2 - x) @ (g2 - g) > 1e-12:
            pairs = [*pairs, (x2 - x, g2 - g)][-memory:]
        done = f - f2 < 1e-6 * max(1.0, abs(f2))
        x, f, g = x2, f2, g2
        if done:
            break
    return x


def _tails(texts: pa.Array, model: OrdinalModel, dense: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, tails) of each text; ``dense``: the weight of each bucket; ``used``: if not zero."""
    raw, off = W.text_bytes(texts)
    s = _shapes(raw, off) @ model.shapes
    for i, j, row, found in _distinct(raw, off, used):
        s[i:j] += np.bincount(row, dense[found], minlength=j - i)
    return s, model.tails(s)


def _dense(model: OrdinalModel) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros(1 << BITS, np.float32)
    out[model.buckets] = model.weights
    return out, out != 0


def score(documents: DataFrame, model: OrdinalModel, *, grade: int = GRADES - 1, least: float = 0.5) -> DataFrame:
    """doc_id, score, expected_grade, tail (probability of ``grade`` or more), keep (tail >= least)
    of every document."""
    ship_code(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the hash space

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(held.value)
        for b in (part for whole in batches for part in _parts(whole, 1)):
            s, tails = _tails(b.column(1), held.value, *dense)
            tail = tails[:, grade - 1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= least)],
                names=["doc_id", "score", "expected_grade", "tail", "keep"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id bigint, score double, expected_grade double, tail double, keep boolean")


def selected(documents: DataFrame, model: OrdinalModel, *, grade: int = GRADES - 1, least: float = 0.5) -> DataFrame:
    """The rows and columns of ``documents`` that the classifier keeps; no shuffle."""
    ship_code(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(held.value)
        for b in (part for whole in batches for part in _parts(whole, at)):
            yield b.filter(pa.array(_tails(b.column(at), held.value, *dense)[1][:, grade - 1] >= least))

    return documents.mapInArrow(run, documents.schema)


def op1_ordinal(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(documents, table(spark, sf_dir, "labels")))
