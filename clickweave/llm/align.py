"""Alignment of two tokenizations of the same texts by pointer jumping.

A text is encoded by a byte-level vocabulary (A, of a space and the text) and by a piece vocabulary (B, which
puts that space itself). Both sequences tile the same bytes. Every token points to the farthest-right
token that overlaps it: the other side's token that holds its last byte, if that reaches farther. Where
both end at the same byte the A token is the end of the chain and the B token points to it. Doubling
all successors at once (``succ = succ[succ]``) until nothing changes takes every token to the terminal
token of its component, which labels its group.

Neither vocabulary joins text across the place before a space or line end that follows another character:
A's splitting pattern starts a new piece there, and no piece of B holds a space after another character, or a
line end beside one (checked when the vocabulary is loaded). Texts are cut at those places; each worker keeps
the aligned groups of the stretches it has met, compared by their bytes, and encodes only new ones.

Every document's distinct linked pairs of ids go to the counts: a pair's count is the number of documents
that hold it, and an A id's best pairs are those of its highest count. Pairs that a large part
of all documents hold are joined where the documents lie (``common.lookup``).

Defined results: null or empty texts, and those that either side does not give back byte by byte (as with
U+2581, which stands for a space in B), have no tokens: zeros and an empty digest; they link nothing. Repeated rows
are separate documents; a null doc_id stays null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as W
from clickweave.llm.common import BROADCAST_ROWS, lookup, release, ship_code, stage, table

#: Bytes of stretches and groups that a worker keeps before it starts afresh.
CACHE_BYTES = 64 << 20
#: Texts of together so many bytes are aligned at once; a longer text alone.
BATCH = 1 << 20
#: An id pair is one number: A's id times this plus B's id.
PAIR = 1 << 32
_SPACE_MARK = "▁"
#: Behind a character that is no white space (of the ranges of UTF-8 that hold none), before a space or line end.
_CUT = re.compile(
    rb"(?:(?<=[\x21-\x7e])|(?<=[\xc3-\xdf][\x80-\xbf])|(?<=[\xe4-\xed][\x80-\xbf][\x80-\xbf]))(?=[ \n])"
)
_ROW = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable Latin-1 ones stand for
    themselves, the others in order for U+0100 and up."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def jump(succ: np.ndarray) -> np.ndarray:
    """The end of every chain of successors, by doubling."""
    while True:
        twice = succ[succ]
        if np.array_equal(twice, succ):
            return succ
        succ = twice


def components(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For the tokens of A, then those of B, given where they end in the same bytes: the number of
    the A token that ends their component. Components are runs of tokens linked by overlap."""
    n = len(ends_a)
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)  # hold the last byte
    succ = np.arange(n + len(ends_b))
    farther = ends_b[over_a] > ends_a
    succ[:n][farther] = n + over_a[farther]
    succ[n:] = over_b  # reaches as far or farther, and closes the component if as far
    return jump(succ)


def _last(x: np.ndarray) -> np.ndarray:
    """Which of sorted numbers are the last of their kind."""
    return np.append(x[1:] != x[:-1], True)[: len(x)]


class _Spans:
    """The bytes of every id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def tile(self, ids: np.ndarray, count: np.ndarray, text: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which of the stretches of ``size`` bytes of ``text`` their ``count`` of ``ids`` give back."""
        upto = np.concatenate([[0], np.cumsum(self.size[ids])])[np.concatenate([[0], np.cumsum(count)])]
        fits = np.diff(upto) == size
        own = np.repeat(fits, count)
        made = self.data[W._ranges(self.begin[ids[own]], self.size[ids[own]])]
        asked = text[np.repeat(fits, size)]
        wrong = np.searchsorted(np.cumsum(size[fits]), np.flatnonzero(made != asked), side="right")
        fits[np.flatnonzero(fits)[wrong]] = False
        return fits


class Aligner:
    """Groups, links and digests of texts under two vocabularies, stretch by stretch."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        by_a = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        joined = re.compile(f"[^{_SPACE_MARK}]{_SPACE_MARK}|.\n|\n.", re.DOTALL)
        if any(joined.search(p) for p in pieces):
            raise ValueError("a piece joins text across a space or line end")
        by_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = _Spans([by_a.get(i, b"") for i in range(max(by_a) + 1)]), _Spans(by_b)
        # a token as it is written into groups: A's before another one or the bar, then B's before another one or the end
        self.words = [f"{i}{sep}".encode() for n, seps in ((len(self.bytes_a.size), ",|"), (len(by_b), ",;")) for sep in seps for i in range(n)]
        self.word_size = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.lone_space = self.b.piece_to_id(_SPACE_MARK)
        self._reset()

    def _reset(self) -> None:
        self.place: dict[bytes, int] = {}
        self.held = 0
        self.groups: list[bytes] = []
        self.stats, self.links, self.ends = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _ids(self, stretches: list[bytes]) -> tuple[list, list]:
        """Ids of stretches, each of which begins with a space or, after other text, with a line end. B puts a
        space before every text: it stands for the first one, or is taken away again."""
        texts = [s.decode() for s in stretches]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return a, [(y if t[0] == " " else y[1:]) or [self.lone_space] for y, t in zip(b, texts, strict=True)]

    def _learn(self, new: list[bytes]) -> None:
        """Align stretches not met before, all at once."""
        ids = self._ids(new)
        count = [np.fromiter(map(len, x), np.int64, len(new)) for x in ids]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in zip(ids, count, strict=True))
        size = np.fromiter(map(len, new), np.int64, len(new))
        text = np.frombuffer(b"".join(new), np.uint8)
        whole = self.bytes_a.tile(a, count[0], text, size) & self.bytes_b.tile(b, count[1], text, size)
        if not whole.all():  # a stretch that a side does not give back is left out: its texts have no tokens
            a, b = a[np.repeat(whole, count[0])], b[np.repeat(whole, count[1])]
            count = [np.where(whole, n, 0) for n in count]
        ends_a, ends_b = np.cumsum(self.bytes_a.size[a]), np.cumsum(self.bytes_b.size[b])
        label = components(ends_a, ends_b)
        # every piece of bytes between two ends belongs to one token of A and one of B: a link
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[_last(ends)]
        links = a[np.searchsorted(ends_a, ends)] * PAIR + b[np.searchsorted(ends_b, ends)]
        in_a, in_b = label[: len(a)], label[len(a) :]
        # the tokens group by group, A's before B's, each with what follows it
        both = np.concatenate([2 * in_a, 2 * in_b + 1])
        last = _last(in_a), _last(in_b)
        n_a, n_b = len(self.bytes_a.size), len(self.bytes_b.size)
        said = np.concatenate([a + n_a * last[0], 2 * n_a + b + n_b * last[1]])[np.argsort(both, kind="stable")]
        written = b"".join(map(self.words.__getitem__, said.tolist()))
        upto = np.concatenate([[0], np.cumsum(self.word_size[said])])[np.cumsum(count[0] + count[1])]
        closes = np.flatnonzero(last[0])
        of_stretch = np.concatenate([[0], ends_a])[np.cumsum(count[0])]  # where each stretch ends
        n_groups = np.diff(np.searchsorted(ends_a[closes], of_stretch, side="right"), prepend=0)
        n_links = np.diff(np.searchsorted(ends, of_stretch, side="right"), prepend=0)
        self.place.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        upto = upto.tolist()
        self.groups += [written[i:j] for i, j in zip([0, *upto], upto, strict=False)]
        self.held += 300 * len(new) + len(text) + len(written) + 8 * len(links)
        stats = np.stack([*count, n_groups, np.where(whole, n_links, -1)], axis=1)
        self.stats = np.concatenate([self.stats, stats])
        self.links = np.concatenate([self.links, links])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(n_links)])

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, digest of the groups, distinct linked pairs, how often each."""
        if self.held > CACHE_BYTES:
            self._reset()
        cut = [_CUT.split(b" " + t.encode()) if t else [] for t in texts]
        new = list(dict.fromkeys(s for parts in cut for s in parts if s not in self.place))
        if new:
            self._learn(new)
        out = []
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        for parts in cut:
            at = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
            stats = self.stats[at]
            if not len(at) or (stats[:, 3] < 0).any():
                out.append(nothing)
                continue
            digest = hashlib.sha256(b"".join([self.groups[i] for i in at.tolist()])[:-1]).hexdigest()
            pairs, times = np.unique(self.links[W._ranges(self.ends[at], stats[:, 3])], return_counts=True)
            out.append((*stats.sum(axis=0).tolist(), digest, pairs, times))
        return out


_held: dict[int, Aligner] = {}


def _aligner(a_json: str, b_model: bytes) -> Aligner:
    """The aligner of this worker process, kept from task to task with the stretches it has met."""
    key = hash((a_json, b_model))
    if key not in _held:
        _held.clear()
        _held[key] = Aligner(a_json, b_model)
    return _held[key]


def aligned(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: row (an arbitrary number), doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs (distinct linked id pairs, A's id times ``PAIR`` plus B's) and times (links
    of each pair). Staged."""
    spark = documents.sparkSession
    ship_code(spark)
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        models = spark.sparkContext.broadcast((f.read(), g.read()))  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId() << 33
        for b in batches:
            _, off = W.text_bytes(b.column(1))
            for i, j in W.groups(off, BATCH):
                got = _aligner(*models.value).align(b.column(1).slice(i, j - i).to_pylist())
                columns = list(zip(*got, strict=True))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in columns[5]])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(nth, nth + j - i)), b.column(0).slice(i, j - i), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4]),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(columns[5]))), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(columns[6]).astype(np.int32))),
                    ],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )
                nth += j - i

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(docs.mapInArrow(run, _ROW), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): in how many rows of ``aligned`` each pair is linked, and whether no other
    pair of its A id is linked in more. Staged."""
    counts = stage(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")), "pair-counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("count").alias("most"))  # a row per A id, at most its vocabulary
    out = counts.withColumn("a", a).join(F.broadcast(most), "a")
    out = stage(out.select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "counted")
    release(counts)
    return out


def cross_aligned(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is a best
    one of its A id), count_sum (sum of the links' counts), groups_sha256."""
    rows = aligned(documents, a_path, b_path)
    counts = pair_counts(rows)
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    if counts.count() <= BROADCAST_ROWS:  # few pairs: no shuffle of the links
        held = links.join(F.broadcast(counts), "pair")
    else:
        held = lookup(links, counts.withColumn("n", F.col("count")), ["pair"], "n")
    sums = held.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    out = rows.drop("pairs", "times").join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def op13_pointer_jumping(spark, sf_dir):
    import public_tokenizers

    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return cross_aligned(table(spark, sf_dir, "documents"), a, b)
