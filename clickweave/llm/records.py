"""Token ids as length-delimited binary records with an offset index.

A data file is a run of records; one record frames one document's token ids:

    uint64  length of the payload            (all numbers little-endian)
    uint32  masked CRC-32 of those 8 bytes
    bytes   payload: int64 doc_id, uint8 1 if doc_id is null, uint8 bytes per id (2 or 4), the ids
    uint32  masked CRC-32 of the payload

The mask rotates a checksum and adds a constant, so that checksums of data that holds checksums
stay apart. Beside each data file an index file holds, per record, uint64 offset, uint64 payload
length and int64 doc_id: a reader can fetch records in any order without scanning.

Files are written by tasks under a folder all executors share, in ascending doc_id order across and
within files, each under a name of its own attempt. The manifest (a staged table, one row per file)
names the files of the attempts that were committed; files of lost attempts are never read.

Texts are encoded piece by piece: the tokenizer's rules never join text across white space, so the ids
of a text are the ids of its pieces in order. Each worker keeps the ids of pieces it has met.

Defined results: a null or empty text is the end id alone; documents of equal doc_id are ordered by a
text hash, equal rows are separate records; null doc_ids come first; an empty table writes no file;
extra columns are not read.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import words as W
from clickweave.llm.common import running_total, scratch, ship_code, shuffle_parts, stage, table

END_ID = 1
_HEAD, _CRC, _OWN, _ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB"), struct.Struct("<QQq")
_MASK = 0xA282EAD8
MANIFEST = "part int, file string, index string, records bigint, tokens bigint, bytes bigint"
#: Pieces that a worker keeps (60 to 120 bytes each, and as many while they are merged), and their bytes.
CACHE_PIECES, CACHE_BYTES = 500_000, 16 << 20
#: Pieces encoded at a time, and how many of them are joined to a text.
_AT_ONCE = 8000
_GAP, _JOINED, _TAIL = "\x00", 1000, ".,;:!?%$&#*|\""
_IS_TAIL = np.isin(np.arange(256), [ord(c) for c in _TAIL])
_ALNUM = np.array([i < 128 and chr(i).isalnum() for i in range(256)])


def _room(x: np.ndarray, size: int) -> np.ndarray:
    """``x`` or a longer array that begins with it."""
    while size > len(x):
        x = np.concatenate([x, np.empty_like(x)])
    return x


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = _OWN.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()
    head = _HEAD.pack(len(payload))
    return b"".join((head, _CRC.pack(masked(head)), payload, _CRC.pack(masked(payload))))


def index_entry(offset: int, framed: int, doc_id: int | None) -> bytes:
    return _ENTRY.pack(offset, framed - 16, doc_id or 0)


def index_entries(raw: bytes) -> list[tuple[int, int, int]]:
    return list(_ENTRY.iter_unpack(raw))


ENTRY_BYTES = _ENTRY.size


def _payload(payload: bytes, crc: bytes) -> tuple[int | None, np.ndarray]:
    if _CRC.unpack(crc)[0] != masked(payload):
        raise ValueError("record checksum does not match")
    doc_id, null, width = _OWN.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=_OWN.size)


def read_record(stream) -> tuple[int | None, np.ndarray] | None:
    """The next (doc_id, ids) of a stream; None at its end."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or _CRC.unpack(head[8:])[0] != masked(head[:8]):
        raise ValueError("length checksum does not match")
    n = _HEAD.unpack(head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4:
        raise ValueError("record is cut off")
    return _payload(body[:n], body[n:])


class WordEncoder:
    """Token ids of texts, piece by piece, with a bounded cache of pieces.

    A piece is a run without white space, less the punctuation at its end where that follows an ASCII
    letter or digit, or that punctuation: the tokenizer never joins text across either cut. ASCII
    letters are folded to lower case, as the tokenizer does (not beside combining marks, with
    which they might compose first, nor where the text of an added token stands in any case: those
    are matched before folding). Pieces are found, hashed and looked up a batch at a time; only
    pieces not met before are encoded. A piece is known only if its bytes are those that were kept."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        contents = (t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added = {W.LOWER[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in contents if t != t.lower() or t != t.upper()}
        (self.gap,) = self.tokenizer.encode(_GAP, add_special_tokens=False).ids
        self._reset()

    def _reset(self) -> None:
        """Known pieces: sorted runs of (hashes, places). Place p has the ids [ends[p], ends[p + 1]) and
        the bytes [cuts[p], cuts[p + 1]) of ``text``, ``heads[p]`` being the first eight."""
        self.runs = [(np.empty(0, np.uint64), np.empty(0, np.int64)) for _ in range(2)]
        self.ids, self.ends = np.empty(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)
        self.text, self.cuts, self.heads = np.empty(1 << 16, np.uint8), np.zeros(1 << 14, np.int64), np.empty(1 << 14, np.uint64)
        self.n = 0

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Places of sorted ``hashes``, -1 where not known."""
        out = np.full(len(hashes), -1, np.int64)
        for keys, places in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, places[at], out)
        return out

    def _add(self, raw: np.ndarray, view: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Encode these pieces and keep their ids and bytes; their places."""
        data, size = raw.tobytes(), stops - starts
        counts, flats = [], []
        for k in range(0, len(starts), _AT_ONCE):
            found = self._encode_pieces([data[a:b].decode() for a, b in zip(starts[k : k + _AT_ONCE].tolist(), stops[k : k + _AT_ONCE].tolist(), strict=True)])
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            flats.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        flat, count, n, more = np.concatenate(flats), np.concatenate(counts), self.n, len(starts)
        self.ids = _room(self.ids, self.ends[n] + len(flat))
        self.text = _room(self.text, self.cuts[n] + int(size.sum()))
        self.ends, self.cuts, self.heads = (_room(x, n + more + 1) for x in (self.ends, self.cuts, self.heads))
        self.ids[self.ends[n] : self.ends[n] + len(flat)] = flat
        self.text[self.cuts[n] : self.cuts[n] + int(size.sum())] = view[W._ranges(starts, size)]
        self.ends[n + 1 : n + 1 + more] = self.ends[n] + np.cumsum(count)
        self.cuts[n + 1 : n + 1 + more] = self.cuts[n] + np.cumsum(size)
        self.heads[n : n + more] = W.heads(view, starts, size)
        self.n += more
        return np.arange(n, n + more)

    def _learn(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Make pieces of these sorted hashes known."""
        run = (np.concatenate([self.runs[1][0], hashes]), np.concatenate([self.runs[1][1], places]))
        if 4 * len(run[0]) > len(self.runs[0][0]):  # merged now and then, so that each piece moves few times
            run = tuple(np.concatenate([x, y]) for x, y in zip(self.runs[0], run, strict=True))
            order = np.argsort(run[0])
            self.runs = [(run[0][order], run[1][order]), (run[0][:0], run[1][:0])]
        else:
            order = np.argsort(run[0])
            self.runs[1] = (run[0][order], run[1][order])

    def _others(self, view: np.ndarray, starts: np.ndarray, stops: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Numbers of the pieces whose bytes are not those of their place."""
        size = stops - starts
        differ = (size != self.cuts[slot + 1] - self.cuts[slot]) | (W.heads(view, starts, size) != self.heads[slot])
        long = np.flatnonzero(~differ & (size > 8))
        rest = size[long] - 8
        same = view[W._ranges(starts[long] + 8, rest)] == self.text[W._ranges(self.cuts[slot[long]] + 8, rest)]
        differ[long[np.searchsorted(np.cumsum(rest), np.flatnonzero(~same), side="right")]] = True
        return np.flatnonzero(differ)

    def _with_added(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Numbers of the pieces in which the text of an added token begins, in any case."""
        data, hits = W.LOWER[raw].tobytes(), []
        for content in self.added:
            at = data.find(content)
            while at >= 0:
                hits.append(at)
                at = data.find(content, at + 1)
        return np.unique(np.searchsorted(starts, np.array(hits, np.int64), side="right") - 1)

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Lower-case ASCII words go to the model itself; others are encoded many at a time, set apart by
        a control character between spaces, whose one id no other text gives."""
        out: list = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            if p.isascii() and p.isalpha():
                out[i] = [t.id for t in self.model.tokenize(p.lower())]
            elif _GAP in p:
                out[i] = self.tokenizer.encode(p, add_special_tokens=False).ids
            else:
                rest.append(i)
        parts = [rest[k : k + _JOINED] for k in range(0, len(rest), _JOINED)]
        texts = [f" {_GAP} ".join([pieces[i] for i in part]) for part in parts]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = e.ids
            bounds = [-1, *[k for k, x in enumerate(ids) if x == self.gap], len(ids)]
            for k, i in enumerate(part):
                out[i] = ids[bounds[k] + 1 : bounds[k + 1]]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with END_ID after each, offsets per text)."""
        if self.n > CACHE_PIECES or self.cuts[self.n] > CACHE_BYTES:
            self._reset()
        raw, off = W.text_bytes(texts)
        folds = not ((raw == 0xCC) | (raw == 0xCD)).any()  # lead bytes of the combining marks
        scan = W.Scan(raw, off[:-1], W.SPACE)
        begin, end = scan.first, scan.last + 1
        kept = np.arange(len(raw), dtype=np.int32)  # a batch holds under 2 GB
        kept[_IS_TAIL[raw]] = -1
        core = np.maximum.accumulate(kept, out=kept)[scan.last].astype(np.int64) + 1 if len(raw) else end
        cut = (core > begin) & (core < end)
        cut[cut] = _ALNUM[raw[core[cut] - 1]]
        place = np.arange(len(begin)) + np.concatenate([[0], np.cumsum(cut)[:-1]]).astype(np.int64) if len(begin) else begin
        starts, stops = np.empty(len(begin) + int(cut.sum()), np.int64), np.empty(len(begin) + int(cut.sum()), np.int64)
        starts[place], stops[place] = begin, np.where(cut, core, end)
        starts[place[cut] + 1], stops[place[cut] + 1] = core[cut], end[cut]
        view = W.padded(W.LOWER[raw] if folds else raw)
        if folds and len(exact := self._with_added(raw, starts)):
            own = W._ranges(starts[exact], stops[exact] - starts[exact])
            view[own] = raw[own]
        hashes = W.span_hashes(view, starts, stops)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._lookup(unique)
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = self._add(raw, view, starts[first[new]], stops[first[new]])
            self._learn(unique[new], known[new])
        slot = known[back]
        if len(others := self._others(view, starts, stops, slot)):  # pieces that share a hash with another one
            slot[others] = self._add(raw, view, starts[others], stops[others])
        count = self.ends[slot + 1] - self.ends[slot]
        ids = self.ids[W._ranges(self.ends[slot], count)] if len(slot) else np.empty(0, np.uint32)
        per = np.concatenate([[0], np.cumsum(count)])[np.append(np.searchsorted(starts, off[:-1]), len(starts))]
        return np.insert(ids, per[1:], END_ID), per + np.arange(len(per))


_held: dict[int, WordEncoder] = {}


def worker_encoder(tokenizer_json: str) -> WordEncoder:
    """The encoder of this worker process, kept from task to task with the words it has met."""
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _held:
        _held.clear()
        _held[key] = WordEncoder(tokenizer_json)
    return _held[key]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_records(documents: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Encode ``documents`` (doc_id, text) and write them as record files under ``folder`` (by
    default a new one in the shared scratch folder). Returns the manifest."""
    spark = documents.sparkSession
    ship_code(spark)
    folder = folder or scratch(spark, "records")
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())  # one tokenizer file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name = TaskContext.get().partitionId(), f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        store, path = _open(name)
        encoder, data, index = None, None, None
        records = tokens = at = 0
        for b in batches:
            _, text_off = W.text_bytes(b.column(1))
            for i, j in W.groups(text_off):
                if encoder is None:
                    encoder = worker_encoder(model.value)
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    data, index = store.open_output_stream(f"{path}.rec"), store.open_output_stream(f"{path}.idx")
                ids, off = encoder.encode(b.column(1).slice(i, j - i))
                out, entries = io.BytesIO(), io.BytesIO()
                for k, doc_id in enumerate(b.column(0).slice(i, j - i).to_pylist()):
                    raw = frame(doc_id, ids[off[k] : off[k + 1]], encoder.width)
                    out.write(raw)
                    entries.write(index_entry(at, len(raw), doc_id))
                    at += len(raw)
                data.write(out.getbuffer())
                index.write(entries.getbuffer())
                records, tokens = records + j - i, tokens + len(ids)
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [f"{name}.rec"], "index": [f"{name}.idx"], "records": [records], "tokens": [tokens], "bytes": [at]}
            )

    order = ["doc_id", F.xxhash64("text")]
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    return stage(rows.mapInArrow(run, MANIFEST), "manifest")


def read_records(manifest: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every record, read back from the files; start
    counts the ids of all records before it. Checksums are verified."""
    ship_code(manifest.sparkSession)
    files = running_total(manifest.select("part", "file", "tokens"), [], ["part"], {"first": F.col("tokens")}, name="files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, path = _open(file)
                rows: list[tuple] = []
                held = 0
                with store.open_input_stream(path, buffer_size=1 << 20) as stream:
                    while (record := read_record(stream)) is not None:
                        doc_id, ids = record
                        raw = ids.astype("<u4").tobytes()
                        rows.append((doc_id, first, len(ids), zlib.crc32(raw), *[raw] * with_ids))
                        first, held = first + len(ids), held + 64 + len(raw) * with_ids
                        if held > 1 << 22:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    spread = files.repartitionByRange(shuffle_parts(manifest.sparkSession), "part").select("file", "first")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds, names = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), ("doc_id", "start", "n_tokens", "ids_crc32", "ids")
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
    return pa.RecordBatch.from_arrays(columns, names=list(names[: len(columns)]))


def read_index(manifest: DataFrame) -> DataFrame:
    """(file, offset, length, doc_id) of every record, from the index files alone."""
    ship_code(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, index in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, path = _open(index)
                with store.open_input_stream(path) as stream:
                    while raw := stream.read(ENTRY_BYTES << 14):
                        at, n, doc = zip(*index_entries(raw), strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([file] * len(at)), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(doc, pa.int64())], names=["file", "offset", "length", "doc_id"]
                        )

    return manifest.select("file", "index").mapInArrow(run, "file string, offset bigint, length bigint, doc_id bigint")


def read_shuffled(manifest: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, ids) of all records in a pseudo-random order, fetched by offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_files: dict = {}
        for b in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if file not in open_files:
                    if len(open_files) >= 64:
                        open_files.pop(next(iter(open_files))).close()
                    store, path = _open(file)
                    open_files[file] = store.open_input_file(path)
                doc_id, ids = read_record(io.BytesIO(open_files[file].read_at(length + 16, offset)))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc_id], pa.int64()), "ids": pa.array([ids.tolist()], pa.list_(pa.int32()))})

    order = F.xxhash64(F.lit(seed), "file", "offset")
    mixed = read_index(manifest).select("file", "offset", "length", order.alias("_o")).repartitionByRange(shuffle_parts(manifest.sparkSession), "_o")
    return mixed.sortWithinPartitions("_o").select("file", "offset", "length").mapInArrow(run, "doc_id bigint, ids array<int>")


def encoded(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    import public_tokenizers

    manifest = write_records(documents, public_tokenizers.path("word_bpe_49k.json"))
    return read_records(manifest, with_ids=False)


def op9_records(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"))
