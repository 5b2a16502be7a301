import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweave.llm import records as R
from clickweave.llm import words as W

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["don't! can's. x'. '. 12.5, a1! É!! ÉA\u0301. H\u0331. h\u0331 ½. ²! x²! ١. foo… Bar”. A.B. U.S.!! ...", "plain H. h. HELLO, hello,", "Hello  World, it's <|endoftext|> a test", "", None, "É İ Σας\x00 \x00 x\x0by\x1cz", "née é ́", "word " * 3000, "x" * 5000, " \n "]


def test_words_encode_as_whole_texts():
    encoder, whole = R.WordEncoder(open(PATH).read()), Tokenizer.from_file(PATH)
    for _ in range(2):  # the second time from the cache
        ids, off = encoder.encode(pa.array(TEXTS, pa.string()))
        for k, t in enumerate(TEXTS):
            assert ids[off[k] : off[k + 1]].tolist() == [*whole.encode(t or "", add_special_tokens=False).ids, 1]


def test_added_tokens_are_told_from_other_spellings():
    whole = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|> a", "b <|EndOfText|>", "c<|endoftext|>.", "C<|ENDOFTEXT|>.", "<|EndOfText|>", "<|endoftext|>"]
    for order in (texts, texts[::-1]):
        for batches in ([order], [[t] for t in order]):
            encoder = R.WordEncoder(open(PATH).read())
            for batch in batches:
                ids, off = encoder.encode(pa.array(batch))
                for k, t in enumerate(batch):
                    assert ids[off[k] : off[k + 1]].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 1]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(R, "CACHE_PIECES", 5)
    encoder = R.WordEncoder(open(PATH).read())
    for i in range(20):
        ids, off = encoder.encode(pa.array([f"a b c{i} d{i}"]))
        assert encoder.n <= 10


def _thue_morse(n):
    """Two words of ``n`` letters that every sum of powers modulo 2^64 confuses."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_share_a_hash_keep_their_ids(monkeypatch):
    whole = Tokenizer.from_file(PATH)
    texts = [w for n in (512, 1024, 2048, 4096) for w in _thue_morse(n)] + ["abcdefgh", "abcdefghi", "abcdefghj", "b", "a"]
    ways = [W.span_hashes, lambda view, begin, end: (end - begin).astype(np.uint64) % np.uint64(3)]  # the second one: a poor hash
    for way in ways:
        monkeypatch.setattr(W, "span_hashes", way)
        for batches in ([texts], [[t] for t in texts], [[" ".join(texts)], texts[::-1]]):
            encoder = R.WordEncoder(open(PATH).read())
            for batch in batches:
                ids, off = encoder.encode(pa.array(batch))
                for k, t in enumerate(batch):
                    assert ids[off[k] : off[k + 1]].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 1]


def test_frames():
    raw = R.frame(-7, np.array([1, 65535], np.uint32), 2) + R.frame(None, np.array([70_000], np.uint32), 4)
    stream = io.BytesIO(raw)
    a, b = R.read_record(stream), R.read_record(stream)
    assert (a[0], a[1].tolist(), b[0], b[1].tolist()) == (-7, [1, 65535], None, [70_000])
    assert R.read_record(stream) is None
    for i in range(len(raw)):
        broken = bytearray(raw)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            s = io.BytesIO(bytes(broken))
            R.read_record(s), R.read_record(s)
    with pytest.raises(ValueError):
        R.read_record(io.BytesIO(raw[:20]))


def test_round_trip(spark, documents):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, "again", "s"), (3, "again", "s"), (None, "no id", "s"), (-5, "negative", "s")]
    df = documents(rows)
    manifest = R.write_records(df, PATH)
    got = R.read_records(manifest).orderBy("start").collect()
    whole = Tokenizer.from_file(PATH)
    ids = {}
    for d, t, _ in rows:
        ids.setdefault(d, []).append([*whole.encode(t or "", add_special_tokens=False).ids, 1])
    assert [r["doc_id"] for r in got] == sorted((d for d, *_ in rows), key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == at and r["n_tokens"] == len(own) and own in ids[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        at += len(own)
    index = R.read_index(manifest)
    assert index.count() == len(rows)
    mixed = R.read_shuffled(manifest, seed=1)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in got)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in mixed.collect()) == want
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)


def test_empty(spark, documents):
    assert R.read_records(R.write_records(documents([]), PATH)).count() == 0


def test_kept_pieces_are_bounded_in_bytes_too(monkeypatch):
    monkeypatch.setattr(R, "CACHE_BYTES", 1 << 16, raising=False)
    encoder, whole = R.WordEncoder(open(PATH).read()), Tokenizer.from_file(PATH)
    for k in range(8):
        texts = [f"{k}é{i}" + "ab9é" * 1000 for i in range(8)]  # pieces of 5 KB, few of them
        ids, off = encoder.encode(pa.array(texts, pa.string()))
        assert encoder.cuts[encoder.n] < (1 << 16) + sum(len(t.encode()) for t in texts)
        assert ids[off[0] : off[1]].tolist() == [*whole.encode(texts[0], add_special_tokens=False).ids, 1]


def test_many_new_pieces_keep_their_order(monkeypatch):
    monkeypatch.setattr(R, "_AT_ONCE", 7)
    encoder, whole = R.WordEncoder(open(PATH).read()), Tokenizer.from_file(PATH)
    text = " ".join(f"w{i}é q{i * 37}. zz" for i in range(50))
    ids, off = encoder.encode(pa.array([text, None, text], pa.string()))
    for k, t in enumerate([text, "", text]):
        assert ids[off[k] : off[k + 1]].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 1]
