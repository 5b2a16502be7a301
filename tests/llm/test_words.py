import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from clickweave.llm import words as W


def _words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]


def _hashed(texts):
    raw, off = W.text_bytes(pa.array(texts, pa.string()))
    rows = []
    for i, j, h, at in W.word_hashes(raw, off, W.SPACE):
        rows += [h[at[r] : at[r + 1]].tolist() for r in range(j - i)]
    return rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbBé \t\n.x", max_size=30)), min_size=1, max_size=12))
def test_hashes_are_those_of_lower_cased_words(texts):
    seen = {}
    for text, got in zip(texts, _hashed(texts), strict=True):
        want = _words(text)
        assert len(got) == len(want)
        for w, h in zip(want, got, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    texts = ["ab " * 500, "x" * 3000 + " y z", "", None, "é" * 900 + " é"]
    whole = _hashed(texts)
    monkeypatch.setattr(W, "PIECE", 64)
    assert _hashed(texts) == whole


def test_shingles_by_brute_force():
    rng = np.random.default_rng(1)
    counts = [0, 1, 3, 4, 5, 20, 0, 2]
    off = np.concatenate([[0], np.cumsum(counts)])
    words = rng.integers(0, 5, off[-1]).astype(np.uint64)
    got, at = W.shingle_hashes(words, off, 4)
    seen = {}
    for r, n in enumerate(counts):
        w = words[off[r] : off[r + 1]].tolist()
        want = [tuple(w[i : i + 4]) for i in range(n - 3)] if n >= 4 else [tuple(w)] * (n > 0)
        hashes = got[at[r] : at[r + 1]].tolist()
        assert len(hashes) == len(want)
        for s, h in zip(want, hashes, strict=True):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_no_two_words_of_a_kind_that_sums_of_powers_confuse():
    for n in (8, 64, 512, 1024, 2048, 4096, 1 << 16):
        bits = [bin(i).count("1") & 1 for i in range(n)]
        a, b = ("".join(x[i] for i in bits) for x in ("ab", "ba"))
        ((x,), (y,), (z,)) = _hashed([a, b, a.upper()])
        assert x != y and x == z


def test_span_hashes_depend_on_all_bytes_and_the_length():
    rng = np.random.default_rng(3)
    raw = rng.integers(0, 3, 5000).astype(np.uint8)
    begin = rng.integers(0, 3900, 4000)
    end = begin + np.concatenate([rng.integers(0, 40, 3900), rng.integers(1000, 1100, 100)])
    seen = {}
    for a, b, h in zip(begin, end, W.span_hashes(W.padded(raw), begin, end).tolist(), strict=True):
        assert seen.setdefault(raw[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
