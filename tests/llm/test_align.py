import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clickweave.llm import align as G

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: n for n, c in {n: c for c, n in G.byte_alphabet().items()}.items()}
    by_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        """The tokens of the whole text, as (id, begin, end) on either side; none if not whole."""
        if not text:
            return [], []
        out = []
        for ids, size in ((a.encode(" " + text, add_special_tokens=False).ids, by_a.__getitem__), (b.encode(text), piece)):
            at, tokens = 0, []
            for i in ids:
                tokens.append((i, at, at + len(size(i))))
                at += len(size(i))
            if b"".join(map(size, ids)) != (" " + text).encode():
                return [], []
            out.append(tokens)
        return tuple(out)

    return encode


def _brute(texts, encode):
    per, docs = [], defaultdict(set)
    for n, t in enumerate(texts):
        a, b = encode(t)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        for link in links:
            docs[link].add(n)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        said, begin = [], 0
        for end in ends:
            said.append("|".join(",".join(str(x[0]) for x in side if begin < x[2] <= end) for side in (a, b)))
            begin = end
        per.append((len(a), len(b), len(ends), links, hashlib.sha256(";".join(said).encode()).hexdigest() if a else ""))
    count = {k: len(v) for k, v in docs.items()}
    best = Counter()
    for (x, _), c in count.items():
        best[x] = max(best[x], c)
    return [(na, nb, ng, len(ls), sum(count[x] == best[x[0]] for x in ls), sum(count[x] for x in ls), s) for na, nb, ng, ls, s in per]


def _texts():
    rng = random.Random(5)
    odd = ["", None, " ", "  ", "a ", " a", "a  ", "\n", "a\n b", "a \n  b", "x\t y", "<|endoftext|>", "a <|endoftext|> b", "<s> </s><unk>", "<0x0A> x",
           "a▁b", "▁", "a  b", "　 x", "a\u0000b", "it's 've  'll", "é ́ x", "\U0001f600 中文 при", "a\u0085 b", "=" * 300, "    indent", "a.  B", "﻿x", "a\nb\n\nc", "\n", "x\n", "é\né \n", "中\n中 中", "\na"]
    alphabet = ["the", "word", " ", " ", "  ", "\n", "é", "中", "\t", "Ab", "12", "'s", ".", " ", " ", "-", "<", "|", "endoftext", "ß", "\r\n", "(", "​", "ing"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    return odd + made + made[:20] + ["the word " * 400]


def test_against_brute_force(spark, documents, sides, monkeypatch):
    texts = _texts()
    want = [(i, *x) for i, x in enumerate(_brute(texts + texts[-2:], sides))]
    rows = list(enumerate(texts)) + [(len(texts), texts[-2]), (None, texts[-1])]
    want[-1] = (None, *want[-1][1:])
    df = documents([(i, t, "s") for i, t in rows])
    for held, few in ((G.CACHE_BYTES, G.BROADCAST_ROWS), (10, 3)):  # also with a cache that is emptied all the time, and shuffled counts
        monkeypatch.setattr(G, "CACHE_BYTES", held)
        monkeypatch.setattr(G, "BROADCAST_ROWS", few)
        G._held.clear()
        got = G.cross_aligned(df, A, B)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_stretches_give_the_tokens_of_the_whole_text(sides):
    aligner = G.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = _texts()
    for t, got in zip(texts, aligner.align(texts), strict=True):
        a, b = sides(t)
        assert got[:2] == (len(a), len(b)), t


def test_jumping_ends_at_each_components_last_token():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        cut = lambda: np.append(np.flatnonzero(rng.random(n - 1) < rng.random()) + 1, n)  # noqa: B023, E731
        a, b = cut(), cut()
        both = np.intersect1d(a, b)
        label = G.components(a, b)
        assert a[label].tolist() == [both[np.searchsorted(both, e)] for e in [*a, *b]]
    assert G.jump(np.append(np.arange(1, 1 << 16), (1 << 16) - 1)).min() == (1 << 16) - 1


def test_empty_tables_and_texts_without_tokens(spark, documents):
    assert G.cross_aligned(documents([]), A, B).count() == 0
    got = G.cross_aligned(documents([(1, None, "s"), (2, "", None), (None, "▁", "s")]), A, B).collect()
    assert sorted((tuple(r)[1:] for r in got)) == [(0, 0, 0, 0, 0, 0, "")] * 3
