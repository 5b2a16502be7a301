import random
import re

import numpy as np
import pyarrow as pa

from clickweave.llm import minhash as M


def _sets(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower) if x]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _brute(docs, size):
    sets = [_sets(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    low = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), low[find(i)], d == low[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def _case():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs = []
    for g in range(6):  # groups of near copies around the threshold, some large
        base = [word() for _ in range(rng.choice([6, 40, 90]))]
        for _ in range(rng.choice([2, 8, 30])):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 30)):
                w[rng.randrange(len(w))] = word()
            docs.append(" ".join(w))
    docs += [" ".join(word() for _ in range(30)) for _ in range(20)]
    docs += ["", None, "   ", "one", "One", "two words", docs[0], docs[0].upper(), None]
    rng.shuffle(docs)
    return [(i, t) for i, t in enumerate(docs)] + [(3, docs[3]), (None, docs[5]), (None, "alone and without an id here")]


def test_against_brute_force(spark, documents, monkeypatch):
    docs = _case()
    df = documents([(i, t, "s") for i, t in docs])
    for size, block in ((4, 1024), (5, 3)):  # small blocks: the second pass meets block against block
        monkeypatch.setattr(M, "BLOCK", block)
        got = sorted(map(tuple, M.near_duplicates(df, size=size).collect()), key=repr)
        assert got == _brute(docs, size)


def test_one_of_each_group_stays(spark, documents):
    docs = _case()
    df = documents([(i, t, "s") for i, t in docs]).selectExpr("*", "1 AS _group", "2 AS _n", "3 AS place", "4 AS row", "5 AS `a.b`")
    got = M.deduplicated(df)
    assert got.columns == df.columns
    brute = _brute(docs, 5)
    kept = {r[0] for r in brute if r[3] and r[0] is not None}
    ids = [r["doc_id"] for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(kept)
    assert M.deduplicated(documents([])).count() == 0


def test_sequential_bounds():
    least = M.min_matches()
    assert least == sorted(least) and len(least) == M.BANDS * M.ROWS // M.BATCH
    rng = np.random.default_rng(0)
    same = rng.random((4000, M.BANDS * M.ROWS)) < 0.8  # pairs of similarity 0.8
    a = rng.integers(0, 2**32, same.shape, dtype=np.uint32)
    assert M._passes(a, np.where(same, a, a + np.uint32(1)), least).mean() > 0.999
    far = rng.random((4000, M.BANDS * M.ROWS)) < 0.4
    assert M._passes(a, np.where(far, a, a + np.uint32(1)), least).mean() < 0.001


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sig = M.signatures(np.concatenate([x[:300], x[100:]]), np.array([0, 300, 600]))
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.15


def test_a_rejected_likeliest_partner_hides_no_other(spark, documents):
    """B looks most like A, the centre of every bucket they share, but only C is similar enough; B
    and C meet in no first pass."""
    rng = random.Random(60)
    w = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(130)]
    core, b, c, extra = w[:100], w[100:112], w[112:125], w[125:127]
    docs = [(0, " ".join(core + c[1:] + extra)), (1, " ".join(core + b)), (2, " ".join(core + c))]
    sig = [np.array(s) for s in M._sig_rows(pa.array([r["sig"] for r in M.shingle_sets(documents([(i, t, "s") for i, t in docs]), 1).orderBy("doc_id").collect()]))]
    assert (sig[1] == sig[0]).sum() > (sig[1] == sig[2]).sum()
    got = sorted(map(tuple, M.near_duplicates(documents([(i, t, "s") for i, t in docs]), size=1).collect()))
    assert got == _brute(docs, 1) and {r[2] for r in got} == {0}


def _thue_morse(n):
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_sums_of_powers_confuse(spark, documents):
    texts = [f"{w} one two three {w} four" for n in (512, 1024, 4096) for w in _thue_morse(n)]
    docs = list(enumerate(texts + texts[:1]))
    got = sorted(map(tuple, M.near_duplicates(documents([(i, t, "s") for i, t in docs])).collect()))
    assert got == _brute(docs, 5) and len({r[2] for r in got}) == 6


def test_exact_sets_by_brute_force():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("aAbcé") for _ in range(rng.randint(0, 9))) for _ in range(80)] + ["", " ", "a\x00 a", "a", "A  a"]
    for size in (1, 2, 5):
        names, off = M.exact_sets(texts, size)
        seen = {}
        for i, t in enumerate(texts):
            want, got = _sets(t, size), names[off[i] : off[i + 1]].tolist()
            assert len(got) == len(want) == len(set(got))
            seen[i] = (want, set(got))
        for i in seen:
            for j in seen:
                assert len(seen[i][0] & seen[j][0]) == len(seen[i][1] & seen[j][1])


def _below(n, seed=3):
    """``n`` near copies of one text, most of them somewhat less similar than the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rng.sample(range(len(w)), 11):
            w[k] = f"x{i}-{k}"
        out.append((i, " ".join(w)))
    return out


def test_rows_given_out_grow_with_the_members_not_their_pairs(spark, documents, monkeypatch):
    """Twice the near copies below the threshold: what tasks give out doubles, though pairs quadruple."""
    counts = {}
    for n in (60, 120):
        docs = _below(n)
        rows = []
        real = M.stage
        monkeypatch.setattr(M, "stage", lambda df, name, real=real, rows=rows: (lambda out: rows.append((name, out.count())) or out)(real(df, name)))
        got = sorted(map(tuple, M.near_duplicates(documents([(i, t, "s") for i, t in docs])).collect()), key=repr)
        monkeypatch.setattr(M, "stage", real)
        assert got == _brute(docs, 5)
        counts[n] = dict(rows)
        assert counts[n]["forest"] <= n * M.BANDS and counts[n]["likely"] <= n * M.BANDS
    for name in ("likely", "forest", "links", "star-ends"):
        assert counts[120][name] <= 2.6 * max(40, counts[60][name]), name


def test_signatures_of_sets_without_a_bucket_mate_stay(spark, documents, monkeypatch):
    rng = random.Random(5)
    text = [f"w{rng.randrange(10**9)}" for _ in range(60)]
    docs = [(0, " ".join(text)), (1, " ".join(text[:-1])), *((k, " ".join(f"v{rng.randrange(10**9)}" for _ in range(40))) for k in range(2, 30))]
    staged = {}
    real = M.stage
    monkeypatch.setattr(M, "stage", lambda df, name: staged.setdefault(name, real(df, name)) if name in ("buckets", "met") else real(df, name))
    monkeypatch.setattr(M, "release", lambda *frames: None)
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(documents([(i, t, "s") for i, t in docs]), size=4).collect()}
    assert got == {i: 0 if i == 1 else i for i, _ in docs}
    assert staged["buckets"].columns == ["key", "n"]
    assert staged["met"].count() == 2 and "sig" in staged["met"].columns
