import hashlib
import math
import random
import re

from clickweave.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _brute(text):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and P.luhn(d):
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]


def test_base_spans_by_their_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("0123456789" * 2 + "aB.@+- ()%_\né") for _ in range(rng.randint(0, 40)))
        assert P.base_spans(text) == _brute(text)
    assert P.luhn("4539578763621486") and not P.luhn("4539578763621487")


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "1." * 100_000, "a@" * 100_000):
        P.base_spans(text)


def test_marginals_by_enumeration():
    field, rng = P.SpanField(), random.Random(2)
    text = "a 12.3 +4"
    n, cuts, segs = field.lattice(text)
    for s in segs:
        for f in s[4]:
            field.weights[s[2], f] = rng.uniform(-1, 1)
    for p in range(5):
        for k in range(4):
            field.weights[k, f"after{p}"] = rng.uniform(-1, 1)
    field._scores.clear()
    n, cuts, segs = field.lattice(text)
    total, mass = 0.0, [0.0] * len(segs)

    def walk(at, last, score, used):
        nonlocal total
        if at == n:
            total += math.exp(score)
            for x in used:
                mass[x] += math.exp(score)
            return
        walk(at + 1, 0, score, used)
        for x, (i, j, k, s, _) in enumerate(segs):
            if i == at:
                walk(j, k + 1, score + s + field.weights[k, f"after{last}"], [*used, x])

    walk(0, 0, 0.0, [])
    z, each, _ = field.marginals(n, segs)
    assert segs and abs(z - math.log(total)) < 1e-9
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(each, mass, strict=True))


def _person(rng):
    card = [rng.randint(0, 9) for _ in range(15)]
    card.append(next(d for d in range(10) if P.luhn("".join(map(str, [*card, d])))))
    return {
        "email": f"{rng.choice('abc')}n.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
        "ip": ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": "".join(map(str, card)),
        "phone": f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}",
    }


def _docs(n, seed):
    rng = random.Random(seed)
    filler = lambda: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(rng.randint(3, 9)))
    noise = lambda: rng.choice(["version 4.0.", "in 1999,", "id 123456789", "token 9f86d081884c7d", "1.2.3", "999.1.1.1", "7 of 12"])
    return [(i, " ".join([filler(), rng.choice(list(_person(rng).values())), filler(), noise(), filler()]), "s") for i in range(n)]


def test_field_adds_what_the_patterns_miss(spark, documents):
    rows = _docs(400, 1)
    field = P.fit(documents(rows))
    p = _person(random.Random(9))
    for text, span in (
        (f"see {p['phone']} {p['ip']} there", (3, 4, 4 + len(p["phone"]))),  # the pattern runs on into the address
        (f"lorem {p['phone'][3:]} ipsum", (3, 6, 6 + len(p["phone"]) - 3)),  # no plus
    ):
        base = P.base_spans(text)
        assert span not in base and span in field.added(text, base)
    for _, text, _ in _docs(200, 2):
        clean = " ".join(w for w in text.split() if w.isalpha()) + " version 3.1 of 2024-05-06, item 123456789 and 12 more"
        assert field.added(clean, P.base_spans(clean)) == []


def test_rows(spark, documents):
    rows = [*_docs(60, 3), (100, None, "s"), (101, "", "s"), (0, _docs(1, 3)[0][1], "s"), (None, "a@b.cd", "s")]
    df = documents(rows)
    got = P.find(df, P.fit(df)).collect()
    assert len(got) == len(rows)
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, t)
    for r in got:
        base = _brute(texts[r["doc_id"]] or "")
        names = [f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[0] == i for x in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r["spans"].split(",")) or not names
    none = documents([])
    assert P.find(none, P.fit(none)).count() == 0
    plain = documents([(1, "no data", "s")])
    assert P.find(plain, P.fit(plain)).first()["spans"] == ""


def _field(seed=5):
    """A field of arbitrary weights, some of them large, so that spans are found."""
    field, rng = P.SpanField(), random.Random(seed)
    for text in ("12 345 678 9012 ", "+1 23.4.5.6 a@b.cd 4539 5787 6362 1486 ", "(555) 123-4567; n 12"):
        for i, j in P.segments(text, P.atoms(text)):
            for f in P.features(text, P.atoms(text)[i], P.atoms(text)[j]):
                for k in range(4):
                    field.weights[k, f] = rng.uniform(-1.2, 1.6)
    for p in range(5):
        for k in range(4):
            field.weights[k, f"after{p}"] = rng.uniform(-1, 1)
    return field


def test_windows_find_the_spans_of_the_whole_region(monkeypatch):
    field, rng = _field(), random.Random(6)
    found = 0
    monkeypatch.setattr(P, "CERTAIN", 0.2)
    for _ in range(30):
        text = "".join(rng.choice(["12", "345 ", "678-", "9012 ", "+1 ", ".", "a@b.cd ", "x ", "(555) ", "10.2.3.4 ", "4539578763621486 ", "\n"]) for _ in range(150))
        base = P.base_spans(text)
        monkeypatch.setattr(P, "WINDOW", 1 << 30)
        whole = sorted(field.added(text, base))
        found += len(whole)
        for window in (1, 7, 64):
            monkeypatch.setattr(P, "WINDOW", window)
            assert sorted(field.added(text, base)) == whole
    assert found > 100


def test_memory_does_not_grow_with_a_table_of_numbers(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(P, "WINDOW", 256)
    field, peak = _field(), {}
    for n in (100, 400):
        text = "12 345 678 9012 " * n
        base = P.base_spans(text)
        field.added(text[:1600], [])
        tracemalloc.start()
        field.added(text, base)
        peak[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert peak[400] < 30e6 and peak[400] < 1.5 * peak[100]
