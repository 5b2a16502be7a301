"""Personal data by a semi-Markov conditional random field over whole spans.

Base spans of four kinds are found by fixed patterns and always kept. Around digits and at-signs a
text is cut into regions and atoms (runs of digits, of letters, single other characters). A segment
is a run of at most ``LONGEST`` atoms; its features look at the whole span: shape, number and
grouping of digits, check digit, address parts, what stands before and after. Kinds and boundaries
of a region are chosen jointly by dynamic programming over segments with bounded length; a segment
is added if its marginal probability reaches ``CERTAIN`` and it overlaps no base span.

The field is fitted by exact gradients on regions of a bounded sample (``SAMPLE`` documents by hash,
at most ``REGIONS`` regions), with base spans as labels, and on copies of them in spellings that the
patterns miss (a phone number without its plus and country, a card number with dots), so that the
span features rather than the literal pattern carry the weight.

Whole texts are read; work is linear in their length. A region is as long as its digits go on (a table of
numbers may be one region): beyond ``WINDOW`` atoms the sums run forwards once, keeping a row at each window's
beginning, then backwards window by window, so that memory does not grow with the segments. Defined results: null or empty texts have no
spans; repeated rows each get their row; a table without personal data fits nothing and adds
nothing; extra columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import ship_code, table

KINDS = ("email", "ip", "card", "phone")
LONGEST, CERTAIN = 20, 0.9
SAMPLE, REGIONS, EPOCHS, RATE, L2 = 20_000, 1500, 6, 0.3, 1e-3
_AROUND, _KEPT_SCORES = 24, 50_000
#: Atoms of a region that are held at once; longer regions go through in windows.
WINDOW = 2048

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7F]+|[\x00-\x7F]")
_DIGITS = re.compile(r"[^0-9]+")
_RUN = re.compile(r"[0-9]+")
_ASCII_WORD = re.compile(r"([A-Za-z]+)[ :]*$")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), kinds in order, leftmost non-overlapping within a kind."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and at-signs."""
    begin = end = -1
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - _AROUND), min(len(text), m.end() + _AROUND)
        if a <= end:
            end = b
        else:
            if end >= 0:
                yield begin, end
            begin, end = a, b
    if end >= 0:
        yield begin, end


def atoms(text: str) -> list[int]:
    """Places where atoms begin, and the end."""
    return [m.start() for m in _ATOM.finditer(text)] + [len(text)]


def _starts(text: str, lo: int, hi: int) -> Iterator[int]:
    """Places where the atoms of a region begin."""
    return (m.start() for m in _ATOM.finditer(text, lo, hi))


def _class(c: str) -> str:
    if not c:
        return "edge"
    if c.isdigit():
        return "digit"
    if c.isalpha():
        return "letter"
    return "space" if c.isspace() else c


def segments(text: str, cuts: list[int]) -> Iterator[tuple[int, int]]:
    """(first atom, end atom) of the segments that may be entities: of digits and separators, or
    around one at-sign without space."""
    n = len(cuts) - 1
    kinds = [_class(text[cuts[i]]) for i in range(n)]
    for i in range(n):
        if not (kinds[i] in ("digit", "letter") or text[cuts[i]] in "+("):
            continue
        signs, digits = 0, False
        letters = False
        for j in range(i, min(n, i + LONGEST)):
            c, k = text[cuts[j]], kinds[j]
            if k == "letter":
                letters = True
            elif k == "digit":
                digits = True
            elif c == "@":
                signs += 1
            elif c not in " ().-+_%":
                break
            if signs > 1 or (k == "space" and (letters or signs or c != " ")):
                break
            if letters and not signs and not _at_follows(text, cuts, j, n):
                break
            if k in ("digit", "letter") and (signs == 1 and text[cuts[i]] != "(" if letters or signs else digits):
                yield i, j + 1


def _at_follows(text: str, cuts: list[int], j: int, n: int) -> bool:
    for x in range(j, min(n, j + LONGEST)):
        c = text[cuts[x]]
        if c == "@":
            return True
        if c.isspace():
            return False
    return False


def features(text: str, a: int, b: int) -> tuple[str, ...]:
    """Features of the span [a, b), without its kind."""
    s = text[a:b]
    before, after = _class(text[a - 1 : a]), _class(text[b : b + 1])
    m = _ASCII_WORD.search(text, max(0, a - 16), a)
    out = ["bias", f"<{before}", f">{after}", f"w{m[1].lower()}" if m else "w"]
    if "@" in s:
        domain = s.rpartition("@")[2]
        return (*out, "@", f"labels{min(3, domain.count('.'))}", f"tld{domain.rpartition('.')[2].isalpha()}", f"end{s[-1].isalnum()}")
    digits = _DIGITS.sub("", s)
    groups = _RUN.findall(s)
    marks = _RUN.sub("", s)
    out += [f"n{len(digits)}", f"g{len(groups)}", f"marks{marks if len(marks) < 8 else len(marks)}", f"plus{s[0] == '+'}", f"paren{'(' in s and ')' in s}"]
    out.append("shape" + _RUN.sub(lambda x: str(min(9, len(x[0]))), s)[:24])
    if groups and len(groups[-1]) == 4 and len(groups) > 1 and len(groups[-2]) == 3:
        out.append("tail3-4")
    if len(digits) >= 13:
        out.append(f"luhn{luhn(digits)}{16 <= len(digits) <= 19}")
    if len(groups) == 4 and marks == "...":
        out.append(f"octets{all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    return tuple(out)


def _add(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


class SpanField:
    """Weights of (kind, feature) and of (label before, kind); label 0 is text outside."""

    def __init__(self):
        self.weights: dict[tuple[int, str], float] = defaultdict(float)
        self.steps: dict[tuple[int, str], float] = defaultdict(float)
        self._scores: dict[tuple[str, ...], list[float]] = {}

    def __getstate__(self):
        return dict(self.weights)

    def __setstate__(self, weights):
        self.__init__()
        self.weights.update(weights)

    def scores(self, found: tuple[str, ...]) -> list[float]:
        got = self._scores.get(found)
        if got is None:
            w = self.weights
            got = [sum(w.get((k, f), 0.0) for f in found) for k in range(len(KINDS))]
            if len(self._scores) >= _KEPT_SCORES:
                self._scores.clear()
            self._scores[found] = got
        return got

    def lattice(self, text: str, free: list[tuple[int, int]] | None = None):
        """(number of atoms, cuts, [(i, j, kind, score, features)])."""
        cuts = atoms(text)
        out = []
        for i, j in segments(text, cuts):
            if free is not None and any(cuts[i] < e and s < cuts[j] for s, e in free):
                continue
            found = features(text, cuts[i], cuts[j])
            mail = "@" in found
            for k, score in enumerate(self.scores(found)):
                if (k == 0) == mail:
                    out.append((i, j, k, score, found))
        return len(cuts) - 1, cuts, out

    def marginals(self, n: int, segs: list) -> tuple[float, list[float], dict]:
        """(log of the sum over all segmentations, marginal of each segment, marginals of label
        pairs), by dynamic programming forwards and backwards over (place, label)."""
        labels = len(KINDS) + 1
        move = [[self.weights.get((k, f"after{p}"), 0.0) for k in range(len(KINDS))] for p in range(labels)]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for x, (i, j, *_) in enumerate(segs):
            ending[j].append(x)
            starting[i].append(x)
        none = -math.inf
        fore = [[none] * labels for _ in range(n + 1)]
        fore[0][0] = 0.0
        for at in range(1, n + 1):
            row = fore[at]
            row[0] = _add(fore[at - 1])
            per: dict[int, list[float]] = {}
            for x in ending[at]:
                i, _, k, score, _ = segs[x]
                per.setdefault(k + 1, []).append(score + _add([fore[i][p] + move[p][k] for p in range(labels)]))
            for lab, values in per.items():
                row[lab] = _add(values)
        back = [[0.0] * labels for _ in range(n + 1)]
        for at in range(n - 1, -1, -1):
            into = [(segs[x][2], segs[x][3] + back[segs[x][1]][segs[x][2] + 1]) for x in starting[at]]
            for p in range(labels):
                back[at][p] = _add([back[at + 1][0], *[v + move[p][k] for k, v in into]])
        total = _add(fore[n])
        each, pairs = [], defaultdict(float)
        for i, j, k, score, _ in segs:
            mass = 0.0
            for p in range(labels):
                v = fore[i][p] + move[p][k] + score + back[j][k + 1] - total
                if v > -30:
                    pairs[p, k] += math.exp(v)
                    mass += math.exp(v)
            each.append(mass)
        return total, each, pairs

    def learn(self, text: str, gold: list[tuple[int, int, int]], rate: float, l2: float) -> None:
        """One step along the gradient of the log-likelihood of ``gold`` (kind, start, end)."""
        n, cuts, segs = self.lattice(text)
        _, each, pairs = self.marginals(n, segs)
        grad: dict[tuple[int, str], float] = defaultdict(float)
        want = {(a, b, k) for k, a, b in gold}
        for (i, j, k, _, found), mass in zip(segs, each, strict=True):
            d = ((cuts[i], cuts[j], k) in want) - mass
            if abs(d) > 1e-6:
                for f in found:
                    grad[k, f] += d
        for (p, k), mass in pairs.items():
            grad[k, f"after{p}"] -= mass
        last_end, last = -1, 0
        for a, b, k in sorted(want):
            grad[k, f"after{last + 1 if a == last_end else 0}"] += 1.0
            last_end, last = b, k
        for key, g in grad.items():
            g -= l2 * self.weights[key]
            self.steps[key] += g * g
            self.weights[key] += rate * g / math.sqrt(self.steps[key] + 1e-8)
        self._scores.clear()

    def _in_windows(self, text: str, lo: int, hi: int, cuts: array, fixed: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """``added`` for one long region [lo, hi) whose atoms begin at ``cuts``: the same sums, with the rows of
        one window of atoms at a time. The region stands alone: nothing beside it is looked at."""
        part = text[lo:hi]
        n, labels = len(cuts), len(KINDS) + 1
        cuts = array("q", (c - lo for c in cuts))
        cuts.append(hi - lo)
        reach = list(itertools.accumulate((b for _, b in fixed), max))  # farthest end so far
        move = [[self.weights.get((k, f"after{p}"), 0.0) for k in range(len(KINDS))] for p in range(labels)]

        def window(first: int) -> list[list[tuple[int, int, float]]]:
            """(end, kind, score) of the segments that begin at each atom of the window."""
            last = min(n, first + WINDOW)
            some = cuts[first : min(n, last + 2 * LONGEST) + 1].tolist()
            near, far = bisect.bisect_right(reach, lo + some[0]), bisect.bisect_left(fixed, (lo + some[-1], 0))
            taken = [a - lo for a, _ in fixed[near:far]]
            upto = [b - lo for b in itertools.accumulate((b for _, b in fixed[near:far]), max)]
            found: list[list[tuple[int, int, float]]] = [[] for _ in range(last - first)]
            for i, j in segments(part, some):
                if i >= last - first:
                    break
                a, b = some[i], some[j]
                x = bisect.bisect_left(taken, b)
                if x and upto[x - 1] > a:  # overlaps a base span
                    continue
                spans = features(part, a, b)
                mail = "@" in spans
                for k, score in enumerate(self.scores(spans)):
                    if (k == 0) == mail:
                        found[i].append((first + j, k, score))
            return found

        def forwards(first: int, row: list[float], ahead: dict, found: list) -> tuple[list[list[float]], list[float], dict]:
            """The rows of the window, the row after it and what its segments leave to later places."""
            ahead, rows = {at: {k: list(v) for k, v in kinds.items()} for at, kinds in ahead.items()}, []
            for i, segs in enumerate(found):
                rows.append(row)
                into = {}
                for j, k, score in segs:
                    if k not in into:
                        into[k] = _add([row[p] + move[p][k] for p in range(labels)])
                    ahead.setdefault(j, {}).setdefault(k, []).append(score + into[k])
                new = [_add(row), *[-math.inf] * len(KINDS)]
                for k, values in ahead.pop(first + i + 1, {}).items():
                    new[k + 1] = _add(values)
                row = new
            return rows, row, ahead

        row, ahead, kept, likely = [0.0, *[-math.inf] * len(KINDS)], {}, [], False
        for first in range(0, n, WINDOW):
            kept.append((row, ahead))
            found = window(first)
            likely = likely or any(score >= 0 for segs in found for _, _, score in segs)
            _, row, ahead = forwards(first, row, ahead, found)
        if not likely:
            return []
        total = _add(row)
        out, back = [], {n: [0.0] * labels}
        for first in reversed(range(0, n, WINDOW)):
            found = window(first)
            rows, _, _ = forwards(first, *kept.pop(), found)
            for i in range(len(found) - 1, -1, -1):
                into = [(k, score + back[j][k + 1]) for j, k, score in found[i]]
                back[first + i] = [_add([back[first + i + 1][0], *[v + move[p][k] for k, v in into]]) for p in range(labels)]
                for j, k, score in found[i]:
                    mass = sum(math.exp(v) for p in range(labels) if (v := rows[i][p] + move[p][k] + score + back[j][k + 1] - total) > -30)
                    if mass >= CERTAIN:
                        out.append((k, lo + cuts[first + i], lo + cuts[j]))
            back = {at: back[at] for at in range(first, min(n, first + 2 * LONGEST) + 1)}
        return out

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of one text that the field adds to ``base``."""
        out = []
        fixed = sorted((a, b) for _, a, b in base)
        at = 0
        for lo, hi in regions(text):
            if hi - lo > WINDOW and len(cuts := array("q", _starts(text, lo, hi))) > WINDOW:
                out += self._in_windows(text, lo, hi, cuts, fixed)
                continue
            while at < len(fixed) and fixed[at][1] <= lo:
                at += 1
            here, x = [], at
            while x < len(fixed) and fixed[x][0] < hi:
                here.append((fixed[x][0] - lo, fixed[x][1] - lo))
                x += 1
            part = text[lo:hi]
            n, cuts, segs = self.lattice(part, here)
            if not segs or max(s[3] for s in segs) < 0:
                continue
            _, each, _ = self.marginals(n, segs)
            out += [(k, lo + cuts[i], lo + cuts[j]) for (i, j, k, _, _), mass in zip(segs, each, strict=True) if mass >= CERTAIN]
        return out


def _respelled(text: str, gold: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]] | None:
    """The region with its only span in a spelling that the patterns miss."""
    if len(gold) != 1 or gold[0][0] < 2:
        return None
    k, a, b = gold[0]
    if k == 2:
        digits = _DIGITS.sub("", text[a:b])
        new = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    else:
        m = re.match(r"\+[0-9]{1,3}[ .-](.*)", text[a:b])
        if not m or len(_DIGITS.sub("", m[1])) < 9:
            return None
        new = m[1]
    return text[:a] + new + text[b:], [(k, a, a + len(new))]


def fit(documents: DataFrame, *, sample: int = SAMPLE, limit: int = REGIONS, epochs: int = EPOCHS) -> SpanField:
    """Fit a field on regions of a bounded sample of ``documents`` (doc_id, text)."""
    ship_code(documents.sparkSession)
    n, buckets = documents.count(), 1 << 30

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: set[str] = set()
            for text in b.column(0).to_pylist():
                found.update(text[lo:hi] for lo, hi in regions(text or "") if hi - lo <= 120)
            yield pa.RecordBatch.from_pydict({"region": pa.array(sorted(found), pa.string())})

    chosen = documents.where(F.pmod(F.xxhash64("text"), F.lit(buckets)) < int(min(1.0, sample / max(1, n)) * buckets))
    found = chosen.select("text").mapInArrow(run, "region string").distinct()
    rows = found.orderBy(F.xxhash64("region"), "region").limit(limit).collect()  # ``limit`` short strings

    field, training = SpanField(), []
    for r in rows:
        text = r["region"]
        gold = base_spans(text)
        ends = set(atoms(text))
        spans = sorted((a, b) for _, a, b in gold)
        if any(a not in ends or b not in ends for a, b in spans) or any(x[1] > y[0] for x, y in zip(spans, spans[1:], strict=False)):
            continue  # labels that no segmentation can hold
        training.append((text, gold))
        if (more := _respelled(text, gold)) is not None:
            training.append(more)
    if any(gold for _, gold in training):
        for epoch in range(epochs):
            for text, gold in training:
                field.learn(text, gold, RATE / (1 + epoch), L2)
    return field


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(documents: DataFrame, field: SpanField) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added)."""
    ship_code(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(field)  # weights fitted on a bounded sample
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for b in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans = [], []
            for value in b.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                for k, c in enumerate(counts):
                    c.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(_named(base).encode()).hexdigest())
                spans.append(_named(base + model.added(text, base)) if model.weights else _named(base))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string())], names=names
            )

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")


def op8_semicrf(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return find(documents, fit(documents))
