"""Word hashes of whole texts, in bulk: a batch's UTF-8 bytes are scanned as one numpy array.

Words are runs of bytes outside a separator set that holds only ASCII bytes, so they never cut a
code point. A text of any length is scanned in pieces cut at separators; what stays is eight bytes
a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: Odd multipliers of the hashes (arbitrary but fixed).
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but digits and letters.
PUNCT = np.zeros(256, bool)
PUNCT[:128] = [not chr(i).isalnum() for i in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: What a load of eight bytes keeps of a span of 0 .. 8 bytes.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Spans of more bytes are hashed one by one.
_LONG = 1 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


def padded(raw: np.ndarray) -> np.ndarray:
    """``raw`` with eight zeros after it, for ``heads``."""
    return np.concatenate([raw, np.zeros(8, np.uint8)])


def heads(view: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first eight bytes of spans of ``view`` (padded), as numbers; zeros after shorter ones."""
    load = np.ndarray((len(view) - 7,), "<u8", view, strides=(1,))
    return load[begin] & _KEEP[np.minimum(size, 8)]


def span_hashes(view: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [begin, end) of ``view`` (padded): eight at a time are scrambled into the
    hash, so that no sums of powers cancel; a span of up to eight has a hash of its own among those of its
    length."""
    size = end - begin
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) * BASE)
        h = mix(h ^ heads(view, begin, size))
        at = np.flatnonzero((size > 8) & (size <= _LONG))
        done = 8
        while len(at):
            h[at] = mix((h[at] + MIX1) ^ heads(view, begin[at] + done, size[at] - done))
            done += 8
            at = at[size[at] > done]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(view[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


class Scan:
    """The words of one piece; a text begins at each of ``starts``. ``first``, ``last``: places of
    their first and last bytes."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, sep: np.ndarray):
        n, self.raw = len(raw), raw
        word = ~sep[raw]
        cut = np.zeros(n + 1, bool)
        cut[starts] = True
        cut[n] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:] = word[:-1]
        after[:-1] = word[1:]
        self.first = np.flatnonzero(word & (~before | cut[:n]))
        self.last = np.flatnonzero(word & (~after | cut[1:]))
        self._view = None

    def span_hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the lower-cased (A-Z) bytes [begin, end)."""
        if self._view is None:
            self._view = padded(LOWER[self.raw])
        return span_hashes(self._view, begin, end)

    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.first, self.last + 1)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    col = col.cast(pa.large_string()).fill_null("")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if off and len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def groups(off: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive rows [i, j) of at most ``limit`` bytes together, a longer row alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def scans(raw: np.ndarray, off: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int, list[Scan], np.ndarray]]:
    """For groups of rows [i, j): (i, j, scans, where each row begins in the scan). A long row comes
    alone, as scans of its pieces."""
    for i, j in groups(off):
        if j - i == 1 and off[j] - off[i] > PIECE:
            yield i, j, long_pieces(raw[off[i] : off[j]], sep), np.zeros(1, np.int64)
        else:
            starts = off[i:j] - off[i]
            yield i, j, [Scan(raw[off[i] : off[j]], starts, sep)], starts


def word_hashes(raw: np.ndarray, off: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For groups of rows [i, j): (i, j, hashes of their words in order, offsets of each row's words)."""
    for i, j, parts, starts in scans(raw, off, sep):
        if j - i == 1:
            hashes = np.concatenate([p.hashes() for p in parts])
            yield i, j, hashes, np.array([0, len(hashes)])
        else:
            (part,) = parts
            yield i, j, part.hashes(), np.append(np.searchsorted(part.first, starts), len(part.first))


def long_pieces(text: np.ndarray, sep: np.ndarray) -> Iterator[Scan]:
    """The scans of one long text, cut at separators (a longer run without one stays whole)."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not sep[text[end - 1]]:
            gap = np.flatnonzero(sep[text[end : end + PIECE]])
            end = min(len(text), end + int(gap[0]) + 1 if len(gap) else end + PIECE)
        yield Scan(text[at:end], np.zeros(1, np.int64), sep)
        at = end


def shingle_hashes(words: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the runs of ``size`` words, offsets per row); a shorter row that has words is one run."""
    with np.errstate(over="ignore"):
        weights = [mix(np.uint64(i + 1) * BASE) | np.uint64(1) for i in range(size)]
        n = np.diff(off)
        count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        out_off = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(int(out_off[-1]), np.uint64)
        full = n >= size
        if full.any():
            total = np.zeros(max(0, len(words) - size + 1), np.uint64)
            for i in range(size):
                total += words[i : len(words) - size + 1 + i] * weights[i]
            take = np.repeat(off[:-1][full] - out_off[:-1][full], count[full]) + _ranges(out_off[:-1][full], count[full])
            out[_ranges(out_off[:-1][full], count[full])] = total[take] + np.uint64(size)
        for r in np.flatnonzero(~full & (n > 0)):
            w = words[off[r] : off[r + 1]]
            out[out_off[r]] = sum((x * y for x, y in zip(w, weights, strict=False)), np.uint64(0)) + np.uint64(len(w))
        return mix(out), out_off


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0].., start[1].., ... with count[i] numbers each."""
    total = int(count.sum())
    step = np.ones(total, np.int64)
    keep = count > 0
    start, count = start[keep], count[keep]
    if total == 0:
        return step
    at = np.concatenate([[0], np.cumsum(count)[:-1]])
    step[at] = start - np.concatenate([[0], start[:-1] + count[:-1] - 1])
    return np.cumsum(step)
