"""Word and window hashes of whole texts, computed with numpy inside tasks.

Texts arrive as UTF-8 bytes; words are what lies between U+0020 and U+0009 to U+000D, as ``bytes.split()`` parts them.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes that are hashed together: short texts in one go, long ones in parts.
PIECE = 1 << 18

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, *range(9, 14)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240301).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.of = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.of) < n:
            steps = np.full(max(n, 2 * len(self.of)), self.base, dtype=np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                self.of = np.multiply.accumulate(steps)
        return self.of[:n]


_POWERS = Powers(int(_M2))


def _piece(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data``, and where they start."""
    b = np.frombuffer(data, dtype=np.uint8)
    b = _LOWER[b] if lower else b
    inside = np.zeros(len(b) + 2, dtype=bool)
    np.take(_IS_WORD, b, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        letters = _VALUES[b[inside[1:-1]]] * _POWERS.upto(int(lengths.max()))[at]
        return mixed(np.add.reduceat(letters, first) + lengths.astype(np.uint64) * _M1), starts


def word_hashes(texts: list[bytes | None], lower: bool = False) -> list[np.ndarray]:
    """For each text the 64-bit hashes of its words; ``lower``: with A-Z lower-cased."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            hashes, starts = _piece(b"\n".join(held), lower)
            ends = np.cumsum([len(t) + 1 for t in held])
            out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
            held.clear()
            size = 0

    for text in texts:
        text = text or b""
        if len(text) > 4 * PIECE:
            flush()
            out.append(np.concatenate([_piece(p, lower)[0] for p in _parts(text)]))
            continue
        held.append(text)
        size += len(text)
        if size >= PIECE:
            flush()
    flush()
    return out


def _parts(text: bytes) -> list[bytes]:
    """A long text in parts that end between words (a longer word stays whole)."""
    out, at = [], 0
    while at < len(text):
        to = min(at + PIECE, len(text))
        while to < len(text) and _IS_WORD[text[to]]:
            to += 1
        out.append(text[at:to])
        at = to
    return out


def windows(h: np.ndarray, width: int, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each ``width`` consecutive values of ``h`` (an independent one if ``second``)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = int(_M2 if second else _M1)
    part = mixed(h ^ _M1) if second else h
    out, done, span = None, 0, 1
    with np.errstate(over="ignore"):
        while True:  # polynomial hashes of 1, 2, 4, ... values, put together by the binary digits of width
            if width & span:
                piece = part[done : done + n]
                out = piece.copy() if out is None else out * np.uint64(pow(base, span, 1 << 64)) + piece
                done += span
            span *= 2
            if span > width:
                return mixed(out)
            half = span // 2
            part = part[:-half] * np.uint64(pow(base, half, 1 << 64)) + part[half:]


def repeated(values: np.ndarray) -> np.ndarray | None:
    """Which values occur twice or more; None if none does."""
    s = np.sort(values)
    twice = s[1:] == s[:-1]
    return np.isin(values, s[1:][twice]) if twice.any() else None


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending; a shorter text is one shingle."""
    if not len(words):
        return words
    s = np.sort(windows(words, min(width, len(words))))
    return s[np.concatenate(([True], s[1:] != s[:-1]))]
