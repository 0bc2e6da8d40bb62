"""Words, their hashes and word shingles, vectorised over the texts of an Arrow batch."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker keeps; a full cache is emptied.
CACHE = 400_000
#: Multipliers of the positions of a shingle: odd and unrelated, so that no two orders of words agree.
POSITION = [np.uint64(xxhash.xxh64_intdigest(f"position {k}") | 1) for k in range(5)]
#: Bytes hashed at once, but for longer words.
PIECE = 1 << 20
#: The base of the words' polynomials, odd, and its inverse modulo 2**64.
BASE = xxhash.xxh64_intdigest("base") | 1
INVERSE = pow(BASE, -1, 1 << 64)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Hashes(dict):
    """Maps a word (bytes) to its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 100:
            self[word] = h
        return h


_hashes = Hashes()


def split(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, A-Z in lower case; bytes.split() splits at just these characters."""
    return text.encode().lower().split() if text else []


def byte_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of any strings of bytes, through a cache."""
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """hashed() of words that hold no blanks."""
    return _hashed(b" " + b" ".join(words) + b" ")[0]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """The first n powers of BASE and of INVERSE."""
    if len(_powers[0]) < n:
        n = max(n, PIECE)
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, INVERSE)):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of data, which starts and ends with a blank.

    A word's polynomial is a difference of running sums over its piece of data, divided by the power at its start."""
    buf = np.frombuffer(data, np.uint8)
    blank = BLANK[buf]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        up, down = _power(int(ends[b - 1] - low) + 1)
        with np.errstate(over="ignore"):
            part = buf[low : ends[b - 1]].astype(np.uint64)
            part += np.uint64(1)
            part *= up[: len(part)]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
            at, to = starts[a:b] - low, ends[a:b] - low
            out[a:b] = mix((total[to] - total[at]) * down[at])
        a = b
    return out, starts


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, as split() finds them, and where each text's begin (and the last end)."""
    parts = [t.encode().lower() if t else b"" for t in texts]
    out, starts = _hashed(b" " + b" ".join(parts) + b" ")
    begin = np.cumsum([1, *(len(x) + 1 for x in parts)])
    return out, np.searchsorted(starts, begin)


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(w: np.ndarray, width: int = 5) -> np.ndarray:
    """Of a text's word hashes, the sorted distinct shingles: of `width` words each; of fewer words, the whole
    sequence as one."""
    n = len(w)
    if not n:
        return w
    with np.errstate(over="ignore"):
        if n < width:
            return mix(np.array([(w * np.array(POSITION[:n])).sum() + np.uint64(n)], np.uint64))
        h = w[: n - width + 1] * POSITION[0]
        for k in range(1, width):
            h = h + w[k : n - width + 1 + k] * POSITION[k]
        h = mix(h)
        h.sort()
        return h[np.concatenate([[True], h[1:] != h[:-1]])]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """shingles() of each text."""
    w, first = hashed(texts)
    return [shingles(w[a:b]) for a, b in zip(first.tolist(), first[1:].tolist())]
