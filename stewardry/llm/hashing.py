"""64-bit hashes of all tokens of a batch of texts, without a Python step per token.

A token's hash is a polynomial in an odd base modulo 2**64 over its bytes, taken from
differences of one running sum over all bytes, and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once; a longer text is cut between tokens.
CHUNK = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: byte -> byte with A-Z lowered
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A"):ord("Z") + 1] += 32

#: byte -> 0 for the white space \x20 \x09-\x0D, else 1: words are what stands between
WORDS = np.ones(256, np.uint8)
WORDS[[0x20, *range(0x09, 0x0E)]] = 0

#: the same with marks (ASCII punctuation and control) apart from letters, digits and other bytes
WORDS_AND_MARKS = WORDS.copy()
WORDS_AND_MARKS[[b for b in range(128) if not chr(b).isalnum() and chr(b) not in " \t\n\x0b\x0c\r_"]] = 2


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class TokenHasher:
    """Hashes of the tokens of texts, tokens being runs of bytes of one class but 0."""

    def __init__(self, classes: np.ndarray = WORDS, chunk: int = CHUNK):
        self._classes, self._chunk = classes, chunk
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grown(self, n: int) -> None:
        if len(self._powers) <= n:
            size = max(n + 1, min(2 * len(self._powers), self._chunk + 1))
            for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _hash(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all tokens in `data`, and where each text's begin; offsets from 0 to len(data)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        self._grown(n)
        kind = self._classes[data]
        edge = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
        edge[offsets] = True
        at = np.flatnonzero(edge)
        runs = kind[at[:-1]] != 0
        starts, ends = at[:-1][runs], at[1:][runs]
        sums = np.zeros(n + 1, np.uint64)
        np.add(LOWER[data], np.uint64(1), out=sums[1:])
        sums[1:] *= self._powers[:n]
        np.cumsum(sums, out=sums)
        hashes = mixed((sums[ends] - sums[starts]) * self._inverses[starts])
        return hashes, np.searchsorted(starts, offsets)

    def _long(self, data: np.ndarray) -> np.ndarray:
        parts, lo = [], 0
        while lo < len(data):
            hi = min(len(data), lo + self._chunk)
            while hi < len(data):
                white = np.flatnonzero(self._classes[data[lo:hi]] == 0)
                if len(white):
                    hi = lo + int(white[-1]) + 1
                    break
                hi = min(len(data), hi + self._chunk)
            parts.append(self._hash(data[lo:hi], np.array([0, hi - lo]))[0])
            lo = hi
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def of_texts(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(lo, hi, hashes, begins) for successive ranges of texts; text lo + i has the
        hashes begins[i] to begins[i + 1]. Nulls are empty."""
        texts = pc.fill_null(texts, "")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, places, bytes_ = texts.buffers()
        if len(texts) == 0:
            return
        offsets = np.frombuffer(places, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + self._chunk, side="right")) - 1)
            part = data[offsets[lo]:offsets[hi]]
            if hi == lo + 1 and len(part) > self._chunk:
                hashes = self._long(part)
                yield lo, hi, hashes, np.array([0, len(hashes)])
            else:
                hashes, begins = self._hash(part, offsets[lo:hi + 1] - offsets[lo])
                yield lo, hi, hashes, begins
            lo = hi
