"""Near-duplicates by one-permutation MinHash.

A text's set holds the hashes of its distinct runs of some words, three unless told otherwise. One permutation deals
the set to BINS bins and keeps the least hash of each; an empty bin borrows from a bin
that a hash of (bin, attempt) names, attempt after attempt, until it meets one that was
filled (optimal densification). Runs of bins make bands, and texts that share a band's
value meet in a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stewardry.llm.hashing import WORDS, TokenHasher, mixed

SHINGLE = 3
BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Links need `SHARED * union <= 100 * intersection`, unless told otherwise.
SHARED = 85

_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_sets(hashes: np.ndarray, begins: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and where each begins.

    Texts of fewer than `shingle` words (5 at most) have one shingle, the whole sequence.
    """
    words = np.diff(begins)
    text = np.repeat(np.arange(len(words)), words)
    n = len(hashes)
    whole = np.zeros(0, np.int64)
    if n >= shingle:
        whole = np.flatnonzero(text[:n - shingle + 1] == text[shingle - 1:])
    values = sum((hashes[whole + j] * _FACTORS[j] for j in range(shingle)), np.zeros(len(whole), np.uint64))
    owner = text[whole]
    few = np.flatnonzero((words > 0) & (words < shingle))
    if len(few):
        short = words[few].astype(np.uint64)
        for j in range(shingle - 1):
            nth = np.where(words[few] > j, hashes[np.minimum(begins[few] + j, n - 1)], np.uint64(0))
            short = short + nth * _FACTORS[j]
        values, owner = np.concatenate([values, short]), np.concatenate([owner, few])
    values = mixed(values)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(words) + 1))


def signatures(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """BINS least hashes per text, densified; texts without a shingle keep zeros."""
    sizes = np.diff(begins)
    out = np.zeros((len(sizes), BINS), np.uint64)
    filled = np.zeros((len(sizes), BINS), bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = mixed(values ^ np.uint64(0x5BF03635))  # the permutation
    bins = (place >> np.uint64(57)).astype(np.int64)
    order = np.lexsort((place, bins, owner))
    owner, bins, place = owner[order], bins[order], place[order]
    first = np.ones(len(place), bool)
    first[1:] = (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])
    out[owner[first], bins[first]] = place[first]
    filled[owner[first], bins[first]] = True
    rows, empty = np.nonzero(~filled & (sizes > 0)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        lender = (mixed(empty.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)
        found = filled[rows, lender]
        out[rows[found], empty[found]] = out[rows[found], lender[found]]
        rows, empty = rows[~found], empty[~found]
    return out


def band_values(signature: np.ndarray) -> np.ndarray:
    """BANDS values per text, each of ROWS bins and the band's number."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    value = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(ROWS):
        value = mixed(value * np.uint64(0x2545F4914F6CDD1D) + parts[:, :, j])
    return value
