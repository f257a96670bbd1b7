"""Hashes of words and word shingles, whole batches of documents at a time in numpy.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower case. Its
hash is a polynomial modulo 2^64 over a random value per byte, mixed afterwards. All
functions take documents as one byte array with offsets, and keep results ragged: one
flat array and the number of entries of each document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
_VALUE = np.where(_IN_WORD, np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64)[_LOWER], np.uint64(0))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an array of strings; a null is empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    raw = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[raw[0] : raw[-1]], raw - raw[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words of each document."""
    n_docs = len(offsets) - 1
    word = _IN_WORD[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = word[first]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    local = np.arange(at[0], len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    value = _VALUE[data[at[0] :]] * powers(_BASE, int(local.max()) + 1)[local]
    hashes = mix(np.add.reduceat(value, at - at[0]))
    return hashes, np.diff(np.searchsorted(at, offsets))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``size`` words; a document of fewer words, but not none,
    has one shingle of them all. Repeats stay."""
    ends = np.cumsum(counts)
    starts = ends - counts
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    weight = powers(_STEP, size)
    full = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for j in range(size if len(full) else 0):
        full += words[j : j + len(full)] * weight[j]
    doc = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + starts[doc]
    out = np.zeros(len(doc), np.uint64)
    whole = counts[doc] >= size
    out[whole] = full[at[whole]]
    for i in np.flatnonzero(~whole):
        some = words[starts[doc[i]] : ends[doc[i]]]
        out[i] = (some * weight[: len(some)]).sum(dtype=np.uint64) + np.uint64(len(some))
    return mix(out), n


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each document, in ascending order."""
    hashes, n = shingle_hashes(*word_hashes(*utf8(texts)), size)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(n))
