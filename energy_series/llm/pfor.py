"""Patched frame-of-reference files of token ids.

A file is a header, the starts of its blocks, the lengths of its documents, and blocks of
1,024 ids (the last may be shorter), all little endian:

    header    magic "PFR1", ids (u64), documents (u64), blocks (u32)
    starts    where each block begins, from the file's first byte (u64 each)
    documents how many ids each has (u64 each)
    block     minimum (u32), width (u8), exceptions (u16), then the low ``width`` bits of
              every id less the minimum, then places (u16) and whole differences (u32) of
              the exceptions

The width is what the 90th percentile of a block's differences needs; ids that need
more are exceptions.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 1024
PERCENTILE = 90
_HEADER = struct.Struct("<4sQQI")
_BLOCK = struct.Struct("<IBH")
_MAGIC = b"PFR1"


def _bits(values: np.ndarray) -> np.ndarray:
    """The width of each value in bits."""
    return np.frexp(values.astype(np.float64))[1]


def _blocks(ids: np.ndarray) -> list[bytes]:
    """Encoded blocks of equal length, rows of ``ids``."""
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    length = ids.shape[1]
    ordered = np.sort(rest, axis=1)
    width = _bits(ordered[:, (length * PERCENTILE + 99) // 100 - 1])
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        bits = (rest[rows][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        packed = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        for row, body in zip(rows, packed, strict=True):
            places = np.flatnonzero(_bits(rest[row]) > w)
            out[row] = (
                _BLOCK.pack(int(low[row]), int(w), len(places))
                + body.tobytes()
                + places.astype("<u2").tobytes()
                + rest[row][places].astype("<u4").tobytes()
            )
    return out


def encode(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A file of documents: all their ids one after another, and how many each has."""
    ids = ids.astype(np.uint32, copy=False)
    whole = len(ids) // BLOCK * BLOCK
    blocks = []
    for i in range(0, whole, 64 * BLOCK):  # so many at a time that the bits stay small
        blocks += _blocks(ids[i : min(whole, i + 64 * BLOCK)].reshape(-1, BLOCK))
    if whole < len(ids):
        blocks += _blocks(ids[whole:].reshape(1, -1))
    head = _HEADER.size + 8 * (len(blocks) + len(lengths))
    starts = head + np.cumsum([0, *map(len, blocks)])[:-1]
    return b"".join(
        [
            _HEADER.pack(_MAGIC, len(ids), len(lengths), len(blocks)),
            np.asarray(starts).astype("<u8").tobytes(),
            np.asarray(lengths).astype("<u8").tobytes(),
            *blocks,
        ]
    )


def _block(data: bytes, at: int, length: int) -> np.ndarray:
    low, width, more = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    size = (length * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=length * width, bitorder="little")
    rest = bits.reshape(length, width) @ (np.uint32(1) << np.arange(width, dtype=np.uint32)) if width else np.zeros(length, np.uint32)
    at += size
    places = np.frombuffer(data, "<u2", more, at)
    rest[places] = np.frombuffer(data, "<u4", more, at + 2 * more)
    return rest + np.uint32(low)


def _index(data: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    magic, n, docs, blocks = _HEADER.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a token file")
    starts = np.frombuffer(data, "<u8", blocks, _HEADER.size)
    return n, starts, np.frombuffer(data, "<u8", docs, _HEADER.size + 8 * blocks)


def lengths(data: bytes) -> np.ndarray:
    return _index(data)[2].astype(np.int64)


def read(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids of the places ``start`` to ``stop``; other blocks are not touched."""
    n, starts, _ = _index(data)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, (stop - 1) // BLOCK
    parts = [_block(data, int(starts[b]), min(BLOCK, n - b * BLOCK)) for b in range(first, last + 1)]
    return np.concatenate(parts)[start - first * BLOCK : stop - first * BLOCK]
