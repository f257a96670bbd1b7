"""Vocabulary files of byte-pair encoders: merge ranks, added tokens and byte alphabets.

The files are those that the tokenizers library reads; their path is a parameter and
each Python worker opens it once.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import public_tokenizers
import regex


def path(name: str) -> str:
    return public_tokenizers.path(name)


def alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable, else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and added tokens of one file."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        letters = alphabet()
        self.byte_ids = np.array([self.ids[c] for c in letters], np.int64)
        self.end_ids = np.array([self.ids[c + self.suffix] for c in letters], np.int64)
        left = np.array([self.ids[a] for a, _ in model["merges"]], np.int64)
        right = np.array([self.ids[b] for _, b in model["merges"]], np.int64)
        made = np.array([self.ids[a + b] for a, b in model["merges"]], np.int64)
        self.n_merges = len(made)
        self.made = made
        self.left, self.right = left, right
        keys = (left << 20) | right
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order

    def plain(self, texts: list[str]) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
        """The parts of the texts between added tokens, and the added tokens in them, each
        with the number of its text."""
        pieces, added = [], []
        for i, text in enumerate(texts):
            if "<|" in text:
                parts = self._split.split(text)
                pieces += [(p, i) for p in parts[::2]]
                added += [(p, i) for p in parts[1::2]]
            else:
                pieces.append((text, i))
        return pieces, added

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair; ``n_merges`` where there is none."""
        keys = (left << 20) | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], self.n_merges)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Byte symbols of all words one after another, and how many each has."""
        raw = [w.encode() for w in words]
        n = np.array([len(b) for b in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        out = self.byte_ids[data]
        if self.suffix:
            last = np.cumsum(n) - 1
            out[last] = self.end_ids[data[last]]
        return out, n


@cache
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)
