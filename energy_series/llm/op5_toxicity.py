"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel compares two words by the character triples that both have in order, with up
to two characters between a triple's ends left out, each at half the weight; the ends of a word are
characters, too. So an insult with inserted characters still resembles it. Landmarks are the beginnings
of words that tell labelled toxic texts from others, Nyström features are kernel values with the
landmarks times the inverse root of the landmarks' kernel matrix, and a linear SVM on them
is fitted to the words of labelled sentences: for a toxic text the words that resemble a
landmark most, as they are and with inserted characters, against the words of the other
texts. A text scores by its worst word, through a logistic curve fitted to labelled texts.

The fit reads a bounded sample of labelled rows (``TOXIC_ROWS`` and ``CLEAN_ROWS``, those whose
ids have the smallest hashes) and no row with crc32(doc_id) mod 5 = 0. Since Nyström features
are linear in kernel values, the fitted machine is one weight for each triple, and every word
of every text is scored in numpy; a worker scores a distinct word once.

Defined cases: a null or empty text has no words and the lowest score; long texts are
scored whole; runs of single letters with blanks between them are one word; every row
gives one row, also where ids repeat or are null; labels that are null, or of unknown
documents, teach nothing, and without labels of both kinds every score is 0; labels,
lang and source are no inputs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, pretokens

TOXIC_ROWS, CLEAN_ROWS = 1000, 2000
FOLDS = 5
LANDMARKS = 64
POWER = 3
BENT = 40  # words with inserted characters for each landmark, at least
HARD = 20_000  # words of other texts, those that resemble a landmark most
COST = 1000.0
MANY = 10_000  # words whose kernel values are worked out at a time
CHANCE = 1e-6  # of a beginning that is no sign of toxicity to become a landmark
BEGIN, END = "\x02", "\x03"
DECAY = 0.5
#: Places of a triple's second and third character.
PATTERNS = [(a, b) for b in range(2, 5) for a in range(1, b)]
AROUND = ".,;:!?\"()[]"
LONGEST, STEP = 16, 4  # characters of a piece of a marked word, and from one piece to the next
_SPELLED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")


def words(text: str) -> list[str]:
    """Words of a text, in lower case; letters spelled one by one are a word."""
    text = text.lower()
    if " " in text:
        text = _SPELLED.sub(lambda m: m[0].replace(" ", "") + " " + m[0], text)
    return text.split()


def pieces(word: str) -> list[str]:
    """Pieces of a word between marks, without the punctuation around it, and again without
    what is no letter inside it; a piece is so short that what happens to resemble a landmark
    in it cannot add up."""
    word = word.strip(AROUND)
    forms = [word] if word.isalpha() else [word, "".join(filter(str.isalpha, word))]
    marked = [BEGIN + w + END for w in dict.fromkeys(forms)]
    return [w[i : i + LONGEST] for w in marked for i in range(0, max(len(w) - LONGEST + STEP, 1), STEP)]


def triples(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String number, triple and weight of every triple of each string."""
    data = np.frombuffer("\x00\x00\x00\x00".join([*strings, ""]).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(strings)), [len(s) + 4 for s in strings])
    found = []
    for a, b in PATTERNS:
        x, y, z = data[: len(data) - b], data[a : len(data) - b + a], data[b:]
        good = np.flatnonzero((x > 0) & (y > 0) & (z > 0))
        key = (x[good] << np.uint64(42)) | (y[good] << np.uint64(21)) | z[good]
        found.append((owner[good], key, np.full(len(good), DECAY ** (b - 2))))
    who, key, weight = (np.concatenate(c) for c in zip(*found, strict=True))
    return who, key, weight


@dataclass
class Landmarks:
    """Landmarks by triple, for kernel values with many strings; most triples are in none,
    which a table of bits tells first."""

    strings: list[str]

    def __post_init__(self) -> None:
        who, key, weight = triples(self.strings)
        norm = np.bincount(who, weight**2, minlength=len(self.strings))
        order = np.argsort(key, kind="stable")
        self.who, self.weight = who[order], (weight / norm[who])[order]
        self.keys, self.first, self.count = np.unique(key[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << 16, bool)
        self.bits[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)

    def kernel(self, strings: list[str]) -> np.ndarray:
        """The third power of the share of each landmark's triples that a string has."""
        who, key, weight = triples(strings)
        maybe = np.flatnonzero(self.bits[self._slot(key)])
        at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
        real = self.keys[at] == key[maybe]
        maybe, at = maybe[real], at[real]
        n = self.count[at]
        place = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        cell = np.repeat(who[maybe], n) * len(self.strings) + self.who[place]
        share = np.bincount(cell, np.repeat(weight[maybe], n) * self.weight[place], minlength=len(strings) * len(self.strings))
        return np.minimum(share, 1.2).reshape(len(strings), -1) ** POWER


@dataclass
class Model:
    """A weight for each landmark, the machine's bias, and the logistic curve of a text's worst word."""

    landmarks: Landmarks | None = None
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    slope: float = 0.0
    middle: float = 0.0

    def word_margins(self, some: list[str]) -> np.ndarray:
        """The worst piece of each word."""
        cut = [pieces(w) for w in some]
        strings = [p for c in cut for p in c]
        kernel = np.empty((len(strings), len(self.landmarks.strings)))
        for i in range(0, len(strings), MANY):  # a string's triples take far more than its row
            kernel[i : i + MANY] = self.landmarks.kernel(strings[i : i + MANY])
        margin = kernel @ self.weights + self.bias
        starts = np.cumsum([0, *map(len, cut)])[:-1]
        return np.maximum.reduceat(margin, starts) if len(margin) else margin

    def score(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (worst - self.middle), -30, 30)))


def _landmarks(toxic: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Beginnings of words that toxic texts have beyond what chance and the other texts
    explain, none of which begins with another."""
    begins = lambda some: {w[:n] for w in (x.strip(AROUND) for x in some) for n in range(3, min(len(w), 12) + 1)}
    have = [begins(s) for s in toxic]
    bad, good = Counter(x for s in have for x in s), Counter()
    for s in clean:
        good.update(begins(s) & bad.keys())
    gain = {}
    for x, n in bad.items():
        expected = (good[x] + 0.5) / (len(clean) + 1) * len(toxic)
        # The Poisson tail is at most exp(n - expected) (expected / n) ** n.
        if n >= 8 * expected and n - expected + n * math.log(expected / n) < math.log(CHANCE):
            gain[x] = n / len(toxic) - 3 * good[x] / len(clean)
    chosen: list[str] = []
    for x in sorted(gain, key=lambda x: (-gain[x], -len(x), x)):
        if len(chosen) < LANDMARKS and not any(x.startswith(c) or c.startswith(x) for c in chosen):
            chosen.append(x)
    return chosen


def _inserted(word: str, rng: np.random.Generator) -> str:
    """The word with one to three characters put in between its own."""
    out = list(word)
    for _ in range(int(rng.integers(1, 4))):
        if len(out) > 2:
            out.insert(int(rng.integers(1, len(out))), str(rng.choice(list(".-*_' 0"))).strip() or "-")
    return "".join(out)


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps on its active points."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        active = y * (a @ w) < 1
        b = a[active] * cost[active, None]
        new = np.linalg.solve(ridge + b.T @ a[active], b.T @ y[active])
        if np.allclose(new, w):
            break
        w = (w + new) / 2
    return w[:-1], float(w[-1])


def _originals(sets: list[set[str]], labels: list[int]) -> tuple[list[set[str]], list[int]]:
    """The texts without near copies of earlier ones, which share half of the sixteen smallest
    hashes of their words: words of one text that was copied often are no sign of anything."""
    seen: defaultdict[int, list[int]] = defaultdict(list)
    kept = []
    for i, s in enumerate(sets):
        sketch = sorted(zlib.crc32(w.encode()) for w in s)[:16]
        shared = Counter(j for h in sketch for j in seen[h])
        if not shared or max(shared.values()) < len(sketch) / 2:
            kept.append(i)
            for h in sketch:
                seen[h].append(i)
    return [sets[i] for i in kept], [labels[i] for i in kept]


def fit(texts: list[str], labels: list[int]) -> Model:
    """The machine for labelled texts (label 1: toxic)."""
    sets, labels = _originals([set(words(t)) for t in texts], labels)
    toxic = [s for s, k in zip(sets, labels, strict=True) if k == 1]
    clean = [s for s, k in zip(sets, labels, strict=True) if k == 0]
    if not toxic or not clean:
        return Model()
    stems = _landmarks(toxic, clean)
    if not stems:
        return Model()
    landmarks = Landmarks([BEGIN + x for x in stems])
    rng = np.random.default_rng(5)
    positive, cost = [], []
    for stem in stems:  # each landmark's words have the same weight together
        some = sorted({w.strip(AROUND) for s in toxic for w in s if w.strip(AROUND).startswith(stem)})
        bent = [_inserted(str(rng.choice(some)), rng) for _ in range(max(len(some), BENT))]
        positive += [pieces(w)[0] for w in [*some, *bent]]
        cost += [1 / (2 * len(some))] * len(some) + [1 / (2 * len(bent))] * len(bent)
    negative = sorted({p for s in clean for w in s for p in pieces(w)})
    near = landmarks.kernel(positive)
    far = np.vstack([landmarks.kernel(negative[i : i + MANY]) for i in range(0, len(negative), MANY)] or [near[:0]])
    hard = np.argsort(-far.max(axis=1), kind="stable")[:HARD]
    among = np.cbrt(landmarks.kernel(landmarks.strings))
    norm = np.sqrt([np.sum(triples([x])[2] ** 2) for x in landmarks.strings])
    among = (among * norm[None, :] / norm[:, None]) ** POWER  # cosines: a share times the ratio of norms
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    x = np.vstack([near, far[hard]]) @ root
    y = np.append(np.ones(len(near)), -np.ones(len(hard)))
    weight = np.append(np.array(cost), np.full(len(hard), len(stems) / len(hard)))
    v, bias = _svm(x, y, COST * weight)
    model = Model(landmarks, root @ v, bias)  # Nystroem features are linear in kernel values
    worst = lambda some: np.array([model.word_margins(sorted(s)).max(initial=bias) for s in some])
    bad, good = worst(toxic), worst(clean)
    # The middle lies where the two kinds of error are fewest, half way between the texts around it.
    every = np.unique(np.concatenate([bad, good, [bias, bias + 2]]))
    cuts = (every[1:] + every[:-1]) / 2
    errors = (bad[:, None] < cuts).mean(axis=0) + (good[:, None] >= cuts).mean(axis=0)
    best = int(np.argmin(errors))
    model.middle = float(cuts[best])
    model.slope = 8 / max(float(every[best + 1] - every[best]), 0.2)
    return model


class Scorer:
    """Scores texts and remembers the margins of their words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.memory = pretokens.Memory(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.margin = np.zeros(0)

    def _learn(self, some: list[str]) -> None:
        self.margin = np.append(self.margin, self.model.word_margins(some))

    def score(self, texts: list[str]) -> np.ndarray:
        if self.model.landmarks is None:
            return np.zeros(len(texts))
        cut = pretokens.Cut([" ".join(words(t)) for t in texts], None)
        number = self.memory.number(cut)
        margin = self.margin[number]
        worst = np.full(len(texts), self.model.bias)
        full = np.flatnonzero(cut.counts)
        if len(full):
            starts = (np.cumsum(cut.counts) - cut.counts)[full]
            worst[full] = np.maximum(worst[full], np.maximum.reduceat(margin, starts))
        return self.model.score(worst)


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """The machine for a bounded sample of the labelled rows that are not held out."""
    marked = labels.select(F.col("doc_id"), F.col("toxic")).filter(~held_out()).filter("toxic in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = [
        marked.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for kind, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    ]
    ids = F.broadcast(some[0].union(some[1]).withColumnRenamed("doc_id", "id"))  # at most the sum of the two bounds
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(ids, F.col("k") == F.col("id"))
    # Of different texts with one id the least, so that the sample doesn't depend on the order of rows.
    rows = rows.filter("t is not null").groupBy("k").agg(F.min("t").alias("t"), F.max("toxic").alias("toxic")).collect()
    rows = sorted(rows, key=lambda r: r["k"])
    return fit([r["t"] for r in rows], [r["toxic"] for r in rows])


def scores(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in common.chunks(batch, "text"):
                value = scorer.score(part.column("text").fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(value, pa.float64())], ["key", "score"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, score double")
    return out.select(F.col("key").alias(key), held_out("key").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in common.chunks(batch, text):
                yield part.filter(pa.array(scorer.score(part.column(text).fill_null("").to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)
