"""What the Python workers of the pipeline hold: bounds on the arrays and strings of a batch."""

import random
import tracemalloc

import numpy as np

from energy_series.llm import bpe, op5_toxicity, op9_bpe, pretokens


def peak(f, *args):
    """MB at most while ``f`` runs, beyond those before, and MB that stay; and its result."""
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    out = f(*args)
    now, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    return (most - before) / 1e6, (now - before) / 1e6, out


def unlike_words(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(5, 11))) for _ in range(n)]


def test_encoder_holds_little_beside_the_texts():
    encoder = op9_bpe.Encoder(bpe.path(op9_bpe.VOCABULARY))
    pretokens._classes()
    words = unlike_words(150_000)
    texts = [" ".join(words[i : i + 300]) for i in range(0, len(words), 300)]
    most, stays, rows = peak(lambda: [(a, b) for a, _, b in encoder.encode(texts)] and None)
    assert rows is None
    assert most < 75, most
    assert stays < 15, stays


def test_encoder_that_forgets_within_a_batch(monkeypatch):
    words = unlike_words(900)
    texts = ["", "<|endoftext|>", *(" ".join(words[i : i + 9]) for i in range(0, 900, 9)), "a <|endoftext|> b", "aaaaaaa aaaa", words[0]]
    whole = op9_bpe.Encoder(bpe.path(op9_bpe.VOCABULARY)).encode(texts)
    monkeypatch.setattr(op9_bpe, "SLICE", 40)
    encoder = op9_bpe.Encoder(bpe.path(op9_bpe.VOCABULARY))
    encoder.memory = pretokens.Memory(encoder._learn, encoder._forget, known=50)
    assert encoder.encode(texts) == whole
    assert encoder.encode(texts[::-1]) == whole[::-1]
    assert encoder.encode([]) == []


def test_hashes_are_the_same_in_any_slices(monkeypatch):
    texts = ["don't stop 12", "", " x  y ", "\u4e2d\u6587 caf\u00e9", "z" * 90]
    for spaced in (True, False, None):
        whole = pretokens.Cut(texts, spaced).hashes()
        for many in (1, 7, 64):
            monkeypatch.setattr(pretokens, "HASHED", many)
            for a, b in zip(pretokens.Cut(texts, spaced).hashes(), whole, strict=True):
                assert (a == b).all()
        monkeypatch.undo()


def test_margins_hold_little_and_do_not_depend_on_blocks():
    stems = [op5_toxicity.BEGIN + w for w in unlike_words(op5_toxicity.LANDMARKS, 6)]
    model = op5_toxicity.Model(op5_toxicity.Landmarks(stems), np.random.default_rng(7).normal(size=len(stems)), -0.5)
    words = unlike_words(40_000)
    most, _, margin = peak(model.word_margins, words)
    assert most < 75, most
    strings = [p for w in words for p in op5_toxicity.pieces(w)]
    assert len(strings) == len(words)  # one piece each
    assert (margin == model.landmarks.kernel(strings) @ model.weights - 0.5).all()
