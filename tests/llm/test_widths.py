"""The wider filters of the toxicity classifier tell texts apart that single words can't."""

import random

import numpy as np
import pyarrow as pa

from polycat.llm import toxicity
from polycat.llm.text import slices


def made(n, seed):
    """Texts that all hold one word of each of two kinds; in the toxic ones they stand side by side, in this order."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = []
    for i in range(n):
        w = [word() for _ in range(r.randint(10, 40))]
        a, b, k = r.choice(["dirty", "filthy", "stupid"]), r.choice(["people", "folk", "crowd"]), r.randrange(len(w))
        w[k:k] = [a, b] if i % 2 else r.choice([[a, word(), word(), b], [b, a]])
        texts.append(" ".join(w))
    out = []
    for _, _, off, data in slices(pa.array(texts)):
        words, counts = toxicity.features(off, data)
        out += np.split(words, np.cumsum(counts)[:-1])
    return out, np.arange(n) % 2


def accuracy():
    model = toxicity.fit(*made(1500, 1))
    texts, y = made(400, 2)
    z = model.logits(np.concatenate(texts), np.array([len(t) for t in texts]))
    return float(np.mean((z > 0) == y))


def test_widths_add(monkeypatch):
    assert accuracy() >= 0.9
    monkeypatch.setattr(toxicity, "WIDTHS", (1,))
    assert accuracy() <= 0.65
