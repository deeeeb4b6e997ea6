"""Hashes of words: equal words meet, and words made to collide modulo powers of two don't."""

import random

import numpy as np
import pyarrow as pa
from test_small_tables import docs

from polycat.llm import minhash, ngram, text


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t


def hashes(texts):
    out = []
    for _, _, off, data in text.slices(pa.array(texts)):
        words, counts = text.word_hashes(off, data)
        out += np.split(words, np.cumsum(counts)[:-1])
    return [x.tolist() for x in out]


def test_equal_words_only(monkeypatch):
    r = random.Random(1)
    words = ["".join(r.choice("abÄ\x01") for _ in range(r.randint(1, 6))) for _ in range(400)]
    texts = [" ".join(r.choice(words) for _ in range(30)) for _ in range(200)]
    for exact in (1 << 24, 4):  # also with remainders taken of each term
        monkeypatch.setattr(text, "_EXACT", exact)
        of = {}
        for t, hs in zip(texts, hashes(texts), strict=True):
            for w, h in zip(t.split(" "), hs, strict=True):
                assert of.setdefault(w, h) == h
        assert len(set(of.values())) == len(of)
    assert hashes(["AbÄ x"]) == hashes(["abÄ X"]) != hashes(["abä x"])


def test_words_that_collide_modulo_powers_of_two(spark):
    for n in (1024, 2048, 4096):
        t = thue_morse(n)
        other = t.translate(str.maketrans("ab", "ba"))
        one, two = hashes([t, other])
        assert len(t) == n and one != two
        rows = [(1, f"{t} {t}"), (2, f"{other} {other}"), (3, f"{t} {t}")]
        got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs(spark, rows), words=4).collect()}
        assert got == {1: 1, 2: 2, 3: 1}
        known = {x.doc_id: x.n_known for x in ngram.score_corpus(docs(spark, [(i, t if i % 2 else other) for i in (1, 3, 2)])).collect()}
        assert len(known) == 3
