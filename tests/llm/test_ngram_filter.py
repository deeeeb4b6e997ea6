"""The filter: unseen keys, levels, scores against a model in plain Python, and what pairs add on held-out texts."""

import collections
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_small_tables import TEXTS, docs, empty

from polycat.llm import ngram


def test_unseen_keys():
    r = np.random.default_rng(1)
    keys, probes = (r.integers(0, 1 << 63, 300_000, dtype=np.uint64) for _ in range(2))
    probes |= np.uint64(1 << 63)  # none of the keys
    raw = ngram.piece(keys, np.ones(len(keys), np.int64), 2).tobytes()
    filter_ = ngram.Filter([(2, 0, raw)], len(raw), 1)
    assert (filter_.levels(keys, 2) > 0).all()
    assert (filter_.levels(probes, 2) > 0).mean() < 0.015


def test_one_piece_is_held_at_a_time():
    """Of several pieces a worker holds one, and over long runs of texts it needs little beside it."""
    held, most = [0], [0]
    r = np.random.default_rng(2)

    class Piece(ngram.Filter):
        def __init__(self):
            raw = ngram.piece(r.integers(0, 1 << 62, 1000, dtype=np.uint64), np.ones(1000, np.int64), 1).tobytes()
            super().__init__([(1, 0, raw)], len(raw), 1)
            held[0] += 1
            most[0] = max(most[0], held[0])

        def __del__(self):
            held[0] -= 1

    class Sent:
        _path = None

        def load_from_path(self, _):
            return Piece()

    texts = pa.array([" ".join(f"w{x}" for x in r.integers(0, 5000, 20_000)) for _ in range(60)])
    tracemalloc.start()
    rows = sum(hi - lo for lo, hi, *_ in ngram._probed([Sent() for _ in range(6)], texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60 and most[0] == 1
    assert peak < 150e6  # over 6.6 MB of text


def test_levels():
    counts = np.arange(1, 3000)
    for order in (1, 2):
        q = ngram.levels(counts, order)
        assert np.all(np.abs(np.log2(ngram.values(q, order) / counts)) <= 1 / ngram.STEPS[order])
    assert ngram.values(np.array([0]), 1)[0] == 0


def split(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def plain(rows):
    """Base and pair scores of each row by dictionaries, counts quantised as the filter keeps them."""
    one, two = collections.Counter(), collections.Counter()
    for i, t in rows:
        if not held(i):
            w = split(t)
            one.update(w)
            two.update(zip([None, *w], w))
    n = sum(one.values())
    divisor = n + 0.1 * (len(one) + 1)
    kept = lambda c, order: float(ngram.values(ngram.levels(np.array([c]), order), order)[0]) if c else 0.0
    out = {}
    for i, t in rows:
        w, base, score = split(t), 0.0, 0.0
        for v, x in zip([None, *w], w):
            base += math.log10((one[x] + 0.1) / divisor)
            a, b = kept(one[x], 1), kept(one[v], 1)
            m = ngram.MU + ngram.SHARE * b
            score += math.log10((min(kept(two[v, x], 2), a, b) + m * (a + 0.1) / divisor) / (b + m))
        out[i] = len(w), sum(one[x] > 0 for x in w), n, base, score
    return out


def rows_of(seed, n):
    r = random.Random(seed)
    words = ["A", "b", "c", "d e", "Éf", *[f"w{i}" for i in range(40)]]
    return [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 50)))) for i in range(n)] + [(n + i, t) for i, (_, t) in enumerate(TEXTS)] + [(None, "a b"), (n + 50, "neu " * 30)]


@pytest.mark.parametrize("cap", ["one piece", "many pieces", "many passes"])
def test_scores(spark, cap, monkeypatch):
    """One broadcast of the filter, many, or several passes with few words broadcast and few counts held: the same scores, those of the plain model."""
    if cap == "many passes":
        monkeypatch.setattr(ngram, "PIECES", 2)
    if cap != "one piece":
        monkeypatch.setattr(ngram, "FILTER_BYTES", 600 << 6)
        monkeypatch.setattr(ngram, "SEGMENT_BYTES", 20_000)
        monkeypatch.setattr(ngram, "HEAD", 5)
        monkeypatch.setattr(ngram, "HELD", 50)
        monkeypatch.setattr(ngram, "GATHER", 500)
    # few enough keys, and so many bits for each, that no unseen key reads as seen
    monkeypatch.setattr(ngram, "KEY_BITS", 1 << 12)
    rows = rows_of(3, 120)
    want = plain(rows)
    got = {x.doc_id: x for x in ngram.score_corpus(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, (n, known, train, base, score) in want.items():
        x = got[i]
        assert (x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (n, known, train, held(i))
        assert x.base_score == pytest.approx(base) and x.score == pytest.approx(score, abs=1e-6), i


def test_edges(spark):
    assert ngram.score_corpus(empty(spark)).count() == 0
    only = [(i, "a b") for i in range(200) if held(i)]  # nothing to learn from
    got = ngram.score_corpus(docs(spark, only)).collect()
    assert {(x.n_known, x.train_tokens, x.held_out) for x in got} == {(0, 0, True)} and all(math.isfinite(x.score) for x in got)
    twice = ngram.score_corpus(docs(spark, TEXTS + TEXTS + [(None, None)])).collect()
    assert len(twice) == 2 * len(TEXTS) + 1


def test_pairs_help_held_out_texts(spark):
    """Texts of a chain of words: with pairs, held-out texts are likelier than by words alone; of words in no order they are hardly less so."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    after = {w: r.sample(words, 3) for w in words}

    def chain(k):
        out = [r.choice(words)]
        while len(out) < k:
            out.append(r.choice(after[out[-1]]))
        return " ".join(out)

    chains = docs(spark, [(i, chain(80)) for i in range(600)])
    mixed = docs(spark, [(i, " ".join(r.choice(words) for _ in range(80))) for i in range(600)])
    gain = {}
    for name, df in (("chain", chains), ("mixed", mixed)):
        x = [(y.score - y.base_score) / y.n_tokens for y in ngram.score_corpus(df).collect() if y.held_out]
        gain[name] = sum(x) / len(x)
    assert gain["chain"] > 0.5 and gain["mixed"] > -0.1
