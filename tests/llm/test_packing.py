"""Packing against the plain library and against every subset sum."""

import itertools
import random
import zlib

import numpy as np
import pytest
from test_small_tables import TEXTS, clashing, docs, empty

from polycat.llm import packing
from polycat.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def ids_of(texts, end=1):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def odd_texts(n):
    r = random.Random(11)
    parts = ["a", "Wort", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "É", "é", "́", "'s", "1", "...", "　", "ж", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|end|>", "\x01", "x" * 70, "한", "ᄒ", "ᅡ"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_encoder_is_the_library():
    texts = [*odd_texts(3000), None, "", "wort " * 5000]
    got = packing.WordEncoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [x[:-1] for x in ids_of(texts)]


def test_least_slack():
    r = random.Random(3)
    for _ in range(300):
        capacity = r.randint(1, 60)
        counts = {r.randint(1, 40): r.randint(1, 4) for _ in range(r.randint(0, 5))}
        taken, slack = packing.least_slack(sorted(counts.items(), reverse=True), capacity)
        best = max(s for c in itertools.product(*[range(k + 1) for k in counts.values()]) if (s := sum(n * x for n, x in zip(counts, c))) <= capacity)
        assert capacity - slack == best == sum(n * k for n, k in taken.items()) and all(k <= counts[n] for n, k in taken.items())


def checked(df, rows, window, **how):
    got = packing.pack(df, PATH, window=window, **how).collect()
    by_doc, by_seq = {}, {}
    for x in got:
        assert len(x.ids) == 4 * x.length > 0
        by_seq.setdefault(x.sequence_id, []).append(x)
    for pieces in by_seq.values():
        pieces.sort(key=lambda x: x.offset)
        at = 0
        for x in pieces:
            assert x.offset == at
            at += x.length
        assert at == window or (at < window and at & at - 1 == 0)
    # documents that share an id are told apart by what they hold
    want = sorted((repr(i), t) for (i, _), t in zip(rows, ids_of([t for _, t in rows])))
    for x in got:
        by_doc.setdefault((repr(x.doc_id), x.doc_tokens), []).append((x.start, np.frombuffer(x.ids, "<u4").tolist()))
    once = [k for k, n in __import__("collections").Counter((i, len(t)) for i, t in want).items() if n == 1]
    for i, t in want:
        if (i, len(t)) in once:
            at = []
            for start, part in sorted(by_doc[i, len(t)]):
                assert start == len(at)
                at += part
            assert at == t
    assert sum(x.length for x in got) == sum(len(t) for _, t in want)
    assert sorted(itertools.chain.from_iterable(np.frombuffer(x.ids, "<u4").tolist() for x in got)) == sorted(itertools.chain.from_iterable(t for _, t in want))
    return got


@pytest.mark.parametrize("pool", [(1 << 21, 1 << 20), (3000, 1000)])
def test_pieces(spark, monkeypatch, pool):
    """Also with a pool that is filled and emptied again and again."""
    monkeypatch.setattr(packing, "POOL", pool[0])
    monkeypatch.setattr(packing, "LOW", pool[1])
    monkeypatch.setattr(packing, "OUT", 700)
    rows = [*TEXTS, *[(100 + i, t) for i, t in enumerate(odd_texts(400))], (4, "dieselbe id"), (None, None)]
    got = checked(clashing(docs(spark, rows)).coalesce(2), rows, 256)
    assert len({x.sequence_id for x in got}) < sum(x.length for x in got) / 256 + 20
    seqs = packing.sequences(packing.pack(docs(spark, rows), PATH, window=256)).collect()
    assert sum(len(s.ids) for s in seqs) == 4 * sum(x.length for x in got)
    assert all(zlib.crc32(s.ids) is not None and len(s.ids) <= 4 * 256 for s in seqs)


def test_equal_lengths_that_fill_no_window(spark):
    """Pieces of one length only leave slack, which cuts fill."""
    rows = [(i, "wort " * 149) for i in range(300)]
    got = checked(docs(spark, rows).coalesce(1), rows, 256)
    assert sum(x.length < 150 for x in got) > 100


def test_edges(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
    assert {(x.doc_id, x.length) for x in packing.pack(docs(spark, [(1, None), (2, ""), (None, " ")]), PATH).collect()} == {(1, 1), (2, 1), (None, 1)}
    with pytest.raises(ValueError):
        packing.pack(empty(spark), PATH, window=2000)
