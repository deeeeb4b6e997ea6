"""Near words against every pair of words, with blocks of all sizes."""

import random
import re
from collections import Counter

import pytest
from test_small_tables import TEXTS, clashing, docs, empty

from polycat.llm import queries, spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(words):
    out = {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if near(w, o))
        form = others[0][1] if others and -others[0][0] >= 2 * n else None
        out[w] = (n, len(others), form, words[form] if form else None)
    for w in words:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w] = (*out[w], root)
    return out


def some_words(r):
    base = ["".join(r.choice("abé") for _ in range(r.randint(1, 9))) for _ in range(150)] + ["aaaaaaa", "aaaaaa", "aaaaa", "abababa", "bababa"]
    base += ["gemeinsam" + "".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    base += ["".join(r.choice("abcdefgh") for _ in range(4)) + "gemeinsam" for _ in range(100)]
    base += ["wort" + chr(c) + "ende" for c in range(0xE0, 0xFF)] + ["wortende", "a", "b", "ab"]
    return {w: r.choice([3, 3, 4, 7, 8, 20, 40, 200]) for w in base}


@pytest.mark.parametrize(("block", "letters", "pairs"), [(128, 1 << 20, 1 << 18), (2, 1 << 20, 5), (4, 20, 1 << 18), (1 << 20, 1 << 20, 64)])
def test_brute_force(spark, monkeypatch, block, letters, pairs):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "LETTERS", letters)
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    words = some_words(random.Random(block))
    got = {x.word: (x.n, x.n_near, x.form, x.form_n, x.root) for x in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got == expected(words)
    links = [(x.word, x.other) for x in spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()]
    assert len(links) == len(set(links)) == sum(x[1] for x in got.values())


def test_small_arrow_batches(spark):
    """A block may begin in one batch and end in another."""
    words = some_words(random.Random(9))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {x.word: (x.n, x.n_near, x.form, x.form_n, x.root) for x in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == expected(words)


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    monkeypatch.setattr(spelling, "SLICE", 1000)
    r = random.Random(2)
    rows = [*TEXTS, *[(100 + i, " ".join(r.choice(["Straße", "STRASSE", "Éléphant", "éléphant", "kurz", "langes", "x" * 3000, "a×b÷cd", "1wörter2"]) for _ in range(30)) + ".") for i in range(300)], (None, "langes " * 4), (7, "langes")]
    want = Counter()
    for i, t in rows:
        change = queries._drop_one(i)
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            want[change(re.sub("[A-Z]", lambda m: m[0].lower(), w))] += 1
    got = {x.word: x.n for x in spelling.word_counts(clashing(docs(spark, rows)), rule=queries._drop_one).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert len(got) > 15 and "straße" in got and "Éléphant" in got and "éléphant" in got


def test_empty(spark):
    words = spelling.word_counts(empty(spark), rule=queries._drop_one)
    assert words.count() == 0 and spelling.variants(words).count() == 0
    assert spelling.word_counts(docs(spark, [(1, None), (2, ""), (None, "ab cd")])).count() == 0


def test_long_words(spark):
    long = ["q" * 5000, "q" * 5001, "q" * 2500 + "r" + "q" * 2499]
    got = {x.word: x.n_near for x in spelling.variants(spark.createDataFrame([(w, 3) for w in long], "word string, n long")).collect()}
    assert got == {long[0]: 2, long[1]: 1, long[2]: 1}
