"""Trees and proofs against a tree built in plain Python."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from test_small_tables import DOCS, TEXTS, clashing, docs, empty

from polycat.llm import merkle


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def tree(nodes, fan):
    """Root, and for each leaf its path of (run, slot)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i : i + fan] for i in range(0, len(level), fan)]
        for k in range(len(nodes)):
            paths[k].append((runs[at[k] // fan], at[k] % fan))
            at[k] //= fan
        level = [h("".join(r)) for r in runs]
    return level[0], paths


def expected(rows, now, fan):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    first = lambda x: (x is not None, x if x is not None else "")
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for g in langs:
        some = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[g] = (some, *tree([leaf(r) for r in some], fan))
    root, above = tree([built[g][1] for g in langs], fan)
    out = []
    for k, g in enumerate(langs):
        some, sub, paths = built[g]
        for r, p in zip(some, paths):
            steps = p + above[k]
            sib = "".join("".join(x for i, x in enumerate(run) if i != slot) for run, slot in steps)
            x = leaf((r[0], now(r[1]), *r[2:]))
            for run, slot in steps:
                x = h("".join(x if i == slot else d for i, d in enumerate(run)))
            out.append((r[0], leaf(r), sub, root, sib, x, x == root))
    assert first(None) < first("")
    return out


@pytest.mark.parametrize(("fan", "langs", "n", "proof_bytes"), [(8, ["de", "en", None, "", "ж"], 700, 32 << 20), (8, ["de", "en", None], 90, 0), (2, ["de"], 17, 32 << 20), (3, [f"l{i}" for i in range(40)], 90, 0), (8, [None], 1, 0)])
def test_brute_force(spark, monkeypatch, fan, langs, n, proof_bytes):
    """Groups of many sizes; also with proofs that are never broadcast."""
    monkeypatch.setattr(merkle, "PROOF_BYTES", proof_bytes)
    r = random.Random(n)
    rows = [(None if r.random() < 0.05 and n > 1 else r.randint(-5, 2 * n), r.choice(["Ä: 1", "Text " * r.randint(0, 9), "", None, "klein"]), langs[min(int(r.expovariate(1.2)), len(langs) - 1)] if n != 90 else r.choice(langs), r.choice(["s", None]), r.choice([None, 3])) for _ in range(n)]
    rows += rows[: n // 10]
    df = clashing(spark.createDataFrame(rows, DOCS).repartition(3))
    got = merkle.manifest(df, F.lower("text"), fan=fan).collect()
    want = expected(rows, lambda t: t if t is None else t.lower(), fan)
    assert sorted(map(repr, want)) == sorted(repr(tuple(x)) for x in got)
    if n == 700:
        assert {x.root for x in merkle.manifest(df.repartition(5), fan=fan).where("verified").collect()} == {got[0].root}


def test_edges(spark):
    assert merkle.manifest(empty(spark)).count() == 0
    got = merkle.manifest(docs(spark)).collect()
    assert len(got) == len(TEXTS) and all(x.verified for x in got)
    one = merkle.manifest(docs(spark, [(1, None)])).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.siblings == ""
