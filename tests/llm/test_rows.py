"""The pipeline's stages decide row by row: clean and bad rows under one id and without one, against brute force."""

import os
import random
import re

from pyspark.sql import functions as F
from test_small_tables import DOCS, shingles, windows

from polycat.llm import common, decontaminate, minhash, mixing, toxicity


def table(spark, rows):
    return spark.createDataFrame([(i, t, "de", s, k) for k, (i, t, s) in enumerate(rows)], DOCS)


def numbers(df):
    return sorted(x.n_chars for x in df.collect())


def test_contaminated_rows(spark):
    item = "eins zwei drei vier fuenf"
    rows = [(i, f"{item} {k}" if k % 3 == 0 else f"sauber {k}", "s") for k, i in enumerate([None, None, None, 7, 7, 7, 8, 9, None])] + [(7, None, "s"), (None, None, "s"), (None, f"{item} 0", "s")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    hit = lambda t: bool(windows((t or "").split(), 5) & windows(item.split(), 5))
    assert numbers(decontaminate.drop_contaminated(table(spark, rows), bench)) == [k for k, r in enumerate(rows) if not hit(r[1])]


def test_toxic_rows(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(600):
        w = [word() for _ in range(r.randint(20, 80))]
        if i % 5 == 0:
            w[r.randrange(len(w))] = "scumbag"
        rows.append((i, " ".join(w), "s"))
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    mixed = [(i, f"{word()} {word()} {'scumbag' if bad else word()} {word()}", "s") for i in (None, 700) for bad in (0, 1, 0, 1)] + [(None, None, "s")]
    df = table(spark, rows + mixed)
    model = toxicity.train(df, labels)
    called = {x.n_chars for x in toxicity.score(df, model, id_col="n_chars").where("predicted = 1").collect()}
    assert {len(rows) + 1, len(rows) + 3, len(rows) + 5, len(rows) + 7} <= called
    assert numbers(toxicity.drop_toxic(df, labels)) == [k for k in range(len(rows + mixed)) if k not in called]


def test_near_duplicate_rows(spark):
    r = random.Random(2)
    base = [[f"w{b}x{j}" for j in range(60)] for b in range(4)]
    rows = []
    for i in (None, 5, 5, 3, None, 6, 3, None):
        w = list(r.choice(base))
        w[r.randrange(60)] = "anders"
        rows.append((i, " ".join(r.choice([w, r.choice(base)])), "s"))
    rows += [(5, "allein " * 3, "s"), (None, "nur hier und sonst nicht", "s"), (5, rows[1][1], "s"), (None, None, "s"), (5, "", "s")]
    sets = [shingles(t, 5) for _, t, _ in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    ids = lambda g: min((rows[k][0] is None, rows[k][0] or 0) for k in range(len(rows)) if group[k] == g)
    left = minhash.drop_near_duplicates(table(spark, rows)).collect()
    assert sorted((group[x.n_chars], x.doc_id is None, x.doc_id or 0) for x in left) == sorted((g, *ids(g)) for g in set(group))


def test_mixed_rows(spark):
    """Repeated rows, one id for a third of the rows and none for another: each source's tokens are on target, row by row."""
    r = random.Random(8)
    rows = [(None if k % 3 == 0 else 1 if k % 3 == 1 else k, " ".join("w" * r.randint(1, 30)), f"s{k % 4}") for k in range(900)]
    rows += rows[:60]
    df = table(spark, rows)
    out = mixing.mix(df).collect()
    times = [0] * len(rows)
    for x in out:
        times[x.n_chars] += 1
    assert max(times) <= mixing.MOST
    want = {x.source: x.target for x in mixing.mix_rates(df.withColumn("s", F.col("source")), keep=("s",)).withColumnRenamed("s", "source").collect()}
    for s in want:
        got = sum(n * len(re.findall(r"\S+", rows[k][1])) for k, n in enumerate(times) if rows[k][2] == s)
        assert abs(got - want[s]) <= 30, (s, got, want[s])
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(repr, ((x.doc_id, x.text) for x in again))) == sorted(map(repr, ((x.doc_id, x.text) for x in out)))


def test_stages_leave_no_texts_behind(spark, tmp_path):
    """Over Parquet files near-duplicates and mix store no copy of the documents, and of their own tables only what their result reads."""
    rows = [(k % 40, f"eins zwei drei vier fuenf sechs w{k % 25}", f"s{k % 3}") for k in range(100)]
    path = f"file://{tmp_path}/docs"
    table(spark, rows).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    for stage, least in ((minhash.drop_near_duplicates, 25), (mixing.mix, 100)):
        before = left(spark)
        out = stage(docs)
        new = left(spark) - before
        assert len(new) == 1 and not any("text" in spark.read.parquet(f"{common.shared_dir(spark)}/{p}").columns for p in new)
        assert numbers(out) == numbers(out) and out.columns == docs.columns and out.count() >= least
    keys = common.keyed(docs, "key")
    assert keys.select("key").distinct().count() == 100 and sorted(map(tuple, keys.collect())) == sorted(map(tuple, keys.collect()))
    twice = common.keyed(docs.join(spark.range(2)), "key")  # the same places twice: stored
    assert twice.select("key").distinct().count() == twice.count() == 200
    plain = common.keyed(table(spark, rows), "key")
    assert plain.select("key").distinct().count() == plain.count() == 100


def left(spark):
    return {p for p in os.listdir(common.shared_dir(spark).removeprefix("file:").replace("//", "/")) if p.startswith("polycat-")}
