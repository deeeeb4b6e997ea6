"""Words of a corpus that are one edit apart, and the spelling that each of them is a variant of.

One edit leaves the words' first half or last half intact. Words that share a first half stand together in a sorted
dictionary, those that share a last half in a dictionary of reversed words; ranges of either are blocks, in which words are
compared. A block is told by where its pairs first differ, an interval of places: pairs that differ first within it
share what is before it and what is after. A block of many words is cut by cutting its interval in halves, down to
one place, where no more words can meet than there are letters. Every pair belongs to one block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polycat.llm.common import TEXT_ROWS, bounded, release, stored

#: Words of a block that are compared with each other, and letters of their differing parts; larger blocks are cut.
BLOCK, LETTERS = 128, 1 << 20
#: Pairs that are compared at once, and distinct words that a task holds before it hands on their counts.
PAIRS, HELD = 1 << 18, 200_000
#: Characters of a text whose words are listed at once.
SLICE = 1 << 20


def _counting(pattern: str, rule: Callable[[object], Callable[[str], str]] | None, least: int):
    run_of = re.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return rows

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                text = text.encode().lower().decode()  # bytes lower A-Z only
                if len(text) <= SLICE:
                    here = Counter(run_of.findall(text))
                else:
                    here = Counter(m[0] for m in run_of.finditer(text))
                change = rule(doc) if rule else None
                for word, n in here.items():
                    if change:
                        word = change(word)
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= HELD:
                    yield out()
        if total:
            yield out()

    return run


def word_counts(docs: DataFrame, letters: str = "A-Za-zÀ-ÿ", min_chars: int = 5, min_count: int = 3, rule: Callable | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: maximal runs of letters in all texts, with A-Z lower-cased, that have min_chars code points and occur min_count times.

    rule(id) gives a function that each of a document's words goes through before it is counted. Null and empty texts
    have no words; long texts are read whole; rows that share an id (or have none) count each. An empty table has no words. Counts
    are summed in each task before the shuffle, so that a frequent word is no hot key.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    pattern = f"[{letters}]{{{min_chars},}}"  # shorter runs stay short
    counts = rows.mapInArrow(_counting(pattern, rule, min_chars), "word string, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), TEXT_ROWS)


_KEY = ["gap", "m", "lo", "hi", "key"]


def _keyed(entries: DataFrame) -> DataFrame:
    """entries with the key of their block: what is before place lo and what is after place hi - 1 of the shorter word."""
    after = F.expr("right(word, greatest(m - hi + gap, 0))")
    return entries.withColumn("key", F.xxhash64(F.substring("word", F.lit(1), F.col("lo")), after))


def _halves(lo: Column, hi: Column) -> Column:
    mid = F.ceil((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi")))


def _near(words: np.ndarray, i: np.ndarray, j: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Which pairs of rows differ by one replaced place (gap 0), or by one letter that row j has more, first at a place of these columns (gap 1)."""
    a, b = words[i], words[j]
    same = a == b
    if not gap:
        return (~same).sum(1) == 1
    first = np.argmin(same, axis=1)
    apart = ~same.all(1)  # else they differ first after these columns, and are another block's
    rest = np.ones((len(i), words.shape[1]), bool)  # rest[:, p]: row i from p on is row j from p + 1 on
    rest[:, :-1] = np.logical_and.accumulate((a[:, :-1] == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return apart & rest[np.arange(len(i)), first]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the words of each block; rows come sorted by block. Gives each near pair in both directions."""
    tail = None
    for batch in chain_last(batches):
        rows = pa.Table.from_batches([batch]) if batch is not None else None
        if tail is not None:
            rows = tail if rows is None else pa.concat_tables([tail, rows])
        if rows is None or not len(rows):
            continue
        keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in _KEY])
        starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [len(rows)]])
        if batch is not None:  # the last block may go on in the next batch
            tail = rows.slice(starts[-2])
            starts = starts[:-1]
        else:
            tail = None
        if len(starts) > 1:
            yield from _compare(rows, keys, starts)


def chain_last(batches: Iterator) -> Iterator:
    """The batches, then None."""
    yield from batches
    yield None


def _compare(rows: pa.Table, keys: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    words, middles, counts = rows.column("word"), rows.column("middle").to_pylist(), rows.column("n").to_numpy()
    shape = keys[:4, starts[:-1]]
    runs = np.concatenate([[0], np.flatnonzero((shape[:, 1:] != shape[:, :-1]).any(0)) + 1, [len(starts) - 1]])
    for a, b in zip(runs[:-1], runs[1:], strict=True):  # blocks of one kind and interval
        gap, m, lo, hi = shape[:, a].tolist()
        first, last = starts[a], starts[b]
        width = hi - lo
        at = first
        while at < last:  # some whole blocks at once, bounded by letters
            end = int(starts[max(np.searchsorted(starts, at, "right"), np.searchsorted(starts, min(last, at + max(1, 4 * LETTERS // width)), "right") - 1)])
            some = np.array(middles[at:end], dtype=f"U{width}").view(np.uint32).reshape(end - at, width)
            stop = starts[np.searchsorted(starts, np.arange(at, end), "right")] - at
            yield from _pairs(some, stop, gap, m, words, counts, int(at), rows.column("long").to_numpy(zero_copy_only=False))
            at = end


def _pairs(some: np.ndarray, stop: np.ndarray, gap: int, m: int, words, counts: np.ndarray, at: int, long: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The near pairs of rows [0, len(some)); row i's block ends before stop[i]."""
    left = stop - np.arange(len(some)) - 1
    lo, most = 0, max(1, min(PAIRS, 8 * LETTERS // some.shape[1]))
    sums = np.concatenate([[0], np.cumsum(left)])
    while lo < len(some):
        hi = max(lo + 1, int(np.searchsorted(sums, sums[lo] + most, "right")) - 1)
        i = np.repeat(np.arange(lo, hi), left[lo:hi])
        j = i + 1 + np.arange(len(i)) - np.repeat(sums[lo:hi] - sums[lo], left[lo:hi])
        if gap and len(i):  # one shorter and one longer word each
            li, lj = long[at + i], long[at + j]
            ok = li != lj
            i, j, li = i[ok], j[ok], li[ok]
            i, j = np.where(li, j, i), np.where(li, i, j)
        lo = hi
        if not len(i):
            continue
        ok = _near(some, i, j, gap)
        i, j = i[ok] + at, j[ok] + at
        if len(i):
            one, two = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
            yield pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (words.take(one), words.take(two), pa.array(counts[np.concatenate([j, i])], pa.int64()))], ["word", "other", "other_n"])


def near_words(words: DataFrame) -> DataFrame:
    """word, other, other_n for each two different words (word, n) that differ by one inserted, deleted or replaced code point, in both directions, each once.

    words must be distinct. Blocks of more than BLOCK words are cut before anything is compared, and only counts of
    blocks are shuffled to find them; entries are joined to the list of large blocks. At one place a block holds words
    that differ there alone, as many as the alphabet has letters, so cutting ends.
    """
    size = F.length("word")
    kinds = F.array(F.struct(F.lit(0).alias("gap"), size.alias("m")), F.struct(F.lit(1).alias("gap"), size.alias("m")), F.struct(F.lit(1).alias("gap"), (size - 1).alias("m")))
    entries = words.where(size > 0).select("word", "n", F.explode(kinds).alias("k")).select("word", "n", "k.gap", "k.m")
    entries = entries.select("word", "n", "gap", "m", F.explode(_halves(F.lit(0), F.col("m") + F.col("gap"))).alias("s")).select("word", "n", "gap", "m", "s.lo", "s.hi").where("hi > lo")
    blocks = None
    while True:
        live = stored(_keyed(entries))
        counts = live.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size"))
        large = counts.where((F.col("size") > 1) & (F.col("hi") - F.col("lo") > 1) & ((F.col("size") > BLOCK) | (F.col("size") * (F.col("hi") - F.col("lo")).cast("long") > LETTERS)))
        large = stored(large.select(*_KEY))
        n = large.count()
        if not n:
            blocks = live if blocks is None else blocks.unionByName(live)
            break
        hot = bounded(large)
        light = live.join(hot, _KEY, "left_anti").select(live.columns)
        blocks = light if blocks is None else blocks.unionByName(light)
        entries = live.join(hot, _KEY, "left_semi").select("word", "n", "gap", "m", F.explode(_halves(F.col("lo"), F.col("hi"))).alias("s")).select("word", "n", "gap", "m", "s.lo", "s.hi")
    middle = F.expr("substring(word, lo + 1, hi - lo)")
    dealt = blocks.select("word", "n", *_KEY, middle.alias("middle"), (size > F.col("m")).alias("long")).repartition(*[F.col(k) for k in _KEY])
    return dealt.sortWithinPartitions(*_KEY, F.when(F.col("lo") > 0, F.col("word")).otherwise(F.reverse("word"))).mapInArrow(_scan, "word string, other string, other_n long")


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root of each of words (word, n).

    form is the near word of the largest n (ties: the smallest in code-point order) if that is times the word's n or more,
    else null; root is where forms lead to, the word itself if it has none. Chains of forms are followed in rounds
    that double their reach; counts grow along them (times must be 2 or more), so there are few rounds and no circles.
    """
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    has = -F.col("best.less") >= times * F.col("n")
    table = stored(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")))
    reach = stored(table.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(reach.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = step.where("moved").limit(1).count()
        release(reach)
        reach = step
        if not moved:
            break
    return table.join(reach.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
