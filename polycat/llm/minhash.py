"""Near-duplicate documents: b-bit MinHash signatures, a multi-index Hamming join, and links confirmed on whole sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polycat.llm.common import TEXT_ROWS, bounded, fresh, keyed, numbered, release, scratch, stored
from polycat.llm.graph import components
from polycat.llm.text import U, mix, shingles, slices, word_hashes

#: 48 components of 16 bits in 12 chunks of 4. A pair that differs in at most 23 components has a chunk with at most
#: one error (12 * 2 > 23). A pair of similarity 0.8 differs in more with a probability under 2e-6.
COMPONENTS, CHUNKS, DISTANCE = 48, 12, 23
#: Rows of a bucket that are compared in one block by signature, and hashes of the sets of those that are then compared whole.
BLOCK, HASHES = 2048, 1 << 20
#: Rows whose signatures are compared with a block's at once.
STRIPE = 64
_A = np.random.default_rng(6).integers(0, 1 << 63, COMPONENTS, dtype=np.uint64) * U(2) + U(1)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s, digest_size=16).digest()


def _sets(words: int):
    """mapInArrow function: id, sorted array of the document's shingle hashes, the array's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, off, data in slices(batch.column(1)):
                sets = shingles(*word_hashes(off, data), words)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32), pa.array(np.concatenate(sets).view(np.int64)))
                digests = pa.array([_digest(s) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists, digests], ["_id", "_set", "_digest"])

    return run


def _signatures(words: int):
    """mapInArrow function: id, size of the set, digest of the set, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, off, data in slices(batch.column(1)):
                sets = shingles(*word_hashes(off, data), words)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                sig = np.zeros((len(sets), COMPONENTS), np.uint16)
                if len(full):
                    every, first = np.concatenate([sets[i] for i in full]), np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    for j in range(COMPONENTS):
                        sig[full, j] = mix(np.minimum.reduceat(every * _A[j], first)).astype(np.uint16)
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())], ["_id", "n_shingles", "_digest", "_sig"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, COMPONENTS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk and each of its components left out (the allowed error), a key of the other components."""
    width = COMPONENTS // CHUNKS
    for whole in batches:
        for lo in range(0, len(whole), 2000):
            batch = whole.slice(lo, 2000)
            sig, keys = _matrix(batch.column(1)).astype(U), []
            for chunk in range(CHUNKS):
                for out in range(width):
                    key = np.full(len(sig), chunk * width + out + 1, U)
                    for j in range(width):
                        if j != out:
                            key = mix(key) + sig[:, chunk * width + j]
                    keys.append((mix(key) & ~U(63) | U(chunk * width + out)).view(np.int64))  # the low bits say which key it is
            ids = np.tile(np.asarray(batch.column(0)), len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(ids, pa.int64())], ["_key", "_rep"])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are as similar as asked."""
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _by_cell(work):
    """mapInArrow function over rows sorted by _cell: work() on a table of whole cells at a time, which holds one large cell or several small ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []  # rows of the last cell so far
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not len(t):
                continue
            cell = np.asarray(batch.column(0))
            if parts and parts[-1].column("_cell")[-1].as_py() != cell[0]:
                yield work(pa.concat_tables(parts))
                parts = []
            last = np.flatnonzero(cell != cell[-1])
            if len(last):
                yield work(pa.concat_tables([*parts, t.slice(0, last[-1] + 1)]))
                parts, t = [], t.slice(last[-1] + 1)
            parts.append(t)
        if parts:
            yield work(pa.concat_tables(parts))

    return run


def _columns(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.asarray(t.column(k).combine_chunks()) for k in names]


def _cuts(cell: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last row (exclusive) of each cell."""
    ends = [*(np.flatnonzero(np.diff(cell)) + 1), len(cell)]
    yield from zip([0, *ends[:-1]], ends, strict=True)


def _apart(comp: np.ndarray, side: np.ndarray, n: np.ndarray, rows: slice, percent: int) -> np.ndarray:
    """Which pairs of some rows and all rows are of different components, to be compared in this cell, and of sizes that allow the similarity."""
    here = (side[rows][:, None] != side) | (side[rows] == 2)[:, None]
    low, high = np.minimum(n[rows][:, None], n), np.maximum(n[rows][:, None], n)
    return here & (comp[rows][:, None] != comp) & (100 * low >= percent * high)


def _suspects(percent: int):
    """Rows of a bucket that have another of a different component within the signature distance."""

    def work(t: pa.Table) -> pa.RecordBatch:
        cell, key, side, rep, comp, n = _columns(t, "_cell", "_key", "_side", "_rep", "_comp", "_n")
        sig, hit = _matrix(t.column("_sig")), np.zeros(len(cell), bool)
        for lo, hi in _cuts(cell):
            c, d, m, s = comp[lo:hi], side[lo:hi], n[lo:hi], sig[lo:hi]
            for at in range(0, hi - lo, STRIPE):
                rows = slice(at, at + STRIPE)
                i, j = np.nonzero(_apart(c, d, m, rows, percent))
                for k in range(0, len(i), 1 << 16):  # some MB of signatures at a time
                    x, y = i[k : k + (1 << 16)] + at, j[k : k + (1 << 16)]
                    near = (s[x] == s[y]).sum(axis=1) >= COMPONENTS - DISTANCE
                    hit[lo + x[near]] = hit[lo + y[near]] = True
        return pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(rep[hit])], ["_key", "_rep"])

    return _by_cell(work)


def _within(percent: int):
    """Links that join components, found among the rows of a cell, a bucket or a block of two of its parts.

    A pair is looked at in the first of the buckets that it shares only, and only while its components are apart.
    """
    width = COMPONENTS // CHUNKS

    def links(index, side, rep, comp, n, sig, sets) -> list[tuple[int, int]]:
        label, found = np.unique(comp, return_inverse=True)[1], []
        for i in range(len(rep) - 1):
            j = np.flatnonzero(_apart(label, side, n, slice(i, i + 1), percent)[0, i + 1 :]) + i + 1
            same = sig[j] == sig[i]
            j, same = j[(far := same.sum(axis=1) >= COMPONENTS - DISTANCE)], same[far]
            if not len(j):
                continue
            chunks = same.reshape(-1, CHUNKS, width)
            first = np.argmax(chunks.sum(axis=2) >= width - 1, axis=1)
            out = np.argmin(chunks[np.arange(len(j)), first], axis=1)  # the component that differs, or 0
            for k in j[first * width + out == index]:
                if label[k] != label[i] and _linked(sets[i], sets[k], percent):
                    found.append((min(rep[i], rep[k]), max(rep[i], rep[k])))
                    label[label == label[k]] = label[i]
        return found

    def work(t: pa.Table) -> pa.RecordBatch:
        cell, key, side, rep, comp, n = _columns(t, "_cell", "_key", "_side", "_rep", "_comp", "_n")
        lists = t.column("_set").combine_chunks()
        off, every = np.asarray(lists.offsets), np.asarray(lists.values).view(U)  # sorted as unsigned numbers
        sets, sig, out = [every[off[i] : off[i + 1]] for i in range(len(cell))], _matrix(t.column("_sig")), []
        for lo, hi in _cuts(cell):
            out += links(key[lo] & 63, side[lo:hi], rep[lo:hi], comp[lo:hi], n[lo:hi], sig[lo:hi], sets[lo:hi])
        out = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    return _by_cell(work)


def _blocked(rows: DataFrame, size) -> DataFrame:
    """rows (_key, _rep, _n, ...) in cells: each bucket is cut in size() parts by hash, and each pair of parts meets in one cell."""
    parts = rows.groupBy("_key").agg(size.cast("int").alias("_parts"))
    rows = rows.join(parts, "_key").withColumn("_part", F.pmod(F.xxhash64("_rep"), F.col("_parts")).cast("int"))
    rows = rows.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    low, high = F.least("_part", "_with"), F.greatest("_part", "_with")
    side = F.when(F.col("_part") == F.col("_with"), 2).when(F.col("_part") < F.col("_with"), 0).otherwise(1)
    return rows.select(F.xxhash64("_key", low, high).alias("_cell"), "_key", side.alias("_side"), "_rep", "_comp", "_n")


def _sorted(cells: DataFrame) -> DataFrame:
    return cells.repartition("_cell").sortWithinPartitions("_cell")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id, kept for each row of docs.

    Words are runs without white space, A-Z lower-cased. A document's set: its distinct shingles of `words` words; with
    fewer words the whole sequence; null, empty and blank texts have the empty set and are linked with nothing. Two
    documents are linked if 100 * |both| >= percent * |either|; component_id is the smallest id reachable by links and
    kept says that it is the row's own. Repeated rows share a component. Rows that share an id but not the text are
    compared each by itself. Rows without an id but with the set of others share their component; such sets that no row
    with an id has are linked with nothing, and their component_id is null.

    1. One scan makes each set's size, digest and signature; equal sets are one class.
    2. Keys of the signatures' chunks, with one component left out at a time, gather classes in buckets: by the
       pigeonhole all pairs within the signature distance meet. In each bucket the smallest and the largest class are
       candidates with every member: linear in the bucket, however many near copies it holds.
    3. Candidates within the distance are confirmed on their whole sets and joined to components.
    4. What is left in a bucket between different components is compared by signature, in blocks of bounded size. Only
       rows that are near one of another component send their whole sets, to blocks of bounded size again, where
       each pair is compared in one bucket only and only links that join components leave the task. So no link is
       lost whatever the bucket's size.

    Sets are compared as 64-bit hashes of their shingles: two different shingles of a pair of documents of n shingles
    each are taken for one with a probability of about n * n / 2**64, 1e-9 for texts of 100,000 words.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    signed = stored(texts.mapInArrow(_signatures(words), "_id long, n_shingles long, _digest binary, _sig binary"), TEXT_ROWS)
    sets = signed.where("n_shingles > 0 and _id is not null").groupBy("_digest")
    classes = numbered(sets.agg(F.min("_id").alias("_first"), F.min("_sig").alias("_sig"), F.min("n_shingles").alias("_n")), "_rep")
    keys = stored(classes.select("_rep", "_sig").mapInArrow(_keys, "_key long, _rep long"))
    buckets = keys.groupBy("_key").agg(F.min("_rep").alias("_low"), F.max("_rep").alias("_high")).where("_low < _high")
    members = stored(keys.join(buckets, "_key"))
    release(keys)
    ends = F.explode(F.array("_low", "_high")).alias("_end")
    stars = members.select("_rep", ends).where("_rep <> _end").select(F.least("_rep", "_end").alias("a"), F.greatest("_rep", "_end").alias("b")).distinct()
    links = _confirmed(stored(_near(stars, classes, percent)), classes, texts, words, percent)
    labels = components(links)
    known = stored(classes.join(labels, F.col("_rep") == F.col("id"), "left").select("_rep", "_n", "_sig", F.coalesce("component", "_rep").alias("_comp")))
    placed = members.where("_rep <> _low and _rep <> _high").select("_key", "_rep").join(known.select("_rep", "_n", "_comp"), "_rep")
    mixed = placed.groupBy("_key").agg(F.min("_comp").alias("_c0"), F.max("_comp").alias("_c1")).where("_c0 < _c1").select("_key")
    rest = stored(placed.join(mixed, "_key", "left_semi"))
    release(members)
    cells = _sorted(_blocked(rest, F.ceil(F.count(F.lit(1)) / BLOCK)).join(known.select("_rep", "_sig"), "_rep").select("_cell", "_key", "_side", "_rep", "_comp", "_n", "_sig"))
    near = stored(stored(cells.mapInArrow(_suspects(percent), "_key long, _rep long")).distinct().join(known, "_rep"))
    release(rest)
    wanted = _sets_of(near.select("_rep").distinct(), classes, texts, words)
    cells = _blocked(near, F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("_n") / HASHES)))
    cells = _sorted(cells.join(known.select("_rep", "_sig"), "_rep").join(wanted, "_rep").select("_cell", "_key", "_side", "_rep", "_comp", "_n", "_sig", "_set"))
    links = links.union(stored(cells.mapInArrow(_within(percent), "a long, b long"), TEXT_ROWS))
    labels = components(links)
    grouped = stored(classes.join(labels, F.col("_rep") == F.col("id"), "left").select("_digest", "_first", F.coalesce("component", "_rep").alias("_comp")))
    first = grouped.groupBy("_comp").agg(F.min("_first").alias("component_id"))
    of_class = grouped.join(first, "_comp").select("_digest", "component_id")
    out = signed.select("_id", "n_shingles", "_digest").join(of_class, "_digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("_id")).otherwise(F.col("component_id"))
    return out.select(F.col("_id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"))


def _sets_of(reps: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """_rep, _set of some classes: the texts of their first ids are read again, and digests tell apart those that share an id."""
    want = stored(classes.join(reps, "_rep").select("_rep", "_first", "_digest"))
    some = texts.join(bounded(want.select("_first").distinct()), F.col("_id") == F.col("_first"), "left_semi")
    sets = some.mapInArrow(_sets(words), "_id long, _set array<long>, _digest binary").join(bounded(want), "_digest")
    return stored(sets.select("_rep", "_set").dropDuplicates(["_rep"]), TEXT_ROWS)


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose signatures are within the distance."""
    of = lambda c: classes.select(F.col("_rep").alias(c), F.col("_sig").alias(f"_s{c}"), F.col("_n").alias(f"_n{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keep = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(axis=1) <= DISTANCE
                yield batch.select([0, 1]).filter(pa.array(keep))

    joined = pairs.join(of("a"), "a").join(of("b"), "b").where(100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))
    return joined.select("a", "b", "_sa", "_sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets are as similar as asked."""
    sets = _sets_of(pairs.select("a").union(pairs.select("b")).distinct().toDF("_rep"), classes, texts, words)
    of = lambda c: sets.select(F.col("_rep").alias(c), F.col("_set").alias(f"_{c}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a").withColumn("_both", F.size(F.array_intersect("_a", "_b")))
    return stored(both.where(100 * F.col("_both") >= percent * (F.size("_a") + F.size("_b") - F.col("_both"))).select("a", "b"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: the one whose id is the smallest, those without an id last; rows without words all stay.

    Rows are compared and dropped by a key of their own, so rows that share an id or have none are decided one by one.
    Only rows of components of several rows are looked up for their ids.
    """
    own, name = fresh(docs, "_own"), fresh(docs, "_gone")
    rows = keyed(docs, own)
    with scratch() as keep:
        near = near_duplicates(rows, words, percent, id_col=own).where("n_shingles > 0").select(F.col(own).alias("_row"), F.col("component_id").alias("_comp"))
        near = keep(stored(near))
    with scratch() as keep:
        several = stored(near.where("_row <> _comp").select(F.col("_comp").alias("_c")).distinct())
        alike = near.join(bounded(several), F.col("_comp") == F.col("_c"), "left_semi")
        alike = stored(alike.join(rows.select(F.col(own).alias("_o"), F.col("doc_id").alias("_id")), F.col("_row") == F.col("_o")).select("_row", "_comp", "_id"))
        first = alike.groupBy("_comp").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row"))["_row"].alias("_first"))
        gone = keep(stored(alike.join(bounded(stored(first)), "_comp").where("_row <> _first").select(F.col("_row").alias(name))))
    release(near)
    return rows.join(bounded(gone), F.col(own) == F.col(name), "left_anti").drop(own)
