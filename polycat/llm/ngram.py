"""Language-model scores from a log-frequency Bloom filter of word and word-pair counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polycat.llm.common import TEXT_ROWS, numbered, release, stored
from polycat.llm.text import U, mix, slices, word_hashes

#: Hash of the end of a document, which is also what comes before its first word.
END = U(0xE0D0C0B0A0908071)
#: Level q of a count c: 1 + floor(STEPS * log2(c)); a count is kept by the keys of its levels 1 to q.
STEPS = {1: 4, 2: 2}
#: Bits of the filter for each key, and bits set for a key in its 64-bit block.
KEY_BITS, KEY_SET = 12, 5
#: Bytes of the filter in one broadcast piece, of which a worker holds one at a time, and pieces that a pass over the
#: texts has at most; a filter of more is read in several passes.
FILTER_BYTES, PIECES = 64 << 20, 24
#: Bytes of training text for each segment of the model. A text of n bytes has fewer than n tokens, so that a segment's
#: n-grams of one order, dealt by hash, and its piece of the filter are of bounded size however large the corpus is.
SEGMENT_BYTES = 8 << 20
#: Counts that come to a task before it sums those of equal keys, and cells that it gets at once.
HELD, CELLS = 4_000_000, 64
#: Keys that are looked up in the filter at once.
PROBES = 1 << 17
#: Words whose exact counts are broadcast for the base score; rarer ones are joined by a shuffle.
HEAD = 1 << 20
#: Weight of the word's own probability against the pair's count: MU, and SHARE times the count of what stands before.
MU, SHARE = 4.0, 1.0
#: Bytes of text whose n-grams are summed before they are sent on.
GATHER = 4 << 20


def pair_hashes(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(mix(before) + words)


def tokens(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each token (words and one end for each row), of what stands before each, and tokens for each row."""
    words, counts = word_hashes(off, data)
    ends = np.cumsum(counts + 1) - 1
    out = np.full(len(words) + len(counts), END, U)
    at = np.ones(len(out), bool)
    at[ends] = False
    out[at] = words
    before = np.empty_like(out)
    before[0], before[1:] = END, out[:-1]
    return out, before, counts + 1


def levels(counts: np.ndarray, order: int) -> np.ndarray:
    return 1 + np.floor(STEPS[order] * np.log2(counts) + 1e-9).astype(np.int64)


def values(q: np.ndarray, order: int) -> np.ndarray:
    """The counts that levels stand for: the middle of those with the level, 0 for level 0."""
    low, high = 2.0 ** ((q - 1) / STEPS[order]), 2.0 ** (q / STEPS[order])
    least, most = np.ceil(low - 1e-9), np.maximum(np.ceil(low - 1e-9), np.ceil(high - 1e-9) - 1)
    return np.where(q > 0, np.sqrt(least * most), 0.0)


def _places(keys: np.ndarray, level: int | np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits of a key's level in a filter segment of so many blocks."""
    h = mix(keys + U(0x9E3779B97F4A7C15) * np.asarray(level, U))
    bits = mix(h)
    mask = np.zeros(len(h), U)
    for k in range(KEY_SET):
        mask |= U(1) << (bits >> U(6 * k) & U(63))
    return h % blocks, mask


def _counting(segments: int, gather: int):
    """mapInArrow function over texts: sums of n-grams, cut by segment; all n-grams of a segment in one cell."""

    def cells(order: int, keys: np.ndarray) -> Iterator[tuple]:
        keys, n = np.unique(keys, return_counts=True)
        part = (keys % U(segments)).astype(np.int64)
        by = np.argsort(part, kind="stable")
        keys, n, cuts = keys[by], n[by].astype(np.uint32), np.searchsorted(part[by], np.arange(segments + 1))
        for s in range(segments):
            lo, hi = cuts[s], cuts[s + 1]
            if lo < hi:
                yield s, order, keys[lo:hi].tobytes(), n[lo:hi].astype(np.uint8 if n[lo:hi].max() < 256 else np.uint32).tobytes()

    def batch_of(one: list[np.ndarray], two: list[np.ndarray]) -> pa.RecordBatch:
        rows = [*cells(1, np.concatenate(one)), *cells(2, np.concatenate(two))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["segment", "order", "keys", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, size = [], [], 0
        for batch in batches:
            for _, _, off, data in slices(batch.column(0)):
                words, before, _ = tokens(off, data)
                one.append(words)
                two.append(pair_hashes(words, before))
                size += len(data)
                if size >= gather:
                    yield batch_of(one, two)
                    one, two, size = [], [], 0
        if one:
            yield batch_of(one, two)

    return run


MODEL = "segment int, order int, filter binary, bytes long, types long, tokens long, keys binary, n binary"


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(k)
    k, n = k[by], n[by]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[first], np.add.reduceat(n, first)


def piece(keys: np.ndarray, counts: np.ndarray, order: int, key_bits: int = KEY_BITS) -> np.ndarray:
    """The filter's blocks for keys of one order with their counts: every level from 1 to a key's own is set."""
    q = levels(counts, order)
    blocks = max(1, -(-int(q.sum()) * key_bits // 64))
    filled = np.zeros(blocks, U)
    level, at = 1, np.arange(len(keys))
    while len(at):
        place, mask = _places(keys[at], level, U(blocks))
        np.bitwise_or.at(filled, place.astype(np.int64), mask)
        level += 1
        at = at[q[at] >= level]
    return filled


def _merge(key_bits: int, most: int):
    """mapInArrow function over cells sorted by segment and order: each one's sums and piece of the filter. Cells come a few at a time and equal keys are summed whenever `most` of them, and as many as are summed already, have come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, pending = None, [], [], 0

        def row() -> pa.RecordBatch:
            k, n = _summed(keys, counts)
            filled, exact = piece(k, n, now[1], key_bits), now[1] == 1  # exact counts of words serve the base score
            values = (now[0], now[1], filled.tobytes(), filled.nbytes, len(k), int(n.sum()), k.tobytes() if exact else b"", n.tobytes() if exact else b"")
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            names = ["segment", "order", "filter", "bytes", "types", "tokens", "keys", "n"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for segment, order, k, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (segment, order):
                    if now is not None:
                        yield row()
                    now, keys, counts, pending = (segment, order), [], [], 0
                keys.append(np.frombuffer(k, U))
                counts.append(np.frombuffer(n, np.uint8 if 8 * len(n) == len(k) else np.uint32).astype(np.int64))
                pending += len(keys[-1])
                if pending >= max(most, len(keys[0])) and len(keys) > 1:
                    k, n = _summed(keys, counts)
                    keys, counts, pending = [k], [n], 0
        if now is not None:
            yield row()

    return run


class Filter:
    """Some segments of the filter: levels of keys by repeated membership probes."""

    def __init__(self, pieces: Iterable[tuple[int, int, bytes]], size: int, segments: int):
        self.segments = segments
        self.at = {o: np.full((2, segments), -1, np.int64) for o in (1, 2)}
        self.raw, at = bytearray(size), 0  # read back by a worker without a second copy, unlike an array
        for order, segment, raw in pieces:
            n = len(raw) // 8
            self.raw[8 * at : 8 * (at + n)] = raw
            self.at[order][:, segment] = at, n
            at += n

    def levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Level of each key, 0 if it was never seen or belongs to a segment that isn't here; probed upwards until a level is absent."""
        return np.concatenate([np.zeros(0, np.uint8), *[self._levels(keys[lo : lo + PROBES], order) for lo in range(0, len(keys), PROBES)]])

    def _levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        bits = np.frombuffer(self.raw, U)
        segment = (keys % U(self.segments)).astype(np.int64)
        start, blocks = self.at[order][0][segment], self.at[order][1][segment]
        q, level, on = np.zeros(len(keys), np.uint8), 1, np.flatnonzero(start >= 0)  # a count of 2**63 has level 253
        while len(on):
            place, mask = _places(keys[on], level, blocks[on].astype(U))
            on = on[(bits[start[on] + place.astype(np.int64)] & mask) == mask]
            q[on] = level
            level += 1
        return q


def segments_for(docs: DataFrame, text_col: str = "text") -> int:
    """How many segments the model of docs needs: one for every SEGMENT_BYTES of text."""
    return max(1, -(-(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // SEGMENT_BYTES))


def train(docs: DataFrame, segments: int, text_col: str = "text") -> DataFrame:
    """The model's segments as a stored table. Every n-gram of every text is counted: sums are made where the text is read and merged after one shuffle of cells, so that a frequent n-gram is one entry of each of them."""
    cells = docs.select(text_col).mapInArrow(_counting(segments, GATHER), "segment int, order int, keys binary, n binary")
    ordered = cells.repartition(segments, "segment", "order").sortWithinPartitions("segment", "order")
    return stored(ordered.mapInArrow(_merge(KEY_BITS, HELD), MODEL), CELLS)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, n in zip(batch.column(0), batch.column(1), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k.as_buffer(), np.int64)), pa.array(np.frombuffer(n.as_buffer(), np.int64))], ["_word", "_c"])


def _grouped(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """(order, segment, bytes) in groups of FILTER_BYTES at most; one segment's are smaller than that by SEGMENT_BYTES."""
    out, size = [[]], 0
    for order, segment, n in sorted(pieces):
        if out[-1] and size + n > FILTER_BYTES:
            out.append([])
            size = 0
        out[-1].append((order, segment, n))
        size += n
    return out


def score(docs: DataFrame, model: DataFrame, segments: int, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id_col, the columns of keep, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    base_score uses exact counts: those of the most frequent words (HEAD of them at most) are broadcast, further words
    are shuffled to their counts. score is the sum of log10 of (c(v w) + m p(w)) / (c(v) + m) with m = MU + SHARE c(v),
    p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), v the token before w, and counts c as the filter has them, a pair's no
    larger than those of its two words. Null and empty texts are one end and very long ones are scored whole; ids of any
    kind, nulls and repeated rows pass through, each with its own score; an empty table gives none.

    The filter is broadcast in pieces of FILTER_BYTES. A task with several reads one after the other for some MB of
    texts at a time, so its memory doesn't grow with them. Beyond PIECES of them there are several passes over the
    texts: each but the last writes the levels that it finds, not the texts, and the last one meets them by row.
    """
    spark = docs.sparkSession
    sizes = [tuple(r) for r in model.select("order", "segment", "bytes").collect()]  # one row for each segment and order
    n_all, types = (model.where("order = 1").agg(F.sum("tokens"), F.sum("types")).first() if sizes else (0, 0))
    n_all, types = n_all or 0, types or 0
    divisor = n_all + 0.1 * (types + 1)
    words = stored(model.where("order = 1").select("keys", "n").mapInArrow(_word_counts, "_word long, _c long"), CELLS // 16)
    head = words.orderBy(F.desc("_c"), "_word").limit(HEAD).toArrow().combine_chunks()
    known = np.asarray(head["_word"]).view(U)
    by = np.argsort(known)
    exact = spark.sparkContext.broadcast((known[by], np.asarray(head["_c"])[by]))
    groups = _grouped(sizes)
    *earlier, last = [groups[i : i + PIECES] for i in range(0, len(groups), PIECES)]

    def loaded(group):
        want = spark.createDataFrame(group or [(0, -1, 0)], "order int, segment int, bytes long").select("order", "segment")
        rows = model.join(F.broadcast(want), ["order", "segment"]).select("order", "segment", "filter").toLocalIterator()
        return spark.sparkContext.broadcast(Filter(rows, sum(n for _, _, n in group), segments))

    texts = docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias("_id"), *keep)
    if earlier:
        texts = numbered(texts, "_own")
        parts = []
        for some in earlier:
            sent = [loaded(g) for g in some]
            parts.append(stored(texts.select("_text", "_own").mapInArrow(_levels_of(sent), LEVELS), _rows(some)))
            for b in sent:
                b.unpersist()
        found = reduce(DataFrame.union, parts).repartition("_own").sortWithinPartitions("_own").mapInArrow(_joined, LEVELS)
        texts = texts.join(stored(found, TEXT_ROWS), "_own")
        release(*parts)
    else:
        texts = texts.withColumn("_levels", F.lit(None).cast("binary"))
    texts = texts.select("_text", "_levels", "_id", *keep)
    sent = [loaded(g) for g in last]
    names = [f for f in texts.schema if f.name not in ("_text", "_levels")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names)
    final = texts.mapInArrow(_scoring(sent, exact, divisor), f"{schema}, _row long, n_tokens long, _known long, _base double, score double, _word long, _times long")
    rows = stored(final, _rows(last))
    for b in (*sent, exact):
        b.unpersist()
    rare = rows.where("_word is not null").select("_row", "_word", "_times").join(words, "_word", "left").withColumn("_c", F.coalesce("_c", F.lit(0)))
    more = F.sum(F.col("_times") * F.log10((F.col("_c") + 0.1) / divisor)).alias("_more")
    rare = rare.groupBy("_row").agg(more, F.sum(F.when(F.col("_c") > 0, F.col("_times")).otherwise(0)).alias("_also"))
    out = rows.where("_word is null").join(rare, "_row", "left")
    return out.select(
        F.col("_id").alias(id_col),
        *keep,
        "n_tokens",
        (F.col("_known") + F.coalesce("_also", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"),
        "score",
    )


LEVELS = "_own long, _levels binary"


def _rows(pieces: list) -> int:
    """Rows of texts that a task gets at once: more if it has several pieces to read for them."""
    return TEXT_ROWS * min(4, len(pieces))


def _pieces(sent: list) -> Iterator[Filter]:
    """The broadcast pieces one after the other. A single one is kept by the worker, of several only the one in use, if the caller lets go of it."""
    for b in sent:
        yield b.value if len(sent) == 1 else b.load_from_path(b._path)


def _probed(sent: list, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First and last row (exclusive) of a slice of texts, its tokens' hashes, tokens for each row, and levels of each token's word, of the token before and of the pair, as three rows of bytes.

    Each piece is read once for as many slices as there are pieces, but texts are hashed and keys looked up in smaller runs, so
    that a worker holds one piece, the hashes of these slices and little else.
    """
    for group in batched(slices(texts), len(sent)):
        parts = []
        for lo, hi, off, data in group:
            words, before, counts = tokens(off, data)
            kinds, back = np.unique(words, return_inverse=True)
            pairs = pair_hashes(words, before)
            parts.append((lo, hi, words, counts, kinds, back.astype(np.int32), pairs, np.zeros(len(kinds), np.uint8), np.zeros(len(pairs), np.uint8)))
        for piece_ in _pieces(sent):  # a key is in one piece only
            for *_, kinds, _, pairs, one, two in parts:
                one |= piece_.levels(kinds, 1)
                two |= piece_.levels(pairs, 2)
            del piece_  # before the next one is read
        for lo, hi, words, counts, _, back, _, one, two in parts:
            yield lo, hi, words, counts, np.stack([one[back], np.roll(one[back], 1), two])  # what stands before the first token is an end, as the last one is


def _earlier(found: np.ndarray, cells: list, counts: np.ndarray) -> np.ndarray:
    """Levels with those that earlier passes found."""
    if cells and cells[0] is not None:
        at = np.cumsum(counts)
        for c, hi, n in zip(cells, at, counts, strict=True):
            found[:, hi - n : hi] = np.maximum(found[:, hi - n : hi], np.frombuffer(zlib.decompress(c), np.uint8).reshape(3, -1))
    return found


def _levels_of(sent):
    """mapInArrow function over texts and their rows' keys: levels that some pieces of the filter know, 0 for all other tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, counts, found in _probed(sent, batch.column(0)):
                at = np.cumsum(counts)
                cells = [zlib.compress(found[:, b - n : b].tobytes(), 1) for b, n in zip(at, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array(cells, pa.binary())], ["_own", "_levels"])

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over levels sorted by row: the largest that any pass found, one row each."""
    own, best = None, None
    for batch in batches:
        keys, cells = [], []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(c), np.uint8)
            if k != own:
                if own is not None:
                    keys.append(own)
                    cells.append(zlib.compress(best.tobytes(), 1))
                own, best = k, x
            else:
                best = np.maximum(best, x)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(cells, pa.binary())], ["_own", "_levels"])
    if own is not None:
        yield pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([zlib.compress(best.tobytes(), 1)], pa.binary())], ["_own", "_levels"])


def token_scores(found: np.ndarray, divisor: float) -> np.ndarray:
    """log10 of each token's probability by the levels of its word, of the token before and of the pair."""
    word, context = values(found[0].astype(int), 1), values(found[1].astype(int), 1)
    pair = np.minimum(values(found[2].astype(int), 2), np.minimum(word, context))
    return np.log10((pair + (MU + SHARE * context) * (word + 0.1) / divisor) / (context * (1 + SHARE) + MU))


def _scoring(sent, exact, divisor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        known, known_n = exact.value
        for batch in batches:
            for lo, hi, words, counts, found in _probed(sent, batch.column(0)):
                found = _earlier(found, batch.column(1).slice(lo, hi - lo).to_pylist(), counts)
                first = np.cumsum(counts) - counts
                each = token_scores(found, divisor)
                ids = np.arange(row, row + hi - lo)
                row += hi - lo
                kinds, back = np.unique(words, return_inverse=True)
                at = np.minimum(np.searchsorted(known, kinds), max(0, len(known) - 1))
                has = known[at] == kinds if len(known) else np.zeros(len(kinds), bool)
                c = np.where(has, known_n[at] if len(known) else 0, 0)
                base = np.where(has, np.log10((c + 0.1) / divisor), 0.0)
                rest = batch.slice(lo, hi - lo).columns[2:]
                tail = np.flatnonzero(~has[back])
                pairs, times = np.unique(np.stack([np.repeat(ids, counts)[tail].astype(U), words[tail]]), axis=1, return_counts=True) if len(tail) else (np.zeros((2, 0), U), np.zeros(0, int))
                n, m = hi - lo, len(times)
                none = lambda k, t: pa.nulls(k, t)
                main = [pa.array(ids), pa.array(counts.astype(np.int64)), pa.array(np.add.reduceat(has[back].astype(np.int64), first)), pa.array(np.add.reduceat(base[back], first)), pa.array(np.add.reduceat(each, first)), none(n, pa.int64()), none(n, pa.int64())]
                more = [pa.array(pairs[0].astype(np.int64)), none(m, pa.int64()), none(m, pa.int64()), none(m, pa.float64()), none(m, pa.float64()), pa.array(pairs[1].view(np.int64)), pa.array(times.astype(np.int64))]
                names = [*batch.schema.names[2:], "_row", "n_tokens", "_known", "_base", "score", "_word", "_times"]
                yield pa.RecordBatch.from_arrays([*rest, *main], names)
                if m:
                    yield pa.RecordBatch.from_arrays([*[pa.nulls(m, x.type) for x in rest], *more], names)

    return run


def held_out(doc_id) -> F.Column:
    """Documents that the model isn't trained on; rows without an id are."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(10)) == 0, F.lit(False))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Trains on the documents that aren't held out and scores all: score()'s columns with held_out.

    Null and empty texts are one end; whole texts are learnt and scored, however long; rows that share an id count each,
    and rows without one are learnt from. With nothing to learn from, every token is unknown; an empty table gives no rows.
    Other columns are left out, whatever their names.
    """
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    known = docs.where("not held_out")
    segments = segments_for(known)
    return score(docs, train(known, segments), segments, keep=("held_out",))
