"""Documents cut and packed into windows of tokens, by minimum bin slack.

Each task packs the documents that it reads, so that nothing is shuffled and no task waits for another. Whole windows of long
documents are sequences of their own; what is left of documents goes to a pool of lengths. For each window, a bitset holds the
sums that lengths of the pool can reach; the sum nearest to the window is taken and the lengths that make it are read
back from the steps, with how often each occurs. If no sum is exact, one more piece is cut to fill the window. The pool is
filled again before it runs low, and the end of a task's tokens fills sequences of ever smaller powers of two.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that a task's pool holds before windows are filled from it, and what it keeps to choose from until its input ends.
POOL, LOW = 1 << 21, 1 << 20
#: Tokens of pieces that are handed on at once.
OUT = 1 << 19
#: Parts of texts whose ids a worker keeps at most, and the longest that it keeps.
KEPT, KEPT_CHARS = 800_000, 64
#: Characters of texts that are taken apart at once.
SLICE = 1 << 18
# White space at which texts are cut; the pattern by which the tokenizer splits a text after it has
# lower-cased it, for code points below U+0300, where composing changes nothing; and what may be split so (no control
# characters, no dotted capital I).
WHITE = " \t\n\r\x0b\x0c"
_OF = lambda kind: "".join(chr(c) for c in range(0x300) if unicodedata.category(chr(c)).startswith(kind))
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_OF('L')}]+|[{_OF('N')}]|[^{_OF('L')}{_OF('N')}{WHITE}]+")
_PLAIN = re.compile(f"[{WHITE}!-~\xa1-\u012f\u0131-\u02ff]*")
_WHITE = re.compile(f"[{WHITE}]")
_open: dict[str, object] = {}


class WordEncoder:
    """Texts to ids for the tokenizer that drops white space, so that no token goes beyond a word.

    Texts fall into parts as the tokenizer splits them; each distinct part goes through the tokenizer's model once and is kept.
    Words with characters that are not lower-cased and composed one by one are parts as a whole, encoded by themselves.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        if self._ids(["a b"])[0].tolist() != [i for x in self._ids(["a", "b"]) for i in x.tolist()]:
            raise ValueError("the tokenizer keeps white space: words can't be encoded one by one")
        #: Whether texts fall into parts as _PART says; else every word is encoded as a whole.
        said = json.loads(self.tokenizer.to_str())
        split, lower = str(said["pre_tokenizer"]), str(said["normalizer"])
        self.splits = r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in split and "Lowercase" in lower and "ByteLevel" in split
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        #: How the tokenizer writes a character's bytes.
        self.bytes_of = {c: as_bytes(chr(c))[0][0] for c in range(33, 0x300)}
        self.model = self.tokenizer.model
        self.kept = _Kept(self.of_part)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (null: empty) as little-endian unsigned 32-bit integers, as the library gives them."""
        ids = self.kept.__getitem__
        out = []
        for text in texts:
            out.append(b"".join([b"".join(map(ids, self._parts(cut))) for cut in _cuts(text or "")]))
            if len(self.kept) > KEPT:
                self.kept.clear()
        return out

    def _parts(self, text: str) -> list[str]:
        """A text's parts in order; a word that must not be split follows a blank."""
        if self.splits and _PLAIN.fullmatch(text) and not self.special.search(text):
            return _PART.findall(text.lower())
        out = []
        for word in text.encode().split():  # at ASCII white space only
            word = word.decode()
            if self.splits and _PLAIN.fullmatch(word) and not self.special.search(word):
                out += _PART.findall(word.lower())
            else:
                out.append(f" {word}")
        return out

    def of_part(self, part: str) -> bytes:
        if part[0] == " ":
            return self._ids([part])[0].tobytes()
        ids = [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.bytes_of))]
        return struct.pack(f"<{len(ids)}I", *ids)


class _Kept(dict):
    """Ids of parts, found when they are first asked for."""

    def __init__(self, of_part):
        self.of_part = of_part

    def __missing__(self, part: str) -> bytes:
        ids = self.of_part(part)
        if len(part) <= KEPT_CHARS:
            self[part] = ids
        return ids


def _cuts(text: str) -> Iterator[str]:
    """A text in slices that end at white space."""
    lo = 0
    while len(text) - lo > SLICE:
        found = _WHITE.search(text, lo + SLICE)
        if not found:
            break
        yield text[lo : found.end()]
        lo = found.end()
    yield text[lo:] if lo else text


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file, opened once."""
    if path not in _open:
        _open.clear()
        _open[path] = WordEncoder(path)
    return _open[path]


def least_slack(counts: list[tuple[int, int]], capacity: int) -> tuple[dict[int, int], int]:
    """Of lengths with how many pieces have them, how many of each to take so that their sum is nearest to capacity without being above, and what is left of capacity.

    A step adds one, two, four ... pieces of a length to the bitset of sums that can be reached; it ends as soon as
    capacity is one of them. A step was taken if the sum could not be reached before it.
    """
    reach, full, mask = 1, 1 << capacity, (1 << capacity + 1) - 1
    steps: list[tuple[int, int, int]] = []
    for length, count in counts:
        left, take = min(count, capacity // length), 1
        while left > 0:
            take = min(take, left)
            more = (reach | reach << take * length) & mask
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            left -= take
            take *= 2
        if reach & full:
            break
    at = best = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + take
            at -= take * length
    return taken, capacity - best


class Pool:
    """Pieces (document, start, ids, tokens of the document) by length, and the windows that they fill."""

    def __init__(self, window: int):
        self.window, self.tokens = window, 0
        self.pieces: dict[int, list[tuple]] = {}
        self.counts = np.zeros(window + 1, np.int64)

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // 4
        self.pieces.setdefault(n, []).append((doc, start, ids, total))
        self.counts[n] += 1
        self.tokens += n

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.tokens -= length
        return self.pieces[length].pop()

    def fill(self, capacity: int) -> Iterator[list[tuple]]:
        """One or more full windows, as lists of pieces, longest first; the pool must hold capacity."""
        there = np.flatnonzero(self.counts[: capacity + 1])[::-1]
        counts = list(zip(there.tolist(), self.counts[there].tolist(), strict=True))
        taken, slack = {}, capacity
        if counts:  # what fills the window beside the longest piece, if anything does; else what fills it best
            longest, many = counts[0]
            left = int(np.searchsorted(-there, longest - capacity))  # the first that fits beside it
            rest = counts[left:] if left else [(longest, many - 1), *counts[1:]]
            taken, slack = least_slack(rest, capacity - longest)
            taken[longest] = taken.get(longest, 0) + 1
            if slack:
                taken, slack = least_slack(counts, capacity)
        times = 1 if slack or capacity < self.window else min(int(self.counts[n]) // k for n, k in taken.items())
        for _ in range(times):
            pieces = [self._take(n) for n, k in sorted(taken.items(), reverse=True) for _ in range(k)]
            if slack:  # no piece is as short, so that any will do; the longest leaves the most useful rest
                doc, start, ids, total = self._take(int(np.flatnonzero(self.counts)[-1]))
                pieces.append((doc, start, ids[: 4 * slack], total))
                self.add(doc, start + slack, ids[4 * slack :], total)
            yield pieces

    def drain(self, down_to: int) -> Iterator[list[tuple]]:
        """Windows until fewer than down_to tokens are left, but for whole windows only."""
        while self.tokens >= max(down_to, self.window):
            yield from self.fill(self.window)

    def end(self) -> Iterator[list[tuple]]:
        """All that is left: windows, then sequences of powers of two, which need no padding."""
        yield from self.drain(0)
        while self.tokens:
            yield from self.fill(1 << self.tokens.bit_length() - 1)


_SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _packing(tokenizer: str, end_id: int, window: int, kind: pa.DataType):
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [kind, *[pa.int64()] * 5, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, pool = encoder(tokenizer), np.array([end_id], "<u4").tobytes(), Pool(window)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held = 0

        def put(pieces: list[tuple]) -> None:
            nonlocal sequence, held
            at = 0
            for doc, start, ids, total in pieces:
                n = len(ids) // 4
                rows.append((doc, start, n, total, sequence, at, ids))
                at += n
            held += at
            sequence += 1

        def out() -> pa.RecordBatch:
            nonlocal rows, held
            columns = list(zip(*rows, strict=True))
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for lo in range(0, len(batch), 200):
                some = batch.slice(lo, 200)
                for doc, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist()), strict=True):
                    ids += end
                    total = len(ids) // 4
                    whole = total - total % window
                    for start in range(0, whole, window):
                        put([(doc, start, ids[4 * start : 4 * (start + window)], total)])
                        if held >= OUT:
                            yield out()
                    if whole < total:
                        pool.add(doc, whole, ids[4 * whole :], total)
                if pool.tokens >= POOL:
                    for pieces in pool.drain(LOW):
                        put(pieces)
                        if held >= OUT:
                            yield out()
                if held >= OUT:
                    yield out()
        for pieces in pool.end():
            put(pieces)
            if held >= OUT:
                yield out()
        if rows:
            yield out()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: id_col, start (ids of its document before it), length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    A document is its text's ids (null text: none) and end_id. Every id lies in one piece, pieces of a sequence follow each
    other from 0 on, and every sequence has window ids or, at the end of a task's rows, a smaller power of two, so that none
    needs padding; window is a power of two. Documents are cut at window and else only where no sum of lengths is exact.
    Rows that share an id (or have none) are documents of their own; other columns are left out; an empty table gives no
    pieces. A long text is encoded whole, in one row of memory.

    No shuffle: a task holds POOL tokens of pieces at most, besides the row that it reads. Where the rows of docs come in an order that
    changes when a task runs again, store docs first, as for any numbering of rows.
    """
    if window & window - 1:
        raise ValueError("window must be a power of two")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return rows.mapInArrow(_packing(tokenizer, end_id, window, arrow), f"doc_id {kind}, {_SCHEMA}").withColumnRenamed("doc_id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids of each sequence, its pieces joined in order (a sequence has at most a window of ids)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p.ids)).alias("ids"))
