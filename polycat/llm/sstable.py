"""Token ids of documents in sorted-string-table shards, and their reading and look-up.

A shard is blocks, a block index, a Bloom filter of the keys and a footer. Keys are document ids as 8 bytes that sort
as the ids do (no bytes for a null id, which sorts first); in a block each key leaves out the bytes that it shares with
the one before. Values are the ids as little-endian unsigned integers of 2 or 4 bytes. Blocks are compressed one by
one and the index has the first key of each, so that a look-up reads the footer, the filter, the index and one block.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polycat.llm.common import TEXT_ROWS, shared_dir, stored
from polycat.llm.text import U, mix

MAGIC = b"PCSST001"
FOOTER = struct.Struct("<QQQQQQB7x8s")  # index and filter: place and length; documents; ids; bytes of an id; magic
ENTRY = struct.Struct("<BBI")  # key bytes shared with the one before, own key bytes, value bytes
BLOCK = 1 << 16
BLOOM_BITS, BLOOM_HASHES = 10, 7
#: Distinct pieces of text whose ids a worker keeps at most.
KEPT = 1_800_000
#: Bytes of text of a shard, and the least of one while there are cores without work.
SHARD_BYTES, SMALL_BYTES = 32 << 20, 4 << 20
#: Rows that the reader hands on at once.
READ_ROWS = 10_000


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def _number(key: bytes) -> int:
    return int.from_bytes(key.rjust(8, b"\0"), "little") + len(key) & (1 << 64) - 1


def _bloom_places(numbers: np.ndarray, bits: int) -> np.ndarray:
    n = numbers.astype(U)
    one, two = mix(n), mix(n + U(0x9E3779B97F4A7C15)) | U(1)
    return (one[:, None] + two[:, None] * np.arange(BLOOM_HASHES, dtype=U)) % U(bits)


class Writer:
    """Writes one shard; keys must come in ascending order."""

    def __init__(self, sink, width: int):
        self.sink, self.width = sink, width
        self.at = self.ids = 0
        self.rows: list[bytes] = []
        self.index: list[bytes] = []
        self.keys = array("Q")  # a number for each key, for the filter
        self.size = 0
        self.last = b""

    def add(self, key: bytes, ids: np.ndarray) -> None:
        value = ids.astype(f"<u{self.width}").tobytes()
        shared = len(os.path.commonprefix([self.last, key])) if self.rows else 0
        if not self.rows:
            self.first = key
        self.rows.append(ENTRY.pack(shared, len(key) - shared, len(value)) + key[shared:] + value)
        self.size += len(self.rows[-1])
        self.last = key
        self.keys.append(_number(key))
        self.ids += len(ids)
        if self.size >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            raw = b"".join(self.rows)
            packed = pa.compress(raw, codec="zstd", asbytes=True)
            self.sink.write(packed)
            self.index.append(struct.pack("<B8sQIII", len(self.first), self.first, self.at, len(packed), len(raw), len(self.rows)))
            self.at += len(packed)
            self.rows, self.size = [], 0

    def close(self) -> None:
        self._flush()
        index = b"".join(self.index)
        bits = max(64, len(self.keys) * BLOOM_BITS)
        bloom = np.zeros(bits, bool)
        keys = np.frombuffer(self.keys, U)
        for lo in range(0, len(keys), 100_000):
            bloom[_bloom_places(keys[lo : lo + 100_000], bits).ravel().astype(np.int64)] = True
        packed = np.packbits(bloom).tobytes()
        self.sink.write(index + struct.pack("<Q", bits) + packed)
        self.sink.write(FOOTER.pack(self.at, len(index), self.at + len(index), len(packed) + 8, len(self.keys), self.ids, self.width, MAGIC))


class Shard:
    """Reads one shard from a file opened for random access."""

    def __init__(self, source):
        self.source = source
        n = source.size()
        self.i_at, self.i_len, self.b_at, self.b_len, self.n_docs, self.n_ids, self.width, magic = FOOTER.unpack(source.read_at(FOOTER.size, n - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        size = struct.calcsize("<B8sQIII")
        index = source.read_at(self.i_len, self.i_at)
        self.blocks = [struct.unpack_from("<B8sQIII", index, i) for i in range(0, len(index), size)]
        self.firsts = [b[1][: b[0]] for b in self.blocks]

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, _, at, length, raw_length, rows = self.blocks[i]
        raw = pa.decompress(self.source.read_at(length, at), decompressed_size=raw_length, codec="zstd", asbytes=True)
        at, key = 0, b""
        for _ in range(rows):
            shared, own, length = ENTRY.unpack_from(raw, at)
            at += ENTRY.size
            key = key[:shared] + raw[at : at + own]
            at += own
            yield key, np.frombuffer(raw, f"<u{self.width}", length // self.width, at)
            at += length

    def scan(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.blocks)):
            yield from self.block(i)

    def may_hold(self, key: bytes) -> bool:
        raw = self.source.read_at(self.b_len, self.b_at)
        bits = struct.unpack_from("<Q", raw)[0]
        bloom = np.unpackbits(np.frombuffer(raw, np.uint8, offset=8))
        return bool(bloom[_bloom_places(np.array([_number(key)], U), bits).astype(np.int64)].all())

    def get(self, key: bytes) -> list[np.ndarray]:
        """The values of a key: none, one, or several where documents share an id."""
        if not self.blocks or not self.may_hold(key):
            return []
        out = []
        for i in range(max(0, bisect.bisect_left(self.firsts, key) - 1), len(self.blocks)):
            if self.firsts[i] > key:
                break
            out += [v for k, v in self.block(i) if k == key]
        return out


# White space of the byte-level tokenizers' split pattern.
_ASCII_WHITE = "".join(map(chr, [*range(9, 14), 0x20]))
_ODD_WHITE = "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_WHITE = _ASCII_WHITE + _ODD_WHITE
_PIECE = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_IS_WHITE = np.isin(np.arange(256), np.frombuffer(_ASCII_WHITE.encode(), np.uint8))
# Letters and signs that every version of Unicode calls so; pieces of these and ASCII digits are split here as the tokenizers' pattern does.
_PLAIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250), *range(0x400, 0x482), *range(0x2010, 0x2028), *range(0x3041, 0x3095), *range(0x4E00, 0x9FA6)) if c != 0xAD]
_LETTERS = "".join(c for c in _PLAIN if unicodedata.category(c)[0] == "L")
_SIGNS = re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] in "PS"))
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+")
#: The character that stands for each byte in a byte-level vocabulary.
_BYTES = {b: b if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD else None for b in range(256)}
_BYTES.update({b: 256 + i for i, b in enumerate(b for b, c in _BYTES.items() if c is None)})
_SPACE = chr(_BYTES[0x20])
_open: dict[str, tuple] = {}
#: Pieces that are encoded in one call, and bytes of texts that are taken at once.
LINES, CHUNK = 300, 4 << 20


def _places(a: pa.Array) -> np.ndarray:
    return np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]


class Encoder:
    """Whole texts to ids. Where the tokenizer splits as byte-level ones do, no token goes over the border of a piece (a run of no white space and one space before it), so that each distinct piece is encoded once and kept.

    Pieces are found in the bytes of a column, numbered by Arrow's dictionary, and their ids put together in numpy, so that only
    distinct pieces become Python's strings. A piece of common letters, digits and signs goes part by part through the
    tokenizer's model; others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.plain = path, None
        #: For pieces, in which no special token's string stands, so that the tokenizer needn't look for one.
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            how = json.load(f)
        #: Strings that the tokenizer takes out of a text before it is split; texts with one are encoded whole.
        self.added = [t["content"] for t in how.get("added_tokens") or []]
        split = how.get("pre_tokenizer") or {}
        self.by_piece = how.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if self.by_piece:
            (self.line_end,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.tokenize = self.tokenizer.model.tokenize
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._forget()

    def _forget(self) -> None:
        #: The number of each piece; the ids of all pieces, one after the other; where each piece's begin.
        self.kept: dict[bytes, int] = {}
        self.ids, self.at = array("I"), array("q", [0])

    def _all(self, texts: list[str]) -> list[np.ndarray]:
        """Whole texts as the library encodes them."""
        if self.plain is None:
            self.plain = type(self.tokenizer).from_file(self.path)
        return [np.array(e.ids, "<u4") for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column (null: empty)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        places, lo = _places(texts), 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(places, places[lo] + CHUNK, "right")) - 1)
            yield from self._some(texts.slice(lo, hi - lo))
            lo = hi

    def _some(self, texts: pa.Array) -> list[np.ndarray]:
        if not self.by_piece:
            return self._all(texts.to_pylist())
        out = self._pieces(texts)
        for a in self.added:
            whole = np.flatnonzero(pc.match_substring(texts, a).to_numpy(zero_copy_only=False))
            for i, ids in zip(whole, self._all([texts[i].as_py() for i in whole.tolist()]), strict=True):
                out[i] = ids
        return out

    def _starts(self, texts: pa.Array, b: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where pieces begin among the bytes b of texts, which begin and end at places: as _PIECE finds them."""
        white = _IS_WHITE[b]
        first = white.copy()
        first[1:] &= ~white[:-1]  # white space after a word
        last = places[1:][places[1:] > places[:-1]] - 1
        ends = first[last]
        first[:-1] |= white[:-1] & ~white[1:]  # the last white space before a word, to which it belongs if it is a space
        first[last] = ends
        first[1:] |= ~white[1:] & white[:-1] & (b[:-1] != 0x20)
        first[places[:-1][places[1:] > places[:-1]]] = True
        for i in np.flatnonzero(pc.match_substring_regex(texts, f"[{_ODD_WHITE}]").to_numpy(zero_copy_only=False)):
            lengths = [len(p.encode()) for p in _PIECE.findall(texts[int(i)].as_py())]
            first[places[i] : places[i + 1]] = False
            first[places[i] + np.cumsum([0, *lengths[:-1]])] = True
        return np.flatnonzero(first)

    def _pieces(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.kept) > KEPT:
            self._forget()
        places, data = _places(texts), texts.buffers()[2]
        b = np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]]
        if not len(b):
            return [np.zeros(0, "<u4")] * len(texts)
        places = places - places[0]
        starts = self._starts(texts, b, places)
        cuts = pa.py_buffer(np.append(starts, len(b)))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, cuts, pa.py_buffer(b)]).dictionary_encode()
        here = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()  # many times faster than to_pylist()
        self._keep([p for p in here if p not in self.kept])
        number = np.fromiter(map(self.kept.__getitem__, here), np.int64, len(here))[pieces.indices.to_numpy()]
        at = np.frombuffer(self.at, np.int64)
        begin = at[number]
        count = at[number + 1] - begin
        before = np.concatenate([[0], np.cumsum(count)])
        ids = np.frombuffer(self.ids, "<u4")[np.repeat(begin - before[:-1], count) + np.arange(before[-1])]
        return np.split(ids, before[np.searchsorted(starts, places[1:-1])])

    def _add(self, piece: bytes, ids: Iterable[int]) -> None:
        self.ids.extend(ids)
        self.at.append(len(self.ids))
        self.kept[piece] = len(self.at) - 2

    def _add_part(self, key: bytes, part: str) -> None:
        coded = part.replace(" ", _SPACE) if part.isascii() else key.decode("latin-1").translate(_BYTES)
        self._add(key, [t.id for t in self.tokenize(coded)])

    def _keep(self, new: list[bytes]) -> None:
        """Encodes pieces. Those for the whole tokenizer that end in a letter, digit or sign go in one text of a line each, which saves what each call costs: line ends are tokens of their own there."""
        lines, rest = [], []
        for b in new:
            if b in self.kept:  # by now, as a part
                continue
            p = b.decode()
            parts = _PART.findall(p)
            if len(parts) == 1 and len(parts[0]) == len(p):
                self._add_part(b, p)
            elif sum(map(len, parts)) == len(p):
                keys = [part.encode() for part in parts]
                for key, part in zip(keys, parts, strict=True):
                    if key not in self.kept:
                        self._add_part(key, part)
                ids = array("I")
                for n in map(self.kept.__getitem__, keys):
                    ids += self.ids[self.at[n] : self.at[n + 1]]
                self._add(b, ids)
            else:
                (rest if p[-1] in _WHITE else lines).append(p)
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self._add(p.encode(), e.ids)
        for lo in range(0, len(lines), LINES):
            some = lines[lo : lo + LINES]
            ids = self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids
            ends = [*np.flatnonzero(np.array(ids) == self.line_end).tolist(), len(ids)]
            at = 0
            for p, end in zip(some, ends, strict=True):
                self._add(p.encode(), ids[at:end])
                at = end + 1


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, opened once."""
    if path not in _open:
        _open.clear()
        _open[path] = Encoder(path)
    return _open[path]


def _writing(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, path = fs.FileSystem.from_uri(folder)
        name, trial = f"part-{part:06d}.sst", f"{path}/_trial-{part:06d}-{uuid.uuid4().hex}"
        enc, end, w = encoder(tokenizer), np.array([end_id], "<u4"), None
        for batch in batches:
            if w is None and len(batch):
                sink = store.open_output_stream(trial)
                w = Writer(sink, enc.width)
            for i, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1)), strict=True):
                w.add(key_of(i), np.concatenate([ids, end]))
        if w is not None:
            w.close()
            sink.close()
            store.move(trial, f"{path}/{name}")  # a task that runs twice leaves the same shard
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [len(w.keys)], "ids": [w.ids]})

    return run


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes docs (null texts: empty) with end_id after each and writes shards in ascending order of id_col to folder; returns part, file, docs, ids of each shard.

    One range shuffle of the texts puts ids in order; texts, not ids, are shuffled, since they are smaller. Rows that
    share an id (or have none) stand side by side, and their place in the table cuts the ranges too, so that an id of a
    third of the rows fills several shards, in each of which its rows are in the order of a hash of their text. The number of shards follows the bytes of text. An empty table gives none.
    Texts that hold a special token's string are encoded as the library does with add_special_tokens=False: the string
    becomes that token.
    """
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    small = min(4 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // SMALL_BYTES))
    n = max(1, small, -(-total // SHARD_BYTES))
    # ranges are cut by id and place in the table, so that finding the cuts reads no texts
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(n, F.col("_id").asc_nulls_first(), "_at")
    ordered = dealt.select("_id", "_text").sortWithinPartitions(F.col("_id").asc_nulls_first(), F.xxhash64("_text"))
    return stored(ordered.mapInArrow(_writing(folder, tokenizer, end_id), "part long, file string, docs long, ids long"), TEXT_ROWS)


def read_shards(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, shard of each document, from the shards' files: one task's work is a file."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        rows = []
        for files in batches:
            for name, start in zip(files.column(0).to_pylist(), files.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{path}/{name}") as f:
                    for key, ids in Shard(f).scan():
                        rows.append((id_of(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), name))
                        start += len(ids)
                        if len(rows) == READ_ROWS:
                            yield batch(rows)
                            rows = []
        if rows:
            yield batch(rows)

    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row for each shard
    n = max(1, shards.count())
    files = shards.select("file", before.alias("start")).repartitionByRange(n, "file")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard string")


def lookup(folder: str, shards: list[str], doc_id: int | None) -> list[np.ndarray]:
    """The ids of a document by binary search in shards that are named in order."""
    store, path = fs.FileSystem.from_uri(folder)
    out = []
    for name in shards:
        with store.open_input_file(f"{path}/{name}") as f:
            out += Shard(f).get(key_of(doc_id))
    return out


def encode_table(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes docs as shards and reads them back: doc_id, start, n_tokens, ids_crc32, shard.

    Null and empty texts are the end id alone; long texts are encoded whole; rows that share an id or have none have a
    row each, nulls first; other columns are left out, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/sst-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else re.sub("^(file:)?/+", "file:///", folder)
    return read_shards(spark, folder, write_shards(docs, folder, tokenizer, end_id))
