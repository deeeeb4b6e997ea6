"""Words and their hashes over whole Arrow batches of UTF-8 texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes that are worked on at once; a longer text is worked on alone.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of words: all but white space, or only ASCII letters and digits and non-ASCII characters.
ANY, ALNUM = ~_SPACE, np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _pows(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64) and bytes of a string array; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row (exclusive), offsets from 0 and bytes of runs of rows of about `most` bytes."""
    off, data = buffers(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        yield lo, hi, off[lo : hi + 1] - off[lo], data[off[lo] : off[hi]]
        lo = hi


def spans(off: np.ndarray, data: np.ndarray, kind: np.ndarray = ANY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes of a kind within a row) and how many words each row has."""
    inside = kind[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[off[:-1][off[:-1] < len(data)]] = False
    after[off[1:][off[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def prefix_sums(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """Running sums from which hash_spans takes the hash of any run of bytes."""
    p, _ = _pows(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * p[: len(data)], out=sums[1:])
    return sums


def hash_spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes have equal hashes wherever they stand."""
    _, inverse = _pows(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U))


# Two primes below 2**31 and a base for each.
_PRIMES, _BASES = (2147483647, 2147483629), (1234567891, 987654323)
#: Bytes whose terms are summed without taking remainders first.
_EXACT = 1 << 24
_moduli: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, U), np.ones(1, U))] * 2


def _residues(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse modulo its prime."""
    if len(_moduli[k][0]) < n:
        n, p, out = max(n, SLICE + 1), _PRIMES[k], []  # all that slices need, once
        for base in (_BASES[k], pow(_BASES[k], -1, _PRIMES[k])):
            powers = np.ones(1, U)
            while len(powers) < n:
                powers = np.concatenate([powers, powers[: n - len(powers)] * U(pow(base, len(powers), p)) % U(p)])
            out.append(powers)
        _moduli[k] = (out[0], out[1])
    return _moduli[k][0][:n], _moduli[k][1][:n]


def word_hashes(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased (A-Z) word in order, and words for each row.

    Polynomials of a word's bytes modulo two primes, 62 bits: equal words have equal hashes wherever they stand, and
    there is no family of words whose hashes meet whatever the bases are, as there is modulo a power of two.
    """
    starts, ends, counts = spans(off, data)
    low = _LOWER[data]
    parts = []
    for k, p in enumerate(_PRIMES):
        powers, inverse = _residues(k, len(data) + 1)
        terms = (low + U(1)) * powers[: len(data)]
        if len(data) > _EXACT:
            terms %= U(p)
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(terms, out=sums[1:])
        parts.append((sums[ends] - sums[starts]) % U(p) * inverse[starts] % U(p))
    return mix((parts[0] << U(31) | parts[1]) + mix((ends - starts).astype(U))), counts


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles; of the whole sequence if it has fewer words."""
    r = _pows(k + 1)[0]
    first = np.concatenate([[0], np.cumsum(counts)])
    if len(words) >= k:
        sums = words[: len(words) - k + 1] * r[0]
        for j in range(1, k):
            sums = sums + words[j : len(words) - k + 1 + j] * r[j]
        sums = mix(sums + U(k))
    out = []
    for i, n in enumerate(counts):
        if n >= k:
            out.append(np.unique(sums[first[i] : first[i] + n - k + 1]))
        elif n:
            out.append(mix(np.atleast_1d((words[first[i] : first[i + 1]] * r[:n]).sum(dtype=U) + U(n))))
        else:
            out.append(np.zeros(0, U))
    return out
