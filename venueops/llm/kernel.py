"""Vectorised text work inside Arrow tasks: slices of whole texts, words, rolling hashes, shingles.

A batch of texts is one run of UTF-8 bytes with offsets. Everything here works on such runs with numpy, about
``SLICE`` bytes at a time, and a text is never cut.

Hashes of substrings are differences of prefix sums: with P[i] the sum of T[byte]·B^t over t < i (mod 2^64),
the substring [s, e) has (P[e] - P[s])·B^-s, the same wherever it stands. They serve places of fixed length in bytes,
below the 1,024 bytes from which such sums have known collisions; words are hashed as wholes.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BASE = 0x9E3779B97F4A7C15  # odd
SLICE = 1 << 18

U = np.uint64


def per_process(key: str, make: Callable):
    """What ``make`` returns, made once in each Python worker (functions pickled by value keep no state)."""
    holder = sys.modules.setdefault("_venueops_llm_kept", types.ModuleType("_venueops_llm_kept"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=U) * U(BASE) + U(seed)) | U(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^n-1 and their inverses mod 2^64."""
    def make(size: int):
        out = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            full = np.full(size, base, dtype=U)
            full[0] = 1
            out.append(np.multiply.accumulate(full))
        return tuple(out)

    size = 1 << max(19, int(n).bit_length())
    up, down = per_process(f"powers{size}", lambda: make(size))
    return up[:n], down[:n]


def byte_values() -> np.ndarray:
    return per_process("bytes", lambda: constants(256, 11))


def strings(column: pa.Array) -> pa.Array:
    """Nulls as empty texts, with 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets from 0, bytes) of consecutive whole texts, about ``limit`` bytes each."""
    column = strings(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
        lo = hi


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Of bytes, or of 64-bit numbers that stand for words."""
    if values.dtype == np.uint8:
        values = byte_values()[values]
    sums = np.empty(len(values) + 1, dtype=U)
    sums[0] = 0
    np.cumsum(values * powers(len(values))[0], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of [start, end), with the length mixed in."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
    return mixed(raw + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _spaces() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _not_letters() -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[lo:hi] = False
    return table


SEPARATORS = {"space": _spaces, "punctuation": _not_letters}


def _edges(data: np.ndarray, offsets: np.ndarray, separators: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether a byte is in a word, first byte of each word, the byte after it)."""
    gap = per_process(separators, SEPARATORS[separators])[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets] = True
    inside = ~gap
    first = inside.copy()
    first[1:] &= gap[:-1] | begins[1 : len(data)]
    last = inside.copy()
    last[:-1] &= gap[1:] | begins[1 : len(data)]
    return inside, np.flatnonzero(first), np.flatnonzero(last) + 1


def _spelled(data: np.ndarray, offsets: np.ndarray, separators: str):
    """(distinct words with A-Z in lower case, each word's place among them, its first byte, the byte after it)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return pa.array([], pa.large_string()), none, none, none
    inside, starts, ends = _edges(data, offsets, separators)
    flat = per_process("lowered", _lowered)[data[inside]]
    at = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(flat)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), starts, ends


def tokens(data: np.ndarray, offsets: np.ndarray, separators: str = "space") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words with A-Z in lower case, each word's place among them, its text's row), the words in order."""
    distinct, codes, starts, _ = _spelled(data, offsets, separators)
    return distinct, codes, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, separators: str = "space"):
    """(hash of each word with A-Z in lower case, its text's row, its first byte, the byte after it), in order.

    The hash works on blocks of bytes and is not linear in them, unlike that of substrings.
    """
    distinct, codes, starts, ends = _spelled(data, offsets, separators)
    hashes = np.array([xxhash.xxh3_64_intdigest(x, 0x5EED) for x in distinct.to_pylist()], dtype=U)[codes]
    return hashes, np.searchsorted(offsets, starts, "right") - 1, starts, ends


def sequences(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Each text's words with A-Z in lower case, one space between them: equal for equal sequences of words only."""
    if not len(data):
        return [b""] * (len(offsets) - 1)
    kept, _, ends = _edges(data, offsets, "space")
    line = per_process("lowered", _lowered)[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets] = True
    gaps = ends[~begins[ends]]  # the byte after a word, if the text goes on
    kept[gaps] = True
    line[gaps] = 0x20
    at = np.r_[0, np.cumsum(kept)][offsets]
    flat = line[kept].tobytes()
    return [flat[a:b].rstrip(b" ") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def exact_grams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`distinct_grams`, but numbers in place of hashes: equal within this call for equal shingles only."""
    _, codes, rows = tokens(data, offsets)
    total = len(codes)
    if not total:
        return codes, rows
    width = int(codes.max()) + 2
    left = np.bincount(rows, minlength=len(offsets) - 1)
    left = np.cumsum(left)[rows] - np.arange(total)  # words from here to the text's end
    gram = codes + 1
    for k in range(1, n):  # 0 where the text has ended
        follows = np.zeros(total, dtype=np.int64)
        follows[: max(0, total - k)] = np.where(left[: max(0, total - k)] > k, codes[k:] + 1, 0)
        gram = np.unique(gram, return_inverse=True)[1] * width + follows
    first = np.r_[True, rows[1:] != rows[:-1]]
    whole = (left >= n) | first  # a text of fewer words is one shingle
    gram, rows = np.unique(gram, return_inverse=True)[1][whole], rows[whole]
    pairs = np.unique(rows * total + gram)
    return pairs % total, pairs // total


def grams(hashes: np.ndarray, rows: np.ndarray, n: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of all ``n`` consecutive words of one text; with ``short``, texts with
    fewer words give their whole sequence as one."""
    total = len(hashes)
    if not total:
        return hashes, np.empty(0, np.int64)
    factor = constants(n, 101)
    sums = np.zeros(total, dtype=U)
    for k in range(min(n, total)):
        sums[: total - k] += mixed(hashes[k:] * factor[k]) * factor[k]
    whole = np.zeros(total, dtype=bool)
    if total >= n:
        whole[: total - n + 1] = rows[n - 1 :] == rows[: total - n + 1]
    at = np.flatnonzero(whole)
    out = mixed(sums[at])
    if short:
        heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sizes = np.diff(np.r_[heads, total])
        few = sizes < n
        extra = []
        for head, size in zip(heads[few], sizes[few], strict=True):
            value = sum(
                (mixed(hashes[head + k : head + k + 1] * factor[k]) * factor[k] for k in range(size)),
                np.zeros(1, dtype=U),
            )
            extra.append(mixed(value ^ constants(1, int(size)))[0])
        if extra:
            at = np.r_[at, heads[few]]
            out = np.r_[out, np.array(extra, dtype=U)]
    return out, at


def distinct_grams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each text's distinct ``n``-word shingles, by row; fewer words make one shingle."""
    hashes, rows, _, _ = words(data, offsets)
    values, at = grams(hashes, rows, n, short=True)
    rows = rows[at]
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    if len(values):
        fresh = np.r_[True, (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])]
        values, rows = values[fresh], rows[fresh]
    return values, rows


def sums_by(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum (mod 2^64) of the values of each of ``n`` rows; rows ascend."""
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values, out=total[1:])
    edges = np.searchsorted(rows, np.arange(n + 1))
    return total[edges[1:]] - total[edges[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(x, dtype=U).view(np.int64)
