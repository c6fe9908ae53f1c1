"""Flat numpy views of Arrow text columns, shared by the Arrow-side operators.

Texts arrive as Arrow batches.  Each batch is cut into chunks of whole documents
(``CHUNK_BYTES`` of UTF-8 unless one document alone is longer) whose bytes lie end to
end in one array, so words, lines, n-grams and windows of many documents come out of a
few array passes instead of per-row Python loops.  A null text is an empty one.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa

# Bounds a worker's arrays, which take some fifty bytes for each byte of text.
CHUNK_BYTES = 1 << 20

#: Multipliers of a polynomial hash modulo 2**64 and of its finaliser.
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class _Cache(dict):
    """What a process works out once; it never travels with a function."""

    def __reduce__(self):
        return _Cache, ()


_powers: dict[str, np.ndarray] = _Cache()


def text_chunks(batches, column="text", limit=CHUNK_BYTES, kind=pa.large_string()):
    """Yield (rows, bytes, bounds): a slice of the batch, its texts end to end, and where each begins and ends."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(column).cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j
        del texts, buffer, data
    give_back()


def give_back():
    """Hand free memory back to the system: workers live on between tasks, next to others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def integers(column, null=0):
    """An Arrow integer column as int64, nulls replaced."""
    return column.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def mix(h):
    """Spread the bits of 64-bit hashes."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(_MIX[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(_MIX[1])
    h ^= h >> np.uint64(31)
    return h


#: A 64-bit value for each byte value.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


#: The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x, k):
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def xxhash64(values):
    """Spark's xxhash64 of bigint values, as unsigned integers."""
    with np.errstate(over="ignore"):
        h = np.uint64(42 + 8) + _P5 ^ _turn(values.astype(np.int64).view(np.uint64) * _P2, 31) * _P1
        h = _turn(h, 27) * _P1 + _P4
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        return h ^ h >> np.uint64(32)


def part_of(ids, n):
    """pmod(xxhash64(id), n), as Spark has it."""
    return np.mod(xxhash64(ids).view(np.int64), n)


#: The constants of 32-bit Murmur3.
_C1, _C2, _C3, _F1, _F2 = (np.uint32(x) for x in (0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35))


def _turn32(x, k):
    return (x << np.uint32(k)) | (x >> np.uint32(32 - k))


def partition_of(values, n):
    """The one of n partitions that Spark's hash partitioning sends integers to: int32 or int64 arrays."""
    words = values.view(np.uint32).reshape(len(values), -1).T
    h = np.full(len(values), 42, np.uint32)
    for word in words:
        h = _turn32(h ^ _turn32(word * _C1, 15) * _C2, 13) * np.uint32(5) + _C3
    h ^= np.uint32(4 * len(words))
    h = (h ^ (h >> np.uint32(16))) * _F1
    h = (h ^ (h >> np.uint32(13))) * _F2
    return np.mod((h ^ (h >> np.uint32(16))).view(np.int32).astype(np.int64), n)


#: So many parts at most get balanced names: they are a literal of the plan.
BALANCED = 1 << 16


def balanced_names(parts, partitions):
    """A different int32 for each of so many parts, such that hash partitioning deals them evenly to the partitions."""
    if parts > BALANCED:
        return np.arange(parts, dtype=np.int32)
    most, size = -(-parts // partitions), 16 * (parts + partitions)
    while True:
        names = np.arange(size, dtype=np.int32)
        slot = partition_of(names, partitions)
        order = np.argsort(slot, kind="stable")
        edge = np.searchsorted(slot[order], np.arange(partitions))
        turn = np.empty(size, np.int64)
        turn[order] = np.arange(size) - edge[slot[order]]
        if np.bincount(slot, minlength=partitions).min() >= most:
            return names[np.lexsort((slot, turn))[:parts]]
        size *= 2


def _power(kind, n):
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = np.full(size, np.uint64(base), np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        if size <= 1 << 23:
            _powers[kind] = have
    return have[:n]


def prefix(values):
    """Prefix sums of a polynomial over 64-bit values; span_hash() reads the hash of any span from them."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("down", len(values)), out=sums[1:])
    return sums


def span_hash(sums, start, end):
    """Well-mixed hashes of values[start:end], equal for equal spans wherever they stand."""
    return mix((sums[end] - sums[start]) * _power("up", len(sums))[start] + (np.asarray(end) - start).astype(np.uint64))


def fixed_hash(sums, k):
    """span_hash of every span of k values."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[k:] - sums[:n]) * _power("up", n) + np.uint64(k))


def words(data, bounds, white=WHITE):
    """(starts, ends, word_bounds): the runs of bytes outside ``white``, none across documents; word_bounds as bounds, counted in words."""
    inside = ~white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = before_next = ~inside[1:]
    del before_next
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def compact(data, starts, ends):
    """The words end to end, each followed by one space, and where each begins there."""
    lengths = ends - starts
    begins = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=begins[1:])
    out = np.full(begins[-1], 32, np.uint8)
    keep = np.ones(len(out), bool)
    keep[begins[1:] - 1] = False
    out[keep] = data[spread(starts, lengths)]
    return out, begins[:-1]


def spread(starts, lengths):
    """Indexes of all places of the spans (start, length), one span after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, np.int64) - first, lengths) + np.arange(total)


def owners(bounds):
    """For each unit the number of the document that holds it."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_document(values, bounds):
    """Sums of values over each document's units."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def covered(n, starts, ends):
    """Which of n places lie in one of the spans."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0


def big_words(data):
    """At each place the next eight bytes as one big-endian integer (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(9, np.uint8)])
    return np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))


def same_bytes(blocks, a, b, lengths):
    """Whether the spans of those lengths at a and at b hold the same bytes; blocks: big_words()."""
    same = np.ones(len(a), bool)
    last = len(blocks) - 1
    live = np.arange(len(a))
    at = 0
    while len(live):
        left = lengths[live] - at
        live, left = live[left > 0], left[left > 0]
        if not len(live):
            break
        differ = blocks[np.minimum(a[live] + at, last)] ^ blocks[np.minimum(b[live] + at, last)]
        differ = differ >> (8 * np.maximum(0, 8 - left)).astype(np.uint64)
        bad = differ != 0
        same[live[bad]] = False
        live = live[~bad]
        at += 8
    return same


def sliding_min(values, w):
    """Minimum of every w consecutive values."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    span, low = 1, values
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:n], low[w - span : w - span + n])
