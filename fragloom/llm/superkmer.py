"""Super-k-mers: consecutive windows that share a minimiser travel as one packed string.

A window is k consecutive units (words or bytes) of one document.  Its minimiser is the
m-unit gram with the least hash in it.  Equal windows have equal minimisers, so when
every window goes to the bucket of its minimiser, equal windows meet.  Consecutive windows
with the same minimiser make one string, which carries them all in one piece: at most
2k - m units for up to k - m + 1 windows.

``pack`` cuts the strings out of a chunk, folds equal strings of the chunk together and
writes one compressed blob for each bucket; ``unpack`` reads a bucket's blobs back.
"""

from __future__ import annotations

import numpy as np

from fragloom.llm import arrays as A
from fragloom.llm import blobs as B

#: Larger chunks fold more copies and compress better.
CHUNK_BYTES = 2 << 20


def cut(grams, bounds, k, m):
    """(first, last, at): for each super-k-mer its first and last window and where its minimiser stands; grams: hashes of all m-unit grams."""
    n = int(bounds[-1])
    if n < k:
        return (np.zeros(0, np.int64),) * 3
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    least = A.sliding_min(keys, k - m + 1)
    at = (least & low).astype(np.int64)
    lengths = np.diff(bounds)
    valid = np.arange(len(at)) + k <= np.repeat(bounds[1:], lengths)[: len(at)]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | (at[1:] != at[:-1])
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends), at[first]


def pack(data, byte_at, byte_end, first, units, gram_at, gram_hash, rows, ids, tags, bounds, n_buckets, earliest_only):
    """(bucket, blob) for each bucket that gets strings of this chunk.

    byte_at, byte_end: each string's bytes; first, units: its first unit in the chunk and how many; gram_at: the
    minimiser's place in it, in bytes; gram_hash: names its bucket; rows: its document; ids, tags: of all documents; bounds: their units.
    Of equal strings in the chunk the earliest travels.  The others are settled here, as spans that ride along:
    with earliest_only all at a later place, otherwise those in a document with a greater id.
    """
    lengths, start = byte_end - byte_at, first - bounds[rows]
    hashes = A.span_hash(A.prefix(A.BYTE_VALUES[data]), byte_at, byte_end)
    own = ids[rows]
    order = np.lexsort((start, own, hashes))
    same = np.zeros(len(order), bool)
    a, b = order[:-1], order[1:]
    like = np.flatnonzero((hashes[a] == hashes[b]) & (lengths[a] == lengths[b]))
    if len(like):
        same[like + 1] = A.same_bytes(A.big_words(data), byte_at[a[like]], byte_at[b[like]], lengths[a[like]])
    leader = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    later = own[order] > own[leader]
    if earliest_only:
        later |= (own[order] == own[leader]) & (start[order] > start[leader])
    settled, rest = order[same & later], order[~(same & later)]
    gone = A.covered(int(bounds[-1]), first[settled], first[settled] + units[settled])
    filled = np.flatnonzero(np.diff(bounds))
    owner, s, e = runs(gone, bounds[filled])
    owner = filled[owner]
    buckets = (A.mix(gram_hash[rest]) % np.uint64(n_buckets)).astype(np.int64)
    by = np.lexsort((start[rest], own[rest], buckets))
    rest, buckets = rest[by], buckets[by]
    used = np.unique(buckets)
    for turn, part in enumerate(np.split(rest, np.flatnonzero(np.diff(buckets)) + 1)):
        ride = slice(turn, None, len(used))
        table, row = np.unique(rows[part], return_inverse=True)
        yield (
            int(used[turn]),
            B.dump(
                ids[owner[ride]], tags[owner[ride]], s[ride].astype(np.uint32), (e[ride] + 1).astype(np.uint32),
                ids[table], tags[table], row.astype(np.uint32),
                lengths[part].astype(np.uint32), start[part].astype(np.uint32), gram_at[part].astype(np.uint32), data[A.spread(byte_at[part], lengths[part])],
            ),
        )


def unpack(column):
    """(bytes, fields, spans): all strings of a bucket's blobs end to end, with id, tag, length, start, gram (the minimiser's place) and at (where it begins) of each, and the settled spans."""
    data, spans, parts = [], [], []
    for blob in column:
        *ride, table, tags, row, length, start, gram, body = B.load(blob.as_py())
        spans.append(np.stack([x.astype(np.int64) for x in ride]))
        parts.append([table[row], tags[row], length, start, gram])
        data.append(body)
    fields = dict(zip(("id", "tag", "length", "start", "gram"), (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)), strict=True))
    fields["at"] = np.cumsum(fields["length"]) - fields["length"]
    A.give_back()
    return np.concatenate(data), fields, np.concatenate(spans, axis=1)


def runs(flags, first):
    """(string, start, end) of the runs of True flags; first: where each string's windows begin in flags."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[first] = True
    begins = flags.copy()
    begins[1:] &= ~flags[:-1] | edge[1:-1]
    ends = flags.copy()
    ends[:-1] &= ~flags[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    owner = np.searchsorted(first, begin, "right") - 1
    return owner, begin - first[owner], end - first[owner]
