"""Exact substring dedup over bytes, by column-wise construction of a collection's BWT.

Every ``k``-byte string that also starts in a document with a smaller doc_id is removed.

How documents become bounded collections: windows of ``k`` bytes travel as super-k-mers to
the bucket of their minimiser (``superkmer``, ``windows``), so a string has at most 2k - m bytes
and the column-wise build needs at most that many rounds, however long a document is.  A
census leaves out minimisers that only one document has.  A bucket's strings
are built into Burrows-Wheeler transforms of about ``COLLECTION`` bytes by inserting one symbol
of each string a round, last column first: a round sorts the transform by symbol (the LF
mapping), which says where the suffixes grown by one symbol go; transform, suffix owners and
common prefixes are then merged in one sequential pass.  Common prefixes are updated for the
inserted suffixes and their successors only, up to ``k`` bytes.  At the end, runs with a
common prefix of ``k`` are the repeated windows, and their least doc_id is the owner.

The transform and its companions are arrays, not files: a task's collections are bounded, and a
task-local file would neither be shared nor survive its executor.

Edge cases: null and empty texts come back with zeros; a text shorter than ``k`` bytes loses
nothing; repeats inside one document stay, as do repeated rows of one doc_id; a null doc_id
counts as the greatest; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fragloom.llm import arrays as A
from fragloom.llm import superkmer as K
from fragloom.llm import windows as W

#: Bytes of one collection; a minimiser's strings stay together even beyond it.
COLLECTION = 1 << 18


def common_prefix(blocks, a, b, most):
    """Common prefix of the suffixes at a and at b, ``most`` at most; blocks: big_words()."""
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    last = len(blocks) - 1
    while len(live):
        differ = blocks[np.minimum(a[live] + out[live], last)] ^ blocks[np.minimum(b[live] + out[live], last)]
        equal = np.full(len(live), 8)
        for byte in range(8):
            equal -= differ >= np.uint64(1) << np.uint64(8 * byte)
        out[live] += equal
        live = live[(equal == 8) & (out[live] < most[live])]
    return np.minimum(out, most)


def build(data, at, length, k):
    """(string, left, lcp) in suffix order for the strings data[at : at + length]: whose suffix, how many bytes it has, its common prefix with the one before (k at most)."""
    n, stop = len(at), at + length
    blocks = A.big_words(data)
    string, left, lcp = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    # The transform: the symbol before each suffix, -1 where the whole string is in.
    symbols = np.where(length > 0, data[np.maximum(stop - 1, 0)].astype(np.int16), np.int16(-1))
    live = np.flatnonzero(length > 0)
    place = live.copy()
    for column in range(1, int(length.max(initial=0)) + 1):
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = n + rank[place] - int((symbols < 0).sum())
        before = stop[live] - column - 1
        preceding = np.where(length[live] > column, data[np.maximum(before, 0)].astype(np.int16), np.int16(-1))
        new = np.zeros(len(symbols) + len(live), bool)
        new[place] = True

        def merged(old, fresh, new=new, place=place):
            out = np.empty(len(new), old.dtype)
            out[~new] = old
            out[place] = fresh
            return out

        string, left, symbols, lcp = merged(string, live), merged(left, column), merged(symbols, preceding), merged(lcp, 0)
        touched = new.copy()
        touched[1:] |= new[:-1]
        touched[0] = False
        here = np.flatnonzero(touched)
        x, y = string[here - 1], string[here]
        most = np.minimum(np.minimum(left[here - 1], left[here]), k)
        lcp[here] = common_prefix(blocks, stop[x] - left[here - 1], stop[y] - left[here], most)
        longer = length[live] > column
        live, place = live[longer], place[longer]
    return string, left, lcp


def _several(hashes, ids):
    """Whether a hash belongs to more than one id."""
    order = np.lexsort((ids, hashes))
    if not len(order):
        return np.zeros(0, bool)
    edge = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    size = np.diff(np.append(edge, len(order)))
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(ids[order[edge]] < ids[order[edge + size - 1]], size)
    return out


def _verdict(k, m):
    """Spans of a bucket's windows that a smaller id holds too."""

    def later(data, f):
        at, length, ids = f["at"], f["length"], f["id"]
        sums = A.prefix(A.BYTE_VALUES[data])
        whole = A.span_hash(sums, at, at + length)
        gram = A.span_hash(sums, at + f["gram"], at + f["gram"] + m)
        order = np.lexsort((f["start"], ids, whole, gram))
        a, b = order[:-1], order[1:]
        like = np.flatnonzero((whole[a] == whole[b]) & (length[a] == length[b]))
        same = np.zeros(len(order), bool)
        same[like + 1] = A.same_bytes(A.big_words(data), at[a[like]], at[b[like]], length[a[like]])
        leader = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        copies = order[ids[order] > ids[leader]]  # equal strings of later documents: all their windows are repeats
        # One collection needs each string once; it stands for all its copies in its first document.
        heads = order[~same]
        # A window holds the 13 bytes before its minimiser or the 13 after it (for k = 50, m = 24): strings
        # that share neither of these with another document's share no window.
        half = (k - m) // 2
        before, after = f["gram"][heads] >= half, length[heads] - f["gram"][heads] >= k - half
        mark = at[heads] + f["gram"][heads]
        live = np.zeros(len(heads), bool)
        for there, low, high in ((before, -half, m), (after, 0, k - half)):
            some = np.flatnonzero(there)
            live[some] |= _several(A.span_hash(sums, mark[some] + low, mark[some] + high), ids[heads[some]])
        heads = heads[live]
        group = gram[heads]
        edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(heads) else heads
        span = np.diff(np.append(edge, len(heads)))
        weight = np.add.reduceat(length[heads], edge) if len(heads) else heads
        flags, firsts = [], []  # by string: repeated windows
        owners = []
        picked = np.arange(len(edge))
        cuts = np.flatnonzero(np.diff(np.cumsum(weight[picked]) // COLLECTION)) + 1 if len(picked) else []
        for part in np.split(picked, cuts) if len(picked) else []:
            mine = heads[A.spread(edge[part], span[part])]
            owner, windows = _repeats(data, at[mine], length[mine], ids[mine], k)
            first = np.cumsum(length[mine] - k + 1) - (length[mine] - k + 1)
            string, s, e = K.runs(windows, first)
            owners.append(mine[string])
            flags.append(s)
            firsts.append(e + k)
        owners, s, e = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, flags, firsts))
        # Verdicts hold for every occurrence of the string in its first document.
        own = order[ids[order] == ids[leader]]
        lead = leader[ids[order] == ids[leader]]
        by = np.argsort(lead, kind="stable")
        own, lead = own[by], lead[by]
        low, high = np.searchsorted(lead, owners), np.searchsorted(lead, owners, "right")
        who = own[A.spread(low, high - low)]
        s, e = np.repeat(s, high - low), np.repeat(e, high - low)
        return (
            np.concatenate([ids[copies], ids[who]]),
            np.concatenate([f["tag"][copies], f["tag"][who]]),
            np.concatenate([f["start"][copies], f["start"][who] + s]),
            np.concatenate([f["start"][copies] + length[copies], f["start"][who] + e]),
        )

    return later


def _repeats(data, at, length, ids, k):
    """(strings, flags): for all k-byte windows, string by string, whether a string of a smaller id holds the same bytes."""
    flat = data[A.spread(at, length)]
    begin = np.cumsum(length) - length
    string, left, lcp = build(flat, begin, length, k)
    whole = left >= k
    string, left, lcp = string[whole], left[whole], lcp[whole]
    edge = np.flatnonzero(lcp < k)
    least = np.repeat(np.minimum.reduceat(ids[string], edge), np.diff(np.append(edge, len(string)))) if len(string) else ids[:0]
    windows = length - k + 1
    first = np.cumsum(windows) - windows
    flags = np.zeros(int(windows.sum()), bool)
    flags[first[string] + length[string] - left] = least < ids[string]
    return string, flags


def _remover(rest):
    def remove(docs: pa.Table, spans: pa.Table) -> pa.Table:
        out = []
        for rows, data, bounds, owner, s, e in W.chunks_with_spans(docs, spans):
            gone = A.covered(len(data), bounds[owner] + s, bounds[owner] + e)
            raw = data[~gone].tobytes()
            edges = np.concatenate([[0], np.cumsum(~gone)])[bounds]
            kept = [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            filled = np.flatnonzero(np.diff(bounds))
            string, _, _ = K.runs(gone, bounds[filled])
            n_spans = np.bincount(filled[string], minlength=rows.num_rows)
            found = {"doc_id": rows.column("doc_id"), "n_bytes": pa.array(np.diff(bounds), pa.int64()), "n_removed": pa.array(A.per_document(gone, bounds), pa.int64())}
            found |= {"n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
            found |= {"kept_bytes": pa.array(kept, pa.binary())} if rest else {}
            out.append(pa.RecordBatch.from_pydict(found))
        return pa.Table.from_batches(out, schema=pa.schema(FIELDS[: 5 + rest]))

    return remove


FIELDS = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_bytes", pa.binary())]


def suffix_dedup(docs: DataFrame, k: int = 50, m: int = 24, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, hot: int | None = None, rest: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``rest``, kept_bytes: each document without the bytes of strings that an earlier one holds.

    Documents are dealt into ``parts`` by doc_id and text; windows of minimisers in more than ``hot`` places travel one by one (windows.HOT).
    """
    rows, parts = W.dealt(docs, id_col, text_col, parts)
    found = W.repeated(rows, W.Bytes, k, m, parts, _verdict(k, m), inside=False, hot=hot)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_bytes binary" * rest
    return rows.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_remover(rest), schema)


def query(spark, sf_dir):
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), rest=False)
