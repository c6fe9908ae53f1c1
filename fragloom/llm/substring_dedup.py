"""Substring dedup over words: super-k-mer partitioning.

A window is ``k`` consecutive words of one document.  Consecutive windows that share a minimiser
travel as one packed string to the minimiser's bucket (``superkmer``, ``windows``); there all
windows are sorted by hash with ties checked byte for byte, so each distinct window is counted
exactly and its first occurrence (least doc_id, then start) is known.  Every later occurrence is
a span to remove.  A census leaves out minimisers that occur only once.

Edge cases: null and empty texts have no words and come back with zeros; a text shorter than
``k`` words has no window; repeated rows (same doc_id, same text) are one occurrence, so
neither removes the other; a null doc_id counts as the greatest; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fragloom.llm import arrays as A
from fragloom.llm import superkmer as K
from fragloom.llm import windows as W


def _verdict(k):
    """Spans of a bucket's windows that also start earlier."""

    def later(data, f):
        order = np.lexsort((f["start"], f["id"]))
        data = data[A.spread(f["at"][order], f["length"][order])]
        f = {name: x[order] for name, x in f.items()}
        bounds = np.concatenate([[0], np.cumsum(f["length"])])
        starts, ends, word_bounds = A.words(data, bounds)
        hashes = A.span_hash(A.prefix(A.BYTE_VALUES[data]), starts, ends)
        windows = A.fixed_hash(A.prefix(hashes), k)
        counts = np.diff(word_bounds) - k + 1
        begin = A.spread(word_bounds[:-1], counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        ids, place = f["id"][owner], f["start"][owner] + begin - word_bounds[owner]
        by = np.argsort(windows[begin], kind="stable")
        key = windows[begin][by]
        # Strings lie in order of (id, start), but windows of overlapping strings need not.
        by = by[np.lexsort((place[by], ids[by], key))] if len(by) else by
        left, right = starts[begin], ends[begin + k - 1]
        same = np.zeros(len(by), bool)
        like = np.flatnonzero(key[1:] == key[:-1])
        a, b = by[like], by[like + 1]
        equal = (right[a] - left[a]) == (right[b] - left[b])
        equal[equal] = A.same_bytes(A.big_words(data), left[a[equal]], left[b[equal]], (right - left)[a[equal]])
        if not equal.all():  # two windows with one hash: sort that bucket by the bytes themselves
            raw = data.tobytes()
            by = np.array(sorted(range(len(begin)), key=lambda i: (raw[left[i] : right[i]], ids[i], place[i])))
            same[1:] = [raw[left[i] : right[i]] == raw[left[j] : right[j]] for i, j in zip(by[:-1], by[1:], strict=True)]
        else:
            same[like + 1] = True
        head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
        flags = np.zeros(len(by), bool)
        flags[by] = same & ((ids[by] != ids[head]) | (place[by] != place[head]))
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        string, s, e = K.runs(flags, first)
        return f["id"][string], f["tag"][string], f["start"][string] + s, f["start"][string] + e + k

    return later


def _remover(texts):
    def remove(docs: pa.Table, spans: pa.Table) -> pa.Table:
        out = []
        for rows, data, bounds, owner, s, e in W.chunks_with_spans(docs, spans):
            starts, ends, word_bounds = A.words(data, bounds)
            text, _ = A.compact(data, starts, ends)
            gone = A.covered(len(starts), word_bounds[owner] + s, word_bounds[owner] + e)
            lengths = ends - starts + 1
            raw = text[np.repeat(~gone, lengths)].tobytes()
            edges = np.concatenate([[0], np.cumsum(np.where(gone, 0, lengths))])[word_bounds]
            kept = [raw[a : max(a, b - 1)] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            found = {"doc_id": rows.column("doc_id"), "n_words": pa.array(np.diff(word_bounds), pa.int64()), "n_removed": pa.array(A.per_document(gone, word_bounds), pa.int64())}
            found |= {"kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
            found |= {"kept_text": pa.array([x.decode() for x in kept], pa.string())} if texts else {}
            out.append(pa.RecordBatch.from_pydict(found))
        return pa.Table.from_batches(out, schema=pa.schema(FIELDS[: 4 + texts]))

    return remove


FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())]


def substring_dedup(docs: DataFrame, k: int = 20, m: int = 8, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, hot: int | None = None, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, kept_text: each document without the words of windows seen earlier.

    Documents are dealt into ``parts`` by doc_id and text; windows of minimisers in more than ``hot`` places travel one by one (windows.HOT).
    """
    rows, parts = W.dealt(docs, id_col, text_col, parts)
    found = W.repeated(rows, W.Words, k, m, parts, _verdict(k), inside=True, hot=hot)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * texts
    return rows.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_remover(texts), schema)


def query(spark, sf_dir):
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)


#: All windows, each as its words; a window is later if its words also start at a smaller (doc_id, start).
SQL = r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from doc)),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as n from win) where n > 1),
gone as (select distinct doc_id, j from (select doc_id, unnest(range(i, i + 20)) as j from later)),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from doc),
kept as (select doc_id, string_agg(word, ' ' order by j) as kept from word anti join gone using (doc_id, j) group by doc_id),
lost as (select doc_id, count(*) as n_removed from gone group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (doc_id) left join lost using (doc_id)
"""
