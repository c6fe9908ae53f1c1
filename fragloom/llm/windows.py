"""Finding repeated windows of all documents: a census of minimisers, strings to buckets, spans to documents.

Documents are dealt into parts by id and tag once; that exchange serves all three readers of the texts.

1. Census.  Each part sends every minimiser (``superkmer``) that it holds to a bucket by hash, once, with how
   often it stands there.  The buckets tell the parts which of their minimisers stand elsewhere too.
2. Strings.  Each part cuts out the super-k-mers of those minimisers and sends them to buckets.
   Windows of other minimisers occur once, so nothing is lost.  The strings around a minimiser that stands in
   very many places, such as the edge of a passage that a third of all documents hold, would crowd
   one bucket: its windows travel one by one, each to the bucket of its own hash.
3. Verdicts.  A bucket decides which windows are repeats, and sends their spans to the parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fragloom.llm import arrays as A
from fragloom.llm import blobs as B
from fragloom.llm import spans as S
from fragloom.llm import superkmer as K


class Bytes:
    """Documents as sequences of bytes."""

    def __init__(self, data, bounds):
        self.text, self.bounds, self.values = data, bounds, A.BYTE_VALUES[data]

    def begin(self, units):
        return units

    def end(self, units):
        """Where the unit before each of ``units`` ends."""
        return units


class Words:
    """Documents as sequences of words, each followed by one space."""

    def __init__(self, data, bounds):
        starts, ends, self.bounds = A.words(data, bounds)
        self.text, self.at = A.compact(data, starts, ends)
        self.stop = self.at + (ends - starts)
        self.values = A.span_hash(A.prefix(A.BYTE_VALUES[self.text]), self.at, self.stop)

    def begin(self, units):
        return self.at[units]

    def end(self, units):
        return self.stop[units - 1]


def _partitions(frame: DataFrame, parts: int) -> int:
    """Partitions for parts: one for each as long as a shuffle can have so many, beyond that for several, which a worker has one after another."""
    return max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(parts, A.BALANCED))


def _names(frame: DataFrame, parts: int):
    return A.balanced_names(parts, _partitions(frame, parts))


#: Bytes of text of a part, which is one group in a worker.
PART_BYTES = 16 << 20


def dealt(docs: DataFrame, id_col: str, text_col: str, parts: int | None) -> tuple[DataFrame, int]:
    """part (its name, see arrays.balanced_names) and spans.keyed() of docs, with a tag of 64 bits, and the number of parts: by default that of shuffle partitions, or more if they would hold more than PART_BYTES.

    Rows are dealt by id and tag, so that rows without id do not gather in one part.  They are dealt to partitions here
    and now, which all readers of parts share, and whose number keeps AQE from joining parts up in one task.
    """
    if not parts:
        size = S.picked(docs, text=text_col).agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    rows = S.keyed(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    part = F.pmod(F.xxhash64(F.col("id").bitwiseXOR(F.col("tag"))), F.lit(parts)).cast("int")
    if parts <= A.BALANCED:
        part = F.get(F.array(*(F.lit(int(x)) for x in _names(docs, parts))), part)
    return rows.select(part.alias("part"), "doc_id", "id", "tag", "text").repartition(_partitions(docs, parts), "part"), parts


#: A minimiser in at least so many places, and in this share of the places of a census bucket's minimisers, sends
#: its windows one by one: by itself it would fill a quarter of an ordinary bucket of strings.
HOT, HOT_SHARE = 4096, 16


def repeated(rows: DataFrame, units: type, k: int, m: int, parts: int, verdict: Callable, inside: bool, hot: int | None = None) -> DataFrame:
    """part, blob: the spans (id, tag, s, e) that verdict finds.  rows: dealt(); inside: whether a window may repeat within a document;
    hot: in how many places a minimiser is crowded, by default as HOT and HOT_SHARE say.

    verdict: makes of a bucket's bytes and fields (superkmer.unpack) the ids, tags, s and e of spans.
    """
    census = rows.groupBy("part").applyInArrow(_census(units, k, m, parts, inside), "bucket int, blob binary")
    shared = census.groupBy("bucket").applyInArrow(_shared(hot), "part int, blob binary")
    strings = rows.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_strings(units, k, m, parts, 4 * parts, inside), "bucket int, blob binary")
    return strings.groupBy("bucket").applyInArrow(_verdicts(verdict, _names(rows, parts)), "part int, blob binary")


def _cut(units, data, bounds, k, m):
    """The units of a chunk, and first and last window, minimiser's place and hash, and document of its super-k-mers."""
    seen = units(data, bounds)
    grams = A.fixed_hash(A.prefix(seen.values), m)
    first, last, gram = K.cut(grams, seen.bounds, k, m)
    return seen, first, last, gram, grams[gram], np.searchsorted(seen.bounds, first, "right") - 1


def _short(hashes, n_buckets):
    """What the census knows a minimiser by: half its hash, after the bucket that the other half gives.  Chance agreement costs work, not results."""
    bucket = (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(n_buckets)
    return (bucket << np.uint64(32)) | (hashes >> np.uint64(32))


def _census(units, k, m, n_buckets, inside):
    def count(docs: pa.Table) -> pa.Table:
        part, names, holders = int(docs.column("part")[0].as_py()), [], []
        for rows, data, bounds in A.text_chunks(docs.to_batches(), limit=K.CHUNK_BYTES):
            _, _, _, _, hashes, row = _cut(units, data, bounds, k, m)
            names.append(_short(hashes, n_buckets))
            holders.append(A.integers(rows.column("id"))[row])
        names, holders = np.concatenate(names), np.concatenate(holders)
        order = np.lexsort((holders, names))
        names, holders = names[order], holders[order]
        edge = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else names.astype(np.int64)
        size = np.diff(np.append(edge, len(names)))
        several = size > 1 if inside else holders[edge + size - 1] > holders[edge]
        names = names[edge]
        # Twice the number of places, and one if they alone make the minimiser shared.
        counts = np.minimum(2 * size + several, (1 << 32) - 2 + several).astype(np.uint32)
        rows = B.by_key((names >> np.uint64(32)).astype(np.int64), lambda at: (np.full(1, part, np.int64), names[at].astype(np.uint32), counts[at]))
        return pa.Table.from_batches([B.batch(rows, "bucket")])

    return count


def _shared(hot):
    def find(table: pa.Table) -> pa.Table:
        loaded = [B.load(blob.as_py()) for blob in table.column("blob")]
        part = np.repeat([x[0][0] for x in loaded], [len(x[1]) for x in loaded])
        names, counts = (np.concatenate([x[i] for x in loaded]) for i in (1, 2))
        order = np.argsort(names, kind="stable")
        names, counts, part = names[order], counts[order], part[order]
        edge = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        size = np.diff(np.append(edge, len(names)))
        shared = (size > 1) | (counts[edge] % 2 == 1)
        total = np.add.reduceat(counts.astype(np.int64) // 2, edge)
        most = max(HOT, int(total.sum()) // HOT_SHARE) if hot is None else hot
        keep = np.repeat(shared, size)
        names, part, crowded = names[keep], part[keep], np.repeat(total > most, size)[keep].astype(np.uint8)
        bucket = np.full(1, table.column("bucket")[0].as_py(), np.int64)
        rows = B.by_key(part, lambda at: (bucket, names[at], crowded[at]))
        return pa.Table.from_batches([B.batch(rows, "part")])

    return find


def _strings(units, k, m, n_census, n_buckets, inside):
    def pack(docs: pa.Table, shared: pa.Table) -> pa.Table:
        out, names, hot = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
        for blob in shared.column("blob"):
            bucket, short, crowded = B.load(blob.as_py())
            names.append(short.astype(np.uint64) | (bucket.astype(np.uint64) << np.uint64(32)))
            hot.append(crowded)
        names, hot = np.concatenate(names), np.concatenate(hot)
        order = np.argsort(names)
        names, hot = names[order], hot[order].astype(bool)
        for rows, data, bounds in A.text_chunks(docs.to_batches() if len(names) else [], limit=K.CHUNK_BYTES):
            seen, first, last, gram, hashes, row = _cut(units, data, bounds, k, m)
            mine = _short(hashes, n_census)
            at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
            live = np.flatnonzero(names[at] == mine)
            if not len(live):
                continue
            first, last, gram, hashes, row, crowded = first[live], last[live], gram[live], hashes[live], row[live], hot[at[live]]
            single = np.where(crowded, last - first + 1, 1)  # crowded strings fall apart into windows
            window = A.spread(first, single)
            last, gram, hashes, row, crowded = (np.repeat(x, single) for x in (last, gram, hashes, row, crowded))
            first, last = window, np.where(crowded, window, last)
            begin, end = seen.begin(first), seen.end(last + k)
            if crowded.any():
                whole = A.span_hash(A.prefix(A.BYTE_VALUES[seen.text]), begin, end)
                hashes = np.where(crowded, whole, hashes)
            ids, tags = A.integers(rows.column("id")), A.integers(rows.column("tag"))
            out += K.pack(seen.text, begin, end, first, last + k - first, seen.begin(gram) - begin, hashes, row, ids, tags, seen.bounds, n_buckets, inside)
        return pa.Table.from_batches([B.batch(out, "bucket")])

    return pack


def _verdicts(verdict, names):
    def judge(table: pa.Table) -> pa.Table:
        data, fields, settled = K.unpack(table.column("blob"))
        ids, tags, s, e = (np.concatenate([x, y]) for x, y in zip(settled, verdict(data, fields), strict=True))
        rows = B.by_key(names[A.part_of(ids ^ tags, len(names))], lambda part: (ids[part], tags[part], s[part].astype(np.uint32), e[part].astype(np.uint32)))
        return pa.Table.from_batches([B.batch(rows, "part")])

    return judge


def chunks_with_spans(docs: pa.Table, spans: pa.Table) -> Iterator[tuple]:
    """A part's documents in chunks, as text_chunks has them, each with (row, s, e) of its spans."""
    ids, tags, s, e = B.loaded(spans.column("blob"), 4)
    name = A.mix(ids.astype(np.int64).view(np.uint64)) + tags.astype(np.int64).view(np.uint64)
    order = np.argsort(name, kind="stable")
    name, s, e = name[order], s[order].astype(np.int64), e[order].astype(np.int64)
    for rows, data, bounds in A.text_chunks(docs.to_batches()):
        mine = A.mix(A.integers(rows.column("id")).view(np.uint64)) + A.integers(rows.column("tag")).view(np.uint64)
        low, high = np.searchsorted(name, mine), np.searchsorted(name, mine, "right")
        pick = A.spread(low, high - low)
        yield rows, data, bounds, np.repeat(np.arange(len(mine)), high - low), s[pick], e[pick]
