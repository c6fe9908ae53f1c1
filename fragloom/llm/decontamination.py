"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are all windows of ``k`` consecutive words of the benchmark items; an item with
fewer words is one pattern.  Patterns of one length share a matcher.  Its shift table, indexed
by the hash of a block of two words, says how far a search position may jump because no
pattern holds that block further left; where the shift is zero, the block's bucket of patterns
is looked up by the window's hash, and the bytes are compared directly.  All documents of a
chunk are searched at once: each segment of ``SEGMENT`` words has its own search position and
every round advances all positions that are still short of their segment's end.

The benchmark is the stated query set: it is read in passes of about ``PASS_BYTES``, so what is
sent to executors is bounded however large the benchmark is; with one pass, the usual case,
nothing is shuffled.

Edge cases: null and empty texts have no words and no hits; items without words match nothing;
a null item_id is written as an empty string; items that share an item_id count once; repeated
document rows come back once each; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fragloom.llm import arrays as A
from fragloom.llm import spans as S
from fragloom.llm.superkmer import runs

PASS_BYTES = 16 << 20
SEGMENT = 256
BLOCK = 2

#: Bytes that part words, once A-Z are lower-cased: all ASCII but digits and letters.
PARTS = np.ones(256, bool)
PARTS[0x30:0x3A] = PARTS[0x61:0x7B] = PARTS[0x80:] = False


def tokenised(data, bounds):
    """(bytes, begins, ends, word_bounds, hashes) of the lower-cased words, each followed by a space."""
    data = A.LOWER[data]
    starts, ends, word_bounds = A.words(data, bounds, PARTS)
    text, at = A.compact(data, starts, ends)
    stop = at + (ends - starts)
    return text, at, stop, word_bounds, A.span_hash(A.prefix(A.BYTE_VALUES[text]), at, stop)


class Matcher:
    """Patterns of one length in words: shift table, suffix buckets and the patterns' bytes."""

    def __init__(self, length, windows, hashes, text, at, stop):
        """windows: the first word of each distinct pattern among ``hashes``."""
        self.length, self.block = length, min(BLOCK, length)
        sums = A.prefix(hashes)
        blocks = A.fixed_hash(sums, self.block)
        size = 1 << max(12, int(16 * len(windows) * length).bit_length())
        self.mask = np.uint64(min(size, 1 << 24) - 1)
        self.shift = np.full(int(self.mask) + 1, length - self.block + 1, np.int16)
        for place in range(length - self.block + 1):  # blocks further right allow smaller shifts
            np.minimum.at(self.shift, blocks[windows + place] & self.mask, length - self.block - place)
        suffix = blocks[windows + length - self.block]
        whole = A.span_hash(sums, windows, windows + length)
        self.suffixes = np.unique(suffix)
        key = self._key(np.searchsorted(self.suffixes, suffix), whole)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        begin, lengths = at[windows], stop[windows + length - 1] - at[windows]
        self.text = text[A.spread(begin, lengths)]
        self.begin = np.cumsum(lengths) - lengths
        self.bytes = lengths

    def _key(self, bucket, whole):
        return (bucket.astype(np.uint64) << np.uint64(40)) | (whole >> np.uint64(24))

    def find(self, text, at, stop, bounds, hashes):
        """(pattern, first word) of all occurrences inside documents."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        counts = np.diff(bounds) - self.length + 1
        filled = np.flatnonzero(counts > 0)
        if not len(filled):
            return none
        sums = A.prefix(hashes)
        blocks = A.fixed_hash(sums, self.block)
        pieces = -(-counts[filled] // SEGMENT)
        number = A.spread(np.zeros(len(pieces), np.int64), pieces)
        document = np.repeat(filled, pieces)
        place = bounds[document] + number * SEGMENT  # a window's first word
        limit = np.minimum(place + SEGMENT, bounds[document] + counts[document])
        found = []
        while len(place):
            ahead = self.shift[blocks[place + self.length - self.block] & self.mask]
            found.append(place[ahead == 0])
            place = place + np.maximum(ahead, 1)
            live = place < limit
            place, limit = place[live], limit[live]
        place = np.concatenate(found)
        suffix = blocks[place + self.length - self.block]
        bucket = np.searchsorted(self.suffixes, suffix)
        hit = self.suffixes[np.minimum(bucket, len(self.suffixes) - 1)] == suffix
        place, bucket = place[hit], bucket[hit]
        if not len(place):
            return none
        key = self._key(bucket, A.span_hash(sums, place, place + self.length))
        low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right")
        place = np.repeat(place, high - low)
        pattern = self.order[A.spread(low, high - low)]
        equal = stop[place + self.length - 1] - at[place] == self.bytes[pattern]
        place, pattern = place[equal], pattern[equal]
        both = A.big_words(np.concatenate([text, self.text]))
        equal = A.same_bytes(both, at[place], len(text) + self.begin[pattern], self.bytes[pattern])
        return pattern[equal], place[equal]


def _numbered(windows, length, hashes, text, at, stop):
    """For each window (its first word) a number, the same for equal ones."""
    whole = A.span_hash(A.prefix(hashes), windows, windows + length)
    begin = at[windows]
    size = stop[windows + length - 1] - begin
    order = np.argsort(whole, kind="stable")
    a, b = order[:-1], order[1:]
    like = np.flatnonzero(whole[a] == whole[b])
    equal = size[a[like]] == size[b[like]]
    equal[equal] = A.same_bytes(A.big_words(text), begin[a[like[equal]]], begin[b[like[equal]]], size[a[like[equal]]])
    if not equal.all():  # two windows with one hash
        number: dict[bytes, int] = {}
        return np.array([number.setdefault(text[x : x + n].tobytes(), len(number)) for x, n in zip(begin, size, strict=True)])
    new = np.ones(len(order), bool)
    new[like + 1] = False
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def build(items, k):
    """[(matcher, pattern, item)]: for each pattern length its matcher and which patterns belong to which item; items: (name, text) pairs."""
    names = [name for name, _ in items]
    raw = [(text or "").encode() for _, text in items]
    data = np.frombuffer(b"".join(raw), np.uint8)
    text, at, stop, bounds, hashes = tokenised(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
    counts = np.diff(bounds)
    out = []
    for length in sorted(set(np.minimum(counts, k).tolist()) - {0}):
        mine = np.flatnonzero(counts >= k if length == k else counts == length)
        windows = A.spread(bounds[mine], counts[mine] - length + 1)
        owner = np.repeat(mine, counts[mine] - length + 1)
        pattern = _numbered(windows, length, hashes, text, at, stop)
        first = windows[np.unique(pattern, return_index=True)[1]]
        pairs = np.unique(np.stack([pattern, owner]), axis=1)
        out.append((Matcher(length, first, hashes, text, at, stop), pairs[0], pairs[1]))
    return names, out


def _found(matchers, text, at, stop, word_bounds, hashes):
    """(place, length, item) of all occurrences; the words as of tokenised()."""
    place, length, item = [], [], []
    for matcher, pattern, owner in matchers:
        which, where = matcher.find(text, at, stop, word_bounds, hashes)
        low, high = np.searchsorted(pattern, which), np.searchsorted(pattern, which, "right")
        item.append(owner[A.spread(low, high - low)])
        place.append(np.repeat(where, high - low))
        length.append(np.full(len(place[-1]), matcher.length))
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (place, length, item))


def _clean(model, column):
    """Batches without the rows whose text holds a pattern."""

    def clean(batches):
        _, matchers = S.received(model)
        for rows, data, bounds in A.text_chunks(batches, column):
            words = tokenised(data, bounds)
            place, _, _ = _found(matchers, *words)
            hit = np.zeros(rows.num_rows, bool)
            hit[np.searchsorted(words[3], place, "right") - 1] = True
            yield rows.filter(pa.array(~hit))

    return clean


def _search(model):
    """Batches of (doc_id, text) to hit spans and item names."""

    def search(batches):
        names, matchers = S.received(model)
        for rows, data, bounds in A.text_chunks(batches):
            text, at, stop, word_bounds, hashes = tokenised(data, bounds)
            place, length, item = _found(matchers, text, at, stop, word_bounds, hashes)
            document = np.searchsorted(word_bounds, place, "right") - 1
            gone = A.covered(int(word_bounds[-1]), place, place + length)
            edge = np.flatnonzero(np.diff(word_bounds))
            owner, s, e = runs(gone, word_bounds[edge])
            owner = edge[owner]
            pairs = np.unique(np.stack([document, item]), axis=1)
            cuts = lambda owners: pa.array(np.searchsorted(owners, np.arange(rows.num_rows + 1)), pa.int32())
            spans = pa.ListArray.from_arrays(cuts(owner), pa.StructArray.from_arrays([pa.array(s, pa.int64()), pa.array(e + 1, pa.int64())], names=["s", "e"]))
            items = pa.ListArray.from_arrays(cuts(pairs[0]), pa.array([names[i] for i in pairs[1]], pa.string()))
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), "id": rows.column("id"), "tag": rows.column("tag"), "n_words": pa.array(np.diff(word_bounds), pa.int64()), "spans": spans, "items": items})

    return search


FOUND = "doc_id bigint, id bigint, tag binary, n_words bigint, spans array<struct<s:bigint,e:bigint>>, items array<string>"


def _digest(batches):
    for batch in batches:
        spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        hits, sha, number = [], [], []
        for s, i in zip(spans, items, strict=True):
            end = total = 0
            for x in sorted((x["s"], x["e"]) for x in s):
                total += max(0, x[1] - max(end, x[0]))
                end = max(end, x[1])
            i = sorted(set(i))
            hits.append(total)
            number.append(len(i))
            sha.append(hashlib.sha256(",".join(i).encode()).hexdigest())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "id": batch.column("id"), "tag": batch.column("tag"), "n_words": batch.column("n_words"), "n_hit": pa.array(hits, pa.int64()), "n_items": pa.array(number, pa.int64()), "items_sha256": pa.array(sha, pa.string()), "contaminated": pa.array([x > 0 for x in hits], pa.bool_()), "spans": batch.column("spans"), "items": batch.column("items")})


def _models(benchmark: DataFrame, k: int, pass_bytes: int) -> list:
    """What to search for, in passes."""
    items = S.picked(benchmark, item_id="item_id", text="text").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("string").alias("text")).distinct()  # repeats would all fall into one pass
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-int(size) // pass_bytes))
    parts = [items if passes == 1 else items.where(F.pmod(F.xxhash64("name", "text"), F.lit(passes)) == i) for i in range(passes)]
    return [S.sent(benchmark.sparkSession, build([tuple(x) for x in part.collect()], k)) for part in parts]


def clean_documents(docs: DataFrame, benchmark: DataFrame, k: int = 10, pass_bytes: int = PASS_BYTES, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text holds no word of a benchmark window.  Rows are judged where they lie: nothing is shuffled, in any number of passes."""
    S.bound_batches(docs.sparkSession)
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    for model in _models(benchmark, k, pass_bytes):
        rows = rows.mapInArrow(_clean(model, f"c{docs.columns.index(text_col)}"), rows.schema)
    return rows.toDF(*docs.columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 10, pass_bytes: int = PASS_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, id, tag, n_words, n_hit, n_items, items_sha256, contaminated, spans (hit words) and items (names) for each document."""
    rows = S.keyed(docs, id_col, text_col)
    found = [rows.mapInArrow(_search(model), FOUND) for model in _models(benchmark, k, pass_bytes)]
    passes = len(found)
    if passes > 1:
        every = found[0]
        for x in found[1:]:
            every = every.unionByName(x)
        every = every.groupBy("doc_id", "id", "tag", "n_words").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"), F.count("*").alias("n"))
        copies = F.expr(f"explode(sequence(1, cast(n div {passes} as int)))")
        found = [every.withColumn("copy", copies).select("doc_id", "id", "tag", "n_words", "spans", "items")]
    schema = "doc_id bigint, id bigint, tag binary, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans array<struct<s:bigint,e:bigint>>, items array<string>"
    return found[0].mapInArrow(_digest, schema)


def query(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "benchmark"))
    return decontaminate(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: For each document the windows of every length that items have, joined with the items' windows on the words themselves.
SQL = r"""
with item as (
  select coalesce(cast(item_id as varchar), '') as name, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
pattern as (
  select distinct name, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
  from (select name, w, unnest(range(1, greatest(2, len(w) - 10 + 2))) as i from item where len(w) > 0)),
doc as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
place as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, (select distinct n from pattern))),
hit as (select r, name, p.n, i from place join pattern p on place.n = p.n and place.win = p.win),
words as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from hit) group by r),
names as (select r, count(*) as n_items, sha256(string_agg(name, ',' order by name)) as items_sha256 from (select distinct r, name from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (r) left join names using (r)
"""
