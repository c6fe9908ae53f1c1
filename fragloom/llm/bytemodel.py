"""Byte n-gram perplexity: an interpolated modified Kneser-Ney model of each language, in sorted arrays dealt by hash.

A gram is ``ORDER`` bytes of one text, A-Z lower-cased and white space made one.  Its language and
middle bytes name its bucket, so a bucket holds all that the two longest orders need of its grams.  Texts fall into
two folds by their least hash of ``WIDE`` bytes: a text is counted in the model of its own fold and scored by that of the
other, so no text, nor a copy or most near copies, vouches for itself.

1. ``_packed``: texts are packed into groups of about ``GROUP_BYTES``, one compressed row each, dealt by name.
2. ``_grams``: a group sends its distinct grams, with their counts in texts that count, to (bucket, salt).
3. ``_summed``: counts are added up by (bucket, salt), so the tasks that see all groups see only sums.
4. ``_lower``, ``_language``: the buckets' counts of the third order, at most 256**3 a language, meet by language;
   each bucket gets back the probabilities of the third order that it asked for, and its discounts.
5. ``_model``, ``_answers``: each bucket's sorted grams with their log probabilities meet the groups' requests.
6. ``_scored``: a group gets the log probabilities of its grams back and adds them up by text.

What is gathered is what the groups' distinct grams take: it grows with the input.  Nothing is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fragloom.llm import arrays as A
from fragloom.llm import blobs as B

ORDER, BUCKETS, WIDE = 5, 256, 24
#: Larger groups send fewer grams twice; a group's texts and grams lie in one worker.
GROUP_BYTES, CHUNK_BYTES = 8 << 20, 2 << 20
SENT = "bucket int, salt int, name bigint, blob binary"
#: Log probabilities travel in steps of so much; what rounding adds to a text's mean is far less.
STEP = 1 / 512
#: Numbers of n-grams of a language, fold and order that occur once, twice, three and four times.
STATS, FOLDS = 4, (0, 1)

PLAIN = A.LOWER.copy()
PLAIN[A.WHITE] = 32
_LOW = [(1 << 8 * n) - 1 for n in range(ORDER + 1)]
_SHIFT = 8 * ORDER


def _sent(rows):
    """Rows (bucket, salt, name, blob) as an Arrow table."""
    types = (("bucket", pa.int32()), ("salt", pa.int32()), ("name", pa.int64()), ("blob", pa.binary()))
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(types)})


def _seed(lang):
    """What a language is known by."""
    return xxhash.xxh64_intdigest("null" if lang is None else f"={lang}") >> 1


def _small(x):
    return x.astype(np.uint16 if not len(x) or int(x.max()) < 1 << 16 else np.uint32)


def folds(data, bounds):
    """Each text's fold."""
    hashes, lengths = A.fixed_hash(A.prefix(A.BYTE_VALUES[data]), WIDE), np.diff(bounds)
    out = np.zeros(len(lengths), np.int64)
    filled = np.flatnonzero(lengths >= WIDE)
    if len(filled):
        inside = np.flatnonzero(np.arange(len(hashes)) + WIDE <= np.repeat(bounds[1:], lengths)[: len(hashes)])
        least = np.minimum.reduceat(hashes[inside], np.searchsorted(inside, bounds[filled]))
        out[filled] = (A.mix(least) & np.uint64(1)).astype(np.int64)
    return out


def _columns(counts):
    return [_small(np.ascontiguousarray(counts[:, f])) for f in FOLDS]


def _packed(described, partitions):
    turn = 0

    def group(held):
        table = pa.Table.from_batches(held).combine_chunks()
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table)
        blob = sink.getvalue().to_pybytes()
        return _sent([(0, 0, name(blob), blob)]).to_batches()[0]

    def name(blob):
        """The group's name: what its bytes hash to, and a little more, so that hash partitioning sends this task's groups to places of their own."""
        nonlocal turn
        task = TaskContext.get()
        place, turn = ((task.partitionId() if task else 0) + turn * (partitions // 2 + 1)) % partitions, turn + 1
        first = (xxhash.xxh64_intdigest(blob) >> 1) - (1 << 62)
        tried = first + np.arange(64 * partitions, dtype=np.int64)
        fits = np.flatnonzero(A.partition_of(tried, partitions) == place)
        return int(tried[fits[0]]) if len(fits) else first

    def pack(batches):
        nonlocal turn
        held, size, turn = [], 0, 0
        for rows, data, bounds in A.text_chunks(batches, limit=CHUNK_BYTES):
            low = PLAIN[data]
            plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(low)])
            held.append(pa.RecordBatch.from_pydict(described(rows, data, bounds) | {"plain": plain, "fold": pa.array(folds(low, bounds), pa.int64())}))
            size += len(data)
            if size >= GROUP_BYTES:
                yield group(held)
                held, size = [], 0
        if held:
            yield group(held)
        A.give_back()

    return pack


def _unpacked(blobs):
    """The tables of a group: one, but for groups alike in every byte."""
    return [pa.ipc.open_stream(x.as_py()).read_all() for x in blobs]


def codes(data, bounds):
    """(codes, text) of all grams inside texts."""
    n = len(data) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = np.zeros(n, np.int64)
    for k in range(ORDER):
        out <<= 8
        out |= data[k : n + k]
    lengths = np.diff(bounds)
    inside = np.flatnonzero(np.arange(n) + ORDER <= np.repeat(bounds[1:], lengths)[:n])
    return out[inside], A.owners(bounds)[inside]


def _keys(tables):
    """(table, first text, keys, text) piece by piece; a key is a gram's language, by its place among the group's seeds, and code."""
    seeds = np.unique([_seed(x) for t in tables for x in t.column("lang").unique().to_pylist()]).astype(np.int64)
    for number, t in enumerate(tables):
        langs = t.column("lang").combine_chunks().dictionary_encode()
        named = np.append([_seed(x) for x in langs.dictionary.to_pylist()], _seed(None)).astype(np.int64)
        place = np.searchsorted(seeds, named)[langs.indices.fill_null(len(named) - 1).to_numpy(zero_copy_only=False)]
        first = 0
        for _, data, bounds in A.text_chunks(t.select(["plain"]).to_batches(), "plain", CHUNK_BYTES, pa.large_binary()):
            code, text = codes(data, bounds)
            yield number, first, (place[first + text] << _SHIFT) | code, text
            first += len(bounds) - 1


def _merged(keys, counts):
    """Distinct keys, sorted, and the sums of their counts, a column for each fold."""
    names, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate(counts)
    return names, np.stack([np.bincount(place, counts[:, f], len(names)).astype(np.int64) for f in FOLDS], 1)


def _asked(tables, counted=True):
    """(seeds, keys, counts, order, edges): a group's distinct grams, and how they are dealt to buckets; counts: in texts that count."""
    seeds = np.unique([_seed(x) for t in tables for x in t.column("lang").unique().to_pylist()]).astype(np.int64)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
    # 0 and 1 are the folds of texts that count, 2 that of others.
    marks = [np.where(t.column("counted").to_numpy(), t.column("fold").to_numpy(), 2) for t in tables]
    for number, first, key, text in _keys(tables):
        mark = marks[number][first + text] if counted else None
        for f in (*FOLDS, 2) if counted else (2,):
            some, often = np.unique(key[mark == f] if counted else key, return_counts=True)
            keys.append(some)
            counts.append(np.stack([often * (f == g) for g in FOLDS], 1))
    keys, counts = _merged(keys, counts)
    middle = (keys >> 8) & _LOW[ORDER - 2]
    bucket = (A.mix(seeds[keys >> _SHIFT].view(np.uint64) ^ A.mix(middle.view(np.uint64))) % np.uint64(BUCKETS)).astype(np.int64) if len(keys) else keys
    order = np.argsort(bucket, kind="stable")
    return seeds, keys, counts, order, np.searchsorted(bucket[order], np.arange(BUCKETS + 1))


def _grams(salts):
    def send(table: pa.Table) -> pa.Table:
        name, out = table.column("name")[0].as_py(), []
        seeds, keys, counts, order, edges = _asked(_unpacked(table.column("blob")))
        for bucket in np.flatnonzero(np.diff(edges)):
            mine = order[edges[bucket] : edges[bucket + 1]]
            out.append((int(bucket), name % salts, name, B.dump(seeds, np.diff(keys[mine], prepend=0), *_columns(counts[mine]))))
        A.give_back()
        return _sent(out)

    return send


def _loaded(blobs):
    """(seeds, keys, counts) of many blobs, summed."""
    parts = [B.load(x.as_py()) for x in blobs]
    seeds = np.unique(np.concatenate([x[0] for x in parts]))
    keys = [np.cumsum(x[1]) for x in parts]
    keys = [np.searchsorted(seeds, x[0])[k >> _SHIFT] << _SHIFT | k & _LOW[ORDER] for x, k in zip(parts, keys, strict=True)]
    return seeds, *_merged(keys, [np.stack(x[2:4], 1) for x in parts])


def _summed(table: pa.Table) -> pa.Table:
    seeds, keys, counts = _loaded(table.column("blob"))
    return _sent([(table.column("bucket")[0].as_py(), 0, 0, B.dump(seeds, np.diff(keys, prepend=0), *_columns(counts)))])


def _below(keys, counts, n):
    """The grams of one order less, n bytes long, that keys end in, how many of the counted keys end in each, by fold, and where each key's is."""
    names, place = np.unique((keys >> _SHIFT << _SHIFT) | keys & _LOW[n], return_inverse=True)
    return names, np.stack([np.bincount(place, counts[:, f] > 0, len(names)).astype(np.int64) for f in FOLDS], 1), place


def _stats(counts):
    """STATS numbers for each fold."""
    return np.array([[np.count_nonzero(counts[:, f] == k) for k in range(1, STATS + 1)] for f in FOLDS], np.int64)


def _lower(table: pa.Table) -> pa.Table:
    """To each language: the bucket's grams of the third order from the end, their counts, and counts of counts of the orders above."""
    bucket, out = table.column("bucket")[0].as_py(), []
    seeds, keys, counts = _loaded(table.column("blob"))
    four, n4, _ = _below(keys, counts, ORDER - 1)
    three, n3, _ = _below(four, n4, ORDER - 2)
    for i, seed in enumerate(seeds):
        mine = three >> _SHIFT == i
        told = np.stack([_stats(counts[keys >> _SHIFT == i]), _stats(n4[four >> _SHIFT == i])])
        out.append((bucket, 0, int(seed), B.dump(np.diff(three[mine] & _LOW[ORDER], prepend=0), *_columns(n3[mine]), told.ravel())))
    return _sent(out)


def discounts(stats):
    """D for counts of 0, 1, 2 and 3 or more, from the numbers of n-grams that occur once to four times."""
    n1, n2, n3, n4 = (float(x) for x in stats)
    if not (n1 and n2):
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.clip(d, [0, 0.1, 0.1, 0.1], [0, 0.95, 1.9, 2.9])


def _level(keys, counts, d, below):
    """Discounted shares of counts in their contexts, what is left of each context given to ``below``; d: of each key.  A context that was never counted leaves all."""
    _, context = np.unique(keys >> 8, return_inverse=True)
    n = int(context.max(initial=-1)) + 1
    cut = d[np.arange(len(counts)), np.minimum(counts, 3)]
    total, mass = np.bincount(context, counts, n)[context], np.bincount(context, cut, n)[context]
    seen = np.maximum(total, 1)
    return np.where(total > 0, (counts - cut + mass * below) / seen, below)


def _each(d, n):
    return np.broadcast_to(d, (n, 4))


def _language(table: pa.Table) -> pa.Table:
    """The third order's probabilities for each bucket of one language."""
    seed, buckets = table.column("name")[0].as_py(), table.column("bucket").to_pylist()
    parts = [B.load(x.as_py()) for x in table.column("blob")]
    asked = [np.cumsum(x[0]) for x in parts]
    keys, counts = _merged(asked, [np.stack(x[1:3], 1) for x in parts])
    told = np.sum([x[3] for x in parts], axis=0).reshape(2, 2, STATS)
    levels = [(keys, counts, None)]
    for n in range(ORDER - 3, 0, -1):
        levels.append(_below(*levels[-1][:2], n))
    found = []
    for f in FOLDS:
        p = np.full(len(levels[-1][0]), 1 / 256)
        for names, often, place in reversed(levels):
            p = _level(names, often[:, f], _each(discounts(_stats(often)[f]), len(names)), p)
            p = p if place is None else p[place]
        found.append((p, np.concatenate([discounts(told[0, f]), discounts(told[1, f])])))
    at = [np.searchsorted(keys, x) for x in asked]
    return _sent([(b, 0, seed, B.dump(*(y.view(np.int64) for p, given in found for y in (p[x], given)))) for b, x in zip(buckets, at, strict=True)])


def _model(salts):
    """A bucket's grams and their log probabilities in both folds, for each salt."""

    def model(sums: pa.Table, lower: pa.Table) -> pa.Table:
        bucket = sums.column("bucket")[0].as_py()
        seeds, keys, counts = _loaded(sums.column("blob"))
        four, n4, to_four = _below(keys, counts, ORDER - 1)
        three, _, to_three = _below(four, n4, ORDER - 2)
        told = [(np.searchsorted(seeds, s), [x.view(np.float64) for x in B.load(b.as_py())]) for s, b in zip(lower.column("name").to_pylist(), lower.column("blob"), strict=True)]
        logs = []
        for f in FOLDS:
            p3, d4, d5 = np.zeros(len(three)), np.zeros((len(four), 4)), np.zeros((len(keys), 4))
            for i, given in told:
                p3[three >> _SHIFT == i] = given[2 * f]
                d5[keys >> _SHIFT == i], d4[four >> _SHIFT == i] = given[2 * f + 1][:4], given[2 * f + 1][4:]
            p = _level(four, n4[:, f], d4, p3[to_three])
            p = _level(keys, counts[:, f], d5, p[to_four])
            logs.append(np.minimum(np.round(-np.log(np.maximum(p, 1e-50)) / STEP), 65535).astype(np.uint16))
        blob = B.dump(seeds, np.diff(keys, prepend=0), *logs)
        return _sent([(bucket, salt, 0, blob) for salt in range(salts)])

    return model


def _answers(asked: pa.Table, model: pa.Table) -> pa.Table:
    out = []
    if asked.num_rows:
        bucket = asked.column("bucket")[0].as_py()
        seeds, keys, *logs = B.load(model.column("blob")[0].as_py())
        keys = np.cumsum(keys)
        for name, blob in zip(asked.column("name").to_pylist(), asked.column("blob"), strict=True):
            own, mine, *_ = B.load(blob.as_py())
            mine = np.cumsum(mine)
            at = np.searchsorted(keys, (np.searchsorted(seeds, own)[mine >> _SHIFT] << _SHIFT) | mine & _LOW[ORDER])
            out.append((bucket, 0, name, B.dump(*(x[at] for x in logs))))
    return _sent(out)


def _scored(names):
    def score(packed: pa.Table, answers: pa.Table) -> pa.Table:
        tables = _unpacked(packed.column("blob"))
        _, keys, _, order, edges = _asked(tables, counted=False)
        logs = np.zeros((2, len(keys)))
        # Groups alike in every byte ask and are answered once each, alike.
        for bucket, blob in zip(answers.column("bucket").to_pylist(), answers.column("blob"), strict=True):
            logs[:, order[edges[bucket] : edges[bucket + 1]]] = np.stack(B.load(blob.as_py())) * STEP
        sums = [np.zeros(t.num_rows) for t in tables]
        count = [np.zeros(t.num_rows, np.int64) for t in tables]
        other = [1 - t.column("fold").to_numpy() for t in tables]
        for number, first, key, text in _keys(tables):
            n = int(text.max(initial=-1)) + 1
            sums[number][first : first + n] += np.bincount(text, logs[other[number][first + text], np.searchsorted(keys, key)], n)
            count[number][first : first + n] += np.bincount(text, minlength=n)
        A.give_back()
        return pa.concat_tables([t.append_column("surprise", pa.array(s, pa.float64(), mask=c == 0)).select(names) for t, s, c in zip(tables, sums, count, strict=True)])

    return score


def scored(rows: DataFrame, described, schema: str) -> DataFrame:
    """The columns of schema for each row: what described(rows, bytes, bounds) says of a chunk, and ``surprise``, the sum of -log p over a text's grams, null if it has none.

    described must tell ``lang`` and ``counted``, whether the model counts a text's grams; rows: text and what described reads.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = -(-partitions // 16)
    packed = rows.mapInArrow(_packed(described, partitions), SENT)
    asked = packed.groupBy("name").applyInArrow(_grams(salts), SENT)
    sums = asked.groupBy("bucket", "salt").applyInArrow(_summed, SENT)
    lower = sums.groupBy("bucket").applyInArrow(_lower, SENT).groupBy("name").applyInArrow(_language, SENT)
    model = sums.groupBy("bucket").cogroup(lower.groupBy("bucket")).applyInArrow(_model(salts), SENT)
    answers = asked.groupBy("bucket", "salt").cogroup(model.groupBy("bucket", "salt")).applyInArrow(_answers, SENT)
    return packed.groupBy("name").cogroup(answers.groupBy("name")).applyInArrow(_scored([x.split()[0] for x in schema.split(", ")]), schema)
