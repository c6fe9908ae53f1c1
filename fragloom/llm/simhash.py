"""SimHash near-dedup with pivot distance tables.

Fingerprints: a bit is 1 if it is set in over half the XXH64 hashes of a text's 4-word shingles.
Documents with one fingerprint form a class; only classes are compared.

Which classes meet: if two fingerprints differ in at most ``far`` bits, then of ``far + 1``
segments of the 64 bits one is equal, and of ``far + 1`` segments of the other bits again one.
So each class goes to (far + 1)**2 blocks, named by two equal segments, and every pair within
reach meets in one.  A block of over ``TILE`` classes is dealt out as pairs of tiles.  In a block,
the pivot table holds each fingerprint's Hamming distances to ``PIVOTS`` reference fingerprints;
by the triangle inequality a pair whose greatest coordinate difference exceeds ``far`` cannot
link and is discarded, and survivors are verified bit by bit.  A block reports a spanning star
for each of its groups of linked classes, never all its links.

Edge cases: texts without words, null ones included, have fingerprint zero and are linked like
any other; fewer than four words are one shingle; repeated rows share a fingerprint; rows with a
null doc_id get the component of their fingerprint, null if it holds no other id; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fragloom.llm import arrays as A
from fragloom.llm import spans as S
from fragloom.operators.components import components
from fragloom.storage import materialise

SHINGLE, SEED, FAR = 4, 42, 4
PIVOTS, TILE, BUCKET_ROWS, SPREAD = 64, 2048, 1 << 18, 8


def fingerprints(data, bounds):
    """A fingerprint for each document, as unsigned integers."""
    data = A.LOWER[data]
    starts, ends, word_bounds = A.words(data, bounds)
    text, at = A.compact(data, starts, ends)
    stop = at + (ends - starts)
    raw = memoryview(text.tobytes())
    counts = np.diff(word_bounds)
    shingles = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    first = A.spread(word_bounds[:-1], shingles)
    final = np.minimum(first + SHINGLE, np.repeat(word_bounds[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(at[first].tolist(), stop[final].tolist(), strict=True)), np.uint64, len(first))
    edges = np.concatenate([[0], np.cumsum(shingles)])
    out = np.zeros(len(counts), np.uint64)
    for i in np.flatnonzero(shingles):
        mine = hashes[edges[i] : edges[i + 1]].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = sum(np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64) for part in np.array_split(mine, len(mine) // 65536 + 1))
        out[i] = np.packbits(2 * ones > len(mine)).view(">u8")[0]
    return out


def _print(batches):
    for rows, data, bounds in A.text_chunks(batches):
        prints = fingerprints(data, bounds).view(np.int64)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("tag"), pa.array(prints, pa.int64())], names=["doc_id", "tag", "print"])


def _segments(bits, parts):
    """The bits dealt into so many runs."""
    return [list(x) for x in np.array_split(np.array(bits), parts)]


def block_masks(far=FAR):
    """The bit masks that name blocks: a segment of all bits, and one of the others."""
    masks = []
    for one in _segments(range(64), far + 1):
        rest = [b for b in range(64) if b not in one]
        for two in _segments(rest, far + 1):
            mask = sum(1 << int(b) for b in [*one, *two])
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def reference_prints(n=PIVOTS):
    """Reference fingerprints: fixed pseudorandom bits."""
    return A.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def linked(prints, group, far=FAR):
    """(a, b): pairs of places in one group (equal neighbours in ``group``) whose fingerprints differ in at most far bits."""
    table = np.bitwise_count(prints[:, None] ^ reference_prints()).astype(np.int8)
    left, right = [], []
    step, live = 1, np.arange(len(prints))
    while True:
        live = live[live + step < len(prints)]
        live = live[group[live] == group[live + step]]
        if not len(live):
            break
        a = live
        for pivot in range(PIVOTS):
            a = a[np.abs(table[a, pivot] - table[a + step, pivot]) <= far]
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= far]
        left.append(a)
        right.append(a + step)
        step += 1
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))


def least_members(n, a, b):
    """For each of n places the least place that links (a, b) connect it with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _block(far):
    def stars(table: pa.Table) -> pa.Table:
        names, prints, ids = (A.integers(table.column(x).combine_chunks()) for x in ("block", "print", "id"))
        order = np.lexsort((prints, names))
        names, prints, ids = names[order], prints[order], ids[order]
        a, b = linked(prints.view(np.uint64), names, far)
        # The same class may stand in several of the bucket's blocks: join them up.  Classes are numbered by (id, print).
        by = np.lexsort((prints, ids))
        new = np.ones(len(by), bool)
        new[1:] = prints[by][1:] != prints[by][:-1]
        place = np.empty(len(by), np.int64)
        place[by] = np.cumsum(new) - 1
        first = by[new]
        root = least_members(len(first), place[a], place[b])
        moved = np.flatnonzero(root != np.arange(len(first)))
        u, v = first[moved], first[root[moved]]
        return pa.table({"u_id": ids[u], "u_print": prints[u], "v_id": ids[v], "v_print": prints[v]})

    return stars


def links(classes: DataFrame, far: int = FAR, tile: int = TILE) -> DataFrame:
    """u, v: links between classes, structs of (id, print), that connect just what all links within reach connect.  classes: print, each once, and id."""
    spark = classes.sparkSession
    masks = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(x).cast("bigint").alias("mask")) for i, x in enumerate(block_masks(far))))
    blocks = classes.select("print", "id", F.explode(masks).alias("m")).select("print", "id", F.xxhash64("m.i", F.col("print").bitwiseAND(F.col("m.mask"))).alias("block"))
    large = blocks.groupBy("block").count().where(F.col("count") > tile).select("block", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    dealt = blocks.join(large, "block", "left")
    whole = dealt.where("tiles is null").select("block", "print", "id")
    mine = F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    parts = dealt.where("tiles is not null").select("block", "print", "id", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    parts = parts.select(F.xxhash64("block", F.least("mine", "other"), F.greatest("mine", "other")).alias("block"), "print", "id")
    # Buckets by the number of classes, so that one holds about as many whatever the corpus.
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), classes.count() * len(block_masks(far)) // BUCKET_ROWS)
    every = whole.unionByName(parts).select("block", "print", "id", F.pmod(F.xxhash64("block"), F.lit(buckets)).alias("bucket"))
    found = every.groupBy("bucket").applyInArrow(_block(far), "u_id bigint, u_print bigint, v_id bigint, v_print bigint")
    return found.select(*(F.struct(F.col(f"{x}_id").alias("id"), F.col(f"{x}_print").alias("print")).alias(x) for x in "uv"))


def near_duplicates(docs: DataFrame, far: int = FAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tag, fingerprint (16 hex digits), component_id (the least doc_id that links reach) and group (the fingerprint of a class with that id, which names the component)."""
    rows = S.keyed(docs, id_col, text_col).select("doc_id", "tag", "text")
    printed = materialise(rows.mapInArrow(_print, "doc_id bigint, tag binary, print bigint"))
    classes = materialise(printed.groupBy("print").agg(F.min(F.coalesce("doc_id", F.lit(S.NULL_ID))).alias("id")))
    # A class is named by its least id and its print, so the least class of a component, its root, tells its least id:
    # nothing has to meet by root, which a great many classes may share.
    roots = components(links(classes, far)).select(F.col("node.print").alias("print"), "root")
    of = materialise(classes.join(roots, "print", "left").select("print", F.coalesce("root", F.struct("id", "print")).alias("root")))
    # A print that very many documents share is spread over SPREAD keys; both sides are written, so AQE may split it further.
    spread = of.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    joined = printed.withColumn("turn", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int")).join(spread, ["print", "turn"])
    hexed = lambda column: F.lower(F.lpad(F.hex(column), 16, "0"))
    component = F.when(F.col("root.id") != S.NULL_ID, F.col("root.id"))
    return joined.select("doc_id", "tag", hexed("print").alias("fingerprint"), component.alias("component_id"), hexed("root.print").alias("group"))


def query(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("tag", "group")
