"""Mixing sources to target weights.  DataFrame operations only.

Each source's documents are laid end to end, and their words packed into blocks of
``block_words``, or of a ``PARTS``th of a source that is smaller (the last may be shorter), so that whole
blocks come near its target.  A source's target says how many block slots it gets.
Slots are dealt to output shards at random, which draws each source's counts over the shards
from a multinomial distribution while its total stays exact.  Within a source, slot t stands for
the block that a pseudorandom permutation of the block indexes gives for t modulo the number of
blocks, with another permutation each time the blocks have been used up; so no block is used
n + 1 times before all are used n times.  Blocks are joined by source and index.

Targets: sources by code point, null last, weigh 1, 2, 3 and on; they share all words, and what a
source cannot take (``most`` times its words) is shared among the others by weight.

Sources are few: there is one row for each in the targets, which are ranked in one task.
Documents of one source are never gathered: their places come from sums over hashed chunks.

Edge cases: null and empty texts have size 0 and are never taken; sources without words have
target 0; repeated rows are documents of their own; no documents give no rows; other columns are
not read.  All is derived from hashes of ids and ``seed``: reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from fragloom.llm.spans import picked, tag_of
from fragloom.storage import materialise

BLOCK_WORDS, PARTS, SHARD_SLOTS, MOST, SEED = 128, 512, 8192, 3, 17
RUN = 4096  # slots that one row spells out


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, target.  sizes: source, size.

    A source's share of the words is level * weight, cut at its cap.  Ordered by cap / weight, the
    level is the greatest of (words - caps of those before) / (weights from there on).
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    ranked = per_source.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    ranked = ranked.withColumn("cap", (F.col("source_size") * most).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")
    onward = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("level", (F.sum("source_size").over(every) - before) / onward)
    return level.select("source", "source_size", F.least(F.col("cap"), F.max("level").over(every) * F.col("weight")).alias("target"))


def permuted(index: Column, n: Column, key: list[Column]) -> Column:
    """Where a pseudorandom permutation of 0 .. n - 1, chosen by key, sends index.

    A four-round Feistel network on a grid just larger than n; indexes that leave the range go
    through it again.  Fewer than sqrt(n) cells lie outside, so 32 turns are enough.
    """
    a = F.ceil(F.sqrt(n)).cast("bigint")
    b = F.ceil(n / a).cast("bigint")

    def half(turn: int, kept: Column, changed: Column, size: Column) -> Column:
        return F.pmod(changed + F.pmod(F.xxhash64(F.lit(turn), *key, kept), size), size)

    def network(x: Column) -> Column:
        low, high = x % a, F.floor(x / a).cast("bigint")
        one = half(1, high, low, a)
        two = half(2, one, high, b)
        three = half(3, two, one, a)
        return half(4, three, two, b) * a + three

    again = F.sequence(F.lit(0), F.lit(32))
    return F.aggregate(again, index.cast("bigint"), lambda x, turn: F.when((turn > 0) & (x < n), x).otherwise(network(x)))


@dataclass
class Mix:
    """documents: doc_id, tag, source, size, source_size, target, taken; slots: source, shard, slot, block; pieces: source, block, doc_id, tag, first, words."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def placed(sized: DataFrame, rows: int) -> DataFrame:
    """sized with ``place``: the words of its source that stand before a document's first."""
    chunks = max(1, int(rows**0.5))
    sized = sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(chunks)))
    sums = sized.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    bases = sums.withColumn("base", F.sum("words").over(before) - F.col("words")).withColumnsRenamed({"source": "s", "chunk": "c"}).drop("words")
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "tag", "size").rowsBetween(Window.unboundedPreceding, 0)
    within = sized.withColumn("within", F.sum("size").over(inside) - F.col("size"))
    joined = within.join(bases, within["source"].eqNullSafe(bases["s"]) & (within["chunk"] == bases["c"]))
    return joined.withColumn("place", (F.col("base") + F.col("within")).cast("bigint")).drop("s", "c", "base", "within", "chunk")


def slot_table(goals: DataFrame, seed: int, shard_slots: int) -> DataFrame:
    """source, shard, slot, block.  goals: source, blocks, slots."""
    spark = goals.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = F.greatest(F.lit(1), F.ceil(F.sum("slots").over(Window.partitionBy()) / shard_slots)).cast("bigint")
    few = goals.withColumn("shards", shards).where("slots > 0")
    runs = few.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / RUN))))
    runs = runs.repartition(parts, "source", "run")
    draws = runs.withColumn("draw", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("slots")) - 1)))
    shard = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "source", "draw"), F.col("shards"))
    counts = draws.groupBy("source", "blocks", shard.alias("shard")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("first", F.sum("n").over(before) - F.col("n")).repartition(parts, "source", "shard")
    slots = counts.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
    turn = F.floor(F.col("slot") / F.col("blocks"))
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), [F.lit(seed), F.col("source"), turn])
    return slots.select("source", "shard", "slot", block.alias("block"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, most: int = MOST, seed: int = SEED, shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    docs = picked(docs, doc_id=id_col, text=text_col, source=source_col)
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    tag = tag_of(text)
    sized = materialise(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), tag.alias("tag"), F.col("source").cast("string").alias("source"), size.alias("size")))
    unit = F.greatest(F.lit(1), F.least(F.lit(block_words), F.ceil(F.col("source_size") / PARTS))).cast("bigint")
    goals = materialise(targets(sized, most).withColumn("unit", unit))
    blocks = F.ceil(F.col("source_size") / F.col("unit")).cast("bigint")
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size"))).otherwise(0).cast("bigint")
    drawn = materialise(slot_table(goals.select("source", blocks.alias("blocks"), slots.alias("slots")), seed, shard_slots))
    whole = goals.withColumnRenamed("source", "s")
    laid = placed(sized, sized.count())
    laid = materialise(laid.join(whole, laid["source"].eqNullSafe(whole["s"])).drop("s"))
    span = F.sequence(F.floor(F.col("place") / F.col("unit")), F.floor((F.col("place") + F.col("size") - 1) / F.col("unit")))
    pieces = laid.where("size > 0").withColumn("block", F.explode(span))
    begin, end = F.greatest("place", F.col("block") * F.col("unit")), F.least(F.col("place") + F.col("size"), (F.col("block") + 1) * F.col("unit"))
    pieces = pieces.select("source", "block", "doc_id", "tag", "place", (begin - F.col("place")).alias("first"), (end - begin).alias("words"))
    times = drawn.groupBy(F.col("source").alias("s"), F.col("block").alias("b")).agg(F.count("*").alias("times"))
    used = pieces.join(times, pieces["source"].eqNullSafe(times["s"]) & (pieces["block"] == times["b"]))
    taken = used.groupBy(F.col("source").alias("s"), F.col("place").alias("p")).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    # A document with words is named by its source and place; one without takes nothing.
    named = laid.join(taken, laid["source"].eqNullSafe(taken["s"]) & (laid["place"] == taken["p"]) & (laid["size"] > 0), "left")
    documents = named.select("doc_id", "tag", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    return Mix(documents, drawn, pieces.drop("place"))


def query(spark, sf_dir):
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).documents.drop("tag", "source")
