"""Fragments to persons: alias resolution, buffering with a sliding lifetime, folding.

What a keyed buffer with expiry does message by message is expressed over whole partitions:
an alias lookup is the last registration of the name before the row, and still alive; a buffer's
life ends at a gap of at least its lifetime; and a buffer fires at every ``least`` fragments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fragloom.operators.fragments import person_fields
from fragloom.operators.schema import FIELDS
from fragloom.storage import materialise

#: A buffer's life in seconds, the fragments that make a person, and how many lives an alias has.
LIFETIME_S, LEAST_FRAGMENTS, ALIAS_LIVES = 300, 2, 3


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / 1_000_000


def with_buffer_key(fragments: DataFrame, lifetime: float = LIFETIME_S) -> DataFrame:
    """fragments (seq, ts, fragment_type, name, match_key) with buffer_key: the passport key that the name was last registered for, if still alive.

    Rows without a name are kept out of the lookup: they would all meet in one partition.
    """
    fragments = materialise(fragments)  # both branches below read it
    own = F.col("match_key").startswith("name:")
    registers = (F.col("fragment_type") == "personal") & F.col("match_key").startswith("passport:") & (F.col("name") != "")
    prepared = fragments.withColumns({"_alias": F.when(own, F.expr("substring(match_key, 6)")).when(registers, F.col("name")), "_key": F.when(registers, F.col("match_key"))})
    before = Window.partitionBy("_alias").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("_key").isNotNull(), F.struct("_key", "ts")), ignorenulls=True).over(before)
    named = prepared.where("_alias is not null").withColumn("_last", last)
    alive = own & F.col("_last").isNotNull() & (_seconds(F.col("ts")) - _seconds(F.col("_last.ts")) < ALIAS_LIVES * lifetime)
    named = named.withColumn("buffer_key", F.when(alive, F.col("_last._key")).otherwise(F.col("match_key"))).drop("_last")
    rest = prepared.where("_alias is null").withColumn("buffer_key", F.col("match_key"))
    return named.unionByName(rest).drop("_alias", "_key")


def with_chunk(fragments: DataFrame, lifetime: float = LIFETIME_S, least: int = LEAST_FRAGMENTS) -> DataFrame:
    """fragments with life and chunk: which life of the buffer a fragment falls into, and which firing; fired: whether that firing happens."""
    of_key = Window.partitionBy("buffer_key").orderBy("seq")
    gap = F.coalesce(_seconds(F.col("ts")) - _seconds(F.lag("ts").over(of_key)) >= lifetime, F.lit(False))
    lives = fragments.withColumn("_gap", gap.cast("int")).withColumn("life", F.sum("_gap").over(of_key.rowsBetween(Window.unboundedPreceding, 0)))
    of_life = Window.partitionBy("buffer_key", "life")
    chunks = lives.withColumn("chunk", F.floor((F.row_number().over(of_life.orderBy("seq")) - 1) / least))
    whole = F.count("*").over(Window.partitionBy("buffer_key", "life", "chunk")) == least
    return chunks.withColumn("fired", whole).drop("_gap")


def first_value(field: str, order: str) -> Column:
    """An aggregate: the field's first value that is not blank."""
    value = F.col(field)
    return F.min_by(F.when(value.cast("string") != "", value), F.when(value.cast("string") != "", F.col(order)))


def fold(chunked: DataFrame) -> DataFrame:
    """A person for each firing: the first value of each field wins; its match key is its first fragment's own, not the buffer's.

    Adds first_seq and seq (of the last fragment, which fired), updated_at (its time) and fragments, as (type, payload).
    """
    fired = chunked.where("fired")
    parts = fired.select("buffer_key", "life", "chunk", "seq", "ts", "match_key", "fragment_type", F.to_json("message").alias("payload"), *(c.alias(f"f_{f}") for f, c in zip(FIELDS, person_fields(F.col("fragment_type"), F.col("message"), F.col("name")), strict=True)))
    values = [first_value(f"f_{f}", "seq").alias(f) for f in FIELDS]
    log = F.transform(F.array_sort(F.collect_list(F.struct("seq", "fragment_type", "payload"))), lambda x: F.struct(x["fragment_type"].alias("fragment_type"), x["payload"].alias("payload")))
    grouped = parts.groupBy("buffer_key", "life", "chunk").agg(F.min_by("match_key", "seq").alias("match_key"), F.min("seq").alias("first_seq"), F.max("seq").alias("seq"), F.max("ts").alias("updated_at"), *values, log.alias("fragments"))
    return grouped.drop("life", "chunk")


def link(fragments: DataFrame, lifetime: float = LIFETIME_S, least: int = LEAST_FRAGMENTS) -> DataFrame:
    """Usable fragments to persons, one for each firing."""
    return fold(with_chunk(with_buffer_key(fragments, lifetime), lifetime, least))


def filled_fields(fields: list[str] = FIELDS) -> Column:
    """How many of a person's data fields are not blank."""
    return sum((F.coalesce(F.col(f).cast("string"), F.lit("")) != "").cast("int") for f in fields)
