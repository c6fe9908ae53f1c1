"""Gap-filling upserts over snapshots, ids, and the fragment log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fragloom.functions.text import norm_name
from fragloom.operators.linking import first_value
from fragloom.operators.schema import FIELDS, field_type
from fragloom.storage import materialise

COLUMNS = ["id", "match_key", *FIELDS, "norm_name", "created_at", "updated_at"]


def require_keys(persons: DataFrame) -> DataFrame:
    """persons; running it fails on an empty match key."""
    bad = F.coalesce(F.col("match_key"), F.lit("")) == ""
    return persons.withColumn("match_key", F.when(bad, F.raise_error(F.lit("a person needs a match key")).cast("string")).otherwise(F.col("match_key")))


def rows_sent(persons: DataFrame) -> int:
    """How many rows an upsert of persons touches: one for each match key."""
    return require_keys(persons).select("match_key").distinct().count()


def _kept(field: str, nulls_only: bool) -> Column:
    """An aggregate: the first value that is not blank, a stored one first; with nulls_only a stored blank stands, too."""
    if not nulls_only:
        return first_value(field, "place")
    value = F.col(field)
    held = F.when(F.col("place.turn") == 0, value.isNotNull()).otherwise(value.cast("string") != "")
    return F.min_by(F.when(held, value), F.when(held, F.col("place")))


def upsert(persons: DataFrame, existing: DataFrame | None = None, nulls_only: bool = False) -> DataFrame:
    """The table after persons (match_key, fields, seq, updated_at) came in order of seq: rows keep what they have, and blanks are filled.

    With nulls_only, as a batch sent in one statement does it, only stored nulls are filled and stored empty strings stay.

    New rows get the next ids, in order of their first person.  norm_name follows the full name that a
    row ends up with.  Bringing the same persons again changes no value.
    """
    new = require_keys(persons).select(F.lit(1).alias("turn"), "seq", F.lit(None).cast("bigint").alias("id"), "match_key", *FIELDS, F.col("updated_at").alias("created_at"), "updated_at")
    rows = new
    if existing is not None:
        rows = existing.select(F.lit(0).alias("turn"), F.lit(0).cast("bigint").alias("seq"), "id", "match_key", *FIELDS, "created_at", "updated_at").unionByName(new)
    ordered = rows.withColumn("place", F.struct("turn", "seq"))
    merged = ordered.groupBy("match_key").agg(F.max("id").alias("id"), F.min("place").alias("place"), *(_kept(f, nulls_only).cast(field_type(f)).alias(f) for f in FIELDS), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    return with_ids(materialise(merged)).withColumn("norm_name", norm_name(F.col("full_name"))).select(*COLUMNS)


def with_ids(rows: DataFrame, chunk: int = 100_000) -> DataFrame:
    """rows whose id is null get the next ids after the greatest, in order of place.

    Rows are counted in ranges of seq first, so no task orders more than a range of them.  rows is read four times: write it first.
    """
    known = rows.where("id is not null")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    new = rows.where("id is null").withColumn("range", F.floor(F.col("place.seq") / chunk))
    counts = new.groupBy("range").count()
    base = counts.select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("base"))
    ranked = new.join(base, "range").withColumn("id", F.col("base") + F.row_number().over(Window.partitionBy("range").orderBy("place", "match_key")))
    return known.unionByName(ranked.withColumn("id", F.col("id") + top).select(*known.columns))


def backfill_names(persons: DataFrame) -> DataFrame:
    """persons with the canonical name worked out where there is a full name but no canonical one yet."""
    missing = F.col("full_name").isNotNull() & (F.coalesce("norm_name", F.lit("")) == "")
    return persons.withColumn("norm_name", F.when(missing, norm_name(F.col("full_name"))).otherwise(F.col("norm_name")))


def upsert_reviews(decisions: DataFrame, existing: DataFrame) -> DataFrame:
    """Review decisions by match_key, the last one replacing those before: (match_key, status, survivor_match_key, note, seq)."""
    both = existing.select(F.lit(-1).cast("bigint").alias("seq"), "match_key", "status", "survivor_match_key", "note").unionByName(decisions.select("seq", "match_key", "status", "survivor_match_key", "note"))
    last = both.groupBy("match_key").agg(F.max_by(F.struct("status", "survivor_match_key", "note"), "seq").alias("d"))
    return last.select("match_key", "d.status", "d.survivor_match_key", "d.note")


def fragment_log(folded: DataFrame, persons: DataFrame) -> DataFrame:
    """person_id, match_key (of the buffer), n, fragment_type, payload: the fragments of each person's last firing."""
    last = folded.groupBy("match_key").agg(F.max_by(F.struct("buffer_key", "fragments"), "seq").alias("x"))
    rows = last.join(persons.select("match_key", "id"), "match_key")
    return rows.select(F.col("id").alias("person_id"), F.col("x.buffer_key").alias("match_key"), F.posexplode("x.fragments").alias("n", "f")).select("person_id", "match_key", F.col("n").cast("bigint").alias("n"), "f.fragment_type", "f.payload")
