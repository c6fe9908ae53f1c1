"""The curated layer: gate, aggregates and review groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fragloom.operators.reconcile import unsettled
from fragloom.operators.schema import COMPLETENESS_FIELDS, FIELDS, LEAST_FILLED, REQUIRED_FIELDS

#: Fixed value: rows of a top list.
TOP = 50


def filled_count() -> Column:
    """How many of the tracked fields are there; an empty string is."""
    return sum(F.col(f).isNotNull().cast("int") for f in COMPLETENESS_FIELDS)


def gold_persons(persons: DataFrame, reviews: DataFrame) -> DataFrame:
    """Persons that a reviewer approved, or that are complete and alone with their name.

    Names are counted, and the single ones joined back: however many rows share a name, they only add
    to a partial count.
    """
    approved = reviews.where("status = 'approved'").select("match_key").distinct().withColumn("approved", F.lit(True))
    single = persons.where("norm_name is not null").groupBy("norm_name").count().where("count = 1").select("norm_name", F.lit(True).alias("single"))
    required = filled_count() >= LEAST_FILLED
    for field in REQUIRED_FIELDS:
        required = required & F.col(field).isNotNull()
    marked = persons.join(approved, "match_key", "left").join(single, "norm_name", "left")
    gold = marked.where(F.coalesce("approved", F.lit(False)) | (required & F.coalesce("single", F.lit(False))))
    return gold.select("id", "match_key", *FIELDS, (filled_count() / 8.0).alias("completeness"), "created_at")


def gold_stats(gold: DataFrame) -> DataFrame:
    """One row of counts; average completeness in fields, 0 without persons."""
    counts = {"with_passport": "passport", "with_city": "city", "with_company": "company", "with_bank": "iban", "with_ipv4": "ipv4"}
    linked = F.col("passport").isNotNull() & F.col("city").isNotNull()
    return gold.agg(F.count("*").alias("total_persons"), *(F.count(c).alias(n) for n, c in counts.items()), F.count_if(linked).alias("cross_linked"), F.coalesce(F.avg("completeness") * 8, F.lit(0.0)).alias("avg_completeness"))


def top_values(persons: DataFrame, field: str, n: int = TOP) -> DataFrame:
    """The n most frequent values of a field, equal ones in order of value."""
    return persons.where(F.col(field).isNotNull()).groupBy(field).agg(F.count("*").alias("person_count")).orderBy(F.desc("person_count"), field).limit(n)


def completeness(gold: DataFrame) -> DataFrame:
    """fields_filled, person_count."""
    return gold.groupBy(filled_count().cast("bigint").alias("fields_filled")).agg(F.count("*").alias("person_count")).orderBy("fields_filled")


def gold_groups(groups: DataFrame, persons: DataFrame, reviews: DataFrame) -> DataFrame:
    """group_id, member_count, max_confidence, reason and members for groups that still have two unsettled members."""
    members = groups.join(unsettled(persons, reviews).select(F.col("id").alias("person_id"), "full_name", "city", "company"), "person_id")
    member = F.struct("person_id", "full_name", "city", "company")
    out = members.groupBy("group_id").agg(F.count("*").alias("member_count"), F.max("confidence").alias("max_confidence"), F.max_by("reason", F.struct("confidence", -F.col("person_id"))).alias("reason"), F.array_sort(F.collect_list(member)).alias("members"))
    return out.where("member_count >= 2")


def members_json(groups: DataFrame) -> DataFrame:
    """groups with their members as JSON text, nulls written out: the form that the API hands on."""
    return groups.withColumn("members", F.to_json("members", {"ignoreNullFields": "false"}))
