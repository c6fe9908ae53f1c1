"""Merging split persons: link rules, components, survivorship, and the manual merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fragloom.functions.text import norm_name
from fragloom.functions.trigram import similarity, trigrams
from fragloom.operators.components import components
from fragloom.operators.schema import FIELDS
from fragloom.storage import materialise

#: How alike names under one passport must be, what a name needs to say enough, and a merge's note.
MERGE_SIMILARITY = 0.85
LEAST_LENGTH, LEAST_WORDS = 3, 2
MANUAL_NOTE = "manual consolidation"


def eligible_name(name: Column) -> Column:
    """Whether a canonical name says enough: three characters and two words at least."""
    return name.isNotNull() & (F.length(name) >= LEAST_LENGTH) & (F.size(F.split(name, " ")) >= LEAST_WORDS)


def passport_links(persons: DataFrame, threshold: float = MERGE_SIMILARITY) -> DataFrame:
    """u, v: persons with one passport and similar names.

    Equal names under a passport are a star around the least id.  Of the different ones only those meet that share one of
    their first trigrams in one order of all: two sets with a similarity of t share one of the first n - ceil(t n) + 1 of
    either's n.  So a passport that very many persons bear, such as a placeholder, is not compared all with all.
    """
    named = persons.where("passport is not null and norm_name is not null").select("id", "passport", "norm_name")
    names = named.groupBy("passport", "norm_name").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    several = names.where("n > 1").select("passport", "norm_name", "least")
    stars = named.join(several, ["passport", "norm_name"]).where("id <> least").select(F.col("id").alias("u"), F.col("least").alias("v"))
    shared = names.groupBy("passport").count().where("count > 1").select("passport")
    side = names.join(shared, "passport", "left_semi").withColumn("t", trigrams(F.col("norm_name")))
    size = F.size("t")
    enough = F.greatest(F.lit(1), size - F.ceil(size * (threshold - 1e-6)) + 1).cast("int")
    grams = F.slice(F.array_sort(F.transform("t", lambda g: F.xxhash64(g))), F.lit(1), enough)
    marked = materialise(side.withColumn("gram", F.explode(grams)))
    a, b = marked.alias("a"), marked.alias("b")
    pairs = a.join(b, (F.col("a.passport") == F.col("b.passport")) & (F.col("a.gram") == F.col("b.gram")) & (F.col("a.norm_name") < F.col("b.norm_name")))
    alike = pairs.where(similarity(F.col("a.t"), F.col("b.t")) >= threshold).distinct()
    return stars.unionByName(alike.select(F.col("a.least").alias("u"), F.col("b.least").alias("v")))


def split_name_links(persons: DataFrame) -> DataFrame:
    """u, v: the two persons of a name that only they have, if at least one has a passport and they have no two different ones."""
    names = persons.where(eligible_name(F.col("norm_name"))).groupBy("norm_name").agg(F.count("*").alias("n"), F.count("passport").alias("with_passport"), F.min("passport").alias("p"), F.max("passport").alias("q"), F.min("id").alias("v"), F.max("id").alias("u"))
    return names.where("n = 2 and with_passport >= 1 and p = q").select("u", "v")


def merge_links(persons: DataFrame, threshold: float = MERGE_SIMILARITY) -> DataFrame:
    return passport_links(persons, threshold).unionByName(split_name_links(persons)).distinct()


def survivors(links: DataFrame) -> DataFrame:
    """loser, survivor: each linked person that is not the least of its component, and that least one."""
    return components(links).where("node <> root").select(F.col("node").alias("loser"), F.col("root").alias("survivor"))


def survive(persons: DataFrame, losers: DataFrame) -> DataFrame:
    """persons after losers went into their survivors.

    Of each field the value of the least id that has one survives; of full names the longest; of times
    the widest span.  Persons that no link touches pass unchanged.
    """
    touched = losers.select(F.col("loser").alias("id"), F.col("survivor").alias("root")).unionByName(losers.select(F.col("survivor").alias("id"), F.col("survivor").alias("root")).distinct())
    mapped = persons.join(touched, "id", "left")
    whole = mapped.where("root is null").select(*persons.columns)
    values = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("id"))).alias(f) for f in FIELDS if f != "full_name"]
    full = F.max_by("full_name", F.when(F.col("full_name").isNotNull(), F.struct(F.length("full_name"), -F.col("id")))).alias("full_name")
    folded = mapped.where("root is not null").groupBy("root").agg(F.min_by("match_key", "id").alias("match_key"), full, *values, F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    folded = folded.withColumnRenamed("root", "id").withColumn("norm_name", norm_name(F.col("full_name")))
    return whole.unionByName(folded.select(*persons.columns))


def consolidate(persons: DataFrame, threshold: float = MERGE_SIMILARITY) -> DataFrame:
    """persons after the automatic merge.  Run again, it changes nothing that it could have merged before."""
    return survive(persons, survivors(merge_links(persons, threshold)))


def manual_merge(persons: DataFrame, reviews: DataFrame, ids: list[int]) -> tuple[DataFrame, DataFrame]:
    """(persons, reviews) after a person decided that two rows are one; the loser's key is traced to the survivor's.

    An id may be named more than once.  Raises ValueError unless there are exactly two different ids and both exist; nothing has changed then.
    """
    ids = sorted(set(ids))
    if len(ids) != 2:
        raise ValueError("a merge takes exactly two different ids")
    if persons.where(F.col("id").isin(ids)).select("id").distinct().count() != 2:
        raise ValueError("a person to merge does not exist")
    low, high = ids
    losers = persons.sparkSession.createDataFrame([(high, low)], "loser bigint, survivor bigint")
    return survive(persons, losers), with_merge_decisions(persons, reviews, losers, MANUAL_NOTE)


def with_merge_decisions(persons: DataFrame, reviews: DataFrame, losers: DataFrame, note: str) -> DataFrame:
    """reviews with each loser's key marked as merged into its survivor's; earlier verdicts on that key are replaced."""
    keys = persons.select("id", "match_key")
    lost = losers.join(keys.select(F.col("id").alias("loser"), "match_key"), "loser").where("match_key is not null")
    kept = lost.join(keys.select(F.col("id").alias("survivor"), F.col("match_key").alias("survivor_match_key")), "survivor")
    traces = kept.select("match_key", F.lit("merged").alias("status"), "survivor_match_key", F.lit(note).alias("note"))
    return reviews.select("match_key", "status", "survivor_match_key", "note").join(traces, "match_key", "left_anti").unionByName(traces)
