"""Probable duplicates for review: blocked trigram and word-containment joins over distinct names.

All comparing is done between distinct names; persons come in once, at the end.  A blocking key that
more than ``most`` persons share is a common name and is not compared, which also bounds every block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fragloom.functions.trigram import similarity, trigrams
from fragloom.operators.merge import eligible_name

#: How alike names must be, beyond how many persons a blocking key is a common name, and verdicts that settle a person.
SIMILARITY, MOST_PERSONS = 0.85, 20
SETTLED = ("approved", "merged")


def unsettled(persons: DataFrame, reviews: DataFrame) -> DataFrame:
    """persons whose match key no reviewer has settled."""
    return persons.join(reviews.where(F.col("status").isin(*SETTLED)).select("match_key").distinct(), "match_key", "left_anti")


def candidates(persons: DataFrame, reviews: DataFrame) -> DataFrame:
    """id, norm, passport of the persons that may be grouped."""
    return unsettled(persons.where(eligible_name(F.col("norm_name"))), reviews).select("id", F.col("norm_name").alias("norm"), "passport")


def name_catalog(persons: DataFrame) -> DataFrame:
    """norm, words, key2, keyt, n_persons, anchor_id, anchor_passport, n_passports for each name; persons: candidates()."""
    names = persons.groupBy("norm").agg(F.count("*").alias("n_persons"), F.min("id").alias("anchor_id"), F.min_by("passport", "id").alias("anchor_passport"), F.countDistinct("passport").alias("n_passports"))
    words = names.withColumn("words", F.split("norm", " "))
    first, second = F.get("words", F.lit(0)), F.get("words", F.lit(1))
    return words.withColumns({"key2": F.concat_ws(" ", first, second), "keyt": F.concat_ws("|", first, F.substring(second, 1, 3))})


def _blocked(names: DataFrame, key: str, most: int) -> DataFrame:
    """Pairs (a, b) of different names in one block of several names and at most so many persons."""
    small = names.groupBy(key).agg(F.sum("n_persons").alias("persons"), F.count("*").alias("names")).where((F.col("persons") <= most) & (F.col("names") > 1))
    side = names.join(small.select(key), key, "left_semi").select(key, F.struct("norm", "words", "anchor_id", trigrams(F.col("norm")).alias("t")).alias("n"))
    a, b = side.select(key, F.col("n").alias("a")), side.select(key, F.col("n").alias("b"))
    return a.join(b, key).where("a.norm <> b.norm")


def name_pairs(names: DataFrame, threshold: float = SIMILARITY, most: int = MOST_PERSONS) -> DataFrame:
    """a, b, sim, contain, b_anchor: each related pair of names in both directions, once for each relation."""
    sim = similarity(F.col("a.t"), F.col("b.t"))
    out = [F.col("a.norm").alias("a"), F.col("b.norm").alias("b"), "sim", "contain", F.col("b.anchor_id").alias("b_anchor")]
    fuzzy = _blocked(names, "keyt", most).withColumn("sim", sim).where((F.col("sim") >= threshold) & (F.col("sim") < 1)).withColumn("contain", F.lit(False))
    inside = (F.size(F.array_except("a.words", "b.words")) == 0) | (F.size(F.array_except("b.words", "a.words")) == 0)
    contain = _blocked(names, "key2", most).where((F.size("a.words") != F.size("b.words")) & inside).withColumn("sim", sim).withColumn("contain", F.lit(True))
    return fuzzy.select(*out).unionByName(contain.select(*out))


def duplicate_groups(persons: DataFrame, reviews: DataFrame, threshold: float = SIMILARITY, most: int = MOST_PERSONS) -> DataFrame:
    """group_id, person_id, confidence, reason for each probable duplicate.

    A name's anchor is the least among itself and its direct neighbours.  A person joins its name's
    anchor, unless the name is merely repeated and the passport contradicts that of the name's least person.
    """
    people = candidates(persons, reviews)
    names = name_catalog(people)
    near = name_pairs(names, threshold, most).groupBy(F.col("a").alias("norm")).agg(F.min("b_anchor").alias("near"), F.max("sim").alias("sim"), F.bool_or("contain").alias("containment"), F.bool_or(~F.col("contain")).alias("fuzzy"))
    named = names.select("norm", "n_persons", "anchor_id", "anchor_passport").join(near, "norm", "left")
    named = named.where(F.col("near").isNotNull() | F.col("n_persons").between(2, most))
    named = named.withColumn("anchor", F.least("anchor_id", "near"))
    rows = people.join(named, "norm")
    contradicts = F.col("near").isNull() & (F.col("n_persons") > 1) & F.coalesce(F.col("passport") != F.col("anchor_passport"), F.lit(False))
    reason = F.when(F.coalesce("containment", F.lit(False)), F.lit("name_containment")).when(F.coalesce("fuzzy", F.lit(False)), F.lit("fuzzy_name")).otherwise(F.lit("exact_name"))
    kept = rows.where(~contradicts).select(F.least("id", "anchor").alias("group_id"), F.col("id").alias("person_id"), F.round(F.coalesce("sim", F.lit(1.0)), 3).alias("confidence"), reason.alias("reason"))
    several = kept.groupBy("group_id").count().where("count > 1").select("group_id")
    return kept.join(several, "group_id", "left_semi")
