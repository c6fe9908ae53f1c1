"""Trigram similarity, as PostgreSQL's trigram module defines it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trigrams(text: Column) -> Column:
    """The set of trigrams of a text's words, each padded with two blanks before and one after."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    of_word = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, of_word)))


def similarity(a: Column, b: Column) -> Column:
    """Common trigrams over all trigrams of two trigram sets, in single precision."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every > 0, common / every).otherwise(F.lit(0.0)).cast("float").cast("double")
