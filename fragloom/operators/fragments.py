"""Raw messages to typed, keyed fragments and partial persons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fragloom.functions import text as T
from fragloom.operators.schema import FIELDS, FRAGMENTS, UNKNOWN, field_type


def decode(value: Column) -> Column:
    """A message's bytes as a map of strings; null unless they are a JSON object."""
    return F.from_json(value.cast("string"), "map<string,string>")


def detect_type(message: Column) -> Column:
    """The fragment type whose keys the (canonical) message covers best, the first of equals; unknown below half."""
    names = F.map_keys(message)
    cover = {kind: F.size(F.array_intersect(names, F.array(*map(F.lit, keys)))) / len(keys) for kind, keys in FRAGMENTS.items()}
    best = F.greatest(*cover.values())
    out = F.when(best.isNull() | (best < 0.5), F.lit(UNKNOWN))
    for kind, share in cover.items():
        out = out.when(share == best, F.lit(kind))
    return out.otherwise(F.lit(UNKNOWN))


def built_name(full: Column, name: Column, lastname: Column) -> Column:
    """The full name without titles: the full one, or else name and lastname; all normalised."""
    return T.strip_titles(F.when(full != "", full).otherwise(F.trim(F.concat_ws(" ", name, lastname))))


def key_of(passport: Column, name: Column, address: Column) -> Column:
    """The match key: passport, or else name, or else address, all normalised; '' without any."""
    return F.when(passport != "", F.concat(F.lit("passport:"), passport)).when(name != "", F.concat(F.lit("name:"), name)).when(address != "", F.concat(F.lit("addr:"), address)).otherwise(F.lit(""))


def person_fields(kind: Column, message: Column, name: Column) -> list[Column]:
    """The person fields that a fragment fills; blanks are null.  A list stands for its first element."""
    value = lambda key: F.nullif(T.scalar(F.try_element_at(message, F.lit(key))), F.lit(""))
    out = []
    for field in FIELDS:
        filled = F.lit(None).cast("string")
        for fragment, keys in FRAGMENTS.items():
            for key, target in keys.items():
                if target == field:
                    filled = F.when(kind == fragment, value(key)).otherwise(filled)
        if field == "full_name":
            filled = F.when(kind == "personal", F.nullif(name, F.lit(""))).otherwise(filled)
        out.append((T.clean_salary(filled) if field == "salary" else filled).cast(field_type(field)).alias(field))
    return out


def classify(raw: DataFrame) -> DataFrame:
    """raw (seq, ts, value) with message, fragment_type, name and match_key.

    Undecodable values have a null message and type.  The five texts that keys are made of are normalised
    in a projection of their own, so the accent function gets them all in one batch and nothing else.
    """
    decoded = raw.withColumn("message", T.normalize_message(decode(F.col("value"))))
    parts = {f"_{key}": T.normalize_text(F.try_element_at("message", F.lit(key))) for key in ("fullname", "name", "lastname", "passport", "address")}
    there = F.col("message").isNotNull()
    typed = decoded.withColumns(parts | {"fragment_type": F.when(there, detect_type(F.col("message")))})
    named = typed.withColumn("name", F.when(there, built_name(F.col("_fullname"), F.col("_name"), F.col("_lastname"))))
    return named.withColumn("match_key", F.when(there, key_of(F.col("_passport"), F.col("name"), F.col("_address")))).drop(*parts)


def rejects(classified: DataFrame) -> DataFrame:
    """seq, reason of the rows that reach no person: undecodable, unknown type or no key.  They are never an error."""
    reason = F.when(F.col("message").isNull(), F.lit("undecodable")).when(F.col("fragment_type") == UNKNOWN, F.lit("unknown")).when(F.col("match_key") == "", F.lit("orphan"))
    return classified.select("seq", reason.alias("reason")).where("reason is not null")


def usable(classified: DataFrame) -> DataFrame:
    return classified.where((F.col("fragment_type") != UNKNOWN) & (F.col("match_key") != ""))
