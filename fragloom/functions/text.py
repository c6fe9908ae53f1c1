"""Normalising text, keys, names and amounts; masking.  All JVM expressions but ``strip_accents``."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

#: Titles taken off a built name, before and after it.
BUILT_PREFIXES = "mr mrs ms dr dr(a) dott dott.ssa ing lic mtro prof sr sra sr(a) sig sig.ra".split()
BUILT_SUFFIXES = "md phd ph.d jr sr ii iii iv pi dds esq".split()
#: Of these, the ones that may not be followed by a dot.
UNDOTTED_PREFIXES = "dott.ssa sig.ra".split()
UNDOTTED_SUFFIXES = "md phd ii iii iv pi dds".split()
#: Titles taken off both ends of a canonical name, and the letters that it folds.
NAME_TITLES = "mr mrs ms miss sir dr dr(a) dott dott.ssa ing lic mtro prof sr sra sr(a) sig sig.ra md phd ph.d jr ii iii iv pi dds esq".split()
ACCENTED, PLAIN = "áàäâãéèëêíìïîóòöôõúùüûñçý", "aaaaaeeeeiiiiooooouuuuncy"
#: A misspelt key and the one that it stands for.
KEY_ALIASES = {"companyadress": "companyaddress"}

#: What is starred out, and what stands there instead ($1 is the first group).
REDACTIONS = (
    (r"(?i)(passport[=:\s]+)([A-Z0-9]{7,10})", "$1***masked***"),
    (r"\b([A-Z]{2}\d{2})[A-Z0-9]{10,30}\b", "$1***masked***"),
    (r"\b[\w.+-]+(@[\w.-]+\.\w+)\b", "***@masked***"),
)

SPACES = r"(?U)\s+"


def _either(words: list[str], undotted: list[str] | None) -> str:
    """A pattern for one of the words, with a dot after it where that is allowed."""
    escaped = {w: w.replace(".", r"\.").replace("(", r"\(").replace(")", r"\)") for w in words}
    return "(?:" + "|".join(escaped[w] + ("" if undotted is not None and w in undotted else r"\.?") for w in words) + ")"


def collapsed(text: Column) -> Column:
    """Runs of white space of any script as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


@F.pandas_udf(StringType())
def _decomposed(text: pd.Series) -> pd.Series:
    plain = lambda x: x if x is None or x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return text.map(plain)


# Marked so that the optimiser leaves it in the projection that calls it: copied into a pushed-down
# filter or a conditional, a Python function cannot be evaluated.
_decomposed = _decomposed.asNondeterministic()


def strip_accents(text: Column) -> Column:
    """Compatibility decomposition without combining marks: the one expression that Spark has no built-in for.  Call it in a projection."""
    return _decomposed(text)


def normalize_text(text: Column) -> Column:
    """Accents stripped, lower case, white space collapsed; '' for null."""
    return collapsed(F.lower(strip_accents(F.coalesce(text, F.lit("")))))


def normalize_key(key: Column) -> Column:
    """A message key in its canonical spelling: lower case without white space, '_' and '-', misspellings mended."""
    plain = F.regexp_replace(F.lower(key), r"(?U)[\s_\-]+", "")
    for wrong, right in KEY_ALIASES.items():
        plain = F.when(plain == wrong, F.lit(right)).otherwise(plain)
    return plain


def bound(value: Column, use) -> Column:
    """use(value) with value worked out once, however often use names it: inside nested functions it would be worked out again for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalize_message(message: Column) -> Column:
    """A map with canonical keys; null for null.  Where two keys become one, the last one's value stays."""
    renamed = F.transform(F.map_entries(message), lambda e: F.struct(normalize_key(e["key"]).alias("key"), e["value"].alias("value")))

    def last_of_each(entries: Column) -> Column:
        names = F.transform(entries, lambda e: e["key"])
        unique = F.size(F.array_distinct(names)) == F.size(names)
        last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
        return F.map_from_entries(F.when(unique, entries).otherwise(last))

    return bound(renamed, last_of_each)


def strip_titles(name: Column) -> Column:
    """One title off the front, one off the end of a normalised name."""
    front = F.trim(F.regexp_replace(name, rf"(?i)^{_either(BUILT_PREFIXES, UNDOTTED_PREFIXES)}\s+", ""))
    return F.trim(F.regexp_replace(front, rf"(?i)\s+{_either(BUILT_SUFFIXES, UNDOTTED_SUFFIXES)}$", ""))


def norm_name(name: Column) -> Column:
    """The canonical name that persons are compared by; null if nothing is left."""
    out = collapsed(F.translate(F.lower(name), ACCENTED, PLAIN))
    title = _either(NAME_TITLES, None)
    for pattern in (rf"(?i)^{title}\s+", rf"(?i)\s+{title}$") * 2:
        out = F.trim(F.regexp_replace(out, pattern, ""))
    return F.nullif(out, F.lit(""))


def clean_salary(text: Column) -> Column:
    """The number in a text with currency signs and separators: of several separators the last is the decimal one; null if there is none."""
    digits = F.regexp_replace(F.regexp_replace(text, r"[^0-9.,\-]", ""), ",", ".")
    return F.regexp_replace(digits, r"\.(?=.*\.)", "").try_cast("double")


def scalar(text: Column) -> Column:
    """The first element of a value that is a JSON list (null if it is empty), or the value."""
    return F.when(text.startswith("["), F.get(F.from_json(text, "array<string>"), F.lit(0))).otherwise(text)


def mask_secret(text: Column, visible: int = 4) -> Column:
    """All but the last characters starred; '' for null."""
    text = F.coalesce(text, F.lit(""))
    hidden = F.length(text) - visible
    return F.when(hidden <= 0, F.repeat(F.lit("*"), F.length(text))).otherwise(F.concat(F.repeat(F.lit("*"), hidden), F.right(text, F.lit(visible))))


def redact(text: Column) -> Column:
    """Labelled passports, IBANs (but for country and check digits) and the local parts of e-mail addresses starred out."""
    for pattern, instead in REDACTIONS:
        text = F.regexp_replace(text, pattern, instead)
    return text


def thousands(number: Column) -> Column:
    """An integer with dots between thousands; a dash for null."""
    return F.coalesce(F.translate(F.format_number(number, 0), ",", "."), F.lit("—"))


def prefix_confidence(short: Column, long: Column) -> Column:
    """How much of a name the other one is, if it begins it."""
    return F.when(long.startswith(short), F.length(short) / F.length(long))
