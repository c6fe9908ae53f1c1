"""The query API as functions over tables: DataFrames for rows, dicts where the answer is a few numbers.

Bounds are checked before anything runs; a value out of range is a ValueError.  Search text only ever
becomes a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fragloom.operators import gold as G
from fragloom.operators.schema import FIELDS

#: Rows of a page at most and by default, columns that free text is looked for in, and what is said before the first refresh.
MOST_ROWS, PAGE = 500, 50
PERSON_COLUMNS = ["id", *FIELDS]
SEARCHED = ["full_name", "name", "lastname", "company", "email"]
NOT_REFRESHED = "gold layer not refreshed yet"


class NotFound(LookupError):
    """There is no such row."""


def _within(name: str, value: float, low: float, high: float) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must be from {low} to {high}")


def _limit(limit: int) -> None:
    _within("limit", limit, 1, MOST_ROWS)


def health() -> dict:
    return {"status": "ok"}


def person_filter(q: str | None = None, city: str | None = None, company: str | None = None, job: str | None = None) -> Column:
    """All the conditions that are given: city is equal but for case, the others contain the text; % and _ are wild."""
    out = F.lit(True)
    like = lambda field, value: F.col(field).ilike(f"%{value.strip()}%")
    if city:
        out = out & (F.lower("city") == city.strip().lower())
    if company:
        out = out & like("company", company)
    if job:
        out = out & like("job", job)
    if q:
        found = F.lit(False)
        for field in SEARCHED:
            found = found | F.coalesce(like(field, q), F.lit(False))
        out = out & found
    return out


def persons_page(persons: DataFrame, limit: int = PAGE, offset: int = 0, **filters: str | None) -> DataFrame:
    """One page of persons by id.  persons_total has the count of all."""
    _limit(limit)
    _within("offset", offset, 0, 1 << 62)
    return persons.where(person_filter(**filters)).orderBy("id").offset(offset).limit(limit).select(*PERSON_COLUMNS)


def persons_total(persons: DataFrame, **filters: str | None) -> int:
    return persons.where(person_filter(**filters)).count()


def persons_list(persons: DataFrame, limit: int = PAGE, offset: int = 0, **filters: str | None) -> dict:
    """A page as it is answered: total, count, limit, offset and items."""
    items = [row.asDict() for row in persons_page(persons, limit, offset, **filters).collect()]
    return {"total": persons_total(persons, **filters), "count": len(items), "limit": limit, "offset": offset, "items": items}


def person(persons: DataFrame, id: int) -> DataFrame:
    """The person with that id; NotFound if there is none."""
    found = persons.where(F.col("id") == id).select(*PERSON_COLUMNS).limit(1)
    rows = found.collect()
    if not rows:
        raise NotFound(id)
    return persons.sparkSession.createDataFrame(rows, found.schema)


def stats(persons: DataFrame) -> dict:
    """total_persons, with_bank and the five most frequent cities and companies of Silver."""
    total = persons.agg(F.count("*").alias("total_persons"), F.count("iban").alias("with_bank")).first().asDict()
    pairs = lambda field: [(row[0], row[1]) for row in G.top_values(persons, field, 5).collect()]
    return total | {"top_cities": pairs("city"), "top_companies": pairs("company")}


def candidates(pairs: DataFrame, limit: int = PAGE, min_confidence: float = 0.5) -> DataFrame:
    """Match candidates by confidence."""
    _limit(limit)
    _within("min_confidence", min_confidence, 0, 1)
    return pairs.where(F.col("confidence") >= min_confidence).orderBy(F.desc("confidence"), "id").limit(limit)


def groups(groups: DataFrame, persons: DataFrame, reviews: DataFrame, limit: int = PAGE, min_confidence: float = 0.5) -> DataFrame:
    """Review groups by confidence; members with any verdict are left out after the limit, and so are groups left with fewer than two."""
    _limit(limit)
    _within("min_confidence", min_confidence, 0, 1)
    page = groups.where(F.col("max_confidence") >= min_confidence).orderBy(F.desc("max_confidence"), "group_id").limit(limit)
    reviewed = persons.join(reviews.select("match_key").distinct(), "match_key", "left_semi").select(F.col("id").alias("person_id"))
    shown = page.select("group_id", F.col("max_confidence").alias("confidence"), "reason", F.explode("members").alias("member"))
    open_members = shown.withColumn("person_id", F.col("member.person_id")).join(reviewed, "person_id", "left_anti")
    bundled = open_members.groupBy("group_id", "confidence", "reason").agg(F.array_sort(F.collect_list("member")).alias("members"))
    return bundled.where(F.size("members") >= 2).orderBy(F.desc("confidence"), "group_id")


def groups_total(groups: DataFrame, min_confidence: float = 0.5) -> int:
    return groups.where(F.col("max_confidence") >= min_confidence).count()


def gold_page(gold: DataFrame, limit: int = PAGE, after_id: int | None = 0, offset: int = 0, **filters: str | None) -> DataFrame:
    """The page after an id, or without one from an offset, with one row more than asked for if there is one: that is has_more."""
    _limit(limit)
    _within("offset", offset, 0, 1 << 62)
    rows = gold.where(person_filter(**filters))
    rows = rows.orderBy("id").offset(offset) if after_id is None else rows.where(F.col("id") > after_id).orderBy("id")
    return rows.limit(limit + 1).select(*PERSON_COLUMNS, "completeness")


def gold_cursor(rows: list, limit: int) -> dict:
    """has_more and next_cursor, the last id shown, for the rows of gold_page."""
    shown = rows[:limit]
    return {"has_more": len(rows) > limit, "next_cursor": shown[-1]["id"] if shown else None, "items": shown}


def gold_list(gold: DataFrame | None, limit: int = PAGE, after_id: int | None = None, offset: int = 0, with_total: bool = False, **filters: str | None) -> dict:
    """A page as it is answered; the total is counted only if asked for.  Before the first refresh it is an empty page."""
    rows = [] if gold is None else [row.asDict() for row in gold_page(gold, limit, after_id, offset, **filters).collect()]
    total = (0 if gold is None else gold.where(person_filter(**filters)).count()) if with_total else None
    page = gold_cursor(rows, limit)
    return {"total": total, "count": len(page["items"]), "limit": limit, "offset": offset} | page


def gold_stats(table: DataFrame | None) -> dict:
    """The one row of the curated statistics, or an error if there is none yet."""
    row = table.first() if table is not None else None
    if row is None:
        return {"error": NOT_REFRESHED}
    return row.asDict() | {"avg_completeness": round(row["avg_completeness"], 2)}


def medallion(bronze: DataFrame | None, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """bronze, silver and gold counts, and raw rows a person; a layer that cannot be read is null."""
    rows = lambda df: df.agg(F.count("*")).scalar()
    raw = F.lit(None).cast("bigint") if bronze is None else rows(bronze)
    one = silver.sparkSession.range(1).select(raw.alias("bronze"), rows(silver).alias("silver"), rows(gold).alias("gold"))
    return one.withColumn("ratio", F.col("bronze") / F.greatest("silver", F.lit(1)))


def approve(reviews: DataFrame, persons: DataFrame, person_id: int, note: str | None = None) -> DataFrame:
    """reviews after a reviewer confirmed a person; ValueError for a note over 255 characters, NotFound without such a person."""
    from fragloom.operators.upsert import upsert_reviews

    if note is not None and len(note) > 255:
        raise ValueError("a note has at most 255 characters")
    one = persons.where(F.col("id") == person_id).select("match_key")
    if one.isEmpty():
        raise NotFound(person_id)
    decision = one.select(F.lit(0).cast("bigint").alias("seq"), "match_key", F.lit("approved").alias("status"), F.lit(None).cast("string").alias("survivor_match_key"), F.lit(note).cast("string").alias("note"))
    return upsert_reviews(decision, reviews)


NOTICE = "Results may hold personal data."


def tools(persons: DataFrame, gold: DataFrame, pairs: DataFrame) -> dict:
    """The closed catalogue of assistant tools, by name."""
    return {
        "get_stats": lambda: stats(persons),
        "top_cities": lambda limit=10: stats(persons)["top_cities"][:limit],
        "top_companies": lambda limit=10: stats(persons)["top_companies"][:limit],
        "completeness_distribution": lambda: [tuple(row) for row in G.completeness(gold).collect()],
        "duplicate_candidates": lambda limit=20: [row.asDict() for row in candidates(pairs, limit).collect()],
        "search_person": lambda q=None, city=None, company=None, job=None, page=1: {"notice": NOTICE} | persons_list(persons, 10, (page - 1) * 10, q=q, city=city, company=company, job=job),
        **{f"explain_{topic}": (lambda text=text: text) for topic, text in EXPLAINED.items()},
    }


EXPLAINED = {
    "pipeline": "Raw messages are kept as they come; fragments with one key are folded into a person; batch jobs merge, group and curate.",
    "matching": "A fragment's key is its passport, or else its name, or else its address; a name leads to the passport that it was last seen with.",
    "duplicates": "Names that differ by a typing error, or hold one another's words, are grouped for a reviewer; nothing is merged on that ground.",
    "gold": "A curated person has the five required fields, seven of eight tracked ones, and a name of its own, or a reviewer's approval.",
}
