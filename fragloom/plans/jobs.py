"""The batch half: merge, then reconcile, then the curated layer; and the reprocess from raw data."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fragloom.observability import Metrics
from fragloom.operators import fragments, gold, linking, merge, reconcile, upsert
from fragloom.storage import SnapshotSet, materialise


@dataclass
class Curated:
    """What the maintenance job leaves."""

    persons: DataFrame
    duplicate_groups: DataFrame
    gold_persons: DataFrame
    gold_stats: DataFrame
    gold_top_cities: DataFrame
    gold_top_companies: DataFrame
    gold_completeness: DataFrame
    gold_duplicate_groups: DataFrame


def maintain(persons: DataFrame, reviews: DataFrame, merge_similarity: float = merge.MERGE_SIMILARITY, similarity: float = reconcile.SIMILARITY, metrics: Metrics | None = None) -> Curated:
    """All curated tables from Silver persons and review decisions, in the one order that is right."""
    began = time.monotonic()
    merged = materialise(merge.consolidate(upsert.backfill_names(persons), merge_similarity))
    reconciling = time.monotonic()
    groups = materialise(reconcile.duplicate_groups(merged, reviews, similarity))
    reconciled = time.monotonic() - reconciling
    curated = materialise(gold.gold_persons(merged, reviews))
    if metrics:
        metrics.count("consolidation_merged_rows", persons.count() - merged.count())
        metrics.gauge("duplicate_groups", groups.select("group_id").distinct().count())
        metrics.gauge("duplicate_memberships", groups.count())
        metrics.gauge("gold_persons", curated.count())
        metrics.observe("reconcile_seconds", reconciled)
        metrics.observe("maintenance_seconds", time.monotonic() - began)
    return Curated(merged, groups, curated, gold.gold_stats(curated), gold.top_values(curated, "city"), gold.top_values(curated, "company"), gold.completeness(curated), gold.gold_groups(groups, merged, reviews))


def publish(curated: Curated, folder: str) -> None:
    """Write all tables as one new set under folder: readers see all of them change at once (storage.SnapshotSet)."""
    SnapshotSet(curated.persons.sparkSession, folder).write(vars(curated))


def ingest(raw: DataFrame, lifetime: float = linking.LIFETIME_S, least: int = linking.LEAST_FRAGMENTS, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(persons, fragment log) after raw messages (seq, ts, value): the batch form of the stream, and the reprocess of a raw layer."""
    folded = materialise(linking.link(fragments.usable(fragments.classify(raw)), lifetime, least))
    persons = materialise(upsert.upsert(folded, existing))
    return persons, upsert.fragment_log(folded, persons)
