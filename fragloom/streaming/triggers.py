"""When to rebuild the curated layer: after so many new persons, or after so long."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: New persons that call for a rebuild, seconds between looks, and seconds after which it is done anyway.
NEW_PERSONS, POLL_S, TIMEOUT_S = 150, 30, 900


def new_since(persons: DataFrame, since: Column | None) -> DataFrame:
    """n_new: persons created after a time, or all."""
    rows = persons if since is None else persons.where(F.col("created_at") > since)
    return rows.agg(F.count("*").alias("n_new"))


def wait_for(count: Callable[[], int], least: int = NEW_PERSONS, poll_s: float = POLL_S, timeout_s: float = TIMEOUT_S, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Polls until count() reaches least: True; or until the time is up: False, and the caller refreshes all the same."""
    waited = 0.0
    while count() < least:
        if waited >= timeout_s:
            return False
        sleep(poll_s)
        waited += poll_s
    return True
