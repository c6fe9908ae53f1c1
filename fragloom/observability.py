"""Metrics of jobs and streams: counters and gauges with a text form, and a listener that feeds them."""

from __future__ import annotations

import logging
import re
from collections import defaultdict
from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fragloom.functions.text import REDACTIONS
from fragloom.storage import materialise

#: Upper bounds of a histogram's buckets, in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 60, 300)


class Metrics:
    """Counters, gauges and histograms by name and label."""

    def __init__(self):
        self.values: dict[tuple[str, str], float] = defaultdict(float)
        self.kinds: dict[str, str] = {}

    def count(self, name: str, n: float = 1, label: str = "") -> None:
        self.kinds[name] = "counter"
        self.values[name, label] += n

    def gauge(self, name: str, value: float, label: str = "") -> None:
        self.kinds[name] = "gauge"
        self.values[name, label] = value

    def observe(self, name: str, seconds: float) -> None:
        self.kinds[name] = "histogram"
        for bound in (*BUCKETS, float("inf")):
            self.values[f"{name}_bucket", f'le="{"+Inf" if bound == float("inf") else bound:}"'] += seconds <= bound
        self.values[f"{name}_sum", ""] += seconds
        self.values[f"{name}_count", ""] += 1

    def text(self) -> str:
        """The exposition format that scrapers read."""
        lines = [f"# TYPE {name} {kind}" for name, kind in self.kinds.items()]
        return "\n".join(lines + [f"{name}{{{label}}} {value:g}" if label else f"{name} {value:g}" for (name, label), value in self.values.items()]) + "\n"


def rate(before: dict, after: dict, name: str, seconds: float) -> dict[str, float]:
    """How much a counter grew a second between two states of Metrics.values, by label; one that went back began anew."""
    grown = {label: (value, before.get((n, label), 0.0)) for (n, label), value in after.items() if n == name}
    return {label: (new - old if new >= old else new) / seconds for label, (new, old) in grown.items()}


def bucket_quantile(values: dict, name: str, share: float) -> float | None:
    """A quantile of a histogram in Metrics.values, even inside its bucket; None without observations, and the last bound beyond it."""
    total = values.get((f"{name}_count", ""), 0)
    if not total:
        return None
    low, below = 0.0, 0.0
    for bound in BUCKETS:
        upto = values.get((f"{name}_bucket", f'le="{bound:}"'), 0)
        if upto >= share * total:
            return low + (bound - low) * ((share * total - below) / (upto - below) if upto > below else 1.0)
        low, below = bound, upto
    return float(BUCKETS[-1])


class StreamMetrics(StreamingQueryListener):
    """Feeds a stream's progress into metrics."""

    def __init__(self, metrics: Metrics):
        self.metrics = metrics

    def onQueryStarted(self, event):  # noqa: N802
        self.metrics.gauge("stream_active", 1)

    def onQueryProgress(self, event):  # noqa: N802
        self.metrics.count("stream_rows", event.progress.numInputRows)
        self.metrics.observe("stream_batch_seconds", event.progress.batchDuration / 1000)

    def onQueryTerminated(self, event):  # noqa: N802
        self.metrics.gauge("stream_active", 0)


def quantiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """share, value: quantiles of a column, each the least value that reaches its share of the rows (nulls aside); null without rows.

    Equal values are counted and dealt to ranges first; only the ranges that hold a quantile are then summed value by value.
    """
    if not all(0 <= share <= 1 for share in shares):
        raise ValueError("shares lie between 0 and 1")
    counts = df.select(F.col(value).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    counts = materialise(counts.repartitionByRange("value").withColumn("range", F.spark_partition_id()))  # read twice, and the ranges must stay
    sizes = counts.groupBy("range").agg(F.min("value").alias("least"), F.sum("n").alias("size")).orderBy("least").select("range", "size").collect()
    total, wanted = sum(size for _, size in sizes), []
    for place, share in enumerate(shares):
        rank, at = max(1, ceil(Fraction(str(share)) * total)), None
        for at, size in sizes:
            if rank <= size:
                break
            rank -= size
        wanted.append((place, float(share), at, rank))
    ranks = df.sparkSession.createDataFrame(wanted, "place int, share double, range int, rank bigint")
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("value"))
    summed = counts.where(F.col("range").isin([at for *_, at, _ in wanted])).withColumn("upto", upto)
    reached = ranks.join(summed, (ranks["range"] == summed["range"]) & (F.col("upto") >= F.col("rank")), "left")
    return reached.groupBy("place", "share").agg(F.min("value").alias("value")).orderBy("place").select("share", "value")


class Redactor(logging.Filter):
    """Stars out labelled passports, IBANs and e-mail addresses in log messages."""

    def filter(self, record: logging.LogRecord) -> bool:
        message = record.getMessage()
        for pattern, instead in REDACTIONS:
            message = re.sub(pattern, instead.replace("$", "\\"), message)
        record.msg, record.args = message, None
        return True
