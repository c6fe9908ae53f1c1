"""Messages to persons by micro-batches.

Each batch runs the batch operators over what it brings and the little that is carried over: the
fragments of buffers that have not fired, and each name's last registration.  Both, and the
persons, are numbered snapshots, written under the batch's number from those before it, so a batch
that is run again after a failure gives the same result: messages at least once, persons exactly
once.  The clock is the messages' own time: the greatest that was seen.  By it lapse the registrations of names and the
buffers that nothing can wake any more, so what is carried over does not grow with the stream; ``lateness`` keeps them
for messages that come out of order by so many seconds.  Snapshots before the last ``KEPT`` go.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from fragloom.observability import Metrics
from fragloom.operators import fragments, linking, upsert
from fragloom.sources import bronze
from fragloom.storage import Snapshots, materialise

#: Snapshots of each table that stay: a batch that is run again needs the one before it.
KEPT = 3

FRAGMENT = ["seq", "ts", "value", "message", "fragment_type", "name", "match_key"]


class Ingest:
    """State under ``folder``: bronze, persons, pending, aliases, fragment_log and rejects."""

    def __init__(self, spark: SparkSession, folder: str, lifetime: float = linking.LIFETIME_S, least: int = linking.LEAST_FRAGMENTS, metrics: Metrics | None = None, lateness: float = 0):
        self.spark, self.folder, self.lifetime, self.least, self.metrics = spark, folder, lifetime, least, metrics
        self.lateness = lateness
        self.tables = {name: Snapshots(spark, f"{folder}/{name}") for name in ("persons", "pending", "aliases", "fragment_log", "clock")}

    def start(self, messages: DataFrame, checkpoint: str, **trigger):
        """A query over a stream of (seq, ts, value); trigger as for writeStream, one second by default."""
        writer = messages.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()

    def _before(self, name: str, number: int) -> DataFrame | None:
        return self.tables[name].read(before=number)

    def batch(self, rows: DataFrame, number: int) -> None:
        began = time.monotonic()
        classified = materialise(fragments.classify(rows))
        bronze.append(bronze.bronze_rows(classified), f"{self.folder}/bronze", number)
        fragments.rejects(classified).write.mode("overwrite").parquet(f"{self.folder}/rejects/batch={number}")
        now = self._tick(classified, number)
        linked = self._linked(fragments.usable(classified).select(*FRAGMENT), number, now)
        chunked = materialise(linking.with_chunk(linked, self.lifetime, self.least))
        folded = materialise(linking.fold(chunked))
        persisting = time.monotonic()
        if not folded.isEmpty() or self._before("persons", number) is None:  # else the last snapshot stands
            persons = upsert.upsert(folded, self._before("persons", number))
            self.tables["persons"].write(persons, number)
            self._log(folded, number)
        persisted = time.monotonic() - persisting
        self._carry(chunked, number, now)
        for table in self.tables.values():
            table.prune(KEPT)
        if self.metrics:
            self.metrics.observe("persist_seconds", persisted)
            self._measure(classified, folded, number, time.monotonic() - began)

    def _tick(self, classified: DataFrame, number: int) -> float | None:
        """The clock after this batch, in seconds, which is kept under the batch's number."""
        latest = classified.agg(F.max(F.unix_micros("ts") / 1_000_000)).first()[0]
        before = self._before("clock", number)
        times = [t for t in (latest, before.first()[0] if before is not None else None) if t is not None]
        now = max(times, default=None)
        self.tables["clock"].write(self.spark.createDataFrame([(now,)], "now double"), number)
        return now

    def _alive(self, ts, now: float | None, seconds: float):
        """Whether a message after now, but for lateness, can still fall within so many seconds of ts."""
        return F.lit(True) if now is None else now - self.lateness - F.unix_micros(ts) / 1_000_000 < seconds

    def _measure(self, classified: DataFrame, folded: DataFrame, number: int, seconds: float) -> None:
        for kind, n in bronze.counts(bronze.bronze_rows(classified)).collect():  # six kinds
            self.metrics.count("messages_consumed", n, f'fragment_type="{kind}"')
        self.metrics.count("messages_failed", fragments.rejects(classified).count())
        consolidated = folded.count()
        self.metrics.count("consolidations", consolidated)
        self.metrics.count("persons_persisted", consolidated)
        self.metrics.gauge("pending_fragments", self.tables["pending"].read(before=number + 1).count())
        self.metrics.observe("processing_seconds", seconds)

    def _linked(self, new: DataFrame, number: int, now: float | None) -> DataFrame:
        """New fragments with their buffer keys, and pending ones, which have theirs; and the names' registrations for the next batch."""
        known = self._before("aliases", number)
        rows = new
        if known is not None:  # a registration is a fragment again for the lookup, but for nothing else
            blank = {c: F.lit(None).cast(new.schema[c].dataType) for c in ("value", "message")}
            old = known.withColumns(blank | {"fragment_type": F.lit("personal")}).select(*FRAGMENT)
            rows = new.unionByName(old)
        keyed = materialise(linking.with_buffer_key(rows, self.lifetime))
        registers = (F.col("fragment_type") == "personal") & F.col("match_key").startswith("passport:") & (F.col("name") != "")
        last = keyed.where(registers).groupBy("name").agg(F.max_by(F.struct("seq", "ts", "match_key"), "seq").alias("x"))
        last = last.where(self._alive(F.col("x.ts"), now, linking.ALIAS_LIVES * self.lifetime))
        self.tables["aliases"].write(last.select("x.seq", "x.ts", "name", "x.match_key"), number)
        fresh = keyed.where("message is not null")
        pending = self._before("pending", number)
        return fresh if pending is None else fresh.unionByName(pending)

    def _carry(self, chunked: DataFrame, number: int, now: float | None) -> None:
        """What has not fired and may yet: the fragments of each buffer's last life, unless that has lapsed."""
        waiting = chunked.where("not fired")
        last = chunked.groupBy("buffer_key").agg(F.max("life").alias("last"), F.max_by("ts", "seq").alias("latest"))
        kept = waiting.join(last, "buffer_key").where("life = last").where(self._alive(F.col("latest"), now, self.lifetime))
        self.tables["pending"].write(kept.select(*FRAGMENT, "buffer_key"), number)

    def _log(self, folded: DataFrame, number: int) -> None:
        """Each person's fragments of its last firing: this batch's replace those before."""
        persons = self.tables["persons"].read(before=number + 1)
        log = upsert.fragment_log(folded, persons)
        before = self._before("fragment_log", number)
        if before is not None:
            log = before.join(log.select("person_id").distinct(), "person_id", "left_anti").unionByName(log)
        self.tables["fragment_log"].write(log, number)

    def persons(self) -> DataFrame | None:
        return self.tables["persons"].read()


