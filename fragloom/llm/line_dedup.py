"""Line dedup over levelled sorted runs of line hashes.  DataFrame operations only.

``LineRuns`` keeps what is known of lines as runs of (hash, n_docs, last): tables bucketed and sorted by hash in
the shared folder, so that a merge join reads a run as it lies.  A new batch is merge-anti-joined with the runs.  Its fresh
lines enter with the batch's counts.  Its known lines are merge-joined with the runs that hold them and enter with all that was
counted before added: a hash may stand in several runs, and its greatest count is the one that holds.  Both
are the batch's own run, at level 0.  ``fanout`` runs of one level are compacted into one of the next, where of each hash the greatest
count stays; so a line is rewritten a logarithmic number of times and a batch meets few runs.  A folder can be opened
again, by another session too, and goes on from its runs.

``line_dedup`` feeds all documents through the runs in ``batches`` parts dealt by doc_id, then
drops lines whose key is at least ``least_chars`` long and stands in at least ``least_docs``
documents, except in the greatest doc_id that holds it.  Lines are told apart by the 128-bit MD5
of their key.  A key is reduced to (hash, document) pairs and then to one row before it is
shuffled by hash alone, so a line that very many documents share is no hot group.

Edge cases: a null or empty text is one empty line, which stays; repeated rows (same doc_id) hold
a line once; a null doc_id counts as the greatest; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fragloom.llm import spans as S
from fragloom.storage import materialise, prepare

#: What is stripped at both ends of a line, and letters that are lower-cased.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROW = "hash binary, n_docs bigint, last bigint"
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class LineRuns:
    """Levelled runs: ``levels[i]`` holds fewer than ``fanout`` runs, each the number of a table of (hash, n_docs, last), bucketed and sorted by hash.

    A run's folder tells its level, number and buckets; it counts once its writer has left the _SUCCESS file.  A batch is
    a set of whole documents that no earlier batch held: hash, n_docs, last, each hash once.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = 3):
        prepare(spark)
        self.spark, self.fanout, self.own = spark, fanout, folder is None
        self.folder = (folder or f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/runs-{uuid.uuid4().hex}").rstrip("/")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[int]] = []
        self.tables: dict[int, str] = {}
        self.next = 0
        for level, number, buckets in self._stored():
            self.buckets, self.next = buckets, max(self.next, number + 1)
            self._level(level).append(number)
            self._named(number, self._path(level, number, buckets))

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _path(self, level: int, number: int, buckets: int) -> str:
        return f"{self.folder}/level{level}-run{number}-of{buckets}"

    def _stored(self) -> list[tuple[int, int, int]]:
        """Level, number and buckets of the complete runs in the folder, oldest first."""
        fs, root = self._fs(self.folder)
        names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
        found = [tuple(map(int, m.groups())) for m in (re.fullmatch(r"level(\d+)-run(\d+)-of(\d+)", x) for x in names) if m]
        return sorted((x for x in found if fs.exists(self._fs(f"{self._path(*x)}/_SUCCESS")[1])), key=lambda x: x[1])

    def _level(self, level: int) -> list[int]:
        while len(self.levels) <= level:
            self.levels.append([])
        return self.levels[level]

    def _named(self, number: int, path: str) -> None:
        """Tell the catalogue of a run that the folder holds."""
        self.tables[number] = f"line_run_{uuid.uuid4().hex}"
        self.spark.sql(f"create table {self.tables[number]} ({ROW}) using parquet clustered by (hash) sorted by (hash) into {self.buckets} buckets location '{path}'")

    @contextmanager
    def _sorted_scans(self):
        """Within, scans of runs are known to be sorted."""
        before = self.spark.conf.get(_ORDERED)
        self.spark.conf.set(_ORDERED, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_ORDERED, before)

    @property
    def runs(self) -> list[DataFrame]:
        return [self.spark.table(self.tables[number]) for level in self.levels for number in level]

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The rows of batch whose hash no run holds: a merge anti-join with each run."""
        for run in self.runs:
            batch = batch.join(run.select("hash").hint("merge"), "hash", "left_anti")
        return batch

    def known(self, batch: DataFrame) -> DataFrame | None:
        """The rows of batch whose hash some run holds, what was counted before added: a merge join with each run."""
        befores = []
        for i, run in enumerate(self.runs):
            run = run.select("hash", F.struct("n_docs", "last").alias(f"before{i}")).hint("merge")
            batch = batch.join(run, "hash", "left")
            befores.append(F.col(f"before{i}"))
        if not befores:
            return None
        n_docs, last = (F.greatest(*(x[name] for x in befores)) if len(befores) > 1 else befores[0][name] for name in ("n_docs", "last"))
        met = batch.where(F.coalesce(*befores).isNotNull())
        return met.select("hash", (F.col("n_docs") + n_docs).alias("n_docs"), F.greatest("last", last).alias("last"))

    def add(self, batch: DataFrame) -> None:
        """Put the batch in as a run of its own; compact levels that are full."""
        with self._sorted_scans():
            fresh, known = self.fresh(batch), self.known(batch)
            self._put(0, fresh if known is None else fresh.unionByName(known))

    def _put(self, level: int, run: DataFrame) -> None:
        number, path = self.next, self._path(level, self.next, self.buckets)
        self.next += 1
        self.tables[number] = f"line_run_{uuid.uuid4().hex}"
        run = run.select("hash", "n_docs", "last").repartition(self.buckets, "hash")  # a bucket is one file
        run.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash").option("path", path).saveAsTable(self.tables[number])
        here = self._level(level)
        here.append(number)
        if len(here) >= self.fanout:
            old, self.levels[level] = list(here), []
            self._put(level + 1, self._greatest([(level, x) for x in old]))
            for x in old:  # only now: whoever opens the folder meanwhile finds counts twice, and the greatest holds
                self._drop(level, x)

    def _drop(self, level: int, number: int) -> None:
        self.spark.sql(f"drop table if exists {self.tables.pop(number)}")
        fs, path = self._fs(self._path(level, number, self.buckets))
        fs.delete(path, True)

    def _greatest(self, runs: list[tuple[int, int]]) -> DataFrame:
        """Of each hash the greatest count that runs (level, number) hold.  They are read as plain files: an aggregation over
        a union of bucketed scans may be planned without an exchange and then lose the buckets, and join nothing up."""
        every = reduce(DataFrame.unionByName, [self.spark.read.schema(ROW).parquet(self._path(*x, self.buckets)) for x in runs])
        return every.groupBy("hash").agg(F.max("n_docs").alias("n_docs"), F.max("last").alias("last"))

    def totals(self) -> DataFrame:
        """hash, n_docs, last of all lines."""
        runs = [(level, number) for level, numbers in enumerate(self.levels) for number in numbers]
        return self._greatest(runs) if runs else self.spark.createDataFrame([], ROW)

    def close(self) -> None:
        """Forget the tables; the runs stay in a folder that was given and go with one that was not."""
        for level, numbers in enumerate(self.levels):
            for number in numbers:
                if self.own:
                    self._drop(level, number)
                else:
                    self.spark.sql(f"drop table if exists {self.tables.pop(number)}")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Stripped at both ends, A-Z lower-cased: for ASCII by the faster function."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(line) == F.length(line), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_hashes(rows: DataFrame, least_chars: int) -> DataFrame:
    """id, tag, pos, hash of all lines whose key is long enough.  rows: spans.keyed()."""
    lines = rows.select("id", "tag", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    lines = lines.where(F.length("line") >= least_chars).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= least_chars)
    return lines.select("id", "tag", "pos", F.unhex(F.md5("key")).alias("hash"))


def batch_lines(lines: DataFrame) -> DataFrame:
    """hash, n_docs, last: the lines of a batch of whole documents."""
    return lines.select("hash", "id").distinct().groupBy("hash").agg(F.count("*").alias("n_docs"), F.max("id").alias("last"))


def dropped_lines(rows: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int = 4, fanout: int = 3, runs: LineRuns | None = None) -> DataFrame:
    """id, tag, gone: places of the lines that each document loses.  With ``runs``, documents that were fed to them before count too, and those of rows are added."""
    lines = materialise(line_hashes(rows, least_chars))
    held = runs or LineRuns(rows.sparkSession, fanout=fanout)
    for i in range(batches):
        held.add(batch_lines(lines.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == i)))
    # Written, so that the join below shuffles for itself: AQE may then split a line that very many documents hold.
    often = materialise(held.totals().where(F.col("n_docs") >= least_docs).select("hash", "last"))
    if runs is None:
        held.close()
    gone = lines.join(often, "hash").where(F.col("id") != F.col("last"))
    return gone.groupBy("id", "tag").agg(F.collect_set("pos").alias("gone"))


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at the places ``gone``.  The lines are bound by an array of one, so a text is split once, not for each line."""

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return F.get(F.transform(F.array(lines_of(text)), rest), F.lit(0))


def line_dedup(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int = 4, fanout: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, id, tag, n_lines, n_dropped, kept_text: each document without the lines that it loses."""
    rows = S.keyed(docs, id_col, text_col)
    gone = dropped_lines(rows, least_chars, least_docs, batches, fanout)
    joined = rows.join(gone, ["id", "tag"], "left")
    n_lines = F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))), F.lit(0)) + 1
    kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(without_lines(F.col("text"), F.col("gone")))
    dropped = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))
    return joined.select("doc_id", "id", "tag", n_lines.cast("bigint").alias("n_lines"), dropped.cast("bigint").alias("n_dropped"), kept.alias("kept_text"))


def query(spark, sf_dir):
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with doc as (select doc_id, string_split(coalesce(text, ''), chr(10)) as w from documents),
line as (select doc_id, unnest(w) as line, unnest(range(1, len(w) + 1)) as j from doc),
keyed as (select doc_id, line, j, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from line),
often as (select key, max(doc_id) as last from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
kept as (select doc_id, string_agg(line, chr(10) order by j) as kept, count(*) as n from (select k.* from keyed k left join often o on k.key = o.key where o.key is null or k.doc_id = o.last) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_lines, cast(len(w) - coalesce(n, 0) as bigint) as n_dropped, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (doc_id)
"""
