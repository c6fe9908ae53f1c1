"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept, and calls
one operator of ``fragloom.llm``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fragloom.llm import decontamination, line_dedup, mixing, quality, simhash
from fragloom.llm.spans import NULL_ID, keyed, tag_of
from fragloom.storage import materialise


class _Rows:
    """The rows of a table with _id and _tag, the names that operators give to rows; its own columns stand under their places, so none can clash."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        plain = docs.toDF(*(f"c{i}" for i in range(len(self.names))))
        tag = tag_of(plain[self.place("text")].cast("string"))
        self.frame = plain.withColumns({"_id": F.coalesce(plain[self.place("doc_id")].cast("bigint"), F.lit(NULL_ID)), "_tag": tag})

    def place(self, name: str) -> str:
        return f"c{self.names.index(name)}"

    def restored(self, frame: DataFrame) -> DataFrame:
        return frame.select(*(f"c{i}" for i in range(len(self.names)))).toDF(*self.names)


def _only(docs: DataFrame, kept: DataFrame, *also: str) -> DataFrame:
    """The rows of docs that kept (id, tag) names, with the same strings in the columns ``also`` of both."""
    rows = _Rows(docs)
    names = kept.select(F.col("id").alias("k_id"), F.col("tag").alias("k_tag"), *(F.col(x).alias(f"k_{x}") for x in also))
    same = (F.col("_id") == F.col("k_id")) & (F.col("_tag") == F.col("k_tag"))
    for x in also:
        same &= F.col(rows.place(x)).cast("string").eqNullSafe(F.col(f"k_{x}"))
    return rows.restored(rows.frame.join(names, same, "left_semi"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rows that differ in language alone are judged apart."""
    return _only(docs, quality.quality(docs).where("kept"), "lang")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars follows the text.  A row that loses nothing stays as it is."""
    gone = line_dedup.dropped_lines(keyed(docs)).select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), F.col("gone").alias("_gone"))
    rows = _Rows(docs)
    text, lost = rows.place("text"), F.col("_gone").isNotNull()
    joined = rows.frame.join(gone, ["_id", "_tag"], "left").withColumn(text, F.when(lost, line_dedup.without_lines(F.col(text), F.col("_gone"))).otherwise(F.col(text)))
    if "n_chars" in rows.names:
        chars = rows.place("n_chars")
        joined = joined.withColumn(chars, F.when(lost, F.length(text).cast("bigint")).otherwise(F.col(chars)))
    return rows.restored(joined)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least doc_id, of each group of near copies."""
    found = simhash.near_duplicates(docs)
    # Groups go by the fingerprint that names their component: rows that share a doc_id need not be copies.
    first = found.groupBy("group").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "tag")).alias("first"))
    kept = first.select(F.col("first.id").alias("_id"), F.col("first.tag").alias("_tag"))
    rows = _Rows(docs)
    # Of repeated rows one stays.
    return rows.restored(rows.frame.join(kept, ["_id", "_tag"], "left_semi").dropDuplicates(["_id", "_tag"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of any benchmark window."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ADDED = ["size", "source_size", "target", "taken"]


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ADDED: their size and their source's size and target in words, and the words of each that the mix takes, repeats counted.

    A column of docs with one of these names is replaced.
    """
    mixed = mixing.mix(docs).documents
    key = lambda column: F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("")).alias("_source")
    # Repeated rows share a key: each gets one of the numbers taken for it.
    named = mixed.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.col("tag").alias("_tag"), key(F.col("source")), *(F.col(x).alias(f"_{x}") for x in ADDED))
    taken = named.groupBy("_id", "_tag", "_source", "_size", "_source_size", "_target").agg(F.sort_array(F.collect_list("_taken")).alias("_taken"))
    docs = docs.select(*(docs[x] for x in docs.columns if x.lower() not in ADDED))
    rows = _Rows(docs)
    turn = F.row_number().over(Window.partitionBy("_id", "_tag", "_source").orderBy("_id"))
    joined = rows.frame.withColumn("_source", key(F.col(rows.place("source")))).join(taken, ["_id", "_tag", "_source"]).withColumn("_taken", F.element_at("_taken", turn))
    return joined.select(*(f"c{i}" for i in range(len(rows.names))), *(f"_{x}" for x in ADDED)).toDF(*rows.names, *ADDED)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
]

#: Perplexity, SimHash and the mix's permutations are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each cut off from its lineage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
