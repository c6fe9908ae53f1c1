"""How operators name rows, pick columns and send models.

Rows of a document table are named by (doc_id, tag): the tag is the 128-bit MD5 of the text,
so repeated rows get the same spans and rows that share a doc_id with different texts get
their own, however many there are.  A null doc_id counts as the greatest one.
"""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The key that stands for a null doc_id: the greatest.
NULL_ID = (1 << 63) - 1


def sent(spark: SparkSession, value) -> Broadcast:
    """A broadcast of something whose class executors need not have; received() takes it out.  Callers bound its size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast: Broadcast):
    return pickle.loads(broadcast.value)


#: Bytes of an Arrow batch on its way to Python, at most: both sides hold several.
BATCH_BYTES = 8 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by BATCH_BYTES where Spark's own bound was left as it is."""
    if spark.conf.get(_BATCH) == _DEFAULT:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def picked(docs: DataFrame, **names: str) -> DataFrame:
    """Just the columns wanted, under new names: new=old.  Found by their exact names and by place, so no other column of ``docs`` can clash.

    Also bounds the session's Arrow batches: bound_batches().
    """
    bound_batches(docs.sparkSession)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.select(*(F.col(f"c{docs.columns.index(old)}").alias(new) for new, old in names.items()))


def tag_of(text: Column) -> Column:
    """The tag of a text: 16 bytes, none for null, so that tags never are null."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, id, tag, text; nothing else of ``docs`` is read."""
    text = F.col("text").cast("string")
    return picked(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"),
        tag_of(text).alias("tag"),
        text.alias("text"),
    )
