"""Quality rules: base measures and an n-gram perplexity band for each language.

The language model is a modified Kneser-Ney model of byte n-grams (``bytemodel``): Spark counts them over
every whole text that the base rules keep into sorted arrays dealt by hash, and scores all texts there.
Every language, and null as one, has a model and a band of its own, whatever its share of the corpus.

A text's perplexity is exp of the sum of -log p of its n-grams over its number of words.  The
band is about the median of its log over a language's documents that the base rules keep.  A text of n
words may lie ``width`` times spread / sqrt(n) from it, or ``least_width`` if that is more: the spread is that of one
word, estimated from the upper quartile of |log perplexity - median| * sqrt(n), so short texts, whose perplexities vary more,
have wider bands.  Quantiles come from exact counts in steps.

Edge cases: null and empty texts have zero measures and fail the base rule; a text of under five
bytes has no perplexity (null) and is judged by the base rule alone; one that a double cannot hold is infinite; repeated rows are judged alike
and each comes back; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fragloom.llm import arrays as A
from fragloom.llm import bytemodel
from fragloom.llm import spans as S
from fragloom.storage import materialise

WIDTH, LEAST_WIDTH = 6.0, 0.25
#: Steps in which log perplexities and their distances from the median are counted.
STEP, FAR_STEP = 0.002, 0.02
#: The upper quartile of the distances of a normal variable, over its standard deviation.
QUARTILE = 1.1503
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _alike(data, a, b, c, d):
    """Whether the spans a to b and c to d hold the same bytes."""
    same = b - a == d - c
    same[same] = A.same_bytes(A.big_words(data), a[same], c[same], (b - a)[same])
    return same


def _exact(text: bytes) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words of one text, by the strings themselves."""
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    words = text.translate(bytes(32 if c in BLANKS else c for c in range(256))).split(b" ")
    words = [x for x in words if x]
    windows = [tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
    often = Counter(windows)
    return len(lines) - len(set(lines)), len({i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(WINDOW)})


def measures(data, bounds):
    """The base measures of each document, as arrays by name."""
    starts, ends, word_bounds = A.words(data, bounds)
    n = len(bounds) - 1
    n_words = np.diff(word_bounds)
    points = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~A.WHITE[data])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    sums = A.prefix(A.BYTE_VALUES[data])
    # Lines: the parts between line ends and document bounds that hold a word.
    line_ends = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([bounds, line_ends, line_ends + 1]))
    holds = np.diff(np.searchsorted(starts, edges)) > 0
    a, b = edges[:-1][holds], edges[1:][holds]
    owner = np.searchsorted(bounds, a, "right") - 1
    key = A.mix(A.span_hash(sums, a, b) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    like = np.flatnonzero(key[order][1:] == key[order][:-1])
    x, y = order[like], order[like + 1]
    alike = _alike(data, a[x], b[x], a[y], b[y])
    unsure = owner[x[~alike]]
    n_dup_lines = np.bincount(owner[y], minlength=n)
    # Windows found twice or more in one document.
    hashes = A.span_hash(sums, starts, ends)
    windows = A.fixed_hash(A.prefix(hashes), WINDOW)
    place = np.flatnonzero(np.arange(len(windows)) + WINDOW <= np.repeat(word_bounds[1:], n_words)[: len(windows)])
    holder = A.owners(word_bounds)[place]
    key = A.mix(windows[place] + holder.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    like = np.flatnonzero(key[order][1:] == key[order][:-1])
    twice = np.zeros(len(place), bool)
    twice[order[like]] = twice[order[like + 1]] = True
    if len(like):
        text, at = A.compact(data, starts, ends)
        stop = at + (ends - starts)
        x, y = place[order[like]], place[order[like + 1]]
        alike = _alike(text, at[x], stop[x + WINDOW - 1], at[y], stop[y + WINDOW - 1])
        unsure = np.append(unsure, holder[order[like[~alike]]])
    repeat = A.per_document(A.covered(len(starts), place[twice], place[twice] + WINDOW), word_bounds)
    for i in np.unique(unsure):  # different lines or windows with one hash
        n_dup_lines[i], repeat[i] = _exact(data[bounds[i] : bounds[i + 1]].tobytes())
    return {
        "n_words": n_words,
        "word_chars": points[bounds[1:]] - points[bounds[:-1]],
        "n_symbols": symbols[bounds[1:]] - symbols[bounds[:-1]],
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": repeat,
    }


def _described(rows, data, bounds):
    """The base measures of a chunk's documents, as Arrow columns."""
    base = measures(data, bounds)
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * base["n_words"])
    out = {x: rows.column(x) for x in ("doc_id", "id", "tag", "lang")} | {k: pa.array(v, pa.int64()) for k, v in base.items()}
    return out | {"base_failed": pa.array(failed, pa.bool_()), "counted": pa.array(~failed, pa.bool_())}


SCORED = "doc_id bigint, id bigint, tag binary, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, surprise double"


def _quantile(name: str, share: float, step: float):
    """(lang, the value below which ``share`` of a language's counts lie) from rows lang, step, count."""

    def value(part):
        part = part.sort_values("step")
        sums = np.cumsum(part["count"].to_numpy())
        at = np.searchsorted(sums, sums[-1] * share)
        return pd.DataFrame({"lang": part["lang"].iloc[:1].to_numpy(), name: [(part["step"].to_numpy()[at] + 0.5) * step]})

    return value


def bands(scored: DataFrame) -> DataFrame:
    """of, centre, spread of each language, null as one."""
    kept = scored.where("not base_failed and log_ppl is not null")
    counts = kept.groupBy("lang", F.floor(F.col("log_ppl") / STEP).alias("step")).count()
    centre = counts.groupBy("lang").applyInPandas(_quantile("centre", 0.5, STEP), "lang string, centre double").withColumnRenamed("lang", "of")
    far = kept.join(centre, kept["lang"].eqNullSafe(centre["of"]))
    step = F.floor(F.abs(F.col("log_ppl") - F.col("centre")) * F.sqrt("n_words") / FAR_STEP)
    far = far.groupBy("lang", step.alias("step")).count()
    spread = far.groupBy("lang").applyInPandas(_quantile("spread", 0.75, FAR_STEP / QUARTILE), "lang string, spread double")
    return centre.join(spread, centre["of"].eqNullSafe(spread["lang"])).select("of", "centre", "spread")


def quality(docs: DataFrame, width: float = WIDTH, least_width: float = LEAST_WIDTH, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, id, tag, lang, the base measures, base_failed, perplexity, its band (ppl_low, ppl_high) and kept, for each document."""
    rows = S.picked(docs, doc_id=id_col, text=text_col, lang=lang_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(S.NULL_ID)).alias("id"), S.tag_of(F.col("text").cast("string")).alias("tag"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    scored = materialise(bytemodel.scored(rows, _described, SCORED)).withColumn("log_ppl", F.col("surprise") / F.greatest("n_words", F.lit(1)))
    band = materialise(bands(scored))  # written, so that its size is known when it is joined
    judged = scored.join(band, scored["lang"].eqNullSafe(band["of"]), "left")
    half = F.greatest(width * F.col("spread") / F.sqrt(F.greatest("n_words", F.lit(1))), F.lit(least_width))
    judged = judged.withColumns({"low": F.col("centre") - half, "high": F.col("centre") + half})
    inside = F.col("log_ppl").isNull() | F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(True))
    return judged.select(
        "doc_id", "id", "tag", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.exp("log_ppl").alias("perplexity"), F.exp("low").alias("ppl_low"), F.exp("high").alias("ppl_high"), (~F.col("base_failed") & inside).alias("kept"),
    )


def query(spark, sf_dir):
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("id", "tag", "lang")
