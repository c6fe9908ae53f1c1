"""The pipeline's stages against brute force, and its queries against their SQL."""

import random
import re
from collections import Counter

import corpus_pipeline as P
import pytest
from brute import decontaminate, key, line_dedup, simhash_roots, targets
from pyspark.sql import functions as F
from support import SF, rows

from fragloom.llm import quality
from fragloom.llm.oracles import ORACLES
from fragloom.llm.queries import QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def sf_dir(spark, tmp_path, made):
    text = next(r[1] for r in made if r[0] == 10)
    spark.createDataFrame([(0, text), (1, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def plain(frame):
    return [tuple(r[c] for c in COLUMNS) for r in frame.collect()]


def test_stages(spark, documents, made, sf_dir):
    stage = dict(P.STAGES)
    assert list(stage) == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
    rows_in = Counter(made)
    kept = Counter((r.doc_id, r.n_words, r.word_chars) for r in quality.quality(documents).where("kept").collect())
    out = stage["quality rules"](spark, documents, sf_dir)
    assert out.columns == documents.columns
    found = Counter(plain(out))
    assert found <= rows_in and found.total() == kept.total()

    dropped = stage["line dedup"](spark, documents, sf_dir)
    lines = line_dedup([(r[0], r[1]) for r in made])
    import hashlib

    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert Counter((r.doc_id, sha(r.text)) for r in dropped.collect()) == Counter((x[0], x[3]) for x in lines)
    assert {r.doc_id: r.n_chars for r in dropped.collect()}[53] < {r[0]: len(r[1] or "") for r in made}[53]

    named = [(r[0], r[1]) for r in made]
    group = {d: root for d, (_, root) in zip(named, simhash_roots(named), strict=True)}
    chosen = plain(stage["SimHash near-dedup"](spark, documents, sf_dir))
    assert len(chosen) == len(set(group.values())) and len({group[x[0], x[1]] for x in chosen}) == len(chosen)
    least = {root: min(key(i) for i, t in named if group[i, t] == root) for root in group.values()}
    assert all(key(x[0]) == least[group[x[0], x[1]]] for x in chosen)

    item = [(0, next(r[1] for r in made if r[0] == 10)), (1, None)]
    clean = [r for r, x in zip(made, decontaminate([(r[0], r[1]) for r in made], item), strict=True) if not x[5]]
    assert Counter(plain(stage["benchmark decontamination"](spark, documents, sf_dir))) == Counter(clean) and len(clean) < len(made)

    mixed = stage["mixing sources to target weights"](spark, documents, sf_dir)
    assert Counter(plain(mixed)) == rows_in
    sizes = Counter()
    for r in made:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    goal = targets(sizes)
    assert all(r.target == pytest.approx(goal[r.source]) and r.taken <= 3 * r["size"] for r in mixed.collect())


def test_stages_of_nothing(spark, nothing, sf_dir):
    for _, stage in P.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0


def test_run(spark, sf_dir):
    out = P.run(spark, sf_dir)
    assert out.columns == [*COLUMNS, "size", "source_size", "target", "taken"]
    assert 0 < out.count() < 90


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, tables, name):
    found, expected = QUERIES[name](spark, SF).toPandas(), tables.sql(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


def test_queries_without_sql(spark):
    """Their brute-force comparisons are in test_operators; here, that they run over whole tables and have the contract's columns."""
    columns = {
        "op1_token_counts": {"doc_id", "n_tokens"},
        "op2_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op3_mixing": {"doc_id", "size", "source_size", "target", "taken"},
        "op4_language_id": {"doc_id", "held_out", "lang_pred", "score"},
        "op5_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        "op6_simhash_dedup": {"doc_id", "fingerprint", "component_id"},
    }
    assert set(columns) == set(QUERIES) - set(ORACLES)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, expected in columns.items():
        out = QUERIES[name](spark, SF)
        assert expected <= set(out.columns) and out.count() == n


def test_many_rows_without_id_stay_apart(spark, sf_dir):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(2500)]
    docs = spark.createDataFrame([(None, t, "en", "web", len(t)) for t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint").cache()
    stage = dict(P.STAGES)
    assert {r.text for r in stage["SimHash near-dedup"](spark, docs, sf_dir).collect()} == set(texts)
    half = docs.where(F.col("text").isin(texts[:1250]))
    assert Counter(plain(P._only(docs, P.keyed(half)))) == Counter(plain(half))


def test_rows_of_one_id_are_copies_by_text_alone(spark, sf_dir):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(2500)]
    rows = [(7, t, "en", "web", len(t)) for t in texts] + [(8, texts[0], "en", "web", 1), (6, texts[1], "en", "web", 1), (7, texts[2], "en", "web", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = dict(P.STAGES)["SimHash near-dedup"](spark, docs, sf_dir).collect()
    assert Counter(r.text for r in kept) == Counter(texts) and {r.doc_id for r in kept if r.text == texts[1]} == {6}
