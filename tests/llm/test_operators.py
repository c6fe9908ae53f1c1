"""Each operator against brute force over awkward rows, and over no rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import base_measures, decontaminate, greedy_pieces, line_dedup, maximal_chats, simhash, substring_dedup, suffix_dedup, targets, with_clashes
from pyspark.sql import functions as F

from fragloom.llm import arrays as A
from fragloom.llm import blobs, bytemodel, chat, decontamination, langid, line_dedup as lines, mixing, quality, simhash as prints, spans, substring_dedup as words, suffix_dedup as suffixes, superkmer, token_counts


def same(frame, expected, columns):
    found = [tuple(row[c] for c in columns) for row in frame.select(*columns).collect()]
    assert Counter(found) == Counter(expected)


def pairs(made):
    return [(row[0], row[1]) for row in made]


@pytest.mark.parametrize("parts,hot", [(1, None), (6, None), (6, 3)])
def test_substring_dedup(documents, made, parts, hot):
    out = words.substring_dedup(documents, parts=parts, hot=hot)
    same(out, substring_dedup(pairs(made)), ["doc_id", "n_words", "n_removed", "kept_sha256"])
    assert {r.doc_id: r.kept_text for r in out.collect()}[63] == "A b c"


@pytest.mark.parametrize("parts,hot", [(1, None), (6, None), (6, 3)])
def test_suffix_dedup(documents, made, parts, hot):
    out = suffixes.suffix_dedup(documents, parts=parts, hot=hot)
    same(out, suffix_dedup(pairs(made)), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    assert {r.doc_id: bytes(r.kept_bytes) for r in out.collect()}[68] == b"x"


def test_column_wise_build_equals_sorting():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 30))).encode() for _ in range(40)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array([len(t) for t in texts])
    string, left, lcp = suffixes.build(data, np.cumsum(length) - length, length, 8)
    expected = sorted((t[len(t) - n :], i, n) for i, t in enumerate(texts) for n in range(len(t) + 1))
    assert [(texts[s][len(texts[s]) - n :]) for s, n in zip(string, left, strict=True)] == [x[0] for x in expected]
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    suffix = [x[0] for x in expected]
    assert lcp[1:].tolist() == [min(8, common(a, b)) for a, b in zip(suffix[:-1], suffix[1:], strict=True)]


def test_simhash(documents, made):
    same(prints.near_duplicates(documents), simhash(pairs(made)), ["doc_id", "fingerprint", "component_id"])


def test_simhash_chains_and_tiles(spark):
    rng, base = random.Random(5), 0x0123456789ABCDEF
    values = {base}
    for _ in range(300):
        value = rng.choice(sorted(values))
        for _ in range(rng.randint(1, 4)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    classes = spark.createDataFrame([(signed(v), i % 50) for i, v in enumerate(sorted(values))], "print bigint, id bigint")
    expected = {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    for tile in (2048, 8):  # with small tiles every block is dealt out
        found = prints.links(classes, tile=tile).collect()
        root = {signed(v): signed(v) for v in values}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for row in found:
            root[find(row.u.print)] = find(row.v.print)
        assert all(find(signed(a)) == find(signed(b)) for a, b in map(tuple, expected))
        linked = {frozenset((row.u.print, row.v.print)) for row in found}
        whole = {signed(v): signed(v) for v in values}
        for a, b in map(tuple, expected):
            whole[find(signed(a), whole)] = find(signed(b), whole)
        assert all(find(a, whole) == find(b, whole) for a, b in map(tuple, linked))


def test_decontamination(spark, documents, made):
    rng = random.Random(11)
    text = [r[1] for r in made if r[1] and len(r[1].split()) > 40]
    items = [(i, " ".join(rng.choice(text).split()[5 : 5 + rng.randint(3, 30)])) for i in range(25)] + [(25, "b"), (26, None), (27, "!!"), (None, "na na"), (3, text[0][:80]), (3, text[1][:90]), (28, "12 34")]
    benchmark = with_clashes(spark, items, "item_id bigint, text string")
    expected = decontaminate(pairs(made), items)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same(decontamination.decontaminate(documents, benchmark), expected, columns)
    same(decontamination.decontaminate(documents, benchmark, pass_bytes=400), expected, columns)
    same(decontamination.decontaminate(documents, benchmark.limit(0)), decontaminate(pairs(made), []), columns)
    clean = [(row[0], row[1], 7) for row, x in zip(made, expected, strict=True) if not x[5]]
    for size in (decontamination.PASS_BYTES, 400):
        same(decontamination.clean_documents(documents, benchmark, pass_bytes=size), clean, ["doc_id", "text", "part"])


def test_line_dedup(documents, made):
    for batches, fanout in ((1, 2), (5, 2)):
        out = lines.line_dedup(documents, batches=batches, fanout=fanout).selectExpr("doc_id", "n_lines", "n_dropped", "sha2(cast(kept_text as binary), 256) as kept_sha256")
        same(out, line_dedup(pairs(made)), ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def _batch(spark, *names):
    return spark.createDataFrame([(bytes(n, "ascii"), 1, i) for i, n in enumerate(names)], "hash binary, n_docs bigint, last bigint").groupBy("hash").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))


def test_line_runs(spark, tmp_path):
    runs, seen = lines.LineRuns(spark, str(tmp_path / "runs"), fanout=2), Counter()
    for names in (("a", "b"), ("b", "c"), ("a", "d"), ("d", "e", "b"), ("f",)):
        batch = _batch(spark, *names)
        assert {bytes(r.hash).decode() for r in runs.fresh(batch).collect()} == set(names) - set(seen)
        known = runs.known(batch)
        seen.update(names)
        assert {bytes(r.hash).decode(): r.n_docs for r in known.collect()} == {n: seen[n] for n in names if seen[n] > 1} if known else len(runs.runs) == 0
        runs.add(batch)
        assert all(len(level) < 2 for level in runs.levels)
    assert {bytes(r.hash).decode(): r.n_docs for r in runs.totals().collect()} == seen
    runs.close()
    # Another opens the folder and goes on.
    again = lines.LineRuns(spark, str(tmp_path / "runs"), fanout=2)
    again.add(_batch(spark, "a", "g"))
    assert {bytes(r.hash).decode(): r.n_docs for r in again.totals().collect()} == seen + Counter("ag")
    assert {bytes(r.hash).decode(): r.last for r in again.totals().collect()} == {"a": 0, "b": 2, "c": 1, "d": 1, "e": 1, "f": 0, "g": 1}
    with again._sorted_scans():
        plan = again.fresh(_batch(spark, "a"))._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.count("Exchange hashpartitioning(hash") == 1 and "SortMergeJoin" in plan
    again.close()


@pytest.mark.parametrize("broken", ["none", "all"])
def test_verdicts_come_from_the_anti_join(spark, made, documents, monkeypatch, broken):
    monkeypatch.setattr(lines.LineRuns, "fresh", lambda self, batch: batch.limit(0) if broken == "none" else batch)
    if broken == "all":
        monkeypatch.setattr(lines.LineRuns, "known", lambda self, batch: None)
    found = Counter((r.doc_id, r.n_dropped) for r in lines.line_dedup(documents).collect())
    assert found != Counter((x[0], x[2]) for x in line_dedup(pairs(made)))


def test_line_dedup_goes_on_from_stored_runs(spark, tmp_path):
    line = "a line that is certainly long enough to be told from others"
    docs = lambda ids: spans.keyed(spark.createDataFrame([(i, f"{line}\nown {i}") for i in ids], "doc_id bigint, text string"))
    runs = lines.LineRuns(spark, str(tmp_path / "runs"))
    assert lines.dropped_lines(docs(range(3)), runs=runs).count() == 0
    assert sorted(r.id for r in lines.dropped_lines(docs(range(3, 7)), runs=runs).collect()) == [3, 4, 5]


def test_quality(documents, made):
    """Base measures, perplexities, bands and verdicts from their definitions."""
    out = quality.quality(documents)
    expected = [(i, *base_measures(t)) for i, t in pairs(made)]
    same(out, expected, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"])
    docs = [(r[2], r[1] or "", base_measures(r[1])) for r in made]
    logs = [s and s / max(1, base[0]) for s, (_, _, base) in zip(slow_surprises([(x, t, not base[5]) for x, t, base in docs]), docs, strict=True)]
    kept = Counter((i, base[0], verdict) for (i, *_), (_, _, base), verdict in zip(made, docs, slow_verdicts(docs, logs), strict=True))
    assert Counter((r.doc_id, r.n_words, r.kept) for r in out.collect()) == kept
    found = sorted((r.n_words, np.log(r.perplexity)) for r in out.collect() if r.perplexity and r.perplexity < np.inf)
    assert np.allclose(found, sorted((base[0], v) for v, (_, _, base) in zip(logs, docs, strict=True) if v is not None and v < 700), rtol=2e-3)


def slow_surprises(docs, order=5):
    """Sum of -log p over each text's grams, by its language's model of the other fold, straight from the definition.  docs: lang, text, whether it is counted."""
    import math

    def grams(text):
        data = bytes(32 if c in b" \t\n\x0b\x0c\r" else c + 32 if 65 <= c < 91 else c for c in text.encode())
        return [data[i : i + order] for i in range(len(data) - order + 1)]

    def fold(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return int(bytemodel.folds(bytemodel.PLAIN[data], np.array([0, len(data)]))[0])

    out = []
    models = {}
    for lang, f in {(x, f) for x, _, _ in docs for f in (0, 1)}:
        counts = [Counter(g for x, t, counted in docs if x == lang and counted and fold(t) == f for g in grams(t))]
        for _ in range(order - 1):
            counts.append(Counter(g[1:] for g in counts[-1]))
        contexts = [{} for _ in counts]
        for c, by in zip(counts, contexts, strict=True):
            for g, n in c.items():
                by.setdefault(g[:-1], []).append(n)
        models[lang, f] = counts, contexts, [bytemodel.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]) for c in counts]

    def p(model, level, gram):
        if level == order:
            return 1 / 256
        below, (counts, contexts, d) = p(model, level + 1, gram[1:]), model
        own = contexts[level].get(gram[:-1])
        if not own:
            return below
        n = counts[level][gram]
        return (n - d[level][min(n, 3)] + sum(d[level][min(v, 3)] for v in own) * below) / sum(own)

    for lang, text, _ in docs:
        g = grams(text)
        out.append(-sum(math.log(p(models[lang, 1 - fold(text)], 0, x)) for x in g) if g else None)
    return out


def slow_verdicts(docs, logs):
    """docs: lang, text, base measures."""
    kept = []
    for (lang, _, base), log in zip(docs, logs, strict=True):
        own = [(v, b[0]) for (x, _, b), v in zip(docs, logs, strict=True) if x == lang and v is not None and not b[5]]
        if base[5] or log is None or not own:
            kept.append(not base[5])
            continue
        rank = lambda values, share: sorted(values)[max(0, int(np.ceil(share * len(values))) - 1)]
        centre = rank([v for v, _ in own], 0.5)
        spread = rank([abs(v - centre) * n**0.5 for v, n in own], 0.75) / quality.QUARTILE
        kept.append(abs(log - centre) <= max(quality.WIDTH * spread / base[0] ** 0.5, quality.LEAST_WIDTH))
    return kept


def test_byte_model_is_the_definition(spark):
    rng = random.Random(8)
    docs = [(rng.choice(["en", "de", None]), " ".join(rng.choice(["a", "B", "c", "dd", "é", f"x{rng.randrange(9)}"]) for _ in range(rng.randint(1, 40)))) for _ in range(60)]
    docs += docs[:5]
    frame = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(docs)], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.perplexity for r in quality.quality(frame.repartition(3)).collect()}
    expected = slow_surprises([(x, t, not base_measures(t)[5]) for x, t in docs])
    for i, value in enumerate(expected):
        n = len(docs[i][1].split())
        assert (found[i] is None) == (value is None) and (value is None or np.log(found[i]) == pytest.approx(value / n, rel=2e-3, abs=2e-3))


def test_lines_and_windows_of_one_hash():
    """Thue-Morse strings share a polynomial hash modulo 2**64, but are different."""
    word = lambda flip: "".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(2048))
    texts = [f"{word(0)}\n{word(1)}", " ".join([word(0), *"abcdefgh", word(1), *"bcdefgh", *["x"] * 9]), "one two\none two\n \n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    found = quality.measures(data, np.cumsum([0, *map(len, texts)]))
    for i, t in enumerate(texts):
        expected = base_measures(t)
        assert (found["n_words"][i], found["n_dup_lines"][i], found["n_repeat_words"][i]) == (expected[0], expected[3], expected[4])


def test_perplexity_rejects_another_language(spark):
    rng = random.Random(4)
    make = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    en, de = ["the", "thing", "other", "there", "then", "with"], ["schlich", "ungsch", "keit", "zug", "auch", "pfund"]
    rows = [(i, make(en, 60), "en") for i in range(60)] + [(100 + i, make(de, 60), "de") for i in range(40)] + [(200, make(de, 60), "en"), (201, "zq zx qq " * 30 + make(en, 40), "en")]
    out = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not out[200] and all(out[i] for i in [*range(60), *range(100, 140)])


def test_small_languages_have_bands_of_their_own(spark):
    rng = random.Random(9)
    make = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    words = {f"l{i}": [f"{c}{i}" for c in "abcdefgh"[: 6 + i % 3]] for i in range(24)}
    rows = [(100 * i + j, make(words[x], 60), x) for i, x in enumerate(words) for j in range(20)]
    rows += [(9000 + i, make(words[f"l{(i + 1) % 24}"], 60), x) for i, x in enumerate(words)]
    out = quality.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert out.select("lang", "ppl_low", "ppl_high").distinct().count() == 24
    assert {r.doc_id for r in out.where("not kept").collect()} == set(range(9000, 9024))


def test_word_order_and_rare_words_raise_perplexity(spark):
    rng = random.Random(10)
    pick = lambda words: rng.choice(words.split())
    sentence = lambda: f"the {pick('big old red odd wet')} {pick('cat dog man cow owl')} {pick('saw met bit fed hid')} a {pick('tin new hot raw shy')} {pick('hat box pan jug bag')}"
    text = lambda: " ".join(sentence() for _ in range(12))
    mixed = text().split()
    rng.shuffle(mixed)
    rows = [(i, text(), "en") for i in range(80)] + [(100, " ".join(mixed), "en"), (101, " ".join("".join(rng.sample(w, len(w))) for w in text().split()), "en")]
    out = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not out[100].kept and not out[101].kept and all(out[i].kept for i in range(80))


def test_token_counts(documents, made):
    vocabulary = {w.encode() for w in (" a", " ab", "abc", "bc", "c", " abcd", "cd", "na", " na", "é")} | {bytes([i]) for i in range(256)}
    import re

    found = re.compile(rb"[^\x20\x09-\x0D]+")
    expected = []
    for i, t in pairs(made):
        w = found.findall((t or "").encode())
        expected.append((i, len((t or "").encode()), len(w), sum(greedy_pieces(x, vocabulary) for x in w)))
    same(token_counts.token_counts(documents, list(vocabulary)), expected, ["doc_id", "n_bytes", "n_words", "n_tokens"])


def test_automaton_equals_greedy_on_random_vocabularies():
    rng = random.Random(9)
    for _ in range(40):
        vocabulary = {bytes(rng.choice(b" ab") for _ in range(rng.randint(1, 6))) for _ in range(12)} | {bytes([i]) for i in range(256)}
        automaton = token_counts.Automaton(vocabulary)
        tried = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 90))) for _ in range(30)]
        data = np.frombuffer(b"".join(tried), np.uint8)
        length = np.array([len(w) for w in tried])
        assert automaton.count(data, np.cumsum(length) - length, length).tolist() == [greedy_pieces(w, vocabulary) for w in tried]


def test_language_id(spark, documents, nothing):
    from support import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 20 and np.mean([r.lang == r.lang_pred for r in out]) > 0.95 and all(0 <= r.score <= 1 for r in out)
    awkward = {r.doc_id: r for r in langid.identify(documents).collect() if r.doc_id is not None}
    assert {i for i, r in awkward.items() if r.lang_pred == "und"} == {65, 66, 67, 69}
    assert {r.lang_pred for r in awkward.values()} <= {"en", "de", "fr", "und"}
    unlabelled = documents.selectExpr("doc_id", "text", "cast(null as string) as lang", "id", "part")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_kernel_is_the_definition(spark):
    texts = [b"abcab", b"bca zz", b"q"]
    grams = lambda t: {(n, t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    x = langid.presence(data, bounds, np.arange(langid.CODES), langid.CODES)
    assert (x @ x.T).tolist() == [[len(grams(a) & grams(b)) for b in texts] for a in texts]


def test_mixing(documents, made):
    import re

    out = mixing.mix(documents, block_words=16)
    rows = out.documents.collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in pairs(made)]
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, n) for (i, _), n in zip(pairs(made), sizes, strict=True))
    whole = Counter()
    for row, n in zip(made, sizes, strict=True):
        whole[row[3]] += n
    expected = targets(whole)
    taken = Counter()
    for r in rows:
        assert r.source_size == whole[r.source] and r.target == pytest.approx(expected[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 40 for s in whole)
    again = mixing.mix(documents.repartition(5), block_words=16).documents.collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    slots, pieces = out.slots.collect(), out.pieces.collect()
    used = Counter((r.source, r.block) for r in slots)
    for source, n in Counter({s: -(-whole[s] // 16) for s in whole}).items():
        times = [used[source, b] for b in range(n)]
        assert not times or max(times) - min(times) <= 1
    words_of = Counter()
    for p in pieces:
        words_of[p.source, p.block] += p.words
    assert all(n <= 16 for n in words_of.values()) and sum(words_of.values()) == sum(sizes)
    assert sum(taken.values()) == sum(words_of[k] * n for k, n in used.items())


def test_small_sources_come_near_their_targets(spark):
    sizes = {"a": 100, "b": 30, "c": 1, "d": 7, None: 5000, "e": 90000}
    rows = [(i, " ".join(["w"] * (n // 5)) if n >= 5 else "w", x) for x, n in sizes.items() for i in range(5 if n >= 5 else 1)]
    whole = Counter()
    for _, t, x in rows:
        whole[x] += len(t.split())
    taken = Counter()
    for r in mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).documents.collect():
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    expected = targets(whole)
    assert all(abs(taken[x] - expected[x]) <= max(1, whole[x] / 256) for x in whole)


def test_language_id_learns_from_labelled_rows_only(spark, monkeypatch):
    sampled = []
    monkeypatch.setattr(langid, "Model", lambda sample, landmarks, ridge: sampled.extend(sample))
    rows = [(1, "a labelled text", "en")] + [(1, f"text without a label {i}", None) for i in range(3)] + [(2, f"other {i % 3}", "de") for i in range(300)]
    langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [(lang, rank) for lang, rank, _ in sampled] == [("de", 1), ("de", 2), ("de", 3), ("en", 1)]
    many = [(7 * i, f"text {'abcdefghij'[i % 10]} {i}", f"l{i % 150}") for i in range(900)]
    sampled.clear()
    langid.train(spark.createDataFrame(many, "doc_id bigint, text string, lang string"), most=300)
    assert len({lang for lang, _, _ in sampled}) == len({r[2] for r in many if zlib.crc32(str(r[0]).encode()) % 5}) and len(sampled) <= 300


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 1000}, {"a": 0, "b": 5, None: 7}, {"a": 1}, {"a": 0}, {"a": 1000, "b": 1, "c": 2, "d": 3, "e": 400}])
def test_mixing_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(targets(sizes))


def test_permutations(spark):
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        row = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), [F.lit(1)]).alias("x"), mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), [F.lit(2)]).alias("y")).collect()
        assert sorted(r.x for r in row) == list(range(n)) and sorted(r.y for r in row) == list(range(n))
        assert n < 60 or [r.x for r in row] != [r.y for r in row]


def test_chat(spark):
    rng = random.Random(8)
    turns = []
    for conv in range(60):
        stem = rng.randrange(6)
        for t in range(rng.randint(1, 8)):
            turns.append((conv, t, "user" if t % 2 else "assistant", f"stem {stem} turn {t}" if t < 6 or rng.random() < 0.5 else f"own {conv}"))
    turns += turns[:9] + [(None, 0, "user", "lost"), (100, None, None, None), (100, None, "user", ""), (101, 3, "user", None), (102, 300, "user", "far"), (102, 2, "user", "near"), (103, 2, "user", "near"), (104, 7, "x", "\n")]
    frame = with_clashes(spark, turns, "conv_id bigint, turn bigint, role string, text string").withColumnRenamed("c0", "conv")
    expected = maximal_chats(turns)
    found = chat.format_chats(frame).collect()
    assert {(1 << 63) - 1 if r.conv_id is None else r.conv_id for r in found} == set(expected)
    for r in found:
        whole = expected[(1 << 63) - 1 if r.conv_id is None else r.conv_id]
        assert r.n_turns == len(whole)
        if r.conv_id not in (100, 102):
            assert r.text == "".join(f"<|im_start|>{a or ''}\n{b or ''}<|im_end|>\n" for a, b in whole) and r.part == 0
    assert sorted(r.part for r in found if r.conv_id == 102) == [0, 1]
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_chats_in_pieces(spark):
    """Very many rows of one turn number, or of none, are dealt by hash, and nothing changes but the rows that hold them."""
    turns = [(1, 3, "user", f"same number {i}") for i in range(60)] + [(None, None, "user", f"no number {i}") for i in range(60)]
    turns += [(2, t, "user", f"turn {t}") for t in range(9)] + [(3, t, "user", f"turn {t}") for t in range(5)] + turns[:60]
    turns += [(4, 3, "user", f"same number {i}") for i in range(60)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    order = lambda r: (r.part is None, r.part, r.piece_turn, r.piece)
    joined = {}
    for most in (chat.MOST, 7):
        rows = sorted(chat.format_chats(frame, most=most).collect(), key=order)
        texts = {}
        for r in rows:
            texts[r.conv_id, r.n_turns] = texts.get((r.conv_id, r.n_turns), "") + r.text
        joined[most] = texts
        assert max(r.text.count("<|im_start|>") for r in rows) > 20 if most > 7 else len(rows) > 10
    assert joined[7] == joined[chat.MOST] and set(joined[7]) == {(1, 60), (2, 9), (None, 60)}


def test_words_of_one_hash_are_counted_each():
    import pyarrow as pa

    word = lambda flip: "".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(2048))
    vocabulary = [b"ab", b"abb", *(bytes([i]) for i in range(256))]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": pa.array([f"{word(0)} {word(1)} x"])})

    class Sent:
        value = __import__("pickle").dumps(token_counts.Automaton(vocabulary))

    out = next(token_counts._counter(Sent)(iter([batch])))
    expected = sum(greedy_pieces(w.encode(), set(vocabulary)) for w in (word(0), word(1), "x"))
    assert out.column("n_tokens").to_pylist() == [expected]


def test_no_documents(spark, nothing):
    empty = nothing.selectExpr("cast(null as bigint) as item_id", "text")
    outs = [words.substring_dedup(nothing), suffixes.suffix_dedup(nothing), prints.near_duplicates(nothing), decontamination.decontaminate(nothing, empty), lines.line_dedup(nothing), quality.quality(nothing), token_counts.token_counts(nothing, [b"a"]), langid.identify(nothing), mixing.mix(nothing).documents]
    assert [x.count() for x in outs] == [0] * 9


def test_hashes_and_blobs(spark):
    ids = [0, 1, -1, 5, (1 << 63) - 1, -(1 << 63), 123456789]
    found = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i bigint").selectExpr("xxhash64(i)").collect()]
    assert A.xxhash64(np.array(ids)).view(np.int64).tolist() == found
    for n in (1, 7, 211):
        for kind in ("int", "bigint"):
            values = [i for i in ids if kind == "bigint" or abs(i) < 1 << 31] + list(range(50))
            dealt = [r[0] for r in spark.createDataFrame([(i,) for i in values], f"i {kind}").selectExpr(f"pmod(hash(i), {n})").collect()]
            assert A.partition_of(np.array(values, np.int32 if kind == "int" else np.int64), n).tolist() == dealt
        for parts in (1, n, 3 * n + 2):
            names = A.balanced_names(parts, n)
            assert len(set(names.tolist())) == parts and np.ptp(np.bincount(A.partition_of(names, n), minlength=n)) <= 1
    arrays = [np.arange(5, dtype=np.int64), np.zeros(0, np.uint16), np.array([1, 70000], np.uint32), np.array([3], np.uint8)]
    assert [x.tolist() for x in blobs.load(blobs.dump(*arrays))] == [x.tolist() for x in arrays]
    text = np.frombuffer(b"abcabcabdabc", np.uint8)
    sums = A.prefix(A.BYTE_VALUES[text])
    hashes = A.fixed_hash(sums, 3)
    assert hashes[0] == hashes[3] == hashes[9] != hashes[6]
    assert A.same_bytes(A.big_words(text), np.array([0, 0, 9]), np.array([3, 6, 0]), np.array([3, 3, 3])).tolist() == [True, False, True]
    assert A.sliding_min(np.array([5, 3, 4, 1, 6]), 3).tolist() == [3, 1, 1]
    assert spans.NULL_ID == (1 << 63) - 1 and superkmer.CHUNK_BYTES


def test_super_kmers_cover_every_window_once():
    rng = random.Random(6)
    text = bytes(rng.choice(b"ab") for _ in range(500))
    data, bounds = np.frombuffer(text, np.uint8), np.array([0, 100, 100, 130, 500])
    first, last, at = superkmer.cut(A.fixed_hash(A.prefix(A.BYTE_VALUES[data]), 4), bounds, 20, 4)
    windows = [w for a, b in zip(first, last, strict=True) for w in range(a, b + 1)]
    assert windows == [*range(0, 81), *range(100, 111), *range(130, 481)]
    assert all(a + 20 >= g + 4 and g >= b for a, b, g in zip(first, last, at, strict=True))


def test_spans_of_many_rows_without_id(spark):
    rng = random.Random(6)
    draw = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = draw(25)
    held = [f"{draw(rng.randint(5, 60))} {passage}" for _ in range(1200)]
    free = [draw(rng.randint(5, 60)) for _ in range(1200)]
    docs = spark.createDataFrame([(1, passage), *((None, t) for t in held + free)], "doc_id bigint, text string").cache()
    out = words.substring_dedup(docs).where("doc_id is null")
    assert Counter(r.kept_text for r in out.collect()) == Counter([t[: -len(passage) - 1] for t in held] + free)
    out = suffixes.suffix_dedup(docs).where("doc_id is null")
    assert Counter(bytes(r.kept_bytes).decode().rstrip() for r in out.collect()) == Counter([t[: -len(passage) - 1] for t in held] + free)
    same_lines = [f"{t}\n{passage}" for t in free]
    batch = spark.createDataFrame([(i, passage) for i in range(6)] + [(None, t) for t in same_lines + held], "doc_id bigint, text string")
    gone = lines.dropped_lines(spans.keyed(batch)).select("id").collect()
    assert sorted(r.id for r in gone) == list(range(6))
    assert spans.keyed(batch).where("doc_id is null").select("tag").distinct().count() == 2400
