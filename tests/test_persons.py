"""Linking, upserts, merges, review groups and curation on small hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from fragloom.functions.text import norm_name
from fragloom.observability import Metrics
from fragloom.operators import fragments, gold, linking, merge, reconcile, upsert
from fragloom.operators.components import components
from fragloom.operators.schema import FIELDS, field_type
from fragloom.operators.upsert import COLUMNS
from fragloom.plans import api, jobs


def people(spark, *records):
    """Silver rows from dicts; ids count from 1."""
    rows = []
    for i, r in enumerate(records, 1):
        r = {"id": i, "match_key": f"k{r.get('id', i)}"} | r
        rows.append(tuple(float(r[f]) if f == "salary" and f in r else r.get(f) for f in ["id", "match_key", *FIELDS]))
    kinds = ", ".join(f"{f} {'double' if f == 'salary' else 'string'}" for f in FIELDS)
    frame = spark.createDataFrame(rows, f"id bigint, match_key string, {kinds}")
    return frame.withColumns({"norm_name": norm_name(F.col("full_name")), "created_at": F.timestamp_seconds("id"), "updated_at": F.timestamp_seconds(F.col("id") + 1)}).select(*COLUMNS)


def no_reviews(spark, *rows):
    return spark.createDataFrame(list(rows), "match_key string, status string, survivor_match_key string, note string")


def simulate(rows, lifetime, least):
    """The keyed buffer, message by message: (firing seqs, match key of the first) in order."""
    alias, buffers, out = {}, {}, []
    for seq, t, kind, name, key in rows:
        buffer = key
        if kind == "personal" and key.startswith("passport:") and name:
            alias[name] = (t, key)
        if key.startswith("name:"):
            known = alias.get(key[5:])
            if known and t - known[0] < 3 * lifetime:
                buffer = known[1]
        held, last = buffers.get(buffer, ([], None))
        if last is not None and t - last >= lifetime:
            held = []
        held = [*held, (seq, key)]
        if len(held) >= least:
            out.append((tuple(s for s, _ in held), held[0][1]))
            buffers.pop(buffer, None)
        else:
            buffers[buffer] = (held, t)
    return sorted(out)


@pytest.mark.parametrize("least", [2, 3])
def test_windows_equal_the_buffer(spark, least):
    rng = random.Random(least)
    rows, t = [], 0
    for seq in range(400):
        t += rng.choice([0, 1, 40, 100, 299, 300, 301, 900])
        who = rng.randrange(4)
        rows.append((seq, t, *rng.choice([("personal", f"n{who}", f"passport:p{who}"), ("location", f"n{who}", f"name:n{who}"), ("bank", "", f"passport:p{who}"), ("net", "", f"addr:a{who}")])))
    frame = spark.createDataFrame([(s, t, k, n, m) for s, t, k, n, m in rows], "seq bigint, t bigint, fragment_type string, name string, match_key string").withColumn("ts", F.timestamp_seconds("t"))
    chunked = linking.with_chunk(linking.with_buffer_key(frame), least=least).where("fired")
    found = chunked.groupBy("buffer_key", "life", "chunk").agg(F.sort_array(F.collect_list("seq")).alias("s"), F.min_by("match_key", "seq").alias("k")).collect()
    assert sorted((tuple(r.s), r.k) for r in found) == simulate(rows, 300, least)


def raw(spark, *messages):
    rows = [(i, m) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "seq bigint, value string").withColumn("ts", F.timestamp_seconds("seq"))


PERSONAL = '{"Name":"Ana","Lastname":"Gil","Sex":"F","Telfnumber":"600","Passport":"X1","E-Mail":"a@x.com"}'
BANK = '{"Passport":"X1","IBAN":"ES1","Salary":"1.500,75"}'
PLACE = '{"Fullname":"Dr. Ana Gil","City":"Madrid","Address":"Calle 1"}'
WORK = '{"Fullname":"Ana Gil","Company":"ACME","Company Address":"Av 1","Company Telfnumber":"900","Company E-Mail":"h@a.com","Job":"Engineer"}'


def test_one_fragment_makes_no_person_and_two_make_one(spark):
    assert jobs.ingest(raw(spark, PERSONAL))[0].count() == 0
    persons, log = jobs.ingest(raw(spark, PERSONAL, BANK, '{"foo":1}', "x"))
    row = persons.collect()
    assert len(row) == 1 and (row[0].passport, row[0].iban, row[0].salary, row[0].full_name, row[0].match_key) == ("X1", "ES1", 1500.75, "ana gil", "passport:x1")
    assert [r.fragment_type for r in log.orderBy("n").collect()] == ["personal", "bank"]


def test_late_names_land_in_the_passport_buffer_but_keep_their_key(spark):
    persons, _ = jobs.ingest(raw(spark, PERSONAL, BANK, PLACE, WORK))
    assert sorted(r.match_key for r in persons.collect()) == ["name:ana gil", "passport:x1"]


def test_upsert_fills_blanks_only_and_repeats_change_nothing(spark):
    first, _ = jobs.ingest(raw(spark, PERSONAL, BANK))
    second, _ = jobs.ingest(raw(spark, PERSONAL.replace("a@x.com", "b@x.com").replace("600", ""), BANK.replace("ES1", "ES2")), existing=first)
    again, _ = jobs.ingest(raw(spark, PERSONAL, BANK), existing=second)
    plain = lambda df: [r[:-2] for r in df.collect()]
    assert plain(first) == plain(second) == plain(again)


def test_batch_upsert_fills_nulls_only(spark):
    stored = people(spark, {"name": "Ana", "phone": "", "city": None}).withColumn("match_key", F.lit("passport:1"))
    kinds = ", ".join(f"{f} {field_type(f)}" for f in FIELDS)
    new = lambda seq, **r: (seq, "passport:1" if seq < 9 else "passport:2", *(r.get(f) for f in FIELDS), None)
    rows = spark.createDataFrame([new(1, name="NO", phone="6", city=""), new(2, city="Rome", salary=2.5), new(9, name="Eva", city=""), new(10, city="Oslo")], f"seq bigint, match_key string, {kinds}, updated_at timestamp")
    assert upsert.rows_sent(rows) == 2
    out = {r.match_key: r for r in upsert.upsert(rows, stored, nulls_only=True).collect()}
    one, two = out["passport:1"], out["passport:2"]
    assert (one.id, one.name, one.phone, one.city, one.salary) == (1, "Ana", "", "Rome", 2.5) and (two.id, two.name, two.city) == (2, "Eva", "Oslo")
    again = upsert.upsert(rows, upsert.upsert(rows, stored, nulls_only=True), nulls_only=True)
    assert again.count() == 2 and {r.match_key: r.phone for r in upsert.upsert(rows, stored).collect()}["passport:1"] == "6"


def test_upsert_needs_a_key(spark):
    frame = people(spark, {"match_key": "", "full_name": "A B"}).withColumn("seq", F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="match key"):
        upsert.upsert(frame).collect()


def test_ids_continue(spark):
    old = people(spark, {"match_key": "a"}, {"match_key": "b"})
    new = people(spark, {"match_key": "c"}, {"match_key": "b", "city": "Rome"}, {"match_key": "d"}).withColumn("seq", F.col("id"))
    out = {r.match_key: (r.id, r.city) for r in upsert.upsert(new, old).collect()}
    assert out == {"a": (1, None), "b": (2, "Rome"), "c": (3, None), "d": (4, None)}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (4, 5), (9, 8), (7, 7), (2, 1)], "u bigint, v bigint")
    assert {r.node: r.root for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}
    assert components(edges.limit(0)).count() == 0


def test_merge_by_passport(spark):
    frame = people(spark, {"passport": "P", "full_name": "Alexander Thompson", "city": "Rome"}, {"passport": "P", "full_name": "Alexander Thompsonn", "iban": "ES"}, {"passport": "Q", "full_name": "Ana Gil"}, {"passport": "Q", "full_name": "Carlos Mendez"})
    out = {r.id: r for r in merge.consolidate(frame).collect()}
    assert set(out) == {1, 3, 4}
    assert (out[1].full_name, out[1].city, out[1].iban) == ("Alexander Thompsonn", "Rome", "ES")


def test_merge_follows_chains(spark):
    frame = people(spark, {"passport": "P", "full_name": "ana gil"}, {"passport": "P", "full_name": "ana gill", "city": "Rome"}, {"passport": "P", "full_name": "ana gillo", "iban": "ES"})
    out = merge.consolidate(frame, 0.6).collect()
    assert len(out) == 1 and (out[0].id, out[0].city, out[0].iban) == (1, "Rome", "ES")


def test_merge_of_split_names(spark):
    split = [{"full_name": "Ana Gil", "passport": "P"}, {"full_name": "ana gil", "city": "Rome"}]
    assert merge.consolidate(people(spark, *split)).count() == 1
    for rest in ([{"full_name": "Ana Gil", "passport": "Q"}, split[0]], [split[1], split[1]], [*split, split[1]], [{"full_name": "Ana", "passport": "P"}, {"full_name": "ana"}]):
        assert merge.consolidate(people(spark, *rest)).count() == len(rest)


def test_second_merge_finds_nothing(spark):
    frame = merge.consolidate(people(spark, {"full_name": "Ana Gil", "passport": "P"}, {"full_name": "ana gil"}))
    assert merge.survivors(merge.merge_links(frame)).count() == 0


def test_manual_merge(spark):
    frame, reviews = people(spark, {"full_name": "A B"}, {"full_name": "C D", "city": "Rome"}, {"full_name": "E F"}), no_reviews(spark, ("k2", "approved", None, None))
    persons, traced = merge.manual_merge(frame, reviews, [2, 1])
    assert {r.id: r.city for r in persons.collect()} == {1: "Rome", 3: None}
    assert [(r.match_key, r.status, r.survivor_match_key) for r in traced.collect()] == [("k2", "merged", "k1")]
    for ids in ([1], [1, 1], [1, 2, 3], [1, 99]):
        with pytest.raises(ValueError):
            merge.manual_merge(frame, reviews, ids)


def test_manual_merge_of_ids_named_twice(spark):
    frame = people(spark, {"full_name": "Ana Gil"}, {"full_name": "Ana Gil Paz"})
    rows, reviews = merge.manual_merge(frame, no_reviews(spark), [2, 1, 2])
    assert [(r.id, r.full_name) for r in rows.collect()] == [(1, "Ana Gil Paz")] and reviews.count() == 1


def test_names_under_one_passport_meet_as_if_all_were_compared(spark):
    rng = random.Random(3)
    bases = ["alexander thompson", "maria del carmen ruiz", "jo li", "anna", "benedict cumberland"]
    names = sorted({"".join(c for c in rng.choice(bases) if rng.random() > 0.05) + rng.choice(["", "", "s", "o"]) for _ in range(120)} - {""})
    frame = people(spark, *({"full_name": n, "passport": "PLACEHOLDER"} for n in names))
    from fragloom.functions.trigram import similarity, trigrams

    rows = frame.select("id", trigrams(F.col("norm_name")).alias("t"))
    a, b = rows.alias("a"), rows.alias("b")
    for threshold in (0.85, 0.5):
        expected = {(r[0], r[1]) for r in a.join(b, F.col("a.id") < F.col("b.id")).where(similarity(F.col("a.t"), F.col("b.t")) >= threshold).select("a.id", "b.id").collect()}
        found = {tuple(sorted((r.u, r.v))) for r in merge.passport_links(frame, threshold).collect()}
        assert found == expected and len(found) > 5


def groups(spark, records, reviews=(), threshold=0.85):
    found = reconcile.duplicate_groups(people(spark, *records), no_reviews(spark, *reviews), threshold).collect()
    return sorted((r.group_id, r.person_id, r.reason) for r in found)


def test_review_groups(spark):
    assert groups(spark, [{"full_name": "Alexander Thompson"}, {"full_name": "Alexander Thompsonn"}]) == [(1, 1, "fuzzy_name"), (1, 2, "fuzzy_name")]
    assert groups(spark, [{"full_name": "Octavio Ponce"}, {"full_name": "Octavio Ponce Gimenez"}]) == [(1, 1, "name_containment"), (1, 2, "name_containment")]
    assert groups(spark, [{"full_name": "Ana Gil"}, {"full_name": "ana  gil"}]) == [(1, 1, "exact_name"), (1, 2, "exact_name")]
    typo = [{"full_name": "Alexander Thompson", "passport": "P"}, {"full_name": "Alexander Thompsonn", "passport": "Q"}]
    assert len(groups(spark, typo)) == 2


def test_no_review_groups(spark):
    same = [{"full_name": "Ana Gil", "passport": "P"}, {"full_name": "Ana Gil", "passport": "Q"}]
    assert groups(spark, same) == []
    assert groups(spark, [{"full_name": "Ana Gil"}] * 21) == []
    assert groups(spark, [{"full_name": "Ana"}, {"full_name": "Ana"}]) == []
    assert groups(spark, [{"full_name": "Jean Leclerc"}, {"full_name": "Jean Leclercq"}]) == []
    assert len(groups(spark, [{"full_name": "Jean Leclerc"}, {"full_name": "Jean Leclercq"}], threshold=0.6)) == 2
    assert groups(spark, []) == []
    assert groups(spark, [{"full_name": "Ana Gil"}, {"full_name": "Ana Gil"}], [("k2", "approved", None, None)]) == []


WHOLE = {"full_name": "Ana Gil", "passport": "P", "city": "Rome", "company": "ACME", "iban": "ES", "email": "a@x", "phone": "6", "ipv4": "1"}


def test_gold_gate(spark):
    frame = people(spark, WHOLE, WHOLE | {"full_name": "Eva Sol", "city": None}, {"full_name": "Luis Paz"})
    curated = gold.gold_persons(frame, no_reviews(spark))
    assert [r.id for r in curated.collect()] == [1]
    assert gold.gold_stats(curated).first().asDict() == {"total_persons": 1, "with_passport": 1, "with_city": 1, "with_company": 1, "with_bank": 1, "with_ipv4": 1, "cross_linked": 1, "avg_completeness": 8.0}
    assert gold.gold_persons(people(spark, WHOLE, WHOLE), no_reviews(spark)).count() == 0
    approved = gold.gold_persons(people(spark, WHOLE, WHOLE | {"city": None}), no_reviews(spark, ("k2", "approved", None, None)))
    assert [r.id for r in approved.collect()] == [2]
    assert gold.gold_stats(curated.limit(0)).first()["avg_completeness"] == 0.0


def test_gold_groups_leave_settled_members_out(spark):
    frame = people(spark, *[{"full_name": "Ana Gil"}] * 3)
    found = reconcile.duplicate_groups(frame, no_reviews(spark))
    row = gold.gold_groups(found, frame, no_reviews(spark, ("k3", "approved", None, None))).first()
    assert (row.member_count, [m.person_id for m in row.members]) == (2, [1, 2])
    assert gold.gold_groups(found, frame, no_reviews(spark, ("k3", "merged", None, None), ("k2", "approved", None, None))).count() == 0


def test_api(spark):
    frame = people(spark, *({"full_name": f"Ana Gil{i}", "city": "Rome" if i % 2 else "Oslo", "iban": "ES" if i < 3 else None} for i in range(8)))
    assert [r.id for r in api.persons_page(frame, 2, 3).collect()] == [4, 5]
    assert api.persons_total(frame, city=" rome ") == 4 and api.persons_total(frame, q="'; drop table persons; --") == 0
    assert api.person(frame, 3).count() == 1
    with pytest.raises(api.NotFound):
        api.person(frame, 99)
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            api.persons_page(frame, **bad)
    assert api.stats(frame) == {"total_persons": 8, "with_bank": 3, "top_cities": [("Oslo", 4), ("Rome", 4)], "top_companies": []}
    rows = [r.asDict() for r in api.gold_page(frame.withColumn("completeness", F.lit(1.0)), 3, after_id=4).collect()]
    assert api.gold_cursor(rows, 3)["next_cursor"] == 7 and api.gold_cursor(rows[:3], 3)["has_more"] is False
    page = api.persons_list(frame, 2, 3, city="ROME")
    assert (page["total"], page["count"], page["limit"], page["offset"], [x["id"] for x in page["items"]]) == (4, 1, 2, 3, [8])
    curated = frame.withColumn("completeness", F.lit(1.0))
    page = api.gold_list(curated, 3, after_id=4, with_total=True)
    assert (page["total"], page["count"], page["next_cursor"], page["has_more"]) == (8, 3, 7, True)
    page = api.gold_list(curated, 3, offset=6)
    assert (page["total"], [x["id"] for x in page["items"]], page["next_cursor"], page["has_more"]) == (None, [7, 8], 8, False)
    assert api.gold_list(None, with_total=True)["total"] == 0 and api.gold_list(None)["next_cursor"] is None
    assert "error" in api.gold_stats(None) and api.health() == {"status": "ok"}
    assert api.approve(no_reviews(spark), frame, 1, "sure").first()["status"] == "approved"
    assert api.medallion(None, frame, frame).first()["bronze"] is None


def test_tools(spark):
    frame = people(spark, WHOLE)
    curated = gold.gold_persons(frame, no_reviews(spark))
    pairs = spark.createDataFrame([(1, 1, 2, 0.9)], "id bigint, person_id_a bigint, person_id_b bigint, confidence double")
    catalogue = api.tools(frame, curated, pairs)
    assert len(catalogue) == 10
    assert catalogue["search_person"]("ana")["items"][0]["id"] == 1 and catalogue["get_stats"]()["total_persons"] == 1
    assert catalogue["top_cities"]() == [("Rome", 1)] and catalogue["duplicate_candidates"]()[0]["confidence"] == 0.9
    assert catalogue["get_stats"]() == api.stats(frame) and catalogue["top_companies"](limit=1) == [("ACME", 1)]
    assert catalogue["search_person"](city="rome", company="acm", page=1)["total"] == 1 and catalogue["search_person"]("ana", page=2)["items"] == []
    assert catalogue["duplicate_candidates"](limit=1)[0]["id"] == 1
    assert catalogue["completeness_distribution"]() == [(8, 1)] and "passport" in catalogue["explain_matching"]()


def test_maintenance_publishes_whole_tables(spark, tmp_path):
    from fragloom.storage import SnapshotSet, Snapshots

    frame = people(spark, WHOLE, {"full_name": "Eva Sol", "passport": "Q"}, {"full_name": "eva sol"})
    metrics = Metrics()
    for _ in range(2):
        jobs.publish(jobs.maintain(frame, no_reviews(spark), metrics=metrics), str(tmp_path))
    table = Snapshots(spark, str(tmp_path))
    assert table.numbers() == [0, 1] and SnapshotSet(spark, str(tmp_path)).read("persons").count() == 2
    (tmp_path / "v=2" / "persons").mkdir(parents=True)  # a rebuild that did not end shows nothing
    assert SnapshotSet(spark, str(tmp_path)).read("gold_persons").count() == 1
    assert metrics.values["reconcile_seconds_count", ""] == 2
    assert metrics.values["consolidation_merged_rows", ""] == 2 and metrics.values["gold_persons", ""] == 1
    table.prune(1)
    assert table.numbers() == [1]


def test_fragments_of_lists(spark):
    row = fragments.classify(raw(spark, '{"Passport":"X1","IBAN":["ES1","ES2"],"Salary":[]}'))
    fields = fragments.person_fields(F.col("fragment_type"), F.col("message"), F.col("name"))
    out = row.select(*fields).first()
    assert (out.iban, out.salary, out.passport) == ("ES1", None, "X1")


def test_rates_and_quantiles_of_metrics():
    from fragloom.observability import bucket_quantile, rate

    metrics = Metrics()
    metrics.count("messages_consumed", 10, 'fragment_type="bank"')
    before = dict(metrics.values)
    metrics.count("messages_consumed", 30, 'fragment_type="bank"')
    assert rate(before, metrics.values, "messages_consumed", 60) == {'fragment_type="bank"': 0.5}
    assert rate(metrics.values, before, "messages_consumed", 10) == {'fragment_type="bank"': 1.0}  # begun anew
    for seconds in (0.02, 0.02, 0.2, 0.9):
        metrics.observe("persist_seconds", seconds)
    assert 0.01 <= bucket_quantile(metrics.values, "persist_seconds", 0.5) <= 0.025
    assert 0.5 < bucket_quantile(metrics.values, "persist_seconds", 0.99) <= 1 and bucket_quantile({}, "x", 0.5) is None


def test_quantiles_are_exact(spark):
    from fragloom.observability import quantiles

    shares = [0.99, 0.0, 0.07, 0.5, 1.0]
    found = [tuple(r) for r in quantiles(spark.range(300_000).selectExpr("id * 7 as v"), "v", shares).collect()]
    assert found == [(0.99, 296_999 * 7), (0.0, 0), (0.07, 20_999 * 7), (0.5, 149_999 * 7), (1.0, 299_999 * 7)]
    few = spark.createDataFrame([(x,) for x in (5, None, 5, -1, 9, None)], "v bigint")
    assert [tuple(r) for r in quantiles(few, "v", [0.25, 0.5, 0.76]).collect()] == [(0.25, -1), (0.5, 5), (0.76, 9)]
    assert [tuple(r) for r in quantiles(few.where("v is null"), "v", [0.5, 0.99]).collect()] == [(0.5, None), (0.99, None)]
    with pytest.raises(ValueError):
        quantiles(few, "v", [1.5])


def test_records_of_several_partitions(spark):
    from fragloom.sources.kafka import topic_rows

    records = spark.createDataFrame([(p, o, f"{p}/{o}") for p in range(3) for o in range(4)], "partition int, offset bigint, value string").withColumn("timestamp", F.current_timestamp())
    rows = topic_rows(records).orderBy("seq").collect()
    assert len({r.seq for r in rows}) == 12 and [r.value for r in rows if r.value.startswith("1/")] == ["1/0", "1/1", "1/2", "1/3"]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from fragloom.storage import prepare

    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(ValueError):
        prepare(SimpleNamespace(sparkContext=context))
