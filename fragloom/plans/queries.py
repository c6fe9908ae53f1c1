"""The driver's queries of the reference's capabilities, by name: each takes (spark, sf_dir)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from fragloom.functions import text as T, trigram
from fragloom.observability import Metrics, quantiles, rate
from fragloom.operators import fragments, gold, linking, merge, reconcile, upsert
from fragloom.operators.schema import FIELDS
from fragloom.plans import api
from fragloom.sources import bronze, fixtures as X
from fragloom.storage import SnapshotSet, materialise, prepare

#: A lifetime that fits the stand-in stream, whose users come back within days: half a day.
LIFETIME_S = 43_200


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.persons(spark, sf_dir)


def _seconds(df: DataFrame) -> DataFrame:
    """Times as whole seconds, so that engines agree on them."""
    return df.withColumns({c: F.unix_seconds(c) for c, kind in df.dtypes if kind == "timestamp"})


# Scalars


def norm_names(spark, sf_dir):
    return persons(spark, sf_dir).select("id", "norm_name")


def normalized_texts(spark, sf_dir):
    text = F.concat(F.lit("  Ñandú\t"), F.col("full_name"), F.lit("  À la  Crème "))
    return persons(spark, sf_dir).select("id", T.normalize_text(text).alias("plain"), T.strip_titles(T.normalize_text("full_name")).alias("untitled"), T.scalar(F.concat(F.lit('["'), F.col("full_name"), F.lit('", "x"]'))).alias("first"))


def normalized_keys(spark, sf_dir):
    names = F.array(*(F.lit(x) for x in ("E-Mail", "Company Address", "company_email", "Company Adress", " Full Name ", "IPv4")))
    keys = X.table(spark, sf_dir, "region").select("r_regionkey", F.posexplode(names).alias("n", "raw"))
    return keys.select("r_regionkey", F.col("n").cast("bigint").alias("n"), T.normalize_key(F.col("raw")).alias("key"))


SALARIES = "case o_orderkey%7 when 0 then concat('$1,', p, '.50') when 1 then concat(p, ',75') when 2 then concat('1.', p, ',25') when 3 then concat(p, '-2') when 4 then '' when 5 then concat('EUR ', p) else '.' end"


def salaries(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 900 + 100).cast("string").alias("p"))
    return orders.select("o_orderkey", T.clean_salary(F.expr(SALARIES)).alias("salary"))


def masked(spark, sf_dir):
    line = F.concat(F.lit("passport: AB"), F.col("c_custkey") + 100000, F.lit(" iban ES91"), F.lit("2100041845020"), F.col("c_custkey"), F.lit(" mail "), F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com"))
    return X.table(spark, sf_dir, "customer").select("c_custkey", T.mask_secret(F.col("c_name")).alias("secret"), T.mask_secret(F.substring("c_name", 1, 3)).alias("short"), T.redact(line).alias("line"))


def thousands(spark, sf_dir):
    value = F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_totalprice") * 100).cast("bigint"))
    return X.table(spark, sf_dir, "orders").select("o_orderkey", T.thousands(value).alias("shown"))


def trigram_similarity(spark, sf_dir):
    rows = persons(spark, sf_dir).where("norm_name is not null").withColumn("other", F.concat_ws(" ", F.reverse(F.get(F.split("norm_name", " "), F.lit(0))), F.get(F.split("norm_name", " "), F.lit(1))))
    return rows.select("id", F.round(trigram.similarity(trigram.trigrams(F.col("norm_name")), trigram.trigrams(F.col("other"))), 5).alias("sim"))


def backfilled_names(spark, sf_dir):
    gaps = F.when(F.col("id") % 3 == 0, F.lit("")).when(F.col("id") % 3 == 1, F.col("norm_name"))
    return upsert.backfill_names(persons(spark, sf_dir).withColumn("norm_name", gaps)).select("id", "norm_name")


# Fragments


def _classified(spark, sf_dir):
    return fragments.classify(X.fragment_stream(spark, sf_dir))


def fragment_types(spark, sf_dir):
    return _classified(spark, sf_dir).select("seq", "fragment_type", "match_key")


def fragment_rejects(spark, sf_dir):
    return fragments.rejects(_classified(spark, sf_dir))


def bronze_counts(spark, sf_dir):
    return bronze.counts(bronze.bronze_rows(_classified(spark, sf_dir)))


def bounded_consume(spark, sf_dir):
    from fragloom.sources.kafka import bounded

    return bounded(X.fragment_stream(spark, sf_dir), 500).select("seq", "value")


def alias_links(spark, sf_dir):
    return linking.with_buffer_key(fragments.usable(_classified(spark, sf_dir)), LIFETIME_S).select("seq", "match_key", "buffer_key")


def buffer_firings(spark, sf_dir):
    chunked = linking.with_chunk(linking.with_buffer_key(fragments.usable(_classified(spark, sf_dir)), LIFETIME_S), LIFETIME_S)
    return chunked.select("seq", "buffer_key", F.col("life").cast("bigint").alias("life"), F.col("chunk").cast("bigint").alias("chunk"), "fired")


def _folded(spark, sf_dir):
    return linking.link(fragments.usable(_classified(spark, sf_dir)), LIFETIME_S)


def folded_persons(spark, sf_dir):
    return _folded(spark, sf_dir).select("seq", "first_seq", "buffer_key", "match_key", *FIELDS, linking.filled_fields().cast("bigint").alias("filled"))


def upserted_persons(spark, sf_dir):
    return _seconds(upsert.upsert(materialise(_folded(spark, sf_dir))))


def fragment_log(spark, sf_dir):
    folded = materialise(_folded(spark, sf_dir))
    return upsert.fragment_log(folded, upsert.upsert(folded)).select("person_id", "match_key", "n", "fragment_type")


# Merge


def merge_survivors(spark, sf_dir):
    return merge.survivors(merge.merge_links(persons(spark, sf_dir)))


def merged_persons(spark, sf_dir):
    return _seconds(merge.consolidate(persons(spark, sf_dir)))


MANUAL_IDS = [3, 40]


def manual_merge(spark, sf_dir):
    rows, _ = merge.manual_merge(persons(spark, sf_dir), X.reviews(spark, sf_dir), MANUAL_IDS)
    return _seconds(rows)


def manual_merge_trace(spark, sf_dir):
    return merge.manual_merge(persons(spark, sf_dir), X.reviews(spark, sf_dir), MANUAL_IDS)[1].select("match_key", "status", "survivor_match_key")


def review_upsert(spark, sf_dir):
    status = F.when(F.col("id") % 2 == 0, "approved").otherwise("merged")
    note = F.concat(F.lit("note "), F.col("id"))
    rows = persons(spark, sf_dir).select(F.col("id").alias("seq"), "match_key", status.alias("status"), F.lit(None).cast("string").alias("survivor_match_key"), note.alias("note"))
    # A second verdict on every key comes later and stands.
    both = rows.unionByName(rows.withColumns({"seq": F.col("seq") + (1 << 40), "note": F.concat("note", F.lit(" again"))}))
    return upsert.upsert_reviews(both, X.reviews(spark, sf_dir)).select("match_key", "status", "note")


def _gappy(spark, sf_dir):
    """Silver rows with gaps: a null city or an empty phone, by id."""
    gaps = {"city": F.when(F.col("id") % 4 != 0, F.col("city")), "phone": F.when(F.col("id") % 6 == 0, F.lit("")).otherwise(F.col("phone"))}
    return persons(spark, sf_dir).withColumns(gaps)


def _incoming(spark, sf_dir):
    """For every person another row under its key, with all fields, and one under a key of its own."""
    rows = persons(spark, sf_dir).withColumns({"seq": F.col("id"), "phone": F.concat(F.lit("7"), F.col("id")), "company": F.lit("other")})
    fresh = rows.withColumns({"seq": F.col("id") + (1 << 40), "match_key": F.concat(F.lit("new:"), F.col("id"))})
    return rows.unionByName(fresh).select("seq", "match_key", *FIELDS, "updated_at")


def upsert_into_existing(spark, sf_dir):
    return upsert.upsert(_incoming(spark, sf_dir), _gappy(spark, sf_dir)).select("id", "match_key", "full_name", "city", "company", "phone", "norm_name")


def upsert_nulls_only(spark, sf_dir):
    return upsert.upsert(_incoming(spark, sf_dir), _gappy(spark, sf_dir), nulls_only=True).select("id", "match_key", "full_name", "city", "company", "phone", "norm_name")


def upsert_rows_sent(spark, sf_dir):
    sent = upsert.rows_sent(_incoming(spark, sf_dir))
    return spark.createDataFrame([(sent,)], "rows_sent bigint")


# Raw layer and jobs


def _folder(spark):
    """A new folder beside the checkpoints, which all executors share."""
    prepare(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/tables-{uuid.uuid4().hex}"


def _raw(spark, sf_dir):
    """The raw layer after the stand-in stream was written to it twice in two batches, one of which replaced itself."""
    folder, rows = _folder(spark), bronze.bronze_rows(_classified(spark, sf_dir))
    half = rows.agg(F.percentile_approx("kafka_offset", 0.5)).first()[0] or 0
    for batch, part in ((0, rows.where(F.col("kafka_offset") < half)), (1, rows.where(F.col("kafka_offset") >= half)), (1, rows.where(F.col("kafka_offset") >= half))):
        bronze.append(part, folder, batch)
    return bronze.scan(spark, folder)


def bronze_scan(spark, sf_dir):
    return _raw(spark, sf_dir).select("seq", "value")


def reprocessed_persons(spark, sf_dir):
    from fragloom.plans.jobs import ingest

    return _seconds(ingest(_raw(spark, sf_dir), LIFETIME_S)[0])


def published_gold(spark, sf_dir):
    from fragloom.plans.jobs import maintain, publish

    folder = _folder(spark)
    publish(maintain(persons(spark, sf_dir), X.reviews(spark, sf_dir)), folder)
    return SnapshotSet(spark, folder).read("gold_persons").select("id", "match_key", "completeness")


# Reconcile


def _people(spark, sf_dir):
    return reconcile.candidates(persons(spark, sf_dir), X.reviews(spark, sf_dir))


def name_catalog(spark, sf_dir):
    return reconcile.name_catalog(_people(spark, sf_dir)).select("norm", F.size("words").cast("bigint").alias("n_words"), "key2", "keyt", "n_persons", "anchor_id", "n_passports")


def name_pairs(spark, sf_dir):
    return reconcile.name_pairs(reconcile.name_catalog(_people(spark, sf_dir))).select("a", "b", F.round("sim", 5).alias("sim"), "contain")


def _groups(spark, sf_dir):
    return reconcile.duplicate_groups(persons(spark, sf_dir), X.reviews(spark, sf_dir))


def duplicate_groups(spark, sf_dir):
    return _groups(spark, sf_dir)


def duplicate_totals(spark, sf_dir):
    return _groups(spark, sf_dir).agg(F.countDistinct("group_id").alias("n_groups"), F.count("*").alias("n_members"))


def _gold_groups(spark, sf_dir):
    return gold.gold_groups(_groups(spark, sf_dir), persons(spark, sf_dir), X.reviews(spark, sf_dir))


def gold_duplicate_groups(spark, sf_dir):
    return _gold_groups(spark, sf_dir).select("group_id", "member_count", "max_confidence", "reason", F.concat_ws(",", F.transform("members", lambda m: m["person_id"].cast("string"))).alias("members"))


def group_members(spark, sf_dir):
    return gold.members_json(_gold_groups(spark, sf_dir)).select("group_id", "members")


# Gold


def _gold(spark, sf_dir):
    return gold.gold_persons(persons(spark, sf_dir), X.reviews(spark, sf_dir))


def gold_persons(spark, sf_dir):
    return _gold(spark, sf_dir).select("id", "match_key", "full_name", "city", "completeness")


def gold_stats(spark, sf_dir):
    return gold.gold_stats(_gold(spark, sf_dir))


def gold_top_cities(spark, sf_dir):
    return gold.top_values(_gold(spark, sf_dir), "city")


def gold_top_companies(spark, sf_dir):
    return gold.top_values(_gold(spark, sf_dir), "company")


def gold_completeness(spark, sf_dir):
    return gold.completeness(_gold(spark, sf_dir))


# Query API


def persons_page(spark, sf_dir):
    return api.persons_page(persons(spark, sf_dir), limit=40, offset=20, q="ST", company="a").select("id", "full_name", "company")


def persons_city(spark, sf_dir):
    return api.persons_page(persons(spark, sf_dir), limit=500, city=" brand#11 ", job="%e_").select("id", "city", "job")


def person_lookup(spark, sf_dir):
    return api.person(persons(spark, sf_dir), 77).select("id", "full_name", "passport", "email", "salary")


def live_stats(spark, sf_dir):
    rows = persons(spark, sf_dir)
    return rows.agg(F.count("*").alias("total_persons"), F.count("iban").alias("with_bank"))


def live_top_cities(spark, sf_dir):
    return gold.top_values(persons(spark, sf_dir), "city", 5)


def gold_page(spark, sf_dir):
    return api.gold_page(_gold(spark, sf_dir), limit=30, after_id=100).select("id", "full_name", "completeness")


def _match_candidates(spark, sf_dir):
    """Pairs of names of which one begins the other, as the legacy table has them."""
    names = reconcile.name_catalog(_people(spark, sf_dir)).select("key2", "norm", "anchor_id")
    a, b = names.select("key2", F.col("norm").alias("a"), F.col("anchor_id").alias("person_id_a")), names.select("key2", F.col("norm").alias("b"), F.col("anchor_id").alias("person_id_b"))
    pairs = a.join(b, "key2").where("a <> b").withColumn("confidence", T.prefix_confidence(F.col("a"), F.col("b"))).where("confidence is not null")
    return pairs.select((F.col("person_id_a") * 1_000_000_000 + F.col("person_id_b")).alias("id"), "person_id_a", "person_id_b", "confidence", F.lit("name_prefix").alias("reason"))


def match_candidates(spark, sf_dir):
    return api.candidates(_match_candidates(spark, sf_dir), limit=100, min_confidence=0.4).select("person_id_a", "person_id_b", F.round("confidence", 6).alias("confidence"))


def groups_page(spark, sf_dir):
    page = api.groups(_gold_groups(spark, sf_dir), persons(spark, sf_dir), X.reviews(spark, sf_dir), limit=25, min_confidence=0.6)
    return page.select("group_id", "confidence", "reason", F.explode("members").alias("m")).select("group_id", "confidence", "reason", "m.person_id", "m.full_name", "m.city", "m.company")


APPROVED_ID = 12


def approved_reviews(spark, sf_dir):
    return api.approve(X.reviews(spark, sf_dir), persons(spark, sf_dir), APPROVED_ID, "seen").select("match_key", "status", "note")


def gold_stats_answer(spark, sf_dir):
    answer = api.gold_stats(gold.gold_stats(_gold(spark, sf_dir)))
    return spark.createDataFrame([(answer["total_persons"], answer["with_bank"], answer["avg_completeness"])], "total_persons bigint, with_bank bigint, avg_completeness double")


def assistant_search(spark, sf_dir):
    catalogue = api.tools(persons(spark, sf_dir), _gold(spark, sf_dir), _match_candidates(spark, sf_dir))
    found = catalogue["search_person"](q="a", company="s", page=2)
    stats, items = catalogue["get_stats"](), found["items"]
    return spark.createDataFrame([(found["total"], stats["total_persons"], stats["with_bank"], x["id"], x["full_name"]) for x in items], "total bigint, total_persons bigint, with_bank bigint, id bigint, full_name string")


def metrics_summary(spark, sf_dir):
    """What a job's metrics say of the stand-in stream: messages by kind, and a rate and a quantile over them."""
    metrics = Metrics()
    before = dict(metrics.values)
    for kind, n in bronze.counts(bronze.bronze_rows(_classified(spark, sf_dir))).collect():
        metrics.count("messages_consumed", n, f'fragment_type="{kind}"')
        metrics.observe("sizes", n)
    rates = rate(before, metrics.values, "messages_consumed", 10)
    rows = [(label.split('"')[1], float(value), float(metrics.values["sizes_count", ""])) for label, value in rates.items()]
    return spark.createDataFrame(rows, "fragment_type string, a_second double, kinds double")


def medallion(spark, sf_dir):
    raw = bronze.bronze_rows(_classified(spark, sf_dir))
    return api.medallion(raw, persons(spark, sf_dir), _gold(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


def new_persons(spark, sf_dir):
    from fragloom.streaming.triggers import new_since

    rows = persons(spark, sf_dir)
    return new_since(rows, F.timestamp_seconds(F.lit(X.EPOCH + 6000))).withColumn("n_all", new_since(rows, None).scalar())


def firing_size_quantiles(spark, sf_dir):
    return quantiles(_folded(spark, sf_dir).withColumn("span", F.col("seq") - F.col("first_seq")), "span", [0.5, 0.99])


def maintained_gold(spark, sf_dir):
    from fragloom.plans.jobs import maintain

    return maintain(persons(spark, sf_dir), X.reviews(spark, sf_dir)).gold_persons.select("id", "match_key", "completeness")


QUERIES = {f.__name__: f for f in (
    norm_names, normalized_texts, normalized_keys, salaries, masked, thousands, trigram_similarity, backfilled_names,
    fragment_types, fragment_rejects, bronze_counts, bounded_consume, alias_links, buffer_firings, folded_persons, upserted_persons, fragment_log,
    merge_survivors, merged_persons, manual_merge, manual_merge_trace, review_upsert,
    name_catalog, name_pairs, duplicate_groups, duplicate_totals, gold_duplicate_groups, group_members,
    gold_persons, gold_stats, gold_top_cities, gold_top_companies, gold_completeness, maintained_gold,
    upsert_into_existing, upsert_nulls_only, upsert_rows_sent, bronze_scan, reprocessed_persons, published_gold,
    approved_reviews, gold_stats_answer, assistant_search, metrics_summary,
    persons_page, persons_city, person_lookup, live_stats, live_top_cities, gold_page, match_candidates, groups_page, medallion, new_persons, firing_size_quantiles,
)}
