import logging

import pytest
from pyspark.sql import functions as F

from fragloom.functions import text as T, trigram
from fragloom.observability import Metrics, Redactor
from fragloom.operators import fragments


def column(spark, values, make, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in frame.withColumn("x", make(F.col("v"))).orderBy("i").select("x").collect()]


def test_keys(spark):
    raw = ["company e-mail", "COMPANY_ADRESS", "Full\tname", "telf-number", " iPv4 ", "", None]
    assert column(spark, raw, T.normalize_key) == ["companyemail", "companyaddress", "fullname", "telfnumber", "ipv4", "", None]


def test_messages_keep_the_last_of_equal_keys(spark):
    out = spark.sql("select map('IP v4', '1', 'Job', 'baker', 'ip_v4', '2', 'IPV-4', '3') as v").select(T.normalize_message(F.col("v")).alias("m")).first().m
    assert out == {"job": "baker", "ipv4": "3"}


#: What is written, and the number in it: one separator is a decimal point, of several the last one is.
AMOUNTS = {"31": 31, "0.125": 0.125, "7,25 kr": 7.25, "£9.876,5": 9876.5, "12,345,678.25": 12345678.25, "-40": -40, "salary: 18": 18, "..": None, "n/a": None, " ": None, "4-4": None, None: None}


def test_salaries(spark):
    assert column(spark, list(AMOUNTS), T.clean_salary) == list(AMOUNTS.values())


def test_texts(spark):
    raw = ["Çağla\u00a0ÖZ", "  tWo \t\n words ", "Ⅷ ½", "", None]
    assert column(spark, raw, T.normalize_text) == ["cagla oz", "two words", "viii 1⁄2", "", ""]


def test_canonical_names(spark):
    raw = ["Mr. Dr. Elías  Núñez", "Prof. Ruth   Okafor PhD", "Wanda", " \t", "", None]
    assert column(spark, raw, T.norm_name) == ["elias nunez", "ruth okafor", "wanda", None, None, None]


def test_titles_come_off_once_at_each_end(spark):
    raw = ["mr. dr. ruth okafor", "ruth okafor jr. phd", "wanda", "dr. wanda jr."]
    assert column(spark, raw, T.strip_titles) == ["dr. ruth okafor", "ruth okafor jr.", "wanda", "wanda"]


def test_masking(spark):
    assert column(spark, ["4929-1177", "four", "x", "", None], T.mask_secret) == ["*****1177", "****", "*", "", ""]
    line = "Passport=ZK009988 paid from GB82WEST12345698765432, ask r.okafor@mail.test or wanda@mail.test"
    (starred,) = column(spark, [line], T.redact)
    assert not any(secret in starred for secret in ("009988", "WEST", "r.okafor", "wanda")) and "GB82" in starred and starred.count("***@masked***") == 2
    record = logging.LogRecord("x", 20, "f", 1, "%s wrote, %d times", ("wanda@mail.test", 2), None)
    assert Redactor().filter(record) and record.getMessage() == "***@masked*** wrote, 2 times"


def test_lists_stand_for_their_first_element(spark):
    raw = ['["one"]', '["one","two","three"]', "[ ]", "plain [text]", "", "[broken", None]
    assert column(spark, raw, T.scalar) == ["one", "one", None, "plain [text]", "", None, None]


def grams(text):
    """Three letters at a time of each word, with two blanks before it and one after."""
    return {padded[i : i + 3] for word in text.lower().split() for padded in [f"  {word} "] for i in range(len(padded) - 2)}


def test_similarity(spark):
    names = ["ruth okafor", "ruth okafour", "okafor ruth", "wanda", "wanda wanda", "elias nunez de la vega", "elias nunez", "q"]
    both = [(x, y) for x in names for y in names]
    frame = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(both)], "i int, a string, b string")
    found = frame.withColumn("s", trigram.similarity(trigram.trigrams(F.col("a")), trigram.trigrams(F.col("b")))).orderBy("i").collect()
    for row in found:
        assert row.s == pytest.approx(len(grams(row.a) & grams(row.b)) / len(grams(row.a) | grams(row.b)), abs=1e-6)


def test_similarity_of_nothing_is_none(spark):
    row = spark.range(1).select(trigram.similarity(trigram.trigrams(F.lit("")), trigram.trigrams(F.lit("--")))).first()
    assert row[0] == 0


MESSAGES = [
    ('{"name":"Ruth","lastname":"Okafor","sex":"F","telfnumber":"0123","passport":"ZK 9","e-mail":"r@mail.test"}', "personal", "passport:zk 9"),
    ('{"PASSPORT":"ZK 9","iban":"GB82","salary":"31"}', "bank", "passport:zk 9"),
    ('{"full name":"Mrs. Wanda  Lee","city":"Lagos","address":"Pier 4"}', "location", "name:wanda lee"),
    ('{"address":"Pier  4","ip_v4":"192.0.2.7"}', "net", "addr:pier 4"),
    ('{"Address":"PIER 4"}', "net", "addr:pier 4"),
    ('{"colour":"red","weight":3}', "unknown", ""),
    ("{}", "unknown", ""),
    ("{broken", None, None),
    ('["a list"]', None, None),
    (None, None, None),
]


def test_classify(spark):
    raw = spark.createDataFrame([(i, m[0]) for i, m in enumerate(MESSAGES)], "seq bigint, value string").withColumn("ts", F.timestamp_seconds("seq"))
    found = fragments.classify(raw).orderBy("seq").collect()
    assert [(r.fragment_type, r.match_key) for r in found] == [m[1:] for m in MESSAGES]
    reasons = {r.seq: r.reason for r in fragments.rejects(fragments.classify(raw)).collect()}
    assert reasons == {5: "unknown", 6: "unknown", 7: "undecodable", 8: "undecodable", 9: "undecodable"}


def test_metrics_text():
    m = Metrics()
    m.count("consumed", 2, 'type="bank"')
    m.gauge("pending", 3)
    m.observe("seconds", 0.2)
    assert 'consumed{type="bank"} 2' in m.text() and "pending 3" in m.text() and 'seconds_bucket{le="0.25"} 1' in m.text()
