import pytest
from support import SF
from pyspark.sql import functions as F

from fragloom.observability import Metrics
from fragloom.plans import jobs
from fragloom.plans.queries import LIFETIME_S
from fragloom.sources import bronze, fixtures, kafka
from fragloom.streaming.ingest import Ingest
from fragloom.streaming.triggers import wait_for

PLAIN = ["id", "match_key", "passport", "full_name", "city", "iban", "salary", "norm_name", "updated_at"]


def stream(spark, folder, state, log):
    source = kafka.file_stream(spark, folder)
    job = Ingest(spark, state, lifetime=LIFETIME_S)
    job.start(source, f"{state}/checkpoint", availableNow=True).awaitTermination()
    return job


def test_stream_equals_batch(spark, tmp_path):
    log = fixtures.fragment_stream(spark, SF).where("seq < 900").orderBy("seq").collect()
    whole = spark.createDataFrame(log, "seq bigint, ts timestamp, value string")
    for i in range(3):  # files in order of arrival
        part = whole.where(F.col("seq").between(i * 300, i * 300 + 299)).coalesce(1)
        part.write.parquet(f"{tmp_path}/in/{i}")
        source = next((tmp_path / "in" / str(i)).glob("part-*"))
        (tmp_path / "feed").mkdir(exist_ok=True)
        source.rename(tmp_path / "feed" / f"{i}.parquet")
        job = stream(spark, f"{tmp_path}/feed", f"{tmp_path}/state", log)
    persons, _ = jobs.ingest(whole, LIFETIME_S)
    plain = lambda df: sorted(map(tuple, df.select(*PLAIN).collect()), key=str)
    assert plain(job.persons()) == plain(persons) and persons.count() > 30
    raw = bronze.scan(spark, f"{tmp_path}/state/bronze")
    assert raw.count() == whole.where(fixtures_decodable(whole)).count()
    again, _ = jobs.ingest(raw, LIFETIME_S)
    assert plain(again) == plain(persons)


def fixtures_decodable(df):
    from fragloom.operators.fragments import decode

    return decode(df["value"]).isNotNull()


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    rows = fixtures.fragment_stream(spark, SF).where("seq < 300")
    metrics = Metrics()
    job = Ingest(spark, str(tmp_path), lifetime=LIFETIME_S, metrics=metrics)
    job.batch(rows.where("seq < 150"), 0)
    assert sum(n for (name, _), n in metrics.values.items() if name == "messages_consumed") == rows.where("seq < 150").where(fixtures_decodable(rows)).count()
    assert metrics.values["pending_fragments", ""] > 0
    for _ in range(2):
        job.batch(rows.where("seq >= 150"), 1)
    persons, log = jobs.ingest(rows, LIFETIME_S)
    assert sorted(map(str, job.persons().select(*PLAIN).collect())) == sorted(map(str, persons.select(*PLAIN).collect()))
    assert job.tables["fragment_log"].read().count() == log.count()


@pytest.mark.parametrize("counts,least,fired,polls", [([5], 3, True, 0), ([10, 50, 200], 100, True, 2), ([10], 100, False, 3)])
def test_waiting(counts, least, fired, polls):
    seen, slept = iter(counts + [counts[-1]] * 9), []
    assert wait_for(lambda: next(seen), least, 30, 90, slept.append) is fired
    assert len(slept) == polls


def test_state_lapses(spark, tmp_path):
    """Names and buffers that nothing can wake any more are not carried on."""
    job = Ingest(spark, str(tmp_path), lifetime=60)
    for number in range(6):
        rows = [(100 * number + i, 1_700_000_000 + 1000 * number + i, f'{{"Name":"n{number}{i}","Lastname":"l","Sex":"F","Telfnumber":"6","Passport":"P{number}{i}","E-Mail":"e"}}') for i in range(5)]
        frame = spark.createDataFrame(rows, "seq bigint, t bigint, value string").select("seq", F.timestamp_seconds("t").alias("ts"), "value")
        job.batch(frame, number)
        assert job.tables["aliases"].read().count() == 5 and job.tables["pending"].read().count() == 5
        assert len(job.tables["aliases"].numbers()) <= 3


def test_a_stream_with_lapsing_state_equals_the_batch(spark, tmp_path):
    rows = fixtures.fragment_stream(spark, SF).where("seq < 600")
    job = Ingest(spark, str(tmp_path), lifetime=LIFETIME_S, lateness=LIFETIME_S)
    for number in range(4):
        job.batch(rows.where(f"seq >= {150 * number} and seq < {150 * number + 150}"), number)
    persons, log = jobs.ingest(rows, LIFETIME_S)
    assert sorted(map(str, job.persons().select(*PLAIN).collect())) == sorted(map(str, persons.select(*PLAIN).collect()))
    assert job.tables["fragment_log"].read().count() == log.count()
