"""Stand-ins on the driver's tables: persons, reviews and a fragment stream.

The SQL runs unchanged in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fragloom.functions.text import norm_name
from fragloom.operators.schema import FIELDS
from fragloom.operators.upsert import COLUMNS

#: Start of the stand-in persons' clock, in seconds.
EPOCH = 1_704_067_200

PERSONS = """
select cast(p_partkey as bigint) as id,
 concat(case when p_partkey%3=0 then 'name:k' else 'passport:k' end, cast(p_partkey as string)) as match_key,
 case when p_partkey%3<>0 then concat('P',cast(p_partkey%700 as string)) end as passport,
 case when p_partkey%35=4 then 'Juan Ignacio'
      when p_partkey%5=0 then concat(b,' ',w)
      when p_partkey%5=1 then concat('Dr. ',upper(b),'  ',w)
      when p_partkey%5=2 then concat(b,' ',w,' ',lower(p_type))
      when p_partkey%5=3 then concat(b,' ',w,'s')
      else concat(b,' md') end as full_name,
 case when p_partkey%2=0 then p_brand end as city,
 case when p_partkey%4<>1 then p_type end as company,
 case when p_partkey%7<>2 then lower(p_type) end as job,
 case when p_partkey%6<>5 then concat('u',cast(p_partkey as string),'@x.com') end as email,
 case when p_partkey%9<>8 then concat('ES',cast(p_partkey as string)) end as iban,
 case when p_partkey%10<>7 then concat('6',cast(p_partkey as string)) end as phone,
 case when p_partkey%11<>3 then '10.0.0.1' end as ipv4,
 p_retailprice as salary
from (select *, concat(split_part(p_name,' ',1),cast(p_size as string)) as b,
             split_part(p_name,' ',2) as w from part) x
"""

REVIEWS = """
select match_key, case when id%97=0 then 'approved' else 'merged' end as status
from persons where id%97=0 or id%101=0
"""

FRAGMENTS = """
select cast(event_id as bigint) as seq, ts,
 case when event_id%97=5 then 'not json'
      when event_id%89=3 then '{"foo":"1","bar":"2"}'
      when event_id%83=7 then '{"Telfnumber":"600","Sex":"F","Name":"","Lastname":" "}'
      when event_type='click' then concat('{"Name":"',n,'","Lastname":"',l,'","Sex":"F","Telfnumber":"6',u,'","Passport":" P',u,' ","E-Mail":"',u,'@x.com"}')
      when event_type='error' then concat('{"Address":"Calle ',u,'","IPv4":"10.0.0.',u,'"}')
      when event_type='purchase' then concat('{"Passport":"p',u,'","IBAN":"ES',u,'","Salary":"',case when event_id%2=0 then '1.500,75' else concat('$',u,',250.50') end,'"}')
      when event_type='signup' then concat('{"Fullname":"Dr. ',n,'  ',l,'","City":"',case when event_id%3=0 then '' else concat('City ',n) end,'","Address":"Calle ',u,'"}')
      else concat('{"Full Name":"',upper(n),' ',l,' Jr","COMPANY":"ACME ',n,'","Company Adress":"Av ',u,'","company_telfnumber":"900","Company E-Mail":"hr@acme.com","Job":"Engineer"}') end as value
from (select *, cast(user_id as string) as u, concat('José', cast(user_id%40 as string)) as n, concat('Muñoz', cast(user_id as string)) as l from events) x
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons with all columns of the table, made from ``part``."""
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    rows = spark.sql(PERSONS)
    blank = {f: F.lit(None).cast("string") for f in FIELDS if f not in rows.columns}
    times = {"created_at": F.timestamp_seconds(EPOCH + F.col("id") * 60), "updated_at": F.timestamp_seconds(EPOCH + F.col("id") * 90)}
    return rows.withColumns(blank | times | {"norm_name": norm_name(F.col("full_name"))}).select(*COLUMNS)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match_key, status, survivor_match_key, note."""
    persons(spark, sf_dir).createOrReplaceTempView("persons")
    return spark.sql(REVIEWS).withColumns({"survivor_match_key": F.lit(None).cast("string"), "note": F.lit(None).cast("string")})


def fragment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, ts, value: an arrival log of raw messages, made from ``events``."""
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    log = spark.sql(FRAGMENTS).withColumn("ts", F.col("ts").cast("timestamp"))
    return log.repartition(spark.sparkContext.defaultParallelism, "seq")  # one file, but a topic has partitions
