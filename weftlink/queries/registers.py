"""The miners and guards over the nested records of the internal register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions.guard import a, b
from weftlink.model import key_columns
from weftlink.operators import mine
from weftlink.queries.sqlx import NICK
from weftlink.session import cut, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_TOKEN = "regexp_replace(replace(lower(strip_accents(coalesce({},''))),'ß','ss'),'[^a-z0-9]','','g')"


def _token(c: str) -> str:
    return _TOKEN.format(c)


_USABLE = "NOT (d IN ('123456789','987654321','111223333','999999999','000000000') OR length(d) <> 9 OR length(replace(d, substr(d,1,1), '')) = 0 OR substr(d,1,3) IN ('000','666') OR substr(d,1,1) = '9' OR substr(d,4,2) = '00' OR substr(d,6,4) = '0000')"
_NUMBER = "regexp_replace(coalesce(x.value,''),'\\D','','g')"
_PHONE = f"CASE WHEN length({_NUMBER})=11 AND substr({_NUMBER},1,1)='1' THEN substr({_NUMBER},2) ELSE {_NUMBER} END"
#: The flat keys of the register's people in SQL, written on their own: names, date, number, phones, place.
_KEYS = f"""WITH once AS (SELECT internal_id AS id, target AS t FROM internal_records WHERE target IS NOT NULL AND internal_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY internal_id ORDER BY received_at, CAST(target AS VARCHAR)) = 1),
k AS (SELECT id, {_token('t.name[1].given[1]')} AS first, {_token('t.name[1].family')} AS family, upper(coalesce(t.name[1].family,'')) AS upper_family, coalesce(t.birthDate,'') AS dob, coalesce(t.address[1].postalCode,'') AS zip,
 list_filter(list_transform(list_filter(coalesce(t.telecom,[]), lambda x: x.system='phone'), lambda x: {_PHONE}), lambda v: length(v)=10) AS phones,
 list_filter(list_transform(list_filter(coalesce(t.identifier,[]), lambda x: x.system='http://hl7.org/fhir/sid/us-ssn'), lambda x: regexp_replace(coalesce(x.value,''),'\\D','','g')), lambda d: {_USABLE})[1] AS ssn,
 try_cast(substr(coalesce(t.birthDate,''),1,4) AS INT) AS yr FROM once)"""
_SAME = "(coalesce(a.ssn=b.ssn,false) OR (a.first=b.first AND a.first<>'' AND a.family=b.family AND a.family<>'' AND a.dob=b.dob AND a.dob<>''))"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _people(spark: SparkSession, d: str) -> DataFrame:
    """The register's people by their first delivery, as flat keys; ``id`` and ``ord`` are the register's numbers."""
    rows = table(spark, d, "internal_records").where("target is not null and internal_id is not null").select("internal_id", "received_at", "target")
    first = rows.groupBy("internal_id").agg(F.min_by("target", F.struct(F.col("received_at").isNull().alias("n"), F.col("received_at").alias("r"), F.to_json("target").alias("j"))).alias("target"))
    return first.select(F.col("internal_id").alias("ord"), F.col("internal_id").alias("_id"), *key_columns(F.col("target"))).withColumn("id", F.col("_id")).drop("_id")


def _ids(df: DataFrame) -> DataFrame:
    return df.select(a("id").alias("id_a"), b("id").alias("id_b"))


@query(_KEYS + " SELECT id, first, family, dob, zip, ssn, array_to_string(list_sort(list_distinct(phones)), ',') AS phones FROM k")
def register_keys(spark: SparkSession, d: str) -> DataFrame:
    return _people(spark, d).select("id", "first", "family", "dob", "zip", "ssn", F.array_join("phones", ",").alias("phones"))


@query(_KEYS + f" SELECT a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.id<b.id AND a.ssn=b.ssn UNION SELECT a.id, b.id FROM k a JOIN k b ON a.id<b.id AND a.first=b.first AND a.family=b.family AND a.dob=b.dob AND {_SAME}")
def register_same_person(spark: SparkSession, d: str) -> DataFrame:
    k = _people(spark, d)
    return mine.same_person_ids(k, k).where("probe_id < id").select(F.col("probe_id").alias("id_a"), F.col("id").alias("id_b"))


_SWAP = "(length(a.dob)=10 AND length(b.dob)=10 AND substr(a.dob,5,1)='-' AND substr(a.dob,8,1)='-' AND substr(b.dob,5,1)='-' AND substr(b.dob,8,1)='-' AND substr(a.dob,1,4)=substr(b.dob,1,4) AND substr(a.dob,6,2)=substr(b.dob,9,2) AND substr(a.dob,9,2)=substr(b.dob,6,2))"
_CLOSE = f"(a.dob<>'' AND b.dob<>'' AND (levenshtein(a.dob,b.dob)<=1 OR {_SWAP}))"


@query(_KEYS + f""" SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.id<b.id AND abs(length(a.dob)-length(b.dob))<=1 AND (substr(a.dob,1,4)=substr(b.dob,1,4) OR right(a.dob,5)=right(b.dob,5))
 AND {_CLOSE} AND list_has_any(a.phones,b.phones)""")
def register_shared_phone(spark: SparkSession, d: str) -> DataFrame:
    """People with a phone in common and birth dates that are one slip apart."""
    from weftlink.functions import norm as N
    from weftlink.functions.guard import side

    k = _people(spark, d)
    keys = lambda s: k.select(F.col("id").alias(s), F.explode("phones").alias("key"))
    met = keys("x").join(keys("y"), "key").where("x < y").select("x", "y").distinct()
    pairs = met.join(side(k, "a"), F.col("x") == a("id")).join(side(k, "b"), F.col("y") == b("id"))
    return _ids(pairs.where(N.dates_close(a("dob"), b("dob"))))


_NEAR_SSN = "coalesce(levenshtein(a.ssn,b.ssn)<=1,false)"


@query(_KEYS + f" SELECT a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.id<b.id AND a.ssn IS NOT NULL AND b.ssn IS NOT NULL AND {_NEAR_SSN}")
def register_near_ssn(spark: SparkSession, d: str) -> DataFrame:
    """People whose numbers are one slip apart, met on deletion keys."""
    from weftlink.functions import norm as N

    n = _people(spark, d).where("ssn is not null").select("id", "ssn", F.explode(N.near_keys(F.col("ssn"))).alias("key"))
    x, y = n.select("key", F.col("id").alias("id_a"), F.col("ssn").alias("s1")), n.select("key", F.col("id").alias("id_b"), F.col("ssn").alias("s2"))
    return x.join(y, "key").where((F.col("id_a") < F.col("id_b")) & N.within(F.col("s1"), F.col("s2"), 1)).select("id_a", "id_b").distinct()


@query(_KEYS + " SELECT upper_family AS family, zip, count(*) AS n, count(*) FILTER (WHERE yr IS NOT NULL AND 2017-yr<18) AS minors FROM k WHERE upper_family<>'' AND zip<>'' GROUP BY 1, 2 HAVING count(*)>1")
def register_family_places(spark: SparkSession, d: str) -> DataFrame:
    """Families of a place: the blocks in which siblings and households are searched."""
    from weftlink.functions import norm as N

    year = N.birth_year(F.col("dob"))
    k = _people(spark, d).where("upper_family <> '' and zip <> ''")
    return k.groupBy(F.col("upper_family").alias("family"), "zip").agg(F.count("*").alias("n"), F.count_if(year.isNotNull() & (F.lit(2017) - year < 18)).alias("minors")).where("n > 1")


_VARIANT = f"(a.first<>'' AND b.first<>'' AND (starts_with(a.first,b.first) OR starts_with(b.first,a.first) OR a.first||'|'||b.first IN {NICK}))"
_DUP = f"""({_NEAR_SSN} OR ({_CLOSE} AND (list_has_any(a.phones,b.phones) OR (a.first=b.first AND a.first<>'' AND a.dob=b.dob) OR (a.family=b.family AND a.family<>'' AND a.dob=b.dob AND {_VARIANT})
 OR (a.first<>'' AND b.first<>'' AND a.family<>'' AND b.family<>'' AND levenshtein(a.first||' '||a.family,b.first||' '||b.family)<=1))))"""


@query(_KEYS + f" SELECT a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.id<b.id AND a.zip=b.zip AND a.zip<>'' AND a.upper_family=b.upper_family AND a.upper_family<>'' AND a.dob<>'' AND b.dob<>'' AND a.first<>b.first AND abs(a.yr-b.yr)<=3 AND NOT ({_SAME} OR {_DUP})")
def register_siblings(spark: SparkSession, d: str) -> DataFrame:
    return _ids(mine.siblings(_people(spark, d)))


@query()
def register_near_misses(spark: SparkSession, d: str) -> DataFrame:
    """Look-alikes of every hundredth record among all of them, by kind."""
    k = cut(_people(spark, d))  # read several times
    return mine.near_misses(k.where("id % 100 = 0"), k).select(a("id").alias("qid"), b("id").alias("rid"), "kind", "rank", "seen")


@query(_KEYS + f" SELECT a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.id<b.id AND {_DUP}")
def register_duplicates(spark: SparkSession, d: str) -> DataFrame:
    k = cut(_people(spark, d))  # read four times: else each read reduces the deliveries again, in one plan
    return mine.duplicate_ids(k, k).where("probe_id < id").select(F.col("probe_id").alias("id_a"), F.col("id").alias("id_b"))
