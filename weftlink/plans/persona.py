"""A population of persons derived from the customers, the same in Spark and in SQL: the input of the queries over people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.model import MAIDEN_URL, key_columns, person_struct, ssn_identifier
from weftlink.session import table

#: The names of the population.
GIVEN = "WILLIAM BILL KATHERINE KATE ROBERT BOB JOHN J CHRISTOPHER CHRIS MARIA JOSÉ ANA LI OMAR GRACE NOOR PRIYA DAVID DAVE ELIZABETH BETH SAMUEL ZOË".split()
FAMILY = "SMITH SMYTH JONES OBRIEN OBRIEN GARCIA GARCÍA LEE CHEN OKAFOR NUÑEZ NUNEZ MÜLLER MULLER HART HARTE ITO MOREAU BROWN BROWNE DAVIS DAVIES WILSON TAYLOR TAILOR CLARK CLARKE LEWIS WALKER HALL YOUNG KING WRIGHT SCOTT GREEN GREENE BAKER ADAMS NELSON HILL".split()


def _h(salt: str, e: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), e.cast("string"))), 1, 8), 16, 10).cast("bigint")


def persona(spark: SparkSession, sf_dir: str, dealt: int | None = None) -> DataFrame:
    """One flat row per customer; if need be their keys are ``dealt`` out to so many tasks before all else is made of them."""
    k = F.col("k")
    hh = F.floor(k / 3).cast("bigint")
    one = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), (i + 1).cast("int"))
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    phone_of = F.when(_h("shp", k) % 2 == 0, hh).otherwise(k + 1000000)
    ssn = F.concat((F.lit(100) + _h("s1", k) % 500).cast("string"), F.lit("-"), (F.lit(10) + _h("s2", k) % 80).cast("string"), F.lit("-"), (F.lit(1000) + _h("s3", k) % 7000).cast("string"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return (customers.repartition(dealt) if dealt else customers).select(
        k.alias("pid"),
        one(GIVEN, _h("given", k) % 24).alias("given"),
        one(FAMILY, _h("fam", hh) % 40).alias("family"),
        F.date_add(F.lit("1930-01-01").cast("date"), (_h("dob", k) % 1500 * 21).cast("int")).alias("dob"),
        F.when(_h("sex", k) % 50 == 0, "unknown").when(_h("sex", k) % 2 == 0, "female").otherwise("male").alias("gender"),
        pad(F.lit(10001) + _h("zip", hh) % 20, 5).alias("zip"),
        F.concat(pad(F.lit(1) + _h("street", hh) % 80, 2), F.lit(" MAIN ST")).alias("street"),
        F.when(_h("nophone", k) % 10 != 0, F.concat(F.lit("347"), pad(F.lit(2000000) + _h("phone", phone_of) % 4000, 7))).alias("phone"),
        F.when(_h("noemail", k) % 3 != 0, F.concat(F.lit("u"), pad(_h("email", k) % 3000, 4), F.lit("@example.org"))).alias("email"),
        F.when(_h("nossn", k) % 4 == 0, F.lit(None)).when(_h("phssn", k) % 30 == 0, "999-99-9999").otherwise(ssn).alias("ssn"),
    )


def persona_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population with copies of every 25th person that carry one edit each."""
    base = persona(spark, sf_dir)
    e = F.floor(F.col("pid") / 25) % 5
    fam = F.col("family")
    copy = base.where("pid % 25 = 0").select(
        (F.col("pid") + 10000000).alias("pid"),
        F.when(e == 3, F.concat(F.substring("given", 1, 1), F.lit("."))).otherwise(F.col("given")).alias("given"),
        F.when(e == 0, F.expr("substring(family, 1, length(family) - 1)")).when(e == 4, F.concat(F.substring(fam, 2, 1), F.substring(fam, 1, 1), F.expr("substring(family, 3)"))).otherwise(fam).alias("family"),
        F.when(e == 1, F.date_add("dob", 1)).otherwise(F.col("dob")).alias("dob"),
        "gender", "zip", "street", F.when(e != 2, F.col("phone")).alias("phone"), "email", "ssn",
    )
    return base.unionByName(copy)


def as_person(df: DataFrame, *keep: str) -> DataFrame:
    """(ord, pid, person): the nested record of each flat row, with the columns to keep."""
    opt = lambda c, x: F.when(c.isNotNull(), F.array(x))
    null = F.lit(None).cast("string")
    telecom = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(s).alias("system"), F.col(c).alias("value"), F.lit(1).alias("rank"))) for s, c in (("phone", "phone"), ("email", "email"))]))
    person = person_struct(
        id=F.col("pid").cast("string"),
        gender=F.col("gender"),
        birthDate=F.date_format("dob", "yyyy-MM-dd"),
        name=F.array(F.struct(F.lit("official").alias("use"), F.col("family").alias("family"), F.array("given").alias("given"), F.lit(None).cast("array<string>").alias("suffix"), null.alias("text"))),
        telecom=telecom,
        address=F.array(F.struct(F.lit("home").alias("use"), F.array("street").alias("line"), null.alias("city"), null.alias("state"), F.col("zip").alias("postalCode"))),
        identifier=opt(F.col("ssn"), ssn_identifier(F.col("ssn"))),
        extension=F.array(F.struct(F.lit(MAIDEN_URL).alias("url"), F.reverse("family").alias("valueString"))),
    )
    return df.select(F.col("pid").alias("ord"), "pid", person.alias("person"), *keep)


def people(df: DataFrame) -> DataFrame:
    """The flat keys of the population; ``id`` is a number, so that it orders and joins fast."""
    return as_person(df).select("ord", *[c for c in key_columns(F.col("person"))]).withColumn("id", F.col("ord"))


def _names(names: list[str]) -> str:
    return "[" + ",".join(f"'{n}'" for n in names) + "]"


def _hs(salt: str, e: str) -> str:
    return f"CAST(('0x'||substr(md5(concat('{salt}:',CAST({e} AS VARCHAR))),1,8)) AS BIGINT)"


#: The population in SQL: the tables persona and persona_dup as common table expressions.
PERSONA_SQL = f"""persona AS (SELECT k AS pid, {_names(GIVEN)}[{_hs('given', 'k')} % 24 + 1] AS given, {_names(FAMILY)}[{_hs('fam', 'k//3')} % 40 + 1] AS family,
 CAST(DATE '1930-01-01' + CAST({_hs('dob', 'k')} % 1500 * 21 AS INTEGER) AS DATE) AS dob,
 CASE WHEN {_hs('sex', 'k')} % 50 = 0 THEN 'unknown' WHEN {_hs('sex', 'k')} % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
 lpad(CAST(10001 + {_hs('zip', 'k//3')} % 20 AS VARCHAR), 5, '0') AS zip, lpad(CAST(1 + {_hs('street', 'k//3')} % 80 AS VARCHAR), 2, '0') || ' MAIN ST' AS street,
 CASE WHEN {_hs('nophone', 'k')} % 10 <> 0 THEN '347' || lpad(CAST(2000000 + {_hs('phone', f"CASE WHEN {_hs('shp', 'k')} % 2 = 0 THEN k//3 ELSE k + 1000000 END")} % 4000 AS VARCHAR), 7, '0') END AS phone,
 CASE WHEN {_hs('noemail', 'k')} % 3 <> 0 THEN 'u' || lpad(CAST({_hs('email', 'k')} % 3000 AS VARCHAR), 4, '0') || '@example.org' END AS email,
 CASE WHEN {_hs('nossn', 'k')} % 4 = 0 THEN NULL WHEN {_hs('phssn', 'k')} % 30 = 0 THEN '999-99-9999' ELSE (100 + {_hs('s1', 'k')} % 500) || '-' || (10 + {_hs('s2', 'k')} % 80) || '-' || (1000 + {_hs('s3', 'k')} % 7000) END AS ssn
 FROM (SELECT c_custkey AS k FROM customer)),
persona_dup AS (SELECT * FROM persona UNION ALL SELECT pid + 10000000, CASE WHEN e = 3 THEN substr(given,1,1) || '.' ELSE given END,
 CASE WHEN e = 0 THEN substr(family,1,length(family)-1) WHEN e = 4 THEN substr(family,2,1) || substr(family,1,1) || substr(family,3) ELSE family END,
 CASE WHEN e = 1 THEN CAST(dob + 1 AS DATE) ELSE dob END, gender, zip, street, CASE WHEN e <> 2 THEN phone END, email, ssn FROM (SELECT *, (pid // 25) % 5 AS e FROM persona WHERE pid % 25 = 0))"""


def token_sql(c: str) -> str:
    return f"regexp_replace(replace(lower(strip_accents(coalesce({c},''))),'ß','ss'),'[^a-z0-9]','','g')"


SSN_OK = "NOT (d IN ('123456789','987654321','111223333','999999999','000000000') OR length(d) <> 9 OR length(replace(d, substr(d,1,1), '')) = 0 OR substr(d,1,3) IN ('000','666') OR substr(d,1,1) = '9' OR substr(d,4,2) = '00' OR substr(d,6,4) = '0000')"


def keys_sql(name: str, source: str) -> str:
    """A common table expression of flat keys, as ``people`` gives them."""
    return f"""{name} AS (SELECT pid AS id, pid AS ord, {token_sql('given')} AS first, {token_sql('family')} AS family, family AS raw_family, upper(family) AS upper_family, upper(trim(given || ' ' || family)) AS upper_name,
 CAST(dob AS VARCHAR) AS dob, CASE WHEN {SSN_OK} THEN d END AS ssn, phone, email, zip, zip AS nzip, {token_sql('street')} AS street, {token_sql('street')} || '|' || zip AS street_zip, gender,
 {token_sql('given')} || ' ' || {token_sql('family')} AS full_name FROM (SELECT *, regexp_replace(coalesce(ssn,''), '\\D', '', 'g') AS d FROM {source}))"""
