"""Queries of edited records, drift scenarios, tiers and released rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.model import export_ready, violations
from weftlink.operators import drift, mutate
from weftlink.plans import pairs, pools
from weftlink.plans.persona import as_person, persona, persona_dup
from weftlink.queries import sqlx as S
from weftlink.sources import jsonl

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _text(spark: SparkSession, d: str) -> DataFrame:
    return persona(spark, d).withColumn("dob", F.date_format("dob", "yyyy-MM-dd"))


def _one(spark: SparkSession, d: str, value) -> DataFrame:
    return _text(spark, d).select("pid", value.alias("variant"))


_D = lambda n, *p: S.draw(n, "0", *p, "@pid")
_SAFE = "coalesce(strftime(try_cast({y}||'-'||lpad(CAST({m} AS VARCHAR),2,'0')||'-'||lpad(CAST(day(dob) AS VARCHAR),2,'0') AS DATE),'%Y-%m-%d'), {y}||'-'||lpad(CAST({m} AS VARCHAR),2,'0')||'-28')"


@query(S.with_persona(f"SELECT pid, strftime(dob + CAST([-3,-2,-1,1,2,3][{_D(6, 'dob_day')}+1] AS INTEGER), '%Y-%m-%d') AS variant FROM persona"))
def mut_dob_day(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.dob_edit(F.col("dob"), "day", F.col("pid")))


@query(S.with_persona(f"SELECT pid, {_SAFE.format(y='CAST(year(dob) AS VARCHAR)', m='nm')} AS variant FROM (SELECT *, (month(dob)-1+[-2,-1,1,2][{_D(4, 'dob_month')}+1]+12)%12+1 AS nm FROM persona)"))
def mut_dob_month(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.dob_edit(F.col("dob"), "month", F.col("pid")))


@query(S.with_persona(f"SELECT pid, {_SAFE.format(y='CAST(ny AS VARCHAR)', m='month(dob)')} AS variant FROM (SELECT *, year(dob)+[-2,-1,1,2][{_D(4, 'dob_year')}+1] AS ny FROM persona)"))
def mut_dob_year(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.dob_edit(F.col("dob"), "year", F.col("pid")))


@query(S.with_persona("SELECT pid, CASE WHEN day(dob)<=12 THEN year(dob)||'-'||lpad(CAST(day(dob) AS VARCHAR),2,'0')||'-'||lpad(CAST(month(dob) AS VARCHAR),2,'0') ELSE strftime(dob,'%Y-%m-%d') END AS variant FROM persona"))
def mut_dob_swap(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.dob_edit(F.col("dob"), "swap", F.col("pid")))


@query(S.with_persona(f"SELECT pid, coalesce(strftime(try_cast(substr(e,1,4)||'-'||substr(e,5,2)||'-'||substr(e,7,2) AS DATE),'%Y-%m-%d'), strftime(dob,'%Y-%m-%d')) AS variant FROM (SELECT *, substr(x,1,p)||CAST((CAST(substr(x,p+1,1) AS INT)+1+q)%10 AS VARCHAR)||substr(x,p+2) AS e FROM (SELECT *, strftime(dob,'%Y%m%d') AS x, CAST({_D(8, 'dob_typo_at')} AS INT) AS p, CAST({_D(9, 'dob_typo_to')} AS INT) AS q FROM persona))"))
def mut_dob_typo(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.dob_edit(F.col("dob"), "typo", F.col("pid")))


_LEN1 = "greatest(length(family)-1,1)"


@query(S.with_persona(f"SELECT pid, substr(family,1,i-1)||substr(family,i+1,1)||substr(family,i,1)||substr(family,i+2) AS variant FROM (SELECT *, CAST({S.draw(1, '0', 'transpose', '@pid').replace('% 1)', f'% {_LEN1})')} AS INT)+1 AS i FROM persona)"))
def mut_transpose(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.transpose(F.col("family"), F.col("pid")))


@query(S.with_persona(f"SELECT pid, CASE WHEN length(family)<3 THEN family ELSE (SELECT string_agg(c, '' ORDER BY i) FROM (SELECT i, substr(family,i,1) AS c, row_number() OVER (ORDER BY md5('0:drop:'||pid||':'||i)) AS r FROM (SELECT CAST(unnest(range(1, length(family)+1)) AS INT) AS i)) WHERE r>greatest(1, CAST(floor(length(family)*0.2) AS INT))) END AS variant FROM persona"))
def mut_drop_letters(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.drop_letters(F.col("family"), F.col("pid")))


@query(S.with_persona(f"""SELECT pid, CASE WHEN n<3 THEN family WHEN op=0 THEN substr(family,1,g)||l||substr(family,g+1) WHEN op=1 THEN substr(family,1,x)||substr(family,x+2) ELSE substr(family,1,x)||l||substr(family,x+2) END AS variant
 FROM (SELECT *, length(family) AS n, {_D(3, 'typo_op')} AS op, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ',CAST({_D(26, 'typo_letter')} AS INT)+1,1) AS l, CAST({S.draw(1, '0', 'typo_at', '@pid').replace('% 1)', '% length(family))')} AS INT) AS x, CAST({S.draw(1, '0', 'typo_at', '@pid').replace('% 1)', '% (length(family)+1))')} AS INT) AS g FROM persona)"""))
def mut_typo(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.typo(F.col("family"), F.col("pid")))


@query(S.with_persona("SELECT pid, substr(given,1,1)||'.' AS variant FROM persona"))
def mut_abbreviate(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.abbreviate(F.col("given")))


_SHORT = """CASE lower(given) WHEN 'william' THEN ['Bill','Billy','Liam','Will','Willie'] WHEN 'katherine' THEN ['Kate','Kathy','Katie','Kit','Kitty'] WHEN 'robert' THEN ['Bob','Bobby','Rob','Robbie']
 WHEN 'john' THEN ['Jack','Johnny'] WHEN 'christopher' THEN ['Chris','Kit','Topher'] WHEN 'david' THEN ['Dave','Davy'] WHEN 'elizabeth' THEN ['Beth','Betty','Eliza','Libby','Liz','Lizzie'] WHEN 'samuel' THEN ['Sam','Sammy'] END"""
_BIG = "CAST(('0x'||substr({},1,8)) AS BIGINT)"


@query(S.with_persona(f"SELECT pid, coalesce(forms[{_BIG.format(S.digest('0', 'nickname', '@pid'))}%len(forms)+1], given) AS variant FROM (SELECT pid, given, {_SHORT} AS forms FROM persona)"))
def mut_nickname(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.nickname(F.col("given"), F.col("pid")))


@query(S.with_persona(f"SELECT pid, CASE WHEN length(given)<2 THEN given ELSE substr(given,1,g)||['-','''','.','  '][{_D(4, 'mark')}+1]||substr(given,g+1) END AS variant FROM (SELECT *, CAST({S.draw(1, '0', 'mark_at', '@pid').replace('% 1)', '% greatest(length(given)-1,1))')} AS INT)+1 AS g FROM persona)"))
def var_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.punctuation(F.col("given"), F.col("pid")))


@query(S.with_persona(f"SELECT pid, CASE WHEN len(spots)=0 THEN given ELSE substr(given,1,p-1)||translate(lower(substr(given,p,1)),'aeiounc','áéíóúñç')||substr(given,p+1) END AS variant FROM (SELECT *, coalesce(spots[{_BIG.format(S.digest('0', 'diacritic', '@pid'))}%greatest(len(spots),1)+1],1) AS p FROM (SELECT pid, given, list_filter(list_transform(range(1,length(given)+1), lambda i: CAST(i AS INT)), lambda i: lower(substr(given,i,1)) IN ('a','e','i','o','u','n','c')) AS spots FROM persona))"))
def var_diacritic(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, mutate.diacritic(F.col("given"), F.col("pid")))


@query(S.with_persona(f"""SELECT pid, CASE WHEN ssn IS NOT NULL THEN ['000-00-0000','999-99-9999','123-45-6789','111-11-1111'][{_D(4, 'dummy_ssn')}+1] END AS ssn,
 CASE WHEN phone IS NOT NULL THEN ['000-000-0000','555-555-5555','999-999-9999'][{_D(3, 'dummy_phone')}+1] END AS phone, ['UNKNOWN','BABY BOY','BABY GIRL'][{_D(3, 'dummy_given')}+1] AS given,
 ['HOMELESS','UNKNOWN'][{_D(2, 'dummy_address')}+1] AS line, ['1900-01-01','1901-01-01'][{_D(2, 'dummy_dob')}+1] AS dob FROM persona"""))
def apply_placeholder(spark: SparkSession, d: str) -> DataFrame:
    """The dummy value that each field of each person would get; null where the field is absent."""
    put = {f: drift.apply_dummy(F.col("person"), f, mutate.dummy(f, F.col("pid"))) for f in mutate.DUMMIES}
    made = as_person(persona(spark, d)).select("pid", *[v.alias(f"p_{f}") for f, v in put.items()])
    phone = F.get(F.filter("p_phone.telecom", lambda t: t["system"] == "phone"), F.lit(0))["value"]
    return made.select("pid", F.get("p_ssn.identifier", F.lit(0))["value"].alias("ssn"), phone.alias("phone"), F.get(F.get("p_given.name", F.lit(0))["given"], F.lit(0)).alias("given"), F.get(F.get("p_address.address", F.lit(0))["line"], F.lit(0)).alias("line"), F.col("p_dob.birthDate").alias("dob"))


@query(S.with_persona("SELECT pid, ssn IS NOT NULL AS applies FROM persona"))
def ssn_dropped(spark: SparkSession, d: str) -> DataFrame:
    return as_person(persona(spark, d)).select("pid", drift.drop_ssn(F.col("person")).isNotNull().alias("applies"))


@query(S.with_persona(f"SELECT pid, CASE gender WHEN 'male' THEN ['female','unknown'] WHEN 'female' THEN ['male','unknown'] WHEN 'unknown' THEN ['male','female'] END[{_D(2, 'gender')}+1] AS gender FROM persona"))
def gender_drift(spark: SparkSession, d: str) -> DataFrame:
    return as_person(persona(spark, d)).select("pid", drift.gender_drift(F.col("person"), F.col("pid"))["gender"].alias("gender"))


@query()
def mut_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    return mutate.fuzzy(_text(spark, d)).select("pid", "given", "family", "dob", "mutation")


@query()
def mut_compound(spark: SparkSession, d: str) -> DataFrame:
    return mutate.compound(_text(spark, d)).select("pid", "given", "family", "dob", "mutations")


@query()
def drift_yield(spark: SparkSession, d: str) -> DataFrame:
    base = as_person(persona(spark, d)).select("pid", "person")
    return drift.variant_counts(base, base)


@query()
def pair_tier(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_tier(persona(spark, d))


@query(S.with_persona("SELECT pid, substr(sha256(CAST(pid AS VARCHAR)),1,16) AS plain, substr(sha256('candidate:'||pid),1,16) AS hidden FROM persona"))
def opaque_ids(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.functions.norm import opaque_id

    who = F.col("pid").cast("string")
    return persona(spark, d).select("pid", opaque_id(who).alias("plain"), opaque_id(who, "candidate").alias("hidden"))


@query("SELECT case_id, regexp_extract(rationale, '^([^/ (]*)', 1) AS category FROM labeled_cases")
def rationale_category(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.session import table

    return table(spark, d, "labeled_cases").select("case_id", jsonl.category_of(F.col("rationale")).alias("category"))


@query("""SELECT case_id, coalesce(strata['pair_type'],'')||CASE WHEN sub IS NULL THEN '' ELSE '/'||sub END||CASE WHEN r='' THEN '' ELSE ' ('||r||')' END AS rationale FROM (
 SELECT case_id, strata, coalesce(nullif(strata['mutation'],''),nullif(strata['case'],''),nullif(strata['category'],'')) AS sub,
 array_to_string(list_sort(list_transform(list_filter(map_entries(strata), lambda e: e.key NOT IN ('pair_type','mutation','case','category') AND e.value IS NOT NULL AND e.value<>''), lambda e: e.key||'='||e.value)), ', ') AS r FROM labeled_cases WHERE strata IS NOT NULL)""")
def rationale_format(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.session import table

    return table(spark, d, "labeled_cases").where("strata is not null").select("case_id", jsonl.rationale_of(F.col("strata")).alias("rationale"))


@query("""SELECT case_id, coalesce(w, 1.0)::DOUBLE AS frequency FROM (SELECT case_id, regexp_extract(rationale, '^([^/ (]*)', 1) AS c FROM labeled_cases) LEFT JOIN (VALUES ('fuzzy_variant',CAST(0.25 AS DOUBLE)),('phone_churn',0.5)) t(c,w) USING (c)""")
def frequency_lookup(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.session import table

    weights = spark.createDataFrame([("fuzzy_variant", 0.25), ("phone_churn", 0.5)], "category string, weight double")
    return jsonl.with_frequency(table(spark, d, "labeled_cases").select("case_id", "rationale"), weights).select("case_id", "frequency")


@query("SELECT case_id, expected_match, frequency, substr(sha256(source.id),1,16) AS source_id, substr(sha256(case_id||':target'),1,16) AS target_id, nullif(source.birthDate,'') AS source_dob, nullif(target.name[1].family,'') AS target_family FROM labeled_cases WHERE source IS NOT NULL AND target IS NOT NULL")
def pair_rows(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.session import table

    rows = jsonl.pair_rows(table(spark, d, "labeled_cases").where("source is not null and target is not null"))
    return rows.select("case_id", "expected_match", "frequency", F.col("source.id").alias("source_id"), F.col("target.id").alias("target_id"), F.col("source.birthDate").alias("source_dob"), F.get("target.name", F.lit(0))["family"].alias("target_family"))


@query(S.with_persona("SELECT substr(sha256('candidate:'||pid),1,16) AS id, substr(sha256('candidate:'||pid),1,16) AS patient_id, family, CAST(dob AS VARCHAR) AS dob, phone FROM persona_dup"))
def candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    base = as_person(persona_dup(spark, d)).select(F.col("pid").cast("string").alias("candidate_id"), F.col("person").alias("patient"))
    phone = F.get(F.filter("patient.telecom", lambda t: t["system"] == "phone"), F.lit(0))["value"]
    return jsonl.candidate_rows(base).select("id", F.col("patient.id").alias("patient_id"), F.get("patient.name", F.lit(0))["family"].alias("family"), F.col("patient.birthDate").alias("dob"), phone.alias("phone"))


@query()
def query_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = jsonl.query_rows(pools.with_query(pools.pools(persona_dup(spark, d)), persona(spark, d)))
    return rows.select("query_id", F.to_json("query").alias("query"), F.array_join("candidate_ids", ",").alias("candidate_ids"), F.array_join("expected_match_ids", ",").alias("expected_match_ids"), "rationale")


@query("SELECT internal_id, string_agg(t.system||'#'||coalesce(CAST(CASE WHEN t.rank IS NOT NULL THEN len(list_filter(list_slice(tel,1,CAST(i AS INT)), lambda y: y.system=t.system AND y.rank IS NOT NULL)) END AS VARCHAR),'-'), ',' ORDER BY i) AS ranks FROM (SELECT internal_id, tel, i, tel[i] AS t FROM (SELECT DISTINCT internal_id, target.telecom AS tel FROM internal_records WHERE target IS NOT NULL), range(1,40) r(i) WHERE i<=len(tel)) GROUP BY internal_id")
def telecom_rank(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.model import renumber
    from weftlink.session import table

    rows = table(spark, d, "internal_records").where("size(target.telecom) > 0").select("internal_id", "target.telecom").distinct()
    said = F.transform(renumber(F.col("telecom")), lambda t: F.concat_ws("#", t["system"], F.coalesce(t["rank"].cast("string"), F.lit("-"))))
    return rows.select("internal_id", F.array_join(said, ",").alias("ranks"))


@query()
def conformance(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.session import table

    rows = table(spark, d, "outside_records").where("source is not null").select(F.explode(violations(F.col("source"))).alias("violation"))
    return rows.groupBy("violation").agg(F.count("*").alias("n"))


@query()
def conformance_raw(spark: SparkSession, d: str) -> DataFrame:
    """Structural problems of the persons that raw payloads hold as they stand."""
    from weftlink.model import PERSON
    from weftlink.session import table

    rows = table(spark, d, "raw_records").select(F.from_json("payload", PERSON).alias("p")).where("p.name is not null or p.telecom is not null or p.identifier is not null")
    return rows.select(F.explode(violations(F.col("p"))).alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))


@query("""SELECT internal_id, nullif(target.gender,'') AS gender, nullif(target.birthDate,'') AS dob, len(list_filter(target.telecom, lambda t: coalesce(t.system,'')<>'' OR coalesce(t.value,'')<>'' OR t.rank IS NOT NULL)) AS n_telecom,
 nullif(target.address[1].city,'') AS city FROM internal_records""")
def export_ready_people(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.session import table

    made = table(spark, d, "internal_records").select("internal_id", export_ready(F.col("target")).alias("p"))
    return made.select("internal_id", "p.gender", F.col("p.birthDate").alias("dob"), F.when(F.col("p.telecom").isNotNull(), F.size("p.telecom")).alias("n_telecom"), F.get("p.address", F.lit(0))["city"].alias("city"))


@query(S.with_persona("SELECT pid, upper(given) AS given, phone FROM persona"))
def csv_to_person(spark: SparkSession, d: str) -> DataFrame:
    from weftlink.sources.csv import to_person

    flat = persona(spark, d).select("pid", F.col("pid").cast("string").alias("EnterpriseID"), F.col("family").alias("LAST"), F.concat(F.lit(" "), F.upper("given"), F.lit(" ")).alias("FIRST"), F.lit("8476").alias("DOB"), F.col("gender").alias("GENDER"), F.col("ssn").alias("SSN"), F.col("street").alias("ADDRESS1"), F.col("zip").alias("ZIP"), F.col("phone").alias("PHONE"), F.lit("").alias("EMAIL"))
    return to_person(flat).select("pid", F.get(F.get("person.name", F.lit(0))["given"], F.lit(0)).alias("given"), F.get("person.telecom", F.lit(0))["value"].alias("phone"))
