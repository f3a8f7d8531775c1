"""Queries of rule evaluation, sampling and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import guard as G
from weftlink.functions import norm as N
from weftlink.functions.guard import a, b
from weftlink.operators import audit, evaluate, mine, sample
from weftlink.plans import dataset, households, pools
from weftlink.plans.pairs import labelled_keys
from weftlink.plans.persona import as_person, people, persona, persona_dup
from weftlink.queries import sqlx as S
from weftlink.session import by_sort, shared_folder, stored, table
from weftlink.sources import jsonl

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Labelled pairs in SQL: one family and ZIP; a match is a person's copy.
_LABELLED = f"lab AS (SELECT a.id AS id_a, b.id AS id_b, a.gender AS gender, {S.digest('@a.id', '@b.id')} AS id, b.id=a.id+10000000 AS label, {S.FEATURES} FROM k a JOIN k b ON a.id<b.id AND a.family=b.family AND a.zip=b.zip), sc AS (SELECT *, 4*CAST(ssn AS INT)+3*CAST(name_dob AS INT)+2*CAST(dob AS INT)+2*CAST(given AS INT)+2*CAST(family AS INT)+CAST(address AS INT)+CAST(phone AS INT)+CAST(email AS INT)>=6 AS multi_field FROM lab)"
_RATES = "round(tp/nullif(tp+fn,0)::DOUBLE,6) AS tpr, round(fn/nullif(tp+fn,0)::DOUBLE,6) AS fnr, round(fp/nullif(fp+tn,0)::DOUBLE,6) AS fpr, round(tp/nullif(tp+fp,0)::DOUBLE,6) AS \"precision\", CASE WHEN tp>0 THEN round(2*tp/(2*tp+fp+fn)::DOUBLE,6) END AS f1"
_COUNTS = "count(*) FILTER (WHERE p AND label) AS tp, count(*) FILTER (WHERE p AND NOT label) AS fp, count(*) FILTER (WHERE NOT p AND label) AS fn, count(*) FILTER (WHERE NOT p AND NOT label) AS tn"


def _sql(body: str, more: str = "") -> str:
    return S.with_people(body, True, _LABELLED + (more and ", " + more))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    df = labelled_keys(persona_dup(spark, d))
    df = df.select("id", "label", a("id").alias("id_a"), b("id").alias("id_b"), a("gender").alias("gender"), *[c.alias(n) for n, c in G.features().items()])
    return df.withColumns(G.baselines())


def _nulls(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c, t in df.dtypes if t == "double"})


_BASE = ("phone", "email", "ssn", "dob", "name_dob", "address")


@query(_sql(f"SELECT matcher, tp, fp, fn, tn, {_RATES} FROM (SELECT matcher, {_COUNTS} FROM m GROUP BY matcher)", "m AS (" + " UNION ALL ".join(f"SELECT '{n}_only' AS matcher, {n} AS p, label FROM sc" for n in _BASE) + " UNION ALL SELECT 'multi_field', multi_field, label FROM sc)"))
def baseline_quality(spark: SparkSession, d: str) -> DataFrame:
    names = [f"{n}_only" for n in _BASE] + ["multi_field"]
    long = _labelled(spark, d).select("label", F.explode(F.array(*[F.struct(F.lit(n).alias("matcher"), F.col(n).alias("p")) for n in names])).alias("m")).select("label", "m.*")
    return _nulls(evaluate.quality(evaluate.confusion(long, F.col("p"), F.col("label"), ("matcher",))))


@query(_sql(f"SELECT gender, tp, fp, fn, tn, {_RATES} FROM (SELECT gender, {_COUNTS} FROM (SELECT *, multi_field AS p FROM sc) GROUP BY gender)"))
def confusion_by_slice(spark: SparkSession, d: str) -> DataFrame:
    return _nulls(evaluate.quality(evaluate.confusion(_labelled(spark, d), F.col("multi_field"), F.col("label"), ("gender",))))


@query(_sql('SELECT count(*) FILTER (WHERE name_dob AND multi_field) AS "both", count(*) FILTER (WHERE name_dob AND NOT multi_field) AS lost, count(*) FILTER (WHERE NOT name_dob AND multi_field) AS gained, count(*) FILTER (WHERE NOT name_dob AND NOT multi_field) AS neither FROM sc WHERE label'))
def paired_recall(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.paired(_labelled(spark, d), F.col("name_dob_only"), F.col("multi_field"), F.col("label"))


@query(_sql(f"SELECT fold, tp, fp, fn, tn, {_RATES} FROM (SELECT fold, {_COUNTS} FROM (SELECT *, multi_field AS p, ntile(5) OVER (ORDER BY substr({S.digest('0', 'fold', '@id')},1,15), id) AS fold FROM sc) GROUP BY fold)"))
def kfold_f1(spark: SparkSession, d: str) -> DataFrame:
    folded = sample.folds(_labelled(spark, d), 5)
    return _nulls(evaluate.quality(evaluate.confusion(folded, F.col("multi_field"), F.col("label"), ("fold",))))


@query(_sql(f"SELECT label, gender, count(*) FILTER (WHERE rn<=ceil(n*0.7)) AS n_holdout, count(*) FILTER (WHERE rn>ceil(n*0.7)) AS n_rest, min(id) FILTER (WHERE rn<=ceil(n*0.7)) AS first_holdout FROM (SELECT *, row_number() OVER (PARTITION BY label, gender ORDER BY substr({S.digest('0', 'split', '@id')},1,15), id) AS rn, count(*) OVER (PARTITION BY label, gender) AS n FROM sc) GROUP BY label, gender"))
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    split = sample.stratified_split(_labelled(spark, d), ["label", "gender"])
    return split.groupBy("label", "gender").agg(F.count_if("holdout").alias("n_holdout"), F.count_if(~F.col("holdout")).alias("n_rest"), F.min(F.when(F.col("holdout"), F.col("id"))).alias("first_holdout"))


@query(_sql("SELECT round((tp+1)/(tp+fn+2)::DOUBLE,6) AS recall_mean, round((fp+1)/(fp+tn+2)::DOUBLE,6) AS fpr_mean FROM (SELECT count(*) FILTER (WHERE multi_field AND label) AS tp, count(*) FILTER (WHERE multi_field AND NOT label) AS fp, count(*) FILTER (WHERE NOT multi_field AND label) AS fn, count(*) FILTER (WHERE NOT multi_field AND NOT label) AS tn FROM sc)"))
def posterior_mean(spark: SparkSession, d: str) -> DataFrame:
    c = evaluate.confusion(_labelled(spark, d), F.col("multi_field"), F.col("label"))
    return c.select(F.round((F.col("tp") + 1) / (F.col("tp") + F.col("fn") + 2), 6).alias("recall_mean"), F.round((F.col("fp") + 1) / (F.col("fp") + F.col("tn") + 2), 6).alias("fpr_mean"))


@query()
def rule_comparison(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.compare(_labelled(spark, d), F.col("name_dob_only"), F.col("multi_field"), F.col("label"))


@query(_sql(f"SELECT 'tpr' AS metric, count(tpr) AS n_folds, round(avg(tpr),6) AS mean, round(coalesce(stddev_pop(tpr),0),6) AS std FROM (SELECT {_RATES} FROM (SELECT fold, {_COUNTS} FROM (SELECT *, multi_field AS p, ntile(5) OVER (ORDER BY substr({S.digest('0', 'fold', '@id')},1,15), id) AS fold FROM sc) GROUP BY fold))"))
def kfold_spread(spark: SparkSession, d: str) -> DataFrame:
    """Mean and deviation of recall over five folds."""
    return evaluate.fold_spread(kfold_f1(spark, d))


@query(_sql("SELECT lost, gained, round((gained-lost)/n::DOUBLE,6) AS net_change, lost+gained AS churn FROM (SELECT count(*) FILTER (WHERE name_dob AND NOT multi_field) AS lost, count(*) FILTER (WHERE NOT name_dob AND multi_field) AS gained, count(*) AS n FROM sc WHERE label)"))
def paired_change(spark: SparkSession, d: str) -> DataFrame:
    row = paired_recall(spark, d).first()
    p = evaluate.Paired(row["both"], row["lost"], row["gained"], row["neither"])
    return spark.createDataFrame([(p.lost, p.gained, round(p.net_change, 6), p.churn)], "lost long, gained long, net_change double, churn long")


@query()
def comparison_text(spark: SparkSession, d: str) -> DataFrame:
    """The comparison of two matchers as lines of text."""
    c = evaluate.comparison(_labelled(spark, d), F.col("name_dob_only"), F.col("multi_field"), F.col("label"))
    return spark.createDataFrame(list(enumerate(evaluate.format_report(c, "name and date", "weighted").split("\n"))), "line int, text string")


@query(_sql("SELECT lost, gained, round(least(1.0, 2*(SELECT sum(exp(lgamma(lost+gained+1)-lgamma(i+1)-lgamma(lost+gained-i+1)-(lost+gained)*ln(2))) FROM range(0, 100000) t(i) WHERE i<=least(lost,gained))),9)::DOUBLE AS p_value FROM (SELECT count(*) FILTER (WHERE name_dob AND NOT multi_field) AS lost, count(*) FILTER (WHERE NOT name_dob AND multi_field) AS gained FROM sc WHERE label)"))
def mcnemar(spark: SparkSession, d: str) -> DataFrame:
    row = paired_recall(spark, d).first()
    return spark.createDataFrame([(row["lost"], row["gained"], round(evaluate.mcnemar(row["lost"], row["gained"]), 9))], "lost long, gained long, p_value double")


_ZA, _ZB = "1.959963984540054", "0.8416212335729143"


@query(S.with_persona(f"SELECT gender, p0, CAST(ceil(pow({_ZA}*sqrt(2*((p0+p1)/2)*(1-(p0+p1)/2))+{_ZB}*sqrt(p0*(1-p0)+p1*(1-p1)),2)/pow(0.02,2)) AS BIGINT) AS rows_per_arm FROM (SELECT gender, p0, least(greatest(p0+0.02,1e-6),1-1e-6) AS p1 FROM (SELECT gender, round(avg(CASE WHEN phone IS NULL THEN 0.0 ELSE 1.0 END)::DOUBLE,4) AS p0 FROM persona GROUP BY gender)) WHERE p0>0 AND p0<1"))
def min_sample_size(spark: SparkSession, d: str) -> DataFrame:
    """Rows per arm to see two points more people with a phone, by gender."""
    rates = persona(spark, d).groupBy("gender").agg(F.round(F.avg(F.col("phone").isNotNull().cast("double")), 4).alias("p0")).collect()  # a row per gender
    return spark.createDataFrame([(r["gender"], r["p0"], evaluate.sample_size(r["p0"], 0.02)) for r in rates if 0 < r["p0"] < 1], "gender string, p0 double, rows_per_arm long")


_BAND = "CASE WHEN 2017-year(dob)<0 THEN NULL WHEN 2017-year(dob)<18 THEN '0-17' WHEN 2017-year(dob)<65 THEN '18-64' WHEN 2017-year(dob)<85 THEN '65-84' ELSE '85+' END"


def _banded(spark: SparkSession, d: str) -> DataFrame:
    p = persona(spark, d)
    return p.select(F.col("pid").alias("id"), sample.band_of(sample.age_of(F.date_format("dob", "yyyy-MM-dd"))).alias("band"))


@query(S.with_persona(f"SELECT band, count(*) AS supply FROM (SELECT {_BAND} AS band FROM persona) WHERE band IS NOT NULL GROUP BY band"))
def age_bands(spark: SparkSession, d: str) -> DataFrame:
    return _banded(spark, d).where("band is not null").groupBy("band").agg(F.count("*").alias("supply"))


def _quota_sql(n: int) -> str:
    q = sample.quotas(n, sample.TARGETS)
    return "CASE band " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in q.items()) + " END"


@query(S.with_persona(f"SELECT id, band, rank, CASE WHEN rank<={_quota_sql(200)} THEN 'sample' ELSE 'donor' END AS role FROM (SELECT pid AS id, {_BAND} AS band, row_number() OVER (PARTITION BY {_BAND} ORDER BY {S.digest('0', '@pid')}, pid) AS rank FROM persona) WHERE rank<={_quota_sql(200)}+{_quota_sql(100)}"))
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample.stratified(_banded(spark, d), 200, 100).select("id", "band", "rank", "role")


@query(S.with_persona("""SELECT band, CAST(base + CASE WHEN row_number() OVER (ORDER BY base-exact, band) <= n-sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota
 FROM (SELECT band, n, n*share AS exact, floor(n*share) AS base FROM (SELECT count(*)//7 AS n FROM persona), (VALUES ('0-17',CAST(0.215 AS DOUBLE)),('18-64',0.612),('65-84',0.1535),('85+',0.0195)) t(band,share))"""))
def band_quota(spark: SparkSession, d: str) -> DataFrame:
    """Whole quotas of the age bands for a sample of a seventh of the people."""
    return spark.createDataFrame(list(sample.quotas(persona(spark, d).count() // 7, sample.TARGETS).items()), "band string, quota long")


@query(f"SELECT event_type, event_id, rank FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY {S.digest('0', '@event_id')}, event_id) AS rank FROM events) WHERE rank<=20")
def reservoir_events(spark: SparkSession, d: str) -> DataFrame:
    return sample.first_per_group(table(spark, d, "events"), ["event_type"], [N.digest(0, F.col("event_id")), F.col("event_id")], 20).select("event_type", "event_id", "rank")


@query("SELECT o_orderpriority, o_orderkey, rank FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank<=10")
def top_k_per_group(spark: SparkSession, d: str) -> DataFrame:
    return sample.first_per_group(table(spark, d, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10).select("o_orderpriority", "o_orderkey", "rank")


@query()
def exclusions(spark: SparkSession, d: str) -> DataFrame:
    """Labelled matches that a rule drops, and the rule."""
    from weftlink.functions.exclusion import Policy

    cases = table(spark, d, "labeled_cases").where("expected_match and source is not null and target is not null")
    return Policy().told(cases).groupBy("excluded_by").agg(F.count("*").alias("n"))


@query()
def rebalance(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d).select("id", F.col("gender").alias("category"), (~F.col("label")).alias("is_match"))
    return sample.rebalance(rows, share=0.1).groupBy("category", "is_match").agg(F.count("*").alias("n"))


_TIER = f"""pos AS (SELECT a.id AS id_a, b.id AS id_b, 'typo_copy' AS category, true AS label FROM k a JOIN k b ON b.id=a.id+10000000),
neg AS (SELECT a.id AS id_a, b.id AS id_b, 'sibling_negative' AS category, false AS label FROM k a JOIN k b ON a.id<b.id AND a.zip=b.zip AND a.upper_family=b.upper_family AND a.first<>b.first AND {S.GAP}<=3 AND NOT {S.ALIKE}
 UNION ALL SELECT a.id, b.id, 'hard_negative', false FROM k a JOIN k b ON a.id<b.id AND a.zip=b.zip AND a.dob=b.dob AND a.upper_family<>b.upper_family AND NOT {S.ALIKE}),
tier AS (SELECT * FROM pos UNION ALL SELECT * FROM neg)"""


def _tier(spark: SparkSession, d: str) -> DataFrame:
    """A small pair tier: copies as matches, siblings and people of one birth date and place as non-matches."""
    flat = persona_dup(spark, d)
    k, who = people(flat), as_person(flat).select("pid", "person")
    yes = G.side(k.where("id < 10000000"), "a").join(G.side(k.where("id >= 10000000"), "b"), b("id") == a("id") + 10000000)
    parts = [(yes, "typo_copy", True), (mine.siblings(k), "sibling_negative", False), (mine.shared_birth_and_zip(k), "hard_negative", False)]
    ids = reduce(DataFrame.unionByName, [df.select(a("id").alias("x"), b("id").alias("y"), F.lit(c).alias("category"), F.lit(y).alias("label")) for df, c, y in parts])
    both = ids.join(who.select(F.col("pid").alias("x"), F.col("person").alias("source")), "x").join(who.select(F.col("pid").alias("y"), F.col("person").alias("target")), "y")
    return both.select(F.concat_ws("-", "category", "x", "y").alias("case_id"), "source", "target", "label", "category")


@query(S.with_people("SELECT category, label, count(*) AS n FROM tier GROUP BY category, label", True, _TIER))
def audit_tier(spark: SparkSession, d: str) -> DataFrame:
    return _tier(spark, d).groupBy("category", "label").agg(F.count("*").alias("n"))


#: Metrics of the audit's own tests, which SQL has no words for: checked by fixtures.
_OWN_TESTS = ("pairs_probable_duplicate_negatives", "twin_pairs_with_name_variants", "pairs_conformance_violations")


@query(S.with_people("""SELECT metric, round(value,6) AS value FROM (
 SELECT 'negative_share' AS metric, avg(CASE WHEN label THEN 0.0 ELSE 1.0 END)::DOUBLE AS value FROM tier
 UNION ALL SELECT 'all_yes_f1', 2*avg(CASE WHEN label THEN 1.0 ELSE 0.0 END)::DOUBLE/(1+avg(CASE WHEN label THEN 1.0 ELSE 0.0 END)::DOUBLE) FROM tier
 UNION ALL SELECT 'n_pairs', count(*)::DOUBLE FROM tier UNION ALL SELECT 'id_equality_f1', 0.0::DOUBLE FROM (SELECT 1 WHERE NOT EXISTS (SELECT 1 FROM tier WHERE id_a=id_b))
 UNION ALL SELECT 'email_differs', avg(CASE WHEN a.email IS DISTINCT FROM b.email THEN 1.0 ELSE 0.0 END)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b
 UNION ALL SELECT 'gender_differs', avg(CASE WHEN a.gender IS DISTINCT FROM b.gender THEN 1.0 ELSE 0.0 END)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b
 UNION ALL SELECT 'address_differs', avg(CASE WHEN a.street_zip IS DISTINCT FROM b.street_zip THEN 1.0 ELSE 0.0 END)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b
 UNION ALL SELECT 'same_person_negatives', (SELECT count(*)::DOUBLE FROM neg t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b WHERE coalesce(a.ssn=b.ssn,false) OR (a.first=b.first AND a.family=b.family AND a.dob=b.dob))
 UNION ALL SELECT 'pairs_identical_positive_pairs', count(*)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b JOIN persona_dup p ON p.pid=a.id JOIN persona_dup q ON q.pid=b.id WHERE p.given=q.given AND p.family=q.family AND p.dob=q.dob AND p.gender=q.gender AND p.phone IS NOT DISTINCT FROM q.phone AND p.email IS NOT DISTINCT FROM q.email AND p.ssn IS NOT DISTINCT FROM q.ssn AND p.zip=q.zip AND p.street=q.street
 UNION ALL SELECT 'pairwise_two_of_three_f1', 2*count(*) FILTER (WHERE p AND label)/(2*count(*) FILTER (WHERE p AND label)+count(*) FILTER (WHERE p<>label))::DOUBLE FROM (SELECT label, CAST(a.first=b.first AS INT)+CAST(a.family=b.family AS INT)+CAST(a.dob=b.dob AS INT)>=2 AS p FROM tier t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b)
 UNION ALL SELECT 'surname_differs', avg(CASE WHEN a.family<>b.family THEN 1.0 ELSE 0.0 END)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b
 UNION ALL SELECT 'phone_differs', avg(CASE WHEN a.phone IS DISTINCT FROM b.phone THEN 1.0 ELSE 0.0 END)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b
 UNION ALL SELECT 'birth_date_differs', avg(CASE WHEN a.dob<>b.dob THEN 1.0 ELSE 0.0 END)::DOUBLE FROM pos t JOIN k a ON a.id=t.id_a JOIN k b ON b.id=t.id_b)""", True, _TIER))
def audit_pairs(spark: SparkSession, d: str) -> DataFrame:
    return audit.pair_metrics(_tier(spark, d)).where(~F.col("metric").isin(*_OWN_TESTS))


@query()
def audit_pairs_all(spark: SparkSession, d: str) -> DataFrame:
    """All metrics over the whole pair tier with every generator."""
    rows = dataset.records(persona(spark, d)).select("source", "target", F.col("expected_match").alias("label"), "category")
    return audit.pair_metrics(stored(rows, "cases"))  # the metrics' long expressions stay out of the plan of the pairs


@query(S.with_people("SELECT t.category FROM (VALUES ('hard_negative'),('name_collision_negative'),('sibling_negative'),('near_miss_negative'),('twin_like_negative')) t(category) WHERE NOT EXISTS (SELECT 1 FROM tier WHERE tier.category=t.category AND NOT label)", True, _TIER))
def missing_categories(spark: SparkSession, d: str) -> DataFrame:
    return audit.missing_categories(_tier(spark, d))


_POPULATION = """SELECT 'people_per_address' AS metric, round(avg(n),6) AS value FROM (SELECT count(*)::DOUBLE AS n FROM k GROUP BY street, zip)
 UNION ALL SELECT 'shared_phone_rate', round(avg(CASE WHEN n>1 THEN 1.0 ELSE 0.0 END)::DOUBLE,6) FROM (SELECT count(*) OVER (PARTITION BY phone) AS n FROM k WHERE phone IS NOT NULL)
 UNION ALL SELECT 'shared_email_rate', round(avg(CASE WHEN n>1 THEN 1.0 ELSE 0.0 END)::DOUBLE,6) FROM (SELECT count(*) OVER (PARTITION BY email) AS n FROM k WHERE email IS NOT NULL)
 UNION ALL SELECT 'minors_with_same_surname_adult_share', round(avg(CASE WHEN 2017-e>=18 THEN 1.0 ELSE 0.0 END)::DOUBLE,6) FROM (SELECT dob, min(CAST(substr(dob,1,4) AS INT)) OVER (PARTITION BY family, street_zip) AS e FROM k) WHERE 2017-CAST(substr(dob,1,4) AS INT)<18"""


@query(S.with_people(_POPULATION))
def audit_population(spark: SparkSession, d: str) -> DataFrame:
    return audit.population_metrics(people(persona(spark, d)))


def _pools(spark: SparkSession, d: str) -> DataFrame:
    return pools.pools(persona_dup(spark, d))


@query()
def population_pools(spark: SparkSession, d: str) -> DataFrame:
    return _pools(spark, d).select("query_id", "candidate_id", "is_match", "category", "place", "rationale")


@query()
def audit_pools(spark: SparkSession, d: str) -> DataFrame:
    return audit.pool_metrics(stored(_pools(spark, d).select("query_id", "candidate_id", "place", "is_match"), "pools"))  # read three times


def _released(spark: SparkSession, d: str, n: int = 300) -> dataset.Released:
    """A data set of ``n`` sampled people, written to the shared folder and read back."""
    folder = shared_folder(spark, "released")
    dataset.write(dataset.realistic(persona(spark, d), n, n), folder)
    return dataset.read(spark, folder)


def _report(spark: SparkSession, d: str) -> DataFrame:
    r = _released(spark, d)
    pairs = r.pairs.select("case_id", "source", "target", F.col("expected_match").alias("label"), jsonl.category_of(F.col("rationale")).alias("category"))
    return audit.build_report(pairs, r.queries, dataset.pool_rows(r), dataset.AS_OF)


@query()
def release_report(spark: SparkSession, d: str) -> DataFrame:
    """Every metric of a written data set."""
    return _report(spark, d)


@query()
def release_gate(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of a written data set against the thresholds of a realistic release."""
    return audit.gate(_report(spark, d), audit.REALISTIC)


@query()
def release_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The counts that a manifest states next to those of the written files."""
    r = _released(spark, d)
    said = spark.createDataFrame([(k, v) for k, v in r.manifest["category_counts"].items()], "category string, n_stated long")
    kind = F.concat_ws("/", jsonl.category_of(F.col("rationale")), F.when(F.col("expected_match"), "match").otherwise("non-match"))
    return said.join(r.pairs.groupBy(kind.alias("category")).agg(F.count("*").alias("n_written")), "category", "full")


@query("SELECT case_id, expected_match, frequency, substr(sha256(source.id),1,16) AS source_id, substr(sha256(case_id||':target'),1,16) AS target_id FROM labeled_cases WHERE source IS NOT NULL AND target IS NOT NULL")
def export_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Labelled cases written as JSON Lines with hidden ids and read back."""
    folder = shared_folder(spark, "pairs")
    jsonl.write_rows(jsonl.pair_rows(table(spark, d, "labeled_cases").where("source is not null and target is not null")), folder)
    return jsonl.read_rows(spark, folder, jsonl.PAIR).select("case_id", "expected_match", "frequency", F.col("source.id").alias("source_id"), F.col("target.id").alias("target_id"))


@query()
def pool_features(spark: SparkSession, d: str) -> DataFrame:
    """Share of decoys that agree with their query on nothing."""
    k = pools.keys(persona_dup(spark, d), "id", "all_phones", "emails", "ssn", "dob", "family", "first", "street_zip")
    decoys = stored(_pools(spark, d).where(~F.col("is_match")).select("query_id", "candidate_id", "category"), "decoys")
    return pool_overlap(decoys, k)


def pool_overlap(decoys: DataFrame, k: DataFrame) -> DataFrame:
    """(category, n, no_overlap_rate) of decoys (query_id, candidate_id, category). Records are joined to those that don't agree on something by their
    kind already; ``decoys`` are read twice."""
    shared = reduce(lambda x, y: x | y, [c for n, c in G.features().items() if n != "name_dob"])
    sure = F.col("category").isin(*G.SHARING)
    met = decoys.where(~sure).join(by_sort(G.side(k, "a")), F.col("query_id") == a("id")).join(by_sort(G.side(k, "b")), F.col("candidate_id") == b("id"))
    rows = decoys.where(sure).select("category", F.lit(0.0).alias("none")).unionByName(met.select("category", (~shared).cast("double").alias("none")))
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.avg("none").alias("no_overlap_rate"))


_GATED = """SELECT t.metric, m.value, t.status, t.status='tracked' OR (m.value IS NOT NULL AND (t.lo IS NULL OR m.value>=t.lo) AND (t.hi IS NULL OR m.value<=t.hi)) AS passed
 FROM (VALUES ('people_per_address',CAST(2.0 AS DOUBLE),CAST(NULL AS DOUBLE),'enforced'),('shared_phone_rate',0.4,0.9,'enforced'),('shared_email_rate',NULL,0.01,'tracked'),('minors_with_same_surname_adult_share',0.7,NULL,'enforced'),('gone',0.0,NULL,'enforced')) t(metric,lo,hi,status) LEFT JOIN m ON m.metric=t.metric"""


@query(S.with_people(_GATED, False, f"m AS ({_POPULATION})"))
def gate_check(spark: SparkSession, d: str) -> DataFrame:
    """The population's metrics against thresholds, one of them for a metric that nobody measures."""
    limits = {"people_per_address": {"min": 2.0, "status": "enforced"}, "shared_phone_rate": {"min": 0.4, "max": 0.9, "status": "enforced"}, "shared_email_rate": {"max": 0.01, "status": "tracked"}, "minors_with_same_surname_adult_share": {"min": 0.7, "status": "enforced"}, "gone": {"min": 0, "status": "enforced"}}
    return audit.gate(audit.population_metrics(people(persona(spark, d))), limits)


#: Households in SQL: places in the order, drawn sizes, where a household begins, who is its anchor.
_HOMES = f"""placed AS (SELECT id, 2017-CAST(substr(dob,1,4) AS INT) AS age, row_number() OVER (ORDER BY family, {S.digest('0', 'home', '@id')}, id)-1 AS r FROM k),
slot AS (SELECT id, age, r//60 AS b, r%60 AS i FROM placed),
drawn AS (SELECT *, {S.uniform('0', 'size', '@b', '@i')} AS u FROM slot),
sized AS (SELECT *, CASE WHEN u<0.29 THEN 1 WHEN u<0.5902523115118887 THEN 2 WHEN u<0.7746128612346456 THEN 3 WHEN u<0.8878136959690395 THEN 4 WHEN u<0.9573211312844258 THEN 5 ELSE 6 END AS size FROM drawn),
begun AS (SELECT b, coalesce(sum(size) OVER (PARTITION BY b ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS start FROM sized),
housed AS (SELECT id, age, CAST(b AS VARCHAR)||'-'||CAST((SELECT count(*) FROM begun g WHERE g.b=s.b AND g.start<60 AND g.start<=s.i) AS VARCHAR) AS household FROM sized s),
homes AS (SELECT *, first_value(id) OVER w AS anchor, first_value(age) OVER w AS anchor_age FROM housed WINDOW w AS (PARTITION BY household ORDER BY age DESC, id DESC))"""


@query(S.with_people("SELECT size, count(*) AS households, sum(minors)::BIGINT AS minors_with_parent FROM (SELECT household, count(*) AS size, count(*) FILTER (WHERE age<18 AND anchor_age-age BETWEEN 18 AND 50) AS minors FROM homes GROUP BY household) GROUP BY size", False, _HOMES))
def household_report(spark: SparkSession, d: str) -> DataFrame:
    homes = households.assign(people(persona(spark, d)))
    sizes = homes.groupBy("household").agg(F.count("*").alias("size"), F.count_if("minor_with_parent").alias("minors"))
    return sizes.groupBy("size").agg(F.count("*").alias("households"), F.sum("minors").alias("minors_with_parent"))


@query(S.with_people(f"SELECT id, household, anchor AS address_of, CASE WHEN id<>anchor AND {S.uniform('0', 'household_phone', '@id')}<0.5 THEN anchor ELSE id END AS phone_of, CASE WHEN id<>anchor AND {S.uniform('0', 'household_email', '@id')}<0.5 THEN anchor ELSE id END AS email_of, age<18 AND {S.uniform('0', 'minor_ssn_absent', '@id')}<0.7 AS drop_ssn FROM homes", False, _HOMES))
def household_members(spark: SparkSession, d: str) -> DataFrame:
    k = people(persona(spark, d))
    return households.shared_contacts(k, households.assign(k))


_ADULTS = f"""aged AS (SELECT id, family, 2017-CAST(substr(dob,1,4) AS INT) AS age FROM k), s AS (SELECT * FROM aged WHERE id%100=1),
needed AS (SELECT DISTINCT family, age FROM s x WHERE age<18 AND NOT EXISTS (SELECT 1 FROM s y WHERE y.family=x.family AND y.age>=18 AND y.age-x.age BETWEEN 18 AND 50)),
found AS (SELECT f.id, f.family, f.age, count(*) AS covers FROM aged f JOIN needed n ON n.family=f.family AND f.age-n.age BETWEEN 18 AND 50 WHERE f.age>=18 AND f.id%100<>1 GROUP BY f.id, f.family, f.age)"""


@query(S.with_people(f"SELECT * FROM (SELECT id, family, age, covers, row_number() OVER (PARTITION BY family ORDER BY {S.digest('0', 'adult', '@id')}, id) AS rank FROM found) WHERE rank<=5", False, _ADULTS))
def family_adults(spark: SparkSession, d: str) -> DataFrame:
    """Adults for the minors of a sample of people (every hundredth) who have none of their name in it."""
    k = people(persona(spark, d))
    return households.family_adults(k.where("id % 100 = 1"), k)
