"""Exclusions, audits, comparisons and whole data sets on small fixtures."""

import json
import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from weftlink.functions import exclusion
from weftlink.model import PERSON, violations
from weftlink.operators import audit, evaluate, mine, sample
from weftlink.plans import dataset, households
from weftlink.plans.persona import people
from weftlink.sources import csv

PEOPLE = "pid long, given string, family string, dob date, gender string, zip string, street string, phone string, email string, ssn string"


def person(given="ANN", family="SMITHSON", dob="1980-01-05", phone="2125550100", zip="10001", ids=(), **more):
    p = {"id": "x", "birthDate": dob, "name": [{"family": family, "given": [given]}], "telecom": [{"system": "phone", "value": phone}], "address": [{"line": ["1 A ST"], "postalCode": zip}]}
    return json.dumps(p | ({"identifier": list(ids)} if ids else {}) | more)


def ssn(value):
    return {"system": "http://hl7.org/fhir/sid/us-ssn", "type": {"coding": [{"code": "SS"}]}, "value": value}


def typed(code, value, system=None, by=None):
    return {"type": {"coding": [{"code": code}]}, "value": value} | ({"system": system} if system else {}) | ({"assigner": {"display": by}} if by else {})


def frame(spark, rows):
    df = spark.createDataFrame([(f"c{i}", *r) for i, r in enumerate(rows)], "case_id string, source string, target string, label boolean, category string")
    return df.select("case_id", F.from_json("source", PERSON).alias("source"), F.from_json("target", PERSON).alias("target"), "label", "category")


@pytest.mark.parametrize(
    "left, right, dropped",
    [
        (person(), person(dob="1990-01-05"), True),
        (person(), person(dob="1980-01-06"), False),
        (person(), person(dob="", given="AMN"), False),  # too short to differ
        (person(), person(dob="", family="SMIHTSON"), True),
        (person(), person(dob="", family="SMIHTSONS"), False),
        (person(zip="10001-1111"), person(dob="", zip="10001"), False),
        (person(phone="1112223333"), person(phone="1112223333", dob=""), False),
        (person(ids=[ssn("219-09-9998")]), person(dob="", ids=[ssn("000-00-9998")]), False),
        (person(ids=[typed("DL", "7", by="NY")]), person(dob="", ids=[typed("DL", "7", by="NY")]), False),
        (person(ids=[typed("DL", "7", by="NY")]), person(dob="", ids=[typed("DL", "7", by="NJ")]), True),
        (person(ids=[typed("MR", "5", "urn:a")]), person(dob="", ids=[typed("MR", "5", "urn:a")]), False),
        (person(ids=[typed("MB", "5", "urn:a")]), person(dob="", ids=[typed("MB", "5", "urn:a")]), False),
        (person(ids=[typed("MB", "5")]), person(dob="", ids=[typed("MB", "5")]), True),
        (person(ids=[typed("SN", "5", "urn:a")]), person(dob="", ids=[typed("SN", "5", "urn:a")]), True),
        (person(given="ROBERT"), person(given="BOB", dob=""), True),
        (person(), None, False),
    ],
)
def test_exclusion(spark, left, right, dropped):
    df = frame(spark, [(left, right, True, "x")])
    assert exclusion.Policy().counts(df) == ({"rule_29_removed": 1} if dropped else {})
    assert exclusion.Policy().kept(df).count() == 1 - dropped and exclusion.NO_EXCLUSIONS.kept(df).count() == 1


def test_exclusion_summary():
    assert exclusion.summary({}) == "no pairs excluded" and exclusion.summary({"b": 2, "a": 1}) == "a=1, b=2"


def value(df):
    return {r.metric: r.value for r in df.collect()}


def test_pair_audit(spark):
    twin = {"given": "WILLIAM"}, {"given": "BILL"}
    rows = [
        (person(), person(dob="1980-01-06", id="y"), True, "fuzzy_variant"),
        (person(), person(id="y"), True, "fuzzy_variant"),  # identical
        (person(**twin[0]), person(**twin[1], id="y"), False, "twin_like_negative"),  # one name in two forms
        (person(given="ANN"), person(given="ROSEMARY", id="y"), False, "twin_like_negative"),
        (person(), person(dob="1980-05-01", given="ANN", id="y"), False, "hard_negative"),  # swapped date
        (person(), person(family="JONES", given="EVE", dob="1950-01-01", phone="2125550199", id="y"), False, "hard_negative"),
        (person(ids=[ssn("219-09-9998")]), person(family="JONES", given="EVE", dob="1950-01-01", ids=[ssn("219-09-9998")]), False, "hard_negative"),
    ]
    m = value(audit.pair_metrics(frame(spark, rows)))
    assert (m["n_pairs"], m["pairs_identical_positive_pairs"], m["twin_pairs_with_name_variants"]) == (7, 1, 1)
    assert m["pairs_probable_duplicate_negatives"] == 3 and m["same_person_negatives"] == 1 and m["negative_share"] == pytest.approx(5 / 7, abs=1e-6)
    assert m["id_equality_f1"] == 0 and m["birth_date_differs"] == 0.5
    assert audit.missing_categories(frame(spark, rows)).count() == 3
    empty = value(audit.pair_metrics(frame(spark, rows).limit(0)))
    assert empty["n_pairs"] == empty["negative_share"] == empty["all_yes_f1"] == 0


def test_pool_audit(spark):
    rows = [("q1", "a", 1, True), ("q1", "b", 2, False), ("q2", "q1", 1, False), ("q2", "c", 2, True), ("q3", "d", 1, False)]
    m = value(audit.pool_metrics(spark.createDataFrame(rows, "query_id string, candidate_id string, place int, is_match boolean")))
    assert m["zero_match_query_share"] == pytest.approx(1 / 3, abs=1e-6) and m["matches_first_rate"] == 0.5 and m["candidate_query_id_overlap"] == 1
    assert m["population_all_yes_f1"] == pytest.approx(4 / 7, abs=1e-6) and m["query_id_leak_f1"] == pytest.approx(4 / 6, abs=1e-6) and m["query_id_leak_lift"] > 0
    queries = spark.createDataFrame([("q1", "population/a+b"), ("q2", "population")], "query_id string, rationale string")
    pairs = spark.createDataFrame([("a",), ("c",), ("placeholder_collision_negative",)], "category string")
    assert [r.category for r in audit.tier_parity_gap(pairs, queries).collect()] == ["c"]


def test_bands_and_sources(spark):
    m = value(audit.band_metrics(spark.createDataFrame([("2010-01-01",), ("1980-01-01",), ("",)], "dob string")))
    assert m["age_band_share 0-17"] == 0.5 and m["age_band_max_error"] == pytest.approx(0.5 - 0.215, abs=1e-6)
    rows = [(person(), person(), True, "x"), (person(family="B"), person(), True, "x"), (person(id=None), person(), True, "x")]
    assert audit.sources_once(frame(spark, rows)).count() == 2


def test_gate(spark):
    metrics = spark.createDataFrame([("a", 0.5), ("b", float("nan"))], "metric string, value double")
    out = audit.gate(metrics, {"a": {"min": 0.6, "status": "tracked"}, "b": {"max": 1, "status": "enforced"}, "c": {"min": 0, "status": "enforced"}})
    assert {r.metric for r in audit.failures(out).collect()} == {"b", "c"}
    with pytest.raises(ValueError):
        audit.gate(metrics, {"a": {"status": "other"}})


def test_conformance_finds_each_problem(spark):
    bad = [
        {"name": [{"use": "odd", "family": "A"}]}, {"telecom": [{"system": "carrier", "value": "1"}]}, {"telecom": [{"system": "phone", "value": "1^2"}]},
        {"telecom": [{"system": "phone", "value": "1", "rank": 1}, {"system": "phone", "value": "2", "rank": 1}]}, {"identifier": [{"system": "http://hl7.org/fhir/sid/us-ssn", "value": "1"}]}, {"gender": ""},
    ]
    df = spark.createDataFrame([(json.dumps({"id": "1"} | x),) for x in bad], "j string").select(F.from_json("j", PERSON).alias("p"))
    found = [r.v for r in df.select(violations(F.col("p")).alias("v")).collect()]
    assert all(len(v) >= 1 for v in found) and {x for v in found for x in v} >= {"name use", "telecom system", "caret in telecom", "duplicate rank", "untyped ssn", "empty value"}


def test_paired_statistics(spark):
    p = evaluate.Paired(50, 3, 12, 5)
    assert p.churn == 15 and p.net_change == pytest.approx(9 / 70) and p.p_better == pytest.approx(0.98936, abs=1e-4) and math.isnan(evaluate.Paired(0, 0, 0, 0).net_change)
    assert evaluate.sample_size(0.9, 0.2) > 0  # the changed rate ends at 1
    with pytest.raises(ValueError):
        evaluate.sample_size(1.0, 0.1)
    df = spark.createDataFrame([(i < 60, i < 90 or i > 150, i < 100) for i in range(200)], "p boolean, q boolean, y boolean")
    c = evaluate.comparison(df, F.col("p"), F.col("q"), F.col("y"))
    assert c.overall == "REJECT" and c.paired.gained == 30 and "REJECT" in evaluate.format_report(c)
    assert evaluate.comparison(df.limit(0), F.col("p"), F.col("q"), F.col("y")).overall == "NEEDS MORE DATA"
    folds = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, float("nan"))], "fold int, tpr double")
    assert tuple(evaluate.fold_spread(folds).first()) == ("tpr", 2, 0.6, 0.1)


def crowd(spark, n=60):
    names = ["WILLIAM", "ANN", "ROSEMARY", "JOHN", "GIORGOS", "BEATRIX"]
    rows = [(i, names[i % 6], ["SMITHSON", "JONES", "LEE", "HART"][i % 4], date(1940 + (i * 7) % 75, 1 + i % 12, 1 + i % 28), "female", f"1000{i % 5}", f"{i % 9} MAIN ST", f"21255501{i % 50:02d}", f"u{i}@x.org" if i % 3 else None, f"219-{10 + i}-9998" if i % 4 else None) for i in range(1, n)]
    return spark.createDataFrame(rows, PEOPLE)


def test_family_adults_and_households(spark):
    rows = [(1, "ANN", "SMITHSON", date(2010, 1, 1)), (2, "BOB", "SMITHSON", date(1980, 1, 1)), (3, "EVE", "SMITHSON", date(1930, 1, 1)), (4, "IDA", "JONES", date(1985, 1, 1))]
    k = people(spark.createDataFrame([(i, g, f, d, "female", "1", "1 A ST", None, None, None) for i, g, f, d in rows], PEOPLE))
    assert [r.id for r in households.family_adults(k.where("id = 1"), k).collect()] == [2]
    homes = households.assign(people(crowd(spark)))
    assert homes.count() == 59 and homes.groupBy("household").count().agg(F.max("count")).first()[0] <= households.LARGEST


def test_institutions(spark):
    k = people(crowd(spark))
    groups = mine.institution_groups(k, 3).collect()
    assert {r.institution for r in groups} == set(mine.INSTITUTIONS) and 8 < len(groups) <= 24 and all(r.line.startswith("SYNTHETIC TEST ADDRESS - ") for r in groups)
    df = spark.createDataFrame([(person(),)], "j string").select(F.from_json("j", PERSON).alias("p"))
    at = df.select(mine.at_institution(F.col("p"), F.lit("dormitory")).alias("p"), mine.at_institution(F.col("p"), F.lit("zoo")).alias("q")).first()
    assert at.p.address[0].postalCode == "00006" and at.q is None


def test_constructed_households_equal_brute_force(spark):
    k = people(crowd(spark, 40))
    rows = k.select("id", "upper_family", "dob", "street_zip").collect()
    alike = {(r.x, r.y) for r in mine.side(k, "a").join(mine.side(k, "b"), F.col("a_id") != F.col("b_id")).where(mine.G.looks_same()).select(F.col("a_id").alias("x"), F.col("b_id").alias("y")).collect()}
    want = {}
    for p in rows:
        for q in rows:
            gap = int(q.dob[:4]) - int(p.dob[:4])
            if p.id != q.id and p.upper_family == q.upper_family and gap >= 15 and p.street_zip != q.street_zip and (p.id, q.id) not in alike:
                want[p.upper_family] = min(want.get(p.upper_family, (999,)), (gap, str(p.id), str(q.id)))
    assert {r.family_name: (r.age_gap_years, r.elder, r.younger) for r in mine.constructed_households(k).collect()} == want and want
    assert mine.constructed_households(k.limit(0)).count() == 0


def test_a_written_data_set(spark, tmp_path):
    ds = dataset.realistic(crowd(spark), 30, 10, size=8)
    dataset.write(ds, str(tmp_path / "out"))
    back = dataset.read(spark, str(tmp_path / "out"))
    assert back.manifest == json.loads(json.dumps(ds.manifest)) and back.pairs.count() == ds.manifest["n_labeled_cases"] > 50
    assert back.queries.count() == ds.manifest["n_population_queries"] and ds.manifest["negative_share"] == pytest.approx(0.5, abs=0.1)
    rows = dataset.pool_rows(back)
    assert rows.where("patient is null").count() == 0 and rows.groupBy("query_id").agg(F.count("*").alias("n"), F.count_if("is_match").alias("m")).where("n > greatest(8, m)").count() == 0
    m = value(audit.pool_metrics(rows))
    assert m["candidate_query_id_overlap"] == 0 and m["query_id_leak_lift"] == 0
    assert {b for b in ds.manifest["sample_band_counts"]} <= set(sample.TARGETS)


def test_shards_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("EnterpriseID,LAST,FIRST,DOB\n1,DOE,ANN,8476\n")
    (tmp_path / "b.csv").write_text("FIRST,LAST,EnterpriseID,PHONE\nBOB,ROE,2,2125550100\n")
    (tmp_path / "c.csv").write_text("EnterpriseID,LAST,FIRST,DOB\n3,POE,EVE,\n")
    paths = csv.shards(spark, str(tmp_path))
    rows = {r.shard: r.person for r in csv.read_people(spark, paths).collect()}
    assert {i: p.name[0].family for i, p in rows.items()} == {0: "DOE", 1: "ROE", 2: "POE"} and rows[1].telecom[0].value == "2125550100" and rows[2].birthDate is None
    assert csv.read_people(spark, []).count() == 0
    (tmp_path / "d.csv").write_text("X,Y\n1,2\n")
    with pytest.raises(ValueError):
        csv.read_people(spark, [str(tmp_path / "d.csv")])
