"""Core operators on small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from weftlink.functions import guard as G
from weftlink.functions import norm as N
from weftlink.model import keyed, violations
from weftlink.operators import evaluate, mine, sample
from weftlink.operators.neighbours import sorted_pairs
from weftlink.operators.prefix import hash_key, running_sum
from weftlink.plans.pairs import COLLISION_FIELDS, INSTITUTIONS, negatives
from weftlink.plans.persona import as_person, people
from weftlink.sources import csv, jsonl


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text,folded", [("José Nuñez", "josenunez"), ("Straße", "strasse"), (None, ""), ("O'Neil-Ö 3", "oneilo3")])
def test_token(spark, text, folded):
    assert one(spark, N.token(F.lit(text))) == folded


@pytest.mark.parametrize("text,usable", [("123-45-6789", None), ("999-99-9999", None), ("666-12-3456", None), ("111-11-1111", None), ("219-09-9998", "219099998"), ("219-00-9998", None), ("21909", None)])
def test_ssn(spark, text, usable):
    assert one(spark, N.usable_ssn(F.lit(text))) == usable


def test_dates(spark):
    assert one(spark, N.shift_years(F.lit("2004-02-29"), 1)) == "2005-02-28"
    assert one(spark, N.shift_years(F.lit("spring"), 1)) == "spring"
    assert one(spark, N.from_day_offset(F.lit("8476"))) == "1923-03-16"
    assert one(spark, N.from_day_offset(F.lit("x"))) is None
    assert one(spark, N.dates_close(F.lit("2001-02-03"), F.lit("2001-03-02")))
    assert not one(spark, N.dates_close(F.lit(""), F.lit("")))


def test_osa(spark):
    for a, b, y in (("ab", "ba", True), ("abcd", "acbd", True), ("ca", "abc", False), ("a", "", True), ("", "", True)):
        assert one(spark, N.osa_within_one(F.lit(a), F.lit(b))) is y


def test_variants(spark):
    for a, b, y in (("william", "bill", True), ("j", "john", True), ("chris", "christopher", True), ("bill", "will", False), ("", "john", False)):
        assert one(spark, N.given_variant(F.lit(a), F.lit(b))) is y


def test_running_sum_equals_a_window(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id", (F.col("id") % 7).alias("v"), hash_key(F.col("id")).alias("h"))
    rows = running_sum(df, ["g"], "h", "v", "before", ["id"]).collect()
    for g in range(3):
        total = 0
        for r in sorted((r for r in rows if r.g == g), key=lambda r: (r.h, r.id)):
            assert r.before == total
            total += r.v
    assert running_sum(df.limit(0), ["g"], "h", "v", "before", ["id"]).count() == 0


def test_sorted_pairs_equal_a_plain_window(spark):
    values = [(i * 7919) % 1000 for i in range(700)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v long")
    got = {(r.a.i, r.b.i) for r in sorted_pairs(df, [F.col("v"), F.col("i")], 4, F.lit(True)).collect()}
    order = [i for _, i in sorted((v, i) for i, v in enumerate(values))]
    assert got == {(order[x], order[y]) for x in range(700) for y in range(x + 1, min(700, x + 4))}
    assert sorted_pairs(df.limit(0), [F.col("v")], 4, F.lit(True)).count() == 0


PEOPLE = "pid long, given string, family string, dob date, gender string, zip string, street string, phone string, email string, ssn string"


def population(spark):
    from datetime import date

    rows = [
        (1, "JOHN", "SMITH", date(1980, 1, 5), "male", "10001", "1 MAIN ST", "2125550100", None, "219-09-9998"),
        (2, "MARY", "SMITH", date(1980, 1, 5), "female", "10001", "1 MAIN ST", "2125550100", None, None),
        (3, "JOHN", "SMYTH", date(1970, 7, 7), "male", "10002", "2 MAIN ST", None, None, None),
        (4, "JOHN", "SMITH", date(1980, 1, 5), "male", "10009", "9 MAIN ST", None, None, "219-09-9998"),
        (5, "ANNA", "JONES", date(1980, 1, 5), "female", "10001", "3 MAIN ST", None, "A@B.org", None),
        (6, "KIM", "SMITH", date(1982, 4, 4), "unknown", "10001", "1 MAIN ST", None, "a@b.org", None),
    ]
    return spark.createDataFrame(rows, PEOPLE)


def keys(spark):
    return keyed(as_person(population(spark)), "person", "ord").withColumn("id", F.col("ord"))


def pairs(df):
    return {(r.a_id, r.b_id) for r in df.select("a_id", "b_id").collect()}


def test_miners(spark):
    k = keys(spark)
    assert pairs(mine.shared_birth_and_zip(k)) == {(1, 5), (2, 5)}
    assert pairs(mine.siblings(k)) == {(1, 6), (2, 6)}
    assert pairs(mine.name_collisions(k)) == pairs(mine.name_collisions_blocked(k))
    met = G.side(k, "a").join(G.side(k, "b"), F.col("a_id") < F.col("b_id"))
    assert pairs(met.where(G.possible_same())) == {(1, 4)}
    assert pairs(met.where(G.twins())) == {(1, 2)}
    assert {(r.probe_id, r.id) for r in mine.duplicate_ids(k, k).collect() if r.probe_id < r.id} == pairs(met.where(G.probable_duplicate()))


def test_near_misses(spark):
    k = keys(spark)
    kinds = {(r.a_id, r.b_id): r.kind for r in mine.near_misses(k.where("id = 1"), k).select("a_id", "b_id", "kind").collect()}
    assert kinds == {(1, 2): "twin", (1, 3): "name", (1, 5): "dob_zip", (1, 6): "sibling"}
    assert mine.near_misses(k.limit(0), k).count() == 0


def test_negatives_of_all_people_and_generators(spark):
    from datetime import date

    more = [(11 + i, f"P{c * 4}", c * 6, date(1930 + i, 2, 3), "male", f"2000{i}", f"{i} OAK ST", None, None, None) for i, c in enumerate("ABCDEFG")] + [(21, "OTTO", "JONES", date(1950, 1, 5), "male", "10001", "8 MAIN ST", None, None, None)]
    flat = population(spark).unionByName(spark.createDataFrame(more, PEOPLE))  # no id is divisible by ten
    k = people(flat)
    rows = negatives(flat).collect()
    assert {frozenset((r.source_id, r.target_id)) for r in rows} >= {frozenset(p) for p in pairs(mine.near_misses(k, k, 3))}
    assert {(r.source_id, r.target_id) for r in rows if r.pair_type == "twin_like_negative"} == {(1, 2)}
    assert {(r.source_id, r.target_id) for r in rows if r.subtype == "multi_generational_household"} == {(int(r.elder), int(r.younger)) for r in mine.constructed_households(k).collect()} != set()
    assert {r.subtype for r in rows if r.pair_type == "special_population"} == {"multi_generational_household", *INSTITUTIONS}
    assert {r.subtype for r in rows if r.pair_type == "placeholder_collision_negative"} == set(COLLISION_FIELDS)


def test_quotas_and_samples(spark):
    assert sample.quotas(2000, sample.TARGETS) == {"0-17": 430, "18-64": 1224, "65-84": 307, "85+": 39}
    with pytest.raises(ValueError):
        sample.quotas(-1, sample.TARGETS)
    df = spark.range(103).select("id")
    sizes = sorted(r["count"] for r in sample.folds(df, 5).groupBy("fold").count().collect())
    assert sizes == [20, 20, 21, 21, 21]
    assert [one(spark, sample.band_of(F.lit(a))) for a in (-1, 0, 17, 18, 64, 65, 85)] == [None, "0-17", "0-17", "18-64", "18-64", "65-84", "85+"]


def test_statistics(spark):
    assert evaluate.mcnemar(0, 0) == 1.0 and abs(evaluate.mcnemar(3, 12) - 0.03515625) < 1e-12
    assert abs(evaluate.beta_cdf(0.3, 2, 5) - 0.579825) < 1e-9
    assert evaluate.sample_size(0.9, 0.02) == 3213
    df = spark.createDataFrame([(i < 60, i < 90, i < 100) for i in range(200)], "p boolean, q boolean, y boolean")
    report = evaluate.compare(df, F.col("p"), F.col("q"), F.col("y"))
    assert {r.overall for r in report.collect()} == {"SHIP"}
    empty = evaluate.quality(evaluate.confusion(df.limit(0), F.col("p"), F.col("y"))).first()
    assert math.isnan(empty.tpr) and empty.tp == 0


def test_csv_and_json(spark, tmp_path):
    path = tmp_path / "shard.csv"
    path.write_text("EnterpriseID,LAST,FIRST,MIDDLE,DOB,GENDER,SSN,ADDRESS1,ZIP,PHONE,EMAIL,ALIAS\n7,DOE-X, ANN ,B,8476,F,219-09-9998,1 A ST,10001,2125550100^2125550110,,NAN\n,,,,,,,,,,,\n")
    rows = csv.read_people(spark, [str(path)]).orderBy(F.desc("person.id")).collect()
    p = rows[0].person
    assert [t.value for t in p.telecom] == ["2125550100", "2125550110"] and p.name[0].given == ["ANN", "B"] and p.name[1].text == "NAN" and p.birthDate == "1923-03-16"
    assert rows[1].person.name is None and rows[1].person.telecom is None
    with pytest.raises(ValueError):
        csv.read_people(spark, ["../x.csv"])
    df = csv.read_people(spark, [str(path)]).select("person")
    assert df.where(F.size(violations(F.col("person"))) > 0).count() == 0
    out = str(tmp_path / "out")
    jsonl.write_rows(df.select(F.lit("c").alias("case_id"), F.col("person").alias("source"), F.col("person").alias("target"), F.lit(True).alias("expected_match"), F.lit("a/b (c)").alias("rationale"), F.lit(1.0).alias("frequency")), out)
    back = jsonl.read_rows(spark, out, jsonl.PAIR, empty=False)
    assert back.count() == 2 and back.select(jsonl.category_of(F.col("rationale")).alias("c")).first().c == "a"
