"""Training-data operators on small fixtures, with brute force, round trips and edge cases."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.llm import abuse, addresses, entities, mixing, names, sampling, strings, tokens

CASES = "case_id string, strata map<string,string>, rationale string, frequency double, request_id string"
TARGETS = "request_id string, strata_key string, category string, target_share double, min_rows long, sample_rows long"


def test_labels_are_read_in_any_spelling(spark):
    rows = [("18–64", "18-64"), (" Near Miss-Negative ", "near_miss_negative"), ("n/a", None), ("", None), (None, None), ("85+", "85+")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert all(r.x == r.b for r in df.select("b", sampling.canonical(F.col("a")).alias("x")).collect())


def test_sample_meets_targets_minimums_and_reports_gaps(spark):
    rng = random.Random(1)
    rows = [(f"c{i}", {"age_band": rng.choice(["0-17", "18-64", "18-64"]), "sex": rng.choice("mf")}, None, rng.choice([None, float("nan"), -1.0, 2.0]), "x") for i in range(600)]
    rows += [("rare1", {"age_band": "85+", "sex": "m"}, None, 1.0, "x"), ("rare1", {"age_band": "85+", "sex": "m"}, None, 1.0, "x"), (None, {"age_band": "85+"}, None, 1.0, "x"), ("n", None, None, None, None)]
    goals = [("r", "age_band", "0-17", 0.5, 1, 100), ("r", "age_band", "18-64", 0.4, 1, 100), ("r", "age_band", "85+", 0.1, 2, 100), ("r", "sex", "m", 0.7, 1, 100), ("r", "sex", "f", 0.3, 1, 100)]
    s = sampling.sample_to_targets(spark.createDataFrame(rows, CASES), spark.createDataFrame(goals, TARGETS))
    drawn, report = s.rows.collect(), {r.category: r for r in s.report.collect()}
    assert len(drawn) == len({r.case_id for r in drawn}) == 100
    assert report["85+"].short and report["85+"].supply == 1 and report["85+"].drawn == 1
    assert abs(report["m"].drawn - 70) <= 2 and abs(report["f"].drawn - 30) <= 2 and not report["m"].short
    none = sampling.sample_to_targets(spark.createDataFrame([], CASES), spark.createDataFrame(goals, TARGETS))
    assert none.rows.count() == 0 and all(r.short for r in none.report.collect())


def test_joined_halves_are_the_encoding_of_the_whole():
    codec, whole = tokens.Codec(tokens.vocabulary_path(), leaf=7), tokens.Codec(tokens.vocabulary_path(), leaf=10**9)
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "Zug", " ", "  ", "\n", "12", "é", "’s", "'ll", "<|endoftext|>", "　", "\x1c", "!", "日本"]) for _ in range(rng.randrange(0, 120))) for _ in range(300)] + ["", None, " " * 500, "x" * 500]
    ids = codec.encode(texts)
    assert ids == whole.encode(texts)
    assert all(codec.decode(i) == (t or "") for i, t in zip(ids, texts))


def test_ids_of_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (3, "a")], "doc_id long, text string")
    assert sorted((r.doc_id, r.ids) for r in tokens.encode_corpus(df).collect()) == [(1, []), (2, []), (3, [64]), (3, [64])]
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def test_schedule_is_fair():
    shares = {"a": 0.5, "b": 0.3, "c": 0.2}
    done = dict.fromkeys(shares, 0)
    for slot, name, _ in mixing.schedule(shares, 1000):
        done[name] += 1
        assert all(abs(done[n] - s * (slot + 1)) < 1 + 1e-9 for n, s in shares.items())


def test_lag_and_missed_deadlines():
    shares = {"a": 0.5, "b": 0.3, "c": 0.2}
    assert mixing.largest_lag(shares, mixing.schedule(shares, 1000), 1000) < 1 and mixing.largest_lag(shares, [(i, "a", i) for i in range(10)], 10) == pytest.approx(5)
    rng = random.Random(10)
    for _ in range(2000):
        total, slots = rng.randrange(1, 10**6), rng.randrange(1, 300)
        target = total * rng.random()
        for stock in (0, int(target), int(target) + 1, target, rng.randrange(total + 1)):
            assert mixing.missed(target, float(total), slots, stock) == (stock < target)


def test_a_recipe_without_weights(spark):
    docs = spark.createDataFrame([(i, "a", 10) for i in range(20)], "doc_id long, source string, n_tokens long")
    goals = spark.createDataFrame([("z", "a", 0.0, 1, 100), ("z", "b", None, 1, 100), ("y", "a", float("nan"), None, None), ("r", "a", 1.0, 1, 100), ("r", None, 1.0, 1, 100)], "recipe_id string, source string, weight double, max_repeats int, total_tokens long")
    m = mixing.mix(docs, goals)
    assert {r.recipe_id for r in m.rows.collect()} == {"r"} and not any(r.short for r in m.report.where("recipe_id <> 'r'").collect())
    assert mixing.mix(docs, goals.where("recipe_id = 'z'")).rows.count() == 0 and mixing.mix(docs, goals.limit(0)).report.count() == 0


def test_mix_shares_caps_and_report(spark):
    docs = spark.createDataFrame([(i, " A" if i % 2 else "b-c", 10) for i in range(100)] + [(200, "b_c", 0), (201, None, 5)], "doc_id long, source string, n_tokens long")
    goals = spark.createDataFrame([("r", "a", 1.0, 1, 800), ("r", "b_c", 3.0, 1, 800), ("r", "gone", 0.0, 1, 800), ("q", "gone", 2.0, 3, 80)], "recipe_id string, source string, weight double, max_repeats int, total_tokens long")
    m = mixing.mix(docs, goals)
    report = {(r.recipe_id, r.source): r for r in m.report.collect()}
    assert all(r.lag_blocks < 1 for r in report.values()) and report["r", "a"].mixed_tokens == 200 and not report["r", "a"].short
    assert report["r", "b_c"].mixed_tokens == 500 and report["r", "b_c"].short and report["q", "gone"].short and not report["r", "gone"].short
    uses = m.rows.groupBy("recipe_id", "doc_id").count().agg(F.max("count")).first()[0]
    assert uses == 1 and mixing.mix(docs.limit(0), goals).rows.count() == 0


def test_addresses():
    read = addresses.read_address
    same = [(["8779 Barley Combe Terrace"], "Langhaven", "C. T.", "06896"), (["C/O X Y", "8779  Barlleycombe Terr"], "Langhaven", "CT", "069860987"), (["8779 BARLEYCOMBE, LANGHAVEN CT 06986"], None, None, None)]
    parsed = [read(*x) | {"uses": 1} for x in same]
    assert all(addresses.same_location(a, b) for a in parsed for b in parsed)
    other = read(["8779 Barleycombe Terrace", "Apt 3"], "Langhaven", "CT", "06986") | {"uses": 1}
    assert other["unit"] == "3" and parsed[0]["unit"] == ""
    assert read(["1388 5th Pky"], "G", "CT", "06280")["name"] == read(["1388 Fifth Parkway"], "G", "CT", "06280")["name"]
    assert read(["P.O.BOX #30381"], "G", "MA", "01255")["kind"] == "po" and read(["RR#6 Bx 375"], "A", "PA", "1")["number"] == "6/375"
    assert all(read(x, "A", "CT", "06280") is None for x in (None, [], ["UNKNOWN"], ["123 MAIN ST"], [None, " "]))


def test_address_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, i % 2, [f"{rng.randrange(1, 5)} {rng.choice(['Elmfold', 'Elmfodl', 'Oakgate'])} {rng.choice(['St', 'Street', 'Ave', ''])}"], "Town", "CT", rng.choice(["06280", None]), "x") for i in range(120)] + [(0, 0, ["x"], None, None, None, "x"), (None, 0, ["1 A St"], "T", "CT", "06280", "x")]
    df = spark.createDataFrame(rows, "address_id long, shard int, line array<string>, city string, state string, postalCode string, name string")
    got = {(r[0], r[1]) for r in addresses.expand(addresses.match_addresses(df, window=200)).collect()}
    read = {r[0]: (r[1], addresses.read_address(*r[2:6])) for r in rows[1:120]}
    uses = {}
    for form in {(s, *sorted(a.items())) for s, a in read.values() if a}:
        n = dict(form[1:])["name"]
        uses[n] = uses.get(n, 0) + 1
    want = {(i, j) for i in read for j in read if i < j and read[i][0] == read[j][0] and all(read[i][1][k] == read[j][1][k] for k in ("kind", "number", "unit")) and addresses.same_location(read[i][1] | {"uses": uses[read[i][1]["name"]]}, read[j][1] | {"uses": uses[read[j][1]["name"]]})}
    assert {p for p in got if 0 not in p} == want
    assert addresses.expand(addresses.match_addresses(df.limit(0))).count() == 0


def test_a_hot_number_loses_no_pair_at_the_shipped_window(spark):
    rng = random.Random(9)
    slip = lambda w: w if rng.random() < 0.6 else (lambda i: w[:i] + w[i + 1] + w[i] + w[i + 2 :])(rng.randrange(len(w) - 1))
    streets, towns = ["Sorrelholt", "Elmfold", "Oak", "Brambury", "Quarrystead"], [("Roshaven", "27195"), ("Langmouth", "27201"), ("Oakenford Falls", "06280"), ("Шуя", "15590")]
    rows = []
    for i in range(300):
        town, code = rng.choice(towns)
        rows.append((i, 0, [f"1 {slip(rng.choice(streets))} {rng.choice(['St', '', 'Ave'])}"], *rng.choice([(slip(town), None), (None, code), (town, code), (town, None)])))
    rows += [(400 + i, 0, [f"PO Box 7{'' if i % 2 else ' '}"], *towns[i % 4]) for i in range(40)]
    rows = [(i, s, line, town, "NC", code) for i, s, line, town, code in rows]
    schema = "address_id long, shard int, line array<string>, city string, state string, postalCode string"
    found = addresses.match_addresses(spark.createDataFrame(rows, schema))
    got = {(r.rep_a, r.rep_b) for r in found.pairs.collect()}
    everything = {(r.rep_a, r.rep_b) for r in addresses.match_addresses(spark.createDataFrame(rows, schema), window=500).pairs.collect()}
    assert got == everything and len(got) > 300


def test_only_unusable_addresses(spark):
    df = spark.createDataFrame([(1, 0, ["unknown"], None, None, None), (2, None, [None], "A", None, None)], "address_id long, shard int, line array<string>, city string, state string, postalCode string")
    assert addresses.expand(addresses.match_addresses(df)).count() == 0


def test_a_code_and_a_city_that_go_together(spark):
    line = ["9595 E Sorrelholt Circle"]
    rows = [(1, 0, line, "Roshaven", "NC", None), (2, 0, line, None, "NC", "27195-9206"), (3, 0, line, "Oakton", "NC", None), (4, 0, line, None, "SC", "27195")]
    rows += [(10 + i, 1, [f"{i} Elm St"], "Roshaven", "NC", "27195") for i in (1, 2)] + [(13, 1, ["3 Elm St"], "Oakton", "NC", "27195")]  # one slip
    df = spark.createDataFrame(rows, "address_id long, shard int, line array<string>, city string, state string, postalCode string")
    assert {tuple(r) for r in addresses.expand(addresses.match_addresses(df)).collect()} == {(1, 2)}


def test_names(spark):
    rows = [
        (1, 0, "Uleskiathoux", ["Eirlys"], None, None, 1936), (2, 0, "Eirlys", ["Uleskiathoux"], None, None, 1936), (3, 0, None, None, None, "ULESKAITHOUX, E.", 1936), (4, 0, "Uleskiathoux", ["Eirlys"], None, None, 1937),
        (5, 0, "Uleskiathoux", ["Greta"], None, None, 1936), (6, 1, "Uleskiathoux", ["Eirlys"], None, None, 1936), (7, 0, "UNKNOWN", ["UNK"], None, None, 1936), (8, 0, None, None, None, None, None), (1, 0, "Uleskiathoux", ["Eirlys"], None, None, 1936),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "name_id long, shard int, family string, given array<string>, suffix array<string>, text string, birth_year int, rep string")
    assert {tuple(r) for r in names.expand(names.link_names(df)).collect()} == {(1, 2), (1, 3), (2, 3)}
    assert names.expand(names.link_names(df.limit(0))).count() == 0
    assert strings.given_alike("bob", "robert") == 1.0 and strings.given_alike("nell", "penelope") == 1.0 and strings.given_alike("greta", "ilse") == 0.0


def test_an_initial_in_the_family_field(spark):
    assert strings.name_parts("I", ["Neigulvova"], None) == strings.name_parts("Neigulvova", ["I."], None) == (["neigulvova"], ["i"])
    assert strings.name_parts("I.", ["Garcia-Lopez", "Ann"], None) == (["garcia", "lopez"], ["i", "ann"]) and strings.name_parts("X", ["Unknown"], None) == ([], [])
    rows = [(1, 0, "I", ["Neigulvova"], None, None, 1969), (2, 0, "Neigulvova", ["Ilse"], None, None, 1969), (3, 0, "I", ["Neigulvova"], None, None, 1969), (4, 0, "i.", ["NEIGULVOAV"], None, None, 1969), (5, 0, "G", ["Neigulvova"], None, None, 1969), (6, 0, "I", ["Neigulvova"], None, None, 1970)]
    df = spark.createDataFrame(rows, "name_id long, shard int, family string, given array<string>, suffix array<string>, text string, birth_year int")
    assert {tuple(r) for r in names.expand(names.link_names(df)).collect()} == {(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)}


def test_short_cuts_equal_the_edit_distance():
    rng = random.Random(12)
    for _ in range(20_000):
        a, b = ("".join(rng.choice("abc1") for _ in range(rng.randrange(9))) for _ in "ab")
        b = b if rng.random() < 0.5 else a[:3] + a[4:5] + a[3:4] + a[5:]
        d = strings.osa(a, b)
        assert strings.within_one(a, b) == (d <= 1) and all(strings.apart(a, b, k) == (d if d <= k else None) for k in (1, 2, 3))


def test_similar_words_share_a_gram():
    rng = random.Random(7)
    pick = lambda: rng.choice("abcdé")

    def slip(w):
        i, kind = rng.randrange(len(w)), rng.randrange(4)
        return w[:i] + (pick() + w[i:], w[i + 1 :] or "a", pick() + w[i + 1 :], w[i + 1 : i + 2] + w[i] + w[i + 2 :])[kind]

    met = 0
    for _ in range(30_000):
        u = v = "".join(pick() for _ in range(rng.randrange(1, 17)))
        for _ in range(rng.randrange(4)):
            v = slip(v)
        if strings.alike(u, v):
            a, b = sorted((u, v), key=len)
            met += 1
            assert names.short_grams(a) & names.long_grams(b), (a, b)
    assert met > 20_000


def test_name_pairs_equal_brute_force(spark):
    rng = random.Random(8)
    families, givens = ["Ng", "Li", "Wu", "Ho", "Vo", "Nguyen", "Uleskiathoux", "Иванов", "Garcia-Lopez", "Brudyskides"], ["Katherine", "Kate", "K", "Katherin", "Bob", "Robert Lee", "Lee Robert", "Анна"]
    slip = lambda w: w if rng.random() < 0.5 or len(w) < 3 else (lambda i: w[:i] + w[i + 1] + w[i] + w[i + 2 :] if i + 1 < len(w) else w[:-1])(rng.randrange(len(w)))
    rows = [(i, rng.choice([0, 1, None]), slip(rng.choice(families)), [slip(rng.choice(givens))], None, None, rng.choice([1980, 1981])) for i in range(250)]
    rows += [(1000 + i, 0, slip(rng.choice(givens)), [slip(rng.choice(families))], None, None, 1980) for i in range(30)] + [(2000, 0, None, ["Nguyen Bob"], None, None, 1980), (2001, 0, "Nguyen", ["Bob"], None, None, 1980)]
    df = spark.createDataFrame(rows, "name_id long, shard int, family string, given array<string>, suffix array<string>, text string, birth_year int")
    links = names.link_names(df)
    got = {(min(r.rep_a, r.rep_b), max(r.rep_a, r.rep_b)) for r in links.pairs.collect()}
    parts = {i: strings.name_parts(f, g, t) for i, _, f, g, _, t, _ in rows}
    rep = {r.name_id: r.rep for r in links.members.collect()}
    forms = {rep[r[0]]: (r[1], r[6], *parts[r[0]]) for r in rows if rep[r[0]] == r[0]}
    count = {}
    for _, _, f, g in forms.values():
        for w in f + g:
            count[w] = count.get(w, 0) + 1
    rarity = {w: np.log(1 + 1e6 / (n + 1)) for w, n in count.items()}
    want = {(a, b) for a in forms for b in forms if a < b and forms[a][:2] == forms[b][:2] and names.agreement((*forms[a][2:], "", rarity), (*forms[b][2:], "", rarity)) >= names.SAME}
    assert got == want and len(want) > 100 and (2000, 2001) in want


def test_no_name_and_null_blocks(spark):
    rows = [(1, 5, "A Unknown", None, None, None, None), (2, None, None, None, None, " ", 5), (3, 5, "Ivanovsky", ["Anna"], None, None, None), (4, None, "Ivanovsky", ["Anna"], None, None, 5), (5, None, "Ivanovsky", ["Anna"], None, None, 5)]
    df = spark.createDataFrame(rows, "name_id long, shard int, family string, given array<string>, suffix array<string>, text string, birth_year int")
    assert {tuple(r) for r in names.expand(names.link_names(df)).collect()} == {(4, 5)}
    assert names.expand(names.link_names(df.where("name_id < 3"))).count() == 0


def test_close_vectors_share_a_place():
    rng = random.Random(4)
    for _ in range(300):
        v = rng.getrandbits(64)
        w = v
        for bit in rng.sample(range(64), entities.RADIUS):
            w ^= 1 << bit
        assert set(entities.filed(v)) & set(entities.filed(w))


PERSON = "struct<id:string,gender:string,birthDate:string,name:array<struct<use:string,family:string,given:array<string>,suffix:array<string>,text:string>>,telecom:array<struct<system:string,value:string,rank:int>>,address:array<struct<use:string,line:array<string>,city:string,state:string,postalCode:string>>,identifier:array<struct<system:string,type:struct<coding:array<struct<system:string,code:string>>>,value:string,assigner:struct<display:string>>>,extension:array<struct<url:string,valueString:string>>>"


def person(family, given, dob, phone):
    return json.dumps({"birthDate": dob, "name": [{"family": family, "given": [given]}], "telecom": [{"system": "phone", "value": phone}] if phone else None})


def test_entities(spark):
    left = [(1, 0, person("Smithson", "Katherine", "1980-01-05", "(212) 555-0100")), (2, 0, None), (3, None, person(None, None, None, None)), (1, 0, person("Smithson", "Katherine", "1980-01-05", "(212) 555-0100"))]
    right = [(11, 0, person("Smihtson", "Kate", "01/05/1980", "212.555.0100 x7")), (12, 0, person("Smithson", "Robert", "1980-01-05", "2125550100")), (13, 1, person("Smithson", "Katherine", "1980-01-05", "2125550100"))]
    frame = lambda rows, k, p: spark.createDataFrame(rows, f"{k} long, shard int, j string").select(k, "shard", F.from_json("j", PERSON).alias(p))
    a, b = frame(left, "l", "s"), frame(right, "r", "t")
    found = {(x.left, x.right): x.confidence for x in entities.match_entities(a, b, "l", "r", "s", "t").pairs.collect()}
    assert set(found) == {(1, 11), (1, 12)} and found[1, 11] > entities.SAME > found[1, 12]
    assert entities.match_entities(a.limit(0), b, "l", "r", "s", "t").pairs.count() == 0


def test_search_loses_no_likely_pair(spark):
    rng = random.Random(11)
    slip = lambda w: w if rng.random() < 0.6 else (lambda i: w[:i] + w[i + 1] + w[i] + w[i + 2 :])(rng.randrange(len(w) - 1))
    people = [(rng.choice(["Ng", "Smithson", "Uleskiathoux", "Bova", "Li"]), rng.choice(["Katherine", "Robert", "Ann", "Giorgos"]), f"19{rng.randrange(40, 99)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", f"212555{rng.randrange(1000, 9999)}") for _ in range(120)]
    frame = lambda rows, k, p: spark.createDataFrame(rows, f"{k} long, shard int, j string").select(k, "shard", F.from_json("j", PERSON).alias(p))
    left = [(i, 0, person(slip(f), slip(g), d, ph if rng.random() < 0.5 else None)) for i, (f, g, d, ph) in enumerate(people)]
    right = [(i, 0, person(f, g, d, ph if rng.random() < 0.5 else None)) for i, (f, g, d, ph) in enumerate(people)]
    m = entities.match_entities(frame(left, "l", "s"), frame(right, "r", "t"), "l", "r", "s", "t")
    met = {(x.left, x.right) for x in m.pairs.collect()}
    read = lambda j: entities.read_person(defaults(json.loads(j)))
    a, b = [read(j) for _, _, j in left], [read(j) for _, _, j in right]
    w = np.array(list(m.weights.values()))
    likely = {(i, k) for i, x in enumerate(a) for k, y in enumerate(b) if np.dot(entities.field_scores(x, y), w[:-1]) + w[-1] >= 0}
    assert len(likely) > 80 and len(likely & met) >= 0.98 * len(likely)


def test_a_contact_of_everybody_is_no_join_of_all(spark):
    rng = random.Random(13)
    families = ["Smithson", "Uleskiathoux", "Bova", "Marystiberg", "Ng", "Okafor", "Jumboubiski", "Quigirard"]
    givens = ["Katherine", "Robert", "Ann", "Giorgos", "Zebedee", "Wanjiru", "Ludmila", "Odalys", "Hyacinth", "Matthias"]
    people = [(rng.choice(families), rng.choice(givens), f"19{rng.randrange(40, 99)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", "2125550100") for _ in range(150)]
    frame = lambda rows, k, p: spark.createDataFrame(rows, f"{k} long, shard int, j string").select(k, "shard", F.from_json("j", PERSON).alias(p))
    rows = [(i, 0, person(*p)) for i, p in enumerate(people)]
    met = {(x.left, x.right) for x in entities.match_entities(frame(rows, "l", "s"), frame([(i, s, person(f, g[0], "", ph)) for (i, s, _), (f, g, _, ph) in zip(rows, people)], "r", "t"), "l", "r", "s", "t").pairs.collect()}
    assert {(i, i) for i in range(150)} <= met and len(met) < 0.45 * 150 * 150


def defaults(p):
    return {"address": None, "identifier": None, "extension": None, **p, "name": [{"suffix": None, "text": None, **n} for n in p["name"]]}


def test_calibration_without_and_with_labels():
    start = np.array([1.0, -2.0, 0.5])
    assert np.allclose(entities.calibrate(np.zeros((0, 2)), np.zeros(0), start), start)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 1)))).astype(float)
    assert np.allclose(entities.calibrate(x, y, start), [2, -1, -1], atol=0.25)
    table = entities.reliability(x, y, rng.random(4000) < 0.5, start)
    assert table["n"].sum() == 4000 and entities.calibration_error(table) < 0.03
    assert entities.calibration_error(entities.reliability(x[:0], y[:0], y[:0] > 0, start)) == 0


def test_abuse_model_on_held_out_documents(spark):
    rng = random.Random(5)
    calm = ["the parcel came today", "please call me back", "my address has changed", "thank you for the help", "the form is long", "see you on monday"]
    rude = ["you are a stupid fool", "shut up you idiot", "what a worthless idiot you are", "you stupid worthless fool"]
    text = lambda bad: ". ".join([*rng.sample(calm, 3), *([rng.choice(rude)] if bad else [])])
    docs = [(i, text(i % 4 == 0), "x") for i in range(400)] + [(900, None, "x"), (901, " ", "x"), (902, "", "x")]
    labels = [(i, int(i % 4 == 0), 1) for i in range(200)] + [(1, None, 1), (5000, 1, 1)]
    d, y = spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, flagged int, n int")
    rows = {r.doc_id: r for r in abuse.score_documents(d, abuse.fit_labels(d, y)).collect()}
    right = np.mean([rows[i].flagged == (i % 4 == 0) for i in range(200, 400)])
    assert right > 0.95 and all(rows[i].score == 0 and not rows[i].flagged for i in (900, 901, 902))
    nothing = abuse.fit_labels(d, y.limit(0))
    assert abuse.score_documents(d, nothing).where("flagged").count() == 0


def test_raters_that_err_are_outvoted():
    yes, no = np.array([1.0, 0.0, 2.0, 1.0, 0.0]), np.array([0.0, 1.0, 0.0, 1.0, 0.0])
    assert 0 < abuse.error_rate(yes, no) < 0.1 and abuse.error_rate(np.zeros(0), np.zeros(0)) > 0
    p = abuse.chances(np.array([0.001, 0.999, 0.02, 0.3, 0.0]), yes, no, 0.03)
    assert p[0] < 0.1 and p[1] > 0.9 and p[2] > 0.9 and p[3] == pytest.approx(0.3) and p[4] < 1e-5


def test_wrong_ratings_do_not_make_harmless_words_abusive(spark):
    rng = random.Random(6)
    calm = ["the parcel came today", "please call me back", "my address has changed", "the form is long", "see you on monday"]
    rude = ["you are a stupid fool", "shut up you idiot", "what a worthless idiot you are"]
    docs = [(i, ". ".join([*rng.sample(calm, 3), *([rng.choice(rude)] if i % 4 == 0 else [])])) for i in range(800)]
    labels = [(i, "a", int((i % 4 == 0) != (i % 25 == 7))) for i in range(400)]  # a rater in 25 errs
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, rater string, flagged int")
    rows = abuse.score_documents(d, abuse.fit_labels(d, y)).where("doc_id >= 400").collect()
    assert np.mean([r.flagged == (r.doc_id % 4 == 0) for r in rows]) > 0.98


@pytest.mark.parametrize("text", ["b-i-t-t-e", "bi​tte", "BITTE", "bítte"])
def test_disguises_are_undone(text):
    assert abuse.pieces(text) == [["bitte"]]
