"""Shredding against a plain walk, and its edge cases."""

import json

from weftlink.operators.shred import REPEATED, ROOTS, latest, parse, persons, shred_records, vacant

SCHEMA = "record_id long, payload string, received_at timestamp, parent_path string"


def walk(value, path, parent, out):
    if not isinstance(value, dict):
        return
    for name, x in value.items():
        p = (path + "." if path else "") + name
        if name in REPEATED or isinstance(x, list):
            for i, e in enumerate(x if isinstance(x, list) else [x]):
                if not vacant(e):
                    q = f"{p}[{i}]"
                    if name in REPEATED:
                        out.add((q, parent))
                    walk(e, q, q if name in REPEATED else parent, out)
        else:
            walk(x, p, parent, out)


PERSON = {
    "resourceType": "Patient",
    "name": [None, {"family": "A", "given": ["x", " ", "y"], "extension": {"url": "u"}}, {"use": None}],
    "identifier": {"type": {"coding": [{"code": "a"}, {}, {"code": "b"}]}, "assigner": {"identifier": {"type": {"coding": {"code": "o"}}}}},
    "address": [{"line": "same", "extension": [{"extension": [{"v": 0.5}, {"v": 1.5}]}]}, {"line": []}, {"line": ["p", None, "q"]}],
    "extension": "text",
    "other": [{"name": ["no"]}],
}


def test_levels_give_the_same_nodes_as_a_walk(spark):
    payloads = [(1, json.dumps(PERSON)), (2, json.dumps(json.dumps(PERSON))), (3, json.dumps({"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Organization", "name": "o"}}, {"resource": PERSON}]}))]
    df = spark.createDataFrame([(k, p, None, "clash") for k, p in payloads], SCHEMA)
    got = {(r.record_id, r.patient_pos, r.node_path, r.parent_path) for r in shred_records(df, values=False).collect()}
    want = set()
    for k, p in payloads:
        for pos, person in persons(parse(p)):
            out = set()
            walk({m: person[m] for m in ROOTS if m in person}, "", "", out)
            want |= {(k, pos, *x) for x in out}
    assert got == want
    assert (3, 1, "identifier[0].assigner.identifier[0].type.coding[0]", "identifier[0].assigner.identifier[0]") in got


def test_members_and_tables(spark):
    df = spark.createDataFrame([(1, json.dumps(PERSON), None, "")], SCHEMA)
    rows = {r.node_path: r for r in shred_records(df).collect()}
    assert rows["name[1]"].members == {"family": "A"} and rows["name[1].given[2]"].members == {"": "y"}
    assert rows["identifier[0].type.coding[2]"].node_table == "identifier[].type.coding[]"


def test_broken_and_empty_payloads_have_no_nodes(spark):
    rows = [(1, None), (2, ""), (3, '{"name": [{"fam'), (4, "null"), (5, "[]"), (6, "{}"), (7, '{"name": [null, {}, " ", []]}'), (8, '"{\\"name\\": 1"')]
    df = spark.createDataFrame([(k, p, None, "") for k, p in rows], SCHEMA)
    assert shred_records(df).count() == 0 and shred_records(df.coalesce(1), values=False).count() == 0
    assert shred_records(df.limit(0)).count() == 0
    assert [r.record_id for r in shred_records(spark.createDataFrame([(None, '{"name": [{"family": "A"}]}', None, "")], SCHEMA)).collect()] == [None]


def test_a_key_counts_once(spark):
    df = spark.createDataFrame([(1, "a", None, ""), (1, "a", None, ""), (None, "b", None, ""), (None, "b", None, ""), (None, "c", None, ""), (None, None, None, "")], SCHEMA)
    assert sorted((r.record_id is None, r.payload or "") for r in latest(df, "record_id", "payload").collect()) == [(False, "a"), (True, ""), (True, "b"), (True, "c")]
