"""The driver's contract: names of queries and their SQL."""

import __spark_entry__


def test_names():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60 and "p3_found" in queries


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["record_id", "patient_pos", "node_path", "parent_path"]
