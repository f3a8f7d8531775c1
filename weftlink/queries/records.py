"""Queries over the nested raw records (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.operators.shred import latest, shred_records
from weftlink.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of every person with the path of its parent."""
    raw = latest(table(spark, sf_dir, "raw_records"), "record_id", "payload")
    return shred_records(raw, values=False).select("record_id", "patient_pos", "node_path", "parent_path")


def p3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flat tables in one: each node with its table, the link to its parent and its scalar members as a map."""
    return shred_records(latest(table(spark, sf_dir, "raw_records"), "record_id", "payload"))


def p3_table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and linked parents of each flat table."""
    nodes = shred_records(latest(table(spark, sf_dir, "raw_records"), "record_id", "payload"), values=False)
    return nodes.groupBy("node_table").agg(F.count("*").alias("n_rows"), F.count_if(F.col("parent_path") == "").alias("n_top"), F.countDistinct("record_id", "patient_pos").alias("n_persons"))


QUERIES = {"p3_found": p3_found, "p3_tables": p3_tables, "p3_table_sizes": p3_table_sizes}
ORACLES: dict[str, str] = {}
