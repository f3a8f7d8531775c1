"""Sorted neighbourhoods: every row meets the rows that follow it in a global order, within a fixed window.

The order is cut into partitions by sampled ranges and numbered through, so that neither a frequent key nor a range border matters:
rows are then dealt out in blocks of equal length by their number, and the first rows of a block also go to the block before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.session import cut, tasks

#: Rows of a block.
BLOCK = 2048


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: the place of each row (from 0) in the total order; equal rows come in any, but one fixed, order."""
    ranged = df.repartitionByRange(tasks(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = cut(ranged.withColumns({"_pid": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = placed.groupBy("_pid").agg(F.count("*").alias("_n"))  # one row for each partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_pid").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), F.col("_pid") == F.col("_p")).withColumn(out, F.col("_at") + F.col("_start")).drop("_pid", "_at", "_p", "_start")


def sorted_pairs(df: DataFrame, order: list[Column], width: int, keep: Column, columns: list[str] | None = None) -> DataFrame:
    """Pairs (a, b) of rows as structs of ``columns`` (default: all): b follows a by less than ``width`` places in the order and
    ``keep``, a condition on the columns ``a`` and ``b``, holds. Null keys sort first and are compared like any other; an empty
    table has no pairs."""
    columns = columns or df.columns
    ranked = number_rows(df, order, "_r").select(*columns, "_r").withColumn("_b", F.floor(F.col("_r") / BLOCK))
    late = ranked.where(F.col("_r") % BLOCK < width - 1).where("_b > 0").withColumn("_b", F.col("_b") - 1)
    both = ranked.withColumn("_own", F.lit(True)).unionByName(late.withColumn("_own", F.lit(False)))
    row = F.struct(*columns)
    following = Window.partitionBy("_b").orderBy("_r").rowsBetween(1, width - 1)
    met = both.select("_own", row.alias("a"), F.collect_list(row).over(following).alias("_next"))
    return met.where("_own").select("a", F.explode("_next").alias("b")).where(keep)
