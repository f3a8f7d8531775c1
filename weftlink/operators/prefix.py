"""Distributed running sums and exact top-k without a window over a whole (possibly hot) group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of a group's hash range; the second level holds one row per group and slice.
SLICES = 4096


def hash_key(*cols: Column) -> Column:
    """A 63-bit non-negative hash used as the random order of rows; equal inputs always give the same place."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)


def running_sum(df: DataFrame, group: list[str], order: str, value: str, out: str, tie: list[str]) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group that come before this row in ``order`` (exclusive).

    ``order`` must be a non-negative 63-bit long spread evenly (see ``hash_key``); ``tie`` breaks equal hashes. The group is
    cut into slices of its hash range: sums per slice are combined map-side, their running sum is a window over at most
    ``SLICES`` rows a group, and only the rows of one slice are sorted together. Null values count as 0; null groups are
    groups of their own; an empty input gives an empty result."""
    sliced = df.withColumn("_slice", F.floor(F.col(order) / F.lit(2**63 // SLICES)).cast("int"))
    totals = sliced.groupBy(*group, "_slice").agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_slice").alias("_s"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    on = F.col("_slice") == F.col("_s")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    within = Window.partitionBy(*group, "_slice").orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_local", F.coalesce(F.sum(F.coalesce(F.col(value), F.lit(0))).over(within), F.lit(0)))
    joined = local.join(totals, on, "inner")
    return joined.withColumn(out, F.col("_base") + F.col("_local")).drop("_slice", "_s", "_base", "_local", *[f"_g{i}" for i in range(len(group))])
