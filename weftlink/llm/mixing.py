"""Mixing sources to target weights (problem 7).

The documents of a source stand in one fixed random order, repeated pass after pass, up to a capped number of passes; a recipe takes
from each source the first documents until the source's share of the total is reached. The stream of a source is cut into blocks of
equal size. Block k of a source with share s may not run before slot floor(k / s) and must run before slot ceil((k + 1) / s);
earliest deadline first then interleaves the sources so that none is ever a block or more ahead or behind its share.

Running sums are two-level (``running_sum``), so no source, however large, is sorted in one task; only the schedule, whose
number of slots is a parameter, is made in one piece per recipe.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from math import ceil, floor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.operators.prefix import hash_key, running_sum
from weftlink.session import cut

#: Slots of a recipe's schedule; a block is the total size of the mix divided by it.
SLOTS = 2048


def canonical_source(source: Column) -> Column:
    """Trimmed, in lower case, with hyphens as underscores."""
    return F.translate(F.lower(F.trim(source)), "-", "_")


def schedule(shares: dict[str, float], slots: int) -> list[tuple[int, str, int]]:
    """(slot, source, block) of a fair schedule: windows from the shares, earliest deadline first, ties by name."""
    waiting, ready, out = [], [], []
    for name, s in shares.items():
        if s > 0:
            heapq.heappush(waiting, (0, ceil(1 / s), name, 0))
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, deadline, name, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, name, k))
        if not ready:
            continue
        _, name, k = heapq.heappop(ready)
        out.append((slot, name, k))
        s = shares[name]
        heapq.heappush(waiting, (floor((k + 1) / s), ceil((k + 2) / s), name, k + 1))
    return out


def largest_lag(shares: dict[str, float], rows: list[tuple[int, str, int]], slots: int) -> float:
    """By how many blocks a source was at most ahead of its share or behind it, after any slot. A source's lag is extreme just before
    and just after one of its own slots, and at the end."""
    done, most = dict.fromkeys(shares, 0), 0.0
    for slot, name, _ in rows:
        before = shares[name] * slot - done[name]
        done[name] += 1
        most = max(most, abs(before), abs(shares[name] * (slot + 1) - done[name]))
    return max([most, *(abs(s * slots - done[n]) for n, s in shares.items())], default=0.0)


def missed(target: float, total: float, slots: int, stock: float) -> bool:
    """Whether a source with so many tokens can't fill one of its blocks by the block's deadline; the last block ends at the target."""
    blocks, block = max(1, ceil(target / total * slots)), total / slots
    filled = min(blocks, int(stock / block))
    return any(stock < (target if k == blocks - 1 else min((k + 1) * block, target)) for k in range(max(0, filled - 1), blocks))


@dataclass
class Mix:
    """``rows``: one per use of a document; ``report``: target and actual shares per recipe and source, and the schedule's largest lag."""

    rows: DataFrame
    report: DataFrame


def mix(docs: DataFrame, targets: DataFrame, slots: int = SLOTS) -> Mix:
    """Mix ``docs`` (doc_id, source, n_tokens) by ``targets`` (recipe_id, source, weight, max_repeats, total_tokens).

    A null, NaN or negative weight counts as 0, a null or negative number of repeats as 0; repeated target rows count once; rows of
    docs without tokens are never used; a document that comes twice with one doc_id counts once; a null source matches no target.
    Empty tables give an empty mix and a report of what is missing. ``rows``: recipe_id, slot, source, doc_id, repeat_no (from 0),
    n_tokens, at_token (where the use begins within its source's stream). Order by (slot, at_token) to read the mix. ``report``: a
    source is short if its stream ends before the deadline of one of its blocks; ``lag_blocks`` is the schedule's largest lag in
    blocks (below 1), a document that is longer than a block adds its own length."""
    weight = F.when(F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") < 0), 0.0).otherwise(F.col("weight"))
    wanted = targets.select("recipe_id", canonical_source(F.col("source")).alias("source"), weight.alias("weight"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).cast("long").alias("max_repeats"), F.col("total_tokens").cast("long").alias("total_tokens"))
    wanted = wanted.groupBy("recipe_id", "source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"), F.max("total_tokens").alias("total_tokens"))
    sums = wanted.groupBy("recipe_id").agg(F.sum("weight").alias("_sum")).withColumnRenamed("recipe_id", "_recipe")
    wanted = wanted.join(sums, F.col("recipe_id").eqNullSafe(F.col("_recipe"))).withColumn("target_share", F.coalesce(F.try_divide("weight", "_sum"), F.lit(0.0))).drop("_recipe", "_sum")

    once = docs.select("doc_id", canonical_source(F.col("source")).alias("source"), "n_tokens").groupBy("doc_id").agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens")).where("n_tokens > 0 and source is not null")
    supply = once.groupBy("source").agg(F.sum("n_tokens").alias("supply_tokens"), F.count("*").alias("supply_docs"))
    plan = wanted.join(supply, "source", "left").withColumns({"supply_tokens": F.coalesce("supply_tokens", F.lit(0)), "supply_docs": F.coalesce("supply_docs", F.lit(0)), "target_tokens": F.col("target_share") * F.col("total_tokens")})

    placed = running_sum(once.withColumn("_h", hash_key(F.col("doc_id"))), ["source"], "_h", "n_tokens", "_start", ["doc_id"]).drop("_h")
    # a use is taken where most of it lies before the target, so that the last one brings the source nearer to its share
    uses = F.least(F.col("max_repeats"), F.ceil((F.col("target_tokens") - F.col("_start") - F.col("n_tokens") / 2) / F.col("supply_tokens")))
    taken = placed.join(plan.where("supply_tokens > 0 and target_tokens > 0").select("recipe_id", "source", "target_tokens", "total_tokens", "supply_tokens", "max_repeats"), "source").withColumn("_uses", uses).where("_uses > 0")
    taken = taken.withColumn("repeat_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_uses").cast("long") - 1))).withColumn("at_token", F.col("repeat_no") * F.col("supply_tokens") + F.col("_start"))
    taken = taken.withColumn("_block", F.floor(F.col("at_token") * F.lit(float(slots)) / F.col("total_tokens")))

    recipe = wanted.schema["recipe_id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row per source: the slots of its blocks in order, whether it misses a deadline, and the recipe's largest lag."""
        shares, total = dict(zip(pdf["source"], pdf["target_share"])), float(pdf["total_tokens"].fillna(0).max())
        rows = schedule(shares, slots)
        own = {name: [] for name in shares}
        for slot, name, _ in rows:
            own[name].append(slot)
        stock = (pdf["max_repeats"] * pdf["supply_tokens"]).tolist()
        short = [total > 0 and target > 0 and missed(target, total, slots, have) for target, have in zip(pdf["target_tokens"], stock)]
        return pdf[["recipe_id", "source"]].assign(slots=[own[n] for n in pdf["source"]], short=short, lag_blocks=largest_lag(shares, rows, slots))

    scheduled = cut(plan.where("source is not null").groupBy("recipe_id").applyInPandas(run, f"recipe_id {recipe}, source string, slots array<long>, short boolean, lag_blocks double"))
    slots_of = scheduled.select("recipe_id", "source", F.posexplode("slots").alias("_block", "slot"))
    # a source's last block can begin past its last slot by rounding: it then goes into the final slot
    rows = taken.join(slots_of, ["recipe_id", "source", "_block"], "left").select("recipe_id", F.coalesce("slot", F.lit(slots - 1)).alias("slot"), "source", "doc_id", "repeat_no", "n_tokens", "at_token")
    used = taken.groupBy("recipe_id", "source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.countDistinct("doc_id").alias("mixed_docs"), F.max(F.col("repeat_no") + 1).alias("most_repeats"))
    report = plan.join(used, ["recipe_id", "source"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("mixed_tokens", "mixed_docs", "most_repeats")})
    total = report.groupBy("recipe_id").agg(F.sum("mixed_tokens").alias("_all"))
    report = report.join(scheduled.drop("slots"), ["recipe_id", "source"], "left").withColumn("short", F.coalesce("short", F.lit(False)))
    report = report.join(total, "recipe_id").withColumn("actual_share", F.coalesce(F.try_divide(F.col("mixed_tokens").cast("double"), F.col("_all")), F.lit(0.0))).drop("_all")
    return Mix(rows, report)
