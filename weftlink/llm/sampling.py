"""Samples that match target proportions of categories (problem 1).

Cases are counted by request and cell (the combination of their categories under the request's margins). Iterative proportional
fitting rakes the cells' expected draws to all margins at once, never beyond a cell's supply and never below the minimum of a
category as far as its supply goes. Within the sample every row has the key -ln(u) / weight with u from a hash of its id: the rows
with the smallest keys are a weighted sample. Whole-number quotas per cell, repaired for minimums, cut the keys exactly; what
remains between targets and draws is reported.

Cells are few (combinations of categories), rows are not. A case has one key for all requests, so cases are counted once per cell
and narrow key range; requests work on these counts, and only rows that a request draws are joined to it. The cut through a cell is
found from the counts, so only the rows of one range are ever sorted together, however many rows a category holds. Requests draw by
the same keys: a case that one request draws is likelier to be drawn by another.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.operators.prefix import hash_key
from weftlink.session import cut

#: The category of rows that a request doesn't name.
REST = "(rest)"
#: Ranges of the logarithm of the key per unit.
FINE = 1024


def canonical(label: Column) -> Column:
    """Lower case, trimmed, one plain hyphen in bands of numbers, underscores inside words; null if it says nothing."""
    plain = F.lower(F.trim(F.regexp_replace(label, "[‐-―−]", "-")))
    banded = F.when(plain.rlike(r"^[0-9]"), F.regexp_replace(plain, r"\s+", "")).otherwise(F.regexp_replace(plain, r"[\s_\-]+", "_"))
    return F.when(~banded.isin("", "unknown", "n/a", "na", "none", "null"), banded)


def category(key: Column, strata: Column, rationale: Column) -> Column:
    """A case's category under a strata key; the pair type is read from the rationale where strata doesn't say it."""
    said = canonical(F.try_element_at(strata, key))
    return F.when(key == "pair_type", F.coalesce(said, canonical(F.regexp_extract(rationale, r"^([^/(]*)", 1)))).otherwise(said)


def rake(supply: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray, np.ndarray]], size: float, rounds: int = 200) -> np.ndarray:
    """Expected draws per cell. ``margins``: (category index of each cell, target per category, minimum per category).

    Starts from the supply and scales to each margin in turn; draws stay within the supply. What a scarce category leaves open goes
    to the cells that still have rows, in proportion to their draws, so that ``size`` rows come out if there are as many."""
    draws = supply * min(1.0, size / max(supply.sum(), 1.0))
    for _ in range(rounds):
        before = draws.copy()
        for index, target, least in margins:
            goal = np.maximum(target, least)
            goal = goal * min(1.0, size / goal.sum()) if goal.sum() else goal
            goal = np.maximum(goal, least)
            now = np.bincount(index, draws, len(target))
            have = np.bincount(index, supply, len(target))
            fresh = (now == 0) & (goal > 0)
            draws = np.where(fresh[index], supply / np.maximum(have[index], 1) * goal[index], draws * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[index])
            draws = np.minimum(draws, supply)
        if np.abs(draws - before).max(initial=0) < 1e-9 * max(size, 1):
            break
    for _ in range(rounds):  # the open rest
        gap = min(size, supply.sum()) - draws.sum()
        room = draws < supply
        base = np.where(room, np.maximum(draws, 1e-9), 0.0)
        if gap < 1e-6 or not room.any():
            break
        draws = np.minimum(supply, draws + gap * base / base.sum())
    return draws


def whole(draws: np.ndarray, supply: np.ndarray, size: int, margins: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Whole quotas by largest remainders, then repaired so that no category lies under its minimum while it has rows."""
    quota = np.floor(draws + 1e-9).astype(np.int64)
    goal = int(min(size, supply.sum()))
    for cell in np.argsort(-(draws - quota), kind="stable"):
        if quota.sum() >= goal:
            break
        quota[cell] += quota[cell] < supply[cell]
    for index, _, least in margins:
        for c in range(len(least)):
            own = index == c
            while quota[own].sum() < min(least[c], supply[own].sum()):
                grow = np.flatnonzero(own & (quota < supply))[0]
                quota[grow] += 1
                if quota.sum() > goal:
                    others = [i for i in np.argsort(-quota, kind="stable") if not own[i] and all(quota[x == x[i]].sum() > m[x[i]] for x, _, m in margins)]
                    if not others:
                        break
                    quota[others[0]] -= 1
    return quota


@dataclass
class Sample:
    """``rows``: the drawn cases; ``report``: supply, target, draws and gap per request and category."""

    rows: DataFrame
    report: DataFrame


def sample_to_targets(cases: DataFrame, targets: DataFrame, seed: int = 0) -> Sample:
    """Draw, for each request, its number of distinct cases with the target shares of its categories.

    ``cases``: case_id, strata, rationale, frequency (a row's design weight; null, NaN, infinite and non-positive values count as 1).
    ``targets``: request_id, strata_key, category, target_share, min_rows, sample_rows; a request may name several strata keys.
    A case delivered twice counts once; a null case_id is no case; null shares and minimums count as 0; a case without a category
    belongs to the rest, which only fills what the named categories leave open. Requests without cases give reports without draws."""
    goals = targets.select("request_id", "strata_key", "category", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce(F.col("min_rows").cast("long"), F.lit(0).cast("long")).alias("min_rows"), F.coalesce(F.col("sample_rows").cast("long"), F.lit(0).cast("long")).alias("sample_rows")).distinct()
    usable = F.col("frequency").isNotNull() & ~F.isnan("frequency") & (F.col("frequency") > 0) & (F.col("frequency") < float("inf"))
    keys = [r[0] for r in goals.where("strata_key is not null").select("strata_key").distinct().sort("strata_key").collect()]  # the keys of the requests, not data
    said = F.array(*[F.coalesce(category(F.lit(k), F.col("strata"), F.col("rationale")), F.lit(REST)) for k in keys]).cast("array<string>")
    once = cases.where("case_id is not null").select("case_id", said.alias("_cell"), F.when(usable, F.col("frequency")).otherwise(1.0).alias("_weight"))
    once = once.groupBy("case_id").agg(F.min(F.struct("_cell", "_weight")).alias("p")).select("case_id", "p.*")
    u = (hash_key(F.lit(seed), F.col("case_id")).cast("double") + 1.0) / F.lit(float(2**63) + 2.0)
    rows = once.select("case_id", "_cell", F.log(-F.log(u) / F.col("_weight")).alias("_key")).withColumn("_range", F.floor(F.col("_key") * FINE))
    counts = cut(rows.groupBy("_cell", "_range").agg(F.count("*").alias("n")))

    # what a request sees of a cell: its own keys, and of these the categories that it names
    parts = counts.select("_cell").distinct().select("_cell", F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in keys]).cast("array<string>"), F.col("_cell"))).alias("strata_key", "category"))
    named = goals.select("request_id", "strata_key", "category", F.lit(True).alias("_named")).distinct()
    seen = parts.join(goals.select("request_id", "strata_key").distinct(), "strata_key").join(named, ["request_id", "strata_key", "category"], "left")
    seen = seen.groupBy("request_id", "_cell").agg(F.sort_array(F.collect_list(F.struct("strata_key", F.when(F.col("_named"), F.col("category")).otherwise(REST).alias("c")))).alias("p"))
    seen = cut(seen.select("request_id", "_cell", F.expr("transform(p, x -> x.c)").alias("cell")))
    ranges = counts.join(seen, "_cell").groupBy("request_id", "cell", "_range").agg(F.sum("n").alias("n"))
    cells = ranges.groupBy("request_id", "cell").agg(F.sum("n").alias("supply"))
    wanted = goals.groupBy("request_id").agg(F.max("sample_rows").alias("size"), F.collect_list(F.struct("strata_key", "category", "target_share", "min_rows")).alias("goals"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Quotas of a request's cells, and what raking left of each of its targets."""
        size, listed, request = int(pdf["size"].iloc[0]), pdf["goals"].iloc[0], pdf["request_id"].iloc[0]
        pdf = pdf[pdf["supply"].notna()]
        supply = pdf["supply"].to_numpy(dtype=float)
        margins, named = [], []
        for at, key in enumerate(sorted({g["strata_key"] for g in listed})):
            own = {g["category"]: (g["target_share"] * size, g["min_rows"]) for g in listed if g["strata_key"] == key}
            names = [*sorted(own), REST]
            rest = max(0.0, size - sum(t for t, _ in own.values()))
            place = {n: i for i, n in enumerate(names)}
            margins.append((np.array([place[c[at]] for c in pdf["cell"]], dtype=np.int64), np.array([own[n][0] for n in names[:-1]] + [rest]), np.array([own[n][1] for n in names[:-1]] + [0], dtype=float)))
            named.append((key, names))
        draws = rake(supply, margins, size)
        quota = whole(draws, supply, size, margins)
        out = [(request, list(c), int(q), None, None, 0, False) for c, q in zip(pdf["cell"], quota)]
        for (key, names), (index, target, least) in zip(named, margins):
            have, reached, got = (np.bincount(index, x, len(names)) for x in (supply, draws, quota))
            goal = np.maximum(target, least)
            scarce = (reached < goal) & (have < goal)  # a gap that raking leaves and no further row could close
            out += [(request, None, int(got[i]), key, n, int(have[i]), bool(scarce[i])) for i, n in enumerate(names[:-1])]
        return pd.DataFrame(out, columns=["request_id", "cell", "quota", "strata_key", "category", "supply", "short"])

    asked = wanted.join(cells, "request_id", "left")
    raked = cut(asked.groupBy("request_id").applyInPandas(run, "request_id string, cell array<string>, quota long, strata_key string, category string, supply long, short boolean"))
    quotas = raked.where("strata_key is null").select("request_id", "cell", "quota")
    before = Window.partitionBy("request_id", "cell").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = ranges.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(quotas, ["request_id", "cell"]).withColumn("_take", F.col("quota") - F.col("_before")).where("_take > 0")
    cuts = cuts.join(seen, ["request_id", "cell"]).select("request_id", "cell", "_cell", "_range", "_take", "n")
    inside = rows.join(cuts, ["_cell", "_range"])
    sure = inside.where("_take >= n").select("request_id", "case_id", "cell")
    edge = inside.where("_take < n").withColumn("_rank", F.row_number().over(Window.partitionBy("request_id", "cell", "_range").orderBy("_key", "case_id"))).where("_rank <= _take").select("request_id", "case_id", "cell")
    drawn = sure.unionByName(edge)

    per_category = raked.where("strata_key is not null").select("request_id", "strata_key", "category", "supply", F.col("quota").alias("drawn"), "short")
    report = goals.join(per_category, ["request_id", "strata_key", "category"], "left")
    report = report.withColumn("needed", F.greatest(F.col("min_rows").cast("double"), F.col("target_share") * F.col("sample_rows"))).withColumns({"gap": F.col("needed") - F.col("drawn"), "actual_share": F.coalesce(F.try_divide(F.col("drawn").cast("double"), F.col("sample_rows")), F.lit(0.0))})
    return Sample(drawn, report)
