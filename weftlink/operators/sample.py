"""Quotas, stratified samples, caps and splits by hash order: deterministic, independent of the order of rows, and exact."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions import norm as N

#: Age bands from their lower bound, target shares, and the year ages are counted in.
BANDS = (("0-17", 0), ("18-64", 18), ("65-84", 65), ("85+", 85))
TARGETS = {"0-17": 0.215, "18-64": 0.612, "65-84": 0.1535, "85+": 0.0195}
AS_OF = 2017


def age_of(dob: Column, as_of: int = AS_OF) -> Column:
    """A difference of years, not of birthdays; null for an unreadable date."""
    return F.lit(as_of) - N.birth_year(dob)


def band_of(age: Column) -> Column:
    """The band of an age; null for a negative or absent age."""
    out = F.when(age < 0, F.lit(None).cast("string"))
    for (name, _), (_, above) in zip(BANDS, BANDS[1:]):
        out = out.when(age < above, name)
    return out.when(age >= BANDS[-1][1], BANDS[-1][0])


def quotas(n: int, shares: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers by largest remainder that add up to n; ties by name."""
    if n < 0 or sum(shares.values()) <= 0:
        raise ValueError("n must not be negative and the shares must add up to more than 0")
    exact = {k: n * v / sum(shares.values()) for k, v in shares.items()}
    out = {k: int(v) for k, v in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], k))[: n - sum(out.values())]:
        out[k] += 1
    return out


def first_per_group(df: DataFrame, group: list[str], order: list[Column], k: int | Column, rank: str = "rank") -> DataFrame:
    """The first k rows of each group in a total order. A constant k is planned with a limit inside each task before the shuffle, so a
    hot group sends k rows a task, not all of its rows."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def stratified(df: DataFrame, n: int, donors: int = 0, seed: int = 0, shares: Mapping[str, float] = TARGETS) -> DataFrame:
    """``n`` people whose bands have the target shares (role sample) and the next ones in the same shares (role donor), of rows with
    ``id`` and ``band``; fewer where a band has fewer people. Quotas are constants, so ranks beyond them are cut early."""
    first, more = quotas(n, shares), quotas(donors, shares) if donors else dict.fromkeys(shares, 0)
    most = max(first[b] + more[b] for b in shares)
    lit = lambda q: F.try_element_at(F.create_map(*[x for b, v in q.items() for x in (F.lit(b), F.lit(v))]), F.col("band"))
    ranked = first_per_group(df.where(F.col("band").isin(*shares)), ["band"], [N.digest(seed, F.col("id")), F.col("id")], most)
    return ranked.withColumn("role", F.when(F.col("rank") <= lit(first), "sample").when(F.col("rank") <= lit(first) + lit(more), "donor")).where("role is not null")


def rebalance(df: DataFrame, share: float, seed: int = 0, floor: int = 25) -> DataFrame:
    """Rows (id, category, is_match) with matches dropped, in proportion to their categories and not below ``floor`` of each, until
    the others have ``share`` of all. Only counts come to the driver, per category and slice of the hash order: rows beyond the slice in
    which a category's limit falls are dropped where they are made, so that only about as many as are kept get sorted."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    h = N.digest(seed, "rebalance", F.col("category"), F.col("id"))
    slices: dict = {}
    for r in df.groupBy("category", "is_match", F.when(F.col("is_match"), F.substring(h, 1, 3)).alias("s")).count().collect():  # at most 4,096 a category
        slices.setdefault((r["category"], r["is_match"]), {})[r["s"]] = r["count"]
    counts = {k: sum(v.values()) for k, v in slices.items()}
    groups = {c: n for (c, m), n in counts.items() if m}
    budget = int(sum(n for (_, m), n in counts.items() if not m) * (1 - share) / share)
    total = sum(groups.values())
    if total <= budget:
        return df
    least = {c: min(n, floor) for c, n in groups.items()}
    keep = {c: min(n, max(least[c], round(n * budget / total))) for c, n in groups.items()}
    while sum(keep.values()) > budget and (open_ := [c for c in keep if keep[c] > least[c]]):
        keep[max(open_, key=lambda c: (keep[c], c))] -= 1
    last = {c: next((s for s, upto in zip(sorted(slices[c, True]), accumulate(n for _, n in sorted(slices[c, True].items()))) if upto >= keep[c]), "fff") for c in keep}
    of = lambda values: F.try_element_at(F.create_map(*[x for c, n in values.items() for x in (F.lit(c), F.lit(n))]), F.col("category"))
    near = df.where("is_match").where(F.substring(h, 1, 3) <= of(last))
    matches = first_per_group(near, ["category"], [h, F.col("id")], max(keep.values()), "_rank").where(F.col("_rank") <= of(keep)).drop("_rank")
    return df.where("not is_match").unionByName(matches)


def stratified_split(df: DataFrame, strata: list[str], holdout: float = 0.7, seed: int = 0) -> DataFrame:
    """Add ``holdout``: true for the first ceil(n * share) rows of each stratum in hash order. Strata are cut at an exact rank that comes
    from counts per slice of the hash range (``running_sum``), so no stratum is sorted in one task."""
    from weftlink.operators.prefix import running_sum

    placed = running_sum(df.withColumn("_h", N.order_key(seed, "split", F.col("id"))).withColumn("_one", F.lit(1)), strata, "_h", "_one", "_before", ["id"])
    sizes = df.groupBy(*strata).agg(F.count("*").alias("_n"))
    on = [F.col(f"_s{i}").eqNullSafe(F.col(s)) for i, s in enumerate(strata)]
    sizes = sizes.select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], "_n")
    return placed.join(sizes, on).withColumn("holdout", F.col("_before") < F.ceil(F.col("_n") * F.lit(holdout))).drop("_h", "_one", "_before", "_n", *[f"_s{i}" for i in range(len(strata))])


def folds(df: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Add ``fold`` (1..k): equal parts in hash order, the first ones larger by one row if need be. Places come from ``running_sum``, not
    from one sorted partition."""
    from weftlink.operators.prefix import running_sum

    placed = running_sum(df.withColumns({"_h": N.order_key(seed, "fold", F.col("id")), "_one": F.lit(1)}), [], "_h", "_one", "_place", ["id"])
    total = df.agg(F.count("*").alias("_n"))  # one row
    place, n = F.col("_place"), F.col("_n")
    small, larger = F.floor(n / k), n % k
    border = larger * (small + 1)
    fold = F.when(place < border, F.floor(place / (small + 1))).otherwise(larger + F.floor((place - border) / F.greatest(small, F.lit(1)))) + 1
    return placed.join(F.broadcast(total)).withColumn("fold", fold.cast("int")).drop("_h", "_one", "_place", "_n")
