"""The pool tier: each query with its matches and decoys among a fixed number of candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions import guard as G
from weftlink.functions import norm as N
from weftlink.functions.guard import a, b
from weftlink.operators import drift, mine
from weftlink.plans.persona import as_person, people
from weftlink.session import by_sort, stored, tasks


def thin(matches: DataFrame, profile: drift.Profile = drift.Profile(), seed: int = 0) -> DataFrame:
    """Rows (query_id, candidate_id, ...) of matches, without those of some queries and all but one of others, by the profile's rates."""
    roll = N.uniform(seed, "match_count", F.col("query_id"))
    none, single = profile.rate("query_no_match"), profile.rate("query_single_match")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(N.digest(seed, "match", F.col("query_id"), F.col("candidate_id")), "candidate_id"))
    return matches.withColumn("_n", nth).where((roll >= none) & ((roll >= none + single) | (F.col("_n") == 1))).drop("_n")


def strangers(queries: DataFrame, people: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """(query_id, candidate_id) of people who are surely somebody else, about three pools full for each query: everybody's hash falls into one
    of many slices, a query reads the slices after its own. No query meets the whole table; ``slices`` grows with the table, so that
    a slice holds about ``size`` people."""
    slices = max(1, people.count() // size)
    at = N.draw(slices, seed, "slice", F.col("id"))
    read = ("id", "first", "family", "dob", "ssn", "phones")  # what ``G.looks_same`` reads: pairs are tested where they meet
    asked = queries.select(*read, F.explode(F.array(*[F.pmod(at + i, F.lit(slices)) for i in range(min(3, slices))])).alias("slice"))
    met = G.side(asked, "a").join(by_sort(G.side(people.select(*read, at.alias("slice")), "b")), (a("slice") == b("slice")) & (a("id") != b("id")))
    return met.where(~G.looks_same()).select(a("id").alias("query_id"), b("id").alias("candidate_id"))


def place(every: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """(query_id, candidate_id, is_match, category, place, rationale) from candidates (query_id, candidate_id, is_match, category, prio): the
    first way in which somebody came in counts, lower priorities come first, matches are never cut, places are drawn by hash."""
    once = every.groupBy("query_id", "candidate_id").agg(F.min(F.struct("prio", "category", "is_match")).alias("m")).select("query_id", "candidate_id", "m.*")
    order = Window.partitionBy("query_id").orderBy("prio", N.digest(seed, "fill", F.col("query_id"), F.col("candidate_id")), "candidate_id")
    trimmed = once.withColumn("_r", F.row_number().over(order)).where(F.col("is_match") | (F.col("_r") <= size))
    shuffled = Window.partitionBy("query_id").orderBy(N.digest(seed, "place", F.col("query_id"), F.col("candidate_id")), "candidate_id")
    placed = trimmed.withColumn("place", F.row_number().over(shuffled)).drop("_r", "prio")
    # over the rows of a query, which lie together here
    told = F.array_sort(F.collect_set(F.when(~F.col("category").isin("match", "stranger"), F.col("category"))).over(Window.partitionBy("query_id")))
    return placed.withColumn("_c", told).withColumn("rationale", F.concat(F.lit("population"), F.when(F.size("_c") > 0, F.concat(F.lit("/"), F.array_join("_c", "+"))).otherwise(""))).drop("_c")


def keys(flat: DataFrame, *columns: str, dealt: bool = False) -> DataFrame:
    """The flat keys of the people, written once. They are dealt out first, unless they are: a small file of keys stands for much work."""
    return stored(people(flat if dealt else flat.repartition(tasks(flat.sparkSession))).select(*columns), "people")


def pools(flat_dup: DataFrame, size: int = 40, seed: int = 0, profile: drift.Profile = drift.Profile(), cap: int = 10) -> DataFrame:
    """(query_id, candidate_id, is_match, category, place, rationale); everybody is a query. Matches are the copies of a query, thinned so that
    some queries have none or one; decoys are near misses in order of kind, then strangers drawn by hash. Strangers are looked for where near
    misses don't fill the pool; elsewhere none could come in. Candidates are dealt out by query once, all that follows stays there."""
    k = keys(flat_dup, *mine.READ)  # read by every join below
    old, new = k.where("id < 10000000"), k.where("id >= 10000000")
    matches = mine.same_person_ids(old, new).unionByName(mine.duplicate_ids(old, new)).distinct().select(F.col("probe_id").alias("query_id"), F.col("id").alias("candidate_id"))
    near, told = mine.drawn_near_misses(old, old, cap, seed)
    short = stored(old.join(by_sort(told.where(F.col("n") >= size).select(F.col("query_id").alias("id"))), "id", "left_anti"), "short")
    every = [thin(matches, profile, seed).select("query_id", "candidate_id", F.lit("match").alias("kind")), near]
    if not short.isEmpty():
        every.append(strangers(short, old, size, seed).select("query_id", "candidate_id", F.lit("stranger").alias("kind")))
    rows = reduce(DataFrame.unionByName, every)
    n = max(tasks(k.sparkSession), near.count() // 500_000)
    nth = F.dense_rank().over(Window.partitionBy("query_id", "kind").orderBy(*mine.draw_order(seed)))  # a pair told twice has one rank
    rank = F.array_position(F.array(*[F.lit(x) for x in G.KINDS]), F.col("kind")).cast("int")
    ranked = rows.repartition(n, "query_id").withColumn("_n", nth)
    is_match, is_near = F.col("kind") == "match", ~F.col("kind").isin("match", "stranger")
    prio = F.when(is_match, 0).when(is_near, F.col("_n") * 10 + rank).otherwise(100000)
    cand = ranked.where(~is_near | (F.col("_n") <= cap)).select("query_id", "candidate_id", is_match.alias("is_match"), F.col("kind").alias("category"), prio.cast("int").alias("prio"))
    # of one priority are the matches, the strangers, or one near miss: beyond the first ``size`` priorities no near miss can come in
    level = F.dense_rank().over(Window.partitionBy("query_id").orderBy("prio"))
    return place(cand.withColumn("_p", level).where((F.col("_p") <= size) | (F.col("prio") == 100000)).drop("_p"), size, seed)


def listed(long: DataFrame) -> DataFrame:
    """One row per query with ordered arrays; a pool has a fixed size. Rows stay where those of their query lie."""
    row = F.struct("place", F.col("candidate_id").cast("string").alias("id"), "is_match")
    rows = long.groupBy("query_id", "rationale").agg(F.array_sort(F.collect_list(row)).alias("c"))
    return rows.select("query_id", "rationale", F.transform("c", lambda x: x["id"]).alias("candidate_ids"), F.transform(F.filter("c", lambda x: x["is_match"]), lambda x: x["id"]).alias("match_ids"))


def as_arrays(long: DataFrame) -> DataFrame:
    """``listed`` for the sink, where ids are texts."""
    return listed(long).withColumn("query_id", F.col("query_id").cast("string"))


def with_query(long: DataFrame, flat: DataFrame) -> DataFrame:
    """``as_arrays`` with the record of each query. The flat rows of the people go to the pools, which stay where they were filled, and become
    records there: neither arrays nor records are shuffled."""
    own = listed(long).join(by_sort(flat), F.col("query_id") == F.col("pid"))
    made = as_person(own, "rationale", "candidate_ids", "match_ids")
    return made.select(F.col("pid").cast("string").alias("query_id"), "rationale", "candidate_ids", "match_ids", F.col("person").alias("query"))
