"""Miners of look-alike pairs: blocked self-joins of keyed persons with a residual test that both can't be one person."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions import guard as G
from weftlink.functions import norm as N
from weftlink.functions.guard import a, b, side
from weftlink.session import by_sort, cut, released, stored, tasks


def blocked(df: DataFrame, keys: list[str], keep: Column, order: str = "ord") -> DataFrame:
    """Pairs of rows of one block, the earlier row first. Rows with an empty key are in no block. The equality is explicit, so the
    join is by hash or sort; blocks that hold much of the table are split by adaptive execution."""
    present = df.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() & (F.col(k) != "") for k in keys]))
    on = reduce(lambda x, y: x & y, [a(k) == b(k) for k in keys])
    return side(present, "a").join(by_sort(side(present, "b")), on & (a(order) < b(order)) & (a("id") != b("id"))).where(keep)


def shared_birth_and_zip(df: DataFrame) -> DataFrame:
    """Same postal code and birth date, other family name."""
    return blocked(df, ["zip", "dob"], (a("upper_family") != b("upper_family")) & ~G.looks_same())


def name_collisions(df: DataFrame) -> DataFrame:
    """Full names one edit apart in other places with other birth dates; the shorter name first. One edit apart means a common
    deletion, so the names meet on deletion keys and are verified: no block of all names with one first letter."""
    present = df.where((F.col("upper_family") != "") & (F.col("zip") != "") & (F.col("dob") != ""))
    names = present.select(F.col("upper_name").alias("n"), F.substring("upper_family", 1, 1).alias("f")).distinct()
    keys = names.select("n", "f", F.explode(N.near_keys(F.col("n"))).alias("key"))
    x, y = keys.select("key", F.col("n").alias("n1"), F.col("f").alias("f1")), keys.select("key", F.col("n").alias("n2"), F.col("f").alias("f2"))
    met = x.join(y, "key").where((F.col("f1") == F.col("f2")) & (F.col("n1") != F.col("n2")) & (F.length("n1") <= F.length("n2")) & N.within(F.col("n1"), F.col("n2"), 1)).select("n1", "n2", "f1").distinct()
    first = lambda s: F.substring(F.col(f"{s}_upper_family"), 1, 1)
    pairs = met.join(side(present, "a"), (F.col("n1") == a("upper_name")) & (F.col("f1") == first("a"))).join(side(present, "b"), (F.col("n2") == b("upper_name")) & (F.col("f1") == first("b")))
    earlier = (F.length("n1") < F.length("n2")) | (a("ord") < b("ord"))
    return pairs.where(earlier & (a("id") != b("id")) & (a("zip") != b("zip")) & (a("dob") != b("dob")) & ~G.looks_same()).drop("n1", "n2", "f1")


def name_collisions_blocked(df: DataFrame) -> DataFrame:
    """The same pairs by blocks of the first letter: the plain way, for comparison."""
    present = df.where((F.col("upper_family") != "") & (F.col("zip") != "") & (F.col("dob") != ""))
    on = F.substring(a("upper_family"), 1, 1) == F.substring(b("upper_family"), 1, 1)
    earlier = (F.length(a("upper_name")) < F.length(b("upper_name"))) | ((F.length(a("upper_name")) == F.length(b("upper_name"))) & (a("ord") < b("ord")))
    return side(present, "a").join(side(present, "b"), on & earlier & (a("id") != b("id"))).where((a("zip") != b("zip")) & (a("dob") != b("dob")) & (a("upper_name") != b("upper_name")) & N.within(a("upper_name"), b("upper_name"), 1) & ~G.looks_same())


def households(df: DataFrame, min_gap: int = 15) -> DataFrame:
    """One family name, place and street, birth years far apart."""
    return blocked(df, ["zip", "upper_family"], (a("dob") != "") & (b("dob") != "") & G.both("street_zip") & G.yes(G.year_gap() >= min_gap) & ~G.looks_same())


def siblings(df: DataFrame, max_gap: int = 3) -> DataFrame:
    """One family name and place, birth years close, other first name."""
    return blocked(df, ["zip", "upper_family"], (a("dob") != "") & (b("dob") != "") & (a("first") != b("first")) & G.yes(G.year_gap() <= max_gap) & ~G.looks_same())


def constructed_households(df: DataFrame, min_gap: int = 15, max_pairs: int = 250, seed: int = 0) -> DataFrame:
    """For each family name the pair of different streets with the smallest fitting gap, older person first; of at most ``max_pairs``
    families in hash order. The younger is to be given the older one's address.

    Gaps are tried in rising order of years: people meet on
    family and year, the gaps of a round are those that no pair was found for so far. Most families are done in the first round, so a
    frequent name is never joined with all of itself."""
    present = df.where((F.col("upper_family") != "") & (F.col("dob") != "") & (F.col("street_zip") != "")).withColumn("_y", N.birth_year(F.col("dob"))).where("_y is not null")
    found = None
    # one aggregate tells between which years a family has people at all
    span = present.groupBy("upper_family").agg(F.min("_y").alias("_lo"), F.max("_y").alias("_hi")).where(F.col("_hi") - F.col("_lo") >= min_gap)
    open_ = cut(present.join(span.select("upper_family"), "upper_family", "left_semi"))
    gap, width = min_gap, 1
    while True:
        gaps = F.array(*[F.lit(g) for g in range(gap, gap + width)])
        younger = open_.withColumn("_elder", F.explode(F.transform(gaps, lambda g: F.col("_y") - g)))
        met = side(open_, "a").join(side(younger, "b"), (a("upper_family") == b("upper_family")) & (a("_y") == F.col("b__elder")) & (a("id") != b("id")))
        pairs = met.where((a("street_zip") != b("street_zip")) & ~G.looks_same())
        best = pairs.groupBy(a("upper_family").alias("family_name")).agg(F.min(F.struct((F.col("b__y") - F.col("a__y")).alias("gap"), a("id").cast("string").alias("elder"), b("id").cast("string").alias("younger"))).alias("p"))
        best = cut(best)
        found = best if found is None else found.unionByName(best)
        gap, width = gap + width, width * 2
        open_ = cut(open_.join(best.select(F.col("family_name").alias("upper_family")), "upper_family", "left_anti"))
        left = open_.agg(F.max("_y") - F.min("_y")).first()[0]
        if left is None or left < gap:
            break
    return found.select("family_name", F.col("p.gap").alias("age_gap_years"), F.col("p.elder").alias("elder"), F.col("p.younger").alias("younger")).orderBy(N.digest(seed, "household", F.col("family_name")), "family_name").limit(max_pairs)


#: Institutions that people are put into, with their reserved addresses.
INSTITUTIONS = {
    "shelter": ("SYNTHETIC TEST ADDRESS - 100 SHELTER WAY", "00001"),
    "nursing_facility": ("SYNTHETIC TEST ADDRESS - 200 NURSING FACILITY DR", "00002"),
    "correctional_institution": ("SYNTHETIC TEST ADDRESS - 300 CORRECTIONAL INSTITUTION RD", "00003"),
    "hotel_short_term_housing": ("SYNTHETIC TEST ADDRESS - 400 SHORT TERM HOUSING BLVD", "00004"),
    "halfway_house": ("SYNTHETIC TEST ADDRESS - 500 HALFWAY HOUSE LN", "00005"),
    "dormitory": ("SYNTHETIC TEST ADDRESS - 600 DORMITORY HALL", "00006"),
    "group_home": ("SYNTHETIC TEST ADDRESS - 700 GROUP HOME CT", "00007"),
    "migrant_camp": ("SYNTHETIC TEST ADDRESS - 800 MIGRANT CAMP RD", "00008"),
}
INSTITUTION_CITY, INSTITUTION_STATE = "TESTCITY", "ZZ"


def at_institution(person: Column, institution: Column) -> Column:
    """A person with the address of an institution as the only one; null for an unknown institution."""
    known = F.create_map(*[x for k, (line, code) in INSTITUTIONS.items() for x in (F.lit(k), F.struct(F.lit(line).alias("line"), F.lit(code).alias("code")))])
    place = F.try_element_at(known, institution)
    address = F.array(F.struct(F.lit("home").alias("use"), F.array(place["line"]).alias("line"), F.lit(INSTITUTION_CITY).alias("city"), F.lit(INSTITUTION_STATE).alias("state"), place["code"].alias("postalCode")))
    return F.when(place.isNotNull(), person.withField("address", address))


def institution_groups(df: DataFrame, size: int = 3, seed: int = 0) -> DataFrame:
    """The groups of all institutions, with the addresses that their people share."""
    rows = [(i, line, code) for i, (line, code) in INSTITUTIONS.items()]
    return institution_pairs(df, size, seed).join(df.sparkSession.createDataFrame(rows, "institution string, line string, postalCode string"), "institution")


def institution_pairs(df: DataFrame, size: int = 3, seed: int = 0, institutions: tuple[str, ...] = tuple(INSTITUTIONS)) -> DataFrame:
    """For each institution ``size`` people of different family names who can't be one person, in hash order, as pairs that share its address.
    The first people of each order are looked at one after another (a few dozen rows), as a greedy choice must be; all orders are made in one pass."""
    each = df.where(F.col("upper_family") != "").select("id", "upper_family", F.explode(F.array(*map(F.lit, institutions))).alias("institution")).withColumn("_h", N.digest(seed, F.col("institution"), F.col("id")))
    lead = each.groupBy("institution", "upper_family").agg(F.min(F.struct("_h", "id")).alias("m")).select("institution", "m._h", F.col("m.id").alias("_i"))
    first = lead.withColumn("_r", F.row_number().over(Window.partitionBy("institution").orderBy("_h"))).where(F.col("_r") <= size * 8).drop("_r")
    pool = cut(df.join(first, F.col("id") == F.col("_i")).drop("_i"))
    met = side(pool, "a").join(side(pool, "b"), (a("institution") == b("institution")) & (a("_h") < b("_h")) & G.looks_same())
    alike = {tuple(r) for r in met.select("a_institution", "a__h", "b__h").collect()}
    chosen: dict[str, list[tuple[str, str]]] = {i: [] for i in institutions}
    for r in sorted(pool.select("institution", "_h", "id").collect()):
        own = chosen[r["institution"]]
        if len(own) < size and not any((r["institution"], h, r["_h"]) in alike for h, _ in own):
            own.append((r["_h"], r["id"]))
    kind = df.schema["id"].dataType.simpleString()
    rows = [(i, p, q) for i, own in chosen.items() for n, (_, p) in enumerate(own) for _, q in own[n + 1 :]]
    return df.sparkSession.createDataFrame(rows, f"institution string, query_id {kind}, candidate_id {kind}")


def institution_group(df: DataFrame, institution: str, size: int = 3, seed: int = 0) -> DataFrame:
    """The pairs of one institution."""
    return institution_pairs(df, size, seed, (institution,))


def placeholder_collisions(df: DataFrame, field: str, max_pairs: int = 100, seed: int = 0) -> DataFrame:
    """Strangers who will be given one dummy value: neighbours in hash order, two by two, of different families and not alike. Everybody
    is used at most once. Places in the order come from a distributed numbering, not from one sorted partition."""
    from weftlink.operators.neighbours import number_rows

    ranked = number_rows(df.where(F.col("upper_family") != "").withColumn("_h", N.digest(seed, "placeholder", field, F.col("id"))), [F.col("_h"), F.col("id")], "_r")
    twos = ranked.withColumn("_pair", F.floor(F.col("_r") / 2))
    x, y = side(twos.where("_r % 2 = 0"), "a"), side(twos.where("_r % 2 = 1"), "b")
    return x.join(y, a("_pair") == b("_pair")).where((a("upper_family") != b("upper_family")) & ~G.looks_same()).orderBy("a__pair").limit(max_pairs)


def key_list() -> Column:
    """The keys under which a person can be met by a near miss of any kind."""
    empty = F.array().cast("array<string>")
    tag = lambda t, *cols: F.when(reduce(lambda x, y: x & y, [c != "" for c in cols]), F.array(F.concat_ws("|", F.lit(t), *cols))).otherwise(empty)
    c = F.col
    name = F.when((c("first") != "") & (c("family") != ""), F.concat_ws(" ", "first", "family"))
    keys = F.concat(
        tag("dz", c("dob"), c("nzip")),
        F.transform(F.when(name.isNotNull(), N.near_keys(name)).otherwise(empty), lambda x: F.concat(F.lit("n|"), x)),
        tag("fz", c("family"), c("nzip")),
        tag("sz", c("street_zip")),
        F.transform("phones", lambda x: F.concat(F.lit("p|"), x)),
        F.transform("emails", lambda x: F.concat(F.lit("e|"), x)),
        tag("d", c("dob")),
        tag("fd", c("family"), c("dob")),
    )
    return F.array_distinct(keys)


def search_keys(df: DataFrame) -> DataFrame:
    """(id, key) for each key of each person."""
    return df.select("id", F.explode(key_list()).alias("key"))


#: What two people have in common that meet, by the kinds of near misses that surely have it: a pair counts at its kind's meeting only,
#: so that it is told once without a list of all pairs.
MEETINGS = {"birth and family": 0, "birth and place": 1, "name": 2, "family and place": 3, "address": 4, "phone": 5, "email": 6, "birth": 7}
#: The columns that guards and kinds read.
READ = ("id", "first", "family", "dob", "ssn", "phones", "emails", "nzip", "street_zip", "tokens")
#: Columns that only the tests of some meetings read: elsewhere they don't travel.
_READ_AT = {"emails": (6, 7), "nzip": (2, 4, 5, 6, 7), "street_zip": (0, 3, 5, 6), "tokens": (0, 3)}
#: The kinds that a meeting tells.
_KINDS_AT = (("twin",), ("dob_zip",), ("name",), ("sibling", "surname_zip"), ("address",), ("phone",), ("email",), ("dob_only",))
#: Borders of the hash at which near misses are counted, falling, each half of the one before.
_BORDERS = tuple("0" * n + x for n in range(4) for x in "8421")

#: Pairs that a task meets and sorts, queries asked again whose keys may be sent to all executors, people under a key and pairs that a task sorts in memory.
_PAIRS_A_TASK, _FEW, _SORTED = 1_000_000, 20_000, 250_000


def _full_name() -> Column:
    return F.when((F.col("first") != "") & (F.col("family") != ""), F.concat_ws(" ", "first", "family"))


def _values(names: Column) -> list[Column]:
    """The values under which a person meets others, by meeting."""
    empty = F.array().cast("array<string>")
    c = F.col
    tag = lambda *cols: F.when(reduce(lambda x, y: x & y, [x != "" for x in cols]), F.array(F.concat_ws("|", *cols))).otherwise(empty)
    return [tag(c("family"), c("dob")), tag(c("dob"), c("nzip")), F.coalesce(names, empty), tag(c("family"), c("nzip")), tag(c("street_zip")), c("phones"), c("emails"), tag(c("dob"))]


def meeting_keys(names: Column) -> Column:
    """(t, k): the meetings of a person and the values under which they meet there; ``names`` are full names, the person's own or those like it."""
    keys = lambda t, v: F.transform(v, lambda x: F.struct(F.lit(t).alias("t"), x.alias("k")))
    return F.concat(*[keys(t, v) for t, v in zip(MEETINGS.values(), _values(names))])


def near_names(queries: DataFrame, records: DataFrame) -> DataFrame:
    """(name, names): each full name of the queries with those of the records at most one edit away. Distinct names meet on deletion keys."""
    keys = lambda df, n: df.select(_full_name().alias(n)).where(F.col(n).isNotNull()).distinct().select(n, F.explode(N.near_keys(F.col(n))).alias("key"))
    met = keys(queries, "name").join(by_sort(keys(records, "near")), "key").where(N.within(F.col("name"), F.col("near"), 1))
    return met.groupBy("name").agg(F.collect_set("near").alias("names"))


def _narrow(df: DataFrame) -> DataFrame:
    """People at a meeting without what its tests don't read."""
    return df.withColumns({c: F.when(F.col("t").isin(*ts), F.col(c)) for c, ts in _READ_AT.items()})


def _asked(queries: DataFrame, records: DataFrame, *more: str) -> DataFrame:
    """The queries with the names that are near theirs."""
    return queries.select(*READ, *more).withColumn("_name", _full_name()).join(by_sort(near_names(queries, records).withColumnRenamed("name", "_name")), "_name", "left").drop("_name")


def _sides(asked: DataFrame, records: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """The queries and the records, each once for each value under which it meets others."""
    x = asked.select(*READ, *more, F.inline(meeting_keys(F.col("names"))))
    return _narrow(x), _narrow(records.select(*READ, F.inline(meeting_keys(F.array_compact(F.array(_full_name()))))))


def _sides_at(t: int, asked: DataFrame, records: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """``_sides`` at one meeting, which the planner knows: tests of others and columns that only they read fall away."""
    under = lambda df, names, *more: df.select(*[F.col(c) if t in _READ_AT.get(c, (t,)) else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in READ], *more, F.lit(t).alias("t"), F.explode(_values(names)[t]).alias("k"))
    return under(asked, F.col("names"), *more), under(records, F.array_compact(F.array(_full_name())))


def _told(queries: DataFrame, records: DataFrame, *more: str) -> DataFrame:
    """(a_*, b_*, kind) of all near misses, each once, with further columns of the queries."""
    return _met(*_sides(_asked(queries, records, *more), records, *more))


def _kinds() -> Column:
    """The kinds that the meeting ``t`` of a row tells."""
    return F.get(F.array(*[F.array(*[F.lit(k) for k in ks]) for ks in _KINDS_AT]), F.col("t"))


def _met(x: DataFrame, y: DataFrame, *parts: str, first: Callable[[Column], Column] | None = None) -> DataFrame:
    """The near misses of the rows of ``_sides`` that meet, if need be only those of equal ``parts`` or those that pass ``first``, a condition on their kind. Shuffled are people with their keys, never pairs:
    what a pair is follows from the two rows where they meet. The tests of a meeting are those of ``G.near_miss_kind`` that are open there."""
    x, y = side(x, "a"), side(y, "b")
    at = lambda m: a("t") == MEETINGS[m]
    other_family, other_first = a("family") != b("family"), a("first") != b("first")
    place = G.both("dob") & G.both("nzip")
    named = G.yes((a("dob") != b("dob")) & (a("nzip") != b("nzip")))
    named_alike = named & N.within(G.full_name("a"), G.full_name("b"), 1)
    once = lambda c: (F.size(a(c)) == 1) | (F.size(b(c)) == 1) | (a("k") == F.array_min(F.array_intersect(a(c), b(c))))
    fits = (
        F.when(at("birth and place"), other_family)
        .when(at("name"), named)
        .when(at("family and place"), other_first & ~G.twins())
        .when(at("address"), other_family & ~place)
        .when(at("phone"), other_family & ~place & ~G.both("street_zip") & once("phones") & ~named_alike)
        .when(at("email"), other_family & ~place & ~G.both("street_zip") & ~G.overlap("phones") & once("emails") & ~named_alike)
        .otherwise(other_family & other_first & ~G.both("nzip") & ~G.overlap("phones") & ~G.overlap("emails"))
    )
    on = reduce(lambda p, q: p & q, [a(c) == b(c) for c in ("t", "k", *parts)])
    named_kinds = {"birth and family": "twin", "birth and place": "dob_zip", "name": "name", "address": "address", "phone": "phone", "email": "email", "birth": "dob_only"}
    kind = F.when(at("family and place"), F.when(G.yes(G.year_gap() <= 3), "sibling").otherwise("surname_zip"))
    for m, k in named_kinds.items():
        kind = kind.when(at(m), k)
    keep = F.when(at("birth and family"), G.twins()).otherwise(fits & ~G.looks_same())
    if first:  # as it costs least
        keep = F.when(first(kind), keep).otherwise(F.lit(False))
    return x.join(by_sort(y), on & (a("id") != b("id"))).where(keep).withColumn("kind", kind)


def near_miss_counts(queries: DataFrame, records: DataFrame) -> DataFrame:
    """(a_id, kind, seen): how many people of ``records`` are near misses of a query, by kind. Pairs are counted where they meet."""
    return _told(queries, records).groupBy("a_id", "kind").agg(F.count("*").alias("seen"))


def _dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The rows dealt out by ``keys`` to ``n`` tasks, where the session would give more to a task than it sorts in memory: what it spills is disk."""
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def near_misses(queries: DataFrame, records: DataFrame, cap: int = 10, seed: int = 0) -> DataFrame:
    """People of ``records`` who look like a query but are somebody else: (a_id, b_id, kind, seen, rank). Kept are the first ``cap`` of a query and
    kind in hash order; ``seen`` counts all. Pairs are counted first, in all and below some borders of the hash; then they meet again and
    only those below the lowest border that leaves ``cap`` of them are tested and ranked. No pair beyond is shuffled or written. Both are one plan, so that
    the records are dealt out to their meetings once."""
    asked = cut(_asked(queries, records))
    n = records.count() * len(MEETINGS) // _SORTED
    return _ranked(asked, lambda asked, *more: _sides(asked, records, *more), lambda df, *keys: _dealt(df, n, *keys), cap, seed)


def near_misses_in_turn(queries: DataFrame, records: DataFrame, cap: int = 10, seed: int = 0) -> DataFrame:
    """The rows of ``near_misses``, one meeting after the other: a kind is told at one meeting only, so that each is whole by itself. What is written
    are ranked pairs; the disk holds the shuffles of one meeting, not those of all. ``queries`` and ``records`` are read once a meeting."""
    spark = queries.sparkSession
    asked = released(_asked(queries, records), "asked")
    # a meeting's tasks differ in pairs more than in bytes: a few for each core even that out
    n = max(tasks(spark), 4 * spark.sparkContext.defaultParallelism, records.count() // _SORTED)
    deal = lambda df, *keys: df.repartition(n, *keys)
    turns = [_ranked(asked, lambda asked, *more, t=t: _sides_at(t, asked, records, *more), deal, cap, seed) for t in MEETINGS.values()]
    return reduce(DataFrame.unionByName, [released(ranked.select("a_id", "b_id", "kind", "seen", "rank"), "near") for ranked in turns])


def _ranked(asked: DataFrame, sides: Callable[..., tuple[DataFrame, DataFrame]], deal: Callable[..., DataFrame], cap: int, seed: int) -> DataFrame:
    """(a_id, b_id, kind, seen, rank) of the first near misses; ``sides`` gives the rows that meet, ``deal`` deals them out by keys."""
    h = N.digest(seed, "near_miss", a("id"), b("id"))
    x, y = sides(asked)
    y = deal(y, "t", "k")
    below = [F.count_if(F.col("_h") < x).alias(f"_n{i}") for i, x in enumerate(_BORDERS)]
    counts = _met(deal(x, "t", "k"), y).select("a_id", "kind", h.alias("_h")).groupBy("a_id", "kind").agg(F.count("*").alias("seen"), *below)
    border = F.lit("g")  # above all hex digits
    for i, x in enumerate(_BORDERS):
        border = F.when(F.col(f"_n{i}") >= cap, x).otherwise(border)
    counts = counts.select("a_id", "kind", "seen", border.alias("border"))
    counts = counts.groupBy("a_id").agg(F.map_from_entries(F.collect_list(F.struct("kind", F.struct("border", "seen")))).alias("told"))
    again = sides(asked.join(by_sort(counts), F.col("id") == F.col("a_id")).drop("a_id"), "told")[0]
    again = again.withColumn("told", F.map_filter("told", lambda kind, _: F.array_contains(_kinds(), kind))).where(F.size("told") > 0)
    told = lambda kind: F.try_element_at(a("told"), kind)
    met = _met(deal(again, "t", "k"), y, first=lambda kind: F.coalesce(h < told(kind)["border"], F.lit(False)))
    kept = met.select("a_id", "b_id", "kind", told(F.col("kind"))["seen"].alias("seen"))
    slot = Window.partitionBy("a_id", "kind").orderBy(h, b("id"))
    # dealt out before the hash is made: 32 characters a pair needn't travel
    return deal(kept.repartition("a_id"), "a_id").withColumn("rank", F.row_number().over(slot)).where(F.col("rank") <= cap)


def drawn_near_misses(queries: DataFrame, records: DataFrame, cap: int = 10, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Near misses where everybody may be a query: pairs (query_id, candidate_id, kind), which ``first_drawn`` cuts to ``cap`` of a query and kind, and
    (query_id, n), how many of them there are at least after that. Each query has ``cap`` of a kind, or all of them where there are fewer; they
    are others than those of ``near_misses``, which compares a query with everybody that it meets. Here the records of a meeting are dealt out
    by hash to parts of about twice the cap and a query meets its own part. Queries that find less than ``cap`` of a kind there meet eight parts at
    once, and so on up to the whole meeting. Pairs are cut to ``cap`` in the task that meets them
    and written; those of a query and kind that was asked again lie among the later ones."""
    spark = queries.sparkSession
    asked = stored(_asked(queries, records), "asked")
    _, y = _sides(asked, records)
    sizes = lambda df, c: df.groupBy("t", "k").agg(F.count("*").alias(c))
    x = _sides(asked, records)[0]
    met = sizes(x, "nx").join(by_sort(sizes(y, "ny")), ["t", "k"]).groupBy("t").agg(F.sum(F.col("nx") * F.col("ny")).alias("pairs"))
    n_asked = x.groupBy("t").agg(F.approx_count_distinct("id").alias("n"))
    per = {r["t"]: r["pairs"] / r["n"] for r in met.join(by_sort(n_asked), "t").collect()}  # a row per meeting
    parts = {t: 1 << max(0, int(log2(max(1.0, n / (2 * cap))))) for t, n in per.items()}
    pairs, counts = [], []
    while parts:
        of = reduce(lambda w, t: w.when(F.col("t") == t, parts[t]), parts, F.when(F.lit(False), 1))
        part = lambda df: df.where(F.col("t").isin(*parts)).withColumn("c", N.draw(of, seed, "part", F.col("id")))  # noqa: E731, B023
        x, y = _sides(asked, records, *(["done"] if counts else []))
        if counts:
            x = x.where(F.col("t").isin(*parts)).withColumn("wanted", F.array_except(_kinds(), F.coalesce("done", F.array().cast("array<string>")))).where(F.size("wanted") > 0).drop("done")
        n = {r["t"]: r["n"] for r in x.where(F.col("t").isin(*parts)).groupBy("t").agg(F.count("*").alias("n")).collect()}  # a row per meeting
        parts = {t: p for t, p in parts.items() if t in n}
        if not parts:
            break
        x, y = part(x), part(y)
        if few := [t for t in parts if counts and n[t] <= _FEW]:
            keys = cut(x.where(F.col("t").isin(*few)).select("t", "k", "c").distinct())
            y = y.where(~F.col("t").isin(*few)).unionByName(y.where(F.col("t").isin(*few)).join(F.broadcast(keys), ["t", "k", "c"], "left_semi"))
        dealt = max(tasks(spark), round(sum(n[t] * per[t] / parts[t] for t in parts) / _PAIRS_A_TASK))
        told = _met(x.repartition(dealt, "t", "k", "c"), y.repartition(dealt, "t", "k", "c"), "c", first=(lambda kind: F.array_contains(a("wanted"), kind)) if counts else None)
        # in one task anyway: the window needs no shuffle
        slot = Window.partitionBy("a_t", "a_k", "a_c", "a_id", "kind").orderBy(_drawn(a("id"), b("id"), seed), b("id"))
        first = told.select("a_t", "a_k", "a_c", "a_id", "b_id", "kind").withColumn("_r", F.row_number().over(slot)).where(F.col("_r") <= cap)
        pairs.append(stored(first.select(a("id").alias("query_id"), b("id").alias("candidate_id"), "kind"), "near"))
        counts.append(stored(pairs[-1].groupBy("query_id", "kind").agg(F.count("*").alias("n")), "near_counts"))
        parts = {t: max(1, p // 8) for t, p in parts.items() if p > 1}
        if parts:
            # of every round so far: a round tells only the kinds that were wanted of it
            done = reduce(DataFrame.unionByName, counts).where(F.col("n") >= cap).groupBy("query_id").agg(F.collect_set("kind").alias("done"))
            asked = asked.drop("done").join(by_sort(done), F.col("id") == F.col("query_id"), "left").drop("query_id")
    if not pairs:  # nobody meets anybody
        kind = queries.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, candidate_id {kind}, kind string"), spark.createDataFrame([], f"query_id {kind}, n long")
    most = reduce(DataFrame.unionByName, counts).groupBy("query_id", "kind").agg(F.least(F.max("n"), F.lit(cap)).alias("n"))
    return reduce(DataFrame.unionByName, pairs), most.groupBy("query_id").agg(F.sum("n").alias("n"))


def _drawn(query: Column, candidate: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit("near_miss"), query, candidate)


def draw_order(seed: int = 0) -> list[Column]:
    """The order in which ``drawn_near_misses`` of a query and kind count."""
    return [_drawn(F.col("query_id"), F.col("candidate_id"), seed), F.col("candidate_id")]


def same_person_ids(probe: DataFrame, known: DataFrame) -> DataFrame:
    """(probe_id, id) of people with an equal usable SSN or identity key."""
    ident = F.when((F.col("first") != "") & (F.col("family") != "") & (F.col("dob") != ""), F.concat_ws("|", F.lit("k"), "first", "family", "dob"))
    keys = lambda df, n: df.select(F.col("id").alias(n), F.explode(F.array_compact(F.array(F.concat(F.lit("s|"), F.col("ssn")), ident))).alias("key"))
    return keys(probe, "probe_id").join(by_sort(keys(known, "id")), "key").select("probe_id", "id").distinct()


def duplicate_ids(probe: DataFrame, known: DataFrame) -> DataFrame:
    """(probe_id, id) of probable duplicates, met by near keys of the SSN, or of the birth date together with what else must agree: a
    phone, a name one edit apart, or, on one day, the first or the family name. A birth date alone joins nobody. Dates that are
    close agree in their year or in all that follows it."""
    empty = F.array().cast("array<string>")
    put = lambda tag, xs: F.transform(xs, lambda x: F.concat(F.lit(tag), x))
    whole = F.when((F.col("first") != "") & (F.col("family") != ""), F.concat_ws(" ", "first", "family"))
    others = F.concat(put("p", F.col("phones")), put("n", F.when(whole.isNotNull(), N.near_keys(whole)).otherwise(empty)))
    halves = F.array(F.substring("dob", 1, 4), F.right("dob", F.lit(5)))
    day = lambda tag, c: F.when(F.col(c) != "", F.array(F.concat_ws("|", F.lit(tag), "dob", c))).otherwise(empty)
    dated = F.when(F.col("dob") != "", F.concat(day("f", "first"), day("g", "family"), F.flatten(F.transform(halves, lambda x: put("d", F.transform(others, lambda o: F.concat_ws("|", x, o))))))).otherwise(empty)
    # as numbers, half the bytes: should two keys fall on one, the pair is tested as any other
    block = F.array_distinct(F.transform(F.concat(put("s|", F.when(F.col("ssn").isNotNull(), N.near_keys(F.col("ssn"))).otherwise(empty)), dated), lambda x: F.xxhash64(x)))
    keys = lambda df, n: df.select(F.col("id").alias(n), F.explode(block).alias("key"))
    met = keys(probe, "pid_").join(by_sort(keys(known, "kid_")), "key").where("pid_ <> kid_").select("pid_", "kid_").distinct()
    pairs = met.join(by_sort(side(probe, "a")), F.col("pid_") == a("id")).join(by_sort(side(known, "b")), F.col("kid_") == b("id"))
    return pairs.where(G.probable_duplicate()).select(a("id").alias("probe_id"), b("id").alias("id"))
