"""The pair tier: labelled pairs of every generator in one frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.functions import guard as G
from weftlink.functions import norm as N
from weftlink.functions.exclusion import Policy
from weftlink.functions.guard import a, b
from weftlink.operators import drift, mine, mutate
from weftlink.plans.persona import as_person, people
from weftlink.session import apart, cut, in_turn, spread, stored


def positives(flat: DataFrame, seed: int = 0, profile: drift.Profile = drift.Profile()) -> DataFrame:
    """(pid, pair_type, subtype, person, variant) of edited records: single edits, compound edits, accents and marks, and life events."""
    # written once, each record beside its flat row: every edit is one projection of it, without joins. A small file of people stands for much work
    own = cut(as_person(spread(flat), "given", "family", "dob", "gender", "zip", "street", "phone", "email", "ssn").drop("ord").withColumnRenamed("person", "source"))
    text = own.withColumn("dob", F.date_format("dob", "yyyy-MM-dd"))
    back = lambda df: df.withColumn("dob", F.col("dob").cast("date"))
    who = F.col("pid")
    base = own.select("pid", F.col("source").alias("person"))
    edited = {
        "fuzzy_variant": (mutate.fuzzy(text, seed).where("mutation is not null"), F.col("mutation")),
        "compound_variant": (mutate.compound(text, 2, seed).where("mutations <> ''"), F.col("mutations")),
        "diacritic": (text.withColumn("_n", mutate.diacritic(F.col("given"), who, seed)).where("_n <> given").withColumn("given", F.col("_n")).drop("_n"), F.lit("diacritic")),
        "punctuation": (text.withColumn("_n", mutate.punctuation(F.col("family"), who, seed)).where("_n <> family").withColumn("family", F.col("_n")).drop("_n"), F.lit("punctuation")),
    }
    parts = []
    for kind, (df, subtype) in edited.items():
        made = as_person(back(df.withColumn("subtype", subtype)), "source", "subtype")
        pair_type = kind if kind.endswith("variant") else "normalization_edge_case"
        parts.append(made.select("pid", F.lit(pair_type).alias("pair_type"), "subtype", F.col("source").alias("person"), F.col("person").alias("variant")))
    events = drift.variants(base, base, profile, seed).select("pid", F.col("scenario").alias("pair_type"), "subtype", "person", "variant")
    return in_turn(parts).unionByName(events)


#: Fields that get a dummy value in common. People of an institution.
COLLISION_FIELDS = ("ssn", "phone", "dob")
INSTITUTIONS = tuple(mine.INSTITUTIONS)
GROUP = 3


def constructed(k: DataFrame, seed: int = 0) -> DataFrame:
    """(source_id, target_id, pair_type, subtype) of pairs of different people whose records are to be changed: an address of an elder,
    dummy values in common, institutions. A pair may be in several kinds, as its records differ in each."""
    kind = k.schema["id"].dataType
    told = lambda df, x, y, t, s: df.select(x.cast(kind).alias("source_id"), y.cast(kind).alias("target_id"), F.lit(t).alias("pair_type"), F.lit(s).alias("subtype"))
    parts = [told(mine.constructed_households(k, seed=seed), F.col("elder"), F.col("younger"), "special_population", "multi_generational_household")]
    parts += [told(mine.placeholder_collisions(k, f, seed=seed), a("id"), b("id"), "placeholder_collision_negative", f) for f in COLLISION_FIELDS]
    inside = mine.institution_pairs(k, GROUP, seed)
    parts.append(inside.select(F.col("query_id").alias("source_id"), F.col("candidate_id").alias("target_id"), F.lit("special_population").alias("pair_type"), F.col("institution").alias("subtype")))
    return in_turn(parts)


def negatives(flat: DataFrame, seed: int = 0, cap: int = 3) -> DataFrame:
    """(source_id, target_id, pair_type, subtype) of pairs of different people: mined ones, where the first kind of a pair counts, and
    constructed ones."""
    k = cut(people(flat))  # the keys are read by every miner
    ids = lambda df: df.select(a("id").alias("source_id"), b("id").alias("target_id"))
    mined = {
        "hard_negative": ids(mine.shared_birth_and_zip(k)),
        "name_collision_negative": ids(mine.name_collisions(k)),
        "household_member_negative": ids(mine.households(k)),
        "sibling_negative": ids(mine.siblings(k)),
    }
    parts = [stored(df, "mined").select("source_id", "target_id", F.lit(n).alias("pair_type"), F.lit("").alias("subtype"), F.lit(i).alias("prio")) for i, (n, df) in enumerate(mined.items())]
    # written by themselves: what is planned with others is planned anew after each of their stages
    near = stored(mine.near_misses(k, k, cap, seed).select("a_id", "b_id", "kind"), "near")
    names = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in G.PAIR_TYPES.items() for x in kv]), F.col("kind")), F.lit("near_miss_negative"))
    parts.append(near.select(a("id").alias("source_id"), b("id").alias("target_id"), names.alias("pair_type"), F.col("kind").alias("subtype"), F.lit(len(mined)).alias("prio")))
    together = reduce(DataFrame.unionByName, parts)
    pair = F.struct("prio", "source_id", "target_id", "pair_type", "subtype")
    once = together.groupBy(F.least("source_id", "target_id").alias("lo"), F.greatest("source_id", "target_id").alias("hi")).agg(F.min(pair).alias("p")).select("p.source_id", "p.target_id", "p.pair_type", "p.subtype")
    return once.unionByName(constructed(k, seed))


def pair_tier(flat: DataFrame, seed: int = 0, profile: drift.Profile = drift.Profile(), exclude: bool = True) -> DataFrame:
    """(case_id, source_id, pair_type, subtype, label): matches without those that the exclusion drops, and all non-matches."""
    made = positives(flat, seed, profile)
    kept = Policy().kept(apart(made), "person", "variant") if exclude else made  # the rules are planned once, not into the edits of each part
    yes = kept.select(F.concat_ws(":", "pair_type", "subtype", F.col("pid").cast("string")).alias("case_id"), F.col("pid").alias("source_id"), "pair_type", "subtype", F.lit(True).alias("label"))
    no = negatives(flat, seed).select(F.concat_ws(":", "pair_type", "subtype", F.col("source_id").cast("string"), F.col("target_id").cast("string")).alias("case_id"), "source_id", "pair_type", "subtype", F.lit(False).alias("label"))
    return in_turn([yes]).unionByName(no)  # the non-matches are read from what is written of each kind: a plan of one shuffle


def labelled_keys(flat_dup: DataFrame) -> DataFrame:
    """Keyed pairs with a label for rule evaluation: people of one family and ZIP, a match where one is the other's copy."""
    pairs = mine.blocked(people(flat_dup), ["family", "zip"], F.lit(True))
    return pairs.withColumn("label", b("id") == a("id") + 10000000).withColumn("id", N.digest(a("id"), b("id")))
