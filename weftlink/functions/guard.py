"""Predicates on pairs of keyed persons (``a_*`` and ``b_*`` columns): could both be one person, are they twins, what do they share.
Absent values never agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.functions import norm as N


def a(name: str) -> Column:
    return F.col(f"a_{name}")


def b(name: str) -> Column:
    return F.col(f"b_{name}")


def side(df: DataFrame, s: str) -> DataFrame:
    """The columns of one side of a pair."""
    return df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns])


def yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def both(name: str) -> Column:
    """Equal and not empty."""
    return yes((a(name) == b(name)) & (a(name) != ""))


def overlap(name: str) -> Column:
    return yes(F.arrays_overlap(a(name), b(name)))


def same_ssn() -> Column:
    return yes(a("ssn") == b("ssn"))


def near_ssn() -> Column:
    return N.within(a("ssn"), b("ssn"), 1)


def same_identity() -> Column:
    """Equal first name, family name and birth date, all present."""
    return both("first") & both("family") & both("dob")


def possible_same() -> Column:
    return same_ssn() | same_identity()


def full_name(s: str) -> Column:
    first, family = F.col(f"{s}_first"), F.col(f"{s}_family")
    return F.when((first != "") & (family != ""), F.concat_ws(" ", first, family))


def probable_duplicate() -> Column:
    close = N.dates_close(a("dob"), b("dob"))
    variant = both("family") & both("dob") & N.given_variant(a("first"), b("first"))
    return near_ssn() | (close & (overlap("phones") | (both("first") & both("dob")) | variant | N.within(full_name("a"), full_name("b"), 1)))


def looks_same() -> Column:
    """What no pair of different people may be."""
    return possible_same() | probable_duplicate()


def distinct_given() -> Column:
    """First names three or more edits apart that aren't variants, and neither record knows the other's name."""
    fa, fb = a("first"), b("first")
    crossed = F.array_contains(a("tokens"), fb) | F.array_contains(b("tokens"), fa)
    related = F.exists(a("tokens"), lambda x: F.exists(b("tokens"), lambda y: ((x == fa) | (y == fb)) & N.given_variant(x, y)))
    return yes((fa != "") & (fb != "") & ~N.given_variant(fa, fb) & ~N.within(fa, fb, 2) & ~crossed & ~related)


def twins() -> Column:
    return both("dob") & both("family") & distinct_given() & ~near_ssn() & (overlap("phones") | both("street_zip"))


def year_gap() -> Column:
    return F.abs(N.birth_year(a("dob")) - N.birth_year(b("dob")))


#: The kinds of near misses, the first that holds counts.
KINDS = ("twin", "dob_zip", "name", "sibling", "address", "phone", "email", "dob_only", "surname_zip")
#: Kinds whose pairs agree on one of ``features`` by what they are: a birth date, family name, address, phone or e-mail.
SHARING = tuple(k for k in KINDS if k != "name")
#: The kind as a pair type.
PAIR_TYPES = {"twin": "twin_like_negative", "dob_zip": "hard_negative", "name": "name_collision_negative", "sibling": "sibling_negative"}


def near_miss_kind() -> Column:
    """What a query and another person share, or null."""
    other_family, other_first = a("family") != b("family"), a("first") != b("first")
    same_zip = both("nzip")
    name = yes((a("dob") != b("dob")) & (a("nzip") != b("nzip"))) & N.within(full_name("a"), full_name("b"), 1)
    surname = both("family") & same_zip & other_first
    return (
        F.when(twins(), "twin")
        .when(both("dob") & same_zip & other_family, "dob_zip")
        .when(name, "name")
        .when(surname & yes(year_gap() <= 3), "sibling")
        .when(both("street_zip") & other_family, "address")
        .when(overlap("phones") & other_family, "phone")
        .when(overlap("emails") & other_family, "email")
        .when(both("dob") & other_family & other_first, "dob_only")
        .when(surname, "surname_zip")
    )


def features() -> dict[str, Column]:
    """Agreement of a pair by field."""
    return {
        "phone": overlap("all_phones"),
        "email": overlap("emails"),
        "ssn": same_ssn(),
        "dob": both("dob"),
        "name_dob": same_identity(),
        "family": both("family"),
        "given": both("first"),
        "address": both("street_zip"),
    }


#: Points of the combined baseline and the score from which it says match.
POINTS, MATCH_FROM = {"ssn": 4, "name_dob": 3, "dob": 2, "given": 2, "family": 2, "address": 1, "phone": 1, "email": 1}, 6


def baselines() -> dict[str, Column]:
    """Matchers over the feature columns of a pair."""
    single = {f"{f}_only": F.col(f) for f in ("phone", "email", "ssn", "dob", "name_dob", "address")}
    score = sum((F.col(f).cast("int") * w for f, w in POINTS.items()), F.lit(0))
    return single | {"multi_field": score >= MATCH_FROM}


def two_of_three() -> Column:
    return both("first").cast("int") + both("family").cast("int") + both("dob").cast("int") >= 2
