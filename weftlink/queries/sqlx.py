"""Pieces of SQL that mirror the predicates on pairs (aliases a and b over the key tables of ``keys_sql``)."""

from weftlink.functions.norm import nickname_pairs
from weftlink.plans.persona import PERSONA_SQL, keys_sql

NICK = "(" + ",".join(f"'{p}'" for p in nickname_pairs()) + ")"
SWAP = "(length(a.dob)=10 AND length(b.dob)=10 AND substr(a.dob,1,4)=substr(b.dob,1,4) AND substr(a.dob,6,2)=substr(b.dob,9,2) AND substr(a.dob,9,2)=substr(b.dob,6,2))"
CLOSE = f"(levenshtein(a.dob,b.dob)<=1 OR {SWAP})"
VARIANT = f"(starts_with(a.first,b.first) OR starts_with(b.first,a.first) OR a.first||'|'||b.first IN {NICK})"
NEAR_SSN = "coalesce(levenshtein(a.ssn,b.ssn)<=1,false)"
SAME = "(coalesce(a.ssn=b.ssn,false) OR (a.first=b.first AND a.family=b.family AND a.dob=b.dob))"
DUP = f"({NEAR_SSN} OR ({CLOSE} AND (coalesce(a.phone=b.phone,false) OR (a.first=b.first AND a.dob=b.dob) OR (a.family=b.family AND a.dob=b.dob AND {VARIANT}) OR levenshtein(a.full_name,b.full_name)<=1)))"
ALIKE = f"({SAME} OR {DUP})"
DISTINCT = f"(NOT {VARIANT} AND levenshtein(a.first,b.first)>2)"
TWINS = f"(a.dob=b.dob AND a.family=b.family AND {DISTINCT} AND NOT {NEAR_SSN} AND (coalesce(a.phone=b.phone,false) OR a.street_zip=b.street_zip))"
GAP = "abs(CAST(substr(a.dob,1,4) AS INT)-CAST(substr(b.dob,1,4) AS INT))"
KIND = f"""CASE WHEN {TWINS} THEN 'twin' WHEN a.dob=b.dob AND a.nzip=b.nzip AND a.family<>b.family THEN 'dob_zip'
 WHEN a.dob<>b.dob AND a.nzip<>b.nzip AND levenshtein(a.full_name,b.full_name)<=1 THEN 'name'
 WHEN a.family=b.family AND a.nzip=b.nzip AND a.first<>b.first AND {GAP}<=3 THEN 'sibling'
 WHEN a.street_zip=b.street_zip AND a.family<>b.family THEN 'address' WHEN a.phone=b.phone AND a.family<>b.family THEN 'phone' WHEN a.email=b.email AND a.family<>b.family THEN 'email'
 WHEN a.dob=b.dob AND a.family<>b.family AND a.first<>b.first THEN 'dob_only' WHEN a.family=b.family AND a.nzip=b.nzip AND a.first<>b.first THEN 'surname_zip' END"""
FEATURES = """coalesce(a.phone=b.phone,false) AS phone, coalesce(a.email=b.email,false) AS email, coalesce(a.ssn=b.ssn,false) AS ssn, a.dob=b.dob AS dob, (a.first=b.first AND a.family=b.family AND a.dob=b.dob) AS name_dob, a.family=b.family AS family, a.first=b.first AS given, a.street_zip=b.street_zip AS address"""


def with_people(body: str, dup: bool = False, more: str = "") -> str:
    """A query over ``k``, the keys of the population (with copies)."""
    return f"WITH {PERSONA_SQL}, {keys_sql('k', 'persona_dup' if dup else 'persona')}{more and ', ' + more} {body}"


def with_persona(body: str, more: str = "") -> str:
    return f"WITH {PERSONA_SQL}{more and ', ' + more} {body}"


def draw(n: int, *parts: str) -> str:
    """A whole number in 0..n-1 from the MD5 of parts; plain words are constants, parts that begin with @ are columns."""
    text = "||':'||".join(f"CAST({p[1:]} AS VARCHAR)" if p.startswith("@") else f"'{p}'" for p in parts)
    return f"(CAST(('0x'||substr(md5({text}),1,8)) AS BIGINT) % {n})"


def digest(*parts: str) -> str:
    text = "||':'||".join(f"CAST({p[1:]} AS VARCHAR)" if p.startswith("@") else f"'{p}'" for p in parts)
    return f"md5({text})"


def uniform(*parts: str) -> str:
    return f"(CAST(('0x'||substr({digest(*parts)},1,13)) AS BIGINT)/4503599627370496.0)"
