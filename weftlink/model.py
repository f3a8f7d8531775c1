"""The nested person record, and its flat keys that predicates and joins work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.functions import norm as N

def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _A = T.StringType(), T.ArrayType
PERSON = _struct(
    id=_S,
    gender=_S,
    birthDate=_S,
    name=_A(_struct(use=_S, family=_S, given=_A(_S), suffix=_A(_S), text=_S)),
    telecom=_A(_struct(system=_S, value=_S, rank=T.IntegerType())),
    address=_A(_struct(use=_S, line=_A(_S), city=_S, state=_S, postalCode=_S)),
    identifier=_A(_struct(system=_S, type=_struct(coding=_A(_struct(system=_S, code=_S))), value=_S, assigner=_struct(display=_S))),
    extension=_A(_struct(url=_S, valueString=_S)),
)
#: The systems of an SSN and of a mother's maiden name.
SSN_SYSTEM, SSN_CODING, MAIDEN_URL = "http://hl7.org/fhir/sid/us-ssn", "http://terminology.hl7.org/CodeSystem/v2-0203", "http://hl7.org/fhir/StructureDefinition/patient-mothersMaidenName"


def _typed(c: Column, field: str) -> Column:
    return c.cast(PERSON[field].dataType)


def ssn_identifier(value: Column) -> Column:
    return F.struct(F.lit(SSN_SYSTEM).alias("system"), F.struct(F.array(F.struct(F.lit(SSN_CODING).alias("system"), F.lit("SS").alias("code"))).alias("coding")).alias("type"), value.alias("value"), F.lit(None).cast("struct<display:string>").alias("assigner"))


def person_struct(**fields: Column) -> Column:
    """A person from columns by field name; missing fields are null."""
    return F.struct(*[(_typed(fields[f.name], f.name) if f.name in fields else F.lit(None).cast(f.dataType)).alias(f.name) for f in PERSON])


def first_name(p: Column) -> Column:
    return N.token(F.get(F.get(p["name"], F.lit(0))["given"], F.lit(0)))


def values_of(p: Column, system: str, clean) -> Column:
    """Distinct non-empty cleaned contact values of a system."""
    own = F.filter(F.coalesce(p["telecom"], F.array().cast(PERSON["telecom"].dataType)), lambda t: t["system"] == system)
    return F.array_sort(F.array_distinct(F.filter(F.transform(own, lambda t: clean(t["value"])), lambda v: v.isNotNull() & (v != ""))))


def ssn_of(p: Column) -> Column:
    own = F.filter(F.coalesce(p["identifier"], F.array().cast(PERSON["identifier"].dataType)), lambda i: i["system"] == SSN_SYSTEM)
    return F.get(F.filter(F.transform(own, lambda i: N.usable_ssn(i["value"])), lambda v: v.isNotNull()), F.lit(0))


def key_columns(p: Column) -> list[Column]:
    """The flat keys of a person: what guards, miners and audits compare."""
    name, address = F.get(p["name"], F.lit(0)), F.get(p["address"], F.lit(0))
    given = F.get(name["given"], F.lit(0))
    family, first = N.token(name["family"]), N.token(given)
    street, nzip = N.token(F.get(address["line"], F.lit(0))), N.token(address["postalCode"])
    entries = F.filter(F.coalesce(p["name"], F.array().cast(PERSON["name"].dataType)), lambda n, i: (i == 0) | (n["use"] == "nickname"))
    words = F.flatten(F.transform(entries, lambda n: F.concat(F.coalesce(n["given"], F.array().cast("array<string>")), F.when(n["use"] == "nickname", F.array(n["text"])).otherwise(F.array().cast("array<string>")))))
    return [
        p["id"].alias("id"),
        first.alias("first"),
        family.alias("family"),
        F.coalesce(name["family"], F.lit("")).alias("raw_family"),
        F.upper(F.coalesce(name["family"], F.lit(""))).alias("upper_family"),
        F.upper(F.trim(F.concat_ws(" ", given, name["family"]))).alias("upper_name"),
        F.coalesce(p["birthDate"], F.lit("")).alias("dob"),
        ssn_of(p).alias("ssn"),
        F.filter(values_of(p, "phone", N.phone), lambda v: F.length(v) == 10).alias("phones"),
        values_of(p, "phone", N.phone).alias("all_phones"),
        values_of(p, "email", lambda v: F.lower(F.trim(v))).alias("emails"),
        F.coalesce(address["postalCode"], F.lit("")).alias("zip"),
        nzip.alias("nzip"),
        street.alias("street"),
        F.when((street != "") & (nzip != ""), F.concat(street, F.lit("|"), nzip)).otherwise(F.lit("")).alias("street_zip"),
        F.array_distinct(F.filter(F.transform(words, N.token), lambda w: F.length(w) > 1)).alias("tokens"),
        p["gender"].alias("gender"),
        F.array_join(F.transform(F.filter(F.flatten(F.array(F.coalesce(address["line"], F.array().cast("array<string>")), F.array(F.coalesce(address["city"], F.lit("")), F.coalesce(address["state"], F.lit("")), F.coalesce(address["postalCode"], F.lit(""))))), lambda x: x.isNotNull()), N.token), "|").alias("address"),
    ]


def keyed(df: DataFrame, person: str = "person", *keep: str) -> DataFrame:
    """The flat keys of each row's person, with the columns to keep."""
    return df.select(*keep, *key_columns(F.col(person)))


def _whole(c: Column, keep) -> Column:
    """A value where a test of it holds, else null; the value is written once in the plan, however often the test reads it."""
    return F.get(F.filter(F.array(c), keep), F.lit(0))


def prune(c: Column, kind: T.DataType) -> Column:
    """Empty strings, arrays and structs as null, at every depth; expressions made from the type."""
    if isinstance(kind, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(kind, T.ArrayType):
        kept = F.filter(F.transform(c, lambda x: prune(x, kind.elementType)), lambda x: x.isNotNull())
        return _whole(kept, lambda x: F.size(x) > 0)
    if isinstance(kind, T.StructType):
        made = F.struct(*[prune(c[f.name], f.dataType).alias(f.name) for f in kind])
        return _whole(made, lambda x: reduce_or([x[f.name].isNotNull() for f in kind]))
    return c


def reduce_or(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def renumber(telecom: Column) -> Column:
    """Ranks 1..n per system in list order; entries without a rank stay without."""

    def one(t: Column, i: Column) -> Column:
        before = F.filter(F.slice(telecom, F.lit(1), i + 1), lambda y: (y["system"] == t["system"]) & y["rank"].isNotNull())
        return t.withField("rank", F.when(t["rank"].isNotNull(), F.size(before)))

    return F.transform(telecom, one)


def export_ready(p: Column) -> Column:
    """Ranks renumbered and empty values dropped; a record of nothing but empty values stays a record."""
    return F.coalesce(prune(p.withField("telecom", renumber(p["telecom"])), PERSON), p)


def violations(p: Column) -> Column:
    """Structural problems of a record as texts; empty for a sound one."""
    names, telecom, ids = F.coalesce(p["name"], F.array().cast(PERSON["name"].dataType)), F.coalesce(p["telecom"], F.array().cast(PERSON["telecom"].dataType)), F.coalesce(p["identifier"], F.array().cast(PERSON["identifier"].dataType))
    ranked = F.transform(F.filter(telecom, lambda t: t["rank"].isNotNull()), lambda t: F.concat_ws("#", t["system"], t["rank"].cast("string")))
    uses, systems = ("usual", "official", "temp", "nickname", "anonymous", "old", "maiden"), ("phone", "fax", "email", "pager", "url", "sms", "other")
    checks = [
        (~p.eqNullSafe(F.coalesce(prune(p, PERSON), p)), "empty value"),
        (F.exists(names, lambda n: n["use"].isNotNull() & ~n["use"].isin(*uses)), "name use"),
        (F.exists(telecom, lambda t: t["system"].isNull() | ~t["system"].isin(*systems)), "telecom system"),
        (F.exists(telecom, lambda t: F.coalesce(t["value"], F.lit("")).contains("^")), "caret in telecom"),
        (F.size(ranked) != F.size(F.array_distinct(ranked)), "duplicate rank"),
        (F.exists(ids, lambda i: (i["system"] == SSN_SYSTEM) & ~F.coalesce(F.exists(i["type"]["coding"], lambda c: c["code"] == "SS"), F.lit(False))), "untyped ssn"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in checks]))
