"""Edits of records as Column expressions. Every choice is drawn from the MD5 of seed, name of the draw and id, so that a variant is the
same in every run, order and engine. A variant equal to its record is a no-op."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftlink.functions import norm as N
from weftlink.functions.nicknames import SHORT_FORMS

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Accents put on letters, marks put into names.
ACCENTS = {"a": "á", "e": "é", "i": "í", "o": "ó", "u": "ú", "n": "ñ", "c": "ç"}
MARKS = ("-", "'", ".", "  ")
#: Dummy values by field.
DUMMIES = {
    "ssn": ("000-00-0000", "999-99-9999", "123-45-6789", "111-11-1111"),
    "phone": ("000-000-0000", "555-555-5555", "999-999-9999"),
    "given": ("UNKNOWN", "BABY BOY", "BABY GIRL"),
    "address": ("HOMELESS", "UNKNOWN"),
    "dob": ("1900-01-01", "1901-01-01"),
}
#: What a gender may drift to.
GENDER_DRIFT = {
    "male": ("female", "unknown"),
    "female": ("male", "unknown"),
    "unknown": ("male", "female"),
}


def pick(values: list, i: Column) -> Column:
    """The value of a literal list at a place from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


def _made(year: Column, month: Column, day: Column) -> Column:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat_ws("-", pad(year, 4), pad(month, 2), pad(day, 2))


def _real(text: Column) -> Column:
    """The text where it is a date of the calendar."""
    return F.when(text.try_cast("date").isNotNull(), text)


def dob_edit(dob: Column, kind: str, who: Column, seed: int = 0) -> Column:
    """A birth date (ISO text) with an error: ``day`` (1 to 3 days), ``month`` (1 or 2, round the year), ``year`` (1 or 2), ``swap`` of month
    and day, ``typo`` in one digit. A day that the new month lacks becomes 28; what can't be is left as it was."""
    y, m, d = (F.substring(dob, a, n).try_cast("int") for a, n in ((1, 4), (6, 2), (9, 2)))
    at = lambda n, name: N.draw(n, seed, f"dob_{name}", who)
    if kind == "day":
        out = F.date_format(F.date_add(dob.try_cast("date"), pick([-3, -2, -1, 1, 2, 3], at(6, kind))), "yyyy-MM-dd")
    elif kind == "month":
        month = F.pmod(m - 1 + pick([-2, -1, 1, 2], at(4, kind)), F.lit(12)) + 1
        out = F.coalesce(_real(_made(y, month, d)), _made(y, month, F.lit(28)))
    elif kind == "year":
        year = y + pick([-2, -1, 1, 2], at(4, kind))
        out = F.coalesce(_real(_made(year, m, d)), _made(year, m, F.lit(28)))
    elif kind == "swap":
        out = F.when((d <= 12) & (d != m), _made(y, d, m))
    elif kind == "typo":
        plain = F.replace(dob, F.lit("-"), F.lit(""))
        place = at(8, "typo_at").cast("int") + 1
        old = F.substr(plain, place, F.lit(1)).try_cast("int")
        new = F.pmod(old + 1 + at(9, "typo_to").cast("int"), F.lit(10)).cast("string")
        edited = F.overlay(plain, new, place, F.lit(1))
        out = _real(F.concat_ws("-", F.substring(edited, 1, 4), F.substring(edited, 5, 2), F.substring(edited, 7, 2)))
    else:
        raise ValueError(f"unknown date error: {kind}")
    return F.coalesce(out, dob)


def transpose(text: Column, who: Column, seed: int = 0, name: str = "transpose") -> Column:
    """One pair of neighbours exchanged; texts of one character stay."""
    i = (N.draw(F.greatest(F.length(text) - 1, F.lit(1)), seed, name, who) + 1).cast("int")
    return F.when(F.length(text) >= 2, F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, F.lit(1)), F.substr(text, i, F.lit(1)), F.substr(text, i + 2))).otherwise(text)


def drop_letters(text: Column, who: Column, seed: int = 0, share: float = 0.2) -> Column:
    """A fifth of the letters, at least one, left out: those with the smallest hashes. Texts under three characters stay."""
    n = F.greatest(F.lit(1), F.floor(F.length(text) * F.lit(share)).cast("int"))
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    ranked = F.array_sort(F.transform(places, lambda i: F.struct(N.digest(seed, "drop", who, i).alias("h"), i.alias("i"))))
    out = F.transform(F.slice(ranked, F.lit(1), n), lambda x: x["i"])
    kept = F.array_join(F.transform(F.filter(places, lambda i: ~F.array_contains(out, i)), lambda i: F.substr(text, i, F.lit(1))), "")
    return F.when(F.length(text) >= 3, kept).otherwise(text)


def typo(text: Column, who: Column, seed: int = 0, name: str = "typo") -> Column:
    """One letter put in, taken out or replaced; texts under three characters stay."""
    n = F.length(text)
    letter = pick(list(LETTERS), N.draw(26, seed, f"{name}_letter", who))
    op = N.draw(3, seed, f"{name}_op", who)
    at = (N.draw(F.greatest(n, F.lit(1)), seed, f"{name}_at", who) + 1).cast("int")
    gap = (N.draw(n + 1, seed, f"{name}_at", who) + 1).cast("int")
    put = F.concat(F.substr(text, F.lit(1), gap - 1), letter, F.substr(text, gap))
    out = F.concat(F.substr(text, F.lit(1), at - 1), F.substr(text, at + 1))
    other = F.concat(F.substr(text, F.lit(1), at - 1), letter, F.substr(text, at + 1))
    return F.when(n < 3, text).when(op == 0, put).when(op == 1, out).otherwise(other)


def abbreviate(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.substring(text, 1, 1), F.lit("."))).otherwise(text)


def nickname(text: Column, who: Column, seed: int = 0) -> Column:
    """A short form of a given name, if it has one."""
    table = F.create_map(*[x for k, v in SHORT_FORMS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in sorted(v.split())]))])
    forms = F.try_element_at(table, F.lower(text))
    return F.when(forms.isNotNull(), F.initcap(F.get(forms, N.draw(F.size(forms), seed, "nickname", who).cast("int")))).otherwise(text)


def diacritic(text: Column, who: Column, seed: int = 0) -> Column:
    """One letter that can bear an accent gets one."""
    letters = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.lower(F.substr(text, i, F.lit(1))).isin(*ACCENTS))
    i = F.get(letters, N.draw(F.greatest(F.size(letters), F.lit(1)), seed, "diacritic", who).cast("int"))
    accented = F.translate(F.lower(F.substr(text, i, F.lit(1))), "".join(ACCENTS), "".join(ACCENTS.values()))
    return F.when(F.size(letters) > 0, F.concat(F.substr(text, F.lit(1), i - 1), accented, F.substr(text, i + 1))).otherwise(text)


def punctuation(text: Column, who: Column, seed: int = 0) -> Column:
    """A mark inside a name."""
    at = (N.draw(F.greatest(F.length(text) - 1, F.lit(1)), seed, "mark_at", who) + 1).cast("int")
    return F.when(F.length(text) >= 2, F.concat(F.substr(text, F.lit(1), at), pick(list(MARKS), N.draw(4, seed, "mark", who)), F.substr(text, at + 1))).otherwise(text)


def dummy(field: str, who: Column, seed: int = 0) -> Column:
    values = DUMMIES[field]
    return pick(list(values), N.draw(len(values), seed, f"dummy_{field}", who))


#: Single edits of (given, family, dob): name -> function of the flat columns and the id that gives the edited columns.
def single_edits(seed: int = 0) -> dict[str, tuple[str, Column]]:
    """Edit name -> (column, edited value), over columns given, family, dob (ISO text) and pid."""
    g, f, d, who = F.col("given"), F.col("family"), F.col("dob"), F.col("pid")
    edits = {f"dob_{k}": ("dob", dob_edit(d, k, who, seed)) for k in ("day", "month", "year", "swap", "typo")}
    return edits | {
        "family_drop": ("family", drop_letters(f, who, seed)),
        "family_transpose": ("family", transpose(f, who, seed)),
        "family_typo": ("family", typo(f, who, seed)),
        "given_abbreviate": ("given", abbreviate(g)),
        "given_nickname": ("given", nickname(g, who, seed)),
    }


def fuzzy(df, seed: int = 0):
    """One effective single edit of each row: the first that changes something, in a hash order of the edits. Adds ``mutation``; rows that no
    edit changes keep a null there."""
    edits = single_edits(seed)
    options = F.array_compact(F.array(*[F.when(~v.eqNullSafe(F.col(c)), F.struct(N.digest(seed, "choice", n, F.col("pid")).alias("h"), F.lit(n).alias("n"), F.lit(c).alias("c"), v.alias("v"))) for n, (c, v) in edits.items()]))
    best = F.array_min(options)
    picked = df.withColumn("_b", best)
    out = {c: F.when(F.col("_b.c") == c, F.col("_b.v")).otherwise(F.col(c)) for c in ("given", "family", "dob")}
    return picked.withColumns(out | {"mutation": F.col("_b.n")}).drop("_b")


def compound(df, n: int = 2, seed: int = 0):
    """``n`` (2 or 3) of the fields given, family and dob edited at once, one effective edit each; adds ``mutations``."""
    if n not in (2, 3):
        raise ValueError("a compound variant has 2 or 3 edits")
    edits = single_edits(seed)
    picked = df
    for c in ("given", "family", "dob"):
        options = F.array_compact(F.array(*[F.when(~v.eqNullSafe(F.col(c)), F.struct(N.digest(seed, "choice", k, F.col("pid")).alias("h"), F.lit(k).alias("n"), v.alias("v"))) for k, (col, v) in edits.items() if col == c]))
        picked = picked.withColumn(f"_{c}", F.array_min(options))
    fields = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"_{c}").isNotNull(), F.struct(N.digest(seed, "field", c, F.col("pid")).alias("h"), F.lit(c).alias("c"))) for c in ("given", "family", "dob")])))
    chosen = F.transform(F.slice(fields, 1, n), lambda x: x["c"])
    picked = picked.withColumn("_chosen", chosen)
    out = {c: F.when(F.array_contains("_chosen", c), F.col(f"_{c}.v")).otherwise(F.col(c)) for c in ("given", "family", "dob")}
    names = F.array_compact(F.array(*[F.when(F.array_contains("_chosen", c), F.col(f"_{c}.n")) for c in ("given", "family", "dob")]))
    return picked.withColumns(out | {"mutations": F.array_join(names, "+")}).drop("_given", "_family", "_dob", "_chosen")


def changed_fields(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return sum(((~x.eqNullSafe(y)).cast("int") for x, y in zip(a, b)), F.lit(0))
