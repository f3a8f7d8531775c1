"""Normalizers and string tests as Column expressions: they stay inside Catalyst, so nested fields are pruned and nothing runs in Python."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftlink.functions.nicknames import SHORT_FORMS

Text = Column | str


def _col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _folding() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters whose plain form is one sign of a-z or 0-9, those signs, and letters that unfold to several; by rule from Unicode."""
    one, plain, several = [], [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x20A0), *range(0xFB00, 0xFB07), *range(0xFF10, 0xFF5B), 0xAA, 0xB2, 0xB3, 0xB9, 0xBA]:
        c = chr(point)
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).casefold()
        base = "".join(x for x in base if x.isascii() and x.isalnum())
        if len(base) == 1:
            one.append(c)
            plain.append(base)
        elif len(base) > 1 and c.lower() == c:
            several.append((c, base))
    return "".join(one), "".join(plain), several


_ONE, _PLAIN, _SEVERAL = _folding()
#: Placeholder social security numbers.
PLACEHOLDER_SSNS = ("123456789", "987654321", "111223333", "999999999", "000000000")


def token(c: Text) -> Column:
    """Lower case, accents folded, only a-z and 0-9; the empty string for null."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    text = reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), _SEVERAL, F.lower(text))
    return F.regexp_replace(F.translate(text, _ONE, _PLAIN), "[^a-z0-9]", "")


def upper_token(c: Text) -> Column:
    """As ``token``, in capitals, with letters written out that have no decomposition (o with stroke, ae, thorn and the like)."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    for a, b in (("æ", "ae"), ("œ", "oe"), ("þ", "th")):
        text = F.replace(F.replace(text, F.lit(a), F.lit(b)), F.lit(a.upper()), F.lit(b.upper()))
    return F.upper(token(F.translate(text, "øØłŁđĐðÐ", "oOlLdDdD")))


def digits(c: Text) -> Column:
    return F.regexp_replace(F.coalesce(_col(c).cast("string"), F.lit("")), r"\D", "")


def phone(c: Text) -> Column:
    """Digits without a leading 1 of eleven."""
    d = digits(c)
    return F.when((F.length(d) == 11) & d.startswith("1"), F.substr(d, F.lit(2))).otherwise(d)


def ssn_placeholder(d: Column) -> Column:
    """Digits that are no usable number: stock values, wrong length, one digit repeated, area 000, 666 or 9xx, group 00, serial 0000."""
    return d.isin(*PLACEHOLDER_SSNS) | (F.length(d) != 9) | d.rlike(r"^(\d)\1*$") | d.rlike("^(000|666|9)") | (F.substring(d, 4, 2) == "00") | (F.substring(d, 6, 4) == "0000")


def usable_ssn(c: Text) -> Column:
    d = digits(c)
    return F.when(~ssn_placeholder(d), d)


def within(a: Column, b: Column, k: int) -> Column:
    """Edit distance of at most k; false where a side is null."""
    return F.coalesce(F.levenshtein(a, b, k) >= 0, F.lit(False))


def swapped_month_day(a: Column, b: Column) -> Column:
    iso = r"^.{4}-.{2}-.{2}$"
    return F.coalesce((F.substring(a, 1, 4) == F.substring(b, 1, 4)) & (F.substring(a, 6, 2) == F.substring(b, 9, 2)) & (F.substring(a, 9, 2) == F.substring(b, 6, 2)) & a.rlike(iso) & b.rlike(iso), F.lit(False))


def dates_close(a: Column, b: Column) -> Column:
    """ISO texts within one edit, or month and day exchanged; an absent date is close to none."""
    return F.coalesce((a != "") & (b != "") & (within(a, b, 1) | swapped_month_day(a, b)), F.lit(False))


def deletions(c: Column) -> Column:
    """All texts with one character taken out."""
    return F.when(F.length(c) > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1))))).otherwise(F.array().cast("array<string>"))


def near_keys(c: Column) -> Column:
    """A text and its deletions: two texts within one edit share at least one."""
    return F.array_union(F.array(c), deletions(c))


def date_keys(c: Column) -> Column:
    """Near keys of an ISO date and the date with month and day exchanged."""
    swap = F.concat(F.substring(c, 1, 5), F.substring(c, 9, 2), F.lit("-"), F.substring(c, 6, 2))
    return F.when(c.rlike(r"^.{4}-.{2}-.{2}$"), F.array_union(near_keys(c), F.array(swap))).otherwise(near_keys(c))


def osa_within_one(a: Column, b: Column) -> Column:
    """Equal, one edit, or one exchange of neighbours."""
    exchanged = F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: F.concat(F.substr(a, F.lit(1), i - 1), F.substr(a, i + 1, F.lit(1)), F.substr(a, i, F.lit(1)), F.substr(a, i + 2)) == b)
    return within(a, b, 1) | F.coalesce((F.length(a) == F.length(b)) & (F.length(a) > 1) & exchanged, F.lit(False))


def nickname_pairs() -> list[str]:
    """``formal|short`` in both orders."""
    return sorted({x for name, short in SHORT_FORMS.items() for s in short.split() for x in (f"{name}|{s}", f"{s}|{name}")})


def given_variant(a: Column, b: Column) -> Column:
    """Equal, an initial or cut form of the other, or a formal name and its short form."""
    related = F.concat(a, F.lit("|"), b).isin(*nickname_pairs())
    return F.coalesce((a != "") & (b != "") & (a.startswith(b) | b.startswith(a) | related), F.lit(False))


def birth_year(c: Column) -> Column:
    return F.expr("cast(null as int)") if c is None else F.substring(c, 1, 4).try_cast("int")


def shift_years(c: Column, years: int) -> Column:
    """An ISO date moved by whole years, the day cut to the month's end; anything else as it is."""
    return F.coalesce(F.date_format(F.add_months(F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c).try_cast("date"), 12 * years), "yyyy-MM-dd"), c)


def from_day_offset(c: Column) -> Column:
    """A whole number of days since 1899-12-30 as an ISO date; null for anything else."""
    return F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.trim(c).try_cast("int") - 2), "yyyy-MM-dd")


def digest(*parts: Column | str | int) -> Column:
    """The MD5 of parts joined by colons: the source of every random draw, equal in every engine."""
    return F.md5(F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def draw(n: int | Column, *parts: Column | str | int) -> Column:
    """A whole number in 0..n-1."""
    return F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("bigint") % n


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) of 52 bits."""
    return F.conv(F.substring(digest(*parts), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(2**52))


def opaque_id(raw: Column, namespace: str = "") -> Column:
    """The first sixteen hex digits of a SHA-256."""
    return F.substring(F.sha2(F.concat(F.lit(namespace + ":"), raw) if namespace else raw, 256), 1, 16)


def order_key(*parts: Column | str | int) -> Column:
    """A 63-bit place in the hash order, the same as the order of the first fifteen hex digits."""
    return F.conv(F.substring(digest(*parts), 1, 15), 16, 10).cast("bigint") * F.lit(8).cast("bigint")
