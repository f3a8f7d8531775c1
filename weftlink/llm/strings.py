"""Folding and comparing of short strings in Python workers; results are kept per worker because the same words come again."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from weftlink.functions.nicknames import NO_NAME, PARTICLES, SUFFIXES, TITLES, formal_forms

FORMAL = formal_forms()
_LETTERS = str.maketrans({"ß": "ss", "ø": "o", "ł": "l", "đ": "d", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ı": "i", "’": "'", "‘": "'", "`": "'", "´": "'"})


@lru_cache(1 << 17)
def fold(text: str) -> str:
    """Lower case without accents; other letters as in plain writing."""
    plain = unicodedata.normalize("NFKD", text.lower().translate(_LETTERS))
    return "".join(c for c in plain if not unicodedata.combining(c))


@lru_cache(1 << 18)
def osa(a: str, b: str) -> int:
    """Edit distance where an exchange of neighbours is one edit."""
    if a == b:
        return 0
    before, now = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, now, row = before, [i], now
        for j, y in enumerate(b, 1):
            best = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, last[j - 2] + 1)
            now.append(best)
        before = row
    return now[-1]


def within_one(a: str, b: str) -> bool:
    """``osa`` of at most 1, without the table: past the first difference the rests are equal after one edit."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def apart(a: str, b: str, most: int) -> int | None:
    """``osa`` if it is at most ``most``, else None. An edit takes one letter away at most, so words with more letters of their own are
    told apart without the table."""
    if abs(len(a) - len(b)) > most:
        return None
    x, y = set(a), set(b)
    if len(x - y) > most or len(y - x) > most:
        return None
    d = osa(a, b)
    return d if d <= most else None


def slips(n: int) -> int:
    """How many edits two words may lie apart of which the longer has n letters."""
    return 0 if n < 3 else 1 if n < 6 else 2 if n < 10 else 3


@lru_cache(1 << 18)
def alike(a: str, b: str) -> float:
    """1 for equal words, falling with the share of edits; 0 where they are too many for a slip."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    d = apart(a, b, slips(n)) if n > 2 else None
    return 1.0 - d / n if d is not None else 0.0


@lru_cache(1 << 18)
def given_alike(a: str, b: str) -> float:
    """Similarity of two given names: 1 equal or short forms of one name, less for slips, cut ends and initials, 0 otherwise."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    fa, fb = FORMAL.get(a, frozenset()), FORMAL.get(b, frozenset())
    if fa & fb:
        return 1.0
    if len(a) == 1:
        return 0.6 if b[0] == a or any(f[0] == a for f in fb) else 0.0
    if len(a) >= 3 and b.startswith(a):
        return 0.85
    if len(a) >= 4 and alike(a, b):
        d = osa(a, b)
        if d == 1 or d == 2 and len(b) >= 6:
            return 0.9 if d == 1 else 0.8
    for short, forms in ((a, fb), (b, fa)):
        for f in forms:
            if len(short) >= 4 and within_one(short, f):
                return 0.8
    return 0.0


def words(text: str | None, family: bool) -> list[str]:
    """The name words of a field: folded, without titles, suffixes, particles and stray marks. Letters before an apostrophe and, in a
    family name, single letters are particles, too."""
    if not text:
        return []
    plain = re.sub(r"\b[a-z]'(?=\w)", "", fold(text))
    found = re.findall(r"[^\W_]+", plain.replace("'", ""))
    return [w for w in found if w not in TITLES and w not in SUFFIXES and (w not in PARTICLES or len(w) == 1) and not (family and len(w) == 1)]


def suffix_of(*texts: str | None) -> str:
    """The generational suffix said in any of the texts, or the empty string."""
    for text in texts:
        for w in re.findall(r"[^\W\d_]+", fold(text or "")):
            if w in SUFFIXES:
                return w
    return ""


def name_parts(family: str | None, given: list[str] | None, text: str | None) -> tuple[list[str], list[str]]:
    """(family words, given words) of a typed name; both empty where it names nobody."""
    given = [g for g in (given if given is not None else []) if g]
    if not family and not given and text:
        if "," in text:
            family, _, rest = text.partition(",")
            given = [rest]
        else:
            found = words(text, False)
            raw = re.split(r"\s+", text.strip())
            family, given = (raw[-1], [" ".join(raw[:-1])]) if len(found) > 1 else (text, [])
            if words(family, True) == [] and len(found) > 1:  # a suffix stands last
                family, given = found[-1], [" ".join(found[:-1])]
    f, g = words(family, True), words(" ".join(given), False)
    initials = [] if f else words(family, False)
    if initials and (named := words(given[0] if given else None, True)):  # the initial stands in the family's field, the family in the given one's
        f, g = named, initials + words(" ".join(given[1:]), False)
    if all(w in NO_NAME for w in f + g) or any(w in ("unknown", "unk", "test", "doe", "baby") for w in f):
        return [], []
    return f, [w for w in g if w not in NO_NAME]
