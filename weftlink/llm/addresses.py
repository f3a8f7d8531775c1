"""Postal addresses that denote the same location (problem 4).

An address is read into number or box, direction, street, type, unit and place. Equal readings are one representative. Several passes
sort the representatives by different orders of the components (``sorted_pairs``) and compare each with its neighbours: number, unit
and direction strictly, street and place by edit distance that counts an exchange of neighbouring letters as one slip. A street
name that is itself frequent is no slip of another frequent one.

A group of equal number and unit that is no larger than the window lies within the window of every order that begins with them, so
all its pairs are compared. Larger groups are compared in full as well: beside the windows their rows meet on grams of the
street name and the place that every two addresses of one location share (``place_keys``)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.names import NONE, long_grams, short_grams
from weftlink.llm.strings import apart, fold, within_one
from weftlink.operators.neighbours import sorted_pairs
from weftlink.session import cut, spread

#: Rows that each representative is compared with, in each pass.
WINDOW = 12

#: Street types and their written forms.
TYPES = {
    "avenue": "ave av aven avenu",
    "boulevard": "blvd boul boulv",
    "circle": "cir circ crcl",
    "court": "ct crt",
    "crossing": "xing crssng crossng",
    "drive": "dr drv driv",
    "highway": "hwy hiway hiwy highwy",
    "lane": "ln",
    "parkway": "pkwy pky parkwy pkway",
    "place": "pl plc",
    "road": "rd",
    "square": "sq sqr",
    "street": "st str strt",
    "terrace": "ter terr",
    "way": "wy",
    "trail": "trl",
}
#: Directions and their written forms.
DIRECTIONS = {"n": "north no n", "s": "south so s", "e": "east e", "w": "west w", "ne": "northeast ne", "nw": "northwest nw", "se": "southeast se", "sw": "southwest sw"}
#: States by postal code.
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut", "de": "delaware", "fl": "florida", "ga": "georgia",
    "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland",
    "ma": "massachusetts", "mi": "michigan", "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada", "nh": "new hampshire", "nj": "new jersey",
    "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota", "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina",
    "sd": "south dakota", "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington", "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming", "dc": "district of columbia",
}
#: Small ordinals in words.
ORDINALS = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
TENS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}
TENTHS = {"twentieth": 20, "thirtieth": 30, "fortieth": 40, "fiftieth": 50, "sixtieth": 60, "seventieth": 70, "eightieth": 80, "ninetieth": 90}
#: First parts of names and parts of city names that are shortened.
NAME_PARTS = {"st": "saint", "ft": "fort", "mt": "mount", "saint": "saint", "fort": "fort", "mount": "mount"}
CITY_PARTS = {"spgs": "springs", "spg": "springs", "spngs": "springs", "fls": "falls", "hts": "heights", "hgts": "heights", "n": "north", "s": "south", "e": "east", "w": "west", "ft": "fort", "mt": "mount", "st": "saint"}
#: Lines that denote no location.
STOCK = ("123 main st", "123 main street", "general delivery", "homeless", "unknown", "no fixed address", "none", "n/a", "na", "unk", "same", "no address", "address unknown", "transient")

_TYPE = {w: k for k, v in TYPES.items() for w in (k, *v.split())}
_DIRECTION = {w: k for k, v in DIRECTIONS.items() for w in v.split()}
_STATE_NAMES = sorted(((v, k) for k, v in STATES.items()), key=lambda x: -len(x[0]))
_NOTE = re.compile(r"^(c/o\b|care of\b|attn\b|attention\b|gate\b|\(|front desk|rear\b|\d+(st|nd|rd|th) (bell|door)|ring\b|call\b|leave\b|use\b)")
_UNIT = re.compile(r"(?:\b(?:apartment|apt|ap|unit|suite|ste|room|rm|no(?=\.? ?#?\d))\b\.?\s*#?\s*|#\s*)(\d+\s*-?\s*[a-z]?|[a-z]\s*-?\s*\d*)\b(?!\s*(?:st|nd|rd|th)\b)")
_BOX = re.compile(r"\b(?:p\.?\s*o\.?\s*b(?:ox)?\b|post office box\b|pob\b|box\b|bx\b)\.?\s*#?\s*(\d+)")
_RURAL = re.compile(r"\b(?:r\.?\s*r\.?|rural\s+(?:route|rte|rt)\.?)\s*#?\s*(\d+)\s*,?\s*(?:box|bx)\.?\s*#?\s*(\d+)")
_ROUTE = re.compile(r"^(?:(?P<us>u\.?\s*s\.?)(?:\s+(?:highway|hwy|hiway|route|rte|rt))?|(?P<state>state|st|s)\.?\s*(?:route|rte|rt|road|rd|highway|hwy)|(?P<sr>sr)|(?P<county>county|cnty|co)\.?\s*(?:road|rd|route|rte)|(?P<cr>cr))\.?\s*#?\s*(?P<n>\d+)\b")


def _ordinal(tokens: list[str]) -> str | None:
    """A number street such as 21st or Twenty First as its number."""
    text = " ".join(tokens).replace("-", " ").split()
    if len(text) == 1:
        if m := re.fullmatch(r"(\d+)(?:st|nd|rd|th)?", text[0]):
            return m[1]
        if text[0] in ORDINALS:
            return str(ORDINALS.index(text[0]))
        if text[0] in TENTHS:
            return str(TENTHS[text[0]])
    if len(text) == 2 and text[0] in TENS and text[1] in ORDINALS[1:10]:
        return str(TENS[text[0]] + ORDINALS.index(text[1]))
    return None


def _type(token: str) -> str | None:
    if token in _TYPE:
        return _TYPE[token]
    if len(token) >= 5:
        for name in TYPES:
            if len(name) >= 5 and within_one(token, name):
                return name
    return None


def state_of(text: str | None) -> str:
    plain = re.sub(r"[^a-z ]", "", fold(text or "")).strip()
    short = plain.replace(" ", "")
    return short if short in STATES else next((k for v, k in _STATE_NAMES if v == plain), plain)


def zip_of(text: str | None) -> str:
    digits = re.sub(r"\D", "", text or "")
    digits = digits[:5] if len(digits) in (5, 9) else digits.zfill(5) if len(digits) == 4 else digits.zfill(9)[:5] if len(digits) == 8 else digits
    return "" if set(digits) <= {"0"} else digits


def city_of(text: str | None) -> str:
    return "".join(CITY_PARTS.get(w, w) for w in re.findall(r"[^\W\d_]+", fold(text or "")))


def _place(text: str) -> tuple[str, str, str]:
    """(city, state, postal code) of the end of a line."""
    code = ""
    if m := re.search(r"(\d{5})(?:-?\d{4})?\s*$", text):
        code, text = m[1], text[: m.start()]
    text = text.strip(" ,.")
    for name, key in _STATE_NAMES:
        if text.endswith(name) and (len(text) == len(name) or text[-len(name) - 1] in " ,"):
            return city_of(text[: -len(name)]), key, code
    if m := re.search(r"(?:^|[ ,])([a-z])\.? ?([a-z])\.?$", text):
        if m[1] + m[2] in STATES:
            return city_of(text[: m.start()]), m[1] + m[2], code
    return city_of(text), "", code


def read_address(line: list[str] | None, city: str | None, state: str | None, code: str | None) -> dict[str, str] | None:
    """The components of an address, or None if it denotes no location."""
    segments = []
    for element in line if line is not None else []:
        for part in re.split(r",", fold(element or "")):
            part = re.sub(r"\s+", " ", part).strip(" .")
            part = re.sub(r"\(.*?\)", "", part).strip()
            if part and not _NOTE.match(part):
                segments.append(part)
    if not segments or ", ".join(segments) in STOCK:
        return None
    out = {"city": city_of(city), "state": state_of(state), "zip": zip_of(code)}
    text = ", ".join(segments)
    kind = number = ""
    if m := _RURAL.search(text):
        kind, number = "rr", f"{int(m[1])}/{int(m[2])}"
    elif (m := _BOX.search(text)) and not re.match(r"\d", text):
        kind, number = "po", str(int(m[1]))
    if kind:
        rest = text[m.end() :].strip(" ,.")
        if rest and not (out["city"] or out["zip"]) and not _UNIT.fullmatch(rest):
            out["city"], s, z = _place(rest)
            out["state"], out["zip"] = out["state"] or s, out["zip"] or z
        return out | {"kind": kind, "number": number, "unit": "", "dir": "", "name": "", "type": ""}
    units, streets, tail = [], [], []
    for part in segments:
        if u := _UNIT.fullmatch(part):
            units.append(u[1])
        elif not streets and re.match(r"\d+[a-z]?\b", part):
            streets.append(part)
        elif streets:
            tail.append(part)
    if not streets:
        return None
    street = streets[0]
    if tail and not (out["city"] or out["zip"]):
        out["city"], s, z = _place(" ".join(tail))
        out["state"], out["zip"] = out["state"] or s, out["zip"] or z
    m = re.match(r"(\d+)([a-z]?)\b\s*", street)
    number, rest = str(int(m[1])) + m[2], street[m.end() :]
    if u := list(_UNIT.finditer(rest)):
        if not rest[: u[-1].start()].strip() == "":
            units.append(u[-1][1])
            rest = rest[: u[-1].start()] + " " + rest[u[-1].end() :]
    unit = re.sub(r"[\s-]", "", units[0]) if units else ""
    tokens = re.findall(r"(?:[^\W_]|['-])+", re.sub(r"(?<=\b[a-z])\.\s?(?=[a-z]\b)", "", rest).replace("'", ""))
    direction = kind_ = ""
    plain = " ".join(tokens)
    if len(tokens) > 1 and tokens[0] in _DIRECTION and not (r := _ROUTE.match(plain)):
        direction, tokens = _DIRECTION[tokens[0]], tokens[1:]
        plain = " ".join(tokens)
    if r := _ROUTE.match(plain):
        base = "us" if r["us"] else "state" if r["state"] or r["sr"] else "county"
        left = plain[r.end() :].split()
        return out | {"kind": "h", "number": number, "unit": unit, "dir": direction or next((_DIRECTION[t] for t in left if t in _DIRECTION), ""), "name": f"{base}{r['n']}", "type": "route"}
    if len(tokens) > 1 and tokens[-1] in _DIRECTION:
        direction, tokens = direction or _DIRECTION[tokens[-1]], tokens[:-1]
    if len(tokens) > 1 and (t := _type(tokens[-1])):
        kind_, tokens = t, tokens[:-1]
    elif len(tokens) > 2 and (t := _type(tokens[-2])) and tokens[-1] in _DIRECTION:
        kind_, tokens = t, tokens[:-2]
    name = _ordinal(tokens)
    if name is None:
        if len(tokens) > 1 and tokens[0] in NAME_PARTS:
            tokens = [NAME_PARTS[tokens[0]], *tokens[1:]]
        name = "".join(tokens).replace("-", "")
    return out | {"kind": "h", "number": number, "unit": unit, "dir": direction, "name": name, "type": kind_}


def near(a: str, b: str) -> bool:
    """One slip apart at most, or two in long words."""
    if a == b:
        return True
    n = max(len(a), len(b))
    return n > 3 and apart(a, b, 1 if n < 9 else 2) is not None


def same_place(a: dict, b: dict) -> bool:
    """Postal code, city and state of two addresses agree as far as both give them, and at least one agrees; or one gives only a postal
    code, the other only a city, and the city is one of those known for the code (``cities``)."""
    if a["state"] and b["state"] and a["state"] != b["state"]:
        return False
    cities = near(a["city"], b["city"]) if a["city"] and b["city"] else None
    if a["zip"] and b["zip"]:
        if a["zip"] == b["zip"]:
            return cities is not False
        return within_one(a["zip"], b["zip"]) and cities is not False
    if cities is not None:
        return cities
    x, y = (a, b) if a["zip"] else (b, a)
    return bool(x["zip"] and y["city"] and not x["city"]) and any(near(c, y["city"]) for c in (x.get("cities") or "").split())


def same_location(a: dict, b: dict) -> float:
    """Confidence that two read addresses of equal kind, number and unit denote one location; 0 if they don't."""
    if a["dir"] and b["dir"] and a["dir"] != b["dir"] or a["type"] and b["type"] and a["type"] != b["type"]:
        return 0.0
    x, y = a["name"], b["name"]
    if x != y:
        if not near(x, y) or re.search(r"\d", x + y):
            return 0.0
        lo, hi = sorted((a["uses"], b["uses"]))
        if lo > 2 and lo * 20 > hi:  # both are names in their own right
            return 0.0
    if not same_place(a, b):
        return 0.0
    return 1.0 - 0.1 * (x != y) - 0.05 * (a["zip"] != b["zip"]) - 0.05 * (a["city"] != b["city"]) - 0.02 * (a["dir"] != b["dir"]) - 0.02 * (a["type"] != b["type"])


def place_keys(r: dict, grams) -> set[str]:
    """What two addresses of one place have in common at least: codes a slip apart share a code with one digit left out, cities that
    are near (or known for the other's code) share a gram."""
    out = {f"z{r['zip'][:i]}{r['zip'][i + 1 :]}" for i in range(len(r["zip"]))}
    for city in {r["city"], *(() if r["city"] else (r.get("cities") or "").split())} - {""}:
        out |= {f"c{g}" for g in grams(city)}
    return out


FIELDS = ("kind", "number", "unit", "dir", "name", "type", "city", "state", "zip")


def known_cities(rows: DataFrame) -> DataFrame:
    """(zip, cities): the cities that records with both parts give for a postal code; those given once (slips of a code or a
    city) count only where the code has no other."""
    given = rows.where("zip <> '' and city <> ''").groupBy("zip", "city").agg(F.count("*").alias("n"))
    most = given.groupBy("zip").agg(F.max("n").alias("most"))
    return given.join(most, "zip").where("n > 1 or most = 1").groupBy("zip").agg(F.concat_ws(" ", F.collect_list("city")).alias("cities"))


@dataclass
class Locations:
    """``members`` (address_id, rep) and ``pairs`` (rep_a, rep_b, score) of representatives that denote one location."""

    members: DataFrame
    pairs: DataFrame


def match_addresses(df: DataFrame, window: int = WINDOW) -> Locations:
    """Match rows (address_id, shard, line, city, state, postalCode) within a shard.

    Absent, unknown and stock addresses and null ids denote nothing; repeated rows of an id count once; a null shard is a shard of its
    own; an empty table gives empty results; other columns are not read. Whether two street names a slip apart are one street
    depends on how many addresses of the table bear each: a name that many bear is a street in its own right."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [read_address(l, c, s, z) for l, c, s, z in zip(pdf["line"], pdf["city"], pdf["state"], pdf["postalCode"])]
            keep = [i for i, r in enumerate(rows) if r]
            if keep:
                yield pd.DataFrame({"address_id": pdf["address_id"].iloc[keep].to_numpy(), "shard": pdf["shard"].iloc[keep].to_numpy()} | {f: [rows[i][f] for i in keep] for f in FIELDS})

    schema = "address_id long, shard int, " + ", ".join(f"`{f}` string" for f in FIELDS)
    rows = spread(df.where("address_id is not null and size(line) > 0").select("address_id", F.coalesce(F.col("shard").cast("int"), F.lit(NONE)).alias("shard"), "line", "city", "state", "postalCode")).mapInPandas(read, schema)
    rows = cut(rows.groupBy("address_id").agg(F.min(F.struct("shard", *FIELDS)).alias("r")).select("address_id", "r.*"))
    forms = rows.groupBy("shard", *FIELDS).agg(F.min("address_id").alias("rep"))
    members = rows.join(forms, ["shard", *FIELDS]).select("address_id", "rep")
    uses = forms.groupBy("name").agg(F.count("*").alias("uses"))
    told_by_code = forms.where("zip <> '' and city = ''").select("rep", "zip").join(known_cities(rows), "zip").select("rep", "cities")
    reps = cut(forms.join(uses, "name").join(told_by_code, "rep", "left").na.fill("", ["cities"]))
    col = lambda *names: [F.col(n) for n in names]
    orders = [
        col("shard", "number", "unit", "zip", "name", "rep"),
        col("shard", "number", "unit", "name", "city", "rep"),
        [*col("shard", "number", "unit", "city"), F.reverse("name"), F.col("rep")],
        col("shard", "name", "number", "unit", "zip", "rep"),
    ]
    strict = ["shard", "kind", "number", "unit"]
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in strict])
    slim = reps.select("rep", *strict, "name", "city", "zip")
    large = slim.groupBy("shard", "number", "unit").agg(F.count("*").alias("n")).where(F.col("n") > window).drop("n")
    hot = cut(reps.join(large, ["shard", "number", "unit"]).select("rep", *strict, "name", "city", "zip", "cities"))
    # in the first order a group that fits the window has met in full: the others see the groups that don't
    passes = [(slim, orders[0]), *((hot, order) for order in orders[1:])]
    met = reduce(DataFrame.unionByName, [sorted_pairs(rows_, order, window, same, ["rep", *strict]).select(F.col("a.rep").alias("x"), F.col("b.rep").alias("y")) for rows_, order in passes])

    def keys(grams):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = [(r["rep"], f"{r['shard']}|{r['kind']}|{r['number']}|{r['unit']}|{n}|{p}") for r in pdf.to_dict("records") for n in grams(r["name"]) for p in place_keys(r, grams)]
                if out:
                    yield pd.DataFrame(out, columns=["rep", "key"])

        return run

    emit = lambda grams, name: hot.mapInPandas(keys(grams), "rep long, key string").withColumnRenamed("rep", name)
    # of a pair the name and the place may be shorter on different sides: both sides bring both kinds of grams
    every = lambda w: short_grams(w) | long_grams(w)
    met = met.unionByName(emit(every, "x").join(emit(every, "y"), "key").where("x < y").select("x", "y"))
    met = met.select(F.least("x", "y").alias("rep_a"), F.greatest("x", "y").alias("rep_b")).distinct()
    told = ("uses", "cities", *FIELDS)
    side = lambda s: reps.select(F.col("rep").alias(f"_{s}"), *[F.col(c).alias(f"{s}_{c}") for c in told])
    flat = met.join(side("a"), F.col("rep_a") == F.col("_a")).join(side("b"), F.col("rep_b") == F.col("_b")).drop("_a", "_b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = ([dict(zip(told, r)) for r in zip(*(pdf[f"{s}_{c}"] for c in told))] for s in "ab")
            out = pdf[["rep_a", "rep_b"]].assign(score=[same_location(x, y) for x, y in zip(a, b)])
            yield out[out["score"] > 0]

    return Locations(members, flat.mapInPandas(verify, "rep_a long, rep_b long, score double"))


def expand(found: Locations) -> DataFrame:
    """All pairs (address_id_lo, address_id_hi): members of matched representatives and copies of one reading."""
    m = found.members
    a, b = m.select(F.col("address_id").alias("ia"), F.col("rep").alias("ra")), m.select(F.col("address_id").alias("ib"), F.col("rep").alias("rb"))
    across = found.pairs.join(a, F.col("rep_a") == F.col("ra")).join(b, F.col("rep_b") == F.col("rb")).select("ia", "ib")
    within = a.join(b, (F.col("ra") == F.col("rb")) & (F.col("ia") < F.col("ib"))).select("ia", "ib")
    return across.unionByName(within).select(F.least("ia", "ib").alias("address_id_lo"), F.greatest("ia", "ib").alias("address_id_hi")).distinct()
