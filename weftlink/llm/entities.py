"""Matching records of two sources that share no key (problem 2).

Attributes are encoded as 64-bit vectors, one bit for each hashed q-gram. Close vectors are found exactly by multi-index hashing: a
vector is cut into ``CHUNKS`` chunks; two vectors that differ in at most ``RADIUS`` bits agree in at least CHUNKS - RADIUS of them, so each
is filed under every combination of that many chunks. Searched are vectors of a birth date with a name word and of a full name with a
postal code, and, at radius 0, telephone numbers, e-mails, street addresses, social security numbers and birth dates with an initial. Candidates get a Dice score
per field; a logistic model turns the field scores into a confidence. It is calibrated on candidates whose social security
numbers say whether they are one person (a number is never a feature of the model itself). What numbers say in addition is then
estimated from all candidates: how much more often equal, partly equal, missing or different numbers come with the pairs that the
model believes in than with the others. How far confidences can be relied on is measured on candidates left out of the fit.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.addresses import read_address
from weftlink.llm.strings import FORMAL, alike, apart, fold, given_alike, suffix_of, within_one, words
from weftlink.session import cut, spread

CHUNKS, RADIUS = 6, 4
#: Labelled candidates that the calibration uses at most, taken by hash order.
CALIBRATION_ROWS = 40_000
#: Confidence from which two records are one person.
SAME = 0.5
#: Birth dates so many days apart can be one date read wrongly.
CLOSE_DAYS = 11
#: Stock birth dates.
STOCK_DATES = ("1900-01-01", "1901-01-01", "1970-01-01", "9999-12-31")


@lru_cache(1 << 16)
def _bit(gram: str) -> int:
    return 1 << (xxhash.xxh32_intdigest(gram) % 64)


@lru_cache(1 << 16)
def word_vector(word: str) -> int:
    """Letter pairs of a word with its ends marked."""
    marked, v = f"^{word}$", 0
    for i in range(len(marked) - 1):
        v |= _bit(marked[i : i + 2])
    return v


def digit_vector(tag: str, digits: str) -> int:
    """Digits with their places."""
    v = 0
    for i, d in enumerate(digits):
        v |= _bit(f"{tag}{i}{d}")
    return v


def dice(a: int, b: int) -> float:
    """Share of common bits."""
    n = a.bit_count() + b.bit_count()
    return 2 * (a & b).bit_count() / n if n else 0.0


#: (shift, mask) of each chunk, and the combinations of chunks that are filed.
_PARTS = [(64 * i // CHUNKS, (1 << (64 * (i + 1) // CHUNKS - 64 * i // CHUNKS)) - 1) for i in range(CHUNKS)]
_FILED = list(combinations(range(CHUNKS), CHUNKS - RADIUS))


def filed(vector: int) -> Iterator[str]:
    """The places where a vector is filed."""
    chunks = [f"{vector >> shift & mask:x}" for shift, mask in _PARTS]
    for own in _FILED:
        yield f"{own}" + "/".join(chunks[i] for i in own)


def read_date(text: str | None) -> str:
    """A birth date as YYYY-MM-DD; the empty string where it is absent, a stock date or no date."""
    t = (text or "").strip()
    if m := re.match(r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:$|T)", t) or re.match(r"^(\d{4})(\d\d)(\d\d)$", t):
        y, mo, d = m.groups()
    elif m := re.match(r"^(\d{1,2})/(\d{1,2})/(\d{4})$", t):
        mo, d, y = m.groups()
    else:
        return ""
    out = f"{y}-{int(mo):02d}-{int(d):02d}"
    return "" if out in STOCK_DATES else out


@lru_cache(1 << 16)
def _day(text: str) -> int | None:
    try:
        return date.fromisoformat(text).toordinal()
    except ValueError:
        return None


def days_apart(a: str, b: str) -> float:
    """Days between two dates; infinite where one isn't in the calendar."""
    x, y = _day(a), _day(b)
    return abs(x - y) if x is not None and y is not None else float("inf")


def read_number(value: str | None) -> str:
    """A social security number's nine digits, or X and the last four of a masked one; the empty string for dummies."""
    v = (value or "").strip().upper()
    digits = re.sub(r"\D", "", v)
    if re.match(r"^[X*]", v):
        return "X" + digits[-4:] if len(digits) >= 4 else ""
    if len(digits) != 9 or len(set(digits)) == 1 or digits in ("123456789", "987654321") or digits[:3] == "000" or digits[3:5] == "00" or digits[5:] == "0000":
        return ""
    return digits


def read_phone(value: str | None) -> str:
    """Ten digits without country code and extension."""
    plain = re.sub(r"\D", "", re.split(r"x|ext", (value or "").lower())[0])
    plain = plain[1:] if len(plain) == 11 and plain[0] == "1" else plain
    return plain if len(plain) == 10 and len(set(plain)) > 1 else ""


def read_person(p) -> dict[str, str]:
    """The comparable attributes of a person record, as short texts; several values are parted by blanks."""
    out = dict.fromkeys(("fam", "giv", "nick", "suffix", "dob", "phones", "emails", "ssn", "street", "place", "maiden"), "")
    if p is None:
        return out
    names = [n for n in (p["name"] if p["name"] is not None else []) if n is not None]
    main = next((n for n in names if n["family"]), names[0] if names else None)
    if main is not None:
        given = [g for g in (main["given"] if main["given"] is not None else []) if g]
        fam, giv = words(main["family"], True), words(" ".join(given), False)
        if not fam and not giv and main["text"]:
            found = words(main["text"], False)
            fam, giv = (found[:1], found[1:]) if "," in main["text"] else (found[-1:], found[:-1])
        out["fam"], out["giv"] = " ".join(fam), " ".join(giv)
        out["suffix"] = suffix_of(main["family"], *given, *(main["suffix"] if main["suffix"] is not None else []))
        out["nick"] = " ".join(w for n in names if n is not main for w in (words(n["text"], False) + words(" ".join(g for g in (n["given"] if n["given"] is not None else []) if g), False)))
    out["dob"] = read_date(p["birthDate"])
    telecom = [t for t in (p["telecom"] if p["telecom"] is not None else []) if t is not None]
    out["phones"] = " ".join(sorted({x for t in telecom if t["system"] == "phone" and (x := read_phone(t["value"]))}))
    out["emails"] = " ".join(sorted({fold(t["value"]).strip().replace(" ", "") for t in telecom if t["system"] == "email" and t["value"]}))
    for a in p["address"] if p["address"] is not None else []:
        if a is not None and (r := read_address(a["line"], a["city"], a["state"], a["postalCode"])):
            out["street"] = f"{r['kind']}|{r['number']}|{r['name']}|{r['unit']}"
            out["place"] = r["zip"] or r["city"]
            break
        if a is not None and not out["place"]:
            out["place"] = re.sub(r"\D", "", a["postalCode"] or "")[:5]
    for i in p["identifier"] if p["identifier"] is not None else []:
        if i is None:
            continue
        codes = [c["code"] for c in (i["type"]["coding"] if i["type"] is not None and i["type"]["coding"] is not None else []) if c is not None]
        if "SS" in codes or "ssn" in (i["system"] or ""):
            out["ssn"] = out["ssn"] or read_number(i["value"])
    for e in p["extension"] if p["extension"] is not None else []:
        if e is not None and "maiden" in (e["url"] or ""):
            out["maiden"] = " ".join(words(e["valueString"], True))
    return out


ATTRIBUTES = ("fam", "giv", "nick", "suffix", "dob", "phones", "emails", "ssn", "street", "place", "maiden")


def search_keys(shard: int, r: dict[str, str]) -> Iterator[tuple[str, int]]:
    """(key, vector) under which a record is filed; vector 0 means that equality of the key is all."""
    fam, giv = r["fam"].split(), r["giv"].split()
    if r["dob"]:
        born = digit_vector("d", r["dob"].replace("-", ""))
        for w in {*fam, *giv[:1], *r["nick"].split()[:1], *r["maiden"].split()[:1]}:
            v = born | word_vector(w)
            for k in filed(v):
                yield f"{shard}d{k}", v
        for x in {w[0] for w in (*fam, *giv)}:  # several slips at once, where the date and an initial are right
            yield f"{shard}b{r['dob']}{x}", 0
    if fam and giv and r["place"]:
        v = digit_vector("z", r["place"]) if r["place"].isdigit() else word_vector(r["place"])
        for w in (*fam, giv[0]):
            v |= word_vector(w)
        for k in filed(v):
            yield f"{shard}n{k}", v
    # a number is enough; a contact or a home may be a third of all people's and needs a part of a name or the date beside it
    if r["ssn"] and r["ssn"][0] != "X":
        yield f"{shard}s{r['ssn']}", 0
    named = {*fam, *giv, *r["nick"].split(), *r["maiden"].split()}
    beside = {p for w in named for f in (w, *FORMAL.get(w, ())) for p in (f"<{f[:3]}", f">{f[-3:]}")} | {f"'{w[0]}" for w in giv[:1]} | ({r["dob"]} if r["dob"] else set()) | ({"-"} if not named else set())
    for tag, field in (("p", "phones"), ("e", "emails"), ("a", "street")):
        for x in r[field].split():
            for y in beside:
                yield f"{shard}{tag}{x}|{y}", 0


#: The scored fields.
FIELDS = ("family", "given", "middle", "birth", "phone", "email", "street", "place", "maiden", "suffix")
FEATURES = [f"{f}_{x}" for f in FIELDS for x in ("score", "absent", "clash")] + ["given_initial", "given_birth", "family_birth", "all_three", "contact", "given_contact"]


def field_scores(a: dict, b: dict) -> list[float]:
    """Dice score, absence and contradiction of each field, then what holds for fields together."""
    out = []

    def put(score: float | None, clash: float = 0.3) -> float:
        out.extend((score or 0.0, float(score is None), float(score is not None and score < clash)))
        return score or 0.0

    fa, fb = a["fam"].split(), b["fam"].split()
    family = None
    if fa and fb:
        family = max([dice(word_vector(x), word_vector(y)) if not alike(x, y) else max(0.8, dice(word_vector(x), word_vector(y))) for x in fa for y in fb] + [dice(word_vector("".join(fa)), word_vector("".join(fb)))])
    ga, gb = a["giv"].split(), b["giv"].split()
    na, nb = ga[:1] + a["nick"].split(), gb[:1] + b["nick"].split()
    given = max((given_alike(x, y) for x in na for y in nb), default=None)
    initial = float(bool(ga and gb) and min(len(ga[0]), len(gb[0])) == 1)
    if fa and fb and ga and gb and (family or 0) < 0.6 and not given:  # typed into each other's field
        crossed = min(max(max(alike(x, y), given_alike(x, y)) for x in fa for y in gb), max(max(alike(x, y), given_alike(x, y)) for x in ga for y in fb))
        if crossed:
            family, given, initial = max(family or 0.0, crossed), crossed, 0.0
    if given == 0.0 and len(ga) > 1 and len(gb) > 1:  # first and middle name exchanged
        given = min(given_alike(ga[0], gb[1]), given_alike(ga[1], gb[0]))
    f, g = put(family, 0.5), put(given)
    put(max(given_alike(x, y) for x in ga[1:] for y in gb[1:]) if ga[1:] and gb[1:] else None)
    birth = None
    if a["dob"] and b["dob"]:
        x, y = a["dob"], b["dob"]
        d = apart(x.replace("-", ""), y.replace("-", ""), 2)
        swap = x[:4] == y[:4] and x[5:7] == y[8:] and x[8:] == y[5:7]
        birth = 1.0 if d == 0 else 0.8 if swap or d == 1 or days_apart(x, y) <= CLOSE_DAYS else 0.35 if d == 2 else 0.0
    t = put(birth)
    pa, pb = a["phones"].split(), b["phones"].split()
    phone = put(max(1.0 if x == y else 0.5 * within_one(x, y) for x in pa for y in pb) if pa and pb else None)
    ea, eb = a["emails"].split(), b["emails"].split()
    email = put(max(1.0 if x == y else max(0.0, dice(word_vector(x.split("@")[0]), word_vector(y.split("@")[0])) - 0.4) for x in ea for y in eb) if ea and eb else None)
    street = None
    if a["street"] and b["street"]:
        (ka, ha, sa, ua), (kb, hb, sb, ub) = a["street"].split("|"), b["street"].split("|")
        street = (1.0 if ua == ub else 0.7) if ka == kb and ha == hb and (sa == sb or alike(sa, sb)) else 0.2 if sa and sa == sb else 0.0
    s = put(street)
    put((1.0 if a["place"] == b["place"] else 0.6 * within_one(a["place"], b["place"])) if a["place"] and b["place"] else None)
    put(dice(word_vector(a["maiden"]), word_vector(b["maiden"])) if a["maiden"] and b["maiden"] else None, 0.5)
    put(float(a["suffix"] == b["suffix"]) if a["suffix"] and b["suffix"] else None)
    contact = max(phone, email, s)
    return [*out, initial, g * t, f * t, f * g * t, contact, g * contact]


def number_evidence(a: str, b: str) -> int:
    """2 equal numbers, 1 equal last four of a masked one, -1 different numbers, 0 nothing to compare."""
    if not a or not b:
        return 0
    if a[0] == "X" or b[0] == "X":
        return 1 if a[-4:] == b[-4:] else -1
    return 2 if a == b else 0 if within_one(a, b) else -1


def calibrate(x: np.ndarray, y: np.ndarray, start: np.ndarray, steps: int = 60, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model (last: constant) by Newton steps. The penalty draws them towards ``start``: what few labelled
    candidates can't say stays as it is there."""
    x = np.c_[x, np.ones(len(x))]
    w = start.copy()
    penalty = ridge * np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ (w - start))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


#: What is believed before any labelled candidate is seen: log-odds by feature.
DEFAULT = {"family_score": 2.0, "given_score": 3.0, "birth_score": 3.0, "phone_score": 3.0, "email_score": 3.0, "street_score": 1.5, "family_clash": -1.5, "given_clash": -5.0, "birth_clash": -4.0, "suffix_clash": -4.0, "middle_clash": -1.5, "given_birth": 2.0, "family_birth": 1.0}
DEFAULT_CONSTANT = -7.0
#: Bins of the reliability table.
BINS = 10


def reliability(x: np.ndarray, y: np.ndarray, half: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """(bin, n, confidence, share): each half of the labelled candidates by the model of the other half."""
    p = np.zeros(len(y))
    for side in (True, False):
        w = calibrate(x[half != side], y[half != side], start)
        p[half == side] = 1 / (1 + np.exp(-np.clip(x[half == side] @ w[:-1] + w[-1], -30, 30)))
    out = pd.DataFrame({"bin": np.minimum((p * BINS).astype(int), BINS - 1), "p": p, "y": y})
    return out.groupby("bin").agg(n=("p", "size"), confidence=("p", "mean"), share=("y", "mean")).reset_index()


def calibration_error(table: pd.DataFrame) -> float:
    """Mean distance between confidence and share of true pairs, weighted by the candidates of each bin."""
    return float((table["n"] * (table["confidence"] - table["share"]).abs()).sum() / max(table["n"].sum(), 1))


def _read(df: DataFrame, key: str, person: str) -> DataFrame:
    kind = "k long, shard int, " + ", ".join(f"{a} string" for a in ATTRIBUTES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [read_person(p) for p in pdf["p"]]
            yield pd.DataFrame({"k": pdf["k"], "shard": pdf["shard"].astype("Int32")} | {a: [r[a] for r in rows] for a in ATTRIBUTES})

    picked = F.col(person)
    slim = F.struct(picked["birthDate"].alias("birthDate"), picked["name"].alias("name"), picked["telecom"].alias("telecom"), picked["address"].alias("address"), picked["identifier"].alias("identifier"), picked["extension"].alias("extension"))
    nested = F.when(picked.isNotNull(), slim).alias("p")

    read = spread(df.where(f"{key} is not null").select(F.col(key).alias("k"), F.coalesce("shard", F.lit(-1)).cast("int").alias("shard"), nested)).mapInPandas(run, kind)
    return cut(read.groupBy("k").agg(F.min(F.struct("shard", *ATTRIBUTES)).alias("r")).select("k", "r.*"))


def _file(people: DataFrame, name: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at : at + 1000]
                out = []
                for r in part.to_dict("records"):
                    out += [(xxhash.xxh64_intdigest(key) - 2**63, v - 2**64 if v >= 2**63 else v, r["k"]) for key, v in set(search_keys(r["shard"], r))]
                if out:
                    yield pd.DataFrame({c: np.array([o[i] for o in out], dtype=np.int64) for i, c in enumerate(("key", f"v_{name}", name))})

    return people.mapInPandas(run, f"key long, v_{name} long, {name} long")


@dataclass
class Matches:
    """``pairs`` (left, right, confidence) of all candidates; ``weights`` of the calibrated model by feature; ``numbers``: log-odds of
    each outcome of comparing numbers; ``reliability`` on held-out labelled candidates."""

    pairs: DataFrame
    weights: dict[str, float]
    numbers: dict[int, float]
    reliability: pd.DataFrame


def match_entities(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_person: str, right_person: str) -> Matches:
    """Candidates of two tables within a shard, each with a confidence that both describe the same person.

    Rows with a null key are left out, repeated rows of a key count once, a null shard is a shard of its own, a record without
    usable attributes has no candidates, empty tables give empty results. Other columns are not read."""
    a, b = _read(left, left_key, left_person), _read(right, right_key, right_person)
    met = _file(a, "x").join(_file(b, "y"), "key").where(F.bit_count(F.col("v_x").bitwiseXOR(F.col("v_y"))) <= RADIUS).select("x", "y").distinct()
    side = lambda df, s: df.select(F.col("k").alias(f"{s}k"), *[F.col(c).alias(f"{s}_{c}") for c in ATTRIBUTES])
    both = met.join(side(a, "a"), F.col("x") == F.col("ak")).join(side(b, "b"), F.col("y") == F.col("bk")).drop("ak", "bk")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sides = [[dict(zip(ATTRIBUTES, r)) for r in zip(*(pdf[f"{s}_{c}"] for c in ATTRIBUTES))] for s in "ab"]
            scores = [np.array(field_scores(p, q), dtype=np.float32) for p, q in zip(*sides)]
            if len(pdf):
                yield pd.DataFrame({"left": pdf["x"], "right": pdf["y"], "number": np.array([number_evidence(p["ssn"], q["ssn"]) for p, q in zip(*sides)], dtype=np.int32), "f": scores})

    scored = cut(spread(both).mapInPandas(score, "left long, right long, number int, f array<float>"))
    labelled = scored.where("number in (2, -1)").orderBy(F.xxhash64("left", "right")).limit(CALIBRATION_ROWS).select("number", "f", (F.pmod(F.xxhash64("left"), F.lit(2)) == 0).alias("half")).toPandas()
    y = (labelled["number"] == 2).to_numpy(dtype=float)
    x = np.stack(labelled["f"].to_list()).astype(float) if len(y) else np.zeros((0, len(FEATURES)))
    start = np.array([DEFAULT.get(f, 0.0) for f in FEATURES] + [DEFAULT_CONSTANT])
    weights = calibrate(x, y, start)
    z = F.aggregate(F.zip_with("f", F.array(*[F.lit(float(w)) for w in weights[:-1]]), lambda p, q: p * q), F.lit(float(weights[-1])), lambda s, v: s + v)
    belief = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    told = {r["number"]: (r["yes"], r["no"]) for r in scored.groupBy("number").agg(F.sum(belief).alias("yes"), F.sum(F.lit(1.0) - belief).alias("no")).collect()}  # four outcomes
    yes, no = (sum(v[i] for v in told.values()) for i in (0, 1))
    numbers = {k: math.log((a + 1) / (yes + 4) / ((b + 1) / (no + 4))) for k, (a, b) in ((k, told.get(k, (0.0, 0.0))) for k in (2, 1, 0, -1))}
    extra = F.try_element_at(F.create_map(*[x for k, v in numbers.items() for x in (F.lit(k), F.lit(v))]), F.col("number"))
    pairs = scored.select("left", "right", (F.lit(1.0) / (F.lit(1.0) + F.exp(-(z + extra)))).alias("confidence"))
    return Matches(pairs, dict(zip([*FEATURES, "constant"], weights.tolist())), numbers, reliability(x, y, labelled["half"].to_numpy(dtype=bool), start))
