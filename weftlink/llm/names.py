"""Variant spellings of typed names (problem 5).

Words of a name are sets of q-grams with at most one gap, taken at the word's two ends; the grams at the ends are the prefix of the
set-similarity join. Words within the slips that ``alike`` allows share at least one of them, as one of their ends holds one
slip at most (``short_grams``), so the join finds every similar pair. It runs over the distinct words of a block: a block is a
shard and a birth year, words of rows without a usable year meet all words of their shard. Rows are candidates if a family word is
similar and given names can agree. They are verified by a soft weighted similarity: each word is aligned to its most similar word,
rare words count more, and family name, given names and suffix may not contradict each other. Equal forms are one representative
throughout; pairs are written out for members only at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.strings import FORMAL, alike, given_alike, name_parts, slips, suffix_of
from weftlink.session import cut, spread

#: Weighted similarity from which two names are the same.
SAME = 0.72
#: Birth years that stand for "not known".
STOCK_YEARS = (1900, 1901, 9999)


#: Stands for a missing shard or year in keys.
NONE = -(1 << 31)


def _end(n: int) -> int:
    """Letters of each end of a word of n letters that are looked at; 0: the whole word. Both ends of two similar words hold so many
    letters apart that one slip can't touch both (six letters: that two slips can't spoil both)."""
    return 0 if n < 6 else 3 if n == 6 else (n - 1) // 2


def _without(word: str, gaps: int) -> set[str]:
    """A word and what is left of it without up to so many of its letters."""
    out = now = {word}
    for _ in range(gaps):
        now = {x[:i] + x[i + 1 :] for x in now for i in range(len(x))}
        out = out | now
    return out


def _ends(word: str, k: int) -> set[str]:
    """The grams of k - 1 letters that the first and the last k letters leave with one gap."""
    return {f"{k}{side}{end[:i]}{end[i + 1 :]}" for side, end in (("<", word[:k]), (">", word[-k:])) for i in range(k)}


@lru_cache(1 << 17)
def short_grams(word: str) -> frozenset[str]:
    """The grams of a word that meet ``long_grams`` of every similar word that isn't shorter."""
    n = len(word)
    return frozenset(_ends(word, _end(n)) if n > 5 else {f"0{x}" for x in _without(word, 1 if n > 2 else 0)})


@lru_cache(1 << 17)
def long_grams(word: str) -> frozenset[str]:
    """The grams of a word that meet ``short_grams`` of every similar word that isn't longer: a partner of n letters brings those
    of its own ends."""
    n = len(word)
    out = {f"0{x}" for x in _without(word, 2 if n > 5 else 1 if n > 2 else 0) if len(x) < 6} if n < 8 else set()
    for k in {_end(m) for m in range(max(6, n - slips(n)), n + 1)}:
        out |= _ends(word, k)
    return frozenset(out)


def forms_of(found: list[str]) -> list[str]:
    """The words and all formal names that they can stand for."""
    return sorted({x for w in found for x in (w, *FORMAL.get(w, ()))})


def agreement(a: tuple, b: tuple) -> float:
    """Soft weighted similarity of two names (family words, given words, suffix, weights of words); 0 where they contradict."""
    (fa, ga, sa, wa), (fb, gb, sb, wb) = a, b
    if sa and sb and sa != sb:
        return 0.0
    best = _oriented(fa, ga, wa, fb, gb, wb)
    if best < 1.0 and (len(ga) and len(gb)):
        best = max(best, _oriented(fa, ga, wa, gb[:1], fb + gb[1:], wb) * 0.99, _oriented(ga[:1], fa + ga[1:], wa, fb, gb, wb) * 0.99)
    return best


def _oriented(fa: list, ga: list, wa: dict, fb: list, gb: list, wb: dict) -> float:
    if not (fa and fb and ga and gb):
        return 0.0
    small, large = (fa, fb) if len(fa) <= len(fb) else (fb, fa)
    weight, total, left = 0.0, 0.0, list(large)
    joined = alike("".join(fa), "".join(fb)) if len(fa) != len(fb) else 0.0
    if joined:
        w = max(wa.get(fa[0], 1.0), wb.get(fb[0], 1.0))
        total, weight = total + w * joined, weight + w
    else:
        for x in small:
            y = max(left, key=lambda y: alike(x, y), default=None)
            s = alike(x, y) if y is not None else 0.0
            if not s:
                return 0.0
            left.remove(y)
            w = max(wa.get(x, 1.0), wb.get(x, 1.0), wa.get(y, 1.0), wb.get(y, 1.0))
            total, weight = total + w * s, weight + w
    first = given_alike(ga[0], gb[0])
    ma, mb = ga[1:], gb[1:]
    if not first and ma and mb and given_alike(ga[0], mb[0]) and given_alike(ma[0], gb[0]):
        first, ma, mb = min(given_alike(ga[0], mb[0]), given_alike(ma[0], gb[0])), [], []
    if not first:
        return 0.0
    w = 0.5 * max(wa.get(ga[0], 1.0), wb.get(gb[0], 1.0))
    total, weight = total + w * first, weight + w
    if ma and mb:
        s = max(given_alike(x, y) for x in ma for y in mb)
        if not s:
            return 0.0
        total, weight = total + 0.3 * w * s, weight + 0.3 * w
    return total / weight


@dataclass
class Links:
    """``members`` (name_id, rep): the representative of each row; ``pairs`` (rep_a, rep_b, score): linked representatives."""

    members: DataFrame
    pairs: DataFrame


def similar_words(a: DataFrame, b: DataFrame) -> DataFrame:
    """(shard, year, wa, ta, wb, tb): words of ``a`` with the words of ``b`` (shard, year, w, t) in the same block that are within
    their slips of each other or nearly so, wb being no shorter. ``t`` says whether the word is read as a given name; two words so
    read don't meet. Every pair with ``alike`` above 0 is found."""

    def keys(grams, left: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for shard, year, w, t in zip(pdf["shard"], pdf["year"], pdf["w"], pdf["t"]):
                    roles = ("gf" if left else "fg",) if t else (("ff", "fg") if left else ("ff", "gf"))
                    out += [(xxhash.xxh64_intdigest(f"{shard}|{year}|{r}{g}") - 2**63, shard, year, w, t) for r in roles for g in grams(w)]
                if out:
                    yield pd.DataFrame(out, columns=["key", "shard", "year", "w", "t"])

        return run

    emit = lambda df, grams, left, s: spread(df).mapInPandas(keys(grams, left), "key long, shard int, year int, w string, t boolean").select("key", *[F.col(c).alias(f"{c}{s}") for c in ("shard", "year", "w", "t")])
    met = emit(a, short_grams, True, "a").join(emit(b, long_grams, False, "b"), "key").where("sharda = shardb and yeara = yearb and length(wa) <= length(wb)")
    n = F.length("wb")
    slack = F.when(n < 3, 0).when(n < 6, 1).when(n < 10, 2).otherwise(3)
    met = met.where((n - F.length("wa") <= slack) & (F.levenshtein("wa", "wb") <= 2 * slack))  # an exchange of neighbours is two plain edits
    return met.select(F.col("sharda").alias("shard"), F.col("yeara").alias("year"), "wa", "ta", "wb", "tb").distinct()


def link_names(df: DataFrame) -> Links:
    """Link rows (name_id, shard, family, given, suffix, text, birth_year) that name the same person.

    Null ids, absent, unknown and test names link to nothing; repeated rows of an id count once; a null shard is a shard of its own; a
    null or stock birth year agrees with any year, but only if all namesakes of the row in its shard are of one year. An empty
    table gives empty results."""
    schema = "name_id long, shard int, year int, fam string, giv string, suffix string"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [name_parts(f, g, t) for f, g, t in zip(pdf["family"], pdf["given"], pdf["text"])]
            suffix = [suffix_of(f, t, *(g if g is not None else []), *(s if s is not None else [])) for f, t, g, s in zip(pdf["family"], pdf["text"], pdf["given"], pdf["suffix"])]
            yield pd.DataFrame({"name_id": pdf["name_id"], "shard": pdf["shard"], "year": pdf["birth_year"].mask(pdf["birth_year"].isin(STOCK_YEARS), NONE), "fam": [" ".join(f) for f, _ in parts], "giv": [" ".join(g) for _, g in parts], "suffix": suffix})

    raw = df.where("name_id is not null").select("name_id", F.coalesce(F.col("shard").cast("int"), F.lit(NONE)).alias("shard"), "family", "given", "suffix", "text", F.coalesce(F.col("birth_year").cast("int"), F.lit(NONE)).alias("birth_year"))
    rows = spread(raw).mapInPandas(read, schema).where("fam <> '' or giv <> ''")
    form = ("shard", "year", "fam", "giv", "suffix")
    rows = cut(rows.groupBy("name_id").agg(F.min(F.struct(*form)).alias("r")).select("name_id", "r.*"))
    forms = rows.groupBy(*form).agg(F.min("name_id").alias("rep"))
    members = rows.join(forms, list(form)).select("name_id", "rep", "fam", "giv")

    words = forms.select("rep", F.explode(F.split(F.concat_ws(" ", F.nullif("fam", F.lit("")), F.nullif("giv", F.lit(""))), " ")).alias("w"))
    common = words.groupBy("w").agg(F.count("*").alias("n"))
    rarity = F.log(F.lit(1.0) + F.lit(1e6) / (F.col("n") + F.lit(1)))  # falls with the count; the scale cancels within a name
    weighted = words.join(common, "w").groupBy("rep").agg(F.collect_list(F.struct("w", rarity.alias("v"))).alias("ws"))
    reps = cut(forms.where("giv <> ''").join(weighted, "rep"))

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each form by its family words (put together, too, where they are several) and by the given name that may be one, with the
        given names that such a reading leaves."""
        for pdf in batches:
            out = []
            for rep, shard, year, fam, giv in zip(pdf["rep"], pdf["shard"], pdf["year"], pdf["fam"], pdf["giv"]):
                f, g = fam.split(), giv.split()
                read = {*f, *(["".join(f)] if len(f) > 1 else [])}
                out += [(rep, shard, year, w, False, forms_of(g[:2])) for w in sorted(read)] + [(rep, shard, year, g[0], True, forms_of((f + g[1:])[:2]))]
            if out:
                yield pd.DataFrame(out, columns=["rep", "shard", "year", "w", "t", "alt"])

    laid = cut(reps.select("rep", "shard", "year", "fam", "giv").mapInPandas(lay, "rep long, shard int, year int, w string, t boolean, alt array<string>"))
    # what can't agree is left out before Python sees it. Given names agree if a form of both begins with the same letter or is two slips apart
    longer = lambda u, v: F.greatest(F.length(u), F.length(v))
    close = lambda u, v: (F.substring(u, 1, 1) == F.substring(v, 1, 1)) | (F.levenshtein(u, v) <= F.when(longer(u, v) < 6, 2).otherwise(4))
    agree = F.exists("altx", lambda u: F.exists("alty", lambda v: close(u, v)))

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        words_of = lambda df: df.select("shard", "year", "w", "t").distinct()
        side = lambda df, s: df.select(F.col("shard").alias(f"shard{s}"), F.col("year").alias(f"year{s}"), F.col("w").alias(f"own{s}"), F.col("t").alias(f"read{s}"), F.col("rep").alias(s), F.col("alt").alias(f"alt{s}"))
        on = lambda s, w: (F.col("shard") == F.col(f"shard{s}")) & (F.col("year") == F.col(f"year{s}")) & (F.col(f"w{w}") == F.col(f"own{s}")) & (F.col(f"t{w}") == F.col(f"read{s}"))
        both = similar_words(words_of(a), words_of(b)).join(side(a, "x"), on("x", "a")).join(side(b, "y"), on("y", "b")).where("x <> y")
        return both.where(agree).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))

    # rows of a known year meet in their year's block; rows without one meet all rows of their shard
    known, anyhow = laid.where(F.col("year") != NONE), laid.withColumn("year", F.lit(NONE))
    unknown = laid.where(F.col("year") == NONE)
    met = meet(known, known).unionByName(meet(unknown, anyhow)).unionByName(meet(anyhow, unknown)).distinct()

    side = lambda p: reps.select(*[(F.when(F.col(c) != NONE, F.col(c)) if c == "year" else F.col(c)).alias(f"{p}_{c}") for c in ("rep", "year", "fam", "giv", "suffix", "ws")])
    both = met.join(side("a"), F.col("x") == F.col("a_rep")).join(side("b"), F.col("y") == F.col("b_rep"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep, score = [], []
            for i, (fa, ga, sa, wa, fb, gb, sb, wb) in enumerate(zip(*(pdf[f"{p}_{c}"] for p in "ab" for c in ("fam", "giv", "suffix", "ws")))):
                s = agreement((fa.split(), ga.split(), sa, {w["w"]: w["v"] for w in wa}), (fb.split(), gb.split(), sb, {w["w"]: w["v"] for w in wb}))
                if s >= SAME:
                    keep.append(i)
                    score.append(s)
            if keep:
                yield pdf.iloc[keep][["x", "y", "a_year", "b_year"]].assign(score=score, full=[len(pdf["a_giv"].iloc[i].split()[0]) > 1 and len(pdf["b_giv"].iloc[i].split()[0]) > 1 for i in keep])

    linked = cut(both.mapInPandas(verify, "x long, y long, a_year int, b_year int, score double, full boolean"))
    # a row without a year: its namesakes in the shard must all be of one year
    dated = linked.where("a_year is not null and b_year is not null").select("x", "y", "score")
    loose = linked.where("a_year is null or b_year is null")
    seen = loose.select(F.when(F.col("a_year").isNull(), F.col("x")).otherwise(F.col("y")).alias("o"), F.coalesce("a_year", "b_year").alias("year"))
    seen = seen.unionByName(loose.where("a_year is null and b_year is null").select(F.col("y").alias("o"), F.lit(None).cast("int").alias("year")))
    clear = seen.groupBy("o").agg(F.min("year").alias("lo"), F.max("year").alias("hi")).where("lo is null or lo = hi").select("o", F.col("lo").alias("only"))
    opened = loose.join(clear.select(F.col("o").alias("ox"), F.col("only").alias("yx")), (F.col("x") == F.col("ox")) & F.col("a_year").isNull(), "left").join(clear.select(F.col("o").alias("oy"), F.col("only").alias("yy")), (F.col("y") == F.col("oy")) & F.col("b_year").isNull(), "left")
    opened = opened.where("(a_year is not null or ox is not null) and (b_year is not null or oy is not null)").where(F.col("full") | F.col("a_year").isNotNull() | F.col("b_year").isNotNull()).select("x", "y", "score")
    pairs = dated.unionByName(opened).select(F.col("x").alias("rep_a"), F.col("y").alias("rep_b"), "score")
    return Links(members, pairs)


def expand(links: Links) -> DataFrame:
    """All linked pairs of rows (name_id_lo, name_id_hi): members of linked representatives, and the copies of one form among
    themselves where the form names somebody in full (family and given name)."""
    m = links.members
    a, b = m.select(F.col("name_id").alias("ia"), F.col("rep").alias("ra")), m.select(F.col("name_id").alias("ib"), F.col("rep").alias("rb"))
    across = links.pairs.join(a, F.col("rep_a") == F.col("ra")).join(b, F.col("rep_b") == F.col("rb")).select("ia", "ib")
    whole = F.col("fam").isNotNull() & (F.col("fam") != "") & (F.col("giv") != "")
    within = m.where(whole).select(F.col("name_id").alias("ia"), F.col("rep").alias("ra")).join(b, (F.col("ra") == F.col("rb")) & (F.col("ia") < F.col("ib"))).select("ia", "ib")
    return across.unionByName(within).select(F.least("ia", "ib").alias("name_id_lo"), F.greatest("ia", "ib").alias("name_id_hi")).distinct()
