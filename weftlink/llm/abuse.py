"""Scores for abusive, hateful or sexual language (problem 8).

A text is cut into sentences and, where they are long, overlapping windows of words. A piece is a bag of words, neighbouring word
pairs and letter n-grams of words, each hashed to a row of an embedding table; the mean of its rows goes through a linear softmax.
Table and softmax are trained jointly in numpy. Labels belong to whole documents, so a document's score is a soft maximum over
its pieces: one abusive sentence in a long harmless text is found, and misspelled or disguised words share n-grams with plain ones.

Raters err. How often they do follows from documents that several of them rated. Each fold's model scores the labelled documents that
it was not trained on; that score and the ratings together give the chance that a document is abusive, and the models are trained
again on these chances. The folds are trained in tasks of their own; their mean is the model that scores the corpus.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.session import cut, spread

#: Rows and width of the embedding table.
BUCKETS, WIDTH = 1 << 16, 8
#: Words of a piece at most, and how far the next one begins.
LONG, STEP = 18, 9
#: Labelled documents that are trained on at most, taken by hash order. Every document is scored.
TRAIN_DOCS = 4000
#: Folds, and how often the chances are read again from the models of the other folds.
FOLDS, ROUNDS = 4, 2
#: Score from which a document is abusive: the softmax holds both classes equally likely.
THRESHOLD = 0.5
#: What is believed about raters before any two have rated one document: as if so many pairs of ratings held one disagreement.
PRIOR_PAIRS = 20
EPOCHS, RATE, DECAY, SHARP = 120, 0.03, 5e-4, 3.0
#: Rows that are added to every mean as zeros, so that very short pieces aren't extreme.
SHRINK = 40
#: What a word pair weighs, in rows.
PAIR = 4

_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_SPELLED = re.compile(r"\b(?:\w[-._* ]){3,}\w\b")
_WORD = re.compile(r"[^\W_](?:[^\s,;:!?()\"“”«»¿¡]*[^\W_])?|[*#$@]{2,}")
_DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})


def plain(text: str) -> str:
    """Lower case, compatibility forms unified, without accents and invisible characters, spelled-out words put together."""
    text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).lower()
    text = "".join(c for c in text if not unicodedata.combining(c)).replace("’", "'").replace("ß", "ss")
    return _SPELLED.sub(lambda m: re.sub(r"[-._* ]", "", m[0]), text)


def pieces(text: str | None) -> list[list[str]]:
    """The words of each sentence, long sentences as overlapping windows; nothing for a null or blank text."""
    out = []
    for sentence in re.split(r"[\r\n\v\f\x85  ]+|(?<=[.!?…])[\"'”»)]*\s+", plain(text or "")):
        found = []
        for w in _WORD.findall(sentence):
            w = w.strip("'-.")
            if any(c.isdigit() for c in w):
                letters = sum(c.isalpha() for c in w)
                w = w.translate(_DISGUISE) if letters * 2 > len(w) and letters > 1 else "#"
            if w:
                found.append(w)
        if len(found) <= LONG:
            if found:
                out.append(found)
        else:
            out += [found[i : i + LONG] for i in range(0, max(1, len(found) - LONG + STEP), STEP)]
    return out


def _bucket(x: str) -> int:
    return xxhash.xxh32_intdigest(x) % BUCKETS


def word_rows(word: str) -> list[int]:
    """Rows of a word: itself and its letter n-grams of 3 to 5."""
    marked = f"<{word}>"
    return [_bucket("w" + word)] * 2 + [_bucket(marked[i : i + n]) for n in (3, 4, 5) for i in range(len(marked) - n + 1)]


def pair_row(a: str, b: str) -> int:
    return _bucket(f"{a} {b}")


@dataclass
class Model:
    """Embedding table, weights and constant of the softmax, the document score from which a text is abusive, how often raters
    err, and the scores of the labelled documents by models that did not see them."""

    table: np.ndarray
    weights: np.ndarray
    constant: float
    threshold: float = THRESHOLD
    error: float = 0.0
    held_out: pd.DataFrame | None = None

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; keeps what a word adds, since words come again."""

    def __init__(self, model: Model) -> None:
        self.value = model.table @ model.weights  # averaging and the linear layer commute: one number a row is enough to score
        self.constant, self.memo = model.constant, {}

    def logit(self, words: list[str]) -> float:
        total, n = 0.0, 0
        for w in words:
            known = self.memo.get(w)
            if known is None:
                rows = word_rows(w)
                known = self.memo[w] = (float(self.value[rows].sum()), len(rows))
                if len(self.memo) > 500_000:
                    self.memo.clear()
            total, n = total + known[0], n + known[1]
        for a, b in zip(words, words[1:]):
            total, n = total + PAIR * float(self.value[pair_row(a, b)]), n + PAIR
        return total / (n + SHRINK) + self.constant

    def score(self, text: str | None) -> float:
        """Probability that the text is abusive; 0 for a text without words."""
        logits = [self.logit(p) for p in pieces(text)]
        return float(1 / (1 + np.exp(-max(logits)))) if logits else 0.0


def _scatter(index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How to add values up by index: (order, heads of equal indices, the indices)."""
    order = np.argsort(index, kind="stable")
    used, first = np.unique(index[order], return_index=True)
    return order, first, used


class Bags:
    """Documents as pieces, pieces as units (words and pairs), units as rows of the table; every unit is added up once a step."""

    def __init__(self, texts: list[str]) -> None:
        units: dict[object, int] = {}
        rows, begin, weight = [], [], []

        def unit(key: object, own: list[int], w: int) -> int:
            k = units.get(key)
            if k is None:
                k = units[key] = len(begin)
                begin.append(len(rows))
                weight.append(w)
                rows.extend(own)
            return k

        content, starts, owner = [], [], []
        for d, text in enumerate(texts):
            for p in pieces(text):
                starts.append(len(content))
                owner.append(d)
                content += [unit(w, units.get(w) is None and word_rows(w) or [], 1) for w in p]
                content += [unit((a, b), [pair_row(a, b)], PAIR) for a, b in zip(p, p[1:])]
        self.rows, self.begin, self.weight = np.array(rows, dtype=np.int32), np.array(begin, dtype=np.int64), np.array(weight, dtype=np.float32)
        self.content, self.starts, self.owner = np.array(content, dtype=np.int32), np.array(starts, dtype=np.int64), np.array(owner, dtype=np.int64)
        if len(starts):
            lengths = np.diff(np.r_[self.begin, len(self.rows)]) * self.weight
            self.size = np.add.reduceat(lengths[self.content], self.starts).astype(np.float32) + SHRINK
            self.piece_of = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[self.starts, len(self.content)]))
            self.unit_of = np.repeat(np.arange(len(begin), dtype=np.int32), np.diff(np.r_[self.begin, len(self.rows)]))
            self.to_units, self.to_rows = _scatter(self.content), _scatter(self.rows)
            self.heads = np.flatnonzero(np.r_[True, self.owner[1:] != self.owner[:-1]])
            self.doc_of = np.cumsum(np.r_[True, self.owner[1:] != self.owner[:-1]]) - 1
        self.n = len(texts)

    def means(self, table: np.ndarray) -> np.ndarray:
        """The mean row of each piece."""
        unit = np.add.reduceat(table[self.rows], self.begin, axis=0) * (self.weight[:, None] if table.ndim > 1 else self.weight)
        mean = np.add.reduceat(unit[self.content], self.starts, axis=0)
        return mean / (self.size[:, None] if table.ndim > 1 else self.size)

    def scores(self, model: Model) -> np.ndarray:
        """The score of each document; 0 for one without words."""
        out = np.zeros(self.n)
        if len(self.starts):
            out[self.owner[self.heads]] = 1 / (1 + np.exp(-(np.maximum.reduceat(self.means(model.table @ model.weights), self.heads) + model.constant)))
        return out


def train(bag: Bags, labels: np.ndarray, weight: np.ndarray, seed: int = 0, epochs: int = EPOCHS) -> Model:
    """Fit table and softmax together by gradient steps over all documents of positive weight; ``labels`` are chances between 0
    and 1."""
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((BUCKETS, WIDTH)) * 0.1).astype(np.float32)
    weights, constant = (rng.standard_normal(WIDTH) * 0.1).astype(np.float32), np.float32(-2.0)
    if not len(bag.starts):
        return Model(table, weights, -20.0)
    docs = bag.owner[bag.heads]
    y, own = labels[docs].astype(np.float32), weight[docs].astype(np.float32)
    share = float((y * own).sum() / max(own.sum(), 1e-6))
    balance = own * np.where(y > 0.5, np.clip((1 - share) / max(share, 1e-3), 1.0, 4.0), 1.0).astype(np.float32)
    order, first, used = bag.to_rows
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (table[used], weights, np.zeros(1, np.float32))]
    for step in range(1, epochs + 1):
        mean = bag.means(table)
        z = mean @ weights + constant
        top = np.maximum.reduceat(z, bag.heads)
        e = np.exp((z - top[bag.doc_of]) * SHARP)
        attention = e / np.add.reduceat(e, bag.heads)[bag.doc_of]
        p = 1 / (1 + np.exp(-np.add.reduceat(attention * z, bag.heads)))
        g = ((p - y) * balance)[bag.doc_of] * attention
        # the linear layer comes last, so what flows back to a row is a number times the weights
        piece = g / bag.size
        unit = np.zeros(len(bag.begin), dtype=np.float32)
        unit[bag.to_units[2]] = np.add.reduceat(piece[bag.piece_of[bag.to_units[0]]], bag.to_units[1])
        row = np.add.reduceat((unit * bag.weight)[bag.unit_of[order]], first)
        grads = [row[:, None] * weights[None, :] + DECAY * table[used], mean.T @ g + DECAY * own.sum() * weights, np.array([g.sum()])]
        updates = []
        for grad, moment in zip(grads, moments):
            moment[0] = 0.9 * moment[0] + 0.1 * grad
            moment[1] = 0.99 * moment[1] + 0.01 * grad * grad
            updates.append(RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-6))
        table[used] -= updates[0].astype(np.float32)
        weights -= updates[1].astype(np.float32)
        constant -= np.float32(updates[2][0])
    return Model(table, weights, float(constant))


def error_rate(yes: np.ndarray, no: np.ndarray) -> float:
    """How often a rater errs, from the share of documents with several raters on which they disagree."""
    several = yes + no > 1
    return float((1 + (several & (yes > 0) & (no > 0)).sum()) / (2 * (PRIOR_PAIRS + several.sum())))


def chances(score: np.ndarray, yes: np.ndarray, no: np.ndarray, error: float) -> np.ndarray:
    """The chance that a document is abusive, given a score that owes nothing to its own ratings, and the ratings."""
    p = np.clip(score, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-np.clip(np.log(p / (1 - p)) + (yes - no) * np.log((1 - error) / error), -30, 30)))


def _train_folds(sample: DataFrame, chance: dict[int, float]) -> tuple[Model, pd.DataFrame]:
    """Train each fold's model on the documents of the other folds, each in a task of its own; gives the mean of the models, as one
    number per row of the table, and (doc_id, score) of each document by its own fold's model. ``chance`` holds one number for
    each of the at most ``TRAIN_DOCS`` documents."""
    shared = sample.sparkSession.sparkContext.broadcast(chance)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [p for p in batches if len(p)]
        if not parts:
            return
        docs = pd.concat(parts).sort_values(["h", "doc_id"])
        mine, bag = int(docs["_task"].iloc[0]), Bags(docs["text"].tolist())
        y, own = docs["doc_id"].map(shared.value).to_numpy(dtype=float), docs["fold"].to_numpy() == mine
        model = train(bag, y, (~own).astype(float), seed=mine)
        yield pd.DataFrame({"doc_id": [*docs["doc_id"][own], -1], "score": [*bag.scores(model)[own], model.constant], "row": [*[None] * own.sum(), (model.table @ model.weights).astype(np.float32)]})

    copies = sample.withColumn("_task", F.explode(F.array(*[F.lit(k) for k in range(FOLDS)]))).repartitionById(FOLDS, F.col("_task"))
    out = copies.mapInPandas(run, "doc_id long, score double, row array<float>").toPandas()
    fitted = out["row"].notna()
    value = np.mean(np.stack(out["row"][fitted].to_list()), axis=0)
    return Model(value[:, None].astype(np.float32), np.ones(1, np.float32), float(out["score"][fitted].mean())), out.loc[~fitted, ["doc_id", "score"]]


def fit_labels(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from rated documents. Null ratings are no ratings, what one rater says of a document twice counts once (as its
    mean), ratings of unknown or blank documents are left out; with no abusive or no harmless document the model scores everything 0."""
    rater = F.col("rater") if "rater" in labels.columns else F.lit(None)
    once = labels.where("flagged is not null and doc_id is not null").groupBy("doc_id", rater.alias("rater")).agg(F.avg(F.col("flagged").cast("double")).alias("y"))
    rated = once.groupBy("doc_id").agg(F.sum("y").alias("yes"), F.sum(F.lit(1.0) - F.col("y")).alias("no"))
    texts = documents.where("doc_id is not null").select("doc_id", "text").where(F.length(F.trim("text")) > 0).join(rated, "doc_id").dropDuplicates(["doc_id"])
    # the bounded sample of labelled rows; their texts stay on the executors
    sample = cut(texts.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(TRAIN_DOCS).withColumn("fold", F.pmod(F.shiftright("h", 7), F.lit(FOLDS)).cast("int")))
    known = sample.select("doc_id", "yes", "no").toPandas()
    yes, no = known["yes"].to_numpy(dtype=float), known["no"].to_numpy(dtype=float)
    if not ((yes > no).any() and (yes < no).any()):
        return Model(np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), -20.0)
    error, chance = error_rate(yes, no), yes / (yes + no)
    for _ in range(ROUNDS + 1):
        model, held = _train_folds(sample, dict(zip(known["doc_id"].tolist(), chance.tolist())))
        known = known.drop(columns="score", errors="ignore").merge(held, on="doc_id")
        yes, no = known["yes"].to_numpy(dtype=float), known["no"].to_numpy(dtype=float)
        chance = chances(known["score"].to_numpy(), yes, no, error)
    model.error, model.held_out = error, known
    return model


def score_documents(documents: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, score, flagged) of every row; null, empty and blank texts score 0. The model goes to the workers once, as
    one number per table row (``BUCKETS`` numbers)."""
    threshold = model.threshold
    shared = documents.sparkSession.sparkContext.broadcast(Model((model.table @ model.weights)[:, None].astype(np.float32), np.ones(1, np.float32), model.constant))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = shared.value.scorer()
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                scores = np.array([scorer.score(t) for t in part["_text"]])
                yield part.drop(columns="_text").assign(score=scores, flagged=scores >= threshold)

    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep)) + ", score double, flagged boolean"
    return spread(documents.select("doc_id", *keep, F.col("text").alias("_text"))).mapInPandas(run, schema)
