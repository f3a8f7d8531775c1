"""Encoding of a corpus with a public byte-level BPE (problem 6).

A text is cut in halves down to leaves, the leaves are encoded in batches, and neighbours are joined up the tree. At a join only a
window around the seam is encoded again. It grows until both of its ends are stable: a place where a white-space character follows
a character that is none is a border of the pre-tokenizer in every context, because each of its pieces is either white space alone
or one optional space and a run without white space, and no piece that ends without white space looks ahead. Tokens outside such
a window can't change, so the joined ids are exactly those of the whole text. Joining is associative, the empty text is neutral.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.session import spread

VOCABULARY = "byte_bpe_50k.json"
#: Characters of a leaf; longer texts are halved.
LEAF = 4096
#: First width of the window at a join; it doubles until it ends at stable places.
WINDOW = 32


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where a vocabulary file lies: the folder of the environment, or that of the installed package."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


class Codec:
    """One vocabulary in one Python worker."""

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.width = [len(n) for n in names]  # in the byte alphabet a character stands for one byte
        self.names, self.leaf = names, leaf
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}

    def _encode_leaves(self, texts: list[str]) -> list[list[int]]:
        run = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in run(texts, add_special_tokens=False)]

    def _spans(self, lo: int, hi: int) -> list[tuple[int, int]]:
        if hi - lo <= self.leaf:
            return [(lo, hi)]
        mid = (lo + hi) // 2
        return self._spans(lo, mid) + self._spans(mid, hi)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; null and empty texts have none."""
        spans = [self._spans(0, len(t)) if t else [] for t in texts]
        leaves = iter(self._encode_leaves([t[lo:hi] for t, own in zip(texts, spans) for lo, hi in own]))
        out = []
        for text, own in zip(texts, spans):
            nodes = [(lo, hi, next(leaves)) for lo, hi in own]
            while len(nodes) > 1:
                nodes = [self.join(text, nodes[i], nodes[i + 1]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
            out.append(nodes[0][2] if nodes else [])
        return out

    @staticmethod
    def _stable(text: str, at: int) -> bool:
        return text[at] in " \n" and (text[at - 1].isalnum() or "!" <= text[at - 1] <= "~")

    def _left_end(self, text: str, lo: int, hi: int) -> int:
        width = WINDOW
        start = hi
        while start > lo:
            stop, start = start, max(lo, hi - width)
            for at in range(stop - 1, max(start, lo + 1) - 1, -1):
                if self._stable(text, at):
                    return at
            width *= 2
        return lo

    def _right_end(self, text: str, lo: int, hi: int) -> int:
        width = WINDOW
        stop = lo
        while stop < hi:
            start, stop = stop, min(hi, lo + width)
            for at in range(max(start, lo + 1), stop):
                if self._stable(text, at):
                    return at
            width *= 2
        return hi

    def join(self, text: str, left: tuple, right: tuple) -> tuple:
        """Two neighbouring parts (from, to, ids) of a text as one."""
        (lo, seam, a), (_, hi, b) = left, right
        p, q = self._left_end(text, lo, seam), self._right_end(text, seam, hi)
        rest = len(text[p:seam].encode("utf-8", "surrogatepass"))
        i = len(a)
        while rest > 0:
            i -= 1
            rest -= self.width[a[i]]
        rest = len(text[seam:q].encode("utf-8", "surrogatepass"))
        j = 0
        while rest > 0:
            rest -= self.width[b[j]]
            j += 1
        return lo, hi, a[:i] + self._encode_leaves([text[p:q]])[0] + b[j:]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are put together up to the top before they are read as characters."""
        return bytes(self.byte[c] for i in ids for c in self.names[i]).decode("utf-8", "replace")


def _codec(path: str, leaf: int, held: dict = {}) -> Codec:  # one per worker
    if (path, leaf) not in held:
        held[path, leaf] = Codec(path, leaf)
    return held[path, leaf]


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """One row (key, ids) for every row: ids of ``text`` without special tokens, the empty list for a null or empty text.

    Strings of special tokens in a text are ordinary text; repeated rows and null keys are kept; other columns are not read."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, leaf)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                yield pd.DataFrame({"k": part["k"], "ids": [np.array(x, dtype=np.int32) for x in codec.encode(part["t"].tolist())]})

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key).alias("k"), F.col(text).alias("t"))).mapInPandas(run, f"k {kind}, ids array<int>").select(F.col("k").alias(key), "ids")


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """(key, *keep, n_tokens) for every row; 0 for null and empty texts. Ids never leave the worker."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, LEAF)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                yield part.drop(columns="_text").assign(n_tokens=np.array([len(x) for x in codec.encode(part["_text"].tolist())], dtype=np.int64))

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (key, *keep)) + ", n_tokens long"
    return spread(df.select(key, *keep, F.col(text).alias("_text"))).mapInPandas(run, schema)
