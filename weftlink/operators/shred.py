"""Columnar shredding of nested JSON records into flat, linked tables.

Each person is cut into leaf columns. A leaf column belongs to a path with its repeated members marked
(``identifier[].type.coding[].code``) and is a sequence of entries (repetition level, definition level, value), as in columnar file
formats: the repetition level says which repeated member of the path goes on to its next element, the definition level how many
repeated members of the path are present. The tables are then rebuilt per repeated ancestor from the level sequences alone: a
counter per repetition level gives the index of each element, and an element exists where the definition level reaches it.

A record never leaves its task: shredding and rebuilding need no shuffle, and a batch holds a bounded number of records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.session import ship, spread

#: Members of a person that are shredded.
ROOTS = ("name", "identifier", "address", "extension")
#: Members whose elements are nodes, at any depth; a single value in place of the array is element 0.
REPEATED = frozenset(("name", "given", "suffix", "identifier", "coding", "address", "line", "extension"))
#: Records shredded together; bounds the memory of a batch, not the result.
BATCH = 500


def parse(payload: str | None) -> object:
    """The JSON value of a payload, unquoted once more where it is a string; None if it isn't complete JSON."""
    if payload is None:
        return None
    try:
        value = json.loads(payload, strict=False)
        return json.loads(value, strict=False) if isinstance(value, str) else value
    except (ValueError, RecursionError):
        return None


def persons(value: object) -> Iterator[tuple[int, dict]]:
    """(position, person) of a payload: a bundle gives its entries of type Patient, any other object without a type or of type
    Patient is a person."""
    if not isinstance(value, dict):
        return
    kind = value.get("resourceType")
    if kind == "Bundle" or (kind is None and "entry" in value):
        entries = value.get("entry")
        for i, entry in enumerate(entries if isinstance(entries, list) else [entries]):
            resource = entry.get("resource") if isinstance(entry, dict) else None
            if isinstance(resource, dict) and resource.get("resourceType") == "Patient":
                yield i, resource
    elif kind in (None, "Patient"):
        yield 0, value


def vacant(value: object) -> bool:
    """Null, a blank string, or an object or array with nothing but such values in it."""
    if value is None:
        return True
    if isinstance(value, str):
        return not value.strip()
    if isinstance(value, dict):
        return all(map(vacant, value.values()))
    if isinstance(value, list):
        return all(map(vacant, value))
    return False


class Path:
    """A member in the schema of a batch; ``level`` is the number of repeated members down to and with it."""

    def __init__(self, name: str = "", repeated: bool = False, parent: Path | None = None) -> None:
        self.name, self.repeated, self.parent = name, repeated, parent
        self.level: int = (parent.level if parent else 0) + repeated
        self.children: dict[tuple[str, bool], Path] = {}
        self.scalar = False
        self.column: tuple[list, list, list, list] = ([], [], [], [])

    def chain(self) -> list[Path]:
        return (self.parent.chain() if self.parent else []) + ([self] if self.parent else [])

    def infer(self, value: object) -> None:
        """Widen the schema by one present value."""
        if isinstance(value, dict):
            for name, x in value.items():
                self._infer_member(name, x)
        elif isinstance(value, list):
            self._infer_member("", value)
        else:
            self.scalar = True

    def _infer_member(self, name: str, value: object) -> None:
        if vacant(value):
            return
        key = (name, name in REPEATED or isinstance(value, list))
        child = self.children.get(key)
        if child is None:
            child = self.children[key] = Path(*key, self)
        for element in value if isinstance(value, list) else [value]:
            if not vacant(element):
                child.infer(element)

    def shred(self, who: int, value: object, rep: int, defined: int) -> None:
        """Add the entries of one value (None: absent) to every leaf column below this member."""
        if self.scalar:
            for part, x in zip(self.column, (who, rep, defined, None if isinstance(value, dict | list) else value)):
                part.append(x)
        for (name, repeated), child in self.children.items():
            x = value.get(name) if isinstance(value, dict) else value if isinstance(value, list) and name == "" else None
            if x is not None and repeated != (name in REPEATED or isinstance(x, list)):
                x = None
            if not repeated or vacant(x):
                child.shred(who, None if vacant(x) else x, rep, defined)
                continue
            for i, element in enumerate(x if isinstance(x, list) else [x]):
                empty = vacant(element)
                child.shred(who, None if empty else element, rep if i == 0 else child.level, defined if empty else child.level)

    def all(self) -> Iterator[Path]:
        yield self
        for child in self.children.values():
            yield from child.all()

    def leaf(self) -> Path:
        """The leaf column below this member with the fewest levels: all of them carry the same elements of this member."""
        return min((p for p in self.all() if p.scalar), key=lambda p: p.level)


def indices(who: np.ndarray, rep: np.ndarray, levels: int) -> np.ndarray:
    """The index of each entry's element at the repetition levels 1..levels: an entry of repetition level r goes on to the next
    element of level r and begins all deeper levels and, at level 0, a new record."""
    n = len(who)
    out = np.zeros((n, levels), dtype=np.int64)
    if not n:
        return out
    first = np.ones(n, dtype=bool)
    first[1:] = who[1:] != who[:-1]
    for level in range(1, levels + 1):
        total = np.cumsum((rep == level) & ~first)
        begins = np.maximum.accumulate(np.where(first | (rep < level), np.arange(n), 0))
        out[:, level - 1] = total - total[begins]
    return out


def _text(chain: list[Path], at: list[int]) -> str:
    """The path of an element, such as ``name[1].given[0]``."""
    out, level = "", 0
    for p in chain:
        out += ("." if out and p.name else "") + p.name
        if p.repeated:
            out += f"[{at[level]}]"
            level += 1
    return out


def _nearest(chain: list[Path]) -> int:
    """How many members of a path go down to its last node."""
    return max((i + 1 for i, p in enumerate(chain) if p.repeated and p.name in REPEATED), default=0)


def rebuild(root: Path, values: bool) -> Iterator[tuple[int, str, str, str, dict[str, str]]]:
    """(person, node path, parent path, table, scalar members) for each node of a shredded batch."""
    members: dict[tuple[int, str], dict[str, str]] = {}
    if values:
        for path in root.all():
            if path.scalar:
                chain = path.chain()
                k = _nearest(chain)
                rest = ".".join(p.name + "[]" * p.repeated for p in chain[k:])
                who, rep = np.array(path.column[0]), np.array(path.column[1])
                at = indices(who, rep, path.level)
                for w, i, v in zip(path.column[0], at.tolist(), path.column[3]):
                    if v is not None:
                        members.setdefault((w, _text(chain[:k], i)), {})[rest] = v if isinstance(v, str) else json.dumps(v)
    for path in root.all():
        if not (path.repeated and path.name in REPEATED):
            continue
        column, chain = path.leaf().column, path.chain()
        who, rep, defined = (np.array(x) for x in column[:3])
        at = indices(who, rep, path.level)
        starts = rep <= path.level
        starts[:1] = True
        keep = np.flatnonzero(starts & (defined >= path.level))
        up = chain[: _nearest(chain[:-1])]
        table = ".".join(p.name + "[]" * p.repeated for p in chain)
        for w, i in zip(who[keep].tolist(), at[keep].tolist()):
            node = _text(chain, i)
            yield w, node, _text(up, i), table, members.get((w, node), {}) if values else {}


def shred_records(df: DataFrame, record_id: str = "record_id", payload: str = "payload", values: bool = True) -> DataFrame:
    """One row per node: record_id, patient_pos, node_path, parent_path, node_table and, with ``values``, its scalar members as a map.

    Null, cut off or non-object payloads have no nodes; repeated deliveries of a key are read once (``latest``); vacant elements
    are no nodes but keep their index; a null record_id is kept as a key. Columns other than the two named are ignored."""
    ship(df.sparkSession)
    schema = "record_id long, patient_pos int, node_path string, parent_path string, node_table string" + (", members map<string,string>" if values else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), BATCH):
                part = pdf.iloc[at : at + BATCH]
                people = [(key, pos, person) for key, text in zip(part["k"], part["v"]) for pos, person in persons(parse(text))]
                root = Path()
                kept = [{m: person[m] for m in ROOTS if m in person} for _, _, person in people]
                for person in kept:
                    root.infer(person)
                for who, person in enumerate(kept):
                    root.shred(who, person, 0, 0)
                rows = list(rebuild(root, values))
                if not rows:  # empty columns have no type that Arrow could cast
                    continue
                out = {"record_id": pd.array([people[w][0] for w, *_ in rows], dtype="Int64"), "patient_pos": np.array([people[w][1] for w, *_ in rows], dtype=np.int32)}
                out |= {name: [r[i] for r in rows] for i, name in ((1, "node_path"), (2, "parent_path"), (3, "node_table"))}
                if values:
                    out["members"] = [r[4] for r in rows]
                yield pd.DataFrame(out)

    return df.select(F.col(record_id).cast("long").alias("k"), F.col(payload).alias("v")).mapInPandas(run, schema)


def latest(df: DataFrame, key: str, *cols: str, order: str = "received_at") -> DataFrame:
    """One row per key: the first delivery (equal times: the smallest content). Rows without a key are one row per content, as
    nothing else says whether they are one record delivered twice."""
    picked = F.struct(F.col(order).isNull().alias("_n"), F.col(order).alias("_o"), *[F.col(c) for c in cols])
    keyed = df.select(key, order, *cols).withColumn("_content", F.when(F.col(key).isNull(), F.to_json(F.struct(*cols))))
    return spread(keyed, key, "_content").groupBy(key, "_content").agg(F.min(picked).alias("_p")).select(key, *[F.col(f"_p.{c}").alias(c) for c in cols])
