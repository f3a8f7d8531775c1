"""One-pass forms: near misses of a stream of records against a fixed set of queries, and caps per group over a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftlink.functions import guard as G
from weftlink.functions import norm as N
from weftlink.functions.guard import a, b, side
from weftlink.operators.mine import key_list, search_keys


def stream_near_misses(queries: DataFrame, records: DataFrame) -> DataFrame:
    """(qid, rid, kind) of streamed keyed records that look like one of the queries. The record's keys stay with its row, so each
    micro-batch is one stream-static join; a pair that meets on several keys comes out once for each, to be made distinct at the sink."""
    q = search_keys(queries).withColumnRenamed("id", "qid").join(side(queries, "a"), F.col("qid") == a("id")).drop("qid")
    r = side(records.withColumn("key", F.explode(key_list())), "b")
    pairs = r.join(q, b("key") == F.col("key")).where(a("id") != b("id")).where(G.twins() | ~G.looks_same())
    return pairs.withColumn("kind", G.near_miss_kind()).where("kind is not null").select(a("id").alias("qid"), b("id").alias("rid"), "kind")


def cap_per_group(events: DataFrame, group: str, key: str, cap: int, seed: int = 0) -> DataFrame:
    """The ``cap`` rows of each group with the smallest hashes, over a stream: the state holds those rows and the number seen. Each trigger
    gives the new state of the groups that it touched (group, key, rank, seen)."""
    schema = events.schema
    kinds = schema[group].dataType.simpleString(), schema[key].dataType.simpleString()

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, kept = state.get if state.exists else (0, "")
        rows = dict(x.split("\t", 1)[::-1] for x in kept.split("\n") if x)
        for pdf in batches:
            seen += len(pdf)
            for h, v in zip(pdf["_h"], pdf[key]):
                rows[str(v)] = h
            rows = dict(sorted(rows.items(), key=lambda kv: (kv[1], kv[0]))[:cap])
        state.update((seen, "\n".join(f"{h}\t{v}" for v, h in rows.items())))
        yield pd.DataFrame({group: k[0], key: pd.Series(list(rows)).astype("int64" if kinds[1] in ("bigint", "int") else "object"), "rank": range(1, len(rows) + 1), "seen": seen})

    hashed = events.select(group, key, N.digest(seed, "cap", F.col(key)).alias("_h"))
    return hashed.groupBy(group).applyInPandasWithState(run, f"{group} {kinds[0]}, {key} {kinds[1]}, rank long, seen long", "seen long, kept string", "update", GroupStateTimeout.NoTimeout)
