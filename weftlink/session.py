"""Session helpers: table reads and cutting of lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_weftlink_shipped", None) is None:
        root = Path(__file__).resolve().parent
        sc._weftlink_shipped = shutil.make_archive(os.path.join(tempfile.mkdtemp(), root.name), "zip", root.parent, root.name)
        sc.addPyFile(sc._weftlink_shipped)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; set a temporary one only where none is set and the session is
    a single local JVM (as in tests). A cluster without the setting is an error, never a machine-local folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), f"weftlink-checkpoint-{os.getuid()}")
    sc.setCheckpointDir(configured)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, where all executors can write and read."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared checkpoint folder and go on from there, so that a lost executor costs no recomputation
    of what lies before and rows that depend on a physical order keep it."""
    ship(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As ``cut``, in columns: for many narrow rows, of which a checkpoint would take several times the bytes."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def released(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, and the shuffles that it took are removed once the rows are written: for work that is done in turns, each of which
    would else leave its shuffles on disk until the driver happens to collect its garbage."""
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return stored(df, name)


def in_turn(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of the parts, of which each is planned and written (``cut``) before the next is made: for long expressions, of which the driver
    then holds one part's, drops it before the next, and compiles none, since the executors compile what they run themselves."""
    written = []
    for part in parts:
        with setting(part.sparkSession, "spark.sql.codegen.wholeStage", "false"):
            written.append(cut(part))
        part.sparkSession.sparkContext._jvm.System.gc()
    return reduce(DataFrame.unionByName, written)


def apart(df: DataFrame) -> DataFrame:
    """The same rows behind a generator of one row: conditions and projections above are neither written into the expressions below nor
    repeated for each part of a union."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def by_sort(df: DataFrame) -> DataFrame:
    """A side of a join that is never sent whole to every executor: what is derived from few compressed columns, or written out from them
    by ``explode``, is guessed far too small, and a guess under the planner's threshold would bring the table to the driver."""
    return df.hint("merge")


def tasks(spark: SparkSession) -> int:
    """Tasks for work that runs in Python: as many as the session shuffles into, at least two for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows (or whole keys) out to ``tasks`` partitions that adaptive execution doesn't merge again: small bytes can
    stand for much work where Python does it. A later aggregation on ``keys`` needs no further shuffle. A single table that
    fills that many file splits anyway isn't shuffled without keys, and with keys gets one partition per split size."""
    ship(df.sparkSession)  # Python comes next
    n, plan = tasks(df.sparkSession), df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if leaves.size() == 1 and leaves.apply(0).nodeName() == "LogicalRelation":  # elsewhere sizes are only guessed
        size, split = int(str(plan.stats().sizeInBytes())), df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        if size > n * split:
            if not keys:
                return df
            n = -(-size // split)
    return df.repartition(n, *keys)
