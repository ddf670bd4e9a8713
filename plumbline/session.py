"""What a session needs: Python workers that find this package, a folder that all executors share, tables cut from their plans."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_FOLDERS: dict[str, str] = {}
_SCRATCH = threading.local()


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, paths) if p)
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the cores if it is too small for Spark to split it; a larger table stays as it is, with no shuffle."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * split else df


# ---------------------------------------------------------------- the shared folder
def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one named in spark.checkpoint.dir, or this thread's scratch folder in it.

    Where that is unset a local master gets a temporary folder of its machine; on a cluster that is
    an error, as executors could not read each other's files.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _FOLDERS:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            named = sc.getConf().get("spark.checkpoint.dir")
            if not named and not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="plumbline-"))
        _FOLDERS[sc.applicationId] = folder = f"{sc._jsc.sc().getCheckpointDir().get()}/plumbline-{sc.applicationId}"
        atexit.register(_remove_at_exit, spark, folder)
    return getattr(_SCRATCH, "folder", None) or _FOLDERS[sc.applicationId]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What this thread cuts inside goes to a folder that is deleted at the end; a ``Cut`` made before keeps its place."""
    before = getattr(_SCRATCH, "folder", None)
    _SCRATCH.folder = folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    try:
        yield
    finally:
        _SCRATCH.folder = before
        remove(spark, folder)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, folder)
    except Exception:  # noqa: BLE001, S110  the session has ended, and a folder that stays does no harm
        pass


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Cut:
    """Tables written to the shared folder and read back.

    That ends their lineage (a lost executor costs no more than one table's tasks), and their size is
    that of their files, where the estimate of a checkpoint grows with each join before it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.held = spark, shared_folder(spark), []

    def __call__(self, df: DataFrame) -> DataFrame:
        folder = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        self.held.append(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def drop(self, keep: int = 0) -> None:
        """Deletes all but the last ``keep`` tables; what was read from them must be done with."""
        old = self.held[: len(self.held) - keep]
        self.held = self.held[len(self.held) - keep :]
        for folder in old:
            remove(self.spark, folder)


# ---------------------------------------------------------------- large groups
def running(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column], cut: Cut) -> DataFrame:
    """``df`` with the running sums ``totals`` of each group of ``keys`` in ``order``, rows up to and with their own.

    Rows are dealt by ranges of keys and order, so a group of any size is shared by many tasks: each
    sums its block of rows, and the sums of a group's earlier blocks (a row for each block) are added.
    Null keys are a group; rows equal in keys and order should be alike in the sums too.
    """
    names = [f"_t{i}" for i in range(len(totals))]
    tie = F.monotonically_increasing_id().alias("_tie")  # rows that repeat are dealt too
    rows = df.withColumns(dict(zip(names, totals.values(), strict=True))).select("*", tie)
    laid = cut(rows.repartitionByRange(partitions(df.sparkSession), *keys, *order, "_tie").withColumn("_block", F.spark_partition_id()))
    here = Window.partitionBy(*keys, "_block").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = laid.groupBy(*keys, "_block").agg(*[F.sum(n).alias(n) for n in names])
    blocks = blocks.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b"), *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}b") for n in names])
    same = (F.col("_block") == F.col("_b"))
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = laid.withColumns({n: F.sum(n).over(here) for n in names}).join(blocks, same)
    return out.withColumns({t: F.col(n) + F.col(f"{n}b") for t, n in zip(totals, names, strict=True)}).select(*df.columns, *totals)
