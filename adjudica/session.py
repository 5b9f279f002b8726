"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("adjudica")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own: dict[str, str] = {}  # folder of a local session that names none


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error rather than a machine-local folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or _own.get(context.applicationId)
    if configured is None:
        configured = context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="adjudica-"))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


T = TypeVar("T")


def side_by_side(spark: SparkSession, jobs: list[Callable[[], T]]) -> list[T]:
    """Submit a few independent Spark jobs at once, results in order.

    Only whole jobs run here, a handful per call; the rows stay in Spark.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go with each write, rather than when the
    driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are fixed and survive losing executors."""
    work_dir(df.sparkSession)
    return df.checkpoint()
