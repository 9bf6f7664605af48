"""Session settings the jobs rely on, and the size and checkpoint questions they ask it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so that they can be applied to a session someone else made.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",  # report dates are UTC dates; cells carry their own offset
    "spark.sql.ansi.enabled": "true",  # an amount too large for its column is an error
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partitions this small are joined by a hash table of the parents: children are not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # The issue log is counted and written from the same shuffled rows.
    "spark.sql.exchange.reuse": "true",
    # The JVM does not compile methods above 8000 bytes: such a stage runs faster step by step than as one method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Delete the shuffle files of a query when it ends; else they stay until the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Every query run inside leaves no shuffle files behind.  For steps that run many and none of them twice."""
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


# Jobs that a step which writes many tables has running at a time.
JOBS_AT_ONCE = 6


def at_once(job: Callable[[str], object], names: Iterable[str]) -> None:
    """``job`` for each name, some at a time: small jobs and the last tasks of large ones leave no cores idle.

    All jobs that were begun have ended when this returns or raises the first error.
    """
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(job), name) for name in names]
        try:
            for each in running:
                each.result()
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; where none is set (tests), a folder of the warehouse.

    On a cluster a warehouse on the driver's own disk is no shared folder; that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        on_local_disk = "://" not in warehouse.removeprefix("file://")
        if on_local_disk and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"{warehouse}/_work"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def estimated_bytes(df: DataFrame) -> int | None:
    """Upper estimate of the optimised plan's output; None where no plan is at hand."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def broadcast_limit(spark: SparkSession) -> int:
    """Largest table, in bytes, that Spark itself broadcasts for a join."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def is_small(df: DataFrame) -> bool:
    """True when Spark will broadcast ``df`` on its own, judged by its size estimate."""
    size = estimated_bytes(df)
    return size is not None and size <= broadcast_limit(df.sparkSession)
