"""Keyed lookups (many rows to one row per key) that hold when one key has most of the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealmill.session import is_small

ROWS_PER_TASK = 2_000_000

_SALT = "__salt"


@dataclass(frozen=True)
class Spread:
    """How large lookups are laid out.

    ``keep`` stores an intermediate table and gives it back (see ``WorkArea``); with it, every key with
    more than ``rows_per_task`` rows is known before the large join is planned and is cut into parts.
    Without it everything stays one lazy plan, and skew is left to the adaptive skew join.
    """

    rows_per_task: int = ROWS_PER_TASK
    keep: Callable[[DataFrame], DataFrame] | None = None


LAZY = Spread()


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, splits) of every key with more than ``rows_per_task`` rows, counted exactly.

    Reads the key column alone; each map task sends one count per key it holds.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where(F.col("__n") > rows_per_task).select(
        key, F.ceil(F.col("__n") / F.lit(rows_per_task)).cast("int").alias("__splits")
    )


def lookup(
    rows: DataFrame,
    parents: DataFrame,
    key: str,
    spread_by: str,
    how: str = "left",
    spread: Spread = LAZY,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to the one row of ``parents`` with the same ``key``.

    ``parents`` must hold each key once.  A small parent is broadcast by Spark.  Otherwise both
    sides are shuffled by key.  Where tables can be kept, hot keys are cut into parts: each row of a hot
    key goes to one part, chosen by ``spread_by`` (a column that tells rows apart), and the parent row is
    repeated once per part.  Rows without a key match nothing and are spread the same way.  The list of
    hot keys is broadcast when Spark finds its stored size within the limit, else joined by a shuffle.

    Hot keys are counted in ``counted_in`` (default ``rows``): name the stored table the rows
    come from, so that earlier steps are not run again for the count.
    """
    if is_small(parents) or not spread.keep:
        return rows.join(parents, key, how)

    hot = spread.keep(hot_keys(rows if counted_in is None else counted_in, key, spread.rows_per_task))
    cold = hot.isEmpty()

    def with_splits(df: DataFrame) -> DataFrame:
        if cold:
            return df.withColumn("__splits", F.lit(1))
        return df.join(hot, key, "left").withColumn("__splits", F.coalesce("__splits", F.lit(1)))

    part = F.xxhash64(F.col(spread_by))
    salt = F.when(F.col(key).isNull(), F.pmod(part, F.lit(1_000_000))).otherwise(F.pmod(part, F.col("__splits")))
    salted_rows = with_splits(rows).withColumn(_SALT, salt.cast("int")).drop("__splits")
    salted_parents = (
        with_splits(parents)
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col("__splits") - 1)))
        .drop("__splits")
    )
    return salted_rows.join(salted_parents, [key, _SALT], how).drop(_SALT)


def replicate(df: DataFrame, times: Column, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each row ``times`` times (none when it is 0), the copies of one row spread over tasks."""
    chunks = df.withColumn("__times", times.cast("long")).where(F.col("__times") > 0)
    chunks = chunks.withColumn(
        "__start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1, F.lit(rows_per_task).cast("long")))
    )
    chunks = chunks.repartition(*(F.col(f"`{c}`") for c in chunks.columns))
    size = F.least(F.lit(rows_per_task).cast("long"), F.col("__times") - F.col("__start"))
    copies = chunks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return copies.drop("__times", "__start", "__copy")
