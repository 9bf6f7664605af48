"""Two kinds of duplicates: later versions of one record, and identical rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealmill.operators.lookup import LAZY, Spread, lookup, replicate
from dealmill.operators.rules import issue_columns


class Split(NamedTuple):
    kept: DataFrame
    issues: DataFrame


def latest_rows(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row per key in ``order``.

    ``row_number() = 1`` is cut down to one row per key before the shuffle (window group
    limit), so a key with very many rows reaches its task as one row per map task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def dedup_latest(
    df: DataFrame,
    key: str,
    version: str,
    version_text: str,
    entity: str,
    issue_type: str,
    row_id: str = "id",
    spread: Spread = LAZY,
    counted_in: DataFrame | None = None,
) -> Split:
    """Keep the row with the latest ``version`` per key (then the highest ``row_id``).

    Rows without a readable version lose to rows with one.  Every other row is logged as
    quarantined, naming its id, its version as written and the id of the row kept.
    """
    kept = latest_rows(df, key, [F.col(version).desc_nulls_last(), F.col(row_id).desc()])

    # A NULL key is one group too; give it a value of its own so that it can be joined.
    null_safe = F.concat_ws("", F.when(F.col(key).isNull(), "0").otherwise("1"), key)
    narrow = df.select(
        key,
        null_safe.alias("__key"),
        F.col(row_id).alias("__row"),
        F.col(version_text).alias("__written"),
        F.col(version).alias("__version"),
    )
    winners = (
        narrow.groupBy("__key")
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.max(F.struct("__version", "__row")).alias("__best"),  # NULL versions order first
        )
        .where(F.col("__rows") > 1)
        .select("__key", F.col("__best.__row").alias("__winner"))
    )
    counted = None if counted_in is None else counted_in.select(null_safe.alias("__key"))
    losers = lookup(
        narrow.drop("__version"), winners, "__key", "__row", "inner", spread, counted
    ).where(F.col("__row") != F.col("__winner"))
    details = (
        "concat('replaced row id=', __row, ' (updated_at=', coalesce(__written, 'NULL'), '); kept id=', __winner)"
    )
    issues = losers.selectExpr(*issue_columns(entity, key, issue_type, "quarantined", details))
    return Split(kept, issues)


def distinct_rows(df: DataFrame, columns: list[str], row_id: str = "id") -> DataFrame:
    """One row per distinct ``columns`` with its lowest ``row_id`` and the number of copies.

    Copies are counted before the shuffle, so a row repeated without bound stays one row per
    map task.
    """
    return df.groupBy(*columns).agg(F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("copies"))


def dedup_exact(
    df: DataFrame, columns: list[str], entity: str, entity_id: str, issue_type: str, row_id: str = "id"
) -> Split:
    """Keep the first of rows equal in ``columns``; log one issue per further copy."""
    groups = distinct_rows(df, columns, row_id)
    extra = replicate(groups.where(F.col("copies") > 1), F.col("copies") - 1)
    issues = extra.selectExpr(*issue_columns(entity, entity_id, issue_type, "quarantined", "'identical row'"))
    return Split(groups.drop("copies"), issues)
