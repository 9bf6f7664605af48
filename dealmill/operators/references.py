"""References between tables: resolve, null out or quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealmill.functions.normalize import is_blank
from dealmill.operators.dedup import Split
from dealmill.operators.lookup import LAZY, Spread, lookup
from dealmill.operators.rules import issue_columns
from dealmill.session import is_small


def mark_reference(
    df: DataFrame,
    column: str,
    parents: DataFrame,
    parent_key: str,
    hit: str,
    carry: dict[str, str] | None = None,
    spread_by: str = "id",
    spread: Spread = LAZY,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """``df`` with a boolean ``hit``: does ``parents`` hold the value of ``column``?

    Keys are compared exactly as written.  ``carry`` brings parent columns along under new
    names.  Parents are cut to one row per key first, so no row is ever multiplied.

    Where intermediate tables can be kept and nothing is carried, only the distinct values of
    ``column`` are checked against the parents.  The values without a parent are usually few:
    when their stored size allows a broadcast, the rows themselves are not shuffled at all.
    """
    carry = carry or {}
    keys = parents.where(F.col(parent_key).isNotNull()).select(
        F.col(parent_key).alias(column), *(F.col(source).alias(target) for source, target in carry.items())
    )
    if spread.keep and not carry and not is_small(keys):
        used = (df if counted_in is None else counted_in).select(column).where(F.col(column).isNotNull())
        missing = spread.keep(used.distinct().join(keys, column, "left_anti"))
        if is_small(missing):
            found = df.join(missing.withColumn(hit, F.lit(True)), column, "left")
            return found.withColumn(hit, F.col(column).isNotNull() & F.col(hit).isNull())
    if carry:
        keys = keys.groupBy(column).agg(*(F.max(target).alias(target) for target in carry.values()))
    else:
        keys = keys.distinct()
    found = lookup(df, keys.withColumn(hit, F.lit(True)), column, spread_by, "left", spread, counted_in)
    return found.withColumn(hit, F.coalesce(F.col(hit), F.lit(False)))


def resolved(column: str, hit: str) -> str:
    """The reference where its parent exists, else NULL."""
    return f"if({hit}, {column}, null)"


def is_broken(column: str, hit: str) -> str:
    """A reference is written but its parent does not exist."""
    return f"not {is_blank(column)} and not {hit}"


def resolve_fk(
    df: DataFrame,
    column: str,
    parents: DataFrame,
    parent_key: str,
    entity: str,
    entity_id: str,
    issue_type: str | None = None,
    spread_by: str = "id",
    spread: Spread = LAZY,
) -> tuple[DataFrame, DataFrame | None]:
    """Keep every row; a reference without parent becomes NULL and, if typed, is logged."""
    marked = mark_reference(
        df, column, parents, parent_key, "__hit", spread_by=spread_by, spread=spread
    )
    out = marked.withColumn(column, F.expr(resolved(column, "__hit"))).drop("__hit")
    if issue_type is None:
        return out, None
    issues = marked.where(is_broken(column, "__hit")).selectExpr(
        *issue_columns(entity, entity_id, issue_type, "flagged", column)
    )
    return out, issues


def quarantine_orphans(
    df: DataFrame,
    column: str,
    parents: DataFrame,
    parent_key: str,
    entity: str,
    entity_id: str,
    issue_type: str,
    spread_by: str = "id",
    spread: Spread = LAZY,
) -> Split:
    """Rows whose parent exists, and one issue per row dropped; a NULL reference is dropped."""
    marked = mark_reference(
        df, column, parents, parent_key, "__hit", spread_by=spread_by, spread=spread
    )
    kept = marked.where(F.col("__hit")).drop("__hit")
    issues = marked.where(~F.col("__hit")).selectExpr(
        *issue_columns(entity, entity_id, issue_type, "quarantined", column)
    )
    return Split(kept, issues)


def mark_canonical(
    df: DataFrame, pk: str, business_key: str, target: str = "canonical_id", spread: Spread = LAZY
) -> DataFrame:
    """``df`` with the lowest ``pk`` of the rows sharing its business key, NULL on that row itself.

    The lowest key is found by a grouped minimum over shared keys only and looked up again,
    so rows of one business key are never gathered in a task.
    """
    shared = (
        df.where(F.col(business_key).isNotNull())
        .groupBy(business_key)
        .agg(F.min(pk).alias(target), F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > 1)
        .drop("__rows")
    )
    found = lookup(df, shared, business_key, pk, "left", spread)
    return found.withColumn(target, F.when(F.col(pk) != F.col(target), F.col(target)))


def resolve_canonical(
    df: DataFrame, pk: str, business_key: str, entity: str = "product", spread: Spread = LAZY
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``canonical_id``, duplicate_sku issues); duplicates stay in the table."""
    out = mark_canonical(df, pk, business_key, spread=spread)
    issues = out.where(F.col("canonical_id").isNotNull()).selectExpr(
        *issue_columns(
            entity, pk, "duplicate_sku", "flagged", f"concat('SKU ', {business_key}, ' repeats ', canonical_id)"
        )
    )
    return out, issues


def flag_before_parent(
    child: DataFrame,
    parents: DataFrame,
    key: str,
    child_time: str,
    parent_time: str,
    entity: str,
    entity_id: str,
    issue_type: str = "temporal_inconsistency",
    spread_by: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``has_quality_issue``, issues) where the child is older than its parent."""
    marked = mark_reference(
        child, key, parents, key, "__hit", {parent_time: "__parent_time"}, spread_by=spread_by
    )
    early = F.coalesce(F.col(child_time) < F.col("__parent_time"), F.lit(False))
    out = marked.withColumn("has_quality_issue", early).drop("__hit", "__parent_time")
    issues = marked.where(early).selectExpr(
        *issue_columns(
            entity, entity_id, issue_type, "flagged",
            f"concat(to_date({child_time}), ' before ', to_date(__parent_time))",
        )
    )
    return out, issues
