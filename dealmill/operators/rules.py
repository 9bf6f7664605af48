"""Row rules, the issue log they feed and the row flag that follows from it.

Rules are SQL expressions over the columns of one table, so that all rules of a table are
evaluated in the projection that also types its columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealmill.functions.normalize import quoted
from dealmill.schemas import ISSUE_SCHEMA, TRANSITIONS
from dealmill.sources.records import sum_before

# Re-spelling a channel is cosmetic: logged, but the row itself is not marked.
COSMETIC = {"normalized_source"}


@dataclass(frozen=True)
class Rule:
    """One check of one row; ``details`` must come from values that are set when it fires."""

    issue_type: str
    action: str
    when: str
    details: str = "null"


def issue_columns(entity: str, entity_id: str, issue_type: str, action: str, details: str = "null") -> list[str]:
    """The five issue columns, in log order, as SQL; the two ids and texts are expressions."""
    return [
        f"'{entity}' as entity",
        f"cast({entity_id} as string) as entity_id",
        f"'{issue_type}' as issue_type",
        f"'{action}' as action",
        f"cast({details} as string) as details",
    ]


def issues_of(entity: str, entity_id: str, rules: list[Rule]) -> str:
    """Array of the issues one row raises, found in the same scan as the row itself.

    NULL for a row without issues; otherwise one entry per rule, NULL where it did not fire.
    (Squeezing the NULLs out here would need a lambda, which is not code-generated.)
    """
    if not rules:
        return f"cast(null as array<{ISSUE_SCHEMA.simpleString()}>)"
    structs = (
        f"if({r.when}, struct({', '.join(issue_columns(entity, entity_id, r.issue_type, r.action, r.details))}), null)"
        for r in rules
    )
    return f"if({' or '.join(r.when for r in rules)}, array({', '.join(structs)}), null)"


def fired(rules: list[Rule]) -> str:
    """Array of the positions (from 1 on) of the rules a row breaks; NULL for a row without issues.

    One entry per rule, NULL where it did not fire.  Type, reaction and text follow from the position, so that a query
    that only counts issues carries no text through the joins.
    """
    if not rules:
        return "cast(null as array<int>)"
    positions = (f"if({r.when}, {i}, null)" for i, r in enumerate(rules, start=1))
    return f"if({' or '.join(r.when for r in rules)}, array({', '.join(positions)}), null)"


def detail_columns(rules: list[Rule]) -> dict[str, str]:
    """One text column per rule that has details, NULL where the rule did not fire."""
    return {
        f"_detail{i}": f"cast(if({r.when}, {r.details}, null) as string)"
        for i, r in enumerate(rules, start=1) if r.details != "null"
    }


def explode_fired(df: DataFrame, entity: str, entity_id: str, rules: list[Rule]) -> DataFrame:
    """One row per issue from rows with ``_issues`` as ``fired`` gives it and their ``detail_columns``."""
    if not rules:
        return df.where("false").selectExpr(*issue_columns(entity, entity_id, "", ""))
    details = detail_columns(rules)
    each = df.select(F.expr(f"cast({entity_id} as string)").alias("entity_id"), *details, F.explode_outer("_issues").alias("rule"))
    texts = " ".join(f"when {name.removeprefix('_detail')} then {name}" for name in details)
    return each.where("rule is not null").selectExpr(
        f"'{entity}' as entity",
        "entity_id",
        f"element_at(array({quoted(r.issue_type for r in rules)}), rule) as issue_type",
        f"element_at(array({quoted(r.action for r in rules)}), rule) as action",
        f"case rule {texts} end as details" if texts else "cast(null as string) as details",
    )


def has_quality_issue(rules: list[Rule]) -> str:
    """True when any rule fires that is not merely cosmetic."""
    checks = [f"coalesce({r.when}, false)" for r in rules if r.issue_type not in COSMETIC]
    return " or ".join(checks) or "false"


def explode_issues(df: DataFrame, column: str = "_issues") -> DataFrame:
    """One row per issue from rows that carry an array of them.

    The outer form keeps the optimiser from testing the array ahead of the explosion, which would
    evaluate every rule a second time.
    """
    return df.select(F.explode_outer(column).alias("issue")).where("issue is not null").select("issue.*")


def apply_rules(
    df: DataFrame, entity: str, entity_id: str, rules: list[Rule]
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``has_quality_issue``, issues)."""
    flagged = df.selectExpr("*", f"{has_quality_issue(rules)} as has_quality_issue")
    issues = explode_issues(df.selectExpr(f"{issues_of(entity, entity_id, rules)} as _issues"))
    return flagged, issues


def is_illegal_transition(old: str, new: str) -> str:
    """True when both stages are set and the step between them is not one of the allowed.

    A first entry (no old stage) is no transition; staying in a stage is not allowed; from a
    stage outside the map nothing is allowed.
    """
    return f"concat({old}, '>', {new}) not in ({quoted(f'{a}>{b}' for a, b in TRANSITIONS)})"


def flag_illegal_transitions(
    history: DataFrame, old: str = "old_stage_id", new: str = "new_stage_id", entity_id: str = "event_id"
) -> tuple[DataFrame, DataFrame]:
    """(history with ``has_quality_issue``, illegal_transition issues)."""
    rule = Rule(
        "illegal_transition", "flagged", is_illegal_transition(old, new), f"concat({old}, ' -> ', {new})"
    )
    return apply_rules(history, "stage_history", entity_id, [rule])


_LOG_ORDER = ["entity", "entity_id", "issue_type", "action", "details"]


def issue_log(frames: list[DataFrame], keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All issues in one table with an id and the time of detection.

    With ``keep``, which stores a table and reads it back, ids are those of ``numbered_log``.  Without it they are
    only unique.
    """
    if keep is not None:
        return keep(numbered_log(frames))
    union = reduce(DataFrame.unionByName, frames).select(*_LOG_ORDER)
    return union.select(F.monotonically_increasing_id().alias("id"), *_LOG_ORDER, F.current_timestamp().alias("detected_at"))


def numbered_log(frames: list[DataFrame], parts: int = 8) -> DataFrame:
    """All issues in one table with ids from 1 on and the time of detection, in ``parts`` tasks in the order of ids.

    Ids follow the order of entity, entity_id, type, reaction and details, so that every load of the same input gives
    the same ids.  The log is shuffled into ranges once: the same shuffled rows are counted per range and, sorted,
    numbered by the rows of the ranges before.  Equal issues may stand in any order and in any task.

    ``frames`` should read stored tables.  Should a range hold other rows than were counted, the job stops with an error.
    """
    union = reduce(DataFrame.unionByName, frames).select(*_LOG_ORDER)
    spread = union.withColumn("__spread", F.monotonically_increasing_id())
    ranges = spread.repartitionByRange(parts, *_LOG_ORDER, "__spread")
    counts = ranges.groupBy(F.spark_partition_id().alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = counts.withColumn("__before", sum_before("__rows", [], ["__part"]))
    rows = ranges.sortWithinPartitions(*_LOG_ORDER).select(
        *_LOG_ORDER, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__seq")
    )
    # One row per task; the broadcast leaves the sorted rows where they are.
    joined = rows.join(F.broadcast(before), "__part", "left")
    # Spark numbers the rows of task p from p * 2 ** 33 on.
    place = F.expr("__seq - shiftleft(cast(__part as bigint), 33)")
    sound = F.coalesce(place < F.col("__rows"), F.lit(False))
    changed = F.raise_error(F.lit("the log changed while it was numbered"))
    number = F.when(sound, F.col("__before") + place + 1).otherwise(changed.cast("long"))
    return joined.select(number.alias("id"), *_LOG_ORDER, F.current_timestamp().alias("detected_at"))
