"""Mixing sources to target weights along a training run whose weights change with time.

Targets: all words are shared out by weight; a source takes ``MAX_REPEATS`` times its words at most, and what
it cannot take is shared out again by weight among the others, until none is above.

Within a source, documents stand in a fixed random order (md5 of the id).  They are taken round after round
until the target is met; the last round stops inside a document where the target ends.

Time: a source's weight schedule is linear from ``first`` to ``last``.  Its integral, scaled to the target, is
the source's cumulative demand; a document gets the time t in [0, 1] at which the demand reaches the word it
starts with, and documents are range-sorted by it.

A null text has size 0; documents of size 0 are never taken and stand at their place in the order.  A null
source is a source of its own.  Repeated rows are documents of their own.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealmill.llm.common import WORD, row_key, stored, whole_text

# Fixed value: weights of the sources in their order, repeating.
WEIGHTS = [1, 2, 3]
MAX_REPEATS = 3
# Schedules by place in the order of sources, repeating: relative weight at the start and at the end.
SCHEDULES = [(1.5, 0.5), (1.0, 1.0), (0.5, 1.5)]
ROWS_PER_PART = 5_000


def _by_rank(values: list, rank: str):
    return F.element_at(F.array(*map(F.lit, values)), (F.col(rank) % len(values) + 1).cast("int"))


def targets(sized: DataFrame, weights: list[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, n_docs, target, first, last), one row per source.

    Only this table of one row per source is ordered as a whole; its size is the number of sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", _by_rank(weights, "rank")).withColumn("cap", max_repeats * F.col("source_size"))
    # Sources reach their cap in the order of cap / weight; ``level`` is the share of weight 1 once those before have.
    # (cap, weight) is compared as a fraction of whole numbers, rank breaks ties.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("taken_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    )
    level = (F.col("total") - F.col("taken_before")).cast("double") / F.col("weight_left").cast("double")
    ranked = ranked.withColumn("level", level)
    # The first source that its level does not fill sets the level of all after it.
    free = F.col("weight") * F.col("level") <= F.col("cap")
    ranked = ranked.withColumn("common", F.first(F.when(free, F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.col("weight") * F.col("common"), F.col("cap").cast("double"))
    first, last = ([s[i] for s in SCHEDULES] for i in (0, 1))
    return ranked.select(
        "source", "source_size", "n_docs", target.alias("target"), _by_rank(first, "rank").alias("first"), _by_rank(last, "rank").alias("last")
    )


def _time_of(offset, target, first, last):
    """The t at which the integral of the schedule, scaled to ``target``, reaches ``offset``."""
    # first * t + (last - first) * t^2 / 2 = y, where y is the share of the target times the mean weight
    share = F.least(offset.cast("double") / target, F.lit(1.0)) * (first + last) / F.lit(2.0)
    root = F.sqrt(first * first + F.lit(2.0) * (last - first) * share)
    return F.when(target > 0, F.lit(2.0) * share / (first + root))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken, position, start, first, last) of every row, range-sorted by position.

    ``position`` is the time of the document's first word; null where the source has no words.
    """
    sized = stored(
        df.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            F.regexp_count(whole_text(text), F.lit(WORD)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("draw"),
        )
    )
    # Cumulative sizes in two steps: parts of a source by its random order, then within a part.
    n_parts = max(1, sized.count() // ROWS_PER_PART)
    part = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / 2.0**32 * n_parts).cast("long")
    sized = sized.withColumn("part", part)
    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    of = targets(sized).drop("n_docs")
    parts = parts.join(of, parts["source"].eqNullSafe(of["source"])).select(
        parts["source"].alias("s"), F.col("part").alias("p"), "part_start", "source_size", "target", "first", "last"
    )
    placed = sized.join(parts, sized["source"].eqNullSafe(parts["s"]) & (sized["part"] == parts["p"]))
    within = Window.partitionBy("source", "part").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("part_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    placed = placed.withColumn("start", start)
    words = F.round("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), words - rounds * F.col("source_size") - F.col("start")))
    mixed = placed.select(
        "doc_id", "size", "source", "source_size", "target",
        (rounds * F.col("size") + rest).cast("long").alias("taken"),
        _time_of(F.col("start"), F.col("target"), F.col("first"), F.col("last")).alias("position"),
        "start", "first", "last",
    )
    return mixed.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id"
    )


def mixed_documents(df: DataFrame) -> DataFrame:
    """The documents of ``df`` that the mix takes, each as often as it is begun, in training order.

    A document cut by the end of the last round is given whole.  Rows are known by a hash of all columns, so a
    null or repeated id loses or multiplies nothing; rows that agree in every column are taken one by one.
    """
    keyed = df.withColumn("__key", row_key(df))
    plan = mix(keyed, doc_id="__key").where("taken > 0").withColumn("__copy", F.explode(F.expr("sequence(0, cast(ceil(taken / size) as int) - 1)")))
    offset = F.col("start") + F.col("__copy") * F.col("source_size")
    at = _time_of(offset, F.col("target"), F.col("first"), F.col("last"))
    places = plan.select(F.col("doc_id").alias("__key"), "__copy", at.alias("__at"))
    rows = keyed.dropDuplicates(["__key"]).join(places, "__key")
    return rows.repartitionByRange("__at", "__key", "__copy").sortWithinPartitions("__at", "__key", "__copy").select(*df.columns)
