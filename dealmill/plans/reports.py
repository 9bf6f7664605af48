"""Management reports over the typed tables.

Every report takes the dictionary of typed tables and returns a lazy DataFrame.  Detail rows
are summed per key before any join, so joins meet one row per key on both sides.  Money in
reports is ``decimal(28,2)``: rounded like the stored amounts, wide enough for their sums.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealmill.operators.constraints import count_by_action, issue_counts
from dealmill.operators.lookup import LAZY, Spread, lookup
from dealmill.schemas import ACTIONS, CLOSING_STAGES, COMMITTED_STAGES, FACT_DATES

Tables = Mapping[str, DataFrame]

SUM_TYPE = "decimal(28,2)"
DEFAULT_DELAY_DAYS = 5
DEFAULT_STALE_DAYS = 14
MAX_STALE_DAYS = 3650
NO_STAGE = "Без стадии"  # fixed value: label of deals without a known stage
NO_STAGE_ORDER = 999


def _money(amount: Column) -> Column:
    return amount.cast(SUM_TYPE)


def _sum_or_zero(amount: Column) -> Column:
    return _money(F.coalesce(F.sum(amount), F.lit(0)))


def _won() -> Column:
    return F.col("stage_id") == "WON"


# ---------------------------------------------------------------- shared parts


def deal_lines(core: Tables, spread: Spread = LAZY) -> DataFrame:
    """Revenue and cost per deal with at least one line."""
    lines = core["deal_products"].select("id", "deal_id", "product_id", "quantity", "unit_price", "discount")
    costs = core["products"].select("product_id", "cost_price")
    priced = lookup(lines, costs, "product_id", "id", "inner", spread)
    return priced.groupBy("deal_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price") - F.col("discount")).alias("revenue"),
        F.sum(F.col("quantity") * F.col("cost_price")).alias("cost"),
    )


def deal_amount(core: Tables) -> DataFrame:
    """Each deal with its amount: the sum of its lines, else the estimate on its card.

    The margin is known only where there are lines.
    """
    deals = core["deals"].select("deal_id", "stage_id", "manager_id", "source_id", "expected_amount")
    both = deals.join(deal_lines(core), "deal_id", "left")
    return both.select(
        "deal_id", "stage_id", "manager_id", "source_id", "expected_amount",
        _money(F.col("revenue")).alias("line_revenue"),
        _money(F.col("revenue") - F.col("cost")).alias("line_margin"),
        _money(F.coalesce("revenue", "expected_amount")).alias("amount"),
    )


def _latest(df: DataFrame, column: str) -> Column:
    return df.agg(F.to_date(F.max(column))).scalar()


def cutoff_date(core: Tables) -> DataFrame:
    """One row: the latest day on which anything actually happened (plans do not count).

    Each table is reduced to one date by its own scalar subquery.
    """
    (table, column), *others = FACT_DATES
    latest = core[table].agg(F.to_date(F.max(column)).alias("first"))
    return latest.select(F.greatest("first", *(_latest(core[t], c) for t, c in others)).alias("cutoff_date"))


def totals(report: DataFrame, columns: list[str]) -> DataFrame:
    """One row of column sums; NULLs are skipped and an empty report sums to zero."""
    types = dict(report.dtypes)
    sums = []
    for name in columns:
        value = F.coalesce(F.sum(name), F.lit(0))
        kind = SUM_TYPE if types[name].startswith("decimal") else "long"
        sums.append(value.cast(kind).alias(name))
    return report.agg(*sums)


# ---------------------------------------------------------------- 1 funnel


def funnel(core: Tables) -> DataFrame:
    """Deals and amount per stage in selling order; deals without a stage form a last row."""
    per_stage = (
        deal_amount(core)
        .groupBy("stage_id")
        .agg(F.count(F.lit(1)).alias("deals"), _sum_or_zero(F.col("amount")).alias("amount"))
    )
    stages = core["pipeline_stages"].select("sort_order", "stage_id", "stage_name", "is_success")
    # A full join keeps the group without a stage; it is the only one that may lack a stage row.
    both = stages.withColumn("known", F.lit(True)).join(per_stage, "stage_id", "full")
    both = both.where(F.col("known").isNotNull() | F.col("stage_id").isNull())
    return both.select(
        F.when(F.col("known"), F.col("sort_order")).otherwise(F.lit(NO_STAGE_ORDER)).alias("sort_order"), "stage_id",
        F.when(F.col("known"), F.col("stage_name")).otherwise(F.lit(NO_STAGE)).alias("stage_name"), "is_success",
        F.coalesce("deals", F.lit(0)).cast("long").alias("deals"),
        _money(F.coalesce("amount", F.lit(0))).alias("amount"),
    ).orderBy(F.col("sort_order").asc_nulls_last(), "stage_id")


def funnel_totals(core: Tables) -> DataFrame:
    return totals(funnel(core), ["deals", "amount"])


# ---------------------------------------------------------------- 2 managers


def managers(core: Tables) -> DataFrame:
    """Won sales and margin of every sales manager, also of those without any."""
    won = (
        deal_amount(core)
        .where(_won())
        .groupBy(F.col("manager_id").alias("user_id"))
        .agg(
            F.count(F.lit(1)).alias("won_deals"),
            F.sum("amount").alias("revenue"),
            F.sum("line_margin").alias("margin"),
            F.count_if(F.col("line_margin").isNull()).alias("won_without_margin"),
        )
    )
    staff = core["users"].where(F.col("role") == "sales_manager").select("user_id", "name", "active")
    return (
        staff.join(won, "user_id", "left")
        .select(
            "user_id", "name", "active",
            F.coalesce("won_deals", F.lit(0)).cast("long").alias("won_deals"),
            _money(F.coalesce("revenue", F.lit(0))).alias("revenue"),
            _money(F.col("margin")).alias("margin"),
            F.coalesce("won_without_margin", F.lit(0)).cast("long").alias("won_without_margin"),
        )
        .orderBy(F.col("revenue").desc(), "user_id")
    )


def shipped_not_closed(core: Tables) -> DataFrame:
    """Deals shipped but not yet won, with the name of their manager."""
    shipped = deal_amount(core).where(F.col("stage_id") == "SHIPPED")
    names = core["users"].select(F.col("user_id").alias("manager_id"), F.col("name").alias("manager_name"))
    return (
        lookup(shipped, names, "manager_id", "deal_id")
        .select("deal_id", "manager_id", "manager_name", "amount", F.col("line_margin").alias("margin"))
        .orderBy("deal_id")
    )


# ---------------------------------------------------------------- 3 receivables


def payments_per_deal(core: Tables) -> DataFrame:
    """Paid, pending and correcting payments per deal; a payment may count as both of the latter."""
    kind, status, amount = F.col("payment_type"), F.col("status"), F.col("amount")
    return core["payments"].groupBy("deal_id").agg(
        F.sum(F.when((status == "paid") & kind.isin("prepayment", "full"), amount)).alias("paid"),
        F.sum(F.when(status == "pending", amount)).alias("pending"),
        F.sum(F.when(kind == "correction", amount)).alias("correction"),
    )


def receivables(core: Tables) -> DataFrame:
    """What is still owed per committed deal or deal with payments; lost deals are left out."""
    paid = payments_per_deal(core).withColumn("has_payments", F.lit(True))
    both = deal_amount(core).join(paid, "deal_id", "left")
    owed = both.where(
        ~F.col("stage_id").eqNullSafe("LOST")
        & (F.col("stage_id").isin(COMMITTED_STAGES) | F.col("has_payments").isNotNull())
    )
    zero = F.lit(0)
    return owed.select(
        "deal_id", "stage_id", "amount",
        _money(F.coalesce("paid", zero)).alias("paid"),
        _money(F.coalesce("pending", zero)).alias("pending"),
        _money(F.coalesce("correction", zero)).alias("correction"),
        _money(F.col("amount") - F.coalesce("paid", zero) + F.coalesce("correction", zero)).alias("balance"),
    ).orderBy(F.col("balance").desc_nulls_first(), "deal_id")


RECEIVABLE_SUMS = ["amount", "paid", "pending", "correction", "balance"]


def receivables_totals(core: Tables) -> DataFrame:
    return totals(receivables(core), RECEIVABLE_SUMS)


def overpaid(core: Tables) -> DataFrame:
    """Receivables with a mark on deals paid beyond their amount."""
    return receivables(core).withColumn("overpaid", F.coalesce(F.col("balance") < 0, F.lit(False)))


# ---------------------------------------------------------------- 4 production delays


def production_delays(core: Tables, threshold_days: int = DEFAULT_DELAY_DAYS) -> DataFrame:
    """Orders finished, or still open at the cutoff, more than ``threshold_days`` after plan."""
    done = F.coalesce("actual_finish_at", cutoff_date(core).scalar())
    counted = core["production_orders"].withColumn("__days", F.date_diff(done, F.col("planned_finish_at")))
    # A filter on a date would be moved below its cleaning, the whole of which is then written out in it many times over; the
    # optimiser leaves one on what was exploded in place.  Orders without a plan have no delay.
    late = F.explode_outer(F.array(F.when(F.col("__days") > threshold_days, F.col("__days"))))
    return (
        counted.select("production_order_id", "deal_id", "status", "planned_finish_at", "actual_finish_at", late.alias("delay_days"))
        .where(F.col("delay_days").isNotNull())
        .orderBy(F.col("delay_days").desc(), "production_order_id")
    )


# ---------------------------------------------------------------- 5 stale deals


def stale_deals(core: Tables, n_days: int = DEFAULT_STALE_DAYS) -> DataFrame:
    """Open deals untouched for more than ``n_days`` at the cutoff, or never touched."""
    if not 0 <= n_days <= MAX_STALE_DAYS:
        raise ValueError(f"n_days must be within 0..{MAX_STALE_DAYS}: {n_days}")
    touched = core["activities"].groupBy("deal_id").agg(
        F.to_date(F.max(F.greatest("deadline_at", "completed_at"))).alias("last_touch")
    )
    is_open = F.coalesce(~F.col("stage_id").isin(CLOSING_STAGES), F.lit(True))
    deals = core["deals"].where(is_open).select("deal_id", "stage_id").join(touched, "deal_id", "left")
    return (
        deals.withColumn("days_since", F.date_diff(cutoff_date(core).scalar(), F.col("last_touch")))
        .where(F.col("last_touch").isNull() | (F.col("days_since") > n_days))
        .select("deal_id", "stage_id", "last_touch", "days_since")
        .orderBy(F.col("days_since").desc_nulls_first(), "deal_id")
    )


# ---------------------------------------------------------------- 6 channels


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` of two amounts, ``whole`` above 0, rounded once to four places, halves away from zero.

    Whole cents are divided as whole numbers; a quotient of doubles, or of decimals of some scale, would be
    rounded before it is rounded.
    """
    cents = lambda amount: (amount * 100).cast("decimal(38,0)")
    places = F.call_function(
        "div", (F.abs(cents(part)) * 20000).cast("decimal(38,0)") + cents(whole), (cents(whole) * 2).cast("decimal(38,0)")
    )
    return F.signum(cents(part)) * places.cast("double") / F.lit(10000.0)


def sources_report(core: Tables) -> DataFrame:
    """Deals, won sales, margin, spending and return on spending per channel."""
    won = _won()
    sold = deal_amount(core).groupBy("source_id").agg(
        F.count(F.lit(1)).alias("deals"),
        F.count_if(won).alias("won_deals"),
        F.sum(F.when(won, F.col("amount"))).alias("revenue"),
        F.sum(F.when(won, F.col("line_margin"))).alias("margin"),
    )
    spent = core["marketing_costs"].groupBy("source_id").agg(
        F.sum("cost_amount").alias("costs"), F.count(F.lit(1)).alias("cost_rows")
    )
    channels = core["sources"].withColumnRenamed("id", "source_id")
    rows = channels.join(sold, "source_id", "left").join(spent, "source_id", "left").select(
        F.col("source_id").alias("id"), "code", "name",
        F.coalesce("deals", F.lit(0)).cast("long").alias("deals"),
        F.coalesce("won_deals", F.lit(0)).cast("long").alias("won_deals"),
        _money(F.coalesce("revenue", F.lit(0))).alias("revenue"),
        _money(F.col("margin")).alias("margin"),
        _money(F.coalesce("costs", F.lit(0))).alias("costs"),
        F.coalesce("cost_rows", F.lit(0)).cast("long").alias("cost_rows"),
    )
    has_costs = (F.col("cost_rows") > 0) & (F.col("costs") > 0)
    return (
        rows.withColumn("has_costs", has_costs)
        .withColumn("romi", F.when(has_costs, _ratio(F.col("revenue") - F.col("costs"), F.col("costs"))))
        .orderBy(F.col("revenue").desc(), "code")
    )


# ---------------------------------------------------------------- 7 data quality


def quality_by_type(core: Tables) -> DataFrame:
    return (
        issue_counts(core).groupBy("issue_type", "action").agg(F.sum("count").alias("count"))
        .orderBy("issue_type", "action")
    )


def quality_by_action(core: Tables) -> DataFrame:
    return count_by_action(issue_counts(core))


def quality_total(core: Tables) -> DataFrame:
    return totals(quality_by_action(core).withColumnRenamed("count", "total"), ["total"])


def quality_pivot(core: Tables) -> DataFrame:
    """Issue types by reaction, zero-filled, most frequent first."""
    counts = issue_counts(core).groupBy("issue_type").agg(
        *(F.sum(F.when(F.col("action") == action, F.col("count")).otherwise(0)).alias(action) for action in ACTIONS)
    )
    return counts.orderBy(sum(F.col(action) for action in ACTIONS).desc(), "issue_type")


def issue_list(core: Tables) -> DataFrame:
    """The whole log in reading order."""
    # Shuffled once before the sort, which else derives the whole log a second time to find its ranges.
    log = core["data_quality_issues"].repartition("id")
    return log.orderBy("entity", F.col("entity_id").asc_nulls_last(), "id")


# ---------------------------------------------------------------- plan and fact


def plan_fact_gap(core: Tables) -> DataFrame:
    """Estimate on the card against the sum of lines, for deals that have lines."""
    return (
        deal_amount(core)
        .where(F.col("line_revenue").isNotNull())
        .select(
            "deal_id",
            _money(F.col("expected_amount")).alias("expected_amount"),
            "line_revenue",
            _money(F.col("expected_amount") - F.col("line_revenue")).alias("gap"),
        )
        .orderBy("deal_id")
    )


# ---------------------------------------------------------------- registry


@dataclass(frozen=True)
class Report:
    title: str  # fixed value: as shown to readers
    rows: Callable[..., DataFrame]
    extras: dict[str, Callable[[Tables], DataFrame]]


REPORTS: dict[str, Report] = {
    "funnel": Report("Воронка продаж", funnel, {"totals": funnel_totals}),
    "managers": Report(
        "Продажи и маржа по менеджерам", managers, {"shipped_not_closed": shipped_not_closed}
    ),
    "receivables": Report("Дебиторка", receivables, {"totals": receivables_totals}),
    "production-delays": Report(
        "Задержка производства > 5 дней", production_delays, {"cutoff_date": cutoff_date}
    ),
    "stale-deals": Report("Сделки без активности N дней", stale_deals, {"cutoff_date": cutoff_date}),
    "sources": Report("Источники заявок", sources_report, {}),
    "data-quality": Report(
        "Проблемы данных", quality_by_type,
        {"by_action": quality_by_action, "total": quality_total, "issues": issue_list},
    ),
}


def run_report(core: Tables, name: str, **parameters) -> DataFrame:
    """Rows of one registered report; unknown names are a KeyError, bad parameters an error."""
    return REPORTS[name].rows(core, **parameters)
