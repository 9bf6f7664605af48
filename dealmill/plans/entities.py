"""One builder per entity: raw text table in, typed table and its issues out.

A builder marks every raw row once (typed values, keep or drop, array of issues) in a single
plan; the typed table and the issues are two projections of that marked table.  A load can
write the marked table once and read both from it.  In lazy plans cells are cleaned before references are
looked up, so that a query moves only the flags and values it needs, not the texts they come from.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealmill.functions import normalize as N
from dealmill.operators.constraints import RECONCILED_KEYS, key_sum
from dealmill.operators.dedup import dedup_latest, distinct_rows
from dealmill.operators.lookup import LAZY, Spread, replicate
from dealmill.operators.references import is_broken, mark_canonical, mark_reference, resolved
from dealmill.operators.rules import (
    Rule,
    detail_columns,
    explode_fired,
    fired,
    has_quality_issue,
    is_illegal_transition,
    issue_columns,
)
from dealmill.schemas import (
    ACTIVITY_TYPES,
    CORE_SCHEMAS,
    DEFAULT_CURRENCY,
    PAYMENT_STATUSES,
    PAYMENT_TYPES,
    PRODUCTION_STATUSES,
    RAW_COLUMNS,
    SHIPMENT_STATUSES,
)


@dataclass(frozen=True)
class Result:
    """Typed table and issues of one entity."""

    table: str
    entity: str
    marked: DataFrame  # typed columns, _keep, _issues, their texts and, where copies were folded, _copies
    entity_id: str  # typed column by which the log names a row, or null
    rules: list[Rule]  # what the positions in _issues stand for
    displaced: DataFrame | None = None  # issues of rows that lost to a later version

    @property
    def core(self) -> DataFrame:
        return self.marked.where("_keep").select(*CORE_SCHEMAS[self.table].names)

    @property
    def issues(self) -> DataFrame:
        out = explode_fired(self.marked, self.entity, self.entity_id, self.rules)
        if "_copies" in self.marked.columns:
            out = out.unionByName(self._issues_of_copies())
        if self.displaced is not None:
            out = out.unionByName(self.displaced)
        return out

    def _issues_of_copies(self) -> DataFrame:
        """Further copies of a kept row are duplicates; those of an orphan are orphans too."""
        key = CORE_SCHEMAS[self.table].names[0]
        folded = self.marked.where(F.col("_copies") > 1).select(key, "deal_id", "_keep", "_copies")
        columns = issue_columns(self.entity, key, "", "quarantined", "if(_keep, 'identical row', deal_id)")
        columns[2] = "if(_keep, 'duplicate_event', 'orphan_deal') as issue_type"
        return replicate(folded.selectExpr(*columns, "_copies"), F.col("_copies") - 1).drop("_copies")

    @property
    def tally(self) -> DataFrame:
        """(table, entity, issue_type, action, count): kept rows under no type, issues under theirs; zeros are left out.

        One pass over the marked rows counts both, without a row per issue.
        """
        kinds = [(None, None, "count_if(_keep)")]
        kinds += [(r.issue_type, r.action, f"count_if(get(_issues, {i}) is not null)") for i, r in enumerate(self.rules)]
        if "_copies" in self.marked.columns:
            kinds.append(("duplicate_event", "quarantined", "coalesce(sum(if(_keep, _copies - 1, 0)), 0)"))
            kinds.append(("orphan_deal", "quarantined", "coalesce(sum(if(_keep, 0, _copies - 1)), 0)"))
        counted = self.marked.selectExpr(*(f"cast({count} as bigint) as n{i}" for i, (_, _, count) in enumerate(kinds)))
        named = [self._counted(t, a, F.col(f"n{i}")) for i, (t, a, _) in enumerate(kinds)]
        out = counted.select(F.inline(F.array(*named)))
        if self.displaced is not None:
            lost = self.displaced.groupBy("issue_type", "action").agg(F.count(F.lit(1)).alias("n"))
            out = out.unionByName(lost.select(self._counted(F.col("issue_type"), F.col("action"), F.col("n")).alias("k")).select("k.*"))
        return out.where("count > 0")

    @property
    def reconciled(self) -> DataFrame:
        """(table, core_rows, core_keys, quarantined, dropped_keys): kept rows, quarantined ones, and sums of their keys' hashes.

        One pass over the marked rows gives both; displaced rows come in rows of their own.
        """
        key = RECONCILED_KEYS.get(self.table, CORE_SCHEMAS[self.table][0].name)
        dropped = [f"if(get(_issues, {i}) is not null, 1, 0)" for i, r in enumerate(self.rules) if r.action == "quarantined"]
        if "_copies" in self.marked.columns:
            dropped.append("_copies - 1")
        times = F.expr(f"cast({' + '.join(dropped) or '0'} as bigint)")
        none, zero = F.lit(0).cast("long"), F.lit(0).cast("decimal(38,0)")
        table = F.lit(self.table).alias("table")
        out = self.marked.agg(
            F.count_if(F.col("_keep")).alias("core_rows"), key_sum(key, F.col("_keep").cast("long")).alias("core_keys"),
            F.coalesce(F.sum(times), none).alias("quarantined"), key_sum(self.entity_id, times).alias("dropped_keys"),
        ).select(table, "*")
        if self.displaced is not None:
            lost = self.displaced.where("action = 'quarantined'").agg(
                F.count(F.lit(1)).alias("quarantined"), key_sum("entity_id").alias("dropped_keys")
            )
            out = out.unionByName(lost.select(table, none.alias("core_rows"), zero.alias("core_keys"), "quarantined", "dropped_keys"))
        return out

    def _counted(self, issue_type: Column | str | None, action: Column | str | None, count: Column) -> Column:
        cells = {"table": self.table, "entity": self.entity, "issue_type": issue_type, "action": action}
        return F.struct(
            *((c if isinstance(c, Column) else F.lit(c)).cast("string").alias(name) for name, c in cells.items()), count.alias("count")
        )

    def stored(self, keep: Callable[[DataFrame], DataFrame]) -> Result:
        """The same result over stored copies of the marked table and of the issues of displaced rows."""
        displaced = None if self.displaced is None else keep(self.displaced)
        return replace(self, marked=keep(self.marked), displaced=displaced)


def _mark(
    df: DataFrame,
    table: str,
    entity: str,
    entity_id: str,
    typed: dict[str, str],
    rules: list[Rule],
    drop_rules: list[Rule] | None = None,
) -> Result:
    """Typed columns (raw ones where not named), row flag, keep flag and broken rules.

    ``drop_rules`` are tried in order; the first that fires drops the row and is its only issue.
    Each rule is evaluated once, into a column that flag and issues both read.
    """
    drops = drop_rules or []
    names = [f"__rule{i}" for i in range(len(drops) + len(rules))]
    df = df.selectExpr("*", *(f"coalesce({r.when}, false) as {n}" for n, r in zip(names, drops + rules)))

    keep = "true"
    found: list[Rule] = []
    for name, rule in zip(names, drops):
        found.append(Rule(rule.issue_type, rule.action, f"({keep} and {name})", rule.details))
        keep = f"{keep} and not {name}"
    checked = [
        Rule(r.issue_type, r.action, f"({keep} and {name})" if drops else name, r.details)
        for name, r in zip(names[len(drops):], rules)
    ]
    typed = {"has_quality_issue": has_quality_issue(checked), **typed}
    columns = [_typed(f, typed.get(f.name, f.name), keep, entity, entity_id) for f in CORE_SCHEMAS[table]]
    rules = found + checked
    columns += [f"{keep} as _keep", f"{fired(rules)} as _issues", *(f"{text} as {c}" for c, text in detail_columns(rules).items())]
    if "_copies" in df.columns:
        columns.append("_copies")
    return Result(table, entity, df.selectExpr(*columns), entity_id, rules)


def _typed(field: T.StructField, value: str, keep: str, entity: str, entity_id: str) -> str:
    """The value in its column's type.

    Only kept rows are typed, so that no cell of a dropped row stops the load.  A number of a kept row
    that does not fit its column is an error that names the row.
    """
    kind = field.dataType.simpleString()
    if isinstance(field.dataType, T.StringType) or field.name == "has_quality_issue":
        return f"cast({value} as {kind}) as {field.name}"
    if not isinstance(field.dataType, T.NumericType):
        return f"cast(if({keep}, {value}, null) as {kind}) as {field.name}"
    fits = f"try_cast({value} as {kind})"
    row = f"concat('{entity} ', coalesce({entity_id}, 'null'), ': {field.name} does not fit {kind}: ', cast({value} as string))"
    return f"if({keep}, if({value} is not null and {fits} is null, raise_error({row}), {fits}), null) as {field.name}"


def _prepared(
    df: DataFrame, kinds: dict[str, N.Kind], checks: list[Rule], look_up: Callable[[DataFrame], DataFrame], spread: Spread
) -> tuple[DataFrame, list[Rule]]:
    """Cells cleaned, references looked up, and the ``checks``, which need no reference, as rules on one number per row.

    A load looks references up first: it needs all cells of a row, and moves them without the values found in them.  A lazy plan
    cleans first and moves the values that its query needs; which checks a row breaks is one number to move.
    """
    bits = " + ".join(f"if({r.when}, {1 << i}, 0)" for i, r in enumerate(checks)) or "0"
    rules = [replace(r, when=f"getbit(_checks, {i}) = 1") for i, r in enumerate(checks)]

    def cleaned(rows: DataFrame) -> DataFrame:
        return N.clean(rows, kinds).selectExpr("*", f"{bits} as _checks")

    return cleaned(look_up(df)) if spread.keep else look_up(cleaned(df)), rules


def _values(*columns: str) -> dict[str, str]:
    """The cleaned value of each column."""
    return {column: f"{column}__v" for column in columns}


def _orphan(column: str, hit: str, issue_type: str) -> Rule:
    """A row without its parent is dropped; a missing key counts as missing parent."""
    return Rule(issue_type, "quarantined", f"not {hit}", column)


def _broken(column: str, hit: str, issue_type: str) -> Rule:
    """A written reference without parent is nulled and flagged; a blank one is no reference."""
    return Rule(issue_type, "flagged", is_broken(column, hit), column)


def _channel_rules(column: str) -> list[Rule]:
    return [
        Rule("unknown_source", "flagged", f"{column}__unknown", column),
        Rule("normalized_source", "fixed", f"{column}__rewritten", f"concat({column}, ' -> ', {column}__v)"),
    ]


# ---------------------------------------------------------------- dictionaries


def build_users(raw: DataFrame) -> Result:
    df = N.clean(raw, {"active": N.FLAG})
    return _mark(df, "users", "user", "user_id", {"active": "active__v"}, [])


def build_companies(raw: DataFrame) -> Result:
    df = N.clean(raw, {"name": N.TEXT, "inn": N.TEXT, "industry": N.TEXT, "created_at": N.TIMESTAMP})
    rules = [
        Rule(
            "incomplete_company", "flagged", "name__blank and inn__blank and industry__blank",
            "'no name, inn or industry'",
        )
    ]
    typed = {"inn": "inn__v", "created_at": "created_at__v"}
    return _mark(df, "companies", "company", "company_id", typed, rules)


def build_contacts(raw: DataFrame, companies: DataFrame, spread: Spread = LAZY) -> Result:
    checks = [
        Rule("normalized_phone", "fixed", "phone__status = 'fixed'", "concat(phone, ' -> ', phone__v)"),
        Rule("unnormalized_phone", "flagged", "phone__status = 'unrecognized'", "phone"),
        Rule("missing_email", "flagged", "email__blank"),
    ]
    df, checks = _prepared(
        raw, {"phone": N.PHONE, "email": N.TEXT, "created_at": N.TIMESTAMP}, checks,
        lambda rows: mark_reference(rows, "company_id", companies, "company_id", "_company", spread=spread, counted_in=raw), spread,
    )
    rules = [_broken("company_id", "_company", "orphan_company"), *checks]
    typed = {
        "company_id": resolved("company_id", "_company"),
        "phone": "phone__v",
        "created_at": "created_at__v",
    }
    return _mark(df, "contacts", "contact", "contact_id", typed, rules)


def build_products(raw: DataFrame, spread: Spread = LAZY) -> Result:
    df = mark_canonical(raw, "product_id", "sku", spread=spread)
    df = N.clean(df, {"cost_price": N.AMOUNT, "is_active": N.FLAG})
    rules = [
        Rule(
            "duplicate_sku", "flagged", "canonical_id is not null",
            "concat('SKU ', sku, ' repeats ', canonical_id)",
        )
    ]
    typed = {"cost_price": "cost_price__v", "is_active": "is_active__v"}
    return _mark(df, "products", "product", "product_id", typed, rules)


def build_pipeline_stages(raw: DataFrame) -> Result:
    df = N.clean(raw, {"sort_order": N.INTEGER, "is_final": N.FLAG, "is_success": N.FLAG})
    typed = _values("sort_order", "is_final", "is_success")
    return _mark(df, "pipeline_stages", "pipeline_stage", "stage_id", typed, [])


# ---------------------------------------------------------------- deals


def build_deals(
    raw: DataFrame,
    users: DataFrame,
    companies: DataFrame,
    contacts: DataFrame,
    stages: DataFrame,
    spread: Spread = LAZY,
) -> Result:
    """``users`` carries ``active`` as a typed flag; the other parents need only their keys."""
    versions = dedup_latest(
        N.clean(raw, {"updated_at": N.TIMESTAMP}), "deal_id", "updated_at__v", "updated_at", "deal",
        "duplicate_deal", spread=spread, counted_in=raw,
    )
    kinds = {
        "source": N.CHANNEL, "expected_amount": N.AMOUNT, "currency": N.CURRENCY,
        "created_at": N.TIMESTAMP, "closed_at": N.TIMESTAMP, "custom_deadline": N.DATE,
        "stage_id": N.TEXT, "manager_id": N.TEXT, "company_id": N.TEXT, "contact_id": N.TEXT,
    }

    def look_up(rows: DataFrame) -> DataFrame:
        for column, parents, key, hit, carry in [
            ("stage_id", stages, "stage_id", "_stage", None),
            ("manager_id", users, "user_id", "_manager", {"active": "_active"}),
            ("company_id", companies, "company_id", "_company", None),
            ("contact_id", contacts, "contact_id", "_contact", None),
        ]:
            rows = mark_reference(rows, column, parents, key, hit, carry, spread=spread, counted_in=raw)
        return rows

    checks = [
        *_channel_rules("source"),
        Rule("missing_manager", "flagged", "manager_id__blank"),
        Rule("missing_company", "flagged", "company_id__blank"),
        Rule("negative_amount", "flagged", "expected_amount__v < 0", "expected_amount"),
        Rule("missing_currency", "fixed", "currency__blank", f"'-> {DEFAULT_CURRENCY}'"),
        Rule(
            "nonstandard_date", "fixed", "created_at__nonstandard", "concat('created_at=', created_at)",
        ),
    ]
    df, checks = _prepared(versions.kept, kinds, checks, look_up, spread)
    unknown_source, normalized_source, missing_manager, missing_company, *others = checks
    rules = [
        unknown_source,
        normalized_source,
        _broken("stage_id", "_stage", "orphan_stage"),
        missing_manager,
        _broken("manager_id", "_manager", "orphan_manager"),
        Rule(
            "inactive_manager", "flagged",
            "not manager_id__blank and _manager and _active = false", "manager_id",
        ),
        missing_company,
        _broken("company_id", "_company", "orphan_company"),
        _broken("contact_id", "_contact", "orphan_contact"),
        *others,
        Rule(
            "won_without_close_date", "flagged",
            "_stage and stage_id = 'WON' and closed_at__blank",
        ),
    ]
    typed = {
        **_values("created_at", "updated_at", "closed_at", "custom_deadline", "expected_amount", "currency"),
        "stage_id": resolved("stage_id", "_stage"),
        "manager_id": resolved("manager_id", "_manager"),
        "company_id": resolved("company_id", "_company"),
        "contact_id": resolved("contact_id", "_contact"),
        "source_id": "source__id",
    }
    return replace(_mark(df, "deals", "deal", "deal_id", typed, rules), displaced=versions.issues)


# ---------------------------------------------------------------- rows under a deal


# Exact up to eight whole digits, to six decimals beyond; a product too large for any decimal has only a sign.
_ABOVE_LINE = (
    "coalesce(try_cast(discount__v as decimal(38,20)) > "
    "try_cast(quantity__v as decimal(18,10)) * try_cast(unit_price__v as decimal(18,10)), "
    "discount__v > try_multiply(quantity__v, unit_price__v), "
    "discount__v is not null and (quantity__v < 0) <> (unit_price__v < 0))"
)


def build_deal_products(
    raw: DataFrame, deals: DataFrame, products: DataFrame, spread: Spread = LAZY
) -> Result:
    def look_up(rows: DataFrame) -> DataFrame:
        rows = mark_reference(rows, "deal_id", deals, "deal_id", "_deal", spread=spread, counted_in=raw)
        return mark_reference(rows, "product_id", products, "product_id", "_product", spread=spread, counted_in=raw)

    checks = [
        Rule(
            "discount_exceeds_line", "flagged", _ABOVE_LINE,
            "concat('discount ', discount, ' > ', quantity, ' x ', unit_price)",
        )
    ]
    df, rules = _prepared(raw, {"quantity": N.AMOUNT, "unit_price": N.AMOUNT, "discount": N.DISCOUNT}, checks, look_up, spread)
    typed = _values("quantity", "unit_price", "discount")
    drops = [_orphan("deal_id", "_deal", "orphan_deal"), _orphan("product_id", "_product", "orphan_product")]
    # The log names a line by its deal: lines have no key of their own.
    return _mark(df, "deal_products", "deal_product", "deal_id", typed, rules, drops)


def build_payments(raw: DataFrame, deals: DataFrame, spread: Spread = LAZY) -> Result:
    kinds = {"payment_date": N.DATE, "amount": N.AMOUNT, "payment_type": PAYMENT_TYPES, "status": PAYMENT_STATUSES}
    checks = [
        Rule("invalid_payment_type", "flagged", "payment_type__invalid", "payment_type"),
        Rule("invalid_payment_status", "flagged", "status__invalid", "status"),
        Rule("unknown_payment_type", "flagged", "payment_type__v = 'unknown'", "payment_type__v"),
        Rule(
            "nonstandard_date", "fixed", "payment_date__nonstandard", "concat('payment_date=', payment_date)",
        ),
    ]
    df, rules = _prepared(
        raw, kinds, checks,
        lambda rows: mark_reference(rows, "deal_id", deals, "deal_id", "_deal", spread=spread, counted_in=raw), spread,
    )
    typed = _values("payment_date", "amount", "payment_type", "status")
    drops = [_orphan("deal_id", "_deal", "orphan_deal")]
    return _mark(df, "payments", "payment", "payment_id", typed, rules, drops)


def build_stage_history(
    raw: DataFrame, deals: DataFrame, stages: DataFrame, users: DataFrame, spread: Spread = LAZY
) -> Result:
    """Identical rows are folded, with their count, before any join; the log unfolds them."""
    df = distinct_rows(raw, RAW_COLUMNS["stage_history"]).withColumnRenamed("copies", "_copies")

    def look_up(rows: DataFrame) -> DataFrame:
        for column, parents, key, hit in [
            ("deal_id", deals, "deal_id", "_deal"),
            ("old_stage_id", stages, "stage_id", "_old"),
            ("new_stage_id", stages, "stage_id", "_new"),
            ("changed_by_id", users, "user_id", "_user"),
        ]:
            rows = mark_reference(rows, column, parents, key, hit, spread=spread, counted_in=raw)
        return rows

    df, _ = _prepared(df, {"changed_at": N.TIMESTAMP}, [], look_up, spread)
    old, new = resolved("old_stage_id", "_old"), resolved("new_stage_id", "_new")
    rules = [
        Rule("illegal_transition", "flagged", is_illegal_transition(old, new), f"concat({old}, ' -> ', {new})"),
        _broken("changed_by_id", "_user", "orphan_user"),
    ]
    typed = {
        "old_stage_id": old,
        "new_stage_id": new,
        "changed_at": "changed_at__v",
        "changed_by_id": resolved("changed_by_id", "_user"),
    }
    drops = [_orphan("deal_id", "_deal", "orphan_deal")]
    return _mark(df, "stage_history", "stage_history", "event_id", typed, rules, drops)


def build_activities(
    raw: DataFrame, deals: DataFrame, users: DataFrame, spread: Spread = LAZY
) -> Result:
    kinds = {
        "activity_type": ACTIVITY_TYPES, "direction": N.TEXT, "completed": N.FLAG,
        "deadline_at": N.TIMESTAMP, "completed_at": N.TIMESTAMP,
    }

    def look_up(rows: DataFrame) -> DataFrame:
        rows = mark_reference(rows, "deal_id", deals, "deal_id", "_deal", spread=spread, counted_in=raw)
        return mark_reference(rows, "responsible_user_id", users, "user_id", "_user", spread=spread, counted_in=raw)

    checks = [Rule("invalid_activity_type", "flagged", "activity_type__invalid", "activity_type")]
    df, checks = _prepared(raw, kinds, checks, look_up, spread)
    rules = [*checks, _broken("responsible_user_id", "_user", "orphan_user")]
    typed = _values("activity_type", "direction", "completed", "deadline_at", "completed_at")
    typed["responsible_user_id"] = resolved("responsible_user_id", "_user")
    drops = [_orphan("deal_id", "_deal", "orphan_deal")]
    return _mark(df, "activities", "activity", "activity_id", typed, rules, drops)


def build_production_orders(raw: DataFrame, deals: DataFrame, spread: Spread = LAZY) -> Result:
    """``deals`` carries ``created_at`` as a typed instant."""
    kinds = {
        "created_at": N.TIMESTAMP, "planned_finish_at": N.DATE, "actual_finish_at": N.DATE, "status": PRODUCTION_STATUSES,
    }
    df, checks = _prepared(
        raw, kinds, [Rule("invalid_production_status", "flagged", "status__invalid", "status")],
        lambda rows: mark_reference(
            rows, "deal_id", deals, "deal_id", "_deal", {"created_at": "_deal_created"}, spread=spread, counted_in=raw
        ),
        spread,
    )
    rules = [
        *checks,
        Rule(
            "temporal_inconsistency", "flagged", "created_at__v < _deal_created",
            "concat(to_date(created_at__v), ' before ', to_date(_deal_created))",
        ),
    ]
    typed = _values("created_at", "planned_finish_at", "actual_finish_at", "status")
    drops = [_orphan("deal_id", "_deal", "orphan_deal")]
    return _mark(
        df, "production_orders", "production_order", "production_order_id", typed, rules, drops
    )


def build_shipments(raw: DataFrame, deals: DataFrame, spread: Spread = LAZY) -> Result:
    df, rules = _prepared(
        raw, {"planned_date": N.DATE, "actual_date": N.DATE, "status": SHIPMENT_STATUSES},
        [Rule("invalid_shipment_status", "flagged", "status__invalid", "status")],
        lambda rows: mark_reference(rows, "deal_id", deals, "deal_id", "_deal", spread=spread, counted_in=raw), spread,
    )
    typed = _values("planned_date", "actual_date", "status")
    drops = [_orphan("deal_id", "_deal", "orphan_deal")]
    return _mark(df, "shipments", "shipment", "shipment_id", typed, rules, drops)


# ---------------------------------------------------------------- spending


def build_marketing_costs(raw: DataFrame) -> Result:
    """Issues carry no row id and never mark the row: spending has no key of its own."""
    df = N.clean(
        raw, {"cost_date": N.DATE, "source": N.CHANNEL, "cost_amount": N.AMOUNT, "currency": N.CURRENCY}
    )
    typed = {
        "cost_date": "cost_date__v",
        "source_id": "source__id",
        "cost_amount": "cost_amount__v",
        "currency": "currency__v",
        "has_quality_issue": "false",
    }
    return _mark(df, "marketing_costs", "marketing_cost", "null", typed, _channel_rules("source"))
