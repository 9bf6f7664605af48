"""Checks over whole tables: declared constraints, row reconciliation and the run summary."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealmill.schemas import ACTIONS, CONSTRAINTS, CORE_SCHEMAS, CORE_TABLES, RAW_TABLES, Constraints

# How the issue log names the rows of each table.
ENTITY_OF_TABLE = {
    "users": "user",
    "companies": "company",
    "contacts": "contact",
    "products": "product",
    "pipeline_stages": "pipeline_stage",
    "deals": "deal",
    "deal_products": "deal_product",
    "payments": "payment",
    "stage_history": "stage_history",
    "activities": "activity",
    "production_orders": "production_order",
    "shipments": "shipment",
    "marketing_costs": "marketing_cost",
}

# The column by which the issue log names a row, where it is not the first of the typed table.
RECONCILED_KEYS = {"deal_products": "deal_id"}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _row_checks(spec: Constraints) -> list[tuple[str, str, Column]]:
    """(constraint, kind, is it broken?) for NOT NULL and value domains of a row."""
    checks = [(f"{c}_not_null", "not_null", F.col(c).isNull()) for c in spec.not_null]
    return checks + [(f"{c}_domain", "check", ~F.col(c).isin(list(values))) for c, values in spec.domains]


def _checks(tables: Mapping[str, DataFrame], specs: dict[str, Constraints]) -> DataFrame:
    """All constraints of all tables in one scan of each table and one shuffle.

    Every row gives one entry per key and reference: the key column it belongs to (its *domain*), a slot that tells
    the key (0) from the references to it (1, 2, ...), and the value.  Entries are counted per domain and value, map-side
    first, so a hot value costs one row per task.  A value with two or more in slot 0 is a repeated key; one
    with none in slot 0 is a parent that is missing, and its references are broken.

    A row that breaks a NOT NULL or a value domain gives one more entry for it: a reference to a key that no table has.
    """
    keys = [
        (table, column, kind)
        for table, spec in specs.items() if table in tables
        for column, kind in [(spec.primary_key, "primary_key"), *((c, "unique") for c in spec.unique)]
    ]
    slots: dict[tuple[str, str], list[tuple[str, str, str]]] = {
        (table, column): [(table, f"{column}_{kind}", kind)] for table, column, kind in keys
    }
    entries: dict[str, list] = {table: [(column, (table, column), 0) for t, column, _ in keys if t == table] for table in tables}
    unkeyed = []
    for table, spec in specs.items():
        if table not in tables:
            continue
        for column, parent, key in spec.references:
            if parent not in tables:
                continue
            if (parent, key) not in slots:  # a reference to a column that is not itself checked
                slots[(parent, key)] = [None]
                unkeyed.append((parent, key))
            slot = slots[(parent, key)]
            entries[table].append((column, (parent, key), len(slot)))
            slot.append((table, f"{column}_to_{parent}", "foreign_key"))
    for parent, key in unkeyed:
        entries[parent].append((key, (parent, key), 0))

    # Checks of rows share domains of the width that keys have anyway, so that counts of keys grow no wider.
    width = max([2, *map(len, slots.values())])
    broken: dict[str, list] = {}
    named_checks: dict[tuple[str, str], list[tuple[str, str, str] | None]] = {}
    for table, spec in specs.items():
        if table not in tables:
            continue
        broken[table] = []
        for i, (constraint, kind, when) in enumerate(_row_checks(spec)):
            domain = (table, f" checks {i // (width - 1)}")
            slot = named_checks.setdefault(domain, [None])
            broken[table].append((F.coalesce(when, F.lit(False)), domain, len(slot)))
            slot.append((table, constraint, kind))
    slots = named_checks | slots

    domains = list(slots)

    def entry(domain: tuple[str, str], slot: int, value: Column) -> Column:
        return F.struct(F.lit(domains.index(domain)).alias("domain"), F.lit(slot).alias("slot"), value.alias("value"))

    stacked = []
    for table, found in entries.items():
        checks = broken.get(table, [])
        if not found and not checks:
            continue
        rows = F.array(*(entry(domain, slot, F.col(column).cast("string")) for column, domain, slot in found))
        if checks:
            # Few rows break any check; the others build no entries for them.
            more = F.array(*(entry(domain, slot, F.when(when, F.lit(""))) for when, domain, slot in checks))
            rows = F.when(reduce(Column.__or__, (when for when, _, _ in checks)), F.concat(rows, more) if found else more).otherwise(rows)
        stacked.append(tables[table].select(F.inline(rows)).where(F.col("value").isNotNull()))
    counted = union_all(stacked).groupBy("domain", "value").agg(
        *(F.count_if(F.col("slot") == i).alias(f"s{i}") for i in range(width))
    )
    per_domain = counted.groupBy("domain").agg(
        F.count_if(F.col("s0") > 1).alias("v0"), *(F.sum(F.when(F.col("s0") == 0, F.col(f"s{i}"))).alias(f"v{i}") for i in range(1, width))
    )
    # A domain without any value has no row here, and no violations.
    names = [
        F.struct(
            F.lit(number).alias("d"), F.lit(i).alias("slot"), F.lit(table).alias("table"), F.lit(constraint).alias("constraint"),
            F.lit(kind).alias("kind"),
        )
        for number, domain in enumerate(domains)
        for i, named in enumerate(slots[domain]) if named
        for table, constraint, kind in [named]
    ]
    everything = per_domain.agg(
        F.collect_list(F.struct("domain", F.array(*(F.col(f"v{i}") for i in range(width))).alias("v"))).alias("found")
    )
    named = everything.select("found", F.inline(F.array(*names)))
    of_domain = F.get(F.filter("found", lambda x: x["domain"] == F.col("d")), F.lit(0))
    violations = F.coalesce(F.get(of_domain["v"], F.col("slot")), F.lit(0)).cast("long")
    return named.select("table", "constraint", "kind", violations.alias("violations"))


def check_constraints(
    tables: Mapping[str, DataFrame], specs: dict[str, Constraints] | None = None
) -> DataFrame:
    """(table, constraint, kind, violations) for every declared constraint of the given tables.

    Each table is scanned once, for NOT NULL, value domains, keys and references together.
    """
    specs = CONSTRAINTS if specs is None else specs
    given = {t: tables[t] for t in specs if t in tables}
    parents = {p: tables[p] for spec in specs.values() for _, p, _ in spec.references if p in tables}
    return _checks(parents | given, specs)


def count_rows(tables: Mapping[str, DataFrame], label: str = "table") -> DataFrame:
    """(table, rows) of each given table."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(label), "rows") for name, df in tables.items()]
    )


def key_sum(column: str, times: Column | None = None) -> Column:
    """Sum of key hashes, each taken ``times`` times: equal for equal multisets of keys, and mergeable."""
    key = F.xxhash64(F.coalesce(F.expr(column).cast("string"), F.lit(""))).cast("decimal(38,0)")
    return F.coalesce(F.sum(key if times is None else (key * times).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def _reconciled_key(table: str) -> str:
    """The column under which the rows of a table are quarantined: the name by which the issue log calls them."""
    return RECONCILED_KEYS.get(table, CORE_SCHEMAS[table][0].name)


def tally_of(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Counts of rows and issues that derived tables offer, (table, entity, issue_type, action, count); stored tables have none."""
    return getattr(tables, "tally", None)


def issue_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(issue_type, action, count) of the issue log, possibly in several rows per type."""
    tally = tally_of(tables)
    if tally is not None:
        return tally.where(F.col("issue_type").isNotNull()).select("issue_type", "action", "count")
    return tables["data_quality_issues"].groupBy("issue_type", "action").count()


def _total(when: Column) -> Column:
    return F.coalesce(F.sum(F.when(when, F.col("count"))), F.lit(0))


def row_counts(tally: DataFrame, names: list[str]) -> DataFrame:
    """(name, rows) of each named table and of the issue log, in that order, from a tally."""
    is_row = F.col("issue_type").isNull()
    sums = tally.agg(*(_total(is_row & (F.col("table") == t)).alias(t) for t in names), _total(~is_row).alias("data_quality_issues"))
    rows = F.array(*(F.struct(F.lit(t).alias("name"), F.col(t).alias("rows")) for t in [*names, "data_quality_issues"]))
    return sums.select(F.inline(rows))


def reconcile_counts(
    raw: Mapping[str, DataFrame], core: Mapping[str, DataFrame], issues: DataFrame
) -> DataFrame:
    """Per table: raw rows, typed rows, quarantined rows, and whether they add up."""
    tally = tally_of(core)
    if tally is None or issues is not core["data_quality_issues"]:
        return reconcile_rows(raw, core, issues).drop("same_keys")
    names = [t for t in RAW_TABLES if t in raw and t in core]
    none = F.lit(0).cast("long")
    read = count_rows({t: raw[t] for t in names}).select("table", F.col("rows").alias("raw_rows"), none.alias("core_rows"), none.alias("quarantined"))
    quarantined = F.col("action") == "quarantined"
    derived = tally.where(F.col("table").isin(names)).select(
        "table", none.alias("raw_rows"), F.when(F.col("issue_type").isNull(), F.col("count")).otherwise(none).alias("core_rows"),
        F.when(quarantined, F.col("count")).otherwise(none).alias("quarantined"),
    )
    sums = read.unionByName(derived).groupBy("table").agg(*(F.sum(c).alias(c) for c in ("raw_rows", "core_rows", "quarantined")))
    return sums.withColumn("balanced", F.col("raw_rows") == F.col("core_rows") + F.col("quarantined"))


def reconcile_rows(
    raw: Mapping[str, DataFrame], core: Mapping[str, DataFrame], issues: DataFrame
) -> DataFrame:
    """Per table: raw rows, typed rows, quarantined rows, and whether they are the same rows.

    ``balanced`` compares numbers of rows.  ``same_keys`` compares which rows: the multiset of keys of the raw table with
    that of the typed table and the quarantined rows together, so one row lost for another is seen.
    Each table is read once, for both.
    """
    names = [t for t in RAW_TABLES if t in raw and t in core]
    zero = F.lit(0).cast("decimal(38,0)")
    derived = getattr(core, "reconciled", None)
    if derived is not None and issues is core["data_quality_issues"]:
        # Derived tables are derived once, for rows and issues together.
        none = F.lit(0).cast("long")
        read = union_all([
            raw[t].agg(F.count(F.lit(1)).alias("raw_rows"), key_sum(_reconciled_key(t)).alias("raw_keys")).select(
                F.lit(t).alias("table"), "raw_rows", "raw_keys", none.alias("core_rows"), zero.alias("core_keys"),
                none.alias("quarantined"), zero.alias("dropped_keys"),
            )
            for t in names
        ])
        found = derived.where(F.col("table").isin(names)).select(
            "table", none.alias("raw_rows"), zero.alias("raw_keys"), "core_rows", "core_keys", "quarantined", "dropped_keys"
        )
        sums = read.unionByName(found).groupBy("table").agg(*(F.sum(c).alias(c) for c in read.columns[1:]))
        return sums.select(
            "table", "raw_rows", "core_rows", "quarantined",
            (F.col("raw_rows") == F.col("core_rows") + F.col("quarantined")).alias("balanced"),
            (F.col("raw_keys") == F.col("core_keys") + F.col("dropped_keys")).alias("same_keys"),
        )

    def counted(df: DataFrame, table: str, side: str, other: str) -> DataFrame:
        key = _reconciled_key(table)
        return df.agg(F.count(F.lit(1)).alias(f"{side}_rows"), key_sum(key).alias(f"{side}_keys")).select(
            F.lit(table).alias("table"), F.lit(ENTITY_OF_TABLE[table]).alias("entity"), f"{side}_rows", f"{side}_keys",
            F.lit(0).cast("long").alias(f"{other}_rows"), zero.alias(f"{other}_keys"),
        )

    sides = [counted(raw[t], t, "raw", "core") for t in names] + [counted(core[t], t, "core", "raw") for t in names]
    counts = union_all(sides).groupBy("table", "entity").agg(
        *(F.sum(c).alias(c) for c in ("raw_rows", "core_rows", "raw_keys", "core_keys"))
    )
    dropped = issues.where(F.col("action") == "quarantined").groupBy("entity").agg(
        F.count(F.lit(1)).alias("count"), key_sum("entity_id").alias("dropped_keys")
    )
    out = counts.join(dropped, "entity", "left").withColumn("quarantined", F.coalesce("count", F.lit(0)))
    return out.select(
        "table", "raw_rows", "core_rows", "quarantined",
        (F.col("raw_rows") == F.col("core_rows") + F.col("quarantined")).alias("balanced"),
        (F.col("raw_keys") == F.col("core_keys") + F.coalesce("dropped_keys", zero)).alias("same_keys"),
    )


def count_by_action(counts: DataFrame) -> DataFrame:
    """(action, count) in fixed order, zero where there are none, from ``issue_counts``; no join."""
    counted = counts.agg(*(_total(F.col("action") == a).alias(a) for a in ACTIONS))
    rows = F.array(*(F.struct(F.lit(a).alias("action"), F.col(a).alias("count")) for a in ACTIONS))
    return counted.select(F.inline(rows))


def run_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(kind, name, rows): typed tables first, then issues by action, zero-filled."""
    loaded = {t: tables[t] for t in CORE_TABLES if t in tables and t in ENTITY_OF_TABLE}
    tally = tally_of(tables)
    counted = count_rows(loaded, "name") if tally is None else row_counts(tally, list(loaded)).where("name <> 'data_quality_issues'")
    by_table = counted.select(F.lit("table").alias("kind"), "name", "rows")
    by_action = count_by_action(issue_counts(tables)).select(
        F.lit("issues").alias("kind"), F.col("action").alias("name"), F.col("count").alias("rows")
    )
    return by_table.unionByName(by_action)
