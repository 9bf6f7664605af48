"""The whole load: text extracts to raw tables, to typed tables and the issue log."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealmill.functions import normalize as N
from dealmill.operators.constraints import check_constraints, union_all
from dealmill.operators.dedup import latest_rows
from dealmill.operators.lookup import LAZY, Spread
from dealmill.operators.rules import issue_log, numbered_log
from dealmill.plans import entities as E
from dealmill.schemas import CORE_TABLES, seed_sources
from dealmill.session import at_once, checkpoint_dir, configure, shuffles_dropped
from dealmill.sources.extracts import read_extracts
from dealmill.sources.store import ROWS_PER_FILE, TableStore, Version


class Parents:
    """Key tables that references are checked against, each planned when first needed.

    Keys come straight from the raw tables: dictionaries lose no rows, deals lose only versions.
    """

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw

    @cached_property
    def users(self) -> DataFrame:
        return N.clean(self.raw["users"], {"active": N.FLAG}).select("user_id", F.col("active__v").alias("active"))

    @cached_property
    def companies(self) -> DataFrame:
        return self.raw["companies"].select("company_id")

    @cached_property
    def contacts(self) -> DataFrame:
        return self.raw["contacts"].select("contact_id")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw["products"].select("product_id")

    @cached_property
    def stages(self) -> DataFrame:
        return self.raw["pipeline_stages"].select("stage_id")

    @cached_property
    def deals(self) -> DataFrame:
        return self.raw["deals"].select("deal_id")

    @cached_property
    def deal_times(self) -> DataFrame:
        """deal_id and created_at of the version that is kept."""
        versions = N.clean(
            self.raw["deals"].select("id", "deal_id", "created_at", "updated_at"),
            {"created_at": N.TIMESTAMP, "updated_at": N.TIMESTAMP},
        ).select("id", "deal_id", F.col("created_at__v").alias("created_at"), "updated_at__v")
        latest = latest_rows(versions, "deal_id", [F.col("updated_at__v").desc_nulls_last(), F.col("id").desc()])
        return latest.select("deal_id", "created_at")


# Build order: parents before the rows that refer to them.
LOAD_ORDER = [
    "users", "companies", "contacts", "products", "pipeline_stages", "deals", "deal_products", "payments",
    "stage_history", "activities", "production_orders", "shipments", "marketing_costs",
]


# An entity with more raw rows is written by itself: its tasks keep all cores busy, and the shuffle files of several add up.
ROWS_AT_ONCE = 50_000_000


def build(
    table: str, raw: Mapping[str, DataFrame], parents: Parents, spread: Spread = LAZY
) -> E.Result:
    """Typed table and issues of one entity."""
    rows, p = raw[table], parents
    builders = {
        "users": lambda: E.build_users(rows),
        "companies": lambda: E.build_companies(rows),
        "contacts": lambda: E.build_contacts(rows, p.companies, spread),
        "products": lambda: E.build_products(rows, spread),
        "pipeline_stages": lambda: E.build_pipeline_stages(rows),
        "deals": lambda: E.build_deals(rows, p.users, p.companies, p.contacts, p.stages, spread),
        "deal_products": lambda: E.build_deal_products(rows, p.deals, p.products, spread),
        "payments": lambda: E.build_payments(rows, p.deals, spread),
        "stage_history": lambda: E.build_stage_history(rows, p.deals, p.stages, p.users, spread),
        "activities": lambda: E.build_activities(rows, p.deals, p.users, spread),
        "production_orders": lambda: E.build_production_orders(rows, p.deal_times, spread),
        "shipments": lambda: E.build_shipments(rows, p.deals, spread),
        "marketing_costs": lambda: E.build_marketing_costs(rows),
    }
    return builders[table]()


class TypedTables(Mapping[str, DataFrame]):
    """The typed tables of one load over the raw tables, each planned when asked for.

    Without ``spread.keep`` all are lazy plans.  With it, each entity is computed and stored once when it is first
    needed; its typed table and its issues are read from there.
    """

    def __init__(self, raw: Mapping[str, DataFrame], spread: Spread = LAZY):
        self.raw, self.spread = raw, spread
        self.parents = Parents(raw)
        self.results: dict[str, E.Result] = {}

    def result(self, table: str) -> E.Result:
        if table not in self.results:
            result = build(table, self.raw, self.parents, self.spread)
            keep = self.spread.keep
            self.results[table] = result.stored(keep) if keep else result
        return self.results[table]

    @cached_property
    def issues(self) -> DataFrame:
        return issue_log([self.result(table).issues for table in LOAD_ORDER], self.spread.keep)

    @cached_property
    def tally(self) -> DataFrame:
        """Rows and issues of all entities as ``Result.tally`` counts them, each entity derived once for both."""
        return union_all([self.result(table).tally for table in LOAD_ORDER])

    @cached_property
    def reconciled(self) -> DataFrame:
        """Rows, quarantined rows and their keys of all entities as ``Result.reconciled`` sums them up."""
        return union_all([self.result(table).reconciled for table in LOAD_ORDER])

    def __getitem__(self, table: str) -> DataFrame:
        if table not in CORE_TABLES:
            raise KeyError(table)
        if table == "sources":
            return seed_sources(self.raw["users"].sparkSession)
        if table == "data_quality_issues":
            return self.issues
        return self.result(table).core

    def __iter__(self):
        return iter(CORE_TABLES)

    def __len__(self) -> int:
        return len(CORE_TABLES)


def run_transform(
    raw: Mapping[str, DataFrame], spread: Spread = LAZY
) -> tuple[TypedTables, DataFrame]:
    """(typed tables, issue log); nothing runs yet."""
    tables = TypedTables(raw, spread)
    return tables, tables.issues


class ConstraintViolation(RuntimeError):
    """The typed tables break a declared constraint; the earlier load stays in place."""


@dataclass(frozen=True)
class Load:
    """What a finished load leaves behind."""

    raw: dict[str, DataFrame]
    core: dict[str, DataFrame]
    summary: DataFrame


def run_load(
    spark: SparkSession, extracts: str, warehouse: str, strict: bool = True,
    on_raw_stored: Callable[[], object] = lambda: None, **read_options
) -> Load:
    """Full refresh of ``warehouse`` from the extracts.

    Raw rows are written first.  Each entity is then computed once into a work area and read back as typed
    table and issues.  The new tables are published together, after the constraints were checked; a failed run
    deletes what it wrote and leaves the earlier ones.  The summary comes from figures observed while writing.

    ``on_raw_stored`` is called when the raw tables are stored: the extracts are not read from then on.
    """
    configure(spark)
    store = TableStore(spark, warehouse)
    version = store.begin_version()
    try:
        with shuffles_dropped(spark):
            _write_version(spark, version, extracts, read_options, on_raw_stored)
        core = version.tables()
        if strict:
            broken = check_constraints(core).where(F.col("violations") > 0).collect()
            if broken:
                raise ConstraintViolation("; ".join(f"{r.table}.{r.constraint}: {r.violations}" for r in broken))
    except BaseException:
        version.discard()
        raise
    version.publish()
    return Load(version.raw_tables(), core, store.summary(version.name))


def _write_version(
    spark: SparkSession, version: Version, extracts: str, read_options: dict, on_raw_stored: Callable[[], object] = lambda: None
) -> None:
    found = read_extracts(spark, extracts, **read_options)
    at_once(lambda table: version.write_raw(table, found[table]), found)
    on_raw_stored()
    work = version.store.begin_work(checkpoint_dir(spark))
    try:
        issues: dict[str, DataFrame] = {}

        def write(table: str) -> None:
            if table == "sources":
                version.write(table, seed_sources(spark))
                return
            # Of an entity only its issues are kept until the log is written.
            area = version.store.begin_work(checkpoint_dir(spark))
            try:
                result = TypedTables(version.raw_tables(), Spread(keep=area.keep)).result(table)
                version.write(table, result.core)
                issues[table] = work.keep(result.issues)
            finally:
                area.drop()

        # References are checked against raw tables, so no entity waits for another; the log needs them all.
        # The largest come first, so that none of them runs alone at the end.
        largest_first = sorted(LOAD_ORDER, key=version.raw_rows, reverse=True)
        alone = [table for table in largest_first if version.raw_rows(table) > ROWS_AT_ONCE]
        for table in alone:
            write(table)
        at_once(write, [*largest_first[len(alone):], "sources"])
        parts = -(-sum(map(version.raw_rows, LOAD_ORDER)) // ROWS_PER_FILE)
        version.write_log(numbered_log([issues[table] for table in LOAD_ORDER], max(1, parts)))
    finally:
        work.drop()
