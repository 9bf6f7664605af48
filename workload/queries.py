"""Registered queries: every operator of the package over the driver tables.

Each entry is (Spark callable, DuckDB SQL or None).  The callables take (spark, sf_dir), read
the driver tables whole and return a lazy DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealmill import schemas
from dealmill.functions import normalize as N
from dealmill.operators import constraints as K
from dealmill.operators.dedup import dedup_exact, dedup_latest
from dealmill.operators.references import (
    flag_before_parent,
    quarantine_orphans,
    resolve_canonical,
    resolve_fk,
)
from dealmill.operators.rules import Rule, apply_rules, flag_illegal_transitions
from dealmill.plans import catalog, load
from dealmill.plans import reports as R
from dealmill.session import at_once, checkpoint_dir, configure
from dealmill.sources.extracts import DEFAULT_TEMPLATE, read_extract, read_extracts
from dealmill.sources.json_out import to_json_rows
from dealmill.sources.store import TableStore, delete
from workload import oracle as O
from workload.views import CORE, RAW

DRIVER_TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events"]

Query = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Views(dict):
    """CRM tables over one data folder, each analysed when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, texts: dict[str, str]):
        super().__init__()
        self.spark, self.sf_dir, self.texts = spark, sf_dir, texts
        self.read: set[str] = set()

    def __missing__(self, table: str) -> DataFrame:
        for name in DRIVER_TABLES:
            if name not in self.read and f"from {name}" in self.texts[table]:
                self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").createOrReplaceTempView(name)
                self.read.add(name)
        df = self.spark.sql(self.texts[table])
        if self.texts is CORE and table in schemas.CORE_SCHEMAS:
            fields = schemas.CORE_SCHEMAS[table]
            df = df.select(*(F.col(f.name).cast(f.dataType) for f in fields))
        self[table] = df
        return df


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, the form in which both engines compare them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        )
    )


def register(name: str, sql: str | None, views: dict[str, str] = RAW):
    """Register a function of the CRM tables under ``name``."""

    def wrap(function: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(function(Views(spark, sf_dir, views)))

        SPARK[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return wrap


ISSUE_COLUMNS = ["entity", "entity_id", "issue_type", "action"]


def bare(issues: DataFrame) -> DataFrame:
    """Issues without prose, which has no counterpart in the SQL."""
    return issues.select(*ISSUE_COLUMNS)


# ---------------------------------------------------------------- cleaning


@register("norm_source", f"""{O.raw('marketing_costs')}
    select id, source, {O.channel('source')} as code, {O.channel_id('source')} as source_id,
        {O.channel_unknown('source')} as unknown, {O.channel_respelled('source')} as rewritten
    from raw_marketing_costs""")
def _(raw: Views) -> DataFrame:
    return N.clean(raw["marketing_costs"], {"source": N.CHANNEL}).select(
        "id", "source", F.col("source__v").alias("code"), F.col("source__id").alias("source_id"),
        F.col("source__unknown").alias("unknown"), F.col("source__rewritten").alias("rewritten"),
    )


@register("norm_timestamp", f"""{O.raw('stage_history')}
    select id, changed_at as cell, {O.ts('changed_at')} as value, {O.odd_date('changed_at')} as nonstandard
    from raw_stage_history""")
def _(raw: Views) -> DataFrame:
    return N.clean(raw["stage_history"], {"changed_at": N.TIMESTAMP}).select(
        "id", F.col("changed_at").alias("cell"), F.col("changed_at__v").alias("value"),
        F.col("changed_at__nonstandard").alias("nonstandard"),
    )


@register("norm_date", f"""{O.raw('payments')}
    select payment_id, payment_date as cell, {O.dt('payment_date')} as value,
        {O.odd_date('payment_date')} as nonstandard
    from raw_payments""")
def _(raw: Views) -> DataFrame:
    return N.clean(raw["payments"], {"payment_date": N.DATE}).select(
        "payment_id", F.col("payment_date").alias("cell"), F.col("payment_date__v").alias("value"),
        F.col("payment_date__nonstandard").alias("nonstandard"),
    )


@register("norm_phone", f"""{O.raw('contacts')}
    select contact_id, phone as cell, {O.phone('phone')} as value, {O.phone_status('phone')} as status
    from raw_contacts""")
def _(raw: Views) -> DataFrame:
    return N.clean(raw["contacts"], {"phone": N.PHONE}).select(
        "contact_id", F.col("phone").alias("cell"), F.col("phone__v").alias("value"),
        F.col("phone__status").alias("status"),
    )


@register("norm_amount", f"""{O.raw('deal_products')}
    select id, unit_price, discount, {O.money('unit_price')} as price, {O.money('discount')} as parsed_discount,
        cast(coalesce({O.number('discount')}, 0) as decimal(14,2)) as discount_or_zero
    from raw_deal_products""")
def _(raw: Views) -> DataFrame:
    cells = raw["deal_products"].withColumn("or_zero", F.col("discount"))
    cleaned = N.clean(cells, {"unit_price": N.AMOUNT, "discount": N.AMOUNT, "or_zero": N.DISCOUNT})
    return cleaned.select(
        "id", "unit_price", "discount",
        N.to_money(F.col("unit_price__v")).alias("price"),
        N.to_money(F.col("discount__v")).alias("parsed_discount"),
        N.to_money(F.col("or_zero__v")).alias("discount_or_zero"),
    )


# Whole and broken numbers: the digits of deal keys, amounts with decimals, blanks.
@register("norm_int", f"""{O.raw('deals')}
    select id, cell, try_cast(case when regexp_full_match(trim(cell), '[+-]?[0-9]+') then trim(cell) end as integer)
        as value
    from (select id, case when id % 3 = 0 then ' ' || substr(deal_id, 2) || ' ' when id % 3 = 1 then expected_amount
                          else currency end as cell from raw_deals) r""")
def _(raw: Views) -> DataFrame:
    cells = raw["deals"].select(
        "id",
        F.when(F.col("id") % 3 == 0, F.concat(F.lit(" "), F.substring("deal_id", 2, 20), F.lit(" ")))
        .when(F.col("id") % 3 == 1, F.col("expected_amount"))
        .otherwise(F.col("currency"))
        .alias("cell"),
    )
    return N.clean(cells, {"cell": N.INTEGER}).select("id", "cell", F.col("cell__v").alias("value"))


@register("norm_bool", f"""{O.raw('activities')}
    select activity_id, completed as cell, {O.flag('completed')} as value from raw_activities""")
def _(raw: Views) -> DataFrame:
    return N.clean(raw["activities"], {"completed": N.FLAG}).select(
        "activity_id", F.col("completed").alias("cell"), F.col("completed__v").alias("value")
    )


@register("norm_inn", f"""{O.raw('companies')}
    select company_id, {O.nn('inn')} as inn, {O.blank('name')} as no_name, {O.blank('industry')} as no_industry
    from raw_companies""")
def _(raw: Views) -> DataFrame:
    return N.clean(raw["companies"], {"inn": N.TEXT, "name": N.TEXT, "industry": N.TEXT}).select(
        "company_id", F.col("inn__v").alias("inn"), F.col("name__blank").alias("no_name"),
        F.col("industry__blank").alias("no_industry"),
    )


@register("domain_check", f"""{O.raw('payments', 'activities', 'production_orders', 'shipments')}
    select 'payment_type' as domain, {O.coded('payment_type', O.PAYMENT_TYPES)} as value,
        {O.miscoded('payment_type', O.PAYMENT_TYPES)} as invalid, count(*) as n
    from raw_payments group by all
    union all select 'payment_status', {O.coded('status', O.PAYMENT_STATUSES)},
        {O.miscoded('status', O.PAYMENT_STATUSES)}, count(*) from raw_payments group by all
    union all select 'activity_type', {O.coded('activity_type', O.ACTIVITY_TYPES)},
        {O.miscoded('activity_type', O.ACTIVITY_TYPES)}, count(*) from raw_activities group by all
    union all select 'production_status', {O.coded('status', O.PRODUCTION_STATUSES)},
        {O.miscoded('status', O.PRODUCTION_STATUSES)}, count(*) from raw_production_orders group by all
    union all select 'shipment_status', {O.coded('status', O.SHIPMENT_STATUSES)},
        {O.miscoded('status', O.SHIPMENT_STATUSES)}, count(*) from raw_shipments group by all""")
def _(raw: Views) -> DataFrame:
    def counted(domain: str, table: str, column: str, codes: list[str]) -> DataFrame:
        return N.clean(raw[table].select(column), {column: codes}).groupBy(
            F.lit(domain).alias("domain"), F.col(f"{column}__v").alias("value"),
            F.col(f"{column}__invalid").alias("invalid"),
        ).agg(F.count(F.lit(1)).alias("n"))

    return K.union_all(
        [
            counted("payment_type", "payments", "payment_type", schemas.PAYMENT_TYPES),
            counted("payment_status", "payments", "status", schemas.PAYMENT_STATUSES),
            counted("activity_type", "activities", "activity_type", schemas.ACTIVITY_TYPES),
            counted("production_status", "production_orders", "status", schemas.PRODUCTION_STATUSES),
            counted("shipment_status", "shipments", "status", schemas.SHIPMENT_STATUSES),
        ]
    )


@register("default_currency", f"""{O.raw('deals', 'activities')}
    select 'currency' as kind, coalesce({O.nn('currency')}, 'RUB') as value, count(*) as n from raw_deals group by all
    union all select 'direction', {O.nn('direction')}, count(*) from raw_activities group by all""")
def _(raw: Views) -> DataFrame:
    def counted(table: str, column: str, kind: str) -> DataFrame:
        cells = N.clean(raw[table].select(column), {column: kind})
        return cells.groupBy(F.lit(column).alias("kind"), F.col(f"{column}__v").alias("value")).agg(
            F.count(F.lit(1)).alias("n")
        )

    return counted("deals", "currency", N.CURRENCY).unionByName(counted("activities", "direction", N.TEXT))


# ---------------------------------------------------------------- extracts


def _cells_sql(table: str) -> str:
    filled = " + ".join(f"count(nullif({c}, ''))" for c in schemas.RAW_COLUMNS[table])
    return f"select '{table}' as \"table\", count(*) as rows, {filled} as filled_cells from raw_{table}"


def _write_extract(df: DataFrame, path: str, compression: str = "none") -> None:
    # Deflating at the default level takes four times as long, for a sixth less text (measured on payments).
    df.write.option("zlib.compress.level", "BEST_SPEED").csv(
        path, compression=compression, header=True, quote='"', escape='"', nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def _write_extracts(raw: Views, template: str) -> str:
    """All raw tables as text extracts in a new shared folder, compressed: the text is many times its Parquet files."""
    folder = f"{checkpoint_dir(raw.spark)}/extracts-{uuid.uuid4().hex}"
    texts = {table: raw[table].select(*schemas.RAW_COLUMNS[table]) for table in schemas.RAW_TABLES}
    at_once(lambda table: _write_extract(texts[table], f"{folder}/{template.format(table=table)}", "gzip"), texts)
    return folder


def _rows_sql(table: str) -> str:
    cells = ", ".join(f"coalesce(nullif({c}, ''), '')" for c in schemas.RAW_COLUMNS[table])
    return f"select '{table}' as \"table\", md5(concat_ws('|', {cells})) as cells, count(*) as rows from raw_{table} group by all"


def _rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, cells, rows): every different row of the given raw tables, as a hash of its cells in order."""
    parts = []
    for table, df in tables.items():
        cells = F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("")) for c in schemas.RAW_COLUMNS[table]))
        # The 16 bytes of the hash are shuffled, and spelled out afterwards.
        counted = df.groupBy(F.unhex(F.md5(cells)).alias("hash")).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.select(F.lit(table).alias("table"), F.lower(F.hex("hash")).alias("cells"), "rows"))
    return K.union_all(parts)


_ROWS = O.raw() + " " + " union all ".join(_rows_sql(t) for t in schemas.RAW_TABLES)


@register("s1_csv_roundtrip_rows", _ROWS)
def _(raw: Views) -> DataFrame:
    return _rows(read_extracts(raw.spark, _write_extracts(raw, "{table}"), "{table}"))


# Whole raw tables written as text extracts and read back: rows, and cells that hold something.
@register("s1_csv_roundtrip_counts", O.raw() + " " + " union all ".join(_cells_sql(t) for t in schemas.RAW_TABLES))
def _(raw: Views) -> DataFrame:
    counts = []
    for table, df in read_extracts(raw.spark, _write_extracts(raw, "{table}"), "{table}").items():
        filled = " + ".join(f"count({c})" for c in schemas.RAW_COLUMNS[table])
        counts.append(df.selectExpr("count(*) as rows", f"{filled} as filled_cells").select(
            F.lit(table).alias("table"), "rows", "filled_cells"
        ))
    return K.union_all(counts)


# Tables whose rows an id and the first cell put in one order, and a cell that gets line breaks and quotes.
_ORDERED = ["companies", "deals", "stage_history", "activities", "marketing_costs"]
_BROKEN = """case when id % 3 = 0 then coalesce(subject, '') || chr(10) || 'said "yes", twice' || chr(13) || chr(10)
    when id % 7 = 0 then '"' || chr(10) || chr(10) || ',"' else subject end"""


def _places_sql(table: str, source: str) -> str:
    cells = ", ".join(f"coalesce({c}, '')" for c in schemas.RAW_COLUMNS[table])
    return f"select '{table}' as \"table\", row_number() over (order by id, {schemas.RAW_COLUMNS[table][0]}) as id, md5(concat_ws('|', {cells})) as cells from {source}"


# Rows per extract file of ``_places``; there are some files in any case.
_FILE_ROWS, _LEAST_FILES = 500_000, 7


def _places(spark: SparkSession, rows: dict[str, DataFrame]) -> DataFrame:
    """(table, id, cells) of tables written as several extract files in the order of their ids, and read again."""
    folder = f"{checkpoint_dir(spark)}/extracts-{uuid.uuid4().hex}"
    parts = []
    for table, df in rows.items():
        key = ["id", schemas.RAW_COLUMNS[table][0]]
        files = max(_LEAST_FILES, -(-df.count() // _FILE_ROWS))
        in_order = df.repartitionByRange(files, *key).sortWithinPartitions(*key).select(*schemas.RAW_COLUMNS[table])
        _write_extract(in_order, f"{folder}/{table}")
        cells = F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("")) for c in schemas.RAW_COLUMNS[table]))
        read = read_extract(spark, table, f"{folder}/{table}")
        parts.append(read.select(F.lit(table).alias("table"), "id", F.md5(cells).alias("cells")))
    return K.union_all(parts)


# Row numbers of extracts of several files follow the files, whatever the splits.
@register("s4_raw_ids", O.raw(*_ORDERED) + " " + " union all ".join(_places_sql(t, f"raw_{t}") for t in _ORDERED))
def _(raw: Views) -> DataFrame:
    return _places(raw.spark, {t: raw[t] for t in _ORDERED})


# Cells with line breaks, commas and quotes, read by many tasks.
@register("s1_line_breaks", f"""{O.raw('activities')}, broken as (select * replace ({_BROKEN} as subject) from raw_activities)
    {_places_sql('activities', 'broken')}""")
def _(raw: Views) -> DataFrame:
    return _places(raw.spark, {"activities": raw["activities"].withColumn("subject", F.expr(_BROKEN))})


# ---------------------------------------------------------------- duplicates, references, rules

_VERSIONED = f"""{O.raw('deals')},
    v as (select *, row_number() over (partition by deal_id
                                       order by {O.ts('updated_at')} desc nulls last, id desc) as version
          from raw_deals)"""


@register("dedup_latest", f"{_VERSIONED} select id, deal_id, title, updated_at, source from v where version = 1")
def _(raw: Views) -> DataFrame:
    return _deal_versions(raw).kept.select("id", "deal_id", "title", "updated_at", "source")


@register("dedup_latest_issues", f"""{_VERSIONED}
    select 'deal' as entity, l.deal_id as entity_id, 'duplicate_deal' as issue_type, 'quarantined' as action,
        'replaced row id=' || l.id || ' (updated_at=' || coalesce(l.updated_at, 'NULL') || '); kept id=' || w.id
            as details
    from v l join v w on w.deal_id = l.deal_id and w.version = 1 where l.version > 1""")
def _(raw: Views) -> DataFrame:
    return _deal_versions(raw).issues


def _deal_versions(raw: Views):
    rows = N.clean(raw["deals"], {"updated_at": N.TIMESTAMP})
    return dedup_latest(rows, "deal_id", "updated_at__v", "updated_at", "deal", "duplicate_deal")


_EVENT = "event_id, deal_id, old_stage_id, new_stage_id, changed_at, changed_by_id"


@register("dedup_exact", f"""{O.raw('stage_history')}
    select {_EVENT}, min(id) as id from raw_stage_history group by {_EVENT}""")
def _(raw: Views) -> DataFrame:
    return _events(raw).kept


@register("dedup_exact_issues", f"""{O.raw('stage_history')}
    select 'stage_history' as entity, event_id as entity_id, 'duplicate_event' as issue_type, 'quarantined' as action
    from (select event_id, row_number() over (partition by {_EVENT} order by id) as copy from raw_stage_history) r
    where copy > 1""")
def _(raw: Views) -> DataFrame:
    return bare(_events(raw).issues)


def _events(raw: Views):
    columns = schemas.RAW_COLUMNS["stage_history"]
    return dedup_exact(raw["stage_history"], columns, "stage_history", "event_id", "duplicate_event")


@register("canonical_sku", f"""{O.raw('products')}
    select product_id, sku, case when lowest <> product_id then lowest end as canonical_id
    from (select *, case when sku is not null then min(product_id) over (partition by sku) end as lowest
          from raw_products) r""")
def _(raw: Views) -> DataFrame:
    out, _ = resolve_canonical(raw["products"], "product_id", "sku")
    return out.select("product_id", "sku", "canonical_id")


@register("canonical_sku_issues", O.issues_sql("products"))
def _(raw: Views) -> DataFrame:
    return bare(resolve_canonical(raw["products"], "product_id", "sku")[1])


@register("fk_resolve_nullable", f"""{O.raw('deals', 'companies')}
    select r.id, r.deal_id, c.company_id from raw_deals r left join raw_companies c on c.company_id = r.company_id""")
def _(raw: Views) -> DataFrame:
    return _deal_company(raw)[0].select("id", "deal_id", "company_id")


@register("fk_resolve_nullable_issues", f"""{O.raw('deals', 'companies')}
    select 'deal' as entity, deal_id as entity_id, 'orphan_company' as issue_type, 'flagged' as action
    from raw_deals where not {O.blank('company_id')} and company_id not in (select company_id from raw_companies)""")
def _(raw: Views) -> DataFrame:
    return bare(_deal_company(raw)[1])


def _deal_company(raw: Views):
    return resolve_fk(
        raw["deals"], "company_id", raw["companies"], "company_id", "deal", "deal_id", "orphan_company"
    )


@register("fk_quarantine", f"""{O.raw('payments', 'deals')}
    select payment_id, deal_id, amount from raw_payments where deal_id in (select deal_id from raw_deals)""")
def _(raw: Views) -> DataFrame:
    return _payments_with_deal(raw).kept.select("payment_id", "deal_id", "amount")


@register("fk_quarantine_issues", f"""{O.raw('payments', 'deals')}
    select 'payment' as entity, payment_id as entity_id, 'orphan_deal' as issue_type, 'quarantined' as action
    from raw_payments r where not exists (select 1 from raw_deals d where d.deal_id = r.deal_id)""")
def _(raw: Views) -> DataFrame:
    return bare(_payments_with_deal(raw).issues)


def _payments_with_deal(raw: Views):
    return quarantine_orphans(
        raw["payments"], "deal_id", raw["deals"], "deal_id", "payment", "payment_id", "orphan_deal"
    )


@register("fk_quarantine_two_stage", f"""{O.with_marked('deal_products')}
    select entity_id, 'orphan_deal' as issue_type from m_deal_products where quarantined__orphan_deal
    union all select entity_id, 'orphan_product' from m_deal_products where quarantined__orphan_product""")
def _(raw: Views) -> DataFrame:
    first = quarantine_orphans(
        raw["deal_products"], "deal_id", raw["deals"], "deal_id", "deal_product", "deal_id", "orphan_deal"
    )
    second = quarantine_orphans(
        first.kept, "product_id", raw["products"], "product_id", "deal_product", "deal_id", "orphan_product"
    )
    return first.issues.unionByName(second.issues).select("entity_id", "issue_type")


@register("fsm_illegal_transitions", f"""{O.raw('stage_history')}
    select id, event_id, old_stage_id, new_stage_id,
        coalesce(old_stage_id || '>' || new_stage_id not in ({O.STEPS}), false) as has_quality_issue
    from raw_stage_history""")
def _(raw: Views) -> DataFrame:
    out, _ = flag_illegal_transitions(raw["stage_history"])
    return out.select("id", "event_id", "old_stage_id", "new_stage_id", "has_quality_issue")


@register("temporal_inconsistency", f"""{O.with_marked('production_orders')}
    select 'production_order' as entity, entity_id, 'temporal_inconsistency' as issue_type, 'flagged' as action
    from m_production_orders where keep and flagged__temporal_inconsistency""")
def _(raw: Views) -> DataFrame:
    orders = N.clean(raw["production_orders"], {"created_at": N.TIMESTAMP})
    orders = orders.withColumn("created_at", F.col("created_at__v"))
    deals = load.Parents(raw).deal_times
    _, issues = flag_before_parent(
        orders, deals, "deal_id", "created_at", "created_at", "production_order", "production_order_id"
    )
    return bare(issues)


def _company_rules(raw: Views):
    contacts = [Rule("missing_email", "flagged", N.is_blank("email"))]
    companies = [
        Rule(
            "incomplete_company", "flagged",
            " and ".join(N.is_blank(c) for c in ("name", "inn", "industry")),
        )
    ]
    return [
        apply_rules(raw["companies"], "company", "company_id", companies),
        apply_rules(raw["contacts"], "contact", "contact_id", contacts),
    ]


@register("row_predicates", f"""{O.raw('companies', 'contacts')}
    select 'company' as entity, company_id as entity_id, 'incomplete_company' as issue_type, 'flagged' as action
    from raw_companies where {O.blank('name')} and {O.blank('inn')} and {O.blank('industry')}
    union all select 'contact', contact_id, 'missing_email', 'flagged' from raw_contacts where {O.blank('email')}""")
def _(raw: Views) -> DataFrame:
    return bare(K.union_all([issues for _, issues in _company_rules(raw)]))


@register("row_flag_rollup", f"""{O.with_marked('deals')}, t as ({O.typed_select('deals', 'm_deals')})
    select stage_id, has_quality_issue, count(*) as deals from t group by stage_id, has_quality_issue""")
def _(raw: Views) -> DataFrame:
    core = _entity(raw, "deals").core
    return core.groupBy("stage_id", "has_quality_issue").agg(F.count(F.lit(1)).alias("deals"))


# ---------------------------------------------------------------- entities and the issue log


def _entity(raw: Views, table: str):
    return load.build(table, raw, load.Parents(raw))


def _register_entity(table: str) -> None:
    @register(f"e_{table.removeprefix('pipeline_')}", O.entity_sql(table))
    def _(raw: Views) -> DataFrame:
        return _entity(raw, table).core

    if O.issues_select(table, ""):

        @register(f"issues_{table}", O.issues_sql(table))
        def _(raw: Views) -> DataFrame:
            return bare(_entity(raw, table).issues)


for _table in load.LOAD_ORDER:
    _register_entity(_table)


def _loaded(raw: Views) -> load.TypedTables:
    return load.TypedTables(raw)


@register("issue_log", O.issues_sql(*O.ALL))
def _(raw: Views) -> DataFrame:
    return bare(_loaded(raw)["data_quality_issues"])


def _log(select: str) -> str:
    log = " union all ".join(p for p in (O.issues_select(t, "m_" + t) for t in O.ALL) if p)
    return f"{O.with_marked(*O.ALL)}, log as ({log}) {select}"


@register("quality_by_type", _log("select issue_type, action, count(*) as count from log group by issue_type, action"))
def _(raw: Views) -> DataFrame:
    return R.quality_by_type(_loaded(raw))


@register("quality_by_action", _log("""select a.action, count(log.action) as count
    from (values ('fixed'), ('quarantined'), ('flagged')) a(action) left join log on log.action = a.action
    group by a.action"""))
def _(raw: Views) -> DataFrame:
    return R.quality_by_action(_loaded(raw))


@register("quality_total", _log("select count(*) as total from log"))
def _(raw: Views) -> DataFrame:
    return R.quality_total(_loaded(raw))


@register("quality_pivot", _log("""select issue_type, count(*) filter (where action = 'fixed') as fixed,
    count(*) filter (where action = 'quarantined') as quarantined,
    count(*) filter (where action = 'flagged') as flagged from log group by issue_type"""))
def _(raw: Views) -> DataFrame:
    return R.quality_pivot(_loaded(raw))


@register("issue_list", _log("select entity, entity_id, issue_type, action from log"))
def _(raw: Views) -> DataFrame:
    return bare(R.issue_list(_loaded(raw)))


_RECONCILED = ", ".join(
    f"('{t}', (select count(*) from raw_{t}), (select count(*) from t_{t}), "
    f"(select count(*) from log where entity = '{O.MARKED[t][1]}' and action = 'quarantined'))"
    for t in O.ALL
)
_ALL_TYPED = O.with_typed(*O.ALL) + ", log as (" + " union all ".join(
    p for p in (O.issues_select(t, "m_" + t) for t in O.ALL) if p
) + ")"


@register("reconcile_counts", f"""{_ALL_TYPED}
    select c.*, raw_rows = core_rows + quarantined as balanced
    from (values {_RECONCILED}) c("table", raw_rows, core_rows, quarantined)""")
def _(raw: Views) -> DataFrame:
    core = _loaded(raw)
    return K.reconcile_counts({t: raw[t] for t in schemas.RAW_TABLES}, core, core["data_quality_issues"])


# The tables whose keys are compared as multisets: keys of raw rows against those of typed and quarantined ones.
def _same_keys_sql(table: str) -> str:
    key = K.RECONCILED_KEYS.get(table, schemas.CORE_SCHEMAS[table][0].name)
    left = f"select coalesce(cast({key} as varchar), '') as k from raw_{table}"
    right = (f"select coalesce(cast({key} as varchar), '') from t_{table} union all select coalesce(entity_id, '') "
             f"from log where entity = '{O.MARKED[table][1]}' and action = 'quarantined'")
    return f"not exists (({left}) except all ({right})) and not exists (({right}) except all ({left}))"


@register("reconcile_rows", f"""{_ALL_TYPED}
    select c.*, raw_rows = core_rows + quarantined as balanced, k.same_keys
    from (values {_RECONCILED}) c("table", raw_rows, core_rows, quarantined)
    join (values {", ".join(f"('{t}', ({_same_keys_sql(t)}))" for t in O.ALL)}) k("table", same_keys) using ("table")""")
def _(raw: Views) -> DataFrame:
    core = _loaded(raw)
    return K.reconcile_rows({t: raw[t] for t in schemas.RAW_TABLES}, core, core["data_quality_issues"])


@register("run_summary", f"""{_ALL_TYPED}
    {' union all '.join(f"select 'table' as kind, '{t}' as name, count(*) as rows from t_{t}" for t in O.ALL)}
    {''.join(f" union all select 'issues', '{a}', count(*) from log where action = '{a}'"
             for a in ('fixed', 'quarantined', 'flagged'))}""")
def _(raw: Views) -> DataFrame:
    return K.run_summary(_loaded(raw))


@register("catalog_counts", f"""{_ALL_TYPED}
    {' union all '.join(f"select '{t}' as name, '{schemas.LABELS[t]}' as label, count(*) as count from t_{t}"
                        for t in ['sources', *O.ALL])}
    union all select 'data_quality_issues', '{schemas.LABELS['data_quality_issues']}', count(*) from log""")
def _(raw: Views) -> DataFrame:
    return catalog.table_counts(_loaded(raw))


# The seed joined to every channel cell it stands for.
@register("s6_sources_seed", f"""{O.with_typed('marketing_costs')}
    select s.id, s.code, s.name, count(t.id) as cost_rows
    from t_sources s left join t_marketing_costs t on t.source_id = s.id group by s.id, s.code, s.name""")
def _(raw: Views) -> DataFrame:
    costs = _entity(raw, "marketing_costs").core.groupBy("source_id").agg(F.count(F.lit(1)).alias("cost_rows"))
    seed = schemas.seed_sources(raw.spark)
    return seed.join(costs, seed["id"] == costs["source_id"], "left").select(
        "id", "code", "name", F.coalesce("cost_rows", F.lit(0)).alias("cost_rows")
    )


# ---------------------------------------------------------------- extracts to published tables


def _published(raw: Views) -> TableStore:
    """A store into which the whole load was run from text extracts with their default names."""
    root = f"{checkpoint_dir(raw.spark)}/warehouse-{uuid.uuid4().hex}"
    extracts = _write_extracts(raw, DEFAULT_TEMPLATE)
    # The extracts were written for this load alone and are as large as its raw tables.
    load.run_load(raw.spark, extracts, root, strict=False, on_raw_stored=lambda: delete(raw.spark, extracts), multi_line=False)
    return TableStore(raw.spark, root)


@register("stored_load_summary", SQL["run_summary"])
def _(raw: Views) -> DataFrame:
    return _published(raw).summary()


# Counts that the published version holds beside its tables, none of which is read for them.
@register("stored_quality_by_type", SQL["quality_by_type"])
def _(raw: Views) -> DataFrame:
    return _published(raw).quality_by_type()


@register("stored_catalog_counts", SQL["catalog_counts"])
def _(raw: Views) -> DataFrame:
    return _published(raw).table_counts()


# The first rows by key of a published table, from its first files; the cutoff from what was observed while writing.
@register("stored_table_preview", f"{O.with_typed('stage_history')} select * from t_stage_history order by event_id limit 500")
def _(raw: Views) -> DataFrame:
    return catalog.preview_published(_published(raw), "stage_history")


@register("stored_cutoff", O.over_load(O.TODAY_TABLES, [O.today("t_")], "select day as cutoff_date from today"))
def _(raw: Views) -> DataFrame:
    return _published(raw).cutoff_date()


# Every stored table against what was written: rows and content.
@register("stored_load_intact", f"""{_ALL_TYPED}
    {' union all '.join(f"select 'raw' as layer, '{t}' as \"table\", count(*) as rows, count(*) as written, true as intact from raw_{t}"
                        for t in O.ALL)}
    {''.join(f" union all select 'core', '{t}', count(*), count(*), true from t_{t}" for t in ['sources', *O.ALL])}
    union all select 'core', 'data_quality_issues', count(*), count(*), true from log""")
def _(raw: Views) -> DataFrame:
    return _published(raw).verify()


@register("stored_load_issue_log", SQL["issue_log"])
def _(raw: Views) -> DataFrame:
    return bare(_published(raw).core("data_quality_issues"))


# Issue ids of a load follow the order of the log, so that loads of the same input agree.
@register("stored_load_issue_ids", _log("""select row_number() over (order by entity nulls first, entity_id nulls first, issue_type, action) as id,
    entity, entity_id, issue_type, action from log"""))
def _(raw: Views) -> DataFrame:
    return _published(raw).core("data_quality_issues").select("id", *ISSUE_COLUMNS)


@register("stored_load_raw", _ROWS)
def _(raw: Views) -> DataFrame:
    store = _published(raw)
    return _rows({table: store.raw(table) for table in schemas.RAW_TABLES})


# ---------------------------------------------------------------- reports end to end

_AMOUNTS, _TODAY = [O.amounts("t_")], [O.today("t_")]


@register("load_funnel", O.over_load([*O.AMOUNT_TABLES, "pipeline_stages"], _AMOUNTS, O.funnel("t_")))
def _(raw: Views) -> DataFrame:
    return R.funnel(_loaded(raw))


@register("load_managers", O.over_load([*O.AMOUNT_TABLES, "users"], _AMOUNTS, O.managers("t_")))
def _(raw: Views) -> DataFrame:
    return R.managers(_loaded(raw))


@register("load_receivables", O.over_load([*O.AMOUNT_TABLES, "payments"], _AMOUNTS, O.receivables("t_")))
def _(raw: Views) -> DataFrame:
    return R.receivables(_loaded(raw))


@register("load_sources", O.over_load([*O.AMOUNT_TABLES, "marketing_costs"], _AMOUNTS, O.channels("t_")))
def _(raw: Views) -> DataFrame:
    return R.sources_report(_loaded(raw))


@register("load_stale_deals", O.over_load(O.TODAY_TABLES, _TODAY, O.stale("t_", 14)))
def _(raw: Views) -> DataFrame:
    return R.stale_deals(_loaded(raw))


@register("load_production_delays", O.over_load(O.TODAY_TABLES, _TODAY, O.delays("t_")))
def _(raw: Views) -> DataFrame:
    return R.production_delays(_loaded(raw))


# ---------------------------------------------------------------- reports over typed tables

_AMOUNTS, _TODAY = [O.amounts("c_")], [O.today("c_")]


def _amount_sql(select: str, *more: str) -> str:
    return O.over_core([*O.AMOUNT_TABLES, *more], _AMOUNTS, select)


def _today_sql(select: str, *more: str) -> str:
    return O.over_core([*O.TODAY_TABLES, *more], _TODAY, select)


@register("lines", _amount_sql(
    f"select deal_id, cast(income as {O.M}) as revenue, cast(spent as {O.M}) as cost from sold"), CORE)
def _(core: Views) -> DataFrame:
    return R.deal_lines(core).select(
        "deal_id", F.col("revenue").cast(R.SUM_TYPE).alias("revenue"), F.col("cost").cast(R.SUM_TYPE).alias("cost")
    )


@register("deal_amount", _amount_sql("""select deal_id, stage_id, manager_id, source_id, expected_amount,
    line_revenue, line_margin, amount from priced"""), CORE)
def _(core: Views) -> DataFrame:
    return R.deal_amount(core)


@register("cutoff", _today_sql("select day as cutoff_date from today"), CORE)
def _(core: Views) -> DataFrame:
    return R.cutoff_date(core)


@register("funnel", _amount_sql(O.funnel("c_"), "pipeline_stages"), CORE)
def _(core: Views) -> DataFrame:
    return R.funnel(core)


@register("funnel_totals", _amount_sql(f"""select cast(sum(deals) as bigint) as deals,
    cast(coalesce(sum(amount), 0) as {O.M}) as amount from ({O.funnel('c_')}) f""", "pipeline_stages"), CORE)
def _(core: Views) -> DataFrame:
    return R.funnel_totals(core)


@register("managers", _amount_sql(O.managers("c_"), "users"), CORE)
def _(core: Views) -> DataFrame:
    return R.managers(core)


@register("shipped_not_closed", _amount_sql("""select x.deal_id, x.manager_id, u.name as manager_name, x.amount,
    x.line_margin as margin from priced x left join c_users u on u.user_id = x.manager_id
    where x.stage_id = 'SHIPPED'""", "users"), CORE)
def _(core: Views) -> DataFrame:
    return R.shipped_not_closed(core)


@register("receivables", _amount_sql(O.receivables("c_"), "payments"), CORE)
def _(core: Views) -> DataFrame:
    return R.receivables(core)


@register("receivables_totals", _amount_sql("select " + ", ".join(
    f"cast(coalesce(sum({c}), 0) as {O.M}) as {c}" for c in R.RECEIVABLE_SUMS
) + f" from ({O.receivables('c_')}) r", "payments"), CORE)
def _(core: Views) -> DataFrame:
    return R.receivables_totals(core)


@register("overpaid", _amount_sql(
    f"select *, coalesce(balance < 0, false) as overpaid from ({O.receivables('c_')}) r", "payments"), CORE)
def _(core: Views) -> DataFrame:
    return R.overpaid(core)


@register("production_delays", _today_sql(O.delays("c_")), CORE)
def _(core: Views) -> DataFrame:
    return R.production_delays(core)


@register("stale_deals", _today_sql(O.stale("c_", 14)), CORE)
def _(core: Views) -> DataFrame:
    return R.stale_deals(core)


@register("stale_deals_7", _today_sql(O.stale("c_", 7)), CORE)
def _(core: Views) -> DataFrame:
    return R.run_report(core, "stale-deals", n_days=7)


@register("sources_romi", _amount_sql(O.channels("c_"), "sources", "marketing_costs"), CORE)
def _(core: Views) -> DataFrame:
    return R.sources_report(core)


@register("plan_fact_gap", _amount_sql(f"""select deal_id, cast(expected_amount as {O.M}) as expected_amount,
    line_revenue, cast(expected_amount - line_revenue as {O.M}) as gap from priced
    where line_revenue is not null"""), CORE)
def _(core: Views) -> DataFrame:
    return R.plan_fact_gap(core)


@register("table_preview", f"{O.core('deals')} select * from c_deals order by deal_id limit 500", CORE)
def _(core: Views) -> DataFrame:
    return catalog.preview(core, "deals")


@register("json_render", f"""{O.core('payments')}
    select '{{"payment_id":"' || payment_id || '","deal_id":"' || deal_id || '","payment_date":"'
        || cast(payment_date as varchar) || '","amount":"' || cast(amount as varchar) || '","payment_type":"'
        || payment_type || '","status":"' || status || '","has_quality_issue":false}}' as json
    from c_payments""", CORE)
def _(core: Views) -> DataFrame:
    return to_json_rows(core["payments"])


def _json_sql(table: str) -> str:
    """The JSON text of a typed row, cell by cell."""
    def cell(f: T.StructField) -> str:
        c = f.name
        if isinstance(f.dataType, T.StringType):
            text = f"""'"' || replace(replace({c}, '\\', '\\\\'), '"', '\\"') || '"'"""
        elif isinstance(f.dataType, T.TimestampType):
            whole = f"strftime({c}, '%Y-%m-%dT%H:%M:%S') || case when date_trunc('second', {c}) = {c} then '' else strftime({c}, '.%f') end"
            text = f"""'"' || {whole} || '+00:00"'"""
        elif isinstance(f.dataType, (T.DecimalType, T.DateType)):
            kind = f.dataType.simpleString()
            text = f"""'"' || cast(cast({c} as {kind}) as varchar) || '"'"""
        else:
            text = f"cast({c} as varchar)"
        return f"""'"{c}":' || coalesce({text}, 'null')"""

    cells = " || ',' || ".join(cell(f) for f in schemas.CORE_SCHEMAS[table])
    return f"select '{table}' as \"table\", '{{' || {cells} || '}}' as json from c_{table}"


_JSON_TABLES = ["deals", "activities", "marketing_costs"]


# NULLs, instants, whole numbers, flags, and texts with quotes in them.
@register("json_all_kinds", f"{O.core(*_JSON_TABLES)} " + " union all ".join(map(_json_sql, _JSON_TABLES)), CORE)
def _(core: Views) -> DataFrame:
    return K.union_all([to_json_rows(core[t]).select(F.lit(t).alias("table"), "json") for t in _JSON_TABLES])


def _constraint_sql() -> str:
    parts = []
    for table, spec in schemas.CONSTRAINTS.items():
        if table not in CORE:
            continue
        for c in spec.not_null:
            parts.append(f"select '{table}' as \"table\", '{c}_not_null' as \"constraint\", 'not_null' as kind, "
                         f"count(*) filter (where {c} is null) as violations from c_{table}")
        for c, values in spec.domains:
            allowed = ", ".join(f"'{v}'" for v in values)
            parts.append(f"select '{table}', '{c}_domain', 'check', count(*) filter (where {c} not in ({allowed})) "
                         f"from c_{table}")
        for c, kind in [(spec.primary_key, "primary_key"), *((u, "unique") for u in spec.unique)]:
            parts.append(f"select '{table}', '{c}_{kind}', '{kind}', count(*) from "
                         f"(select {c} from c_{table} group by {c} having count(*) > 1 and {c} is not null) k")
        for c, parent, key in spec.references:
            parts.append(f"select '{table}', '{c}_to_{parent}', 'foreign_key', count(*) from c_{table} x "
                         f"where {c} is not null and not exists (select 1 from c_{parent} p where p.{key} = x.{c})")
    return O.core() + " " + " union all ".join(parts)


@register("constraint_violations", _constraint_sql(), CORE)
def _(core: Views) -> DataFrame:
    return K.check_constraints({table: core[table] for table in CORE})
