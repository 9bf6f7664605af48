"""Declared tables, value domains and constraints.  Nothing here is ever inferred from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- raw extracts

# Column names of the 13 text extracts, in header order.
RAW_COLUMNS: dict[str, list[str]] = {
    "users": ["user_id", "name", "role", "active", "department", "email"],
    "companies": ["company_id", "name", "inn", "city", "industry", "created_at"],
    "contacts": ["contact_id", "company_id", "name", "phone", "email", "created_at"],
    "products": ["product_id", "sku", "name", "category", "cost_price", "is_active"],
    "pipeline_stages": ["pipeline_id", "stage_id", "stage_name", "sort_order", "is_final", "is_success"],
    "deals": [
        "deal_id", "title", "created_at", "updated_at", "stage_id", "manager_id", "company_id",
        "contact_id", "source", "expected_amount", "currency", "closed_at", "lost_reason",
        "custom_deadline",
    ],
    "deal_products": ["deal_id", "product_id", "quantity", "unit_price", "discount"],
    "payments": ["payment_id", "deal_id", "payment_date", "amount", "payment_type", "status"],
    "stage_history": ["event_id", "deal_id", "old_stage_id", "new_stage_id", "changed_at", "changed_by_id"],
    "activities": [
        "activity_id", "deal_id", "activity_type", "direction", "subject", "responsible_user_id",
        "completed", "deadline_at", "completed_at",
    ],
    "production_orders": [
        "production_order_id", "deal_id", "created_at", "planned_finish_at", "actual_finish_at",
        "status", "workshop",
    ],
    "shipments": ["shipment_id", "deal_id", "planned_date", "actual_date", "status"],
    "marketing_costs": ["cost_date", "source", "campaign", "cost_amount", "currency"],
}

RAW_TABLES = list(RAW_COLUMNS)


def raw_schema(table: str) -> T.StructType:
    """Row id plus text columns of one raw table."""
    return T.StructType(
        [T.StructField("id", T.LongType())]
        + [T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]]
    )


# ---------------------------------------------------------------- typed tables

MONEY = T.DecimalType(14, 2)

STRING, BOOL, DATE, TIME = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()
INT, LONG = T.IntegerType(), T.LongType()

# Columns and types of the 15 typed tables.
CORE_SCHEMAS: dict[str, T.StructType] = {
    "sources": T.StructType([
        T.StructField("id", INT, nullable=False),
        T.StructField("code", STRING, nullable=False),
        T.StructField("name", STRING),
    ]),
    "users": T.StructType([
        T.StructField("user_id", STRING, nullable=False),
        T.StructField("name", STRING),
        T.StructField("role", STRING),
        T.StructField("active", BOOL),
        T.StructField("department", STRING),
        T.StructField("email", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "companies": T.StructType([
        T.StructField("company_id", STRING, nullable=False),
        T.StructField("name", STRING),
        T.StructField("inn", STRING),
        T.StructField("city", STRING),
        T.StructField("industry", STRING),
        T.StructField("created_at", TIME),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "contacts": T.StructType([
        T.StructField("contact_id", STRING, nullable=False),
        T.StructField("company_id", STRING),
        T.StructField("name", STRING),
        T.StructField("phone", STRING),
        T.StructField("email", STRING),
        T.StructField("created_at", TIME),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "products": T.StructType([
        T.StructField("product_id", STRING, nullable=False),
        T.StructField("sku", STRING),
        T.StructField("name", STRING),
        T.StructField("category", STRING),
        T.StructField("cost_price", MONEY),
        T.StructField("is_active", BOOL),
        T.StructField("canonical_id", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "pipeline_stages": T.StructType([
        T.StructField("stage_id", STRING, nullable=False),
        T.StructField("pipeline_id", STRING),
        T.StructField("stage_name", STRING),
        T.StructField("sort_order", INT),
        T.StructField("is_final", BOOL),
        T.StructField("is_success", BOOL),
    ]),
    "deals": T.StructType([
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("title", STRING),
        T.StructField("created_at", TIME),
        T.StructField("updated_at", TIME),
        T.StructField("closed_at", TIME),
        T.StructField("custom_deadline", DATE),
        T.StructField("stage_id", STRING),
        T.StructField("manager_id", STRING),
        T.StructField("company_id", STRING),
        T.StructField("contact_id", STRING),
        T.StructField("source_id", INT),
        T.StructField("expected_amount", MONEY),
        T.StructField("currency", STRING, nullable=False),
        T.StructField("lost_reason", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "deal_products": T.StructType([
        T.StructField("id", LONG, nullable=False),
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("product_id", STRING, nullable=False),
        T.StructField("quantity", MONEY),
        T.StructField("unit_price", MONEY),
        T.StructField("discount", MONEY, nullable=False),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "payments": T.StructType([
        T.StructField("payment_id", STRING, nullable=False),
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("payment_date", DATE),
        T.StructField("amount", MONEY),
        T.StructField("payment_type", STRING),
        T.StructField("status", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "stage_history": T.StructType([
        T.StructField("event_id", STRING, nullable=False),
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("old_stage_id", STRING),
        T.StructField("new_stage_id", STRING),
        T.StructField("changed_at", TIME),
        T.StructField("changed_by_id", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "activities": T.StructType([
        T.StructField("activity_id", STRING, nullable=False),
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("activity_type", STRING),
        T.StructField("direction", STRING),
        T.StructField("subject", STRING),
        T.StructField("responsible_user_id", STRING),
        T.StructField("completed", BOOL),
        T.StructField("deadline_at", TIME),
        T.StructField("completed_at", TIME),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "production_orders": T.StructType([
        T.StructField("production_order_id", STRING, nullable=False),
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("created_at", TIME),
        T.StructField("planned_finish_at", DATE),
        T.StructField("actual_finish_at", DATE),
        T.StructField("status", STRING),
        T.StructField("workshop", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "shipments": T.StructType([
        T.StructField("shipment_id", STRING, nullable=False),
        T.StructField("deal_id", STRING, nullable=False),
        T.StructField("planned_date", DATE),
        T.StructField("actual_date", DATE),
        T.StructField("status", STRING),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "marketing_costs": T.StructType([
        T.StructField("id", LONG, nullable=False),
        T.StructField("cost_date", DATE),
        T.StructField("source_id", INT),
        T.StructField("campaign", STRING),
        T.StructField("cost_amount", MONEY),
        T.StructField("currency", STRING, nullable=False),
        T.StructField("has_quality_issue", BOOL, nullable=False),
    ]),
    "data_quality_issues": T.StructType([
        T.StructField("id", LONG, nullable=False),
        T.StructField("entity", STRING, nullable=False),
        T.StructField("entity_id", STRING),
        T.StructField("issue_type", STRING, nullable=False),
        T.StructField("action", STRING, nullable=False),
        T.StructField("details", STRING),
        T.StructField("detected_at", TIME, nullable=False),
    ]),
}
CORE_TABLES = list(CORE_SCHEMAS)

PRIMARY_KEYS: dict[str, str] = {name: schema[0].name for name, schema in CORE_SCHEMAS.items()}

# Display labels of the typed tables.
LABELS = {
    "sources": "Источники (каналы)",
    "users": "Сотрудники",
    "companies": "Компании",
    "contacts": "Контакты",
    "products": "Товары",
    "pipeline_stages": "Стадии воронки",
    "deals": "Сделки",
    "deal_products": "Позиции сделок",
    "payments": "Оплаты",
    "stage_history": "История стадий",
    "activities": "Активности",
    "production_orders": "Производственные заказы",
    "shipments": "Отгрузки",
    "marketing_costs": "Маркетинговые затраты",
    "data_quality_issues": "Проблемы качества",
}

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

# Columns that say when something happened; plans do not count.
FACT_DATES = [
    ("deals", "updated_at"), ("payments", "payment_date"), ("shipments", "actual_date"), ("activities", "completed_at"),
    ("stage_history", "changed_at"), ("production_orders", "actual_finish_at"),
]

# ---------------------------------------------------------------- value domains

# Canonical channels (ids 1..6 in this order), their names and other spellings.
SOURCE_SEED = [
    ("avito", "Avito"),
    ("website", "Сайт"),
    ("yandex_direct", "Яндекс.Директ"),
    ("phone", "Телефон"),
    ("referral", "Рекомендации"),
    ("telegram", "Telegram"),
]
SOURCE_ALIASES = {"авито": "avito", "сайт": "website"}

# Allowed codes per column.
PAYMENT_TYPES = ["prepayment", "full", "correction", "unknown"]
PAYMENT_STATUSES = ["paid", "pending"]
ACTIVITY_TYPES = ["call", "email", "task"]
PRODUCTION_STATUSES = ["planned", "in_progress", "done"]
SHIPMENT_STATUSES = ["planned", "shipped"]
ACTIONS = ["fixed", "quarantined", "flagged"]

# What the issue log may name.
ISSUE_TYPES = [
    "discount_exceeds_line", "duplicate_deal", "duplicate_event", "duplicate_sku", "illegal_transition",
    "inactive_manager", "incomplete_company",
    "invalid_activity_type", "invalid_payment_status", "invalid_payment_type", "invalid_production_status",
    "invalid_shipment_status", "missing_company", "missing_currency", "missing_email", "missing_manager",
    "negative_amount", "nonstandard_date", "normalized_phone", "normalized_source", "orphan_company", "orphan_contact",
    "orphan_deal", "orphan_manager", "orphan_product", "orphan_stage", "orphan_user", "temporal_inconsistency",
    "unknown_payment_type", "unknown_source", "unnormalized_phone", "won_without_close_date",
]

# Stages in selling order, then the two closing stages.
OPEN_STAGES = ["NEW", "QUALIFICATION", "CALCULATION", "PROPOSAL", "CONTRACT", "PRODUCTION", "SHIPPED"]
CLOSING_STAGES = ["WON", "LOST"]
COMMITTED_STAGES = ["CONTRACT", "PRODUCTION", "SHIPPED", "WON"]

# A deal moves one stage forward at a time and may close from any open stage.
TRANSITIONS: list[tuple[str, str]] = list(zip(OPEN_STAGES, OPEN_STAGES[1:])) + [
    (stage, closing) for stage in OPEN_STAGES for closing in CLOSING_STAGES
]

DATA_TIME_ZONE = "+05:00"
DEFAULT_CURRENCY = "RUB"


def seed_sources(spark: SparkSession) -> DataFrame:
    """The six canonical channels with ids in seed order."""
    rows = [(i, code, name) for i, (code, name) in enumerate(SOURCE_SEED, start=1)]
    return spark.createDataFrame(rows, CORE_SCHEMAS["sources"])


# ---------------------------------------------------------------- constraints


@dataclass(frozen=True)
class Constraints:
    """What must hold for one typed table."""

    primary_key: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    domains: tuple[tuple[str, tuple[str, ...]], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent key)


_DEAL = ("deal_id", "deals", "deal_id")

_DOMAINS = {
    "payments": (("payment_type", PAYMENT_TYPES), ("status", PAYMENT_STATUSES)),
    "activities": (("activity_type", ACTIVITY_TYPES),),
    "production_orders": (("status", PRODUCTION_STATUSES),),
    "shipments": (("status", SHIPMENT_STATUSES),),
    "data_quality_issues": (("action", ACTIONS),),
}

# Foreign keys of the typed tables.
_REFERENCES = {
    "contacts": [("company_id", "companies", "company_id")],
    "products": [("canonical_id", "products", "product_id")],
    "deals": [
        ("stage_id", "pipeline_stages", "stage_id"),
        ("manager_id", "users", "user_id"),
        ("company_id", "companies", "company_id"),
        ("contact_id", "contacts", "contact_id"),
        ("source_id", "sources", "id"),
    ],
    "deal_products": [_DEAL, ("product_id", "products", "product_id")],
    "payments": [_DEAL],
    "stage_history": [
        _DEAL,
        ("old_stage_id", "pipeline_stages", "stage_id"),
        ("new_stage_id", "pipeline_stages", "stage_id"),
        ("changed_by_id", "users", "user_id"),
    ],
    "activities": [_DEAL, ("responsible_user_id", "users", "user_id")],
    "production_orders": [_DEAL],
    "shipments": [_DEAL],
    "marketing_costs": [("source_id", "sources", "id")],
}

CONSTRAINTS: dict[str, Constraints] = {
    name: Constraints(
        primary_key=PRIMARY_KEYS[name],
        not_null=tuple(f.name for f in schema if not f.nullable),
        unique=("code",) if name == "sources" else (),
        domains=tuple((column, tuple(values)) for column, values in _DOMAINS.get(name, ())),
        references=tuple(_REFERENCES.get(name, ())),
    )
    for name, schema in CORE_SCHEMAS.items()
}
