"""Plain DuckDB SQL for every registered query, written apart from the Spark code."""

from __future__ import annotations

from workload.views import CORE, RAW

BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"


# ---------------------------------------------------------------- cells


def nn(cell: str) -> str:
    return f"nullif(trim({cell}, {BLANKS}), '')"


def blank(cell: str) -> str:
    return f"({nn(cell)} is null)"


def _spellings(cell: str) -> list[tuple[str, int]]:
    """(wall-clock reading, minutes east of UTC) per accepted spelling; the first five are standard."""
    s = nn(cell)
    return [
        (f"try_strptime({s}, '%Y-%m-%dT%H:%M:%SZ')", 0),
        (f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S+05:00')", 300),
        (f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S-03:30')", -210),
        (f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S+0900')", 540),
        (f"try_strptime({s}, '%Y-%m-%d')", 300),
        (f"try_strptime({s}, '%Y/%m/%d')", 300),
        (f"try_strptime({s}, '%d.%m.%Y %H:%M')", 300),
        (f"try_strptime({s}, '%d.%m.%Y')", 300),
    ]


def ts(cell: str) -> str:
    return "coalesce(" + ", ".join(f"{wall} - interval ({m}) minute" for wall, m in _spellings(cell)) + ")"


def dt(cell: str) -> str:
    return "cast(coalesce(" + ", ".join(wall for wall, _ in _spellings(cell)) + ") as date)"


def odd_date(cell: str) -> str:
    standard = "coalesce(" + ", ".join(wall for wall, _ in _spellings(cell)[:5]) + ")"
    return f"({nn(cell)} is not null and {standard} is null)"


def number(cell: str) -> str:
    return f"try_cast(trim({cell}, {BLANKS}) as decimal(38,10))"


def money(cell: str) -> str:
    return f"cast({number(cell)} as decimal(14,2))"


def flag(cell: str) -> str:
    w = f"lower(trim({cell}, {BLANKS}))"
    return f"(case when {w} in ('true','1','yes','t') then true when {w} in ('false','0','no','f') then false end)"


def channel(cell: str) -> str:
    k = f"lower({nn(cell)})"
    return f"(case {k} when 'авито' then 'avito' when 'сайт' then 'website' else {k} end)"


CHANNELS = "('avito','website','yandex_direct','phone','referral','telegram')"


def channel_id(cell: str) -> str:
    return (
        f"cast(case {channel(cell)} when 'avito' then 1 when 'website' then 2 when 'yandex_direct' then 3 "
        "when 'phone' then 4 when 'referral' then 5 when 'telegram' then 6 end as integer)"
    )


def channel_unknown(cell: str) -> str:
    return f"coalesce({channel(cell)} not in {CHANNELS}, false)"


def channel_respelled(cell: str) -> str:
    return f"coalesce({channel(cell)} in {CHANNELS} and {channel(cell)} <> {nn(cell)}, false)"


def digits(cell: str) -> str:
    return f"regexp_replace({cell}, '[^0-9]', '', 'g')"


def phone(cell: str) -> str:
    d = digits(cell)
    return f"(case when regexp_full_match({d}, '[78][0-9]{{10}}') then '+7' || substr({d}, 2) else {nn(cell)} end)"


def phone_status(cell: str) -> str:
    return (
        f"(case when {nn(cell)} is null then null "
        f"when not regexp_full_match({digits(cell)}, '[78][0-9]{{10}}') then 'unrecognized' "
        f"when not starts_with({nn(cell)}, '+7') then 'fixed' end)"
    )


def coded(cell: str, codes: str) -> str:
    return f"(case when {nn(cell)} in ({codes}) then {nn(cell)} end)"


def miscoded(cell: str, codes: str) -> str:
    return f"coalesce({nn(cell)} not in ({codes}), false)"


PAYMENT_TYPES = "'prepayment','full','correction','unknown'"
PAYMENT_STATUSES = "'paid','pending'"
ACTIVITY_TYPES = "'call','email','task'"
PRODUCTION_STATUSES = "'planned','in_progress','done'"
SHIPMENT_STATUSES = "'planned','shipped'"
STEPS = ", ".join(
    f"'{a}>{b}'"
    for a, b in [
        ("NEW", "QUALIFICATION"), ("QUALIFICATION", "CALCULATION"), ("CALCULATION", "PROPOSAL"),
        ("PROPOSAL", "CONTRACT"), ("CONTRACT", "PRODUCTION"), ("PRODUCTION", "SHIPPED"),
    ]
    + [(s, end) for s in ("NEW", "QUALIFICATION", "CALCULATION", "PROPOSAL", "CONTRACT", "PRODUCTION", "SHIPPED")
       for end in ("WON", "LOST")]
)


def ctes(views: dict[str, str], prefix: str, *names: str) -> str:
    return ", ".join(f"{prefix}{n} as ({views[n]})" for n in (names or views))


def raw(*names: str) -> str:
    return "with " + ctes(RAW, "raw_", *names)


def core(*names: str) -> str:
    return "with " + ctes(CORE, "c_", *names)


# ---------------------------------------------------------------- marked rows per entity

# Each entry: the raw tables it reads and a SELECT giving typed columns, "keep", and one
# boolean per issue type named "<action>__<issue_type>".  Booleans are read only where kept,
# except the quarantining ones.

MARKED: dict[str, tuple[list[str], str, str]] = {}


def _marked(table: str, entity: str, reads: list[str], select: str) -> None:
    MARKED[table] = (reads, entity, select)


_marked("users", "user", ["users"], f"""
    select user_id, name, role, {flag('active')} as active, department, email, true as keep,
        user_id as entity_id
    from raw_users""")

_marked("companies", "company", ["companies"], f"""
    select company_id, name, {nn('inn')} as inn, city, industry, {ts('created_at')} as created_at, true as keep,
        company_id as entity_id,
        {blank('name')} and {blank('inn')} and {blank('industry')} as flagged__incomplete_company
    from raw_companies""")

_marked("contacts", "contact", ["contacts", "companies"], f"""
    select contact_id, case when known then r.company_id end as company_id, name, {phone('phone')} as phone, email,
        {ts('created_at')} as created_at, true as keep, contact_id as entity_id,
        not {blank('r.company_id')} and not known as flagged__orphan_company,
        coalesce({phone_status('phone')} = 'fixed', false) as fixed__normalized_phone,
        coalesce({phone_status('phone')} = 'unrecognized', false) as flagged__unnormalized_phone,
        {blank('email')} as flagged__missing_email
    from (select *, coalesce(company_id in (select company_id from raw_companies), false) as known
          from raw_contacts) r""")

_marked("products", "product", ["products"], f"""
    select product_id, sku, name, category, {money('cost_price')} as cost_price, {flag('is_active')} as is_active,
        case when sku is not null and lowest <> product_id then lowest end as canonical_id, true as keep,
        product_id as entity_id, sku is not null and lowest <> product_id as flagged__duplicate_sku
    from (select *, min(product_id) over (partition by sku) as lowest from raw_products) r""")

_marked("pipeline_stages", "pipeline_stage", ["pipeline_stages"], f"""
    select stage_id, pipeline_id, stage_name, cast(trim(sort_order) as integer) as sort_order,
        {flag('is_final')} as is_final, {flag('is_success')} as is_success, true as keep, stage_id as entity_id
    from raw_pipeline_stages""")

_marked("deals", "deal", ["deals", "users", "companies", "contacts", "pipeline_stages"], f"""
    select deal_id, title, {ts('r.created_at')} as created_at, {ts('updated_at')} as updated_at,
        {ts('closed_at')} as closed_at, {dt('custom_deadline')} as custom_deadline,
        s.stage_id as stage_id, u.user_id as manager_id, c.company_id as company_id, p.contact_id as contact_id,
        {channel_id('source')} as source_id, {money('expected_amount')} as expected_amount,
        coalesce({nn('currency')}, 'RUB') as currency, lost_reason, version = 1 as keep, deal_id as entity_id,
        version > 1 as quarantined__duplicate_deal,
        {channel_unknown('source')} as flagged__unknown_source,
        {channel_respelled('source')} as fixed__normalized_source,
        not {blank('r.stage_id')} and s.stage_id is null as flagged__orphan_stage,
        {blank('r.manager_id')} as flagged__missing_manager,
        not {blank('r.manager_id')} and u.user_id is null as flagged__orphan_manager,
        coalesce(u.user_id is not null and u.active = false, false) as flagged__inactive_manager,
        {blank('r.company_id')} as flagged__missing_company,
        not {blank('r.company_id')} and c.company_id is null as flagged__orphan_company,
        not {blank('r.contact_id')} and p.contact_id is null as flagged__orphan_contact,
        coalesce({number('expected_amount')} < 0, false) as flagged__negative_amount,
        {blank('currency')} as fixed__missing_currency,
        {odd_date('r.created_at')} as fixed__nonstandard_date,
        coalesce(s.stage_id = 'WON', false) and {blank('closed_at')} as flagged__won_without_close_date
    from (select *, row_number() over (partition by deal_id
                                       order by {ts('updated_at')} desc nulls last, id desc) as version
          from raw_deals) r
    left join raw_pipeline_stages s on s.stage_id = r.stage_id
    left join (select user_id, {flag('active')} as active from raw_users) u on u.user_id = r.manager_id
    left join raw_companies c on c.company_id = r.company_id
    left join raw_contacts p on p.contact_id = r.contact_id""")

_marked("deal_products", "deal_product", ["deal_products", "deals", "products"], f"""
    select id, deal_id, product_id, cast(q as decimal(14,2)) as quantity, cast(price as decimal(14,2)) as unit_price,
        cast(disc as decimal(14,2)) as discount, deal_known and product_known as keep, deal_id as entity_id,
        not deal_known as quarantined__orphan_deal,
        deal_known and not product_known as quarantined__orphan_product,
        coalesce(cast(disc as decimal(18,4)) > cast(q as decimal(14,2)) * cast(price as decimal(14,2)), false)
            as flagged__discount_exceeds_line
    from (select id, deal_id, product_id, {number('quantity')} as q, {number('unit_price')} as price,
              coalesce({number('discount')}, 0) as disc,
              exists (select 1 from raw_deals d where d.deal_id = l.deal_id) as deal_known,
              exists (select 1 from raw_products p where p.product_id = l.product_id) as product_known
          from raw_deal_products l) r""")

_marked("payments", "payment", ["payments", "deals"], f"""
    select payment_id, deal_id, {dt('payment_date')} as payment_date, {money('amount')} as amount,
        {coded('payment_type', PAYMENT_TYPES)} as payment_type, {coded('status', PAYMENT_STATUSES)} as status,
        known as keep, payment_id as entity_id, not known as quarantined__orphan_deal,
        {miscoded('payment_type', PAYMENT_TYPES)} as flagged__invalid_payment_type,
        {miscoded('status', PAYMENT_STATUSES)} as flagged__invalid_payment_status,
        coalesce({nn('payment_type')} = 'unknown', false) as flagged__unknown_payment_type,
        {odd_date('payment_date')} as fixed__nonstandard_date
    from (select *, deal_id in (select deal_id from raw_deals) as known from raw_payments) r""")

_marked("stage_history", "stage_history", ["stage_history", "deals", "pipeline_stages", "users"], f"""
    select event_id, deal_id, o.stage_id as old_stage_id, n.stage_id as new_stage_id,
        {ts('changed_at')} as changed_at, u.user_id as changed_by_id, known and copy = 1 as keep,
        event_id as entity_id, not known as quarantined__orphan_deal,
        known and copy > 1 as quarantined__duplicate_event,
        coalesce(o.stage_id || '>' || n.stage_id not in ({STEPS}), false) as flagged__illegal_transition,
        not {blank('changed_by_id')} and u.user_id is null as flagged__orphan_user
    from (select *, deal_id in (select deal_id from raw_deals) as known,
              row_number() over (partition by event_id, deal_id, old_stage_id, new_stage_id, changed_at, changed_by_id
                                 order by id) as copy
          from raw_stage_history) r
    left join raw_pipeline_stages o on o.stage_id = r.old_stage_id
    left join raw_pipeline_stages n on n.stage_id = r.new_stage_id
    left join raw_users u on u.user_id = r.changed_by_id""")

_marked("activities", "activity", ["activities", "deals", "users"], f"""
    select activity_id, deal_id, {coded('activity_type', ACTIVITY_TYPES)} as activity_type,
        {nn('direction')} as direction, subject, u.user_id as responsible_user_id, {flag('completed')} as completed,
        {ts('deadline_at')} as deadline_at, {ts('completed_at')} as completed_at, known as keep,
        activity_id as entity_id, not known as quarantined__orphan_deal,
        {miscoded('activity_type', ACTIVITY_TYPES)} as flagged__invalid_activity_type,
        not {blank('responsible_user_id')} and u.user_id is null as flagged__orphan_user
    from (select *, deal_id in (select deal_id from raw_deals) as known from raw_activities) r
    left join raw_users u on u.user_id = r.responsible_user_id""")

_marked("production_orders", "production_order", ["production_orders", "deals"], f"""
    select production_order_id, r.deal_id, {ts('r.created_at')} as created_at,
        {dt('planned_finish_at')} as planned_finish_at, {dt('actual_finish_at')} as actual_finish_at,
        {coded('status', PRODUCTION_STATUSES)} as status, workshop, d.deal_id is not null as keep,
        production_order_id as entity_id, d.deal_id is null as quarantined__orphan_deal,
        {miscoded('status', PRODUCTION_STATUSES)} as flagged__invalid_production_status,
        coalesce({ts('r.created_at')} < d.created_at, false) as flagged__temporal_inconsistency
    from raw_production_orders r
    left join (select deal_id, {ts('created_at')} as created_at from raw_deals
               qualify row_number() over (partition by deal_id
                                          order by {ts('updated_at')} desc nulls last, id desc) = 1) d
        on d.deal_id = r.deal_id""")

_marked("shipments", "shipment", ["shipments", "deals"], f"""
    select shipment_id, deal_id, {dt('planned_date')} as planned_date, {dt('actual_date')} as actual_date,
        {coded('status', SHIPMENT_STATUSES)} as status, known as keep, shipment_id as entity_id,
        not known as quarantined__orphan_deal,
        {miscoded('status', SHIPMENT_STATUSES)} as flagged__invalid_shipment_status
    from (select *, deal_id in (select deal_id from raw_deals) as known from raw_shipments) r""")

_marked("marketing_costs", "marketing_cost", ["marketing_costs"], f"""
    select id, {dt('cost_date')} as cost_date, {channel_id('source')} as source_id, campaign,
        {money('cost_amount')} as cost_amount, coalesce({nn('currency')}, 'RUB') as currency, true as keep,
        cast(null as varchar) as entity_id,
        {channel_unknown('source')} as flagged__unknown_source,
        {channel_respelled('source')} as fixed__normalized_source
    from raw_marketing_costs""")

# Typed columns in output order.
COLUMNS = {
    "users": "user_id name role active department email",
    "companies": "company_id name inn city industry created_at",
    "contacts": "contact_id company_id name phone email created_at",
    "products": "product_id sku name category cost_price is_active canonical_id",
    "pipeline_stages": "stage_id pipeline_id stage_name sort_order is_final is_success",
    "deals": "deal_id title created_at updated_at closed_at custom_deadline stage_id manager_id company_id "
             "contact_id source_id expected_amount currency lost_reason",
    "deal_products": "id deal_id product_id quantity unit_price discount",
    "payments": "payment_id deal_id payment_date amount payment_type status",
    "stage_history": "event_id deal_id old_stage_id new_stage_id changed_at changed_by_id",
    "activities": "activity_id deal_id activity_type direction subject responsible_user_id completed deadline_at "
                  "completed_at",
    "production_orders": "production_order_id deal_id created_at planned_finish_at actual_finish_at status workshop",
    "shipments": "shipment_id deal_id planned_date actual_date status",
    "marketing_costs": "id cost_date source_id campaign cost_amount currency",
}


def _issue_flags(table: str) -> list[str]:
    words = MARKED[table][2].replace(",", " ").split()
    return [w for w in words if "__" in w and w.split("__")[0] in ("fixed", "flagged", "quarantined")]


def typed_select(table: str, source: str) -> str:
    columns = COLUMNS[table].split()
    if table == "pipeline_stages":
        return f"select {', '.join(columns)} from {source} where keep"
    marks = [f for f in _issue_flags(table)
             if not f.startswith("quarantined") and not f.endswith("normalized_source")]
    row_flag = " or ".join(marks) if marks and table != "marketing_costs" else "false"
    return f"select {', '.join(columns)}, ({row_flag}) as has_quality_issue from {source} where keep"


def issues_select(table: str, source: str) -> str:
    entity = MARKED[table][1]
    parts = []
    for name in _issue_flags(table):
        action, issue_type = name.split("__")
        guard = name if action == "quarantined" else f"keep and {name}"
        parts.append(
            f"select '{entity}' as entity, entity_id, '{issue_type}' as issue_type, '{action}' as action "
            f"from {source} where {guard}"
        )
    return " union all ".join(parts)


def with_marked(*tables: str) -> str:
    """WITH list of the marked rows of the given entities and everything they read."""
    reads: list[str] = []
    for t in tables:
        reads += [r for r in MARKED[t][0] if r not in reads]
    # Rows of raw tables are read several times; MATERIALIZED keeps the check quick.
    raws = ", ".join(f"raw_{r} as materialized ({RAW[r]})" for r in reads)
    return f"with {raws}, " + ", ".join(f"m_{t} as materialized ({MARKED[t][2]})" for t in tables)


def entity_sql(table: str) -> str:
    return f"{with_marked(table)} {typed_select(table, 'm_' + table)}"


def issues_sql(*tables: str) -> str:
    parts = [issues_select(t, "m_" + t) for t in tables]
    return f"{with_marked(*tables)} " + " union all ".join(p for p in parts if p)


ALL = list(MARKED)


def with_typed(*tables: str) -> str:
    """WITH list ending in typed tables ``t_<table>`` and ``t_sources``."""
    return with_marked(*tables) + ", " + ", ".join(
        f"t_{t} as ({typed_select(t, 'm_' + t)})" for t in tables
    ) + (", t_sources as (select * from (values (1,'avito','Avito'),(2,'website','Сайт'),"
         "(3,'yandex_direct','Яндекс.Директ'),(4,'phone','Телефон'),(5,'referral','Рекомендации'),"
         "(6,'telegram','Telegram')) s(id, code, name))")


# ---------------------------------------------------------------- reports over tables named <p><table>

M = "decimal(28,2)"


def amounts(p: str) -> str:
    """CTEs giving one priced row per deal, ``priced``."""
    return f"""
    sold as (select l.deal_id, sum(l.quantity * l.unit_price - l.discount) as income,
                    sum(l.quantity * g.cost_price) as spent
             from {p}deal_products l, {p}products g where g.product_id = l.product_id group by l.deal_id),
    priced as (select d.*, cast(income as {M}) as line_revenue, cast(income - spent as {M}) as line_margin,
                      cast(case when income is not null then income else expected_amount end as {M}) as amount
               from {p}deals d left join sold on sold.deal_id = d.deal_id)"""


def today(p: str) -> str:
    return f"""
    today as (select max(happened) as day from (
        select cast(max(updated_at) as date) as happened from {p}deals
        union all select max(payment_date) from {p}payments
        union all select max(actual_date) from {p}shipments
        union all select cast(max(completed_at) as date) from {p}activities
        union all select cast(max(changed_at) as date) from {p}stage_history
        union all select max(actual_finish_at) from {p}production_orders) moments)"""


def funnel(p: str) -> str:
    return f"""
    select ps.sort_order, ps.stage_id, ps.stage_name, ps.is_success,
        (select count(*) from priced x where x.stage_id = ps.stage_id) as deals,
        cast(coalesce((select sum(amount) from priced x where x.stage_id = ps.stage_id), 0) as {M}) as amount
    from {p}pipeline_stages ps
    union all
    select 999, null, 'Без стадии', null, n, cast(coalesce(total, 0) as {M})
    from (select count(*) as n, sum(amount) as total from priced where stage_id is null) z where n > 0"""


def managers(p: str) -> str:
    return f"""
    select u.user_id, u.name, u.active, count(w.deal_id) as won_deals,
        cast(coalesce(sum(w.amount), 0) as {M}) as revenue, cast(sum(w.line_margin) as {M}) as margin,
        sum(case when w.deal_id is not null and w.line_margin is null then 1 else 0 end)::bigint as won_without_margin
    from {p}users u left join (select * from priced where stage_id = 'WON') w on w.manager_id = u.user_id
    where u.role = 'sales_manager'
    group by u.user_id, u.name, u.active"""


def receivables(p: str) -> str:
    return f"""
    select deal_id, stage_id, amount, paid, pending, correction, cast(amount - paid + correction as {M}) as balance
    from (select x.deal_id, x.stage_id, x.amount,
              cast(coalesce(sum(case when y.status = 'paid' and y.payment_type in ('prepayment','full')
                                     then y.amount end), 0) as {M}) as paid,
              cast(coalesce(sum(case when y.status = 'pending' then y.amount end), 0) as {M}) as pending,
              cast(coalesce(sum(case when y.payment_type = 'correction' then y.amount end), 0) as {M}) as correction,
              count(y.payment_id) as n
          from priced x left join {p}payments y on y.deal_id = x.deal_id
          where coalesce(x.stage_id, '') <> 'LOST'
          group by x.deal_id, x.stage_id, x.amount) z
    where n > 0 or stage_id in ('CONTRACT','PRODUCTION','SHIPPED','WON')"""


def delays(p: str) -> str:
    return f"""
    select production_order_id, deal_id, status, planned_finish_at, actual_finish_at,
        cast(coalesce(actual_finish_at, day) - planned_finish_at as integer) as delay_days
    from {p}production_orders, today
    where coalesce(actual_finish_at, day) - planned_finish_at > 5"""


def stale(p: str, n_days: int) -> str:
    return f"""
    select d.deal_id, d.stage_id, last_touch, cast(day - last_touch as integer) as days_since
    from {p}deals d cross join today
    left join (select deal_id, cast(max(greatest(deadline_at, completed_at)) as date) as last_touch
               from {p}activities group by deal_id) t on t.deal_id = d.deal_id
    where coalesce(d.stage_id, '') not in ('WON','LOST') and (last_touch is null or day - last_touch > {n_days})"""


def channels(p: str) -> str:
    return f"""
    select id, code, name, deals, won_deals, revenue, margin, costs, cost_rows,
        cost_rows > 0 and costs > 0 as has_costs,
        case when cost_rows > 0 and costs > 0
             then cast(case when 2 * abs(cents % cost_cents) >= cost_cents then cents // cost_cents + sign(cents)
                       else cents // cost_cents end as double) / 10000 end as romi
    from (select *, cast((revenue - costs) * 100 as hugeint) * 10000 as cents, cast(costs * 100 as hugeint) as cost_cents from (
          select s.id, s.code, s.name,
              (select count(*) from priced x where x.source_id = s.id) as deals,
              (select count(*) from priced x where x.source_id = s.id and x.stage_id = 'WON') as won_deals,
              cast(coalesce((select sum(amount) from priced x where x.source_id = s.id and x.stage_id = 'WON'), 0)
                   as {M}) as revenue,
              cast((select sum(line_margin) from priced x where x.source_id = s.id and x.stage_id = 'WON')
                   as {M}) as margin,
              cast(coalesce((select sum(cost_amount) from {p}marketing_costs k where k.source_id = s.id), 0)
                   as {M}) as costs,
              (select count(*) from {p}marketing_costs k where k.source_id = s.id) as cost_rows
          from {p}sources s) z) y"""


AMOUNT_TABLES = ["deals", "deal_products", "products"]
TODAY_TABLES = ["deals", "payments", "shipments", "activities", "stage_history", "production_orders"]


def over_core(tables: list[str], parts: list[str], select: str) -> str:
    wanted = list(dict.fromkeys(tables))
    return f"{core(*wanted)}{''.join(', ' + p for p in parts)} {select}"


def over_load(tables: list[str], parts: list[str], select: str) -> str:
    wanted = list(dict.fromkeys(tables))
    return f"{with_typed(*wanted)}{''.join(', ' + p for p in parts)} {select}"
