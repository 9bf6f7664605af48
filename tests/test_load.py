"""The hand-made extract end to end: counts, issues, reports."""

import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dealmill.operators.constraints import check_constraints, reconcile_counts, reconcile_rows, run_summary
from dealmill.plans import catalog
from dealmill.plans import reports as R
from dealmill.plans.load import ConstraintViolation, run_load, run_transform
from dealmill.schemas import CORE_SCHEMAS
from dealmill.session import checkpoint_dir
from dealmill.sources import store as store_module
from dealmill.sources.extracts import read_extracts
from dealmill.sources.store import TableStore
from tests.crm import ROWS, write_extracts


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    extracts = write_extracts(tmp_path_factory.mktemp("extracts"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    load = run_load(spark, extracts, warehouse)
    return spark, warehouse, load


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_counts(loaded):
    _, _, load = loaded
    assert sum(df.count() for df in load.raw.values()) == 80
    counts = {r["name"]: r["count"] for r in catalog.table_counts(load.core).collect()}
    assert counts == {
        "sources": 6, "users": 5, "companies": 6, "contacts": 5, "products": 6, "pipeline_stages": 9, "deals": 11,
        "deal_products": 8, "payments": 5, "stage_history": 4, "activities": 3, "production_orders": 3,
        "shipments": 3, "marketing_costs": 4, "data_quality_issues": 29,
    }


def test_summary_and_reconciliation(loaded):
    _, _, load = loaded
    summary = {(r["kind"], r["name"]): r["rows"] for r in load.summary.collect()}
    assert [summary["issues", a] for a in ("fixed", "quarantined", "flagged")] == [9, 8, 12]
    assert summary["table", "deals"] == 11
    checked = reconcile_counts(load.raw, load.core, load.core["data_quality_issues"]).collect()
    assert len(checked) == 13 and all(r["balanced"] for r in checked)
    assert sum(r["raw_rows"] for r in checked) == 80


def test_issues_by_type(loaded):
    _, _, load = loaded
    found = {(t, a): n for t, a, n in rows(R.quality_by_type(load.core))}
    assert found == {
        ("normalized_source", "fixed"): 5, ("normalized_phone", "fixed"): 1, ("missing_currency", "fixed"): 1,
        ("nonstandard_date", "fixed"): 2, ("duplicate_deal", "quarantined"): 1, ("orphan_deal", "quarantined"): 5,
        ("orphan_product", "quarantined"): 1, ("duplicate_event", "quarantined"): 1,
        **{(t, "flagged"): 1 for t in (
            "incomplete_company", "orphan_company", "missing_email", "duplicate_sku", "orphan_stage",
            "missing_manager", "inactive_manager", "missing_company", "negative_amount", "won_without_close_date",
            "illegal_transition", "temporal_inconsistency",
        )},
    }
    pivot = rows(R.quality_pivot(load.core))
    assert pivot[0] == ("normalized_source", 5, 0, 0) and pivot[1] == ("orphan_deal", 0, 5, 0)
    assert rows(R.quality_total(load.core)) == [(29,)]
    listed = [(r["entity"], r["entity_id"]) for r in R.issue_list(load.core).collect()]
    assert listed == sorted(listed, key=lambda k: (k[0], k[1] is None, k[1] or ""))


def test_typed_values(loaded):
    _, _, load = loaded
    deals = {r["deal_id"]: r for r in load.core["deals"].collect()}
    assert {d for d, r in deals.items() if r["has_quality_issue"]} == {
        "D1004", "D1006", "D1007", "D1009", "D1010", "D1011"
    }
    assert deals["D1008"]["expected_amount"] == Decimal("69000.00") and deals["D1008"]["source_id"] == 2
    assert deals["D1010"]["currency"] == "RUB" and deals["D1010"]["source_id"] == 1
    assert deals["D1011"]["stage_id"] is None and deals["D1011"]["manager_id"] is None
    when = load.core["deals"].where("deal_id = 'D1010'").select(F.col("created_at").cast("string")).first()[0]
    assert when == "2026-06-14 04:20:00"
    contacts = {r["contact_id"]: r for r in load.core["contacts"].collect()}
    assert contacts["P303"]["phone"] == "+79170003003" and contacts["P304"]["company_id"] is None
    assert load.core["companies"].where("company_id = 'C200'").first()["inn"] == "0278123456"
    products = {r["product_id"]: r for r in load.core["products"].collect()}
    assert products["PR006"]["canonical_id"] == "PR001" and products["PR001"]["canonical_id"] is None
    assert products["PR005"]["name"] == "Дверь\nраспашная" and products["PR004"]["name"] == 'Дверь "Север"'
    assert check_constraints(load.core).where("violations > 0").count() == 0


def test_cutoff_and_funnel(loaded):
    _, _, load = loaded
    assert rows(R.cutoff_date(load.core)) == [(date(2026, 6, 15),)]
    funnel = {r["stage_id"]: (r["deals"], r["amount"]) for r in R.funnel(load.core).collect()}
    assert funnel["WON"] == (2, Decimal("361000.00")) and funnel["LOST"] == (1, Decimal("57000.00"))
    assert funnel[None] == (1, Decimal("54000.00")) and funnel["CONTRACT"] == (0, Decimal("0.00"))
    assert rows(R.funnel_totals(load.core)) == [(11, Decimal("1040000.00"))]
    order = [r["sort_order"] for r in R.funnel(load.core).collect()]
    assert order == [10, 20, 30, 40, 50, 60, 70, 80, 90, 999]


def test_margins_and_managers(loaded):
    _, _, load = loaded
    margins = {r["deal_id"]: r["line_margin"] for r in R.deal_amount(load.core).where("line_margin is not null").collect()}
    assert {k: int(v) for k, v in margins.items()} == {
        "D1001": 39100, "D1002": 42400, "D1003": 85600, "D1004": 13800, "D1005": 48500
    }
    assert rows(R.managers(load.core)) == [
        ("U10", "Иван Петров", True, 2, Decimal("361000.00"), Decimal("85600.00"), 1),
        ("U11", "Анна Соколова", True, 0, Decimal("0.00"), None, 0),
        ("U12", "Олег Крылов", False, 0, Decimal("0.00"), None, 0),
    ]
    assert rows(R.shipped_not_closed(load.core)) == [
        ("D1005", "U11", "Анна Соколова", Decimal("92000.00"), Decimal("48500.00"))
    ]


def test_receivables(loaded):
    _, _, load = loaded
    balances = [(r["deal_id"], int(r["balance"])) for r in R.receivables(load.core).collect()]
    assert balances == [
        ("D1010", 169000), ("D1009", 125000), ("D1002", 84000), ("D1001", 66000), ("D1003", 0), ("D1005", -8000)
    ]
    assert [int(v) for v in R.receivables_totals(load.core).first()] == [837000, 396000, 30000, -5000, 436000]
    assert [r["deal_id"] for r in R.overpaid(load.core).where("overpaid").collect()] == ["D1005"]


def test_delays_and_stale_deals(loaded):
    _, _, load = loaded
    assert [(r["production_order_id"], r["delay_days"]) for r in R.production_delays(load.core).collect()] == [("PO003", 6)]
    assert [r["production_order_id"] for r in R.production_delays(load.core, 1).collect()] == ["PO003", "PO001", "PO002"]
    stale = rows(R.stale_deals(load.core))
    assert [r[0] for r in stale] == ["D1006", "D1007", "D1008", "D1010", "D1011"]
    assert all(r[2] is None and r[3] is None for r in stale)
    week = {r[0]: r[3] for r in rows(R.run_report(load.core, "stale-deals", n_days=7))}
    assert (len(week), week["D1001"], week["D1002"], week["D1005"]) == (8, 12, 11, 8)
    for bad in (-1, 3651):
        with pytest.raises(ValueError):
            R.stale_deals(load.core, bad)


def test_sources(loaded):
    _, _, load = loaded
    found = {r["code"]: r for r in R.sources_report(load.core).collect()}
    yandex, avito = found["yandex_direct"], found["avito"]
    assert (yandex["deals"], yandex["won_deals"], int(yandex["revenue"]), yandex["romi"]) == (2, 1, 236000, 27.7805)
    assert (int(avito["costs"]), avito["cost_rows"], avito["romi"]) == (8400, 2, -1.0)
    assert not found["website"]["has_costs"] and found["website"]["cost_rows"] == 1
    assert found["referral"]["margin"] is None and found["referral"]["romi"] is None
    gap = {r["deal_id"]: int(r["gap"]) for r in R.plan_fact_gap(load.core).collect()}
    assert gap["D1001"] == 24000


def test_catalog(loaded):
    _, _, load = loaded
    assert [r["deal_id"] for r in catalog.preview(load.core, "deals", 2).collect()] == ["D1001", "D1002"]
    with pytest.raises(KeyError):
        catalog.preview(load.core, "passwords")
    for bad in (0, 5001):
        with pytest.raises(ValueError):
            catalog.preview(load.core, "deals", bad)
    with pytest.raises(KeyError):
        R.run_report(load.core, "unknown")


def test_every_report_runs(loaded):
    _, _, load = loaded
    for report in R.REPORTS.values():
        report.rows(load.core).count()
        for extra in report.extras.values():
            extra(load.core).count()


def test_second_load_replaces_the_first(spark, tmp_path):
    first, second, warehouse = tmp_path / "first", tmp_path / "second", str(tmp_path / "warehouse")
    first.mkdir(), second.mkdir()
    run_load(spark, write_extracts(first), warehouse)
    more = {t: list(cells) for t, cells in ROWS.items()}
    more["users"] = [*more["users"], ["U15", "Новый", "sales_manager", "1", "", ""]]
    run_load(spark, write_extracts(second, rows=more), warehouse)
    store = TableStore(spark, warehouse)
    assert store.core("users").count() == 6 and store.core("deals").count() == 11
    assert store.raw("users").count() == 6
    assert store.drop_superseded() == 1 and store.core("users").count() == 6
    with pytest.raises(KeyError):
        store.core("nothing")


def test_broken_load_is_not_published(spark, tmp_path):
    good, bad, warehouse = tmp_path / "good", tmp_path / "bad", str(tmp_path / "warehouse")
    good.mkdir(), bad.mkdir()
    run_load(spark, write_extracts(good), warehouse)
    before = TableStore(spark, warehouse).current_version()
    twice = {t: list(cells) for t, cells in ROWS.items()}
    twice["payments"] = [*twice["payments"], twice["payments"][0]]
    with pytest.raises(ConstraintViolation, match="payment_id_primary_key"):
        run_load(spark, write_extracts(bad, rows=twice), warehouse)
    store = TableStore(spark, warehouse)
    assert store.current_version() == before and store.core("payments").count() == 5


def work_folders(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    return sorted(f for f in (os.listdir(folder) if os.path.isdir(folder) else []) if f.startswith("load-"))


def with_rows(folder, **more):
    return write_extracts(folder, rows={t: [*cells, *more.get(t, [])] for t, cells in ROWS.items()})


def test_oversized_numbers_of_dropped_rows_do_not_stop_the_load(spark, tmp_path):
    before = work_folders(spark)
    line = [*ROWS["deal_products"][0]]
    line[0], line[2:5] = "D9999", ["100000000000000000000", "100000000000000000000", "1"]
    extracts = with_rows(
        tmp_path, payments=[["PAY007", "D9998", "2026-06-01", "9999999999999", "full", "paid"]], deal_products=[line]
    )
    load = run_load(spark, extracts, str(tmp_path / "warehouse"))
    assert load.core["payments"].count() == 5 and load.core["deal_products"].count() == 8
    log = {(r["entity_id"], r["issue_type"]) for r in load.core["data_quality_issues"].collect()}
    assert ("PAY007", "orphan_deal") in log and ("D9999", "orphan_deal") in log
    assert work_folders(spark) == before


def test_an_oversized_number_of_a_kept_row_is_named(spark, tmp_path):
    before = work_folders(spark)
    extracts = with_rows(tmp_path, payments=[["PAY007", "D1001", "2026-06-01", "9999999999999", "full", "paid"]])
    with pytest.raises(Exception, match="payment PAY007: amount does not fit"):
        run_load(spark, extracts, str(tmp_path / "warehouse"))
    assert work_folders(spark) == before


def test_lazy_transform_agrees_with_the_stored_load(loaded, tmp_path):
    spark, _, load = loaded
    core, issues = run_transform(load.raw)
    for table, df in core.items():
        if table != "data_quality_issues":
            assert sorted(map(str, rows(df))) == sorted(map(str, rows(load.core[table]))), table
    columns = ["entity", "entity_id", "issue_type", "action", "details"]
    assert sorted(map(str, rows(issues.select(columns)))) == sorted(
        map(str, rows(load.core["data_quality_issues"].select(columns)))
    )
    assert run_summary(core).where("name = 'flagged'").first()["rows"] == 12


def test_missing_extract_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_extracts(spark, str(tmp_path))


def make_version(store, n_users):
    version = store.begin_version()
    users = store.spark.range(n_users).selectExpr("cast(id as string) as user_id")
    for f in CORE_SCHEMAS["users"].names[1:]:
        users = users.withColumn(f, F.lit(False if f == "has_quality_issue" else None))
    version.write("users", users)
    return version


def test_racing_loads_get_different_numbers(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    assert make_version(store, 1).publish() == 1
    second, third = make_version(store, 2), make_version(store, 3)
    stale = store._numbers()  # both loads look at the numbers before either has published
    monkeypatch.setattr(store, "_numbers", lambda: stale)
    assert (second.publish(), third.publish()) == (2, 3)
    monkeypatch.undo()
    assert store.current_version() == third.name and store.core("users").count() == 3
    assert store.drop_superseded() == 2 and store.core("users").count() == 3


def test_a_clock_that_is_late_publishes_all_the_same(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    first = make_version(store, 1)
    first.publish()

    class Late:
        @staticmethod
        def now(zone):
            return datetime.now(zone) - timedelta(hours=1)

    monkeypatch.setattr(store_module, "datetime", Late)
    second = make_version(store, 2)
    assert second.name < first.name
    second.publish()
    assert store.current_version() == second.name and store.core("users").count() == 2
    left_behind = make_version(store, 9)
    assert store.drop_superseded() == 1 and store.core("users", left_behind.name).count() == 9
    assert store.drop_unpublished() == 1 and store.core("users").count() == 2


def test_a_manifest_cut_short_is_passed_over(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.current_version()
    first = make_version(store, 1)
    first.publish()
    assert store._create(2, '{"version": "x') and not store._create(2, "{}")
    assert store.current_version() == first.name
    assert make_version(store, 2).publish() == 3 and store.manifest()["number"] == 3
    assert store.manifest(first.name)["figures"]["core"]["users"]["rows"] == 1


def test_manifest_knows_what_was_written(loaded, tmp_path):
    spark, _, load = loaded
    extracts = tmp_path / "extracts"
    extracts.mkdir()
    run_load(spark, write_extracts(extracts), str(tmp_path / "w"))
    store = TableStore(spark, str(tmp_path / "w"))
    issues = store.core("data_quality_issues")
    assert sorted(map(tuple, store.summary().collect())) == sorted(map(tuple, run_summary(store.tables()).collect()))
    assert sorted(map(tuple, store.quality_by_type().collect())) == sorted(map(tuple, R.quality_by_type(store.tables()).collect()))
    assert [tuple(r) for r in store.table_counts().collect()] == [tuple(r) for r in catalog.table_counts(store.tables()).collect()]
    for df in (store.summary(), store.quality_by_type(), store.table_counts()):
        assert df.inputFiles() == []
    assert all(r["intact"] for r in store.verify().collect())
    # One cell of one row of the stored table changes.
    version = store.current_version()
    payments = store.core("payments")
    damaged = payments.withColumn("status", F.when(F.col("payment_id") == "PAY001", "pending").otherwise(F.col("status"))).collect()
    spark.createDataFrame(damaged, payments.schema).write.mode("overwrite").parquet(store.path("core", version, "payments"))
    found = {(r["layer"], r["table"]): (r["rows"] == r["written"], r["intact"]) for r in store.verify().collect()}
    assert found.pop(("core", "payments")) == (True, False) and set(found.values()) == {(True, True)}
    # The same extracts loaded again give the same ids of issues.
    again = run_load(spark, str(extracts), str(tmp_path / "again")).core["data_quality_issues"]
    columns = ["id", "entity", "entity_id", "issue_type", "action", "details"]
    assert sorted(map(str, issues.select(columns).collect())) == sorted(map(str, again.select(columns).collect()))
    assert sorted(r["id"] for r in again.collect()) == list(range(1, again.count() + 1))


def test_a_row_exchanged_for_another_is_seen(loaded):
    _, _, load = loaded
    issues = load.core["data_quality_issues"]
    checked = reconcile_rows(load.raw, load.core, issues).collect()
    assert len(checked) == 13 and all(r["balanced"] and r["same_keys"] for r in checked)
    exchanged = dict(load.core)
    exchanged["payments"] = load.core["payments"].withColumn(
        "payment_id", F.when(F.col("payment_id") == "PAY001", "PAY999").otherwise(F.col("payment_id"))
    )
    found = {r["table"]: (r["balanced"], r["same_keys"]) for r in reconcile_rows(load.raw, exchanged, issues).collect()}
    assert found.pop("payments") == (True, False) and set(found.values()) == {(True, True)}


def test_preview_opens_only_the_first_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    version = store.begin_version()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        users = spark.range(4000).selectExpr("lpad(cast((id * 7919) % 4000 as string), 5, '0') as user_id")
        for f in CORE_SCHEMAS["users"].names[1:]:
            users = users.withColumn(f, F.lit(False if f == "has_quality_issue" else None))
        version.write("users", users)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    version.publish()
    files = len(store.core("users").inputFiles())
    assert files >= 4
    for limit, most in ((1, 1), (100, 1), (1500, 4), (4000, files)):
        got = catalog.preview_published(store, "users", limit)
        assert [r["user_id"] for r in got.collect()] == [f"{i:05d}" for i in range(limit)]
        assert len(store.first_rows("users", limit).inputFiles()) <= most
    with pytest.raises(KeyError):
        catalog.preview_published(store, "nothing")
    with pytest.raises(ValueError, match="limit"):
        catalog.preview_published(store, "users", 0)


def test_cutoff_of_a_published_load_reads_no_table(loaded):
    spark, warehouse, load = loaded
    store = TableStore(spark, warehouse)
    assert store.cutoff_date().inputFiles() == []
    assert store.cutoff_date().collect() == R.cutoff_date(load.core).collect()
