"""What must not grow: rows moved to number them, text carried by counts, extract files of a fixed number."""

import glob
import re
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dealmill.functions import normalize as N
from dealmill.operators import constraints as K
from dealmill.plans import catalog
from dealmill.plans import reports as R
from dealmill.operators.lookup import Spread
from dealmill.operators.rules import numbered_log
from dealmill.plans import load as load_module
from dealmill.plans.load import TypedTables
from dealmill.schemas import CONSTRAINTS, CORE_SCHEMAS, RAW_COLUMNS, RAW_TABLES, raw_schema
from dealmill.session import at_once, shuffles_dropped
from dealmill.sources.extracts import read_extract
from dealmill.sources.store import TableStore
from workload import queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _users(spark, n):
    return spark.range(n).selectExpr(
        "id + 1 as id", "concat('U', id) as user_id", "'n' as name", "'director' as role", "'1' as active",
        "'d' as department", "cast(null as string) as email",
    )


def test_numbering_leaves_the_rows_where_they_were_read(spark, tmp_path):
    Q._write_extract(_users(spark, 50).drop("id").repartitionByRange(3, "user_id"), str(tmp_path / "users"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = read_extract(spark, "users", str(tmp_path / "users"), multi_line=False)
        plan = read._jdf.queryExecution().executedPlan().toString()
        ids = sorted(r.id for r in read.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # The counts of splits may be joined to those of files in any way; the rows are not moved.
    joins = [line for line in plan.splitlines() if "Join" in line and "LeftOuter" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins) and ids == list(range(1, 51))


def test_extracts_are_written_compressed_and_read_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "checkpoint_dir", lambda _: str(tmp_path))
    raw = Q.Views(spark, "", {})
    raw |= {t: spark.createDataFrame([], raw_schema(t)) for t in RAW_TABLES} | {"users": _users(spark, 20)}
    folder = Q._write_extracts(raw, "{table}")
    assert glob.glob(f"{folder}/users/*.csv.gz") and not glob.glob(f"{folder}/users/*.csv")
    assert read_extract(spark, "users", f"{folder}/users").count() == 20


def test_hashes_of_cells_are_counted_as_bytes(spark):
    rows = Q._rows({"users": _users(spark, 3).drop("id").unionByName(_users(spark, 2).drop("id"))})
    assert "unhex" in _plan(rows)
    assert sorted(r.rows for r in rows.collect()) == [1, 2, 2] and all(len(r.cells) == 32 for r in rows.collect())


def test_files_of_an_extract_follow_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "_FILE_ROWS", 10, raising=False)
    monkeypatch.setattr(Q, "checkpoint_dir", lambda _: str(tmp_path))
    found = Q._places(spark, {"users": _users(spark, 200)})
    assert len(glob.glob(f"{tmp_path}/extracts-*/users/part-*")) > 7
    assert sorted(r.id for r in found.collect()) == list(range(1, 201))


def test_counts_of_issues_carry_no_text(spark):
    raw = {t: spark.createDataFrame([], raw_schema(t)) for t in RAW_TABLES}
    raw["payments"] = spark.createDataFrame([(1, "PAY1", "D9", "01.02.2024", "5", "full", "paid")], raw_schema("payments"))
    tables = TypedTables(raw)
    counted = R.quality_by_type(tables)
    assert "payment_date=" not in _plan(counted)
    assert [tuple(r) for r in counted.collect()] == [("orphan_deal", "quarantined", 1)]
    assert [(r.entity_id, r.details) for r in tables["data_quality_issues"].collect()] == [("PAY1", "D9")]


def test_case_of_a_channel_is_folded_once(spark):
    cells = spark.createDataFrame([("АВИТО",), ("Website",), (None,)], "source string")
    cleaned = N.clean(cells, {"source": N.CHANNEL})
    assert _plan(cleaned).count("lower(") == 1
    assert [r["source__v"] for r in cleaned.collect()] == ["avito", "website", None]


def _small_load(spark):
    """Raw tables with an orphan, an older version of a deal and copies of kept and orphaned events."""
    rows = {
        "deals": [
            (1, "D1", "t", "2024-01-01", "2024-01-02", "NEW", None, None, None, "Avito", "5", None, None, None, None),
            (2, "D1", "t", "2024-01-01", "2024-01-03", "NEW", None, None, None, "Avito", "5", None, None, None, None),
        ],
        "payments": [(1, "PAY1", "D9", "01.02.2024", "5", "full", "paid"), (2, "PAY2", "D1", "01.02.2024", "5", "what", "paid")],
        "stage_history": [(i, "E1", "D1", None, "NEW", "2024-01-01", "U9") for i in (1, 2, 3)]
        + [(i, "E2", "D9", None, "NEW", "2024-01-01", None) for i in (4, 5)],
    }
    return {t: spark.createDataFrame(rows.get(t, []), raw_schema(t)) for t in RAW_TABLES}


class Tallied(dict):
    """Typed tables with counts beside them."""

    def __init__(self, tables, tally):
        super().__init__(tables)
        self.tally = tally


def test_entities_are_derived_once_for_rows_and_issues(spark):
    raw = _small_load(spark)
    tables = TypedTables(raw)
    plan = _plan(R.quality_by_type(tables))
    assert "explode" not in plan and plan.count("PAY1") <= 1
    held = lambda df: spark.createDataFrame(df.collect(), df.schema)
    plain = {t: held(df) for t, df in tables.items()}
    tallied = Tallied({t: spark.createDataFrame([], df.schema) for t, df in plain.items()} | {"sources": plain["sources"]}, held(tables.tally))
    for count in (
        R.quality_by_type, R.quality_by_action, R.quality_total, R.quality_pivot, catalog.table_counts, K.run_summary,
        lambda core: K.reconcile_counts(raw, core, core["data_quality_issues"]).orderBy("table"),
    ):
        assert [tuple(r) for r in count(tallied).collect()] == [tuple(r) for r in count(plain).collect()]
    by_type = {(r.issue_type, r.action): r["count"] for r in R.quality_by_type(tallied).collect()}
    assert by_type[("duplicate_event", "quarantined")] == 2 and by_type[("orphan_deal", "quarantined")] == 3
    assert by_type[("duplicate_deal", "quarantined")] == 1 and sum(by_type.values()) == plain["data_quality_issues"].count()


def test_log_is_not_derived_again_to_find_its_ranges(spark):
    rows = [(i, "deal", f"D{9 - i}", "missing_manager", "flagged", None, datetime(2024, 1, 1)) for i in range(5)]
    listed = R.issue_list({"data_quality_issues": spark.createDataFrame(rows, CORE_SCHEMAS["data_quality_issues"])})
    assert "RepartitionByExpression" in _plan(listed)
    assert [r.id for r in listed.collect()] == [4, 3, 2, 1, 0]


def test_tables_are_written_at_once():
    both = threading.Barrier(2)
    at_once(lambda name: both.wait(30), ["a", "b"])

    def fail(name):
        raise ValueError(name)

    with pytest.raises(ValueError):
        at_once(fail, [str(i) for i in range(20)])


def test_patterns_of_dates_are_tried_by_their_signs(spark):
    cells = [" 2024-02-01 ", "2024/2/1", "01.02.2024", "1.2.2024 \t 7:05", "2024-02-01t07:05:00+0500", "2024-02-01T07:05:00Z", "2024-02-30",
             "01.02.2024 7:5:3", "2024.02/01", "2024-02-01T07:05:00.5Z", "0000-01-01", "не дата", "", None]
    cleaned = N.clean(spark.createDataFrame([(c,) for c in cells], "d string"), {"d": N.TIMESTAMP})
    found = [str(r["d__v"])[5:16] if r["d__v"] else None for r in cleaned.selectExpr("cast(d__v as timestamp_ntz) as d__v").collect()]
    early, odd = "01-31 19:00", [r["d__nonstandard"] for r in cleaned.collect()]
    assert found == [early, early, early, "02-01 02:05", "02-01 02:05", "02-01 07:05"] + [None] * 8
    assert odd == [False, True, True, True, False, False, True, True, True, True, True, True, False, False]
    assert "Contains" in _plan(cleaned) and "regexp_replace" not in _plan(cleaned)


def test_constraints_read_every_table_once(spark, tmp_path):
    nulls = ", ".join(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in CORE_SCHEMAS["payments"])
    spark.sql(f"select {nulls} from range(3)").write.parquet(str(tmp_path / "payments"))
    spark.sql("select 'D1' as deal_id").write.parquet(str(tmp_path / "deals"))
    tables = {t: spark.read.parquet(str(tmp_path / t)) for t in ("payments", "deals")}
    found = K.check_constraints(tables, {"payments": CONSTRAINTS["payments"]})
    assert _plan(found).count("Relation") == 2
    # More checks than there are slots, all broken by every row.
    broken = {r.constraint: r.violations for r in found.collect()}
    not_null = CONSTRAINTS["payments"].not_null
    assert len(not_null) > 2 and {c: n for c, n in broken.items() if n} == {f"{c}_not_null": 3 for c in not_null}


def test_log_is_laid_out_by_its_ids_without_a_sample(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    log = spark.range(1, 8).orderBy("id", ascending=False).selectExpr(
        "id", "'deal' as entity", "concat('D', id) as entity_id", "'orphan_deal' as issue_type",
        "'quarantined' as action", "cast(null as string) as details", "timestamp'2026-01-01' as detected_at",
    )
    version = store.begin_version()
    version.write_log(log, 7, rows_per_file=3)
    files = sorted(glob.glob(f"{tmp_path}/core/{version.name}/data_quality_issues/part-*"))
    assert [[r.id for r in spark.read.parquet(f).collect()] for f in files] == [[1, 2, 3], [4, 5, 6], [7]]
    assert version.figures["core"]["data_quality_issues"]["rows"] == 7 and version.issues == [["orphan_deal", "quarantined", 7]]
    empty = store.begin_version()
    empty.write_log(log.where("id < 0"), 0)
    assert empty.figures["core"]["data_quality_issues"]["rows"] == 0 and empty.issues == []


def test_issues_of_displaced_rows_are_derived_once_by_a_load(spark, tmp_path):
    raw = {t: spark.createDataFrame([], raw_schema(t)) for t in RAW_TABLES}
    cells = {"deal_id": "'D1'", "updated_at": "concat('2026-01-0', id)"}
    raw["deals"] = spark.range(1, 4).selectExpr("id", *(f"{cells.get(c, 'cast(null as string)')} as {c}" for c in RAW_COLUMNS["deals"]))
    kept = []

    def keep(df):
        path = str(tmp_path / str(len(kept)))
        df.write.parquet(path)
        kept.append(path)
        return spark.read.schema(df.schema).parquet(path)

    displaced = TypedTables(raw, Spread(keep=keep)).result("deals").displaced
    assert sorted(r.details[:17] for r in displaced.collect()) == ["replaced row id=1", "replaced row id=2"]
    assert "Relation" in _plan(displaced) and "Join" not in _plan(displaced)


def test_log_is_shuffled_once_and_numbered_in_its_order(spark, tmp_path):
    rows = spark.range(400).selectExpr(
        "if(id % 2 = 0, 'deal', 'payment') as entity", "if(id % 9 = 0, null, concat('D', id % 30)) as entity_id",
        "'orphan_deal' as issue_type", "'quarantined' as action", "concat('row ', id % 3) as details",
    )
    rows.write.parquet(str(tmp_path / "issues"))
    stored = spark.read.parquet(str(tmp_path / "issues"))
    log = numbered_log([stored, stored.where("entity_id is null")], 5)
    version = TableStore(spark, str(tmp_path / "w")).begin_version()
    version.write_log(log)
    order = ["entity", "entity_id", "issue_type", "action", "details"]
    files = sorted(glob.glob(f"{tmp_path}/w/core/{version.name}/data_quality_issues/part-*"))
    found = [r for f in files for r in spark.read.parquet(f).collect()]
    assert len(files) > 1 and [r.id for r in found] == list(range(1, 446))
    key = lambda r: [(r[c] is not None, r[c] or "") for c in order]
    assert [key(r) for r in found] == sorted(map(key, rows.collect() + rows.where("entity_id is null").collect()))
    # The rows that are counted per task and those that are sorted come from one shuffle.
    log.collect()
    final = log._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("+- Exchange rangepartitioning") == 1
    empty = version.store.begin_version()
    empty.write_log(numbered_log([stored.where("entity = 'none'")], 5))
    assert empty.figures["core"]["data_quality_issues"]["rows"] == 0 and empty.issues == []


def test_the_largest_tables_of_a_load_are_begun_first(spark, tmp_path, monkeypatch):
    begun = []
    monkeypatch.setattr(load_module, "at_once", lambda job, names: [begun.append(n) or job(n) for n in names])
    raw = _small_load(spark)
    monkeypatch.setattr(load_module, "read_extracts", lambda spark, extracts: raw)
    version = TableStore(spark, str(tmp_path)).begin_version()
    load_module._write_version(spark, version, "", {})
    assert begun[len(RAW_TABLES):][:3] == ["stage_history", "deals", "payments"]
    assert sorted(begun[len(RAW_TABLES):]) == sorted(t for t in CORE_SCHEMAS if t != "data_quality_issues")
    assert sorted(r.id for r in version.tables()["data_quality_issues"].collect()) == list(range(1, version.figures["core"]["data_quality_issues"]["rows"] + 1))


def test_late_orders_are_told_without_writing_the_cleaning_out_in_a_filter(spark):
    cells = {t: [f"cast(id as string) as {c}" for c in RAW_COLUMNS[t]] for t in RAW_TABLES}
    tables = TypedTables({t: spark.range(3).selectExpr("id", *cells[t]) for t in RAW_TABLES})
    orders = [_plan(tables["production_orders"]), _plan(R.production_delays(tables))]
    assert len(orders[1]) < 5 * len(orders[0])


def test_a_load_drops_what_it_is_done_with(spark, tmp_path, monkeypatch):
    raw = Q.Views(spark, "", {})
    raw |= _small_load(spark)
    monkeypatch.setattr(Q, "checkpoint_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(load_module, "checkpoint_dir", lambda _: str(tmp_path / "work"))
    seen, write_log = [], load_module.Version.write_log
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def log(version, *args):
        seen.append((spark.conf.get(setting), sorted(spark.read.parquet(glob.glob(f"{tmp_path}/work/*/*")[0]).columns)))
        seen.append(len(glob.glob(f"{tmp_path}/work/*")))
        write_log(version, *args)

    monkeypatch.setattr(load_module.Version, "write_log", log)
    store = Q._published(raw)
    # While the log is written, one work area of issues is left; then nothing but the stored tables.
    assert seen == [("true", ["action", "details", "entity", "entity_id", "issue_type"]), 1]
    assert spark.conf.get(setting) == "false" and not glob.glob(f"{tmp_path}/work/*") and not glob.glob(f"{tmp_path}/extracts-*")
    assert store.raw("payments").count() == 2 and store.verify().where("not intact").isEmpty()
    assert glob.glob(f"{tmp_path}/warehouse-*/core/*/deals/*.zstd.parquet")


def test_shuffle_files_of_a_load_go_with_their_query(spark, tmp_path):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*")}

    before = files()
    spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "left"))
    left = files()
    assert left - before
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "dropped"))
    for _ in range(50):
        if files() <= left:
            break
        time.sleep(0.2)
    assert files() <= left and spark.read.parquet(str(tmp_path / "dropped")).count() == 1000


def test_very_large_tables_of_a_load_take_turns(spark, tmp_path, monkeypatch):
    together = []
    monkeypatch.setattr(load_module, "at_once", lambda job, names: [together.append(n) or job(n) for n in names])
    monkeypatch.setattr(load_module, "ROWS_AT_ONCE", 1)
    raw = _small_load(spark)
    monkeypatch.setattr(load_module, "read_extracts", lambda spark, extracts: raw)
    version = TableStore(spark, str(tmp_path)).begin_version()
    load_module._write_version(spark, version, "", {})
    assert not {"stage_history", "deals", "payments"} & set(together[len(RAW_TABLES):]) and "users" in together[len(RAW_TABLES):]
    assert {t: version.figures["core"][t]["rows"] for t in ("stage_history", "deals", "payments")} == {"stage_history": 1, "deals": 1, "payments": 1}


def test_a_load_moves_texts_and_a_count_moves_checks(spark):
    cells = {t: [f"concat(id, '{t}') as {c}" for c in RAW_COLUMNS[t]] for t in RAW_TABLES}
    raw = {t: spark.range(3).selectExpr("id", *cells[t]) for t in RAW_TABLES}

    def moved(df):
        """What stands below the join of payments to deals on the side of payments."""
        return _plan(df).split("Join LeftOuter")[1].split("Aggregate [deal_id")[0]

    lazy = moved(TypedTables(raw).result("payments").issues.select("entity_id", "issue_type"))
    assert re.search(r"Project \[payment_id#\d+, deal_id#\d+, \(", lazy) and "AS _checks" in lazy
    loaded = load_module.build("payments", raw, load_module.Parents(raw), Spread(keep=lambda df: df))
    assert "payment_type__v" not in moved(loaded.marked)


def test_rows_are_reconciled_in_one_pass_of_each_entity(spark):
    raw = _small_load(spark)
    tables = TypedTables(raw)
    found = K.reconcile_rows(raw, tables, tables["data_quality_issues"])
    assert "explode" not in _plan(found)
    held = lambda df: spark.createDataFrame(df.collect(), df.schema)
    plain = {t: held(df) for t, df in tables.items()}
    expected = K.reconcile_rows(raw, plain, plain["data_quality_issues"])
    assert found.columns == expected.columns
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == sorted(tuple(r) for r in expected.collect()) and len(rows) == len(RAW_TABLES)
    assert ("stage_history", 5, 1, 4, True, True) in rows and ("deals", 2, 1, 1, True, True) in rows
    # A raw row more, and another key, are seen.
    more = raw | {"payments": raw["payments"].unionByName(raw["payments"].limit(1))}
    other = raw | {"payments": raw["payments"].withColumn("payment_id", F.concat("payment_id", F.lit("x")))}
    flags = [
        {r.table: (r.balanced, r.same_keys) for r in K.reconcile_rows(x, tables, tables["data_quality_issues"]).collect()}["payments"]
        for x in (more, other)
    ]
    assert flags == [(False, False), (True, False)]
