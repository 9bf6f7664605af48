"""Operators on small tables against brute force, with one key holding most of the rows.

``rows_per_task`` is set low and broadcasting is off, so that the spreading that large tables
meet is what runs here.
"""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealmill.functions import normalize as N
from dealmill.operators.constraints import check_constraints
from dealmill.operators.dedup import dedup_exact, dedup_latest
from dealmill.operators.lookup import Spread, hot_keys, lookup, replicate
from dealmill.operators.references import (
    mark_reference,
    quarantine_orphans,
    resolve_canonical,
    resolve_fk,
)
from dealmill.operators.rules import Rule, apply_rules, flag_illegal_transitions
from dealmill.sources.store import WorkArea
from dealmill.schemas import CLOSING_STAGES, CONSTRAINTS, CORE_SCHEMAS, OPEN_STAGES, Constraints


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def skewed(spark, n=3000):
    """Rows of which a third share one key, a few have none and some keys have no parent."""
    return spark.range(n).select(
        "id",
        F.expr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else 'k' || (id % 40) end").alias("k"),
    )


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_hot_keys_are_found(spark):
    found = {r["k"]: r["__splits"] for r in hot_keys(skewed(spark), "k", rows_per_task=200).collect()}
    assert found == {"hot": 5}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_equals_a_plain_join(spark, no_broadcast, tmp_path, how):
    rows = skewed(spark)
    parents = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "k string, v int")
    want = bag(rows.join(parents, "k", how).select("id", "k", "v"))
    for spread in (Spread(200), Spread(200, WorkArea(spark, str(tmp_path)).keep)):
        assert bag(lookup(rows, parents, "k", "id", how, spread).select("id", "k", "v")) == want


def test_lookup_spreads_every_hot_key(spark, no_broadcast, tmp_path):
    keep = WorkArea(spark, str(tmp_path)).keep
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parents = spark.createDataFrame([("hot", 1)], "k string, v int")
        joined = lookup(skewed(spark), parents, "k", "id", "inner", spread=Spread(100, keep))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 1000 and len(sizes) > 1 and max(sizes) < 500

        # However many keys are hot, each is cut.
        rows = spark.range(12_000).select("id", F.expr("'k' || (id % 400)").alias("k"))
        assert hot_keys(rows, "k", 10).count() == 400
        parents = rows.select("k").distinct()
        joined = lookup(rows, parents, "k", "id", "left", spread=Spread(10, keep))
        placed = joined.withColumn("task", F.spark_partition_id())
        places = placed.groupBy("k").agg(F.count_distinct("task").alias("tasks"), F.count(F.lit(1)).alias("n"))
        found = places.collect()
        assert len(found) == 400 and all(r["n"] == 30 for r in found) and sum(r["tasks"] > 1 for r in found) > 300
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_replicate(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25)], "k string, n int")
    got = replicate(df, F.col("n"), rows_per_task=10)
    assert Counter(r["k"] for r in got.collect()) == {"b": 1, "c": 25}


def test_dedup_latest(spark, no_broadcast):
    cells = [("2026-06-%02d" % (1 + i % 9)) if i % 4 else ("bad" if i % 8 else None) for i in range(600)]
    data = [(i, "hot" if i % 3 == 0 else f"d{i % 70}", cells[i]) for i in range(600)]
    df = N.clean(spark.createDataFrame(data, "id long, k string, updated_at string"), {"updated_at": N.TIMESTAMP})
    split = dedup_latest(df, "k", "updated_at__v", "updated_at", "deal", "duplicate_deal", spread=Spread(50))
    groups = defaultdict(list)
    for i, k, cell in data:
        readable = cell is not None and cell != "bad"
        groups[k].append((readable, cell if readable else "", i, cell))
    winners = {k: max(rows)[2] for k, rows in groups.items()}
    assert {r["k"]: r["id"] for r in split.kept.collect()} == winners
    want = Counter(
        (k, f"replaced row id={i} (updated_at={'NULL' if cell is None else cell}); kept id={winners[k]}")
        for k, rows in groups.items() for _, _, i, cell in rows if i != winners[k]
    )
    assert bag(split.issues.select("entity_id", "details")) == want


def test_dedup_exact_keeps_the_first_and_logs_every_copy(spark):
    data = [(i, "hot" if i % 3 == 0 else f"e{i % 50}", None if i % 2 else "x") for i in range(400)]
    df = spark.createDataFrame(data, "id long, event_id string, note string")
    split = dedup_exact(df, ["event_id", "note"], "stage_history", "event_id", "duplicate_event")
    first, copies = {}, Counter()
    for i, event, note in data:
        if (event, note) in first:
            copies[event] += 1
        first.setdefault((event, note), i)
    assert {(r["event_id"], r["note"]): r["id"] for r in split.kept.collect()} == first
    assert Counter(r["entity_id"] for r in split.issues.collect()) == copies


def test_references(spark, no_broadcast):
    rows = skewed(spark).withColumn("k", F.when(F.col("id") % 100 == 7, F.lit(" ")).otherwise(F.col("k")))
    parents = spark.createDataFrame([("hot",), ("k1",), ("k1",), ("k2",), (None,)], "key string")
    known = {"hot", "k1", "k2"}
    plain = [(r["id"], r["k"]) for r in rows.collect()]

    out, issues = resolve_fk(rows, "k", parents, "key", "deal", "id", "orphan_company", spread=Spread(100))
    assert bag(out.select("id", "k")) == Counter((i, k if k in known else None) for i, k in plain)
    assert bag(issues.select("entity_id", "details")) == Counter(
        (str(i), k) for i, k in plain if k not in known and k is not None and k.strip()
    )
    assert resolve_fk(rows, "k", parents, "key", "deal", "id")[1] is None

    split = quarantine_orphans(rows, "k", parents, "key", "payment", "id", "orphan_deal", spread=Spread(100))
    assert bag(split.kept.select("id", "k")) == Counter(p for p in plain if p[1] in known)
    assert bag(split.issues.select("entity_id")) == Counter((str(i),) for i, k in plain if k not in known)


def test_reference_carries_parent_columns(spark, no_broadcast):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, k string")
    parents = spark.createDataFrame([("a", 5)], "key string, size int")
    got = mark_reference(rows, "k", parents, "key", "hit", {"size": "parent_size"})
    assert bag(got.select("id", "hit", "parent_size")) == {(1, True, 5): 1, (2, False, None): 1, (3, False, None): 1}


@pytest.mark.parametrize("limit", ["50000", "-1"])
def test_kept_tables_give_the_same_references(spark, tmp_path, limit):
    """Few missing keys are broadcast (50 kB allowed), or everything is shuffled (-1)."""
    rows = skewed(spark).withColumn("note", F.lit("x" * 100))
    parents = spark.range(40_000).select(F.expr("if(id = 0, 'hot', 'k' || id)").alias("key"))
    known = lambda k: k is not None and (k == "hot" or int(k[1:]) > 0)
    kept_limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    work = WorkArea(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        marked = mark_reference(rows, "k", parents, "key", "hit", spread=Spread(100, work.keep))
        salted = "__salt" in marked._jdf.queryExecution().analyzed().toString()
        assert salted is (limit == "-1")
        assert bag(marked.select("id", "hit")) == Counter((r["id"], known(r["k"])) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept_limit)


def test_canonical(spark, no_broadcast):
    data = [(f"PR{i:03d}", "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"s{i % 45}")) for i in range(300)]
    df = spark.createDataFrame(data, "product_id string, sku string")
    out, issues = resolve_canonical(df, "product_id", "sku", spread=Spread(20))
    lowest = {}
    for pid, sku in data:
        lowest[sku] = min(lowest.get(sku, pid), pid)
    want = {pid: lowest[sku] if sku is not None and lowest[sku] != pid else None for pid, sku in data}
    assert {r["product_id"]: r["canonical_id"] for r in out.collect()} == want
    assert {r["entity_id"] for r in issues.collect()} == {pid for pid, canon in want.items() if canon}


def test_transitions(spark):
    stages = [*OPEN_STAGES, *CLOSING_STAGES, "OTHER", None]
    pairs = [(str(i), a, b) for i, (a, b) in enumerate((a, b) for a in stages for b in stages)]
    df = spark.createDataFrame(pairs, "event_id string, old_stage_id string, new_stage_id string")

    def illegal(a, b):
        if a is None or b is None:
            return False
        if a in OPEN_STAGES:
            nxt = OPEN_STAGES[OPEN_STAGES.index(a) + 1: OPEN_STAGES.index(a) + 2]
            return b not in nxt + CLOSING_STAGES
        return True

    out, issues = flag_illegal_transitions(df)
    assert {r["event_id"]: r["has_quality_issue"] for r in out.collect()} == {i: illegal(a, b) for i, a, b in pairs}
    assert {r["entity_id"] for r in issues.collect()} == {i for i, a, b in pairs if illegal(a, b)}


def test_rules_mark_rows_and_log_issues(spark):
    df = spark.createDataFrame([("a", -1), ("b", 2), ("c", None)], "k string, n int")
    rules = [
        Rule("negative_amount", "flagged", "n < 0", "n"),
        Rule("normalized_source", "fixed", "k = 'b'"),
    ]
    out, issues = apply_rules(df, "deal", "k", rules)
    assert {r["k"]: r["has_quality_issue"] for r in out.collect()} == {"a": True, "b": False, "c": False}
    assert bag(issues) == {
        ("deal", "a", "negative_amount", "flagged", "-1"): 1, ("deal", "b", "normalized_source", "fixed", None): 1
    }


def test_constraints_report_every_kind(spark):
    users = spark.createDataFrame(
        [("U1", True), ("U1", True), (None, None)], "user_id string, has_quality_issue boolean"
    )
    payments = spark.createDataFrame(
        [("P1", "D1", "cash", "paid", False), ("P2", "D2", "full", None, False)],
        "payment_id string, deal_id string, payment_type string, status string, has_quality_issue boolean",
    )
    deals = spark.createDataFrame([("D1",)], "deal_id string")
    specs = {name: CONSTRAINTS[name] for name in ("users", "payments")}
    got = {
        (r["table"], r["constraint"]): r["violations"]
        for r in check_constraints({"users": users, "payments": payments, "deals": deals}, specs).collect()
        if r["violations"]
    }
    assert got == {
        ("users", "user_id_not_null"): 1, ("users", "has_quality_issue_not_null"): 1, ("users", "user_id_primary_key"): 1,
        ("payments", "payment_type_domain"): 1, ("payments", "deal_id_to_deals"): 1,
    }


def test_constraints_of_all_tables_need_one_shuffle_of_keys(spark):
    tables = {
        name: spark.createDataFrame([tuple({"string": "x", "boolean": True}.get(f.dataType.typeName()) for f in schema)], T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
        for name, schema in CORE_SCHEMAS.items()
    }
    report = check_constraints(tables)
    found = {(r["table"], r["constraint"]): r["violations"] for r in report.collect()}
    assert len(found) == sum(
        len(s.not_null) + len(s.domains) + 1 + len(s.unique) + len(s.references) for s in CONSTRAINTS.values()
    )
    assert found["data_quality_issues", "action_domain"] == 1 and found["deals", "stage_id_to_pipeline_stages"] == 0
    assert found["sources", "code_unique"] == 0 and found["payments", "status_domain"] == 1
    assert "Join" not in report._jdf.queryExecution().optimizedPlan().toString()


def test_hot_and_missing_keys_are_counted_exactly(spark):
    deals = spark.range(50).selectExpr("'D' || id as deal_id").unionByName(spark.createDataFrame([("D1",), ("D1",), (None,)], "deal_id string"))
    payments = spark.range(3000).selectExpr("'P' || id as payment_id", "case when id % 3 = 0 then 'D7' when id % 3 = 1 then 'X' end as deal_id")
    specs = {"deals": Constraints("deal_id"), "payments": Constraints("payment_id", references=(("deal_id", "deals", "deal_id"),))}
    got = {r["constraint"]: r["violations"] for r in check_constraints({"deals": deals, "payments": payments}, specs).collect()}
    assert got == {"deal_id_primary_key": 1, "payment_id_primary_key": 0, "deal_id_to_deals": 1000}
    # Without the parent table the reference cannot be judged; empty tables break nothing.
    got = [r["constraint"] for r in check_constraints({"payments": payments}, specs).collect()]
    assert got == ["payment_id_primary_key"]
    assert {r["violations"] for r in check_constraints({"deals": deals.where("false"), "payments": payments.where("false")}, specs).collect()} == {0}
