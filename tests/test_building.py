"""Test tables built from groups of the lines, against the plain SQL they stand for."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from perilframe.plans.contract import Contract
from perilframe.plans.location import location_file
from perilframe.registry import PARAMS, QUERIES
from perilframe.sources import testdata as td

DAY = datetime(1998, 5, 1)
LINES = [
    # order, part, supplier, line, quantity, price, return flag, status, shipped
    (1, 5, 1, 1, 10.0, 100.5, "R", "F", DAY),
    (1, 6, 3, 1, 50.0, 90.25, "N", "O", DAY),
    (1, 6, 3, 1, 50.0, 90.25, "N", "O", DAY),
    (1, 7, 2, 2, 30.0, 80.0, "R", "F", DAY),
    (1, 7, 2, 12, 3.0, 70.0, "A", "F", DAY),
    (1, 7, 1, 2, 4.0, 60.0, "A", "F", DAY),
    (3, 8, 2, 7, 46.0, 55.0, "N", "O", None),
    (3, None, None, 7, 46.0, 54.0, "N", None, DAY),
    (5, 9, 2, None, None, None, None, "F", DAY),
    (5, 9, 2, 3, 1.0, 20.0, "N", "O", DAY),
    (5, 9, None, None, 2.0, 21.0, "R", "F", DAY),
    (10, 4, 2, 1, 2.0, 10.0, "N", "O", DAY),
    (10, 4, 2, 2, 2.0, 11.0, "N", "O", DAY),
    (None, 4, 2, 2, 2.0, 12.0, "N", "O", DAY),
]
ORDERS = [
    (1, 1, "P", datetime(1998, 3, 1), "1-URGENT"), (3, 2, "O", datetime(1998, 2, 1), "3-MEDIUM"),
    (3, 2, "O", datetime(1998, 2, 1), "3-MEDIUM"), (5, None, None, datetime(1997, 9, 1), None),
    (10, 3, "P", datetime(1998, 1, 1), "2-HIGH"), (11, 3, "F", None, "5-LOW"),
]
SMALL = {
    "region": [(0, "AFRICA"), (1, "AMERICA")],
    "nation": [(0, "ALGERIA", 0), (1, "CANADA", 1)],
    "customer": [(1, "one", "A"), (2, "two", "B"), (3, "three", None)],
    "supplier": [(1, "s1", 0), (2, "s2", 1), (3, "s3", 1)],
}


@pytest.fixture(scope="module", params=["odd rows", "plain rows"])
def folder(request, spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    plain = [r for r in LINES if None not in r[:4] and r[3] < 10]
    rows = SMALL | {"orders": ORDERS, "lineitem": LINES if request.param == "odd rows" else plain}
    for table, ddl in td.BASE_SCHEMAS.items():
        spark.createDataFrame(rows[table], ddl).write.parquet(f"{root}/{table}.parquet")
    return root


def _same(found, wanted) -> None:
    assert found.dtypes == wanted.dtypes
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


@pytest.mark.parametrize("table", td.LOADED)
def test_tables_are_those_of_the_sql(spark, folder, table):
    wanted = td._run(spark, td.base_frames(spark, folder), td.typed_body(table))
    _same(td.mart_of_testdata(spark, folder)[table], wanted)


def test_snapshots_are_those_of_the_sql(spark, folder):
    found = td.snapshots_of_testdata(spark, folder, "location")
    for name, day in td.SNAPSHOTS.items():
        wanted = td._run(spark, td.base_frames(spark, folder), td.location_snapshot(day))
        _same(found[name], wanted)


@pytest.fixture
def written(spark, folder, tmp_path, monkeypatch):
    """Names of the folders written by queries on a fresh set of groups."""
    monkeypatch.setattr(td, "_groups", {})
    monkeypatch.setattr(td.Stage, "of", lambda session: td.Stage(session, str(tmp_path)))
    return lambda: {n for _, names, _ in os.walk(f"{tmp_path}/perilframe") for n in names}


def test_only_narrow_groups_are_written(spark, folder, written):
    QUERIES["heritage_extract"](spark, folder).collect()
    tables = written() & set(td.LOADED)
    assert "lines" in written() and tables <= {"excess"}


def test_only_the_snapshots_asked_for_are_written(spark, folder, written):
    QUERIES["ct_location_orphans"](spark, folder).collect()
    assert {n for n in written() if n.startswith("location_")} == {"location_current"}


def test_lines_are_dealt_by_rows_before_they_are_grouped(spark, folder, written, monkeypatch):
    monkeypatch.setattr(td, "ROWS_PER_TASK", 2)
    dealt = []
    keep = td.Stage.keep
    monkeypatch.setattr(td.Stage, "keep", lambda self, f, n: dealt.append(f) or keep(self, f, n))
    td.mart_of_testdata(spark, folder)["risk"].collect()
    for frame in dealt:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        # No hashing of a whole split before the shuffle.
        assert plan.count("Exchange") == 1 and "HashAggregate" not in plan[plan.index("Exchange"):]


@pytest.mark.parametrize("name", ["dq_initial_final", "dq_initial_final_policy"])
def test_detail_and_file_are_not_joined_in_one_plan(spark, folder, written, name):
    frame = QUERIES[name](spark, folder)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert {"initial_rows", "final_rows"} <= written()
    # Structures are read by detail and file alone.
    assert "rps_id" not in plan


def test_groups_by_risk_lie_where_the_lines_lie(spark, folder, written):
    mart = td.mart_of_testdata(spark, folder)
    joined = mart["risk"].hint("merge").join(mart["covered_property_structure"], "risk_id")
    joined = joined.join(td._run(spark, td._groups_of(spark, folder), td._RPP_LINES).hint("merge"), "risk_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert "lines" in written() and not written() & {"by_risk", "places", "flags"}


def test_orders_with_flags_are_shuffled_once(spark, folder, written, monkeypatch):
    monkeypatch.setattr(td, "ROWS_PER_TASK", 2)
    groups = td._groups_of(spark, folder)
    groups["lines"]
    monkeypatch.setattr(td.Stage, "keep_bucketed", lambda self, frame, *_: frame)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = groups["flagged_orders"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One shuffle of the orders and one of the flags; neither the join nor the buckets ask for more.
    assert plan.count("Exchange") == 2 and plan.count("REPARTITION_BY_NUM") == 2


def test_structures_lie_where_the_lines_lie_if_ids_tell_their_risk(spark, folder, written):
    odd = td._groups_of(spark, folder)["lines"].filter("risk_id IS NULL OR l_linenumber IS NULL")
    plan = td.mart_of_testdata(spark, folder)["risk_property_structure"]._jdf.queryExecution().executedPlan()
    assert ("by_structure" in written()) == (not odd.isEmpty())
    assert "Exchange" not in plan.toString()


def test_sides_of_the_contract_file_are_written_before_they_meet(spark, folder, written):
    QUERIES["contract_file"](spark, folder)
    assert {"premium", "deductible", "groups", "blankets"} <= {n.rsplit("_", 1)[0] for n in written()}


def test_lines_hold_no_amount_twice_and_flags_are_shuffled_as_bits(spark, folder, written):
    groups = td._groups_of(spark, folder)
    lines = groups["lines"]
    assert lines.filter("lesser_amt = amt").isEmpty()
    assert lines.filter("lesser_amt = 90.25 AND amt = 100.5").count() == 1
    assert td._run(spark, groups, td._RISK_FLAGS).columns == ["l_orderkey", "bits"]


def test_location_file_moves_the_risks_in_force_alone(spark, folder, written, tmp_path):
    mart = td.mart_of_testdata(spark, folder)
    staged = location_file(mart, PARAMS, stage=td.Stage(spark, str(tmp_path)))
    assert [n for n in written() if n.startswith("risks_in_force_")]
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    # Every place that reads risks keeps those ids only.
    assert plan.count("Join LeftSemi, (risk_id") >= 4
    _same(staged, location_file(mart, PARAMS))


@pytest.mark.parametrize("most, broadcast", [("48k", False), ("10MB", True)])
def test_packed_sides_of_the_contract_file_are_sized_by_their_rows(spark, tmp_path, monkeypatch, most, broadcast):
    """4,000 terms take 64 KB unpacked, their files and the shares of single columns far less."""
    orders = spark.range(1, 4001).selectExpr(
        "id AS o_orderkey", "id % 3 + 1 AS o_custkey", "'O' AS o_orderstatus",
        "TIMESTAMP_NTZ '1998-05-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    lines = orders.selectExpr(
        "o_orderkey AS l_orderkey", "5L AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber", "10.0D AS l_quantity",
        "100.5D AS l_extendedprice", "'N' AS l_returnflag", "'O' AS l_linestatus", "o_orderdate AS l_shipdate")
    for table, ddl in td.BASE_SCHEMAS.items():
        rows = {"orders": orders, "lineitem": lines}.get(table)
        (rows or spark.createDataFrame(SMALL[table], ddl)).write.parquet(f"{tmp_path}/{table}.parquet")
    mart, plans, keep = td.mart_of_testdata(spark, str(tmp_path)), {}, td.Stage.keep

    def seen(self, frame, name):
        plans[name.rsplit("_", 1)[0]] = frame._jdf.queryExecution().executedPlan().toString()
        return keep(self, frame, name)

    monkeypatch.setattr(td.Stage, "keep", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    try:
        file = Contract(mart, PARAMS, td.Stage(spark, str(tmp_path))).file()
        plans["file"] = file._jdf.queryExecution().executedPlan().toString()
        assert file.count() > 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sides = {n for n in ("premium", "blankets", "groups", "deductible", "file") if "BroadcastHashJoin [policy_term_id" in plans[n]}
    assert bool(sides) == broadcast, sides
