"""Shape of the physical plans, and where results are written."""

from __future__ import annotations

import contextlib
import io

import pytest

from perilframe.operators.spine import add_perils, add_risks, add_structures
from perilframe.plans import quality as dq
from perilframe.plans.location import location_file
from perilframe.registry import PARAMS, QUERIES
from perilframe.sources import publish
from perilframe.sources.testdata import mart_of_testdata


def plan_of(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("NestedLoop", "CartesianProduct", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in plan


def test_date_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["pif_contract"](spark, sf_dir))
    assert "LessThanOrEqual(policy_term_effective_dt,1998-12-31)" in plan
    assert "GreaterThan(policy_term_expiration_dt,1998-12-31)" in plan
    assert "ReadSchema: struct<risk_id:bigint,policy_term_id:bigint>" in plan
    assert "ReadSchema: struct<risk_id:bigint,product_id:bigint>" in plan


def test_sample_keeps_few_rows_per_group_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["pif_sample_top5"](spark, sf_dir))
    assert "WindowGroupLimit" in plan


def test_bucketed_mart_joins_risks_without_a_shuffle(spark, sf_dir):
    mart = mart_of_testdata(spark, sf_dir)
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    tables = ("risk", "risk_property_structure", "covered_property_structure",
              "risk_peril_product")
    publish.write_bucketed(mart, "bucketed", 4, tables)
    stored = {t: spark.table(f"bucketed.{t}") for t in tables}
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored["risk"].alias("risk")
        for table in tables[1:]:
            joined = joined.join(stored[table], "risk_id")
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    big = publish.bucketed_mart(spark, "bucketed", mart)
    assert big["risk"].count() == mart["risk"].count()
    assert big["peril"].count() == 8


def test_hot_term_joins_split(spark):
    """A term with most of the risks: the risk join keeps every row."""
    from perilframe.sources.mart import Mart

    risks = spark.range(6000).selectExpr(
        "id AS risk_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS policy_term_id",
        "id % 2 AS location_id")
    mart = Mart.from_frames(spark, {
        "risk": risks,
        "location": spark.range(2).selectExpr("id AS location_id"),
        "risk_property_structure": spark.range(6000).selectExpr("id AS risk_id"),
        "covered_property_structure": spark.range(6000).selectExpr("id AS risk_id"),
        "risk_peril_product": spark.range(6000).selectExpr(
            "id AS risk_peril_product_id", "id AS risk_id", "1L AS peril_id", "0L AS product_id"),
    })
    terms = risks.select("policy_term_id").distinct().alias("t")
    rows = add_perils(add_structures(add_risks(terms, mart, "t"), mart), mart)
    assert rows.count() == 6000


def test_files_are_written_by_period_and_line(spark, sf_dir, tmp_path):
    file = QUERIES["contract_file"](spark, sf_dir)
    path = str(tmp_path / "contract")
    publish.write_file(file, path, publish.CONTRACT_PARTITIONS)
    back = spark.read.parquet(path)
    assert back.count() == file.count()
    one = back.filter("ModPeriod = '1998-12-31' AND LOB = 'PIMx'")
    assert "PartitionFilters: [isnotnull(ModPeriod" in plan_of(one)


def test_location_file_survives_parquet_and_csv(spark, sf_dir, tmp_path):
    file = location_file(mart_of_testdata(spark, sf_dir), PARAMS)
    publish.write_snapshot(file, str(tmp_path), "now")
    back = publish.read_snapshots(spark, str(tmp_path), ["now"])["now"]
    assert set(back.columns) == set(file.columns)
    publish.write_csv(back, str(tmp_path / "csv"))
    text = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert text.count() == back.count()
    publish.publish_view(back, "location_export")
    assert spark.table("location_export").count() == back.count()


def test_named_blankets(spark, sf_dir):
    from perilframe.plans.contract import Contract

    contract = Contract(mart_of_testdata(spark, sf_dir), PARAMS)
    term = contract.groups.first()["policy_term_id"]
    rows = dq.blankets_of(contract.layers, contract.groups, (term,)).collect()
    assert rows and {r.policy_term_id for r in rows} == {term}
