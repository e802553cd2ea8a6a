"""Salted joins, semi-joined side branches, ranges from the data, remote tables."""

from __future__ import annotations

import contextlib
import io
from datetime import date

import pytest
from pyspark.sql import functions as F

from perilframe import schema
from perilframe.operators import pif
from perilframe.operators.skew import heavy_keys, salted_join
from perilframe.params import RunParams
from perilframe.plans import control_totals as ct
from perilframe.plans.contract import Contract
from perilframe.plans.location import location_file, location_pif
from perilframe.registry import PARAMS, QUERIES
from perilframe.sources import publish
from perilframe.sources.mart import JdbcTable, Mart
from perilframe.sources.staging import Stage
from perilframe.sources.testdata import mart_of_testdata


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def plan_of(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


def skewed(spark):
    """A third of the rows has no key, a third has key 1."""
    return spark.range(60_000).selectExpr(
        "id AS fact", "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE id END AS policy")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_a_plain_one(spark, how):
    left = skewed(spark).limit(3000)
    right = spark.range(200).selectExpr("id AS policy", "id * 2 AS premium").union(
        spark.sql("SELECT 1L, 7L UNION ALL SELECT NULL, 9L"))
    heavy = spark.createDataFrame([(1,)], "policy long")
    rows = lambda f: sorted(map(str, f.select(*sorted(f.columns)).collect()))
    assert rows(salted_join(left, right, ["policy"], how, heavy, 8)) == rows(left.join(right, "policy", how))


def test_salted_join_spreads_hot_and_missing_keys(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    right = spark.range(60_000).selectExpr("id AS policy", "id * 2 AS premium")
    with settings(spark, **{k: v for k, v in conf.items()}):
        def most(frame):
            return max(r["count"] for r in frame.groupBy(F.spark_partition_id().alias("p")).count().collect())

        plain = skewed(spark).join(right, "policy", "left")
        salted = salted_join(skewed(spark), right, ["policy"], "left")
        assert salted.count() == plain.count() == 60_000
        assert most(plain) > 20_000 and most(salted) < 2 * 60_000 / 16


def test_heavy_keys_are_few(spark):
    assert [r.policy for r in heavy_keys(skewed(spark), ["policy"]).collect()] == [1]
    assert heavy_keys(skewed(spark), ["policy"], rows=0).count() <= 1000
    assert heavy_keys(skewed(spark).limit(0), ["policy"], rows=0).count() == 0


def test_a_line_reads_its_own_terms_in_every_branch(spark, sf_dir):
    """Each aggregate of a side branch stands above a semi join with the kept terms."""
    mart = mart_of_testdata(spark, sf_dir)
    line = F.col("UDF5") == "GARS_Condo"
    contract = Contract(mart, PARAMS, Stage.of(spark))
    whole, kept = plan_of(contract.file()), plan_of(contract.file(line))
    assert kept.count("LeftSemi") >= whole.count("LeftSemi") + 5
    only = contract.only(line)
    for step in (only.premium, only.risks, only.blankets, only.perils):
        plan = plan_of(step)
        semi = max(i for i, x in enumerate(plan.splitlines()) if "LeftSemi" in x)
        top = min(i for i, x in enumerate(plan.splitlines()) if "Aggregate" in x)
        assert top < semi  # lines further down stand below
    assert only.risks.count() < contract.risks.count()
    premium = contract.only(F.col("Premium") > 0)
    assert premium is contract  # names no terms beforehand
    rows = lambda f: sorted(map(str, f.collect()))
    assert rows(contract.file(F.col("Premium") > 0)) == rows(contract.file().filter("Premium > 0"))


def test_a_location_predicate_of_any_column(spark, sf_dir):
    mart = mart_of_testdata(spark, sf_dir)
    whole, line = plan_of(location_file(mart, PARAMS)), plan_of(location_file(mart, PARAMS, F.col("UDF5") == "ALT"))
    assert line.count("LeftSemi") >= whole.count("LeftSemi") + 3
    assert "Window" not in whole and "collect_list" not in whole
    rows = lambda f: sorted(map(str, f.collect()))
    found = location_file(mart, PARAMS, F.col("country_cd") == "US")
    wanted = location_file(mart, PARAMS).filter("CountryISO = 'US'")
    assert found.count() and rows(found) == rows(wanted)


def test_ranges_follow_the_ids(spark, sf_dir):
    policies = location_pif(mart_of_testdata(spark, sf_dir), PARAMS)
    borders = pif.id_borders(policies, rows_per_range=50)
    assert len(borders) >= pif.LEAST_RANGES
    counts = [policies.filter(F.col("policy_term_id").between(a, b)).count() for a, b in zip(borders, borders[1:])]
    assert max(counts) < 4 * 50
    far = spark.range(1000).selectExpr(
        "CASE WHEN id < 900 THEN id ELSE id * 1000000000 END AS policy_term_id", "'A' AS business_unit_cd",
        "id AS product_id", "'d' AS product_desc")
    numbered = pif.number_in_group(far, rows_per_range=100)
    assert sorted(r.bu_product_row_number for r in numbered.collect()) == list(range(1, 1001))


def test_files_written_again_replace_their_own_folders(spark, sf_dir, tmp_path):
    path = str(tmp_path / "file")
    rows = [("2020", a, c, i) for a in "xy" for c, i in (("b", 2), ("a", 1), ("a", 0))]
    file = spark.createDataFrame(rows, "ModPeriod string, LOB string, ContractID string, LayerID int")
    publish.write_file(file, path, publish.CONTRACT_PARTITIONS, order=publish.CONTRACT_ORDER)
    publish.write_file(file.filter("LOB = 'x' AND LayerID = 2"), path, publish.CONTRACT_PARTITIONS, "replace")
    publish.write_file(file.filter("LOB = 'x' AND LayerID = 2"), path, publish.CONTRACT_PARTITIONS, "replace")
    back = publish.read_file(spark, path, file)
    assert back.columns == file.columns and back.dtypes == file.dtypes
    found = [tuple(r) for r in back.collect()]
    assert [r for r in found if r[1] == "y"] == [("2020", "y", "a", 0), ("2020", "y", "a", 1), ("2020", "y", "b", 2)]
    assert [r for r in found if r[1] == "x"] == [("2020", "x", "b", 2)]


def test_keys_of_the_other_dialect(frame):
    left = ct.collated_keys(frame([("Ab ", "L1"), ("c", "L2"), (None, "L3")], "ContractID string, LocationID string"))
    right = ct.collated_keys(frame([("aB", "x"), ("C  ", None)], "ContractID string, LocationID string"))
    found = ct.plain_keys(ct.orphans(left, right, "LocationID"))
    assert {r.ContractID for r in found.collect()} == {"c", None}
    assert dict(found.dtypes)["ContractID"] == "string"


def test_report_reads_each_snapshot_once(spark, sf_dir):
    from perilframe.sources.testdata import snapshots_of_testdata

    location = snapshots_of_testdata(spark, sf_dir, "location")
    contract = snapshots_of_testdata(spark, sf_dir, "contract")
    plan = plan_of(ct.report_rows(contract, location))
    single = sum(plan_of(f).count("FileScan") for f in (*location.values(), *contract.values()))
    assert plan.count("FileScan") == single
    checks = {r["check"] for r in QUERIES["ct_report"](spark, sf_dir).select("check").distinct().collect()}
    more = {r["check"] for r in QUERIES["ct_report_reinsured"](spark, sf_dir).select("check").distinct().collect()}
    assert more - checks == {"reinsurance rows", "reinsurance ExposureFormat"} and len(checks) >= 9


def test_rejected_values(frame):
    file = frame([("1.5",), (" ",), ("x",), (None,), ("-2",)], "amount string")
    row = ct.rejected_values({"now": file}, ("amount",)).first()
    assert (row.row_count, row.missing, row.blank, row.rejected, row.total) == (5, 1, 1, 1, -0.5)


def test_dates_as_text():
    params = RunParams.of_text("30.06.2020", "01.07.2020", "SRC", "%d.%m.%Y", direct_premium_only=True)
    assert params.as_of == date(2020, 6, 30) and params.now.year == 2020 and params.direct_premium_only
    with pytest.raises(ValueError):
        RunParams.of_text("2020-06-30", "2020-07-01", "SRC", "%d.%m.%Y")


def test_options_of_remote_tables():
    assert JdbcTable().options("risk", "dbo.") == {"dbtable": "dbo.risk"}
    read = JdbcTable(bounds=(1, 900), partitions=9, fetch=5000).options("risk")
    assert read == {"dbtable": "risk", "fetchsize": "5000", "partitionColumn": "risk_id", "lowerBound": "1",
                    "upperBound": "900", "numPartitions": "9"}
    with pytest.raises(ValueError, match="borders"):
        JdbcTable(bounds=(1, 9)).options("d_producer")
    source = JdbcTable(name="PRODUCERS", key="producer_code", borders=("G", "O'N"))
    assert source.options("d_producer") == {"dbtable": "PRODUCERS"}
    assert source.predicates() == ["producer_code < 'G' OR producer_code IS NULL",
                                   "producer_code >= 'G' AND producer_code < 'O''N'", "producer_code >= 'O''N'"]
    with pytest.raises(ValueError, match="rise"):
        JdbcTable(key="producer_code", borders=("b", "a")).predicates()


def test_tables_under_other_names(spark, tmp_path):
    columns = ", ".join(f"CAST(NULL AS {schema.column_type(c)}) AS {c}" for c in schema.columns("peril"))
    spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / "XPERIL"))
    mart = Mart.from_parquet(spark, str(tmp_path), {"peril": "XPERIL"})
    assert mart["peril"].count() == 1
