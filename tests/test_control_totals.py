from __future__ import annotations

import random
from decimal import Decimal

import pytest

from perilframe.plans import control_totals as ct

LOC_DDL = ("ContractID string, LocationID string, BuildingValue string, OtherValue string, "
           "ContentsValue string, TimeElementValue string, OccupancyCode string, "
           "ConstructionCode string, CountryISO string, Area string")


def _places(frame, rows):
    """Rows of dictionaries; values default to 0."""
    base = {"ContractID": "C", "LocationID": "L", "BuildingValue": "0", "OtherValue": "0",
            "ContentsValue": "0", "TimeElementValue": "0", "OccupancyCode": None,
            "ConstructionCode": None, "CountryISO": "US", "Area": None}
    return frame([tuple((base | r).values()) for r in rows], LOC_DDL)


def _tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counts_show_empty_snapshots(frame):
    files = {"a": frame([(1,), (2,)], "x int"), "b": frame([], "x int")}
    assert _tuples(ct.snapshot_counts(files, "db")) == [("a", 2), ("b", 0)]


def test_sum_reads_blank_as_zero(frame):
    files = {"a": frame([("1.5",), ("",), (None,), ("2",)], "v string")}
    assert _tuples(ct.snapshot_sum(files, "v", "db", "total")) == [("a", 3.5)]


def test_value_counts_skip_blanks(frame):
    files = {"a": frame([("P",), ("P",), ("",), ("  ",), (None,)], "v string"),
             "b": frame([("P",)], "v string")}
    assert _tuples(ct.value_counts(files, "v")) == [("a", "P", 2), ("b", "P", 1)]


@pytest.mark.parametrize(
    "contract, short", [("CPP000000199", "0000001"), ("CPP0000001", "CPP0000"), ("AB", "AB")]
)
def test_short_policy(frame, contract, short):
    rows = frame([(contract,)], "c string")
    assert rows.select(ct.short_policy(rows.c)).first()[0] == short


def test_drift_pairs_contracts_by_policy(frame):
    now = _places(frame, [{"ContractID": "CPP000000101", "LocationID": x} for x in "aab"]
                  + [{"ContractID": "NEW000000901"}])
    old = _places(frame, [{"ContractID": "CPP000000199", "LocationID": x} for x in "abc"]
                  + [{"ContractID": "CPP000000100", "LocationID": None}])
    assert [tuple(r) for r in ct.location_count_drift(now, old).collect()] == [
        ("CPP000000199", 3, "CPP000000101", 2, 1), ("CPP000000100", 0, "CPP000000101", 2, -2)
    ]


def test_orphans_against_brute_force(frame):
    rng = random.Random(3)
    ids = ["HOT", *(f"C{i}" for i in range(30)), None]
    left = [(rng.choice(["HOT", *ids]),) for _ in range(300)]
    right = [(rng.choice(ids[:20] + ["HOT"] * 10), rng.choice([None, "x"])) for _ in range(300)]
    found = ct.orphans(frame(left, "ContractID string"),
                       frame(right, "ContractID string, LocationID string"), "LocationID")
    matched = {c for c, v in right if c is not None and v is not None}
    expected = {(c,) for c, in left} - {(m,) for m in matched}
    assert {(r[0],) for r in found.collect()} == expected


@pytest.mark.parametrize(
    "value, layer, exposure",
    [
        ("1234567-01", "7Digit-mod", "7Digit-mod"),
        ("CPP123456701-01", "SymPolMod-LayerNumber", "Check these"),
        ("CPP123456701", "Sym+Pol+Mod", "Sym+Pol+Mod"),
        ("CPP123456701 ", "Sym+Pol+Mod", "Sym+Pol+Mod"),
        ("12-4567-01", "Check these", "Check these"),
        (None, "Check these", "Check these"),
    ],
)
def test_formats(frame, value, layer, exposure):
    rows = frame([(value,)], "id string")
    for layered, expected in ((True, layer), (False, exposure)):
        (row,) = ct.format_profile(rows, "id", layered).collect()
        assert (row["id_Format"], row["row_count"]) == (expected, 1)


def test_occupancy_drift(frame):
    now = _places(frame, [{"OccupancyCode": c} for c in ("300", "300", "301", None)])
    old = _places(frame, [{"OccupancyCode": c} for c in ("300", "302")])
    ref = frame([("300", "Home", "US"), ("301", "Shop", "CA")],
                "code string, description string, region string")
    assert _tuples(ct.occupancy_drift(now, old, ref)) == sorted([
        ("300", "Home", 2, 1, 1), ("301", None, 1, None, 1), ("302", None, None, 1, -1),
        (None, None, None, None, 0), ("TOTAL", "", 3, 2, 1),
    ], key=str)


def test_construction_counts_repeat_over_countries(frame):
    now = _places(frame, [{"ConstructionCode": "100", "CountryISO": c} for c in ("US", "MX", "CL")])
    old = _places(frame, [{"ConstructionCode": "100", "CountryISO": "US"}])
    ref = frame([("100", "G", "Wood", "US")],
                "code string, category string, description string, region string")
    assert _tuples(ct.construction_drift(now, old, ref)) == sorted([
        ("100", "G", "Wood", 3, 1, 2), ("100", None, None, 6, 2, 4), ("TOTAL", "", "", 9, 3, 6),
    ], key=str)
    assert _tuples(ct.construction_drift(now, old, ref, country_aware=True)) == sorted([
        ("100", "G", "Wood", 1, 1, 0), ("100", None, None, 2, None, 2), ("TOTAL", "", "", 3, 1, 2),
    ], key=str)


@pytest.fixture
def states(frame):
    now = _places(frame, [
        {"Area": "OH", "BuildingValue": "1500"}, {"Area": "OH", "OtherValue": None},
        {"Area": "NEW", "BuildingValue": "7"}, {"Area": "ZERO", "BuildingValue": "5"},
        {"Area": None, "BuildingValue": "3"},
    ])
    old = _places(frame, [
        {"Area": "OH", "BuildingValue": "1000"}, {"Area": "LOST", "BuildingValue": "9"},
        {"Area": "ZERO"}, {"Area": None},
    ])
    return now, old


def test_state_totals(states):
    rows = {r.State: r for r in ct.state_totals(*states).collect()}
    ohio = rows["OH"]
    assert tuple(ohio)[1:] == ("$1,500", "$1,000", "$500", "50.00 %", "2", "1", "1", "100.00 %")
    assert rows["ZERO"]["TIV % Change"] is None
    assert "LOST" not in rows and "NEW" not in rows and None in rows


def test_state_rollup_labels(states):
    shared = sorted(r.State for r in ct.state_rollup(*states).collect())
    assert shared == ["OH", "TOTAL", "TOTAL", "ZERO"]
    rows = {r.State: r for r in ct.state_rollup(*states, label_new=True).collect()}
    assert set(rows) == {"OH", "ZERO", "(new)", "TOTAL"}
    assert rows["TOTAL"]["Current_TIV"] == "$1,515"
    assert rows["(new)"]["Prior_TIV"] is None


def test_orphan_exposures_keep_every_nameless_layer_row(frame):
    ceded = frame([("A", "X"), ("B", "Y"), ("C", None), ("D", "Z")],
                  "ContractID string, ExposureID string")
    contract = frame([("c", "X"), (None, "Y"), (None, "Y"), ("d", "Y")],
                     "ContractID string, LayerID string")
    assert _tuples(ct.orphan_exposures(ceded, contract)) == sorted([
        ("B", None, "Y", "Y"), ("B", None, "Y", "Y"), ("C", None, None, None),
        ("D", None, "Z", None),
    ], key=str)


def test_exact_sums_do_not_depend_on_order(frame):
    rows = [(str(Decimal(i) / 100),) for i in range(2000)]
    for parts in (1, 7, 32):
        files = {"a": frame(rows, "v string").repartition(parts)}
        assert ct.snapshot_sum(files, "v", "db", "total").first()["total"] == 19990.0


def test_whole_report_on_own_files(spark, sf_dir):
    """Both files written for two dates feed the control totals."""
    from dataclasses import replace
    from datetime import date

    from pyspark.sql import functions as F

    from perilframe.plans.contract import Contract
    from perilframe.plans.location import location_file
    from perilframe.registry import PARAMS
    from perilframe.sources.testdata import mart_of_testdata

    mart = mart_of_testdata(spark, sf_dir)
    contract, location = {}, {}
    for name, day in (("current", date(1998, 12, 31)), ("prior", date(1998, 6, 30))):
        run = replace(PARAMS, as_of=day)
        contract[name] = Contract(mart, run).file().withColumn(
            "SublimitPerils", F.col("SublimitArea")
        )
        location[name] = location_file(mart, run).select(
            "ContractID", "LocationID", "DeductBldg", "CountryISO", "Area",
            *(F.col(v).cast("string").alias(v) for v in ct.VALUES),
            F.lit("300").alias("OccupancyCode"), F.lit("100").alias("ConstructionCode"),
        )
    checks = ct.report(
        contract, location, mart["occupancy_codes"], mart["construction_codes"],
        reinsurance=contract["current"].select("ContractID", F.col("LayerID").alias("ExposureID")),
        rollup=True,
    )
    assert len(checks) == 14
    assert checks["Exposures without layer"].count() == 0
    totals = {r.State: r for r in checks["State totals"].collect()}
    # the location file leaves one value empty, so no total insured value can be known
    assert totals["TOTAL"]["Current_TIV"] is None and totals["TOTAL"]["Current_Locs"] is not None
    without = ct.report(contract, location, mart["occupancy_codes"], mart["construction_codes"])
    assert len(without) == 12
