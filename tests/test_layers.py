"""Layers, counts and premium on a small hand-made mart."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest

from perilframe.operators import layers as lay
from perilframe.operators.premium import link_policy_id, policy_premium
from perilframe.plans.contract import Contract
from perilframe.sources.mart import Mart, missing_columns, read_catalogue, view
from perilframe.sources.staging import Stage


@pytest.fixture(scope="module")
def mart(spark):
    def table(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    begin, end = date(2020, 1, 1), date(2021, 1, 1)
    return Mart.from_frames(spark, {
        "policy_term": table(
            [(1, "PIM", "CPP", "0000001", "01", "1", begin, end, 1, 1),
             (2, "AED", "DIC", "0000002", None, None, begin, end, 1, 0)],
            "policy_term_id bigint, business_unit_cd string, policy_symbol_cd string, "
            "policy_number_cd string, policy_module_cd string, current_version_no string, "
            "policy_term_effective_dt date, policy_term_expiration_dt date, fire_ind int, "
            "flood_ind int"),
        "risk": table([(10, 1), (11, 1), (20, 2)], "risk_id bigint, policy_term_id bigint"),
        "risk_peril_product": table(
            [(100, 10, 1, 0), (101, 11, 1, 0), (200, 20, 1, 0)],
            "risk_peril_product_id bigint, risk_id bigint, peril_id bigint, product_id bigint"),
        "product": table([(0, "PIMPROPEX", "x")],
                         "product_id bigint, product_cd string, product_desc string"),
        "peril": table([(1, "FIRE"), (8, "(none)")], "peril_id bigint, peril_cd string"),
        "excess": table(
            [(1, 1, 1, 100), (1, 8, 1, 100), (1, 1, 2, 200)],
            "policy_term_id bigint, peril_id bigint, layer_no int, limit_amt int"),
        "d_policy": table(
            [(501, "CPP", "0000001", "01", "1"), (502, "DIC", "0000002", None, None)],
            "policy_id bigint, policy_symbol string, policy_number string, policy_module string, "
            "policy_version_cd string"),
        "f_divisional_premiums": table(
            [(501, 1, 100, 2020), (501, 2, 10, 2019), (501, 3, 7, 2001), (501, 9, 1, 2020)],
            "policy_id bigint, written_transaction_id bigint, change_written_premium int, "
            "transaction_accounting_year int"),
        "d_transaction_items": table(
            [(1, "Direct"), (1, "Direct Funded"), (2, "Ceded"), (3, "Direct")],
            "transaction_items_id bigint, rein_transaction_type_desc string"),
    })


@pytest.fixture(scope="module")
def contract(mart):
    from datetime import datetime

    from perilframe.params import RunParams

    return Contract(mart, RunParams(date(2020, 6, 30), datetime(2020, 7, 1), "SRC"))


def _by_term(df, column):
    rows: dict = {}
    for r in df.collect():
        rows.setdefault(r.policy_term_id, []).append(r[column])
    return {k: sorted(v, key=str) for k, v in rows.items()}


def test_layers_fold_perils(mart):
    rows = {(r.layer_no, r.limit_amt): r for r in lay.excess_layers(mart).collect()}
    first = rows[1, Decimal("100.00")]
    assert (first.layer_fire_ind, first.layer_none_ind, first.layer_flood_ind) == (1, 1, 0)
    assert len(rows) == 2


def test_keys_read_missing_parts_as_empty(contract):
    assert _by_term(contract.layers, "spmvl") == {
        1: ["CPP0000001011-01", "CPP0000001011-02"], 2: ["DIC0000002"]
    }


def test_counts(mart, contract):
    assert _by_term(lay.layer_count(contract.layers), "layer_count") == {1: [2], 2: [0]}
    # two layers times two risks, no layer times one risk
    assert _by_term(contract.risks, "risk_count") == {1: [4], 2: [1]}
    # other peril flags are NULL here, so their sum is too
    assert _by_term(contract.perils, "policy_peril_count") == {1: [None], 2: [None]}


def test_null_key_parts_never_link(mart, contract):
    assert _by_term(link_policy_id(mart, contract.folded), "policy_id") == {1: [501], 2: [None]}


def test_premium_repeats_amounts_of_types_listed_twice(mart, contract):
    links = link_policy_id(mart, contract.folded)
    total = _by_term(policy_premium(mart, links, contract.params), "total_policy_premium")
    assert total == {1: [Decimal("211.00")], 2: [None]}
    direct = replace(contract.params, direct_premium_only=True)
    total = _by_term(policy_premium(mart, links, direct), "total_policy_premium")
    assert total == {1: [Decimal("200.00")], 2: [None]}


def test_staging_changes_nothing(spark, sf_dir):
    from perilframe.registry import PARAMS
    from perilframe.sources.testdata import mart_of_testdata

    mart = mart_of_testdata(spark, sf_dir)
    stage = Stage.of(spark)
    lazy, staged = Contract(mart, PARAMS).file(), Contract(mart, PARAMS, stage).file()
    assert len(lazy.columns) == len({c.lower() for c in lazy.columns}) == 65
    assert sorted(map(str, lazy.collect())) == sorted(map(str, staged.collect()))


def test_views(mart):
    assert "policy_term_id" not in view(mart, "policy_term").columns
    shown = view(mart, "location").columns
    assert shown.index("latitude_cd") < shown.index("longitude_cd")
    assert "street_addr_1_txt" in shown and "create_ts" not in shown
    with pytest.raises(ValueError):
        view(mart, "peril")


def test_catalogue(spark, tmp_path):
    path = tmp_path / "columns.txt"
    path.write_text("TABLE_NAME\tCOLUMN_NAME\nPERIL\tPERIL_ID\nPERIL\tPERIL_CD\n")
    missing = missing_columns(read_catalogue(spark, str(path)), spark)
    perils = {r.column_name for r in missing.filter("table_name = 'peril'").collect()}
    assert perils == {"peril_desc", "source_system_id", "create_ts", "update_ts"}
