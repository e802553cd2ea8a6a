from __future__ import annotations

from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from perilframe.operators import perils as per
from perilframe.plans import location as loc
from perilframe.registry import PARAMS
from perilframe.sources.testdata import mart_of_testdata

CELL_DDL = "policy_term_id bigint, risk_id bigint, peril_cd string, " + ", ".join(
    f"{c} {'decimal(9,4)' if c.endswith('pcnt') else 'decimal(18,2)'}"
    for c in per.MEASURES.values()
)
FLAG_DDL = "policy_term_id bigint, risk_id bigint, " + ", ".join(f"{f} int" for f in per.RISK_FLAGS)


def _cells(frame, rows):
    """Rows of (risk, peril, {measure: amount})."""
    full = []
    for risk, peril, amounts in rows:
        values = (amounts.get(short) for short in per.MEASURES)
        full.append((1, risk, peril, *(None if v is None else Decimal(v) for v in values)))
    return frame(full, CELL_DDL)


def test_pivot_takes_the_maximum_and_keeps_unlisted_perils(frame):
    cells = _cells(frame, [
        (1, "FIRE", {"bldg_limit": "5"}), (1, "FIRE", {"bldg_limit": "7", "bi_limit": "1"}),
        (1, "FLOOD", {}), (2, "(none)", {"bldg_limit": "9"}), (3, None, {}),
    ])
    rows = {r.risk_id: r.asDict() for r in per.pivot_terms(per.limit_deductible(cells)).collect()}
    assert set(rows) == {1, 2, 3}
    assert len(rows[1]) == 2 + 56
    assert (rows[1]["FIRE_bldg_limit"], rows[1]["FIRE_bi_limit"]) == (7, 1)
    assert all(v is None for k, v in rows[2].items() if "_limit" in k)


BLOCKS = [
    # flag, measures -> limit type, building limit, deductible type, building deductible
    (0, {"bldg_limit": "5", "bldg_ded_amt": "9"}, ("", "", "", "")),
    (1, {}, ("", "", "N", "")),
    (1, {"bldg_limit": "100000000"}, ("C", "100000000", "N", "")),
    (1, {"bldg_ded_amt": "9.5", "bldg_ded_pcnt": "2"}, ("", "", "C", "9.5")),
    (1, {"bldg_ded_pcnt": "2"}, ("", "", "C", "0.02")),
    (1, {"bldg_ded_amt": "9"}, ("", "", "S", "9")),
    (1, {"cnts_limit": "4"}, ("C", "", "N", "")),
    (None, {"bldg_limit": "5"}, ("C", "5", "N", "")),
]


@pytest.mark.parametrize("flag, amounts, expected", BLOCKS)
def test_deductible_block(frame, flag, amounts, expected):
    pivot = per.pivot_terms(per.limit_deductible(_cells(frame, [(1, "HURRICANE", amounts)])))
    flags = frame([(1, 1, *(flag for _ in per.RISK_FLAGS))], FLAG_DDL)
    (row,) = per.peril_block_rows(flags, pivot, 2).collect()
    names = ("LocLimitType 2", "LimitBldg 2", "DeductType 2", "DeductBldg 2")
    assert tuple(row[n] for n in names) == expected


@pytest.mark.parametrize("flag, kind", [(0, ""), (1, "N"), (None, "")])
def test_flat_block(frame, flag, kind):
    cells = _cells(frame, [(1, "FIRE", {"bldg_ded_amt": "9"})])
    flags = frame([(1, 1, *(flag for _ in per.RISK_FLAGS))], FLAG_DDL)
    (row,) = per.peril_block_rows(flags, per.pivot_terms(per.limit_deductible(cells)), 1).collect()
    assert (row.DeductType, row.DeductBldg) == (kind, "")


def test_structures_of_a_risk_combine_over_all_blocks(frame):
    """Two structures with different flags: every combination, as five joins would give."""
    flags = [(1, 7, *(f for _ in per.RISK_FLAGS)) for f in (0, 1)]
    pivot = per.pivot_terms(
        _cells(frame, [(7, p, {"bldg_limit": "5"}) for p, _ in per.BLOCKS.values()]).drop(
            "policy_term_id"
        ),
        ("risk_id",),
    )
    rows = loc._with_blocks(frame(flags, FLAG_DDL), pivot, one_structure=False).collect()
    names = [per.block_name("LocLimitType", n) for n in per.BLOCKS]
    found = sorted((r.structure_fire_ind, *(r[n] for n in names)) for r in rows)
    assert found == sorted((f, *c) for f in (0, 1) for c in product(("", "C"), repeat=5))


def test_one_structure_gives_the_same_file_or_stops(spark, sf_dir):
    mart = mart_of_testdata(spark, sf_dir)
    folded = loc.fold_products(loc.location_pif(mart, PARAMS))
    selection = loc.location_selection(mart, folded, PARAMS)
    pivot = loc.location_pivot(mart, PARAMS)
    single = selection.groupBy("risk_id").agg(F.count("*").alias("n")).filter("n = 1")
    alone = selection.join(single, "risk_id", "left_semi")
    strict = loc.location_rows(alone, pivot, PARAMS, one_structure=True)
    loose = loc.location_rows(alone, pivot, PARAMS)
    assert sorted(map(str, strict.collect())) == sorted(map(str, loose.collect()))
    with pytest.raises(Exception, match="several structures"):
        loc.location_rows(selection, pivot, PARAMS, one_structure=True).collect()


def test_file_has_its_columns(spark, sf_dir):
    file = loc.location_file(mart_of_testdata(spark, sf_dir), PARAMS)
    assert len(file.columns) == len({c.lower() for c in file.columns}) == 202
    assert "void" not in {t for _, t in file.dtypes}


def test_deleted_perils_stay_unless_told_otherwise(spark, sf_dir):
    from dataclasses import replace

    mart = mart_of_testdata(spark, sf_dir)
    folded = loc.fold_products(loc.location_pif(mart, PARAMS))
    every = loc.location_detail(mart, folded, PARAMS).count()
    living = loc.location_detail(mart, folded, replace(PARAMS, drop_deleted_perils=True)).count()
    assert 0 < living < every
