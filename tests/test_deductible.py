from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perilframe.operators import deductible as ded
from perilframe.operators import limits as lim
from perilframe.schema import BLANKET_DEDUCTIBLES, BLANKET_LIMITS, SITE_LIMITS, column_type

BLANKET_DDL = "policy_term_id bigint, peril_cd string, " + ", ".join(
    f"{c} {column_type(c)}" for c in BLANKET_DEDUCTIBLES
) + ", blanket_risk_count bigint"


def _blankets(frame, rows):
    """Rows of (term, peril, amount, percent, risks)."""
    blank = dict.fromkeys(BLANKET_DEDUCTIBLES)
    full = []
    for term, peril, amount, percent, risks in rows:
        values = blank | {
            "blanket_deductible_amt": None if amount is None else Decimal(amount),
            "blanket_deductible_pcnt": None if percent is None else Decimal(percent),
        }
        full.append((term, peril, *values.values(), risks))
    return frame(full, BLANKET_DDL)


def _chain(frame, rows, risks, perils):
    groups = ded.blanket_groups(
        _blankets(frame, rows),
        frame(risks, "policy_term_id bigint, risk_count bigint"),
        frame(perils, "policy_term_id bigint, policy_peril_count bigint, "
                      "excess_layer_peril_count bigint"),
    )
    return groups


def test_groups_join_perils_and_skip_zero(frame):
    rows = [
        (1, "FLOOD", "100", None, 2),
        (1, "EARTHQUAKE", "100", None, 2),
        (1, "FIRE", "0", None, 2),
        (1, "FIRE", None, "0", 2),
        (1, "NBCR", "0", "5", 2),
        (1, None, "100", None, 2),
    ]
    found = {
        (r.blanket_deductible_amt, r.blanket_deductible_pcnt): r
        for r in _chain(frame, rows, [(1, 2)], [(1, 3, None)]).collect()
    }
    assert set(found) == {(Decimal("100.00"), None), (Decimal("0.00"), Decimal("5.0000"))}
    both = found[Decimal("100.00"), None]
    assert both.peril_cd_list == "EARTHQUAKE, FLOOD"
    assert (both.blanket_peril_count, both.sublimit_flood_ind, both.sublimit_fire_ind) == (3, 1, 0)
    assert both.policy_blanket_ind == 1


def test_layers_with_other_counts_repeat_perils(frame):
    rows = [(1, "FIRE", "100", None, 4)]
    (row,) = _chain(frame, rows, [(1, 2)], [(1, 3, 1), (1, 3, 2)]).collect()
    assert (row.blanket_peril_count, row.peril_cd_list) == (2, "FIRE, FIRE")
    assert row.policy_blanket_ind == 0


CASES = {
    # perils at one amount -> (dedamt1, area, type, sublimit amount)
    ("FIRE",): ("100", None, None, None),
    ("FIRE", "WIND_HAIL"): ("100", None, None, None),
    ("WIND_HAIL", "EARTHQUAKE"): (None, "AllLoc-Wind", "B", "100"),
    ("HURRICANE", "FLOOD"): (None, "AllLoc-Wind", "B", "100"),
    ("EARTHQUAKE", "FLOOD"): (None, "AllLoc-EQ", "B", "100"),
    ("TERRORISM",): (None, None, "B", "100"),
}


@pytest.mark.parametrize("perils", CASES)
def test_deductible_terms(frame, perils):
    rows = [(1, p, "100", None, 2) for p in perils]
    (row,) = ded.deductible_terms(_chain(frame, rows, [(1, 2)], [(1, 2, None)])).collect()
    amount, area, kind, sublimit = CASES[perils]
    assert row.dedamt1 == (None if amount is None else Decimal(amount))
    assert (row.sublimitarea, row.sublimitdedtype) == (area, kind)
    assert row.sublimitdedamt1 == (None if sublimit is None else Decimal(sublimit))


def test_flood_alone_is_dropped(frame):
    groups = _chain(frame, [(1, "FLOOD", "100", None, 2)], [(1, 2)], [(1, 2, None)])
    assert ded.deductible_terms(groups).count() == 0


def test_zero_amount_hides_percent(frame):
    groups = _chain(frame, [(1, "FIRE", "0", "5", 2)], [(1, 2)], [(1, 2, None)])
    (row,) = ded.deductible_terms(groups).collect()
    assert row.dedamt1 == 0


def test_partial_blanket_sets_nothing(frame):
    groups = _chain(frame, [(1, "WIND_HAIL", "100", None, 1)], [(1, 2)], [(1, 2, None)])
    (row,) = ded.deductible_terms(groups).collect()
    assert (row.policy_blanket_ind, row.sublimitarea, row.dedamt1) == (0, None, None)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_spread_settles_ties_by_amount(frame, partitions):
    rows = [(1, "FIRE", "100", None, 2), (1, "FIRE", "300", None, 2), (1, "FIRE", "200", None, 2),
            (1, "EARTHQUAKE", "50", None, 2), (2, "FIRE", "10", None, 1)]
    groups = _chain(frame, rows, [(1, 2), (2, 1)], [(1, 2, None), (2, 1, None)])
    spread = ded.spread_dedamt(ded.deductible_terms(groups).repartition(partitions))
    rows = spread.collect()
    assert {(r.policy_term_id, r.raw_layer_count, r.dedamt1) for r in rows} == {
        (1, 4, Decimal(300)), (2, 1, Decimal(10))
    }
    kept = ded.policy_deductible(spread).collect()
    assert sorted((r.policy_term_id, r.sublimitarea) for r in kept) == [(1, "AllLoc-EQ"), (2, None)]


def test_all_peril_mark_repeats_per_count_row(frame):
    groups = _chain(frame, [(1, "FIRE", "10", None, 1)], [(1, 1)], [(1, 1, None)])
    one = ded.policy_deductible(ded.spread_dedamt(ded.deductible_terms(groups)))
    perils = frame([(1, 1, 5), (1, 1, 6)], "policy_term_id bigint, policy_peril_count bigint, "
                                           "excess_layer_peril_count bigint")
    assert [r.isallperildeductible for r in ded.mark_all_peril(one, perils).collect()] == [1, 1]


LIMIT_DDL = "policy_term_id bigint, policy_peril_location_count bigint, " + ", ".join(
    f"{c} {column_type(c)}" for c in (*BLANKET_LIMITS, *SITE_LIMITS)
)


def _limit(frame, risks=3, **amounts):
    names = (*BLANKET_LIMITS, *SITE_LIMITS)
    values = [None if n not in amounts else Decimal(amounts[n]) for n in names]
    return frame([(1, risks, *values)], LIMIT_DDL)


@pytest.mark.parametrize(
    "amounts, kept",
    [
        ({}, False),
        ({"blanket_limit_amt": 0, "building_limit_amt": 0}, False),
        ({"building_limit_amt": 5}, True),
        ({"site_limit_amt": 0}, True),
        ({"blanket_combined_limit_amt": 0}, True),
        ({"blanket_agg_limit_amt": 9}, False),
    ],
)
def test_empty_limits(frame, amounts, kept):
    risks = frame([(1, 3)], "policy_term_id bigint, risk_count bigint")
    assert lim.blanket_limits(_limit(frame, **amounts), risks).count() == int(kept)


@pytest.mark.parametrize("shared, total, flag", [(3, 3, 1), (2, 3, 0), (1, 1, 0)])
def test_shared_limit(frame, shared, total, flag):
    risks = frame([(1, total)], "policy_term_id bigint, risk_count bigint")
    groups = _limit(frame, risks=shared, building_limit_amt=5)
    (row,) = lim.blanket_limits(groups, risks).collect()
    assert row.policy_blanket_ind == flag


def test_hot_term_counts_match_brute_force(spark, frame):
    """One term holds a third of the rows; counts must not depend on how it is split."""
    rows = [(1 if i % 3 == 0 else i, i, i % 5, i % 2) for i in range(900)]
    details = frame(rows, "policy_term_id bigint, risk_id bigint, peril_id bigint, twice int")
    doubled = details.union(details.filter("twice = 1")).repartition(16)
    found = {tuple(r) for r in lim.risk_peril_count(doubled).collect()}
    expected: dict = {}
    for term, risk, peril, _ in rows:
        expected.setdefault((term, peril), set()).add(risk)
    assert found == {(t, p, len(r)) for (t, p), r in expected.items()}
    assert doubled.agg(F.count("*")).first()[0] == 1350
