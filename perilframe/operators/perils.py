"""Limits and deductibles by peril: pivot and the peril blocks of the location file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions.dialect import percent_text, plain_number
from perilframe.functions.fixed import PERILS
from perilframe.operators.spine import add_deductibles, add_limits
from perilframe.schema import PERIL_FLAGS
from perilframe.sources.mart import Mart

# Pivoted measures: short name -> source column.
MEASURES = {
    "bldg_limit": "building_limit_amt",
    "bldg_ded_amt": "building_deductible_amt",
    "bldg_ded_pcnt": "building_deductible_pcnt",
    "cnts_limit": "contents_limit_amt",
    "cnts_ded_amt": "contents_deductible_amt",
    "cnts_ded_pcnt": "contents_deductible_pcnt",
    "bi_limit": "bi_limit_amt",
    "bi_ded_amt": "bi_deductible_amt",
}
PIVOTED_PERILS = tuple(sorted(PERILS))
# Block number in the file -> peril, and whether the block carries deductible amounts.
BLOCKS = {
    1: ("FIRE", False),
    2: ("HURRICANE", True),
    3: ("EARTHQUAKE", True),
    4: ("TERRORISM", False),
    5: ("WIND_HAIL", True),
}
BLOCK_COLUMNS = ("LocLimitType", "LimitBldg", "LimitOther", "LimitContent", "LimitTime",
                 "Participation1", "Participation2", "DeductType", "DeductBldg", "DeductOther",
                 "DeductContent", "DeductTime")
RISK_FLAGS = tuple(f"structure_{flag}" for flag in PERIL_FLAGS)


def limit_deductible(details: DataFrame) -> DataFrame:
    """The pivot's input: one row per risk and peril row."""
    return details.select("policy_term_id", "risk_id", "peril_cd", *MEASURES.values())


def risk_limit_deductible(mart: Mart, risks: DataFrame) -> DataFrame:
    """The same measures straight from the peril rows of some risks (column ``risk_id``).

    Structures, coverages and addresses of a risk repeat its peril rows without changing
    them, and a maximum does not see repeats, so the file's pivot needs none of them.
    """
    perils = mart["risk_peril_product"].join(risks, "risk_id", "left_semi").alias("rpp")
    named = perils.join(
        mart["peril"].alias("peril"), F.col("rpp.peril_id") == F.col("peril.peril_id"), "left"
    )
    return add_deductibles(add_limits(named, mart), mart).select(
        "rpp.risk_id", "peril.peril_cd", *MEASURES.values()
    )


def pivot_terms(rows: DataFrame, keys: Sequence[str] = ("policy_term_id", "risk_id")) -> DataFrame:
    """Maximum of each measure per peril, one row per key.

    Written as conditional maxima: one aggregate with one shuffle, combined on the map
    side, where ``pivot`` with several measures would shuffle twice. Keys without a listed
    peril keep a row of NULLs.
    """
    cells = (
        F.expr(f"max(CASE WHEN peril_cd = '{peril}' THEN {source} END) AS {peril}_{short}")
        for peril in PIVOTED_PERILS
        for short, source in MEASURES.items()
    )
    return rows.groupBy(*keys).agg(*cells)


def risk_perils(selection: DataFrame) -> DataFrame:
    """Peril flags of a risk's structures."""
    return selection.select("policy_term_id", "risk_id", *RISK_FLAGS)


def block_name(column: str, number: int) -> str:
    return column if number == 1 else f"{column} {number}"


def _limit_text(amount: Column) -> Column:
    return F.when(amount > 0, plain_number(amount)).otherwise("")


def _deductible_text(amount: Column, percent: Column) -> Column:
    nothing = F.greatest(F.coalesce(amount, F.lit(0)), F.coalesce(percent, F.lit(0))) == 0
    return (
        F.when(nothing, "")
        .when(amount > 0, plain_number(amount))
        .when(percent > 0, percent_text(percent))
        .otherwise("")
    )


def peril_block(number: int, flag: Column | None = None) -> list[Column]:
    """The twelve columns of one block, from a row holding the pivot and the peril flag.

    ``flag`` is the structure's peril flag: 0 empties the block, NULL does not.
    """
    peril, with_deductible = BLOCKS[number]
    flag = F.col(f"structure_{peril.lower()}_ind") if flag is None else flag

    def cell(short: str) -> Column:
        return F.col(f"{peril}_{short}")

    def unless_off(value: Column) -> Column:
        return F.when(flag == 0, "").otherwise(value)

    total = F.coalesce(cell("bldg_limit"), F.lit(0))
    for short in ("cnts_limit", "bi_limit"):
        total = total + F.coalesce(cell(short), F.lit(0))
    empty = F.lit("")
    if with_deductible:
        kind = (
            F.when(cell("bldg_ded_pcnt") > 0, "C").when(cell("bldg_ded_amt") > 0, "S").otherwise("N")
        )
        building = unless_off(_deductible_text(cell("bldg_ded_amt"), cell("bldg_ded_pcnt")))
        contents = unless_off(_deductible_text(cell("cnts_ded_amt"), cell("cnts_ded_pcnt")))
        income = unless_off(_limit_text(cell("bi_ded_amt")))
    else:
        kind = F.when(flag == 1, "N").otherwise("")
        building = contents = income = empty
    values = (
        unless_off(F.when(total > 0, "C").otherwise("")),
        unless_off(_limit_text(cell("bldg_limit"))),
        empty,
        unless_off(_limit_text(cell("cnts_limit"))),
        unless_off(_limit_text(cell("bi_limit"))),
        empty,
        empty,
        unless_off(kind),
        building,
        empty,
        contents,
        income,
    )
    return [v.alias(block_name(c, number)) for c, v in zip(BLOCK_COLUMNS, values)]


def peril_block_rows(perils: DataFrame, pivot: DataFrame, number: int) -> DataFrame:
    """One block as a relation: peril flags of the risks joined to the pivot by risk."""
    return perils.join(pivot.drop("policy_term_id"), "risk_id", "left").select(
        "policy_term_id", "risk_id", *peril_block(number)
    )
