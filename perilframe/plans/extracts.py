"""Ad-hoc exposure extracts over the same join spine as the files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions.dialect import alive, term_in_force
from perilframe.functions.layout import (
    DETAIL_DEDUCTIBLES,
    DETAIL_LIMITS,
    EXTRACT_FLAGS,
    FIRE_DEDUCTIBLES,
    FIRE_LIMITS,
    UPDATE_YEARS,
)
from perilframe.functions.rules import (
    built_year,
    policy_layer_key,
    policy_version_key,
    stories_or_unknown,
)
from perilframe.operators.layers import COMPANY_COLUMNS
from perilframe.operators.spine import (
    add_deductibles,
    add_limits,
    add_perils,
    add_risks,
    add_structures,
    from_table,
    on_same,
)
from perilframe.params import Alive, InForce
from perilframe.plans.location import COVERED_TEXT, OCCUPANCY, PREMIUMS, VALUES
from perilframe.schema import ADDRESS
from perilframe.sources.mart import Mart, construction_numbers

POLICY_ORDER = ("t.policy_number_cd", "t.policy_module_cd", "structure.location_cd",
                "structure.building_cd")
# Ids that end every order, so that no key's rows are one range.
UNIQUE_ORDER = ("structure.risk_property_structure_id", "rpp.risk_peril_product_id")
# Amounts the heritage layout leaves to a later step.
LEFT_EMPTY = ("building_deductible_amt", "contents_deductible_amt", "bi_deductible_amt")


def policies(mart: Mart, keep: Column) -> DataFrame:
    """Terms passing ``keep`` with producer, company and raw excess rows."""
    return (
        mart["policy_term"].filter(keep).alias("t")
        .join(
            mart["producer_profit_center_bu"].alias("b"),
            on_same("t", "b", "producer_profit_center_bu_id"),
        )
        .join(mart["company"].alias("m"), on_same("t", "m", "company_id"))
        .join(mart["excess"].alias("x"), on_same("t", "x", "policy_term_id"), "left")
    )


def add_facultative(frame: DataFrame, mart: Mart) -> DataFrame:
    """Ceded rows only repeat their risk, so no column but the key is read."""
    ceded = mart["facultative"].select("risk_id").alias("fac")
    return frame.join(ceded, on_same("risk", "fac", "risk_id"), "left")


def _spine(mart: Mart, keep: Column, still: Column) -> DataFrame:
    """Policies down to perils, limits and deductibles. Everything joined by risk id comes
    together; the peril rows follow."""
    risks = add_structures(add_risks(policies(mart, keep), mart, "t"), mart, still)
    perils = add_perils(add_facultative(risks, mart), mart, still)
    return add_deductibles(add_limits(perils, mart), mart)


def _keys() -> list[Column]:
    return [
        policy_version_key("t.").alias("accntnum"),
        policy_layer_key(F.col("x.policy_term_id"), F.col("x.layer_no"), "t.").alias("policynum"),
        F.col("t.primary_insured_nm").alias("accntname"),
    ]


def heritage_extract(
    mart: Mart, business_unit: str, lob: str, as_of: date, ordered: bool = True
) -> DataFrame:
    """One business unit's buildings with every peril, limit and deductible.

    Only rows with a deletion date on or after the date are alive here: open rows need a
    far-future date. Excess rows are not folded, so a term with several repeats its risks.
    """
    keep = (F.col("business_unit_cd") == business_unit) & term_in_force(
        as_of, InForce(expires_on_date_counts=True, cancellation="on_or_after")
    )
    still = alive(as_of, Alive(open_counts=False))
    decode = F.broadcast(construction_numbers(mart.spark)).alias("decode")
    rows = _spine(mart, keep, still).join(
        decode,
        F.trim("structure.construction_cd") == F.trim("decode.construction_desc"),
        "left",
    )
    if ordered:
        rows = rows.orderBy(*POLICY_ORDER, "peril.peril_cd", *UNIQUE_ORDER)
    return rows.select(
        "t.policy_term_id",
        *from_table("risk", ("location_id", "risk_id")),
        "structure.risk_property_structure_id",
        "covered.covered_property_structure_id",
        *from_table("t", ("business_unit_cd", "business_unit_desc")),
        *_keys(),
        F.col("b.profit_center_cd").alias("branchname"),
        "b.profit_center_desc",
        F.lit(lob).alias("lobname"),
        *from_table("m", COMPANY_COLUMNS),
        *from_table("t", ("policy_symbol_cd", "policy_symbol_desc", "policy_number_cd",
                          "policy_module_cd", "current_version_no")),
        *from_table("risk", ("risk_catg_cd", "risk_catg_desc")),
        *from_table("location", ADDRESS),
        *from_table("structure", ("location_cd", "building_cd")),
        F.col("decode.construction_no").alias("construction_cd_num"),
        *from_table("structure", ("construction_cd", "construction_desc",
                                  "construction_scheme_desc", *OCCUPANCY, "stories_no")),
        built_year(F.col("structure.built_yr"), "9999").alias("built_yr"),
        *from_table("structure", UPDATE_YEARS),
        "structure.square_footage_no",
        *from_table("covered", (*COVERED_TEXT, *VALUES, *EXTRACT_FLAGS, *PREMIUMS)),
        *from_table("rpp", ("risk_peril_product_id", "peril_id")),
        *from_table("peril", ("peril_cd", "peril_desc")),
        *from_table("rpp", ("source_peril_cd", "product_id")),
        *from_table("product", ("product_cd", "product_desc")),
        "rpp.source_product_cd",
        "lim.limit_property_structure_id",
        *from_table("lim", DETAIL_LIMITS),
        "ded.deduct_property_structure_id",
        *(
            F.lit(None).cast("decimal(18,2)").alias(c) if c in LEFT_EMPTY else F.col(f"ded.{c}")
            for c in DETAIL_DEDUCTIBLES
        ),
    )


def _open_business(as_of: date, units: str) -> Column:
    return F.col("business_unit_cd").like(units) & term_in_force(as_of, InForce())




def fire_extract(
    mart: Mart, as_of: date, units: str, other_than: str, perils: tuple[str, ...] = ("FIRE",),
    ordered: bool = True,
) -> DataFrame:
    """Fire exposure of business units like ``units`` outside one profit centre."""
    rows = _spine(mart, _open_business(as_of, units), alive(as_of, Alive())).filter(
        (F.col("b.profit_center_cd") != other_than) & F.col("peril.peril_cd").isin(*perils)
    )
    if ordered:
        rows = rows.orderBy(*POLICY_ORDER, *UNIQUE_ORDER)
    return rows.select(
        *from_table("t", ("business_unit_cd", "business_unit_desc")),
        *from_table("b", ("profit_center_cd", "profit_center_desc")),
        *from_table("product", ("product_cd", "product_desc")),
        *_keys(),
        *from_table("t", ("policy_term_effective_dt", "policy_term_expiration_dt",
                          "cancellation_effective_dt", "sic_cd", "sic_desc")),
        *from_table("risk", ("risk_catg_cd", "risk_catg_desc")),
        *from_table("location", ("street_address_1_txt", "city_nm", "state_province_cd",
                                 "state_province_nm", "postal_cd", "country_cd", "country_nm")),
        *from_table("structure", ("risk_id", "location_cd", "building_cd", "construction_cd",
                                  "construction_desc", "occupancy_scheme_desc", "occupancy_cd",
                                  "occupancy_desc")),
        stories_or_unknown(F.col("structure.stories_no")).alias("stories_no"),
        built_year(F.col("structure.built_yr"), "").alias("built_yr"),
        "structure.square_footage_no",
        *from_table("covered", (*VALUES[:3], *EXTRACT_FLAGS)),
        *from_table("lim", FIRE_LIMITS),
        *from_table("ded", FIRE_DEDUCTIBLES),
    )


def policy_term_extract(mart: Mart, as_of: date, units: str, ordered: bool = True) -> DataFrame:
    """Policy terms of business units like ``units``, once per row of the full join.

    The joins below the policy only repeat a term, so they run on its id and the sort
    columns alone; the wide policy rows join once at the end.
    """
    narrow = (
        _spine(mart, _open_business(as_of, units), alive(as_of, Alive()))
        .select("t.policy_term_id", "structure.location_cd", "structure.building_cd",
                "structure.risk_property_structure_id", "rpp.risk_peril_product_id")
        .alias("structure")
    )
    rows = narrow.join(mart["policy_term"].alias("t"), on_same("structure", "t", "policy_term_id"))
    if ordered:
        rows = rows.orderBy(
            *POLICY_ORDER, "structure.risk_property_structure_id", "structure.risk_peril_product_id"
        )
    return rows.select("t.*")


def preview(extract: DataFrame, rows: int = 100) -> DataFrame:
    return extract.limit(rows)
