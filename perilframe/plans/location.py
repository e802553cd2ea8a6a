"""Location file: one wide row per building of a policy in force."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions.dialect import alive, join_text, round_up
from perilframe.functions.fixed import (
    BUILDERS_RISK_COLUMNS,
    CAMPUS_COLUMNS,
    DECODED_SCHEME,
    GEOCODE_COLUMNS,
    MODIFIER_COLUMNS,
)
from perilframe.functions.layout import DETAIL_DEDUCTIBLES, DETAIL_LIMITS, UPDATE_YEARS
from perilframe.functions.rules import (
    built_year,
    line_of_business,
    location_currency,
    policy_key,
    policy_version_key,
    sub_area,
)
from perilframe.operators.layers import COMPANY_COLUMNS, POLICY_COLUMNS, PRODUCER_COLUMNS
from perilframe.operators.perils import (
    BLOCK_COLUMNS,
    BLOCKS,
    RISK_FLAGS,
    block_name,
    peril_block,
    pivot_terms,
    risk_limit_deductible,
)
from perilframe.operators.pif import fold_products, policy_products, terms_in_force
from perilframe.operators.spine import (
    add_deductibles,
    add_limits,
    add_perils,
    add_risks,
    add_structures,
    from_table,
    on_same,
)
from perilframe.params import Alive, RunParams
from perilframe.plans.predicate import asks_only_for
from perilframe.schema import ADDRESS, PERIL_FLAGS
from perilframe.sources.mart import Mart
from perilframe.sources.staging import Stage

COVERED_TEXT = ("building_percent_complete_no", "contents_rate_grade_cd")
OCCUPANCY = ("occupancy_cd", "occupancy_desc", "occupancy_scheme_desc")
VALUES = ("building_replacement_amt", "contents_replacement_amt", "business_int_replacement_amt",
          "building_cvrg_a_amt", "building_cvrg_b_amt", "contents_cvrg_c_amt",
          "business_int_cvrg_d_amt")
PREMIUMS = ("written_premium_amt", "annualized_premium_amt")


def location_pif(mart: Mart, params: RunParams) -> DataFrame:
    return policy_products(mart, params.as_of, params.location_terms)


def add_construction(frame: DataFrame, mart: Mart) -> DataFrame:
    """Decode the construction number from the code, else from the wording.

    Both lookups match trimmed text within the risk's source system.
    """
    for alias, column in (("by_code", "construction_cd"), ("by_text", "construction_desc")):
        lookup = mart["construction_lookup"].alias(alias)
        frame = frame.join(
            lookup,
            (F.trim(f"structure.{column}") == F.trim(f"{alias}.construction_desc"))
            & (F.col("structure.source_system_id") == F.col(f"{alias}.source_system_id")),
            "left",
        )
    return frame


def _spine(mart: Mart, folded: DataFrame, params: RunParams) -> DataFrame:
    """Policies, then risks, structures and coverages; the last three share a partitioning."""
    policies = (
        folded.alias("pif")
        .join(mart["policy_term"].alias("t"), on_same("pif", "t", "policy_term_id"))
        .join(mart["policy"].alias("y"), on_same("t", "y", "policy_id"), "left")
        .join(mart["customer"].alias("c"), on_same("y", "c", "customer_id"), "left")
        .join(
            mart["producer_profit_center_bu"].alias("b"),
            on_same("t", "b", "producer_profit_center_bu_id"),
        )
        .join(mart["company"].alias("m"), on_same("t", "m", "company_id"))
    )
    risks = add_risks(policies, mart, "t").join(
        mart["source_system"].alias("s"), on_same("risk", "s", "source_system_id"), "left"
    )
    return add_construction(add_structures(risks, mart, alive(params.as_of, Alive())), mart)


def _policy_columns(product: str) -> list[Column]:
    return [
        *from_table("t", ("business_unit_cd", "business_unit_desc")),
        *from_table("b", PRODUCER_COLUMNS),
        F.col("c.customer_cd"),
        policy_key("t.").alias("spm"),
        policy_version_key("t.").alias("spmv"),
        *from_table("t", POLICY_COLUMNS),
        *from_table("m", COMPANY_COLUMNS),
        *from_table(product, ("product_cd", "product_desc")),
        *from_table("t", ("sic_cd", "sic_desc")),
    ]


def _risk_columns() -> list[Column]:
    number = F.coalesce("by_code.construction_no", "by_text.construction_no")
    return [
        *(F.col(f"t.{f}").alias(f"policy_{f}") for f in PERIL_FLAGS),
        *from_table("risk", ("risk_catg_cd", "risk_catg_desc")),
        *from_table("s", ("source_system_cd", "source_system_desc")),
        *from_table("structure", ("location_cd", "building_cd")),
        F.col("structure.deleted_dt").alias("risk_deleted_dt"),
        *(F.col(f"covered.{f}").alias(f"structure_{f}") for f in PERIL_FLAGS),
        *from_table("location", ADDRESS),
        number.alias("construction_cd_num"),
        *from_table("structure", ("construction_cd", "construction_desc")),
        F.coalesce(
            "structure.construction_scheme_desc", F.when(number.isNotNull(), DECODED_SCHEME)
        ).alias("construction_scheme_desc"),
        *from_table("structure", (*OCCUPANCY, "stories_no")),
        built_year(F.col("structure.built_yr"), "9999").alias("built_yr"),
        *from_table("structure", UPDATE_YEARS),
        F.col("structure.square_footage_no"),
        *from_table("covered", (*COVERED_TEXT, *VALUES, *PREMIUMS)),
    ]


def location_selection(mart: Mart, folded: DataFrame, params: RunParams) -> DataFrame:
    """Term x risk x structure x coverage with everything the file shows about them."""
    return _spine(mart, folded, params).select(
        "t.policy_term_id",
        *from_table("risk", ("risk_id", "location_id", "risk_place_hash_txt")),
        "structure.risk_property_structure_id",
        "covered.covered_property_structure_id",
        *_policy_columns("pif"),
        "pif.mod_period",
        *_risk_columns(),
        line_of_business(F.col("pif.business_unit_cd"), F.col("pif.product_cd")).alias("UDF5"),
    )


def location_lob(selection: DataFrame, predicate: Column) -> DataFrame:
    """Keep the rows of the caller's predicate (usually on ``UDF5``)."""
    return selection.filter(predicate).drop("UDF5")


def location_detail(mart: Mart, folded: DataFrame, params: RunParams) -> DataFrame:
    """The selection spread over peril rows, with limits and deductibles."""
    still = alive(params.as_of, Alive()) if params.drop_deleted_perils else None
    joined = add_perils(_spine(mart, folded, params), mart, still)
    joined = add_deductibles(add_limits(joined, mart), mart)
    return joined.select(
        "t.policy_term_id",
        *from_table("risk", ("risk_id", "location_id")),
        *from_table("rpp", ("risk_peril_product_id", "peril_id", "product_id")),
        "structure.risk_property_structure_id",
        "covered.covered_property_structure_id",
        "lim.limit_property_structure_id",
        "ded.deduct_property_structure_id",
        *_policy_columns("product"),
        "rpp.source_product_cd",
        *_risk_columns(),
        *from_table("peril", ("peril_cd", "peril_desc")),
        "rpp.source_peril_cd",
        *from_table("lim", DETAIL_LIMITS),
        *from_table("ded", DETAIL_DEDUCTIBLES),
    )


def flag_counts(selection: DataFrame) -> DataFrame:
    """One row per risk: its rows in the selection, and how many of them have each block's
    peril flag off and on. Counts are bounded whatever the number of structures, and have a
    map-side pass over a few narrow columns."""
    return selection.groupBy("risk_id").agg(
        F.count(F.lit(1)).alias("copies"),
        *(
            F.count_if(F.col(_flag(number)) == value).alias(f"flag_{number}_{value}")
            for number in BLOCKS for value in (0, 1)
        ),
    )


def _flag(number: int) -> str:
    return f"structure_{BLOCKS[number][0].lower()}_ind"


def _opened(number: int) -> Column:
    """The flags of a block that the counts stand for: off, on, and neither."""
    off, on = (F.col(f"flag_{number}_{value}").cast("int") for value in (0, 1))
    neither = F.col("copies").cast("int") - off - on
    parts = ((F.lit(0), off), (F.lit(1), on), (F.lit(None).cast("int"), neither))
    return F.explode(F.concat(*(F.array_repeat(value, times) for value, times in parts)))


def _with_blocks(selection: DataFrame, pivot: DataFrame, one_structure: bool) -> DataFrame:
    """Add the five peril blocks to the selection.

    The file joins every block by risk alone, so a risk with k structures gets k rows per
    block and k^6 rows in all, in every combination of the structures' peril flags. Here
    one row per risk carries the pivot and the counts of its flags, whatever k is; the
    counts are opened into rows once per block, in the last step before the file's columns.

    With ``one_structure`` the caller vouches for k = 1 and the blocks read their own row;
    a risk found twice then stops the run.
    """
    joined = selection.join(pivot, "risk_id", "left")
    frame = joined.join(flag_counts(selection), "risk_id")
    if one_structure:
        stop = F.raise_error(F.concat(F.lit("several structures for risk "), "risk_id"))
        checked = F.when(F.col("copies") > 1, stop.cast("bigint")).otherwise(F.col("risk_id"))
        return frame.withColumn("risk_id", checked).select(
            *joined.columns, *(c for n in BLOCKS for c in peril_block(n))
        )
    for number in BLOCKS:
        frame = frame.withColumn(f"flag_{number}", _opened(number))
    return frame.select(
        *joined.columns,
        *(c for n in BLOCKS for c in peril_block(n, F.col(f"flag_{n}"))),
    )


def _empty(names: tuple[str, ...], kind: str = "string") -> list[Column]:
    return [F.lit(None).cast(kind).alias(n) for n in names]


def _block_section(number: int) -> list[Column]:
    """A block as the file shows it, between its peril string and its sublimit area."""
    blank = F.lit("") if number == 1 else F.lit(None).cast("string")
    return [
        blank.alias(block_name("LocPerils", number)),
        *(F.col(f"`{block_name(c, number)}`") for c in BLOCK_COLUMNS),
        blank.alias(block_name("SublimitArea", number)),
    ]


def location_rows(selection: DataFrame, pivot: DataFrame, params: RunParams,
                  one_structure: bool = False) -> DataFrame:
    """The file's columns from the selected rows and the pivot by risk."""
    frame = _with_blocks(selection, pivot, one_structure)
    country, no_occupancy = F.col("country_cd"), F.col("occupancy_cd").isNull()
    tag = params.source_tag.lower()
    return frame.select(
        "policy_term_id", "risk_id", "location_cd", "building_cd", "product_cd",
        line_of_business(F.col("business_unit_cd"), F.col("product_cd")).alias("LOB"),
        *PRODUCER_COLUMNS,
        *(f"policy_{f}" for f in PERIL_FLAGS),
        *RISK_FLAGS,
        F.lit(params.now).cast("timestamp").alias("AsOfDate"),
        "mod_period",
        F.col("spm").alias("ContractID"),
        join_text("spm", F.lit("_"), "risk_catg_cd", F.lit("_"), "risk_id").alias("LocationID"),
        join_text(F.lit("Location "), "location_cd", F.lit(", Building "), "building_cd").alias(
            "LocationName"
        ),
        F.col("street_address_1_txt").alias("Street"),
        F.col("city_nm").alias("City"),
        F.col("state_province_cd").alias("Area"),
        F.col("postal_cd").alias("PostalCode"),
        sub_area(country, F.col("county_cd"), F.col("postal_cd")).alias("SubArea"),
        country.alias("CountryISO"),
        F.col("construction_scheme_desc").alias(f"{tag}_construction_scheme_desc"),
        F.col("construction_cd_num").alias(f"{tag}_construction_cd_num"),
        F.col("construction_cd").alias(f"{tag}_construction_cd"),
        F.col("construction_desc").alias(f"{tag}_construction_desc"),
        *_empty(("ConstructionOther",)),
        F.when(no_occupancy, "SIC").otherwise(F.col("occupancy_scheme_desc")).alias(
            f"{tag}_occupancy_scheme_desc"
        ),
        F.coalesce("occupancy_cd", "sic_cd", F.lit("0")).alias(f"{tag}_occupancy_cd"),
        F.when(no_occupancy, F.col("sic_desc")).otherwise(F.col("occupancy_desc")).alias(
            f"{tag}_occupancy_desc"
        ),
        F.col("built_yr").alias("YearBuilt"),
        round_up("stories_no").alias("NumberOfStories"),
        F.lit(1).alias("RiskCount"),
        F.col("square_footage_no").alias("GrossArea"),
        *_empty(BUILDERS_RISK_COLUMNS),
        *_empty(CAMPUS_COLUMNS),
        location_currency(country).alias("Currency"),
        F.col("written_premium_amt").alias("Premium"),
        F.col("building_replacement_amt").alias("BuildingValue"),
        *_empty(("OtherValue",), "decimal(18,2)"),
        F.col("contents_replacement_amt").alias("ContentsValue"),
        F.col("business_int_replacement_amt").alias("TimeElementValue"),
        *(c for n in BLOCKS for c in _block_section(n)),
        F.when(F.col("business_int_replacement_amt").isNotNull(), 365).alias("DaysCovered"),
        *_empty(MODIFIER_COLUMNS),
        join_text(F.lit(f"{params.source_tag}-"), "source_system_desc").alias("UDF1"),
        F.col("building_replacement_amt").alias("UDF2"),
        F.lit(100).alias("UDF3"),
        *_empty(("UDF4", "UDF5")),
        *_empty(GEOCODE_COLUMNS),
        "risk_place_hash_txt",
    )


def risks_in_force(mart: Mart, params: RunParams) -> DataFrame:
    """Ids of the risks of terms in force."""
    terms = terms_in_force(mart, params.as_of, params.location_terms).select("policy_term_id")
    risks = mart["risk"].select("risk_id", "policy_term_id")
    return risks.join(terms, "policy_term_id").select("risk_id")


def location_pivot(mart: Mart, params: RunParams, risks: DataFrame | None = None) -> DataFrame:
    """Pivot by risk for the given risks, or those of terms in force."""
    if risks is None:
        risks = risks_in_force(mart, params)
    perils = risk_limit_deductible(mart, risks.select("risk_id"))
    return pivot_terms(perils, ("risk_id",))


def kept_terms(folded: DataFrame, predicate: Column) -> DataFrame | None:
    """Ids of the terms that pass a predicate on their own columns and line of business, or
    None where it asks for more."""
    lob = line_of_business(F.col("business_unit_cd"), F.col("product_cd"))
    terms = folded.withColumn("UDF5", lob)
    if not asks_only_for(predicate, terms):
        return None
    return terms.filter(predicate).select("policy_term_id")


def location_file(mart: Mart, params: RunParams, predicate: Column | None = None,
                  one_structure: bool = False, stage: Stage | None = None) -> DataFrame:
    """The whole location file, optionally for the lines of business of ``predicate``.

    The terms that pass are found once (and written, given a ``stage``); risks, and so
    structures, perils, limits and the pivot, are semi-joined to them. A predicate on other
    columns restricts the pivot to the risks that are left.

    Without a predicate a ``stage`` gets the ids of the risks in force, found on the narrow
    pairs of risk and term; every step that joins risks to terms then moves these risks only.
    """
    if stage and predicate is None:
        ids = stage.keep(risks_in_force(mart, params), f"risks_in_force_{uuid4().hex}")
        mart = mart.holding(ids)
    folded = fold_products(location_pif(mart, params))
    keys = None if predicate is None else kept_terms(folded, predicate)
    if keys is not None:
        if stage:
            keys = stage.keep(keys, f"kept_terms_{uuid4().hex}")
        mart = mart.within(keys)
        folded = folded.join(keys, "policy_term_id", "left_semi")
    selection = location_selection(mart, folded, params)
    kept = location_lob(selection, F.lit(True) if predicate is None else predicate)
    risks = None if predicate is None or keys is not None else kept.select("risk_id").distinct()
    return location_rows(kept, location_pivot(mart, params, risks), params, one_structure)
