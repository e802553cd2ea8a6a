"""Column layout of the mart and its feeder tables.

Types follow the column name's ending; only exceptions are listed. Names are kept
lower case, Spark resolves them in either case.
"""

from __future__ import annotations

from pyspark.sql import types as T

from perilframe.functions.layout import (
    BLANKET_DEDUCTIBLES,
    BLANKET_LIMITS,
    PERIL_FLAGS,
    SITE_DEDUCTIBLES,
    SITE_LIMITS,
    STREETS,
)

MONEY = "decimal(18,2)"
PERCENT = "decimal(9,4)"

_BY_ENDING = {
    "id": "bigint",
    "ts": "timestamp",
    "dt": "date",
    "amt": MONEY,
    "pcnt": PERCENT,
    "ind": "int",
}
_EXCEPTIONS = {
    "layer_no": "int",
    "priority_no": "int",
    "square_footage_no": MONEY,
    "building_percent_complete_no": PERCENT,
    "blanket_bi_deductible_dur_no": "int",
    "bi_deductible_duration_no": "int",
    "change_written_premium": MONEY,
    "transaction_accounting_year": "int",
    "construction_no": "int",
}

AUDIT = ("source_system_id", "create_ts", "update_ts")
ADDRESS = (
    "place_desc", *STREETS, "city_nm", "state_province_cd", "state_province_nm", "postal_cd",
    "county_cd", "county_nm", "country_cd", "country_nm", "country_schema_cd",
    "section_txt", "range_txt", "township_txt", "longitude_cd", "latitude_cd", "geo_resolution_cd",
)
EXTRA_FLAGS = ("eqsl_ind", "ordlaw_ind", "fire_follow_ind")

# Table -> columns, own surrogate key first, as the catalogue lists them.
TABLES: dict[str, tuple[str, ...]] = {
    "company": ("company_id", "company_cd", "company_nm", "company_abrv_cd", *AUDIT),
    "customer": ("customer_id", "customer_cd", "customer_nm", *AUDIT),
    "policy": (
        "policy_id", "customer_id", "policy_number_cd", "business_unit_cd", "business_unit_desc",
        "original_effective_dt", "original_primary_insured_nm", *AUDIT,
    ),
    "policy_term": (
        "policy_term_id", "policy_id", "producer_profit_center_bu_id", "company_id",
        "business_unit_cd", "business_unit_desc", "policy_symbol_cd", "policy_symbol_desc",
        "policy_number_cd", "policy_module_cd", "policy_term_effective_dt",
        "policy_term_expiration_dt", "cancellation_effective_dt", "current_version_no",
        "policy_status_cd", "policy_status_desc", "renewal_status_cd", "renewal_status_desc",
        "primary_insured_nm", "primary_insured_address_1_txt", "primary_insured_address_2_txt",
        "primary_insured_city_nm", "primary_insured_state_cd", "primary_insured_state_nm",
        "primary_insured_postal_cd", "underwriter_nm", "naics_cd", "naics_desc", "sic_cd",
        "sic_desc", "policy_state_cd", "policy_state_nm", "policy_entry_system_cd",
        "policy_entry_system_desc", "reins_ind", "fac_reins_ind", *PERIL_FLAGS, *AUDIT,
        "policy_hash_txt", *EXTRA_FLAGS,
    ),
    "producer_profit_center_bu": (
        "producer_profit_center_bu_id", "producer_cd", "producer_desc", "profit_center_cd",
        "profit_center_desc", "field_cd", "field_desc", "territory_cd", "territory_desc",
        "business_unit_cd", "business_unit_desc", "producer_address_1_txt",
        "producer_address_2_txt", "producer_city_nm", "producer_state_cd", "producer_state_nm",
        "producer_postal_cd", "producer_phone_no", *AUDIT, "producer_hash_txt",
    ),
    "excess": (
        "excess_id", "policy_term_id", "peril_id", "layer_no", "limit_amt",
        "attachment_point_amt", "part_of_amt", "part_of_pcnt", "source_polterm_cd",
        "source_peril_cd", *AUDIT, "excess_hash_txt",
    ),
    "risk": (
        "risk_id", "policy_term_id", "location_id", "risk_catg_cd", "risk_catg_desc",
        "source_risk_cd", *AUDIT, "risk_place_hash_txt",
    ),
    "location": ("location_id", *ADDRESS, "place_hash_txt", "create_ts", "update_ts"),
    "risk_property_structure": (
        "risk_property_structure_id", "risk_id", "location_cd", "building_cd", "structure_desc",
        "stories_no", "built_yr", "electrical_update_yr", "heating_update_yr",
        "plumbing_update_yr", "roof_update_yr", "other_update_yr", "square_footage_no",
        "construction_scheme_desc", "construction_cd", "construction_desc",
        "occupancy_scheme_desc", "occupancy_cd", "occupancy_desc", "source_risk_cd", *AUDIT,
        "risk_hash_txt", "deleted_dt",
    ),
    "covered_property_structure": (
        "covered_property_structure_id", "risk_id", "building_percent_complete_no",
        "building_replacement_amt", "building_cvrg_a_amt", "building_cvrg_b_amt",
        "contents_rate_grade_cd", "contents_rate_grade_desc", "contents_replacement_amt",
        "contents_cvrg_c_amt", "business_int_replacement_amt", "business_int_cvrg_d_amt",
        "building_ind", "contents_ind", "business_int_ind", *PERIL_FLAGS, "source_risk_cd",
        *AUDIT, "risk_cvrg_hash_txt", "written_premium_amt", "annualized_premium_amt",
        *EXTRA_FLAGS,
    ),
    "risk_peril_product": (
        "risk_peril_product_id", "risk_id", "peril_id", "product_id", "deleted_dt",
        "source_risk_cd", "source_peril_cd", "source_product_cd", *AUDIT, "peril_hash_txt",
    ),
    "limit_property_structure": (
        "limit_property_structure_id", "risk_peril_product_id", *BLANKET_LIMITS, *SITE_LIMITS,
        *AUDIT, "limit_hash_txt",
    ),
    "deductible_property_structure": (
        "deduct_property_structure_id", "risk_peril_product_id", *BLANKET_DEDUCTIBLES,
        *SITE_DEDUCTIBLES, *AUDIT, "deductible_hash_txt",
    ),
    "facultative": (
        "risk_id", "peril_id", "layer_no", "limit_amt", "attachment_point_amt", "reinsurer_cd",
        "reinsurer_nm", "reinsurer_type_cd", "ceded_pcnt", "priority_no", *AUDIT,
    ),
    "peril": ("peril_id", "peril_cd", "peril_desc", *AUDIT),
    "product": ("product_id", "product_cd", "product_desc", *AUDIT),
    "source_system": (
        "source_system_id", "source_system_cd", "source_system_desc", "create_ts", "update_ts",
    ),
}

# Feeder tables from the warehouse and the reference databases: only the columns read.
FEEDS: dict[str, tuple[str, ...]] = {
    "d_policy": ("policy_id", "policy_symbol", "policy_number", "policy_module", "policy_version_cd"),
    "f_divisional_premiums": (
        "policy_id", "written_transaction_id", "change_written_premium",
        "transaction_accounting_year",
    ),
    "d_transaction_items": ("transaction_items_id", "rein_transaction_type_desc"),
    "d_producer": ("producer_code", "location_state", "state_number"),
    "d_geography": ("state_province_code", "rein_state_province_code", "country_code"),
    "construction_lookup": ("construction_desc", "construction_no", "source_system_id"),
    "occupancy_codes": ("code", "description", "region"),
    "construction_codes": ("code", "category", "description", "region"),
}

# Tables with a reader's view.
VIEWED = tuple(t for t in TABLES if t not in ("facultative", "peril", "product", "source_system"))


def column_type(name: str) -> str:
    """Spark SQL type of a column, from its name."""
    return _EXCEPTIONS.get(name) or _BY_ENDING.get(name.rsplit("_", 1)[-1], "string")


def columns(table: str) -> tuple[str, ...]:
    return TABLES[table] if table in TABLES else FEEDS[table]


def struct(table: str) -> T.StructType:
    """Explicit read schema of a table."""
    return T.StructType.fromDDL(", ".join(f"{c} {column_type(c)}" for c in columns(table)))
