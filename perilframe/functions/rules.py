"""Business rules behind the derived columns of the files and extracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perilframe.functions.dialect import join_text, layer_text


def policy_key(prefix: str = "") -> Column:
    """Symbol, number and module of a policy term."""
    return join_text(*(f"{prefix}policy_{part}_cd" for part in ("symbol", "number", "module")))


def policy_version_key(prefix: str = "") -> Column:
    """Policy key with the version added."""
    return join_text(policy_key(prefix), f"{prefix}current_version_no")


def policy_layer_key(layer_owner: Column, layer_no: Column, prefix: str = "") -> Column:
    """Version key with the layer added when there is an excess layer."""
    suffix = F.when(layer_owner.isNotNull(), join_text(F.lit("-"), layer_text(layer_no)))
    return join_text(policy_version_key(prefix), suffix)


def line_of_business(business_unit: Column, product_cd: Column) -> Column:
    """Line of business. ``product_cd`` is the folded list, so only terms with a single
    product can match a product code."""
    return (
        F.when(business_unit == "PIM", F.when(product_cd == "PIMPROPEX", "PIMx").otherwise("PIMt"))
        .when(business_unit == "AED", "ALT")
        .when(business_unit == "GARS", F.when(product_cd == "DPG", "GARS_Condo").otherwise("GARS"))
        .otherwise(business_unit)
    )


def short_unit(business_unit: Column) -> Column:
    return F.when(business_unit == "AED", "ALT").otherwise(business_unit)


def code_and_text(code: Column, text: Column) -> Column:
    return join_text(code, F.lit("-"), text)


def contract_currency(country: Column) -> Column:
    return F.when(country == "US", "USD").when(country == "CAN", "CAD").otherwise("USD")


def location_currency(country: Column) -> Column:
    return F.when(country == "US", "USD").when(country == "CA", "CAD").otherwise("USD")


def layer_id(key: Column, excess: Column, layer_no: Column) -> Column:
    return F.when(excess == 0, join_text(key, F.lit("-01"))).when(
        excess == 1, join_text(key, F.lit("-"), layer_text(layer_no))
    )


def sub_area(country: Column, county: Column, postal: Column) -> Column:
    return F.when(country == "US", county).when(country == "CA", F.substring(postal, 1, 3))


def built_year(year: Column, unknown: str) -> Column:
    """1900 stands for an unknown year of construction."""
    return F.when(year == "1900", unknown).otherwise(year)


def stories_or_unknown(stories: Column) -> Column:
    return F.when(stories == "", "Unknown").otherwise(stories)
