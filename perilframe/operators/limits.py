"""Limits per building and peril, grouped to find blanket limits of a policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.operators.deductible import LAYER_COLUMNS, STRUCTURE_COLUMNS, insured_risks
from perilframe.operators.spine import add_limits, from_table
from perilframe.params import RunParams
from perilframe.schema import ADDRESS, BLANKET_LIMITS, SITE_LIMITS
from perilframe.sources.mart import Mart

LIMIT_KEYS = ("policy_term_id", "spmv", "peril_id", "peril_desc", *BLANKET_LIMITS, *SITE_LIMITS)


def limit_detail(mart: Mart, layers: DataFrame, params: RunParams) -> DataFrame:
    """Term x layer x risk x peril x product with address, structure and limits. Unlike in
    the deductible detail, rows without a product stay."""
    joined = add_limits(insured_risks(mart, layers, params, "left"), mart)
    return joined.select(
        *from_table("layer", LAYER_COLUMNS),
        "risk.risk_id",
        *from_table("structure", ("location_cd", "building_cd")),
        "product.product_cd",
        *from_table("peril", ("peril_id", "peril_desc")),
        *from_table("location", ADDRESS),
        *from_table("structure", STRUCTURE_COLUMNS),
        *from_table("lim", ("risk_peril_product_id", "limit_property_structure_id",
                            *BLANKET_LIMITS, *SITE_LIMITS,
                            "source_system_id", "create_ts", "update_ts", "limit_hash_txt")),
    )


def limit_rows(mart: Mart, layers: DataFrame, params: RunParams) -> DataFrame:
    """The detail cut down to what its groupings read. They count distinct risks, which the
    layers of a term cannot change, so each term enters once per version key."""
    terms = layers.select("policy_term_id", "spmv").distinct()
    joined = add_limits(insured_risks(mart, terms, params, "left"), mart)
    return joined.select(
        *from_table("layer", ("policy_term_id", "spmv")),
        "risk.risk_id",
        *from_table("peril", ("peril_id", "peril_desc")),
        *from_table("lim", (*BLANKET_LIMITS, *SITE_LIMITS)),
    )


def risk_peril_count(details: DataFrame) -> DataFrame:
    return details.groupBy("policy_term_id", "peril_id").agg(
        F.countDistinct("risk_id").alias("policy_peril_risk_count")
    )


def limit_groups(details: DataFrame) -> DataFrame:
    """Distinct risks per term, peril and set of limits."""
    return details.groupBy(*LIMIT_KEYS).agg(
        F.countDistinct("risk_id").alias("policy_peril_location_count")
    )


def blanket_limits(groups: DataFrame, risks: DataFrame) -> DataFrame:
    """Mark limits that every risk of a term shares; drop groups without any limit.

    A group is dropped only when its blanket, building, contents and business-income limits
    are each NULL or 0 and its other six limits are all NULL; a 0 among the six keeps it.
    (The test on the six reads "is NULL and equals 0": unknown for NULL, false otherwise.)
    """

    def unset(column: str) -> Column:
        return F.col(column).isNull() | (F.col(column) == 0)

    absent = ("blanket_building_limit_amt", "blanket_contents_limit_amt", "blanket_bi_limit_amt",
              "blanket_combined_limit_amt", "site_limit_amt", "combined_limit_amt")
    nothing = unset("blanket_limit_amt")
    for column in ("building_limit_amt", "contents_limit_amt", "bi_limit_amt"):
        nothing = nothing & unset(column)
    for column in absent:
        nothing = nothing & F.col(column).isNull()
    shared = (F.col("policy_peril_location_count") == F.col("risk_count")) & (
        F.col("risk_count") != 1
    )
    return (
        groups.filter(~nothing)
        .join(risks, "policy_term_id", "left")
        .withColumn("policy_blanket_ind", F.when(shared, 1).otherwise(0))
    )
