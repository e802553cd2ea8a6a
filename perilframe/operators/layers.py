"""Excess layers, the policy x layer view and the counts taken on it."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions.fixed import NO_PERIL, PERILS
from perilframe.functions.rules import policy_key, policy_layer_key, policy_version_key
from perilframe.operators.spine import on_same
from perilframe.schema import PERIL_FLAGS
from perilframe.sources.mart import Mart

LAYER_TERMS = ("limit_amt", "attachment_point_amt", "part_of_amt", "part_of_pcnt")
LAYER_FLAGS = tuple(f"layer_{flag}" for flag in PERIL_FLAGS) + ("layer_none_ind",)

# Columns of the policy x layer view, by the table they come from.
TERM_COLUMNS = ("policy_term_id", "company_id", "producer_profit_center_bu_id",
                "business_unit_cd", "business_unit_desc")
PRODUCER_COLUMNS = ("profit_center_cd", "profit_center_desc", "producer_cd", "producer_desc")
POLICY_COLUMNS = ("policy_symbol_cd", "policy_symbol_desc", "policy_number_cd",
                  "policy_module_cd", "current_version_no", "primary_insured_nm",
                  "policy_term_effective_dt", "policy_term_expiration_dt",
                  "cancellation_effective_dt")
COMPANY_COLUMNS = ("company_cd", "company_nm", "company_abrv_cd")


def excess_layers(mart: Mart) -> DataFrame:
    """Excess rows, one per peril, folded to one row per term x layer with a count column
    per peril."""
    excess = mart["excess"].select("policy_term_id", "layer_no", "peril_id", *LAYER_TERMS)
    perils = mart["peril"].select("peril_id", "peril_cd")

    def counted(peril: str) -> Column:
        return F.sum(F.when(F.col("peril_cd") == peril, 1).otherwise(0))

    return (
        excess.join(perils, "peril_id", "left")
        .groupBy("policy_term_id", "layer_no", *LAYER_TERMS)
        .agg(*(counted(p).alias(f) for p, f in zip((*PERILS, NO_PERIL), LAYER_FLAGS)))
    )


def policy_layers(mart: Mart, folded: DataFrame) -> DataFrame:
    """Term x layer with policy, customer, producer, product and layer columns."""
    term = mart["policy_term"].alias("t")
    producer = mart["producer_profit_center_bu"].alias("b")
    geography = mart["d_geography"].alias("g")
    place = (
        (F.col("p.location_state") == F.col("g.state_province_code"))
        & (F.col("p.state_number") == F.col("g.rein_state_province_code"))
    )
    joined = (
        folded.alias("f")
        .join(term, on_same("f", "t", "policy_term_id"), "left")
        .join(excess_layers(mart).alias("x"), on_same("t", "x", "policy_term_id"), "left")
        .join(mart["policy"].alias("y"), on_same("t", "y", "policy_id"), "left")
        .join(mart["customer"].alias("c"), on_same("y", "c", "customer_id"), "left")
        .join(producer, on_same("t", "b", "producer_profit_center_bu_id"), "left")
        .join(
            mart["d_producer"].alias("p"), F.col("b.producer_cd") == F.col("p.producer_code"), "left"
        )
        .join(geography, place, "left")
        .join(mart["company"].alias("m"), on_same("t", "m", "company_id"), "left")
    )
    return joined.select(
        "f.mod_period",
        *(f"t.{c}" for c in TERM_COLUMNS),
        *(f"b.{c}" for c in PRODUCER_COLUMNS),
        F.col("g.country_code").alias("producer_country_cd"),
        "c.customer_cd",
        policy_key("t.").alias("spm"),
        policy_version_key("t.").alias("spmv"),
        policy_layer_key(F.col("x.policy_term_id"), F.col("x.layer_no"), "t.").alias("spmvl"),
        "f.product_cd",
        "f.product_desc",
        *(f"t.{c}" for c in POLICY_COLUMNS),
        *(f"m.{c}" for c in COMPANY_COLUMNS),
        F.when(F.col("x.policy_term_id").isNull(), 0).otherwise(1).alias("excess_policy_ind"),
        *(F.col(f"t.{f}").alias(f"policy_{f}") for f in PERIL_FLAGS),
        "t.underwriter_nm",
        F.col("x.layer_no").alias("excess_layer_no"),
        *(F.col(f"x.{c}").alias(f"excess_{c}") for c in LAYER_TERMS),
        *(F.col(f"x.{f}").alias(f"excess_{f}") for f in LAYER_FLAGS),
        "t.policy_entry_system_desc",
    )


def layer_count(layers: DataFrame) -> DataFrame:
    return layers.groupBy("policy_term_id").agg(F.sum("excess_policy_ind").alias("layer_count"))


def peril_count(layers: DataFrame) -> DataFrame:
    """Perils of the policy and of the layer per term. Layers with different counts leave
    several rows for a term; terms without layers have NULL."""

    def total(prefix: str) -> Column:
        return reduce(add, (F.col(f"{prefix}{f}") for f in PERIL_FLAGS))

    return layers.select(
        "policy_term_id",
        total("policy_").cast("bigint").alias("policy_peril_count"),
        total("excess_layer_").cast("bigint").alias("excess_layer_peril_count"),
    ).distinct()


def risk_count(mart: Mart, layers: DataFrame) -> DataFrame:
    """Rows of layer x risk per term: layers times risks, and layers alone where a term has
    no risk. Both sides are counted before they meet."""
    layer_rows = layers.groupBy("policy_term_id").agg(F.count(F.lit(1)).alias("layer_rows"))
    risks = mart["risk"].groupBy("policy_term_id").agg(F.count(F.lit(1)).alias("risks"))
    return layer_rows.join(risks, "policy_term_id", "left").select(
        "policy_term_id",
        (F.col("layer_rows") * F.coalesce("risks", F.lit(1))).alias("risk_count"),
    )
