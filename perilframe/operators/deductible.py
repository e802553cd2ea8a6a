"""Blanket deductibles: from deductibles per building and peril to policy terms."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions.dialect import alive
from perilframe.functions.fixed import (
    FLOOD_AREA,
    PERIL_SEPARATOR,
    PERILS,
    QUAKE_AREA,
    WIND_AREA,
)
from perilframe.operators.spine import (
    add_deductibles,
    add_perils,
    add_risks,
    add_structures,
    from_table,
)
from perilframe.params import Alive, RunParams
from perilframe.schema import ADDRESS, BLANKET_DEDUCTIBLES, PERIL_FLAGS, SITE_DEDUCTIBLES
from perilframe.sources.mart import Mart

LAYER_COLUMNS = ("mod_period", "policy_term_id", "business_unit_cd", "business_unit_desc",
                 "profit_center_cd", "profit_center_desc", "producer_cd", "producer_desc", "spmv")
STRUCTURE_COLUMNS = ("risk_property_structure_id", "structure_desc", "stories_no",
                     "square_footage_no", "construction_scheme_desc", "construction_cd",
                     "construction_desc", "occupancy_scheme_desc", "occupancy_cd",
                     "occupancy_desc")
SUBLIMIT_FLAGS = tuple(f"sublimit_{flag}" for flag in PERIL_FLAGS)
# Rows deleted on the date itself are already gone in the contract details.
STILL_THERE = Alive(on_date_counts=False)


def insured_risks(mart: Mart, terms: DataFrame, params: RunParams, product: str) -> DataFrame:
    """Terms (aliased ``layer``) x living risks x living perils."""
    still = alive(params.as_of, STILL_THERE)
    risks = add_risks(terms.alias("layer"), mart, "layer")
    structures = add_structures(risks, mart, still, coverage=False)
    return add_perils(structures, mart, still, product)


def deductible_detail(mart: Mart, layers: DataFrame, params: RunParams) -> DataFrame:
    """Term x layer x risk x peril x product with address, structure and deductibles."""
    joined = add_deductibles(insured_risks(mart, layers, params, "inner"), mart)
    return joined.select(
        *from_table("layer", LAYER_COLUMNS),
        "risk.risk_id",
        *from_table("structure", ("location_cd", "building_cd")),
        "product.product_cd",
        *from_table("peril", ("peril_id", "peril_cd", "peril_desc")),
        *from_table("location", ADDRESS),
        *from_table("structure", STRUCTURE_COLUMNS),
        *from_table("ded", ("deduct_property_structure_id", "risk_peril_product_id",
                            *BLANKET_DEDUCTIBLES, *SITE_DEDUCTIBLES,
                            "source_system_id", "create_ts", "update_ts", "deductible_hash_txt")),
    )


def blanket_by_peril(
    mart: Mart, terms: DataFrame, layers: DataFrame, params: RunParams
) -> DataFrame:
    """Rows of the deductible detail per term, peril and set of blanket deductibles.

    The detail repeats every risk once per layer and never looks at the layer. So risks are
    counted without layers, on the columns of the group only, and the count is multiplied
    by the term's layer rows.
    """
    joined = add_deductibles(insured_risks(mart, terms, params, "inner"), mart)
    keys = ("policy_term_id", "peril_cd", *BLANKET_DEDUCTIBLES)
    counted = (
        joined.select("layer.policy_term_id", "peril.peril_cd",
                      *from_table("ded", BLANKET_DEDUCTIBLES))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("risk_rows"))
    )
    layer_rows = layers.groupBy("policy_term_id").agg(F.count(F.lit(1)).alias("layer_rows"))
    flags = (
        F.when(F.col("peril_cd") == p, 1).otherwise(0).alias(f)
        for p, f in zip(PERILS, SUBLIMIT_FLAGS)
    )
    return counted.join(layer_rows, "policy_term_id").select(
        "policy_term_id",
        "peril_cd",
        *flags,
        *BLANKET_DEDUCTIBLES,
        (F.col("risk_rows") * F.col("layer_rows")).alias("blanket_risk_count"),
    )


def blanket_groups(blankets: DataFrame, risks: DataFrame, perils: DataFrame) -> DataFrame:
    """Perils sharing one non-zero blanket amount, percent and risk count.

    ``perils`` may hold several rows per term; each repeats the peril in the count and in
    the list. The list is built from one entry per peril code, repeated as often as it
    occurs, so a group never gathers more entries than there are perils.
    """
    amount, percent = F.col("blanket_deductible_amt"), F.col("blanket_deductible_pcnt")
    keys = ("policy_term_id", "policy_risk_count", "policy_peril_count",
            "blanket_deductible_amt", "blanket_deductible_pcnt", "blanket_risk_count")
    per_peril = (
        blankets.filter((amount != 0) | (percent != 0))
        .join(risks, "policy_term_id", "left")
        .join(perils, "policy_term_id", "left")
        .withColumnRenamed("risk_count", "policy_risk_count")
        .groupBy(*keys, "peril_cd")
        .agg(F.count(F.lit(1)).alias("peril_rows"))
    )
    repeated = F.when(
        F.col("peril_cd").isNotNull(),
        F.expr(f"array_join(array_repeat(peril_cd, cast(peril_rows as int)), '{PERIL_SEPARATOR}')"),
    )
    flags = (
        F.max(F.when(F.col("peril_cd") == p, 1).otherwise(0)).alias(f)
        for p, f in zip(PERILS, SUBLIMIT_FLAGS)
    )
    return (
        per_peril.withColumn("peril_text", repeated)
        .groupBy(*keys)
        .agg(
            F.sum("peril_rows").alias("blanket_peril_count"),
            *flags,
            F.expr(
                f"listagg(peril_text, '{PERIL_SEPARATOR}') within group (order by peril_cd)"
            ).alias("peril_cd_list"),
        )
        .withColumn(
            "policy_blanket_ind",
            F.when(F.col("blanket_risk_count") == F.col("policy_risk_count"), 1).otherwise(0),
        )
    )


def deductible_terms(groups: DataFrame) -> DataFrame:
    """Read each group as a policy deductible (fire) or as a sublimit (other perils)."""
    value = F.coalesce("blanket_deductible_amt", "blanket_deductible_pcnt").cast("decimal(20,4)")
    fire, hurricane, quake, flood, wind = (
        F.col(f"sublimit_{p}_ind") == 1
        for p in ("fire", "hurricane", "earthquake", "flood", "wind_hail")
    )
    whole = F.col("policy_blanket_ind") == 1
    sublimit = whole & ~fire
    area = (
        F.when(hurricane | wind, WIND_AREA).when(quake, QUAKE_AREA).when(flood, FLOOD_AREA)
    )
    flood_only = ~fire & flood & ~quake & ~hurricane & ~wind
    return groups.filter(~flood_only).select(
        "*",
        F.when(whole & fire, value).alias("dedamt1"),
        F.when(sublimit, area).alias("sublimitarea"),
        F.when(sublimit, F.lit("B")).alias("sublimitdedtype"),
        F.when(sublimit, value).alias("sublimitdedamt1"),
    )


def spread_dedamt(terms: DataFrame) -> DataFrame:
    """Give every row of a term the row count and the last fire deductible of the term.

    Last means highest blanket indicator, then highest fire indicator; equal rows are
    settled by the larger amount. Only rows with both indicators set carry an amount, so
    the last one is the largest one. Both values come from a grouped aggregate (combined
    on the map side) that joins back: no task ever holds a whole term, as a window would.
    Both branches read one shuffle of the blanket groups, which Spark plans once.
    """
    per_term = terms.groupBy("policy_term_id").agg(
        F.count(F.lit(1)).alias("raw_layer_count"), F.max("dedamt1").alias("term_dedamt1")
    )
    return terms.join(per_term, "policy_term_id").select(
        "policy_term_id",
        "raw_layer_count",
        F.col("term_dedamt1").alias("dedamt1"),
        *SUBLIMIT_FLAGS,
        "sublimitarea",
        "sublimitdedtype",
        "sublimitdedamt1",
    )


def policy_deductible(spread: DataFrame) -> DataFrame:
    """A term's only row, or its sublimit rows when it has several."""
    return spread.filter(
        (F.col("raw_layer_count") == 1) | F.col("sublimitarea").isNotNull()
    ).drop("raw_layer_count")


def mark_all_peril(deductibles: DataFrame, perils: DataFrame) -> DataFrame:
    """Flag deductibles that reach as many perils as the policy covers."""
    reached: Column = reduce(add, (F.col(f) for f in SUBLIMIT_FLAGS))
    return deductibles.join(
        perils.select("policy_term_id", "policy_peril_count"), "policy_term_id", "left"
    ).select(
        *deductibles.columns,
        F.when(reached == F.col("policy_peril_count"), 1).otherwise(0).alias("isallperildeductible"),
    )
