"""Reconciliations between the steps of the files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.operators.deductible import insured_risks
from perilframe.operators.spine import add_deductibles
from perilframe.plans.contract import Contract


def deductible_rows(contract: Contract) -> DataFrame:
    """Rows of the deductible detail per term, counted per risk and multiplied by layers."""
    terms, layers = contract.terms_in_force, contract.layers
    details = add_deductibles(
        insured_risks(contract.mart, terms, contract.params, "inner"), contract.mart
    )
    risk_rows = details.groupBy("layer.policy_term_id").agg(F.count(F.lit(1)).alias("risk_rows"))
    layer_rows = layers.groupBy("policy_term_id").agg(F.count(F.lit(1)).alias("layer_rows"))
    return risk_rows.join(layer_rows, "policy_term_id").select(
        "policy_term_id", (F.col("risk_rows") * F.col("layer_rows")).alias("actual_count")
    )


def count_comparison(
    rows: DataFrame, layers: DataFrame, perils: DataFrame, risks: DataFrame
) -> DataFrame:
    """Perils times risks against the rows found, per term."""
    expected = F.col("policy_peril_count") * F.col("risk_count")
    return (
        rows.join(layers, "policy_term_id", "left")
        .join(perils, "policy_term_id", "left")
        .join(risks, "policy_term_id", "left")
        .select(
            "policy_term_id", "layer_count", "policy_peril_count", "excess_layer_peril_count",
            "risk_count", expected.alias("theoretical_count"), "actual_count",
            F.when(expected == F.col("actual_count"), 1).otherwise(0).alias("match_indicator"),
        )
    )


def count_mismatches(comparison: DataFrame) -> DataFrame:
    return comparison.filter(F.col("match_indicator") == 0)


def small_blankets(layers: DataFrame, groups: DataFrame, perils: int = 2) -> DataFrame:
    """Policy layers of terms holding a blanket over few perils, once per such blanket."""
    few = groups.filter(F.col("blanket_peril_count") <= perils).select("policy_term_id")
    return layers.join(few, "policy_term_id")


def blankets_of(layers: DataFrame, groups: DataFrame, term_ids: tuple[int, ...]) -> DataFrame:
    """Blanket groups of named terms with their policy keys."""
    keys = layers.select("policy_term_id", "spm")
    named = groups.filter(F.col("policy_term_id").isin(*term_ids))
    return named.join(keys, "policy_term_id", "left").orderBy(
        "policy_term_id", "policy_blanket_ind", "sublimit_fire_ind"
    )


def pif_summary(pif: DataFrame, terms: DataFrame) -> DataFrame:
    """Policies in force per business unit and product."""
    units = terms.select("policy_term_id", "business_unit_desc")
    return (
        pif.join(units, "policy_term_id")
        .groupBy("mod_period", "business_unit_desc", "product_desc")
        .agg(F.count(F.lit(1)).alias("pif_count"))
    )


def initial_final(pif: DataFrame, detail: DataFrame, file: DataFrame) -> DataFrame:
    """Policies and locations before and after the location file is built."""

    def row(frame: DataFrame, granularity: str, source: str, count) -> DataFrame:
        return frame.agg(count.cast("bigint").alias("record_count")).select(
            F.lit(granularity).alias("granularity"),
            F.lit(source).alias("source_name"),
            "record_count",
        )

    rows = F.count(F.lit(1))
    # The file is built once for both of its counts.
    final = file.agg(F.countDistinct("ContractID").alias("p"), rows.alias("l")).select(
        F.inline(F.array(*(
            F.struct(
                F.lit(name).alias("granularity"), F.lit("Final").alias("source_name"),
                F.col(c).cast("bigint").alias("record_count"),
            )
            for name, c in (("Policy", "p"), ("Location", "l"))
        )))
    )
    return (
        row(pif, "Policy", "Initial", rows)
        .union(row(detail, "Location", "Initial", F.countDistinct("risk_id")))
        .union(final)
        .distinct()
    )


def initial_final_by_policy(detail: DataFrame, file: DataFrame) -> DataFrame:
    """Locations per policy before and after."""

    def counted(frame: DataFrame, source: str, key: str, count) -> DataFrame:
        return frame.groupBy(F.col(key).alias("ContractID")).agg(
            count.cast("bigint").alias("record_count")
        ).select(
            F.lit("Policy-Location").alias("granularity"),
            F.lit(source).alias("source_name"),
            "ContractID",
            "record_count",
        )

    return counted(detail, "Initial", "spm", F.countDistinct("risk_id")).union(
        counted(file, "Final", "ContractID", F.count(F.lit(1)))
    ).distinct()


def staged_subset(file: DataFrame, hashes: DataFrame) -> DataFrame:
    """File rows whose place hash is staged; a hash staged twice repeats its rows."""
    staged = hashes.filter(F.col("risk_place_hash_txt").isNotNull())
    return file.join(staged, "risk_place_hash_txt").select(*file.columns)
