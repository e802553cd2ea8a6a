"""Written premium per policy term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.functions.fixed import DIRECT_TYPES, PREMIUM_YEARS
from perilframe.operators.skew import salted_join
from perilframe.params import RunParams
from perilframe.sources.mart import Mart


def link_policy_id(mart: Mart, folded: DataFrame) -> DataFrame:
    """Policy term -> warehouse policy id, matched on symbol, number, module and version."""
    terms = mart["policy_term"].select(
        "policy_term_id",
        F.col("policy_symbol_cd").alias("policy_symbol"),
        F.col("policy_number_cd").alias("policy_number"),
        F.col("policy_module_cd").alias("policy_module"),
        F.col("current_version_no").alias("policy_version_cd"),
    )
    key = ["policy_symbol", "policy_number", "policy_module", "policy_version_cd"]
    policies = mart["d_policy"].select("policy_id", *key)
    return (
        folded.select("policy_term_id")
        .join(terms, "policy_term_id", "left")
        .join(policies, key, "left")
        .select("policy_term_id", "policy_id")
    )


def policy_premium(mart: Mart, links: DataFrame, params: RunParams) -> DataFrame:
    """Sum of written-premium changes per term and policy id.

    The transaction type is looked up without restricting the sum, so all it can do is
    repeat an amount when the type table lists a transaction twice. Amounts are therefore
    weighted by that count and summed per policy before they meet the policy terms: only
    one row per policy and one per term reach the join. Only facts of linked policies are
    read on; terms without a warehouse policy share the key NULL and bypass the join.
    """
    per_link = links.groupBy("policy_term_id", "policy_id").agg(
        F.count(F.lit(1)).alias("link_rows")
    )
    items = mart["d_transaction_items"].filter(
        F.col("rein_transaction_type_desc").isin(*DIRECT_TYPES)
    )
    repeats = items.groupBy("transaction_items_id").agg(F.count(F.lit(1)).alias("repeats"))
    facts = mart["f_divisional_premiums"].filter(
        F.col("transaction_accounting_year") >= params.now.year - PREMIUM_YEARS
    ).join(per_link.select("policy_id").dropna().distinct(), "policy_id", "left_semi")
    how = "inner" if params.direct_premium_only else "left"
    per_policy = (
        facts.join(repeats, F.col("written_transaction_id") == F.col("transaction_items_id"), how)
        .withColumn("times", F.coalesce("repeats", F.lit(1)).cast("int"))
        .groupBy("policy_id")
        .agg(F.sum(F.col("change_written_premium") * F.col("times")).alias("premium"))
    )
    return salted_join(per_link, per_policy, ["policy_id"], "left").select(
        "policy_term_id",
        "policy_id",
        (F.col("premium") * F.col("link_rows")).cast("decimal(38,2)").alias("total_policy_premium"),
    )
