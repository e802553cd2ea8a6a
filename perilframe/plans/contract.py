"""Contract file: one row per policy term, excess layer and sublimit."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe.functions.dialect import join_text
from perilframe.functions.layout import FILE_FLAGS
from perilframe.functions.rules import (
    code_and_text,
    contract_currency,
    layer_id,
    line_of_business,
    short_unit,
)
from perilframe.operators import deductible as ded
from perilframe.operators import layers as lay
from perilframe.operators.pif import fold_products, policy_products
from perilframe.operators.premium import link_policy_id, policy_premium
from perilframe.params import RunParams
from perilframe.plans.predicate import asks_only_for
from perilframe.schema import PERIL_FLAGS
from perilframe.sources.mart import Mart
from perilframe.sources.staging import Stage, too_many_to_broadcast



@dataclass(frozen=True)
class Contract:
    """The steps of the contract file over one mart and run.

    Every step is a lazy DataFrame. Five steps read the policy x layer view; with a
    ``stage`` it is written once (policy grain, small beside risks and perils) and the
    policies in force are then taken from it, instead of being found again per step.
    """

    mart: Mart
    params: RunParams
    stage: Stage | None = None
    view: DataFrame | None = None  # the policy x layer view, where it is at hand

    @cached_property
    def pif(self) -> DataFrame:
        return policy_products(self.mart, self.params.as_of, self.params.contract_terms)

    @cached_property
    def folded(self) -> DataFrame:
        return fold_products(self.pif)

    @cached_property
    def layers(self) -> DataFrame:
        if self.view is not None:
            return self.view
        view = lay.policy_layers(self.mart, self.folded)
        return self.stage.keep(view, "policy_layers") if self.stage else view

    @cached_property
    def layers_by_term(self) -> DataFrame:
        """The view, to be grouped by term and joined: Spark takes a few of its columns for few
        bytes, whatever the number of rows."""
        if not self.stage or self.view is not None:
            return self.layers
        many = too_many_to_broadcast(self.layers.select("policy_term_id"))
        return self.layers.hint("merge") if many else self.layers

    @cached_property
    def terms_in_force(self) -> DataFrame:
        """One row per policy term in force."""
        if self.stage or self.view is not None:
            return self._kept(self.layers.select("policy_term_id").distinct(), "terms")
        return self.folded.select("policy_term_id")

    def _kept(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame, written where there is a stage. Sides that join by term would else run their
        groupings and joins in one task, which holds the memory of all of them at once. The
        terms of a predicate (``view``) are few and stay one plan."""
        if not self.stage or self.view is not None:
            return frame
        return self.stage.keep_side(frame, f"{name}_{uuid4().hex}")

    @cached_property
    def premium(self) -> DataFrame:
        links = link_policy_id(self.mart, self.terms_in_force)
        return self._kept(policy_premium(self.mart, links, self.params), "premium")

    @cached_property
    def perils(self) -> DataFrame:
        return lay.peril_count(self.layers_by_term)

    @cached_property
    def risks(self) -> DataFrame:
        return lay.risk_count(self.mart, self.layers_by_term)

    @cached_property
    def blankets(self) -> DataFrame:
        return ded.blanket_by_peril(self.mart, self.terms_in_force, self.layers_by_term, self.params)

    @cached_property
    def groups(self) -> DataFrame:
        blankets = self._kept(self.blankets, "blankets")
        return self._kept(ded.blanket_groups(blankets, self.risks, self.perils), "groups")

    @cached_property
    def terms(self) -> DataFrame:
        return ded.deductible_terms(self.groups)

    @cached_property
    def spread(self) -> DataFrame:
        return ded.spread_dedamt(self.terms)

    @cached_property
    def deductible(self) -> DataFrame:
        marked = ded.mark_all_peril(ded.policy_deductible(self.spread), self.perils)
        return self._kept(marked, "deductible")

    def file(self, predicate: Column | None = None) -> DataFrame:
        """The contract file, optionally restricted on its own columns."""
        if predicate is None:
            return contract_rows(self.layers, self.premium, self.deductible, self.params)
        kept = self.only(predicate)
        rows = contract_rows(kept.layers, kept.premium, kept.deductible, kept.params)
        return rows.filter(predicate)

    def only(self, predicate: Column) -> Contract:
        """The steps for the terms of which some row can pass the predicate.

        Their ids are found once on the policy x layer view, and premium, risks, deductibles
        and layers are semi-joined to them before they are aggregated. All layers of a kept
        term stay, as the counts need them. A predicate that asks for premium or deductible
        columns names no terms beforehand; then nothing is left out.
        """
        spark = self.mart.spark
        rows = contract_rows(
            self.layers, _no_rows(spark, PREMIUM_SIDE), _no_rows(spark, DEDUCTIBLE_SIDE), self.params
        )
        if not asks_only_for(predicate, rows, FROM_SIDES):
            return self
        keys = rows.filter(predicate).select("policy_term_id").distinct()
        if self.stage:
            keys = self.stage.keep(keys, f"kept_terms_{uuid4().hex}")
        layers = self.layers.join(keys, "policy_term_id", "left_semi")
        return replace(self, mart=self.mart.within(keys), view=layers)


# Columns the file takes from the sides, and what these sides hold.
FROM_SIDES = ("Premium", "DedType", "DedAmt1", *ded.SUBLIMIT_FLAGS, "SublimitArea", "SublimitAttachAmt")
PREMIUM_SIDE = ("policy_term_id", "total_policy_premium")
DEDUCTIBLE_SIDE = ("policy_term_id", "isallperildeductible", "dedamt1", *ded.SUBLIMIT_FLAGS,
                   "sublimitarea", "sublimitdedamt1")


def _no_rows(spark: SparkSession, columns: tuple[str, ...]) -> DataFrame:
    return spark.range(1).select(*(F.lit(None).cast("bigint").alias(c) for c in columns)).filter("false")


def contract_rows(
    layers: DataFrame, premium: DataFrame, deductible: DataFrame, params: RunParams
) -> DataFrame:
    """Assemble the file's columns."""
    rows = (
        layers.alias("l")
        .join(premium.alias("p"), F.col("l.policy_term_id") == F.col("p.policy_term_id"), "left")
        .join(deductible.alias("d"), F.col("l.policy_term_id") == F.col("d.policy_term_id"), "left")
    )
    unit, product = F.col("l.business_unit_cd"), F.col("l.product_cd")
    excess = F.col("l.excess_policy_ind")
    all_perils = F.col("d.isallperildeductible") == 1
    some_perils = F.col("d.isallperildeductible") == 0
    lob = line_of_business(unit, product)

    def layer_amount(column: str) -> Column:
        return F.when(excess == 1, F.col(f"l.excess_{column}"))

    def blank(name: str) -> Column:
        return F.lit("").alias(name)

    return rows.select(
        F.col("l.spm").alias("ContractID"),
        F.col("l.primary_insured_nm").alias("InsuredName"),
        lob.alias("LOB"),
        short_unit(unit).alias("UDF1"),
        code_and_text(F.col("l.profit_center_cd"), F.col("l.profit_center_desc")).alias("UDF2"),
        code_and_text(F.col("l.producer_cd"), F.col("l.producer_desc")).alias("ProducerName"),
        F.col("l.underwriter_nm").alias("Underwriter"),
        excess,
        *(F.col(f"l.policy_{f}") for f in FILE_FLAGS),
        F.col("l.policy_term_effective_dt").alias("InceptionDate"),
        F.col("l.policy_term_expiration_dt").alias("ExpirationDate"),
        contract_currency(F.col("l.producer_country_cd")).alias("Currency"),
        layer_id(F.col("l.spm"), excess, F.col("l.excess_layer_no")).alias("LayerID"),
        *(F.col(f"l.excess_{f}") for f in lay.LAYER_FLAGS),
        F.when(excess == 0, "").when(excess == 1, "E").alias("LimitType"),
        layer_amount("part_of_amt").alias("Limit1"),
        *(blank(f"Limit{x}") for x in "ABCD"),
        layer_amount("attachment_point_amt").alias("AttachmentAmt"),
        layer_amount("limit_amt").alias("Limit2"),
        F.when(all_perils, "MI").alias("DedType"),
        F.when(all_perils, F.col("d.dedamt1")).alias("DedAmt1"),
        blank("DedAmt2"),
        F.col("p.total_policy_premium").alias("Premium"),
        *(F.when(some_perils, F.col(f"d.{f}")).alias(f) for f in ded.SUBLIMIT_FLAGS),
        F.when(some_perils, F.col("d.sublimitarea")).alias("SublimitArea"),
        *(blank(f"{n}") for n in ("SublimitType", "SubLimitOcc")),
        *(blank(f"SublimitLimit{x}") for x in "ABCD"),
        F.col("d.sublimitdedamt1").alias("SublimitAttachAmt"),
        *(blank(f"Sublimit{n}") for n in ("Part", "DedType", "DedAmt1", "DedAmt2")),
        F.col("l.policy_nbcr_ind").alias("UDF3"),
        join_text(F.lit(f"{params.source_tag}-"), "l.policy_entry_system_desc").alias("UDF4"),
        lob.alias("UDF5"),
        F.lit(params.now).cast("timestamp").alias("AsOfDate"),
        F.col("l.mod_period").alias("ModPeriod"),
        F.col("l.policy_term_id"),
        product,
    )
