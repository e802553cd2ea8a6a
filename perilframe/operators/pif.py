"""Policies in force, their products, and samples of them."""

from __future__ import annotations

from datetime import date

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilframe.functions.dialect import term_in_force
from perilframe.functions.fixed import PRODUCT_SEPARATOR
from perilframe.params import InForce
from perilframe.sources.mart import Mart
from perilframe.sources.staging import Stage

# Rows per id range when rows of a group are numbered, about, and ranges at least and at most.
ROWS_PER_RANGE, LEAST_RANGES, MOST_RANGES = 250_000, 8, 10_000


def terms_in_force(mart: Mart, as_of: date, spec: InForce) -> DataFrame:
    return mart["policy_term"].filter(term_in_force(as_of, spec))


def policy_products(mart: Mart, as_of: date, spec: InForce) -> DataFrame:
    """Distinct policy term x product in force on the date.

    The date is a literal column, never a joined one-row table. Duplicates are removed on
    the narrow id pair (with a map-side pass, so a term holding many risks shrinks before
    it is shuffled); the product texts join the distinct pairs.
    """
    terms = terms_in_force(mart, as_of, spec).select("policy_term_id", "business_unit_cd")
    risks = mart["risk"].select("risk_id", "policy_term_id")
    insured = mart["risk_peril_product"].select("risk_id", "product_id")
    products = mart["product"].select("product_id", "product_cd", "product_desc").distinct()
    pairs = (
        terms.join(risks, "policy_term_id")
        .join(insured, "risk_id")
        .select("policy_term_id", "business_unit_cd", "product_id")
        .distinct()
    )
    return pairs.join(products, "product_id").select(
        "policy_term_id",
        "business_unit_cd",
        "product_id",
        "product_cd",
        "product_desc",
        F.lit(as_of).alias("mod_period"),
    )


def fold_products(pif: DataFrame) -> DataFrame:
    """One row per term; its products joined into one text per attribute."""

    def folded(column: str) -> Column:
        return F.expr(
            f"listagg(cast({column} as string), '{PRODUCT_SEPARATOR}') "
            "within group (order by product_id)"
        ).alias(column)

    return pif.groupBy("policy_term_id", "business_unit_cd", "mod_period").agg(
        folded("product_id"), folded("product_cd"), folded("product_desc")
    )


def id_borders(pif: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Borders that cut the ids into ranges of about so many rows: approximate quantiles, so
    ranges follow the data however the ids are spread."""
    ranges = min(MOST_RANGES, max(LEAST_RANGES, -(-pif.count() // rows_per_range)))
    wanted = [i / ranges for i in range(1, ranges)]
    return sorted(set(pif.approxQuantile("policy_term_id", wanted, 0.25 / ranges)))


def number_in_group(pif: DataFrame, stage: Stage | None = None,
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number the rows of each business unit x product, newest term first.

    A plain window would sort a whole business unit in one task. Here the ids are cut into
    ranges taken from the data: rows are numbered inside the range of their group and
    shifted by the count of the newer ranges, which gives the same numbers. The ranges, the
    counts and the rows are three passes; a ``stage`` derives the policies once for them.
    """
    group = ["business_unit_cd", "product_desc"]
    rows = stage.keep(pif, "numbered_policies") if stage else pif
    splits = [-float("inf"), *id_borders(rows, rows_per_range), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="policy_term_id", outputCol="id_bucket").transform(rows)
    newer = (
        Window.partitionBy(*group)
        .orderBy(F.desc("id_bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        cut.groupBy(*group, "id_bucket")
        .agg(F.count(F.lit(1)).alias("bucket_rows"))
        .select(
            *(F.col(g).alias(f"s_{g}") for g in group),
            F.col("id_bucket").alias("s_bucket"),
            F.coalesce(F.sum("bucket_rows").over(newer), F.lit(0)).alias("shift"),
        )
    )
    inside = Window.partitionBy(*group, "id_bucket").orderBy(
        F.desc("policy_term_id"), F.asc("product_id")
    )
    same_bucket = F.col("id_bucket") == F.col("s_bucket")
    for g in group:
        same_bucket = same_bucket & F.col(g).eqNullSafe(F.col(f"s_{g}"))
    return (
        cut.withColumn("inside", F.row_number().over(inside))
        .join(shifts, same_bucket)
        .select(
            *pif.columns,
            (F.col("inside") + F.col("shift")).cast("bigint").alias("bu_product_row_number"),
        )
    )


def sample_per_group(pif: DataFrame, n: int = 5, keep_ids: tuple[int, ...] = (),
                     stage: Stage | None = None) -> DataFrame:
    """The newest ``n`` rows of each business unit x product, and any listed term."""
    if keep_ids:
        numbered = number_in_group(pif, stage)
        return numbered.filter(
            (F.col("bu_product_row_number") <= n) | F.col("policy_term_id").isin(*keep_ids)
        )
    # Without listed terms Spark keeps only n rows per group before the shuffle.
    newest = Window.partitionBy("business_unit_cd", "product_desc").orderBy(
        F.desc("policy_term_id"), F.asc("product_id")
    )
    rank = F.row_number().over(newest)
    return (
        pif.withColumn("bu_product_row_number", rank)
        .filter(F.col("bu_product_row_number") <= n)
        .withColumn("bu_product_row_number", F.col("bu_product_row_number").cast("bigint"))
    )
