"""The join spine shared by details, files and extracts: term -> risk -> structure -> peril.

Order of the joins: risks by term, addresses by location, then structures, coverages and
perils all by risk id, so those three share one partitioning; the limits and deductibles
follow by peril row. Only equi-joins occur. No table here is broadcast by hint: adaptive
execution broadcasts a side once its measured size allows it, and splits a skewed
partition when one term or address holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.sources.mart import Mart


def on_same(left: str, right: str, key: str) -> Column:
    return F.col(f"{left}.{key}") == F.col(f"{right}.{key}")


def add_risks(frame: DataFrame, mart: Mart, term: str) -> DataFrame:
    """Risks of the terms aliased ``term``, with their addresses."""
    return frame.join(
        mart["risk"].alias("risk"), on_same(term, "risk", "policy_term_id")
    ).join(mart["location"].alias("location"), on_same("risk", "location", "location_id"))


def add_structures(
    frame: DataFrame, mart: Mart, alive: Column | None = None, coverage: bool = True
) -> DataFrame:
    """Structures still alive, and their coverages."""
    structures = mart["risk_property_structure"]
    if alive is not None:
        structures = structures.filter(alive)
    joined = frame.join(structures.alias("structure"), on_same("risk", "structure", "risk_id"))
    if coverage:
        joined = joined.join(
            mart["covered_property_structure"].alias("covered"),
            on_same("risk", "covered", "risk_id"),
        )
    return joined


def add_perils(
    frame: DataFrame, mart: Mart, alive: Column | None = None, product: str = "left"
) -> DataFrame:
    """Peril rows of the risks with product and peril texts."""
    perils = mart["risk_peril_product"]
    if alive is not None:
        perils = perils.filter(alive)
    return (
        frame.join(perils.alias("rpp"), on_same("risk", "rpp", "risk_id"))
        .join(mart["product"].alias("product"), on_same("rpp", "product", "product_id"), product)
        .join(mart["peril"].alias("peril"), on_same("rpp", "peril", "peril_id"), "left")
    )


def add_limits(frame: DataFrame, mart: Mart) -> DataFrame:
    limits = mart["limit_property_structure"].alias("lim")
    return frame.join(limits, on_same("rpp", "lim", "risk_peril_product_id"), "left")


def add_deductibles(frame: DataFrame, mart: Mart) -> DataFrame:
    deductibles = mart["deductible_property_structure"].alias("ded")
    return frame.join(deductibles, on_same("rpp", "ded", "risk_peril_product_id"), "left")


def from_table(alias: str, columns: tuple[str, ...]) -> list[Column]:
    return [F.col(f"{alias}.{c}") for c in columns]
