"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe import schema
from perilframe.functions.dialect import alive, term_in_force
from perilframe.operators import deductible as ded
from perilframe.operators import layers as lay
from perilframe.operators import limits as lim
from perilframe.operators import perils as per
from perilframe.operators.pif import fold_products, number_in_group, sample_per_group
from perilframe.operators.premium import link_policy_id, policy_premium
from perilframe.params import Alive, InForce, RunParams
from perilframe.plans import control_totals as ct
from perilframe.plans import extracts as ext
from perilframe.plans import location as loc
from perilframe.plans import named
from perilframe.plans import quality as dq
from perilframe.plans.contract import Contract
from perilframe.sources import publish
from perilframe.sources.mart import Mart, view
from perilframe.sources.staging import Stage
from perilframe.sources.testdata import mart_of_testdata, snapshots_of_testdata

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = date(1998, 12, 31)
PARAMS = RunParams(as_of=AS_OF, now=datetime(2000, 1, 1), source_tag="SRC")
# Terms always kept in the sample; term 66 is in force and past the fifth of its group.
KEPT_TERMS = (61, 66)
# Terms whose blankets are looked into by name.
NAMED_TERMS = (26, 31, 66)
# Columns of the location file that ought to be numeric, and one that is not.
NUMERIC_COLUMNS = ("BuildingValue", "OtherValue", "DeductBldg", "OccupancyCode", "ContractID")
# The open business that two extracts report, and the profit centre that one leaves out.
UNITS, LEFT_OUT = "A%", "2758"

IN_FORCE_VARIANTS = {
    "contract": InForce(),
    "location": InForce(cancellation="ignore"),
    "heritage": InForce(expires_on_date_counts=True, cancellation="on_or_after"),
}
ALIVE_VARIANTS = {
    "dated only": Alive(open_counts=False),
    "on date or open": Alive(),
    "after date or open": Alive(on_date_counts=False),
}


def _on_mart(make: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(mart_of_testdata(spark, sf_dir))


def _contract(make: Callable[[Contract], DataFrame], staged: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stage = Stage.of(spark) if staged else None
        return make(Contract(mart_of_testdata(spark, sf_dir), PARAMS, stage))

    return query


def _location(make: Callable[[Mart, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = mart_of_testdata(spark, sf_dir)
        return make(mart, fold_products(loc.location_pif(mart, PARAMS)))

    return query


def _counts(frame: DataFrame, variants: dict[str, Column]) -> DataFrame:
    """One pass over a table counting the rows each predicate keeps, one row per variant."""
    counted = frame.agg(*(F.count_if(p).alias(n) for n, p in variants.items()))
    rows = (
        F.struct(F.lit(n).alias("variant"), F.col(f"`{n}`").alias("kept")) for n in variants
    )
    return counted.select(F.inline(F.array(*rows)))


def _alive_counts(mart: Mart) -> DataFrame:
    variants = {n: alive(AS_OF, spec) for n, spec in ALIVE_VARIANTS.items()}
    parts = (
        _counts(mart[t], variants).select(F.lit(t).alias("source"), "variant", "kept")
        for t in ("risk_peril_product", "risk_property_structure")
    )
    return reduce(DataFrame.union, parts)


def _selection(mart: Mart) -> DataFrame:
    """Selections by business unit, profit centre and peril, counted in one pass each."""
    terms = mart["policy_term"].join(
        mart["producer_profit_center_bu"].select("producer_profit_center_bu_id", "profit_center_cd"),
        "producer_profit_center_bu_id",
    )
    by_term = _counts(
        terms,
        {
            "one unit": F.col("business_unit_cd") == "GARS",
            "units like A": F.col("business_unit_cd").like(UNITS),
            "other centres": F.col("profit_center_cd") != LEFT_OUT,
        },
    )
    perils = mart["risk_peril_product"].join(mart["peril"].select("peril_id", "peril_cd"), "peril_id")
    return by_term.union(_counts(perils, {"fire": F.col("peril_cd").isin("FIRE")}))


def _block(number: int) -> Query:
    def make(mart: Mart, folded: DataFrame) -> DataFrame:
        flags = per.risk_perils(loc.location_selection(mart, folded, PARAMS))
        return per.peril_block_rows(flags, loc.location_pivot(mart, PARAMS), number)

    return _location(make)


def _view(table: str) -> Query:
    return _on_mart(lambda m: view(m, table))


def _small_pif(mart: Mart) -> DataFrame:
    return loc.location_pif(mart, PARAMS)


def _staged_hashes(mart: Mart) -> DataFrame:
    """Places of policies with excess layers."""
    excess = mart["excess"].select("policy_term_id")
    return mart["risk"].join(excess, "policy_term_id", "left_semi").select("risk_place_hash_txt")


def _location_rows(mart: Mart) -> DataFrame:
    return loc.location_file(mart, PARAMS, stage=Stage.of(mart.spark))


def _single_structures(mart: Mart, folded: DataFrame) -> DataFrame:
    """The location file of risks with one structure, whose blocks read their own row."""
    selection = loc.location_selection(mart, folded, PARAMS)
    single = loc.flag_counts(selection).filter("copies = 1")
    alone = selection.join(single, "risk_id", "left_semi")
    return loc.location_rows(alone, loc.location_pivot(mart, PARAMS, alone), PARAMS, one_structure=True)


def _twice_written(contract: Contract) -> DataFrame:
    """The contract file as written, then one line of business written anew without its primary
    layers; the other lines stay."""
    path = Stage.of(contract.mart.spark).folder("contract_file")
    file = contract.file()
    publish.write_file(file, path, publish.CONTRACT_PARTITIONS, order=publish.CONTRACT_ORDER)
    again = publish.read_file(contract.mart.spark, path, file).filter("LOB = 'GARS' AND excess_policy_ind = 1")
    kept = contract.stage.keep(again, "rewritten_line")  # it may not be read where it is replaced
    publish.write_file(kept, path, publish.CONTRACT_PARTITIONS, "replace", publish.CONTRACT_ORDER)
    return publish.read_file(contract.mart.spark, path, file)


def _shouted(files: dict[str, DataFrame]) -> DataFrame:
    """The prior location file with keys in small letters and trailing blanks."""
    return files["prior"].withColumn("ContractID", F.concat(F.lower("ContractID"), F.lit("  ")))


def _named_terms(mart: Mart) -> DataFrame:
    publish.publish_view(mart["policy_term"], "named_policy_term")
    return named.terms_by(mart.spark, "named_policy_term", "business_unit_cd", "31/12/1998", "dd/MM/yyyy")


def _named_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = publish.publish_snapshots(snapshots_of_testdata(spark, sf_dir, "location"), "location")
    return named.matching_rows(spark, names, "CountryISO", ["CA", "MX"])


def _report(spark: SparkSession, sf_dir: str, kinds: str) -> DataFrame:
    return ct.report_rows(*(snapshots_of_testdata(spark, sf_dir, k) for k in kinds.split()))


def _text_dates(mart: Mart) -> DataFrame:
    """Policies in force a year earlier, by a date given as text."""
    params = RunParams.of_text("31.12.1997", "01.01.2000", "SRC", "%d.%m.%Y")
    return loc.location_pif(mart, params)


def _initial_final(mart: Mart, by_policy: bool) -> DataFrame:
    pif = loc.location_pif(mart, PARAMS)
    stage = Stage.of(mart.spark)
    # Detail and file are run one after the other, each on its own: planned as one query, the
    # tables of both are broadcast, and so held by the driver, at once.
    detail = loc.location_detail(mart, fold_products(pif), PARAMS)
    detail = stage.keep(detail.select("spm", "risk_id"), "initial_rows")
    file = stage.keep(_location_rows(mart).select("ContractID"), "final_rows")
    if by_policy:
        return dq.initial_final_by_policy(detail, file)
    return dq.initial_final(pif, detail, file)


def _files(kind: str, make: Callable[..., DataFrame]) -> Query:
    """A check over the snapshots of one or more kinds of file."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(*(ct.Trimmed(snapshots_of_testdata(spark, sf_dir, k)) for k in kind.split()))

    return query


def _with_reference(table: str, make: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = snapshots_of_testdata(spark, sf_dir, "location")
        current, prior = (ct.trimmed_keys(files[n]) for n in ("current", "prior"))
        return make(current, prior, mart_of_testdata(spark, sf_dir)[table])

    return query


QUERIES: dict[str, Query] = {
    # policies in force
    "in_force_variants": _on_mart(
        lambda m: _counts(
            m["policy_term"], {n: term_in_force(AS_OF, s) for n, s in IN_FORCE_VARIANTS.items()}
        )
    ),
    "alive_variants": _on_mart(_alive_counts),
    "selection_filters": _on_mart(_selection),
    "pif_contract": _contract(lambda c: c.pif),
    "pif_location": _on_mart(_small_pif),
    "pif_numbered": _on_mart(lambda m: number_in_group(_small_pif(m), Stage.of(m.spark))),
    "pif_sample_top5": _on_mart(lambda m: sample_per_group(_small_pif(m))),
    "pif_sample_kept": _on_mart(
        lambda m: sample_per_group(_small_pif(m), keep_ids=KEPT_TERMS, stage=Stage.of(m.spark))
    ),
    "product_listagg": _contract(lambda c: c.folded),
    # contract pipeline
    "policy_id_link": _contract(lambda c: link_policy_id(c.mart, c.folded)),
    "policy_premium": _contract(lambda c: c.premium),
    "excess_layer_pivot": _on_mart(lay.excess_layers),
    "policy_layer_enriched": _contract(lambda c: c.layers),
    "layer_count": _contract(lambda c: lay.layer_count(c.layers)),
    "peril_count": _contract(lambda c: c.perils),
    "risk_count": _contract(lambda c: c.risks),
    "deductible_detail": _contract(lambda c: ded.deductible_detail(c.mart, c.layers, PARAMS)),
    "limit_detail": _contract(lambda c: lim.limit_detail(c.mart, c.layers, PARAMS)),
    "peril_risk_count": _contract(
        lambda c: lim.risk_peril_count(lim.limit_rows(c.mart, c.layers, PARAMS))
    ),
    "limit_groups": _contract(lambda c: lim.limit_groups(lim.limit_rows(c.mart, c.layers, PARAMS))),
    "blanket_limits": _contract(
        lambda c: lim.blanket_limits(
            lim.limit_groups(lim.limit_rows(c.mart, c.layers, PARAMS)), c.risks
        ),
        staged=True,
    ),
    "blanket_by_peril": _contract(lambda c: c.blankets, staged=True),
    "blanket_groups": _contract(lambda c: c.groups, staged=True),
    "deductible_terms": _contract(lambda c: c.terms, staged=True),
    "spread_dedamt": _contract(lambda c: c.spread, staged=True),
    "policy_deductible": _contract(lambda c: c.deductible, staged=True),
    "contract_file": _contract(lambda c: c.file(), staged=True),
    "contract_file_lob": _contract(
        lambda c: c.file(F.col("UDF5").isin("PIMx", "PIMt", "GARS_Condo")), staged=True
    ),
    # location pipeline
    "location_selection": _location(lambda m, f: loc.location_selection(m, f, PARAMS)),
    "location_lob": _location(
        lambda m, f: loc.location_lob(
            loc.location_selection(m, f, PARAMS), F.col("UDF5").isin("ALT", "GARS")
        )
    ),
    "location_detail": _location(lambda m, f: loc.location_detail(m, f, PARAMS)),
    "location_perils": _location(
        lambda m, f: per.risk_perils(loc.location_selection(m, f, PARAMS))
    ),
    "peril_pivot": _location(
        lambda m, f: per.pivot_terms(per.limit_deductible(loc.location_detail(m, f, PARAMS)))
    ),
    "peril_block_fire": _block(1),
    "peril_block_hurricane": _block(2),
    "peril_block_earthquake": _block(3),
    "peril_block_terrorism": _block(4),
    "peril_block_wind": _block(5),
    "location_file": _on_mart(_location_rows),
    "location_file_lob": _on_mart(
        lambda m: loc.location_file(
            m, PARAMS, F.col("UDF5") == "GARS_Condo", stage=Stage.of(m.spark)
        )
    ),
    "location_file_one_structure": _location(_single_structures),
    "location_detail_alive": _location(
        lambda m, f: loc.location_detail(m, f, replace(PARAMS, drop_deleted_perils=True))
    ),
    "policy_premium_direct": _contract(
        lambda c: policy_premium(
            c.mart, link_policy_id(c.mart, c.terms_in_force), replace(PARAMS, direct_premium_only=True)
        )
    ),
    "contract_file_rewritten": _contract(_twice_written, staged=True),
    "pif_text_date": _on_mart(_text_dates),
    "terms_by_parameter": _on_mart(_named_terms),
    # extracts
    "heritage_extract": _on_mart(lambda m: ext.heritage_extract(m, "GARS", "GARS_Condo", AS_OF)),
    "fire_extract": _on_mart(lambda m: ext.fire_extract(m, AS_OF, UNITS, LEFT_OUT)),
    "policy_term_extract": _on_mart(lambda m: ext.policy_term_extract(m, AS_OF, UNITS)),
    **{f"view_{t}": _view(t) for t in schema.VIEWED},
    # control totals
    "ct_contract_counts": _files("contract", lambda c: ct.snapshot_counts(c, "Contract_rec_Count")),
    "ct_location_counts": _files("location", lambda c: ct.snapshot_counts(c, "Location_rec_Count")),
    "ct_building_sum": _files(
        "location",
        lambda c: ct.snapshot_sum(c, "BuildingValue", "Location_sum_Building", "SumBuildingValue"),
    ),
    "ct_deduct_sum": _files(
        "location",
        lambda c: ct.snapshot_sum(c, "DeductBldg", "Location_sum_DeductBldg", "SumDeductBldg"),
    ),
    "ct_loc_drift": _files(
        "location", lambda c: ct.location_count_drift(c["current"], c["prior"])
    ),
    "ct_contract_orphans": _files(
        "contract location", lambda c, l: ct.orphans(c["current"], l["current"], "LocationID")
    ),
    "ct_location_orphans": _files(
        "contract location", lambda c, l: ct.orphans(l["current"], c["current"], "ContractID")
    ),
    "ct_sublimit_perils": _files("contract", lambda c: ct.value_counts(c, "SublimitPerils")),
    "ct_layerid_format": _files(
        "contract", lambda c: ct.format_profile(c["current"], "LayerID", layered=True)
    ),
    "ct_occupancy": _with_reference("occupancy_codes", ct.occupancy_drift),
    "ct_construction": _with_reference("construction_codes", ct.construction_drift),
    "ct_construction_by_country": _with_reference(
        "construction_codes", lambda a, b, r: ct.construction_drift(a, b, r, country_aware=True)
    ),
    "ct_state": _files("location", lambda c: ct.state_totals(c["current"], c["prior"])),
    "ct_state_rollup": _files("location", lambda c: ct.state_rollup(c["current"], c["prior"])),
    "ct_state_rollup_new": _files(
        "location", lambda c: ct.state_rollup(c["current"], c["prior"], label_new=True)
    ),
    "ct_exposure_orphans": _files(
        "reinsurance contract", lambda r, c: ct.orphan_exposures(r["current"], c["current"])
    ),
    "ct_exposureid_format": _files(
        "reinsurance", lambda r: ct.format_profile(r["current"], "ExposureID", layered=False)
    ),
    "ct_contract_orphans_collated": lambda spark, sf_dir: ct.plain_keys(
        ct.orphans(
            ct.collated_keys(snapshots_of_testdata(spark, sf_dir, "contract")["current"]),
            ct.collated_keys(_shouted(snapshots_of_testdata(spark, sf_dir, "location"))),
            "LocationID",
        )
    ),
    "ct_rejected_values": _files("location", lambda c: ct.rejected_values(c, NUMERIC_COLUMNS)),
    "ct_rows_by_parameter": _named_snapshots,
    "ct_report": lambda spark, sf_dir: _report(spark, sf_dir, "contract location"),
    "ct_report_reinsured": lambda spark, sf_dir: _report(spark, sf_dir, "contract location reinsurance"),
    # reconciliations
    "dq_deductible_rows": _contract(dq.deductible_rows, staged=True),
    "dq_count_comparison": _contract(
        lambda c: dq.count_comparison(
            dq.deductible_rows(c), lay.layer_count(c.layers), c.perils, c.risks
        ),
        staged=True,
    ),
    "dq_count_mismatches": _contract(
        lambda c: dq.count_mismatches(
            dq.count_comparison(
                dq.deductible_rows(c), lay.layer_count(c.layers), c.perils, c.risks
            )
        ),
        staged=True,
    ),
    "dq_small_blankets": _contract(lambda c: dq.small_blankets(c.layers, c.groups), staged=True),
    "dq_named_policies": _contract(
        lambda c: dq.blankets_of(c.layers, c.groups, NAMED_TERMS), staged=True
    ),
    "dq_pif_summary": _contract(lambda c: dq.pif_summary(c.pif, c.mart["policy_term"])),
    "dq_initial_final": _on_mart(lambda m: _initial_final(m, by_policy=False)),
    "dq_initial_final_policy": _on_mart(lambda m: _initial_final(m, by_policy=True)),
    "dq_hash_subset": _on_mart(lambda m: dq.staged_subset(_location_rows(m), _staged_hashes(m))),
    "dq_preview": _on_mart(lambda m: ext.preview(ext.policy_term_extract(m, AS_OF, UNITS))),
}
