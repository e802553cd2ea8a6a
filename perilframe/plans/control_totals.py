"""Control totals: the latest contract and location files against earlier snapshots.

Snapshots come as a mapping of name to DataFrame, so any set of files can be compared.
Every check aggregates each file by its key before anything is joined.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions.dialect import (
    as_key,
    as_text,
    blank_length,
    money_text,
    number_or_zero,
    readable,
    share_text,
    whole_text,
)
from perilframe.functions.fixed import FORMAT_FULL, FORMAT_LAYERED, FORMAT_OTHER, FORMAT_SHORT

Snapshots = Mapping[str, DataFrame]
TOTAL = "TOTAL"
VALUES = ("BuildingValue", "OtherValue", "ContentsValue", "TimeElementValue")
KEY_COLUMNS = ("ContractID", "LocationID", "LayerID", "ExposureID", "SublimitPerils",
               "OccupancyCode", "ConstructionCode", "CountryISO", "Area")


def trimmed_keys(file: DataFrame) -> DataFrame:
    """Files compare keys without trailing blanks; drop those once, on reading."""
    return file.select(
        *(F.rtrim(c).alias(c) if c in KEY_COLUMNS else F.col(c) for c in file.columns)
    )


class Trimmed(Mapping[str, DataFrame]):
    """Snapshots with trimmed keys; only those asked for are read."""

    def __init__(self, snapshots: Snapshots):
        self._snapshots = snapshots

    def __getitem__(self, name: str) -> DataFrame:
        return trimmed_keys(self._snapshots[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self._snapshots)

    def __len__(self) -> int:
        return len(self._snapshots)


def collated_keys(file: DataFrame) -> DataFrame:
    """Files whose keys compare without regard to case and trailing blanks: the keys become
    collated columns, so every join, group and comparison of the checks follows."""
    return file.select(*(as_key(c).alias(c) if c in KEY_COLUMNS else F.col(c) for c in file.columns))


def plain_keys(result: DataFrame) -> DataFrame:
    """A check's result with plain texts again."""
    return result.select(
        *(as_text(c).alias(c) if kind.startswith("string collate") else F.col(c) for c, kind in result.dtypes)
    )


def _stacked(snapshots: Snapshots, make) -> DataFrame:
    parts = [make(frame).withColumn("snapshot", F.lit(name)) for name, frame in snapshots.items()]
    return reduce(DataFrame.unionByName, parts)


# --- counts and sums -------------------------------------------------------------------


def snapshot_counts(snapshots: Snapshots, label: str) -> DataFrame:
    """Rows per snapshot; an empty file counts 0."""
    counted = _stacked(snapshots, lambda f: f.agg(F.count(F.lit(1)).alias("rec_Count")))
    return counted.select(F.col("snapshot").alias(label), "rec_Count")


def snapshot_sum(snapshots: Snapshots, column: str, label: str, total: str) -> DataFrame:
    """Sum of a numeric text per snapshot, added exactly and shown as a double."""
    added = F.sum(number_or_zero(column)).cast("double").alias(total)
    return _stacked(snapshots, lambda f: f.agg(added)).select(
        F.col("snapshot").alias(label), total
    )


def rejected_values(snapshots: Snapshots, columns: tuple[str, ...]) -> DataFrame:
    """Per snapshot and numeric text column: rows, missing, blank and unreadable values, and
    the sum of the others. One pass over each snapshot, whatever the number of columns."""

    def counted(file: DataFrame) -> DataFrame:
        cells = []
        for c in columns:
            text = F.col(c)
            cells += [
                F.count_if(text.isNull()).alias(f"{c}_missing"),
                F.count_if(F.trim(text) == "").alias(f"{c}_blank"),
                F.count_if(~readable(text)).alias(f"{c}_rejected"),
                F.sum(number_or_zero(text)).cast("double").alias(f"{c}_total"),
            ]
        found = file.agg(F.count(F.lit(1)).alias("rows"), *cells)
        rows = (
            F.struct(
                F.lit(c).alias("column_name"), F.col("rows").alias("row_count"),
                *(F.col(f"{c}_{k}").alias(k) for k in ("missing", "blank", "rejected", "total")),
            )
            for c in columns
        )
        return found.select(F.inline(F.array(*rows)))

    return _stacked(snapshots, counted)


def value_counts(snapshots: Snapshots, column: str) -> DataFrame:
    """Count of each non-blank value per snapshot."""

    def counted(file: DataFrame) -> DataFrame:
        kept = file.filter(F.col(column).isNotNull() & (F.rtrim(column) != ""))
        return kept.groupBy(column).agg(F.count(column).alias("Counts"))

    return (
        _stacked(snapshots, counted)
        .select(F.col("snapshot").alias("db"), column, "Counts")
        .orderBy(column, "db")
    )


# --- contracts and their locations ------------------------------------------------------


def short_policy(contract: Column) -> Column:
    """Policy number inside a contract id: after the symbol of a full id, else its start."""
    length = blank_length(contract)
    return F.when(length == 12, F.substring(contract, 4, 7)).when(
        length != 12, F.left(contract, F.lit(7))
    )


def location_count_drift(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Locations per contract now and before, for contracts sharing a policy number.

    Both files are reduced to one row per contract first. What a policy number then pairs
    are its contracts, and all pairs are the result.
    """

    def per_contract(file: DataFrame, side: str) -> DataFrame:
        return file.groupBy("ContractID").agg(
            F.countDistinct("LocationID").alias(f"{side}_loccount")
        ).select(
            short_policy(F.col("ContractID")).alias("POL"),
            F.col("ContractID").alias(f"{side}contractid"),
            f"{side}_loccount",
        )

    return (
        per_contract(current, "Current")
        .join(per_contract(prior, "Prior"), "POL")
        .select(
            "Priorcontractid",
            "Prior_loccount",
            "Currentcontractid",
            "Current_loccount",
            (F.col("Prior_loccount") - F.col("Current_loccount")).alias("Diff"),
        )
        .orderBy(F.desc("Diff"), "Priorcontractid", "Currentcontractid")
    )


def orphans(left: DataFrame, right: DataFrame, counted: str) -> DataFrame:
    """Contract ids of ``left`` for which ``right`` holds no value in ``counted``.

    A match whose counted value is NULL still counts 0, so this is not quite an anti join.
    Both sides are reduced to one row per contract before they meet.
    """
    keys = left.select("ContractID").distinct()
    matches = (
        right.groupBy(F.col("ContractID").alias("matched"))
        .agg(F.count(counted).alias("found"))
        .filter(F.col("found") > 0)
    )
    return keys.join(matches, F.col("ContractID") == F.col("matched"), "left_anti").select(
        "ContractID", F.lit(0).cast("bigint").alias(f"{counted}_count")
    )


# --- formats ----------------------------------------------------------------------------


def id_format(column: str, layered: bool) -> Column:
    """Format class of a layer or exposure id; only layers know the 15-character form."""
    dash, length = F.locate("-", F.col(column), 1), blank_length(column)
    found = F.when((dash == 8) & (length == 10), FORMAT_SHORT)
    if layered:
        found = found.when((dash == 13) & (length == 15), FORMAT_LAYERED)
    return found.when(length == 12, FORMAT_FULL).otherwise(FORMAT_OTHER)


def format_profile(file: DataFrame, column: str, layered: bool) -> DataFrame:
    return file.groupBy(id_format(column, layered).alias(f"{column}_Format")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(column).alias("Sample")
    )


# --- code drift -------------------------------------------------------------------------


def _code_counts(file: DataFrame, code: str, name: str, rows: bool) -> DataFrame:
    """Rows per code. NULL codes never join, so they are not carried along."""
    counted = F.count(F.lit(1)) if rows else F.count(code)
    return file.filter(F.col(code).isNotNull()).groupBy(F.col(code).alias(f"{name}_code")).agg(
        counted.alias(name)
    )


def _with_total(table: DataFrame, key: str, blanks: tuple[str, ...], sums: tuple[str, ...]) -> DataFrame:
    """Add a row of sums, then drop duplicate rows as a plain union does."""
    total = table.agg(*(F.sum(c).cast("bigint").alias(c) for c in sums)).select(
        F.lit(TOTAL).alias(key), *(F.lit("").alias(b) for b in blanks), *sums
    )
    return table.union(total.select(*table.columns)).distinct()


def _drift(codes: DataFrame, current: DataFrame, prior: DataFrame, reference: DataFrame,
           match: Column, code: str, texts: tuple[str, ...], counts: tuple[str, str]) -> DataFrame:
    now, before = counts
    joined = (
        codes.join(current, F.col(code) == F.col(f"{now}_code"), "left")
        .join(prior, F.col(code) == F.col(f"{before}_code"), "left")
        .join(reference, match, "left")
    )
    summed = joined.groupBy(code, *texts).agg(
        F.sum(now).cast("bigint").alias(now), F.sum(before).cast("bigint").alias(before)
    )
    diff = F.coalesce(now, F.lit(0)) - F.coalesce(before, F.lit(0))
    return _with_total(summed.withColumn("diff", diff), code, texts, (now, before, "diff"))


def occupancy_drift(current: DataFrame, prior: DataFrame, reference: DataFrame,
                    region: str = "US") -> DataFrame:
    """Occupancy codes of both files with counts, description and difference."""
    code = "OccupancyCode"
    codes = current.select(code).union(prior.select(code)).distinct()
    described = reference.filter(F.col("region") == region).select(
        F.col("code").alias("ref_code"), F.col("description").alias("AIROccupancy")
    )
    return _drift(
        codes,
        _code_counts(current, code, "CurrentCount", rows=False),
        _code_counts(prior, code, "PriorCount", rows=False),
        described,
        F.col(code) == F.col("ref_code"),
        code,
        ("AIROccupancy",),
        ("CurrentCount", "PriorCount"),
    ).orderBy(F.desc("diff"))


def construction_drift(current: DataFrame, prior: DataFrame, reference: DataFrame,
                       country_aware: bool = False) -> DataFrame:
    """Construction codes of both files with counts, description and difference.

    Codes are listed per country but counted over all of them, so a code used in several
    countries without a description adds its count several times. ``country_aware`` counts
    per country instead.
    """
    code, names = "ConstructionCode", ("CurrentCounts", "PriorCounts")
    keys = [code, "CountryISO"]
    codes = current.select(*keys).union(prior.select(*keys)).distinct()
    described = reference.select(
        F.col("code").alias("ref_code"),
        F.col("region").alias("ref_region"),
        F.col("category").alias("AIRConstructionCategory"),
        F.col("description").alias("AIRConstruction"),
    )
    match = (F.col(code) == F.col("ref_code")) & (F.col("CountryISO") == F.col("ref_region"))
    texts = ("AIRConstructionCategory", "AIRConstruction")
    if not country_aware:
        counted = [
            _code_counts(f, code, n, rows=True) for f, n in zip((current, prior), names)
        ]
        return _drift(codes, *counted, described, match, code, texts, names)
    for file, name in zip((current, prior), names):
        counted = file.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        codes = codes.join(counted, keys, "left")
    summed = codes.join(described, match, "left").groupBy(code, *texts).agg(
        *(F.sum(n).cast("bigint").alias(n) for n in names)
    )
    diff = F.coalesce(names[0], F.lit(0)) - F.coalesce(names[1], F.lit(0))
    return _with_total(summed.withColumn("diff", diff), code, texts, (*names, "diff"))


# --- states -----------------------------------------------------------------------------


def insured_value() -> Column:
    """Total insured value of a location; one missing value makes it unknown."""
    return sum((number_or_zero(v) for v in VALUES[1:]), number_or_zero(VALUES[0]))


def state_sums(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Value and locations per state of the current file beside those of the prior one.
    States the current file lost are not shown."""

    def per_state(file: DataFrame, side: str) -> DataFrame:
        return file.groupBy(F.col("Area").alias(f"{side}_state")).agg(
            F.sum(insured_value()).cast("decimal(38,4)").alias(f"{side}_tiv"),
            F.count("LocationID").alias(f"{side}_locs"),
        )

    now, before = per_state(current, "current"), per_state(prior, "prior")
    return now.join(before, F.col("current_state") == F.col("prior_state"), "left")


def state_changes(sums: DataFrame) -> DataFrame:
    """Plain numbers of the state report."""

    def share(change: Column, base: Column) -> Column:
        return F.try_divide(change.cast("double"), base.cast("double"))

    value = F.col("current_tiv") - F.col("prior_tiv")
    places = F.col("current_locs") - F.col("prior_locs")
    return (
        sums.withColumn("tiv_change", value)
        .withColumn("tiv_share", share(value, F.col("prior_tiv")))
        .withColumn("loc_change", places)
        .withColumn("loc_share", share(places, F.col("prior_locs")))
    )


def state_report(changes: DataFrame) -> DataFrame:
    """The state report as printed."""
    return changes.select(
        "State",
        money_text(F.col("current_tiv")).alias("Current_TIV"),
        money_text(F.col("prior_tiv")).alias("Prior_TIV"),
        money_text(F.col("tiv_change")).alias("TIV_Change"),
        share_text(F.col("tiv_share")).alias("TIV % Change"),
        whole_text(F.col("current_locs")).alias("Current_Locs"),
        whole_text(F.col("prior_locs")).alias("Prior_Locs"),
        whole_text(F.col("loc_change")).alias("Loc_Change"),
        share_text(F.col("loc_share")).alias("Loc % Change"),
    )


def state_totals(current: DataFrame, prior: DataFrame) -> DataFrame:
    """State report. The state shown is the prior file's, so a new state has none."""
    sums = state_sums(current, prior).withColumn("State", F.col("prior_state"))
    return state_report(state_changes(sums))


def state_rollup(current: DataFrame, prior: DataFrame, label_new: bool = False) -> DataFrame:
    """State report with a grand total.

    States new in the current file have no prior name: they fold into one row, which is
    labelled like the grand total unless ``label_new`` tells the two apart.
    """
    rolled = (
        state_sums(current, prior)
        .rollup("prior_state")
        .agg(
            F.grouping("prior_state").alias("is_total"),
            *(
                F.sum(c).cast(t).alias(c)
                for c, t in (("current_tiv", "decimal(38,4)"), ("prior_tiv", "decimal(38,4)"),
                             ("current_locs", "bigint"), ("prior_locs", "bigint"))
            ),
        )
    )
    fallback = F.when(F.col("is_total") == 1, TOTAL).otherwise("(new)") if label_new else F.lit(TOTAL)
    return state_report(
        state_changes(rolled.withColumn("State", F.coalesce("prior_state", fallback)))
    )


# --- reinsurance ------------------------------------------------------------------------


def orphan_exposures(reinsurance: DataFrame, contract: DataFrame) -> DataFrame:
    """Reinsured exposures without a contract layer, or on a layer without contract id.

    The contract file is reduced to one row per layer first: whether it exists and how many
    of its rows lack a contract id, each of which is one result row.
    """
    layers = contract.groupBy("LayerID").agg(
        F.count_if(F.col("ContractID").isNull()).cast("int").alias("nameless")
    )
    matched = reinsurance.alias("r").join(
        layers.alias("c"), F.col("r.ExposureID") == F.col("c.LayerID"), "left"
    )
    rows = F.when(F.col("c.LayerID").isNull(), 1).otherwise(F.col("c.nameless"))
    return (
        matched.withColumn("rows", rows)
        .filter(F.col("rows") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        .select(
            F.col("r.ContractID").alias("ContractID"),
            F.lit(None).cast("string").alias("Contract_ContractID"),
            F.col("r.ExposureID").alias("ExposureID"),
            F.col("c.LayerID").alias("LayerID"),
        )
    )


# --- the report as rows ----------------------------------------------------------------

# Check by file and key column; the first of each file counts its rows.
REPORT_KEYS = {
    "contract": ("LayerFormat", "SublimitPerils"),
    "location": ("OccupancyCode", "ConstructionCode", "Area"),
    "reinsurance": ("ExposureFormat",),
}


def report_rows(contract: Snapshots, location: Snapshots, reinsurance: Snapshots | None = None
                ) -> DataFrame:
    """Counts and sums of all snapshots as rows (check, snapshot, key, row_count,
    building_value, deductible); the checks of a reinsurance file if there is one.

    All files are stacked as a few narrow columns, each snapshot is read once, and one grouped
    pass with a grouping set per check counts them; contracts are reduced to one row per
    snapshot and id in the same pass before those without a counterpart are counted.
    """
    files = {"contract": contract, "location": location, "reinsurance": reinsurance or {}}
    parts = [
        _report_columns(kind, name, trimmed_keys(file))
        for kind, snapshots in files.items() for name, file in snapshots.items()
    ]
    keys = [k for kind in files for k in REPORT_KEYS[kind]]
    sets = [["kind", "snapshot"], ["snapshot", "ContractID"], *(["kind", "snapshot", k] for k in keys)]
    grouped = (
        reduce(DataFrame.unionByName, parts)
        .groupingSets([[F.col(c) for c in s] for s in sets], "kind", "snapshot", "ContractID", *keys)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("kind_") == "contract").alias("contracts"),
            F.count_if(F.col("located")).alias("places"),
            F.count_if(F.col("kind_") == "location").alias("locations"),
            F.sum("building").alias("building"), F.sum("deduct").alias("deduct"),
            *(F.grouping(c).alias(f"no_{c}") for c in ("kind", *keys)),
        )
    )
    check = F.when(F.col("no_kind") == 1, F.when((F.col("contracts") > 0) & (F.col("places") == 0),
                                                 "contracts without locations")
                   .when((F.col("locations") > 0) & (F.col("contracts") == 0), "locations without contract"))
    shown = F.lit(None).cast("string")
    for kind, own in REPORT_KEYS.items():
        for k in own:
            here = F.col(f"no_{k}") == 0
            check = check.when(here, F.when(F.col("kind") == kind, f"{kind} {k}"))
            shown = F.when(here, F.col(k)).otherwise(shown)
    check = check.otherwise(F.concat("kind", F.lit(" rows")))
    by_contract = F.col("no_kind") == 1
    return (
        grouped.withColumn("check", check)
        .filter(F.col("check").isNotNull() & (~by_contract | F.col("ContractID").isNotNull()))
        .select(
            "check", "snapshot", shown.alias("key"),
            F.when(by_contract, 1).otherwise(F.col("rows")).alias("rows"),
            F.when(~by_contract, F.col("building")).alias("building"),
            F.when(~by_contract, F.col("deduct")).alias("deduct"),
        )
        .groupBy("check", "snapshot", "key")
        .agg(
            F.sum("rows").alias("row_count"), F.sum("building").cast("double").alias("building_value"),
            F.sum("deduct").cast("double").alias("deductible"),
        )
    )


def _report_columns(kind: str, snapshot: str, file: DataFrame) -> DataFrame:
    """The narrow columns of one file; those of other files are NULL."""
    none, amount = F.lit(None).cast("string"), F.lit(None).cast("decimal(28,4)")
    found: dict[str, Column] = {
        "contract": {
            "LayerFormat": id_format("LayerID", layered=True),
            "SublimitPerils": F.nullif(F.col("SublimitPerils"), F.lit("")),
        },
        "location": {
            "building": number_or_zero("BuildingValue"), "deduct": number_or_zero("DeductBldg"),
            "located": F.col("LocationID").isNotNull(),
            **{k: F.col(k) for k in REPORT_KEYS["location"]},
        },
        "reinsurance": {"ExposureFormat": id_format("ExposureID", layered=False)},
    }[kind]
    names = {k: none for own in REPORT_KEYS.values() for k in own}
    names |= {"building": amount, "deduct": amount, "located": F.lit(False)} | found
    return file.select(
        F.lit(kind).alias("kind"), F.lit(kind).alias("kind_"), F.lit(snapshot).alias("snapshot"),
        "ContractID", *(column.alias(name) for name, column in names.items()),
    )


# --- the whole report ----------------------------------------------------------------------


def report(contract: Snapshots, location: Snapshots, occupancy: DataFrame,
           construction: DataFrame, reinsurance: DataFrame | None = None,
           rollup: bool = False, current: str = "current", prior: str = "prior"
           ) -> dict[str, DataFrame]:
    """All checks by heading. The reinsurance checks need a reinsurance file."""
    contract = {n: trimmed_keys(f) for n, f in contract.items()}
    location = {n: trimmed_keys(f) for n, f in location.items()}
    con, loc, old = contract[current], location[current], location[prior]
    checks = {
        "Record counts, contract": snapshot_counts(contract, "Contract_rec_Count"),
        "Record counts, location": snapshot_counts(location, "Location_rec_Count"),
        "Building value": snapshot_sum(
            location, "BuildingValue", "Location_sum_Building", "SumBuildingValue"
        ),
        "Building deductible": snapshot_sum(
            location, "DeductBldg", "Location_sum_DeductBldg", "SumDeductBldg"
        ),
        "Location counts by policy": location_count_drift(loc, old),
        "Contracts without locations": orphans(con, loc, "LocationID"),
        "Locations without contract": orphans(loc, con, "ContractID"),
        "Sublimit perils": value_counts(contract, "SublimitPerils"),
        "Layer id formats": format_profile(con, "LayerID", layered=True),
        "Occupancy codes": occupancy_drift(loc, old, occupancy),
        "Construction codes": construction_drift(loc, old, construction),
        "State totals": state_rollup(loc, old) if rollup else state_totals(loc, old),
    }
    if reinsurance is not None:
        ceded = trimmed_keys(reinsurance)
        checks["Exposures without layer"] = orphan_exposures(ceded, con)
        checks["Exposure id formats"] = format_profile(ceded, "ExposureID", layered=False)
    return checks
