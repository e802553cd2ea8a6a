"""Where results go: files for import, named views, snapshots and a bucketed mart."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from perilframe.sources.mart import Mart

CONTRACT_PARTITIONS = ("ModPeriod", "LOB")
LOCATION_PARTITIONS = ("mod_period", "LOB")
# Key each big mart table is bucketed by, so that joins on it need no shuffle.
BUCKET_KEYS = {
    "risk": "risk_id",
    "risk_property_structure": "risk_id",
    "covered_property_structure": "risk_id",
    "risk_peril_product": "risk_id",
    "limit_property_structure": "risk_peril_product_id",
    "deductible_property_structure": "risk_peril_product_id",
    "policy_term": "policy_term_id",
}


# Order of the rows inside a file.
CONTRACT_ORDER = ("ContractID", "LayerID")
LOCATION_ORDER = ("ContractID", "LocationName")


def write_file(file: DataFrame, path: str, partitions: Iterable[str], mode: str = "error",
               order: Iterable[str] = ()) -> None:
    """Write a file as Parquet, one folder per period and line of business.

    Rows are rebalanced on the partition columns first: small lines end in one file each,
    and adaptive execution splits a line that holds much of the rows over several tasks.
    ``order`` sorts the rows of every file written. Mode ``replace`` puts the periods and
    lines of this file in the place of those already there and leaves all others alone, so
    that a run may be repeated.
    """
    columns, ordered = tuple(partitions), tuple(order)
    dealt = file.hint("rebalance", *columns)
    if ordered:
        dealt = dealt.sortWithinPartitions(*columns, *ordered)
    writer = dealt.write.partitionBy(*columns)
    if mode == "replace":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).parquet(path)


def read_file(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A written file with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*(f"`{c}`" for c in like.columns))


def write_csv(file: DataFrame, path: str, mode: str = "error") -> None:
    """Write a file as text with a heading line, for import tools."""
    file.write.mode(mode).option("header", True).csv(path)


def publish_view(file: DataFrame, name: str) -> None:
    file.createOrReplaceTempView(name)


def publish_snapshots(snapshots: dict[str, DataFrame], kind: str) -> dict[str, str]:
    """Register every snapshot as a view of its own; the names, by snapshot."""
    names = {name: f"{kind}_{name}" for name in snapshots}
    for name, view in names.items():
        publish_view(snapshots[name], view)
    return names


def write_snapshot(file: DataFrame, root: str, snapshot: str, mode: str = "error") -> None:
    """Keep a file as one snapshot, to be compared with later ones."""
    file.write.mode(mode).parquet(f"{root}/snapshot={snapshot}")


def read_snapshots(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Snapshots by name; each reads only its own folder."""
    return {n: spark.read.parquet(f"{root}/snapshot={n}") for n in names}


def write_bucketed(mart: Mart, database: str, buckets: int, tables: Iterable[str] = ()) -> None:
    """Store mart tables bucketed and sorted by their join keys."""
    for table in tables or BUCKET_KEYS:
        key = BUCKET_KEYS[table]
        # One task writes one bucket. The keys are the tables' own or their parent's surrogate
        # keys; tables grouped by term (excess, ceded rows) are left out, as one term may
        # hold very many of them.
        mart[table].repartition(buckets, key).write.mode("overwrite").bucketBy(
            buckets, key
        ).sortBy(key).saveAsTable(f"{database}.{table}")


def bucketed_mart(spark: SparkSession, database: str, other: Mart) -> Mart:
    """Mart reading the bucketed tables, and ``other`` for the rest."""
    return Mart(
        spark, lambda t: spark.table(f"{database}.{t}") if t in BUCKET_KEYS else other[t]
    )
