"""Mart access: one lazily built DataFrame per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe import schema
from perilframe.functions.fixed import CONSTRUCTION_NUMBERS


NO_NAMES: Mapping[str, str] = {}


@dataclass(frozen=True)
class JdbcTable:
    """How one table of a database is read.

    ``bounds`` (lowest, highest) of a numeric ``key`` (the table's own key unless named) reads
    it in ``partitions`` ranges of equal width. ``borders`` of a key of any type reads it in
    ranges between them, below the first, from the last on, and the rows without key.
    """

    name: str | None = None
    key: str | None = None
    bounds: tuple[int, int] | None = None
    partitions: int = 1
    borders: tuple[str, ...] = ()
    fetch: int | None = None

    def options(self, table: str, prefix: str = "") -> dict[str, str]:
        out = {"dbtable": f"{prefix}{self.name or table}"}
        if self.fetch:
            out["fetchsize"] = str(self.fetch)
        if self.bounds:
            key = self.key or schema.columns(table)[0]
            if schema.column_type(key) not in ("bigint", "int", "date", "timestamp"):
                raise ValueError(f"{table}.{key} is no number or date; give borders instead of bounds")
            low, high = self.bounds
            out |= {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(self.partitions)}
        return out

    def predicates(self) -> list[str]:
        """Conditions that every row meets one of."""
        if not self.borders:
            return []
        if not self.key or self.bounds:
            raise ValueError("borders need a key, and no bounds")
        marks = ["'" + b.replace("'", "''") + "'" for b in self.borders]
        if any(not a < b for a, b in zip(self.borders, self.borders[1:])):
            raise ValueError("borders must rise")
        between = (f"{self.key} >= {a} AND {self.key} < {b}" for a, b in zip(marks, marks[1:]))
        return [f"{self.key} < {marks[0]} OR {self.key} IS NULL", *between, f"{self.key} >= {marks[-1]}"]


class Mart:
    """Named tables. A table is built on first use, so a query only plans what it reads."""

    def __init__(self, spark: SparkSession, build: Callable[[str], DataFrame]):
        self.spark = spark
        self._build = build
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self._build(table)
        return self._tables[table]

    def within(self, terms: DataFrame) -> Mart:
        """The same mart for some policy terms (column ``policy_term_id``): every table that
        holds that key keeps the rows of these terms only, before anything is aggregated."""
        keys = terms.select("policy_term_id")

        def build(table: str) -> DataFrame:
            if "policy_term_id" in schema.columns(table):
                return self[table].join(keys, "policy_term_id", "left_semi")
            return self[table]

        return Mart(self.spark, build)

    def holding(self, risks: DataFrame) -> Mart:
        """The same mart for some risks (column ``risk_id``): the table of risks keeps the rows of
        these only. They are told by the id that structures and perils join by, so where these lie
        together only the rows kept are moved to their terms."""
        ids = risks.select("risk_id")

        def build(table: str) -> DataFrame:
            return self[table].join(ids, "risk_id", "left_semi") if table == "risk" else self[table]

        return Mart(self.spark, build)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: Mapping[str, str] = NO_NAMES) -> Mart:
        """One Parquet folder per table under ``root``; ``names`` gives those called otherwise."""
        return cls(
            spark,
            lambda t: spark.read.schema(schema.struct(t)).parquet(f"{root}/{names.get(t, t)}"),
        )

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, sources: Mapping[str, JdbcTable] | None = None,
                  prefix: str = "", **options: str) -> Mart:
        """Tables of a database. ``sources`` says how single tables are called and read; the
        others are called as the mart calls them and read by one task. Only the columns of the
        mart are asked for."""

        def build(table: str) -> DataFrame:
            source = (sources or {}).get(table, JdbcTable())
            wanted = schema.struct(table)
            read = {"url": url, **options, **source.options(table, prefix)}
            ranges = source.predicates()
            if ranges:
                name = read.pop("dbtable")
                frame = spark.read.jdbc(read.pop("url"), name, predicates=ranges, properties=read)
            else:
                frame = spark.read.format("jdbc").options(**read).load()
            return frame.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))

        return cls(spark, build)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> Mart:
        """Given DataFrames; columns they lack are read as NULL."""

        def build(table: str) -> DataFrame:
            frame = frames.get(table)
            if frame is None:
                return spark.createDataFrame([], schema.struct(table))
            present = {c.lower() for c in frame.columns}
            return frame.select(
                *(
                    (F.col(c) if c in present else F.lit(None))
                    .cast(schema.column_type(c))
                    .alias(c)
                    for c in schema.columns(table)
                )
            )

        return cls(spark, build)


def construction_numbers(spark: SparkSession) -> DataFrame:
    """The short construction list as a table; its size is fixed."""
    rows = [(text, number) for text, number in CONSTRUCTION_NUMBERS.items()]
    return spark.createDataFrame(rows, "construction_desc string, construction_no int")


def view(mart: Mart, table: str) -> DataFrame:
    """Reader's view of a table: without its own key and the audit times."""
    if table not in schema.VIEWED:
        raise ValueError(f"no view on {table}")
    hidden = {schema.columns(table)[0], "create_ts", "update_ts"}
    shown = [c for c in schema.columns(table) if c not in hidden]
    if table == "location":
        at = shown.index("longitude_cd")
        shown[at : at + 2] = ["latitude_cd", "longitude_cd"]
    renamed = {s: s.replace("_address_", "_addr_") for s in schema.STREETS}
    return mart[table].select(*(F.col(c).alias(renamed.get(c, c)) for c in shown))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated list of table and column names."""
    return spark.read.csv(
        path, sep="\t", header=True, schema="table_name string, column_name string"
    )


def missing_columns(catalogue: DataFrame, spark: SparkSession) -> DataFrame:
    """Columns the engine reads that a catalogue does not list."""
    wanted = spark.createDataFrame(
        [(t, c) for t, cs in schema.TABLES.items() for c in cs],
        "table_name string, column_name string",
    )
    listed = catalogue.select(
        F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")
    )
    return wanted.join(listed, ["table_name", "column_name"], "left_anti")
