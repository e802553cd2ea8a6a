"""Intermediate tables that several later steps read."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DecimalType, StringType, StructType

SHARED_DIR = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"
MOST_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
PACKED = "zstd"


def _bytes(text: str) -> int:
    """A size as Spark's settings give it: 10485760b, 256k, 10MB, -1."""
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def _row_bytes(columns: StructType) -> int:
    """Of a row in memory, about."""
    def more(kind) -> int:
        return 20 if isinstance(kind, StringType) else 8 * (isinstance(kind, DecimalType) and kind.precision > 18)

    return 8 + sum(8 + more(c.dataType) for c in columns)


def too_many_to_broadcast(frame: DataFrame) -> bool:
    """Whether the rows of a staged table take more memory than Spark may broadcast. They are
    counted, which reads no more than the files' footers."""
    return frame.count() * _row_bytes(frame.schema) > _bytes(frame.sparkSession.conf.get(MOST_BROADCAST))


class Stage:
    """Writes intermediate results as Parquet into the cluster's shared checkpoint folder.

    A table read several times is computed once, later steps still prune its columns and
    see its true size, and a lost executor costs a re-read instead of a recomputation.
    Each stage object owns one new subfolder; the folder's retention policy clears it. Files are
    packed with zstd, which takes less disk than the default.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = f"{root.rstrip('/')}/perilframe/{uuid.uuid4().hex}"

    @classmethod
    def of(cls, spark: SparkSession) -> Stage:
        """A stage in the session's shared folder, or in the warehouse, which executors share as
        well, where none is set. The same on every master."""
        return cls(spark, spark.conf.get(SHARED_DIR, None) or spark.conf.get(WAREHOUSE))

    def folder(self, name: str) -> str:
        """Path of a subfolder for files that a run writes itself."""
        return f"{self._root}/{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        frame.write.parquet(path, compression=PACKED)
        return self._spark.read.schema(frame.schema).parquet(path)

    def keep_side(self, frame: DataFrame, name: str) -> DataFrame:
        """The same, for one side of a join. Spark sizes a table by its packed files, and a broadcast
        once planned stays although the rows prove too many; such a side is sorted and merged."""
        kept = self.keep(frame, name)
        return kept.hint("merge") if too_many_to_broadcast(kept) else kept

    def keep_bucketed(self, frame: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """The same, as a table in buckets by ``key``: groupings and joins on it need no shuffle.
        A frame dealt to as many partitions by the same key is one file a bucket."""
        table = f"{name}_{uuid.uuid4().hex}"
        writer = frame.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.options(path=self.folder(name), compression=PACKED).saveAsTable(table)
        return self._spark.table(table)
