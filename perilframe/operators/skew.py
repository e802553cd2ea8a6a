"""Joins on keys that may be missing or hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Share of all rows from which a key is heavy, so that there are a thousand heavy keys at
# most; rows it must hold besides; and the partitions its rows are dealt to.
HEAVY_SHARE, HEAVY_ROWS, SALTS = 0.001, 10_000, 64


def heavy_keys(frame: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE,
               rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``share`` of the rows and more than ``rows`` rows. Counting has a
    map-side pass, and the result has 1 / share rows at most. NULL is no key."""
    counts = frame.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    total = F.coalesce(counts.agg(F.sum("rows")).scalar(), F.lit(0))
    return counts.filter((F.col("rows") > rows) & (F.col("rows") > share * total)).select(*keys)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                heavy: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """Equi-join on ``keys`` (inner, left or left_semi) whose partitions do not follow the keys.

    Rows of ``left`` with a heavy key are dealt to ``salts`` partitions by a hash of the whole
    row, and the rows of ``right`` with that key are repeated once for each. Rows of ``left``
    without a key match nothing: they bypass the shuffle, and a left join returns them as they
    are. Rows that are equal in all columns are dealt alike, so aggregate such rows first.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"no salted join of kind {how}")
    keys = list(keys)
    missing = reduce(or_, (F.col(k).isNull() for k in keys))
    found = heavy_keys(left, keys) if heavy is None else heavy.select(*keys)
    # Bounded by heavy_keys, whatever the size of the data.
    marks = F.broadcast(found.withColumn("_heavy", F.lit(True)))
    dealt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted = left.filter(~missing).join(marks, keys, "left").select(
        *left.columns, F.when(F.col("_heavy"), dealt).otherwise(0).alias("_salt")
    )
    repeated = right.join(marks, keys, "left").select(
        *right.columns,
        F.explode(F.when(F.col("_heavy"), every).otherwise(F.array(F.lit(0)))).alias("_salt"),
    )
    joined = salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
    if how != "left":
        return joined
    added = [f for f in right.schema if f.name not in keys]
    bare = left.filter(missing).select(
        *left.columns, *(F.lit(None).cast(f.dataType).alias(f.name) for f in added)
    )
    return joined.unionByName(bare)
