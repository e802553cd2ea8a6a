"""Which columns a caller's predicate asks for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def asks_only_for(predicate: Column, frame: DataFrame, without: Iterable[str] = ()) -> bool:
    """Whether the predicate can be told from the columns of ``frame`` that are not left out.

    It is tried on an empty table of these columns: on the frame itself, columns that an
    earlier step dropped would be found as well.
    """
    hidden = set(without)
    fields = [f for f in frame.schema if f.name not in hidden]
    try:
        frame.sparkSession.createDataFrame([], T.StructType(fields)).filter(predicate)
    except AnalysisException:
        return False
    return True
