"""Queries whose tables, columns and predicates are named at run time.

Names go through ``IDENTIFIER`` and values through bound arguments, so nothing is pasted into
the text of a statement.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def terms_by(spark: SparkSession, table: str, column: str, as_of: str, form: str) -> DataFrame:
    """Terms in force per value of a column. The date comes as text with its format."""
    return spark.sql(
        """
        SELECT IDENTIFIER(:column) AS value, count(*) AS terms
        FROM IDENTIFIER(:table)
        WHERE policy_term_effective_dt <= to_date(:as_of, :form)
          AND policy_term_expiration_dt > to_date(:as_of, :form)
        GROUP BY 1
        """,
        args={"table": table, "column": column, "as_of": as_of, "form": form},
    )


def matching_rows(spark: SparkSession, tables: dict[str, str], column: str, values: list[str]) -> DataFrame:
    """Rows of each named table whose column holds one of the values, and all rows."""
    counted = [
        spark.sql(
            """
            SELECT :label AS snapshot, count(*) AS row_count,
              count_if(array_contains(:wanted, IDENTIFIER(:column))) AS matching
            FROM IDENTIFIER(:table)
            """,
            args={"label": label, "table": table, "column": column, "wanted": values},
        )
        for label, table in tables.items()
    ]
    return reduce(DataFrame.union, counted)
