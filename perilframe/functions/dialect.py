"""Text, number and null rules the files depend on, as Column expressions.

The source systems treat an empty text as missing when joining texts, compare texts
without their trailing blanks and print numbers without trailing zeros. Spark does
none of that by itself, so every place that needs it calls one of these helpers.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from perilframe.params import Alive, InForce


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text -------------------------------------------------------------------------


def join_text(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as empty; NULL when nothing is left."""
    return F.nullif(F.concat_ws("", *(col_of(p).cast("string") for p in parts)), F.lit(""))


def blank_length(text: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(col_of(text)))


def empty_as_null(text: Column | str) -> Column:
    return F.nullif(col_of(text), F.lit(""))


def layer_text(layer_no: Column | str) -> Column:
    """Layer number on two digits; numbers of three digits lose the last one."""
    return F.lpad(col_of(layer_no).cast("string"), 2, "0")


def plain_number(amount: Column) -> Column:
    """Decimal as text without trailing zeros, never in exponent form.

    The column must be a decimal with at least one decimal place.
    """
    return F.rtrim(F.rtrim(amount.cast("string"), F.lit("0")), F.lit("."))


def percent_text(percent: Column) -> Column:
    """A percentage as a fraction in text: 2.0000 gives 0.02."""
    return plain_number((percent * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,6)"))


def number_or_zero(text: Column | str) -> Column:
    """Numeric text as an exact decimal: blank counts as 0, unreadable text as NULL."""
    trimmed = F.trim(col_of(text))
    return F.when(trimmed == "", F.lit(0).cast("decimal(28,4)")).otherwise(
        trimmed.try_cast("decimal(28,4)")
    )


def readable(text: Column | str) -> Column:
    """Whether a text is blank or a number; NULL for NULL."""
    given = col_of(text)
    return F.when(given.isNotNull(), number_or_zero(given).isNotNull())


def round_up(text: Column | str) -> Column:
    """Smallest whole number not below a numeric text; NULL when it is not a number."""
    return F.ceil(col_of(text).try_cast("decimal(18,4)")).cast("bigint")


# --- keys of the other dialect --------------------------------------------------------

# Compares without regard to case and trailing blanks.
KEY_COLLATION = "UTF8_LCASE_RTRIM"


def as_key(text: Column | str) -> Column:
    """A text that is compared, joined and grouped as the other dialect does: trailing blanks
    and case do not count. What is shown stays as it was."""
    return F.collate(col_of(text), KEY_COLLATION)


def as_text(key: Column | str) -> Column:
    """A key as a plain text again."""
    return F.collate(col_of(key), "UTF8_BINARY")


# --- report formats -----------------------------------------------------------------


def _signed(amount: Column, body: Column) -> Column:
    return F.when(amount < 0, F.concat(F.lit("-"), body)).otherwise(body)


def whole_text(amount: Column) -> Column:
    """1234.5 as ``1,235``, rounding halves away from zero."""
    rounded = F.round(amount.cast("decimal(38,4)"), 0)
    return _signed(rounded, F.format_number(F.abs(rounded), 0))


def money_text(amount: Column) -> Column:
    """1234.5 as ``$1,235``; negative amounts as ``-$1,235``."""
    rounded = F.round(amount.cast("decimal(38,4)"), 0)
    return _signed(rounded, F.concat(F.lit("$"), F.format_number(F.abs(rounded), 0)))


def share_text(share: Column) -> Column:
    """0.12345 as ``12.35 %``."""
    rounded = (share * 100).cast("decimal(28,2)")
    return _signed(rounded, F.concat(F.format_number(F.abs(rounded), 2), F.lit(" %")))


# --- dates ---------------------------------------------------------------------------


def term_in_force(as_of: date, spec: InForce) -> Column:
    """Predicate on policy-term columns: in force on the date."""
    day = F.lit(as_of)
    expires = F.col("policy_term_expiration_dt")
    cancelled = F.col("cancellation_effective_dt")
    predicate = (F.col("policy_term_effective_dt") <= day) & (
        (expires >= day) if spec.expires_on_date_counts else (expires > day)
    )
    if spec.cancellation == "ignore":
        return predicate
    if spec.cancellation not in ("after", "on_or_after"):
        raise ValueError(f"unknown cancellation rule {spec.cancellation!r}")
    later = (cancelled > day) if spec.cancellation == "after" else (cancelled >= day)
    return predicate & (later | cancelled.isNull())


def alive(as_of: date, spec: Alive, deleted: Column | str = "deleted_dt") -> Column:
    """Predicate on a soft-deleted row: still there on the date."""
    when, day = col_of(deleted), F.lit(as_of)
    predicate = (when >= day) if spec.on_date_counts else (when > day)
    return (predicate | when.isNull()) if spec.open_counts else predicate
