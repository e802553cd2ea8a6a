"""Run parameters. Dates and the clock are always passed in, so runs repeat."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any


@dataclass(frozen=True)
class InForce:
    """Which policy terms count as in force on a date.

    ``expires_on_date_counts``: a term expiring on the date is still in force.
    ``cancellation``: ``"after"`` keeps terms cancelled later than the date,
    ``"on_or_after"`` also those cancelled on it, ``"ignore"`` keeps cancelled terms.
    """

    expires_on_date_counts: bool = False
    cancellation: str = "after"


@dataclass(frozen=True)
class Alive:
    """When a soft-deleted row still counts on a date."""

    on_date_counts: bool = True
    open_counts: bool = True


def read_date(text: str, form: str = "%Y-%m-%d") -> date:
    """A date from text; the form is that of ``datetime.strptime``."""
    return datetime.strptime(text, form).date()


@dataclass(frozen=True)
class RunParams:
    """One run of a file or an extract."""

    as_of: date
    now: datetime
    # Marks values and columns that come from the source system.
    source_tag: str
    # The written-premium join tests the transaction type but keeps every amount;
    # True restricts the sum to direct business instead.
    direct_premium_only: bool = False
    # The location detail never tests the deletion date of a peril; True does.
    drop_deleted_perils: bool = False
    contract_terms: InForce = field(default_factory=InForce)
    location_terms: InForce = field(default_factory=lambda: InForce(cancellation="ignore"))

    @classmethod
    def of_text(cls, as_of: str, now: str, source_tag: str, form: str = "%Y-%m-%d",
                **switches: Any) -> RunParams:
        """Parameters whose dates come as text in one form; the clock stands at midnight."""
        clock = datetime.combine(read_date(now, form), datetime.min.time())
        return cls(read_date(as_of, form), clock, source_tag, **switches)
