"""Small declarative descriptions the operators take as arguments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Column:
    """One output column of a normalisation: where it comes from, what it is called, its type.

    ``cast=None`` leaves the type as read.
    """

    source: str
    name: str
    cast: str | None = None

    @property
    def lost(self) -> str:
        """The name of the flag "the cast lost a value"."""
        return f"_lost_{self.name}"


@dataclass(frozen=True)
class Rule:
    """A data-quality rule. ``test`` is a SQL predicate; a NULL in any of ``columns`` passes."""

    name: str
    columns: tuple[str, ...]
    test: str

    @property
    def flag(self) -> str:
        return f"is_valid_{self.name}"

    @property
    def code(self) -> str:
        return f"invalid_{self.name}"

    @property
    def passes(self) -> str:
        """SQL text of "this row passes"; never NULL."""
        return " OR ".join([*(f"{c} IS NULL" for c in self.columns), f"({self.test})"])


@dataclass(frozen=True)
class Lookup:
    """A short static lookup: rows of (natural key, description) known in advance."""

    name: str
    natural_key: str
    surrogate_key: str
    description: str
    rows: tuple[tuple[int, str], ...]


@dataclass(frozen=True)
class Calendar:
    """An inclusive range of days."""

    first: dt.date
    last: dt.date

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1

    @property
    def end(self) -> dt.date:
        """The first day after the range."""
        return self.last + dt.timedelta(days=1)


@dataclass(frozen=True)
class Role:
    """A fact column that refers to a dimension: fact.``source`` finds the key stored as ``name``."""

    dimension: str
    source: str
    name: str
