"""Filter context: which rows a measure sees, column by column."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermart.plans.star import PARTITION, Star
from rostermart.schemas import DIMENSIONS, FACT, KEY_OF

# Which dimension holds a column; fact columns are looked up first.
HOME = {c: dim for dim, columns in DIMENSIONS.items() for c in columns if c not in KEY_OF.values()}
DEMOGRAPHICS = ("gender", "ethnicity", "age_group")


@dataclass(frozen=True)
class Condition:
    column: str
    values: tuple = ()
    low: object = None
    high: object = None

    def test(self) -> Column:
        """True where the row fits; null counts as false, and a plain comparison reaches the scan."""
        if self.values:
            return F.col(self.column).isin(*self.values)
        bounds = []
        if self.low is not None:
            bounds.append(F.col(self.column) >= F.lit(self.low))
        if self.high is not None:
            bounds.append(F.col(self.column) <= F.lit(self.high))
        return reduce(Column.__and__, bounds, F.lit(True))


@dataclass(frozen=True)
class FilterContext:
    """An immutable set of conditions on fact and dimension columns."""

    conditions: tuple[Condition, ...] = ()

    def where(self, **values) -> FilterContext:
        """Add ``column=value`` or ``column=[values]`` (in-list) conditions."""
        added = [Condition(c, tuple(v) if isinstance(v, list | tuple | set) else (v,))
                 for c, v in values.items()]
        for condition in added:
            _home(condition.column)
            if not condition.values:
                raise ValueError(f"No values for {condition.column}")
        return FilterContext(self.conditions + tuple(added))

    def between(self, column: str, low=None, high=None) -> FilterContext:
        """Add a closed range; None leaves that side open."""
        _home(column)
        return FilterContext((*self.conditions, Condition(column, low=low, high=high)))

    def without(self, columns: Iterable[str]) -> FilterContext:
        """Drop the conditions on ``columns``."""
        gone = set(columns)
        return FilterContext(tuple(c for c in self.conditions if c.column not in gone))

    def only(self, columns: Iterable[str]) -> FilterContext:
        kept = set(columns)
        return FilterContext(tuple(c for c in self.conditions if c.column in kept))

    def without_table(self, dim: str, but: Iterable[str] = ()) -> FilterContext:
        """Drop the conditions on a whole dimension except those on ``but``."""
        spared = set(but)
        return FilterContext(tuple(c for c in self.conditions
                                   if _home(c.column) != dim or c.column in spared))

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(c.column for c in self.conditions))

    def test(self) -> Column:
        return reduce(Column.__and__, [c.test() for c in self.conditions], F.lit(True))


def _home(column: str) -> str | None:
    """The dimension of a column, None for the fact."""
    if column in FACT:
        return None
    if column not in HOME:
        raise ValueError(f"No such column in the star: {column}")
    return HOME[column]


def day_number(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def rows_in_context(star: Star, columns: Iterable[str], context: FilterContext,
                    tests_later: Iterable[str] = ()) -> DataFrame:
    """Facts joined with the dimensions that ``columns`` and ``context`` name, filtered.

    Ranges of days become ranges on the fact's date key and year folder, which
    prune files without a join; conditions on the year prune folders too. ``tests_later`` columns are joined but
    their conditions are left to the caller.
    """
    later = set(tests_later)
    now = context.without(later)
    fact = star.fact
    for c in now.conditions:
        if c.column == "full_date" and not c.values:
            if c.low is not None:
                fact = fact.where((F.col("date_key") >= day_number(c.low)) & (F.col(PARTITION) >= c.low.year))
            if c.high is not None:
                fact = fact.where((F.col("date_key") <= day_number(c.high)) & (F.col(PARTITION) <= c.high.year))
        if c.column == "year":
            fact = fact.where(replace(c, column=PARTITION).test())
    needed: dict[str, list[str]] = {}
    # Ranges of days are done; any other condition, also one on the day, is still to be tested.
    rest = FilterContext(tuple(c for c in now.conditions if c.column != "full_date" or c.values))
    for column in dict.fromkeys([*columns, *rest.columns, *later]):
        home = _home(column)
        if home and column not in needed.setdefault(home, []):
            needed[home].append(column)
    rows = star.with_fact(fact).joined(needed)
    return rows.where(rest.test()) if rest.conditions else rows


def last_twelve_months(star: Star, context: FilterContext | None = None) -> FilterContext:
    """The default date slicer: twelve months up to the last day in the calendar."""
    last = star.dimensions["date"].agg(F.max("full_date").alias("last"),
                                       F.date_add(F.add_months(F.max("full_date"), -12), 1).alias("first")).first()
    return (context or FilterContext()).between("full_date", last["first"], last["last"])
