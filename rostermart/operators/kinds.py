"""What the values of text columns are: numbers, and dates of which format.

A value fits a set of kinds, written as bits; what a column is, is what all of
its values fit, the ``bit_and`` over the column. All columns go through one
aggregate of fixed size, which can also be observed while the rows are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermart.functions.parsing import DEFAULT_DATE_FORMATS, KNOWN_DATE_FORMATS, parse_date, parse_number

INTEGER, NUMBER = 1, 2


def text_names(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in but]


def _bits(fits: Sequence[Column]) -> Column:
    return reduce(Column.bitwiseOR, [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fits)])


def _number_bits(text: Column) -> Column:
    whole = text.rlike(r"^\s*[+-]?\d{1,18}\s*$")  # more digits do not fit a bigint
    return F.when(text.isNotNull(), _bits([whole, parse_number(text).isNotNull()]))


def number_metrics(columns: Sequence[str]) -> list[Column]:
    """One aggregate per column, for ``agg`` or ``observe``."""
    return [F.bit_and(_number_bits(F.col(f"`{c}`"))).alias(f"kinds{i}") for i, c in enumerate(columns)]


def number_kinds(columns: Sequence[str], found: Mapping[str, int | None]) -> dict[str, int]:
    """The columns whose values are all numbers, with ``INTEGER`` or ``NUMBER``.

    ``found`` holds the values of ``number_metrics``. A column without any value
    is none of them.
    """
    bits = {c: found[f"kinds{i}"] or 0 for i, c in enumerate(columns)}
    return {c: INTEGER if b & INTEGER else NUMBER for c, b in bits.items() if b}


def with_numbers(df: DataFrame, kinds: Mapping[str, int]) -> DataFrame:
    """The columns of ``kinds`` as bigint or double."""
    cell = {c: F.col(f"`{c}`") for c in kinds}
    return df.withColumns({c: F.trim(cell[c]).try_cast("bigint") if kind == INTEGER else parse_number(cell[c])
                           for c, kind in kinds.items()})


def date_formats(df: DataFrame, columns: Sequence[str], first_by: Sequence[str],
                 candidates: Sequence[str] = KNOWN_DATE_FORMATS) -> dict[str, tuple[str, ...]]:
    """The format of each text column of dates, from one aggregate over all of them.

    It is the earliest candidate that every value fits, so months come before
    days where both would do. Where no candidate fits every value, it is that of
    the first value: of the row with the greatest ``first_by`` columns. A first
    value of no candidate's format leaves the column to the default formats.
    """
    if not columns:
        return {}
    place = F.struct(*[F.col(f"`{c}`") for c in first_by])
    metrics = []
    for i, c in enumerate(columns):
        text = F.col(f"`{c}`")
        bits = F.when(text.isNotNull(), _bits([parse_date(text, [f]).isNotNull() for f in candidates]))
        metrics += [F.bit_and(bits).alias(f"all{i}"), F.max_by(bits, F.when(text.isNotNull(), place)).alias(f"first{i}")]
    found = df.agg(*metrics).first()
    chosen = {}
    for i, c in enumerate(columns):
        bits = found[f"all{i}"] or found[f"first{i}"] or 0
        fitting = [f for k, f in enumerate(candidates) if bits >> k & 1]
        chosen[c] = tuple(fitting[:1]) or tuple(DEFAULT_DATE_FORMATS)
    return chosen
