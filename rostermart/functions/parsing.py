"""Text to null, date and number, with bad values turned to null."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cell texts that count as null in the input.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

DEFAULT_DATE_FORMATS = ("yyyy-MM-dd",)

# Formats that are looked for in a column; one letter stands for one or two digits.
KNOWN_DATE_FORMATS = (
    "yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy",
    "yyyy-MM-dd HH:mm:ss", "M/d/yyyy HH:mm:ss", "d/M/yyyy HH:mm:ss",
)

_NUMBER = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
_FIELD_WIDTH = re.compile(r"y+|M+|d+|H+|m+|s+")


def null_if_token(text: Column) -> Column:
    """Null for the listed tokens, exact match without trimming."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def _shape_of(date_format: str) -> str:
    """The regular expression a text must meet: as many digits as a field has letters, one or two for one letter."""
    pattern, at = "", 0
    for field in _FIELD_WIDTH.finditer(date_format):
        width = len(field.group())
        digits = rf"\d{{{width}}}" if width > 1 else r"\d{1,2}"
        pattern += re.escape(date_format[at:field.start()]).replace("'", "") + digits
        at = field.end()
    return "^" + pattern + re.escape(date_format[at:]) + "$"


def parse_date(text: Column, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """The first format that fits exactly; otherwise null.

    The shape is checked first, since Spark would read ``2023-02`` as a date.
    """

    def read(date_format: str) -> Column:
        fitting = F.when(text.rlike(_shape_of(date_format)), text)
        if date_format == "yyyy-MM-dd":
            return fitting.try_cast("date")  # the same days, without a formatter per row
        return F.to_date(F.try_to_timestamp(fitting, F.lit(date_format)))

    return F.coalesce(*[read(f) for f in formats])


def parse_number(text: Column) -> Column:
    """A double, or null where the text is not a plain number (``1d`` is not)."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))
