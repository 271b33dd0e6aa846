"""Column names in snake case."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    """Lower case, blanks and hyphens to one underscore, other signs removed.

    Fixed values: the two character classes decide the names.
    """
    words = re.sub(r"[\s-]+", "_", name.lower())
    kept = re.sub(r"[^a-z0-9_]", "", words)
    return "_".join(part for part in kept.split("_") if part)


def renamed_columns(df: DataFrame) -> dict[str, str]:
    """Old to new name, for the names that change."""
    return {c: snake_case(c) for c in df.columns if snake_case(c) != c}


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns; two names that become one are an error."""
    names = [snake_case(c) for c in df.columns]
    clashes = sorted(n for n, uses in Counter(names).items() if uses > 1)
    if clashes:
        raise ValueError("Columns share a name after renaming: " + ", ".join(clashes))
    return df.toDF(*names)
