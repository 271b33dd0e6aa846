"""Location text to city, state and country."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def place_parts(location: Column) -> dict[str, Column]:
    """``city, state, country``; absent parts are Unknown, further commas stay in country."""
    parts = F.split(location, ",", 3)

    def part(i: int) -> Column:
        return F.trim(F.get(parts, F.lit(i)))

    return {
        "city": part(0),
        "state": F.when(location.isNotNull(), F.coalesce(part(1), F.lit(UNKNOWN))),
        "country": F.when(location.isNotNull(), F.coalesce(part(2), F.lit(UNKNOWN))),
    }
