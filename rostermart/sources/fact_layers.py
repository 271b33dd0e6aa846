"""The stored fact: years cut into key-hash segments, each a stack of layers of which the newest row counts.

A load writes only the rows it has, as a new layer on the segments they fall in.
A segment that holds one layer is read as it lies; of the others, the newest row of
each key is taken. A layer that has every key of its segment replaces the
ones below, and a segment with too many layers is made one again by the load that
finds it so. The description of a fact, ``{"2024/0": {...}}``, has one entry per
segment and does not grow with the number of loads.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermart.schemas import FACT, ddl

YEAR, SEGMENT, LAYER = "date_year", "segment", "_layer"
KEYS = ("employee_key", "date_key")
#: Layers that a segment may have before a load makes them one.
MAX_LAYERS = 4
#: Rows that a segment of a new year is meant to have.
SEGMENT_ROWS = 4_000_000
SCHEMA = ddl(FACT) + f", {YEAR} int, {SEGMENT} int"


@dataclass
class Segment:
    """Its number of keys and the folders (below the root) of its layers, oldest first."""

    rows: int = 0
    layers: list[str] = field(default_factory=list)


Place = tuple[int, int]


def from_state(described: Mapping[str, Mapping] | None) -> dict[Place, Segment]:
    return {tuple(int(n) for n in place.split("/")): Segment(s["rows"], list(s["layers"])) for place, s in (described or {}).items()}


def to_state(fact: Mapping[Place, Segment]) -> dict[str, dict]:
    return {f"{y}/{s}": {"rows": v.rows, "layers": v.layers} for (y, s), v in sorted(fact.items())}


def segment_of(counts: Mapping[int, int]) -> Column:
    """The segment of a row in a year of ``counts[year]`` segments (1 if not named)."""
    cut = {y: n for y, n in counts.items() if n > 1}
    if not cut:
        return F.lit(0)
    number = F.coalesce(*[F.when(F.col(YEAR) == y, F.lit(n)) for y, n in sorted(cut.items())], F.lit(1))
    return F.pmod(F.xxhash64("employee_key"), number).cast("int")


def segment_counts(fact: Mapping[Place, Segment], fresh: Mapping[int, int], rows: int = SEGMENT_ROWS) -> dict[int, int]:
    """Segments by year: as stored, and for a new year by the number of its rows."""
    stored: dict[int, int] = {}
    for year, number in fact:
        stored[year] = max(stored.get(year, 1), number + 1)
    return {y: 1 << max(0, -(-n // rows) - 1).bit_length() for y, n in fresh.items()} | stored


def _in(places: Iterable[Place]) -> Column:
    """Whether a row lies in one of the places; on partition columns, so that other files are not read."""
    by_year: dict[int, list[int]] = {}
    for year, number in sorted(places):
        by_year.setdefault(year, []).append(number)
    return reduce(Column.__or__, [(F.col(YEAR) == y) & F.col(SEGMENT).isin(numbers) for y, numbers in by_year.items()])


def read(spark: SparkSession, root: str, fact: Mapping[Place, Segment], columns: Iterable[str] | None = None) -> DataFrame:
    """The fact's columns (all, or KEYS and some others) with year and segment, one row per key."""
    wanted = [c for c in FACT if columns is None or c in columns or c in KEYS]
    flat: dict[str, list[Place]] = {}
    stacked: dict[tuple[str, int], list[Place]] = {}
    for place, segment in fact.items():
        for i, path in enumerate(segment.layers):
            if len(segment.layers) == 1:
                flat.setdefault(path, []).append(place)
            else:
                stacked.setdefault((path, i), []).append(place)

    def part(path: str, places: list[Place]) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(f"{root}/{path}").where(_in(places)).select(*wanted, YEAR, SEGMENT)

    parts = [part(path, places) for path, places in sorted(flat.items())]
    if stacked:
        layers = [part(path, places).withColumn(LAYER, F.lit(i)) for (path, i), places in sorted(stacked.items())]
        by = [YEAR, SEGMENT, *KEYS]
        rest = [c for c in wanted if c not in KEYS]
        newest = reduce(DataFrame.unionByName, layers).groupBy(*by).agg(F.max_by(F.struct(*rest), LAYER).alias("_row")) if rest else \
            reduce(DataFrame.unionByName, layers).select(*by).distinct()
        parts.append(newest.select(*[f"_row.{c}" if c in rest else c for c in [*wanted, YEAR, SEGMENT]]))
    if not parts:
        return spark.createDataFrame([], SCHEMA).select(*wanted, YEAR, SEGMENT)
    return reduce(DataFrame.unionByName, parts)


def write(rows: DataFrame, path: str) -> None:
    """Rows with year and segment, each segment's together; a large one is split over tasks."""
    rows.hint("rebalance", F.col(YEAR), F.col(SEGMENT)).write.partitionBy(YEAR, SEGMENT).parquet(path)


def stacked_on(fact: Mapping[Place, Segment], layer: str, sizes: Mapping[Place, tuple[int, int]]) -> dict[Place, Segment]:
    """The fact with a layer whose places have ``(rows, new keys)``."""
    out = dict(fact)
    for place, (rows, fresh) in sizes.items():
        old = fact.get(place, Segment())
        total = old.rows + fresh
        out[place] = Segment(total, [layer] if rows == total else [*old.layers, layer])
    return out


def compacted(spark: SparkSession, root: str, fact: Mapping[Place, Segment], layer: str, most: int = MAX_LAYERS) -> dict[Place, Segment]:
    """The fact with every segment of more than ``most`` layers written anew, as the one layer ``layer``."""
    high = {p: s for p, s in fact.items() if len(s.layers) > most}
    if not high:
        return dict(fact)
    write(read(spark, root, high), f"{root}/{layer}")
    return {**fact, **{p: Segment(s.rows, [layer]) for p, s in high.items()}}
