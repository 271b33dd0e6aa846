"""Feature logics by name: each turns a source column into a new column."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostermart.config import FeatureSpec

log = logging.getLogger(__name__)

# Fixed value: mean days per month.
DAYS_PER_MONTH = 30.44

FeatureLogic = Callable[[FeatureSpec, Column, dt.date], Column]
LOGICS: dict[str, FeatureLogic] = {}


def feature_logic(name: str) -> Callable[[FeatureLogic], FeatureLogic]:
    """Register a logic ``(spec, source column, as_of) -> Column`` under ``name``."""

    def add(logic: FeatureLogic) -> FeatureLogic:
        LOGICS[name] = logic
        return logic

    return add


def months_between_dates(day: Column, as_of: dt.date) -> Column:
    """Mean-length months from ``day`` to ``as_of``, one decimal; null for no date.

    Days are whole days passed: a time of day within ``day`` takes one off.
    """
    passed = F.datediff(F.lit(as_of), day) - (day > F.to_date(day)).cast("int")
    return F.round(passed / F.lit(DAYS_PER_MONTH), 1)


def bucket_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin; the first bin also holds its lower edge."""
    if len(labels) != len(edges) - 1:
        raise ValueError("bins need one more edge than labels")
    inside = value.isNotNull() & (value >= edges[0]) & (value <= edges[-1])
    ladder = reduce(lambda case, step: case.when(value <= step[0], F.lit(step[1])),
                    zip(edges[2:], labels[1:], strict=True), F.when(value <= edges[1], F.lit(labels[0])))
    return F.when(inside, ladder)


def bucket_code(label: Column, labels: Sequence[str]) -> Column:
    """Place of the label in its list, -1 for null."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), label) - 1
    return F.coalesce(place, F.lit(-1)).cast("int")


def above(value: Column, threshold: float) -> Column:
    """1 if strictly greater, else 0; null and NaN give 0."""
    return F.coalesce((value > threshold) & ~F.isnan(value.cast("double")), F.lit(False)).cast("int")


@feature_logic("months_since_hire")
@feature_logic("months_since_event")
def _months_since(spec: FeatureSpec, source: Column, as_of: dt.date) -> Column:
    return months_between_dates(source, as_of)


@feature_logic("bucket")
def _bucket(spec: FeatureSpec, source: Column, as_of: dt.date) -> Column:
    return bucket_label(source, spec.params["bins"], spec.params["labels"])


@feature_logic("threshold")
def _threshold(spec: FeatureSpec, source: Column, as_of: dt.date) -> Column:
    return above(source, spec.params["threshold"])


def usable_features(columns: Sequence[str], specs: Sequence[FeatureSpec]) -> list[FeatureSpec]:
    """The specs that can run, in order; others are skipped with a warning."""
    known, usable = set(columns), []
    for spec in specs:
        if spec.logic not in LOGICS:
            log.warning("Feature %s skipped: no logic named %s", spec.name, spec.logic)
        elif spec.source not in known:
            log.warning("Feature %s skipped: no column %s", spec.name, spec.source)
        else:
            usable.append(spec)
            known.add(spec.name)
    return usable
