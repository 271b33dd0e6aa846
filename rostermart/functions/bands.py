"""Bands and status labels for numbers on the report pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk limits, target and status limits of the report.
HIGH_RISK = 0.30
MEDIUM_RISK = 0.15
RISK_TARGET = 0.15
RISK_REFERENCE = 0.15
TENURE_BANDS = ("0-12mo", "13-36mo", "37-60mo", "60+mo")


def risk_level(probability: Column) -> Column:
    """High from 0.30, Medium from 0.15, else Low; no probability counts as 0."""
    p = F.coalesce(probability.cast("double"), F.lit(0.0))
    return F.when(p >= HIGH_RISK, "High").when(p >= MEDIUM_RISK, "Medium").otherwise("Low")


def tenure_band(months: Column) -> Column:
    """``<=12``, ``(12, 36]``, ``(36, 60]``, ``>60`` months."""
    a, b, c, d = TENURE_BANDS
    return (F.when(months <= 12, a).when(months <= 36, b).when(months <= 60, c)
            .when(months.isNotNull(), d))


def tenure_band_order(months: Column) -> Column:
    return (F.when(months <= 12, 1).when(months <= 36, 2).when(months <= 60, 3)
            .when(months.isNotNull(), 4))


def attrition_status(rate: Column) -> Column:
    """Percent: green below 10, yellow to 20, red above."""
    return F.when(rate < 10, "green").when(rate <= 20, "yellow").when(rate > 20, "red")


def satisfaction_status(score: Column) -> Column:
    """Green from 4, yellow from 3, red below."""
    return F.when(score >= 4, "green").when(score >= 3, "yellow").when(score < 3, "red")


def risk_status(probability: Column) -> Column:
    """Green below 15 percent, yellow to 30, red above."""
    p = probability.cast("double")
    return F.when(p < 0.15, "green").when(p <= 0.30, "yellow").when(p > 0.30, "red")


def above_target(probability: Column, target: float = RISK_TARGET) -> Column:
    return (probability.cast("double") > target).cast("int")


def change_sign(change: Column) -> Column:
    """1, 0 or -1."""
    return F.signum(change).cast("int")
