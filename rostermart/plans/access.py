"""Row-level access: a user's star, narrowed before any measure runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.plans.star import Star

# Role names.
MANAGER = "Department_Manager"
EXECUTIVE = "HR_Executive"

MAP_SCHEMA = "map_id long, user_email string, department_key long, role_name string"


def secure(star: Star, user: str, roles: Iterable[str], department_map: DataFrame | None = None) -> Star:
    """The star as ``user`` may see it.

    An executive sees all. A manager sees the departments that name the user as
    head and those mapped to the user; several roles add up. Without a known
    role everything is empty. Facts follow their department, and the other
    dimensions show only what visible facts use.
    """
    held = set(roles)
    if EXECUTIVE in held:
        return star
    departments = star.dimensions["department"]
    if MANAGER not in held:
        nothing = {n: t.where(F.lit(False)) for n, t in star.dimensions.items()}
        history = None if star.history is None else star.history.where(F.lit(False))
        return Star(star.fact.where(F.lit(False)), nothing, history, restricted=True)
    headed = F.col("department_head") == user
    if department_map is None:
        visible = departments.where(headed)
    else:
        mapped = department_map.where(F.col("user_email") == user).select("department_key").distinct()
        own = departments.where(headed).select("department_key").unionByName(mapped).distinct()
        visible = departments.join(own, "department_key", "left_semi")
    fact = star.fact.join(visible.select("department_key"), "department_key", "left_semi")
    return star.narrowed(fact, visible)


def has_access(star: Star) -> DataFrame:
    """One row, ``has_access`` 1 if any department is visible, else 0."""
    found = star.dimensions["department"].agg(F.count("*").alias("n"))
    return found.select((F.col("n") > 0).cast("int").alias("has_access"))
