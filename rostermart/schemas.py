"""Schemas and constraints of the raw, staging, dimension and fact tables."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names, types and lengths of the tables.
RAW_COLUMNS = (
    "employee_id", "name", "department", "job_role", "hire_date", "age", "gender", "ethnicity",
    "salary", "satisfaction_score", "overtime_hours", "promotion_date", "location", "attrition",
)

STAGING = {
    "employee_id": "string", "name": "string", "department": "string", "job_role": "string",
    "hire_date": "date", "age": "int", "gender": "string", "ethnicity": "string",
    "salary": "decimal(12,2)", "satisfaction_score": "decimal(4,2)", "overtime_hours": "int",
    "promotion_date": "date", "location": "string", "attrition": "int",
    "tenure_months": "decimal(6,2)", "age_group": "string", "salary_band": "string",
    "overtime_flag": "int", "promotion_recency": "decimal(6,1)",
    "attrition_probability": "decimal(5,4)", "load_timestamp": "timestamp",
}

DEPARTMENT = {"department_key": "bigint", "department_name": "string", "department_head": "string",
              "cost_center": "string"}
JOB_ROLE = {"job_role_key": "bigint", "job_title": "string", "job_level": "string",
            "job_family": "string"}
LOCATION = {"location_key": "bigint", "city": "string", "state": "string", "country": "string",
            "region": "string"}
EMPLOYEE = {"employee_key": "bigint", "employee_id": "string", "full_name": "string",
            "gender": "string", "ethnicity": "string", "age_group": "string", "hire_date": "date",
            "termination_date": "date", "salary_band": "string", "promotion_recent": "int"}
DATE = {"date_key": "int", "full_date": "date", "year": "int", "quarter": "int", "month": "int",
        "month_name": "string", "day_of_week": "int", "is_month_end": "int"}
FACT = {"metric_id": "bigint", "employee_key": "bigint", "department_key": "bigint",
        "job_role_key": "bigint", "location_key": "bigint", "date_key": "int",
        "attrition_flag": "int", "headcount": "int", "tenure_months": "decimal(6,2)",
        "satisfaction_score": "decimal(4,2)", "attrition_probability": "decimal(5,4)",
        "salary": "decimal(12,2)", "overtime_hours": "int"}

DIMENSIONS = {"department": DEPARTMENT, "job_role": JOB_ROLE, "location": LOCATION,
              "employee": EMPLOYEE, "date": DATE}
KEY_OF = {"department": "department_key", "job_role": "job_role_key", "location": "location_key",
          "employee": "employee_key", "date": "date_key"}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


@dataclass(frozen=True)
class Constraints:
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    between: dict[str, tuple[int, int]] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()


STAGING_RULES = Constraints(
    required=tuple(c for c in STAGING if c not in ("promotion_date", "promotion_recency")),
    max_length={"employee_id": 50, "name": 200, "department": 100, "job_role": 150, "gender": 20,
                "ethnicity": 50, "location": 100, "age_group": 20, "salary_band": 30},
    decimals={"salary": (12, 2), "satisfaction_score": (4, 2), "tenure_months": (6, 2),
              "promotion_recency": (6, 1), "attrition_probability": (5, 4)},
    between={"attrition": (0, 1), "overtime_flag": (0, 1)},
)
DIMENSION_RULES = {
    "department": Constraints(
        required=tuple(DEPARTMENT),
        max_length={"department_name": 100, "department_head": 200, "cost_center": 50},
        unique=(("department_key",), ("department_name",))),
    "job_role": Constraints(
        required=tuple(JOB_ROLE), max_length={"job_title": 150, "job_level": 50, "job_family": 100},
        unique=(("job_role_key",), ("job_title", "job_level"))),
    "location": Constraints(
        required=tuple(LOCATION), max_length={"city": 100, "state": 100, "country": 100, "region": 50},
        unique=(("location_key",), ("city", "state", "country"))),
    "employee": Constraints(
        required=tuple(c for c in EMPLOYEE if c != "termination_date"),
        max_length={"employee_id": 50, "full_name": 200, "gender": 20, "ethnicity": 50,
                    "age_group": 20, "salary_band": 30},
        between={"promotion_recent": (0, 1)},
        unique=(("employee_key",), ("employee_id",))),
    "date": Constraints(
        required=tuple(DATE), max_length={"month_name": 20},
        between={"quarter": (1, 4), "month": (1, 12), "day_of_week": (1, 7), "is_month_end": (0, 1)},
        unique=(("date_key",), ("full_date",))),
}
FACT_RULES = Constraints(
    required=tuple(FACT),
    decimals={"tenure_months": (6, 2), "satisfaction_score": (4, 2),
              "attrition_probability": (5, 4), "salary": (12, 2)},
    between={"attrition_flag": (0, 1)},
    unique=(("metric_id",),),
)
