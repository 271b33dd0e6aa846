"""Declarative description of a run: what to require, derive and train."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from rostermart.operators.nulls import NUMERIC_COLUMNS

# The default job. Bin edges, labels, thresholds and model
# settings decide results, so they are stated here as they must be.
DEFAULT_JOB: dict[str, Any] = {
    "ingestion": {
        "required_columns": [
            "employee_id", "name", "department", "job_role", "hire_date", "age", "gender",
            "ethnicity", "salary", "satisfaction_score", "overtime_hours", "location", "attrition",
        ],
        "null_strategy": "drop",
        "dedup_key": "employee_id",
        "dedup_sort": "hire_date",
    },
    "transformation": {
        "encoding_strategy": "label",
        "feature_derivations": [
            {"name": "tenure_months", "source": "hire_date", "logic": "months_since_hire"},
            {"name": "age_group", "source": "age", "logic": "bucket",
             "params": {"bins": [0, 25, 35, 45, 55, 100],
                        "labels": ["Under 25", "25-34", "35-44", "45-54", "55+"]}},
            {"name": "salary_band", "source": "salary", "logic": "bucket",
             "params": {"bins": [0, 40000, 60000, 80000, 100000, 500000],
                        "labels": ["Entry", "Mid", "Senior", "Executive", "Top"]}},
            {"name": "overtime_flag", "source": "overtime_hours", "logic": "threshold",
             "params": {"threshold": 10}},
            {"name": "promotion_recency", "source": "promotion_date",
             "logic": "months_since_event"},
        ],
    },
    "model": {
        "algorithms": ["logistic_regression", "random_forest"],
        "test_size": 0.2,
        "random_seed": 42,
        "hyperparameters": {
            "logistic_regression": {"max_iter": 5000, "solver": "lbfgs", "C": 1.0},
            "random_forest": {"n_estimators": 100, "max_depth": 10,
                              "min_samples_split": 5, "min_samples_leaf": 2},
        },
    },
    "database": {"staging_table": "stg_employee_data"},
}


@dataclass(frozen=True)
class IngestSpec:
    required: tuple[str, ...]
    null_strategy: str = "drop"
    key: str = "employee_id"
    latest_by: str = "hire_date"


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    source: str
    logic: str
    params: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class CleanSpec:
    """``number_columns`` are converted whatever they hold; with ``infer_numbers`` further columns
    that hold nothing but numbers are, too. Without ``date_formats`` each date column's is found in its values."""

    encoding: str = "label"
    features: tuple[FeatureSpec, ...] = ()
    number_columns: tuple[str, ...] = NUMERIC_COLUMNS
    infer_numbers: bool = True
    date_formats: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ModelSpec:
    algorithms: tuple[str, ...]
    test_size: float = 0.2
    seed: int = 42
    params: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)


@dataclass(frozen=True)
class JobSpec:
    ingest: IngestSpec
    clean: CleanSpec
    model: ModelSpec
    staging_table: str = "stg_employee_data"

    @classmethod
    def from_mapping(cls, job: Mapping[str, Any]) -> JobSpec:
        """Build a job from the nested mapping layout of ``DEFAULT_JOB``.

        Connection strings and other secrets in the mapping are ignored: a JDBC
        sink takes its credentials from the environment.
        """
        ingest, clean, model = job["ingestion"], job["transformation"], job["model"]
        return cls(
            ingest=IngestSpec(
                required=tuple(ingest["required_columns"]),
                null_strategy=ingest.get("null_strategy", "drop"),
                key=ingest.get("dedup_key", "employee_id"),
                latest_by=ingest.get("dedup_sort", "hire_date"),
            ),
            clean=CleanSpec(
                encoding=clean.get("encoding_strategy", "label"),
                features=tuple(
                    FeatureSpec(f["name"], f["source"], f["logic"], f.get("params", {}))
                    for f in clean.get("feature_derivations", [])
                ),
                number_columns=tuple(clean.get("number_columns", NUMERIC_COLUMNS)),
                infer_numbers=bool(clean.get("infer_numbers", True)),
                date_formats=tuple(clean["date_formats"]) if clean.get("date_formats") else None,
            ),
            model=ModelSpec(
                algorithms=tuple(model["algorithms"]),
                test_size=float(model.get("test_size", 0.2)),
                seed=int(model.get("random_seed", 42)),
                params=model.get("hyperparameters", {}),
            ),
            staging_table=job.get("database", {}).get("staging_table", "stg_employee_data"),
        )

    @classmethod
    def from_file(cls, path: str) -> JobSpec:
        """Read a JSON or YAML job file (YAML needs PyYAML to be installed)."""
        text = Path(path).read_text()
        if path.endswith(".json"):
            return cls.from_mapping(json.loads(text))
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("PyYAML is not installed; give the job as JSON") from missing
        return cls.from_mapping(yaml.safe_load(text))

    @classmethod
    def default(cls) -> JobSpec:
        return cls.from_mapping(DEFAULT_JOB)
