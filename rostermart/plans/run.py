"""The whole run: ingest, transform, model, load."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rostermart.config import JobSpec
from rostermart.functions.naming import renamed_columns, snake_case, standardize_columns
from rostermart.functions.parsing import parse_number
from rostermart.operators.clean import change_log, coerce_types, coercion_log, date_texts, feature_log
from rostermart.operators.encode import (
    CODE, bucket_columns, encode_categoricals, model_columns, text_columns)
from rostermart.operators.features import derive_features
from rostermart.operators.kinds import (
    date_formats, number_kinds, number_metrics, text_names, with_numbers)
from rostermart.operators.latest import drop_repeated_rows, keep_latest
from rostermart.operators.nulls import treat_nulls
from rostermart.plans.model import PROBABILITY, TrainingResult, save_model, score, train
from rostermart.plans.star import misfits, to_staging
from rostermart.schemas import STAGING_RULES
from rostermart.sources import scratch
from rostermart.sources.employees import read_employees
from rostermart.sources.star_store import LoadResult, StarStore
from rostermart.sources.tables import write_staging

STAGE_SCHEMA = ("run_id string, stage_name string, status string, start_time timestamp, "
                "end_time timestamp, row_count long, error_message string")


@dataclass
class StageResult:
    stage_name: str
    status: str
    start_time: dt.datetime
    end_time: dt.datetime
    row_count: int = 0
    error_message: str | None = None


@dataclass
class RunResult:
    run_id: str
    stages: list[StageResult] = field(default_factory=list)
    final_status: str = "not_started"
    total_seconds: float = 0.0
    training: TrainingResult | None = None
    load: LoadResult | None = None
    log: DataFrame | None = None

    def audit(self, spark: SparkSession) -> DataFrame:
        rows = [(self.run_id, s.stage_name, s.status, s.start_time, s.end_time, s.row_count,
                 s.error_message) for s in self.stages]
        return spark.createDataFrame(rows, STAGE_SCHEMA)


def first_seen_order(job: JobSpec) -> list:
    """Order of appearance after ingestion: latest first, then by key (cleaned names)."""
    day = F.coalesce(-F.unix_date(F.col(snake_case(job.ingest.latest_by))), F.lit(2**31 - 1))
    return [day, F.col(snake_case(job.ingest.key))]


def ingest(raw: DataFrame, job: JobSpec, numbers: Sequence[str] = ()) -> DataFrame:
    """Nulls treated and the latest row per key kept; ``numbers`` are further columns of numbers."""
    number_texts = (*job.clean.number_columns, "attrition", *map(snake_case, numbers))
    known = treat_nulls(raw, job.ingest.null_strategy, job.ingest.required, number_texts)
    return keep_latest(known, job.ingest.key, job.ingest.latest_by)


@dataclass(frozen=True)
class Ingested:
    """The stored rows as text, their number, and which columns hold numbers of which kind."""

    table: DataFrame
    rows: int
    kinds: Mapping[str, int] = field(default_factory=dict)


def ingest_file(spark: SparkSession, job: JobSpec, source: str) -> Ingested:
    """Read, ingest and store; what the columns hold is found in all rows that are read.

    It is observed by the job that stores the rows. Only filling nulls has to
    know before, so that strategy reads the source once more. The key, the label
    and dates are left out.
    """
    raw = read_employees(spark, source, job.ingest.required)
    columns = [c for c in text_names(raw, but=[job.ingest.key])
               if snake_case(c) != "attrition" and "date" not in snake_case(c)] if job.clean.infer_numbers else []
    if not columns:
        return Ingested(*counted_save(ingest(raw, job), "ingested"))
    metrics = number_metrics(columns)
    if job.ingest.null_strategy == "drop":
        seen = Observation()
        table, rows = counted_save(ingest(raw.observe(seen, *metrics), job), "ingested")
        return Ingested(table, rows, number_kinds(columns, seen.get))
    kinds = number_kinds(columns, raw.agg(*metrics).first().asDict())
    return Ingested(*counted_save(ingest(raw, job, list(kinds)), "ingested"), kinds)


def named_and_formats(ingested: Ingested, job: JobSpec) -> tuple[DataFrame, dict]:
    """Rows with clean names and the numbers found, and the options of their conversion.

    Date formats that the job does not give are found in the stored rows, the
    latest of which counts as the first.
    """
    named = standardize_columns(with_numbers(ingested.table, ingested.kinds))
    formats: Sequence[str] | Mapping[str, Sequence[str]] | None = job.clean.date_formats
    if formats is None:
        first_by = [c for c in map(snake_case, (job.ingest.latest_by, job.ingest.key)) if c in named.columns]
        formats = date_formats(named, date_texts(named), first_by or named.columns)
    return named, {"numeric_columns": job.clean.number_columns, "date_formats": formats}


def counted_save(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    seen = Observation()
    table = scratch.saved(df.observe(seen, F.count("*").alias("rows")), label)
    return table, seen.get["rows"]


def rows_with_model_input(featured: DataFrame, job: JobSpec, skip: Sequence[str] = ()) -> DataFrame:
    """Two structs per row: ``row`` as it is, and ``model`` with the numeric columns made from it.

    Keeping both side by side spares a join between scores and rows later.
    ``skip`` texts are not encoded.
    """
    buckets, key = bucket_columns(job.clean.features), snake_case(job.ingest.key)
    codes = {f"{CODE}{c}": F.col(c) for c in text_columns(featured, but=[*buckets, *skip, key])}
    encoded = encode_categoricals(featured.withColumns(codes), job.clean.encoding, list(codes),
                                  first_seen_order(job))
    return encoded.select(F.struct(*featured.columns).alias("row"),
                          F.struct(*model_columns(encoded, buckets, but=[key])).alias("model"))


def encoded_frame(featured: DataFrame, job: JobSpec, skip: Sequence[str] = ()) -> DataFrame:
    """The key and the numeric columns for the models, from the featured table."""
    both = rows_with_model_input(featured, job, skip)
    return both.select(f"row.{snake_case(job.ingest.key)}", "model.*")


def run_job(spark: SparkSession, job: JobSpec, source: str, store_root: str, as_of: dt.date, *,
            model_path: str | None = None, staging_folder: str | None = None, started: dt.datetime | None = None,
            **load_options) -> RunResult:
    """Run the four stages in order and stop at the first failure.

    Plans stay lazy within a stage; each stage ends in one written table, whose
    row count the write itself reports. Names and ids are no features, so they
    are not encoded, which spares a code table as long as the data. With a
    ``staging_folder`` the staging table is also stored there, under the job's name
    for it. Values that do not fit a staging column that must not be null fail the
    load; other misfits are counted in the load result as ``misfit_<column>``.
    """
    result = RunResult(uuid.uuid4().hex[:12])
    began = time.monotonic()
    store, key = StarStore(spark, store_root), snake_case(job.ingest.key)
    tables: dict[str, DataFrame] = {}
    found: list[Ingested] = []

    def ingestion() -> int:
        found.append(ingest_file(spark, job, source))
        return found[0].rows

    def transformation() -> int:
        named, options = named_and_formats(found[0], job)
        typed = drop_repeated_rows(coerce_types(named, **options)).transform(_typed_label)
        derived = derive_features(typed, job.clean.features, as_of)
        tables["featured"], n = counted_save(derived, "featured")
        buckets = bucket_columns(job.clean.features)
        result.log = change_log(
            renamed_columns(found[0].table), coercion_log(named, **options), result.stages[0].row_count, n,
            feature_log(tables["featured"], job.clean.features), job.clean.encoding,
            text_columns(tables["featured"], but=[*buckets, "name", key]))
        return n

    def modeling() -> int:
        both, n = counted_save(rows_with_model_input(tables["featured"], job, skip=("name",)), "model")
        result.training = train(both.select(f"row.{key}", "model.*"), job.model, key=(key,))
        best = result.training.models[result.training.best_name]
        if model_path:
            save_model(best, model_path)
        scored = score(best, both.select("row", "model.*"))
        tables["scored"] = scored.select("row.*", PROBABILITY)
        return n

    def star_load() -> int:
        lost = misfits(tables["scored"])
        needed = [f"{c} ({n})" for c, n in lost.items() if c in STAGING_RULES.required]
        if needed:
            raise ValueError("Values that do not fit the staging table: " + ", ".join(needed))
        staged = to_staging(tables["scored"], dt.datetime.combine(as_of, dt.time()))
        if staging_folder:
            write_staging(staged, f"{staging_folder.rstrip('/')}/{job.staging_table}")
        result.load = store.load(staged, as_of, run_id=result.run_id, started=started, **load_options)
        result.load.counts |= {f"misfit_{c}": n for c, n in lost.items()}
        return result.load.staging_rows

    stages: list[tuple[str, Callable[[], int]]] = [
        ("ingestion", ingestion), ("transformation", transformation), ("modeling", modeling),
        ("sql_loading", star_load)]
    result.final_status = "success"
    for name, stage in stages:
        start = dt.datetime.now()
        try:
            outcome = StageResult(name, "success", start, dt.datetime.now(), stage())
        except Exception as error:
            outcome = StageResult(name, "failure", start, dt.datetime.now(), 0, str(error))
            result.final_status = "failure"
        outcome.end_time = dt.datetime.now()
        result.stages.append(outcome)
        if outcome.status == "failure":
            break
    result.total_seconds = time.monotonic() - began
    result.audit(spark).coalesce(1).write.mode("append").parquet(f"{store.root}/stage_log")
    return result


def _typed_label(df: DataFrame) -> DataFrame:
    """A text or boolean label column becomes 0/1; a text that is no number fails the run."""
    kind, label = dict(df.dtypes).get("attrition"), F.col("attrition")
    if kind == "boolean":
        return df.withColumn("attrition", label.cast("int"))
    if kind != "string":
        return df
    number = parse_number(label)
    wrong = F.raise_error(F.concat(F.lit("The label is no number: "), label)).cast("double")
    return df.withColumn("attrition", F.when(label.isNotNull() & number.isNull(), wrong).otherwise(number).cast("int"))
