"""Star tables on shared storage: each load writes a new run, one state file publishes it.

Layout below the root::

    runs/<run id>/<table>        parquet; the fact's layers in folders by year and segment
    history/as_of=../run_id=..   what each load predicted for whom
    states/<load number>.json    appears whole and at once, and publishes that load; the largest number counts
    failures/<run id>.json       loads that were given up, with the reason
    leases/<number>              who loads now, see ``lease``

A state names the folder of every dimension and, per segment of the fact, its
layers; its size follows the years and segments, not the loads. Readers see the
old star or the new one and never a mix. The table rules are counted by the jobs that
write the tables, and a load that breaks one publishes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rostermart.operators.merge import (
    ACTION, RepeatedSourceKeyError, beside, merge_by_outer_join, merge_type1, one_row_per_key, require_unique)
from rostermart.operators.ordering import positions
from rostermart.operators.quality import EmptyInputError, broken_rules, check_rules, require_same_count
from rostermart.plans import star as s
from rostermart.schemas import DIMENSION_RULES, DIMENSIONS, FACT, FACT_RULES, KEY_OF, STAGING_RULES, ddl
from rostermart.session import side_by_side
from rostermart.sources import buckets, fact_layers
from rostermart.sources.fact_layers import KEYS, SEGMENT, YEAR
from rostermart.sources.files import Files
from rostermart.sources.lease import ConcurrentLoadError, Lease

log = logging.getLogger(__name__)

LOG_SCHEMA = (
    "load_number long, run_id string, load_status string, load_mode string, as_of date, "
    "load_start_time timestamp, load_end_time timestamp, staging_rows long, "
    "counts map<string,long>, rejected_rows long, error_message string"
)
HISTORY = "employee_key long, department_key long, attrition_probability decimal(5,4), as_of date, run_id string"


class BrokenRulesError(ValueError):
    """Rows that the tables may not hold; ``violations`` has the number of rows by rule."""

    def __init__(self, violations: dict[str, int]):
        self.violations = dict(sorted(violations.items()))
        super().__init__("Table rules are broken: " + ", ".join(f"{r} ({n})" for r, n in self.violations.items()))


class LoadFailedError(RuntimeError):
    """No fact row came out of a staging table that had rows."""


@dataclass(frozen=True)
class State:
    """What one load published."""

    load_number: int
    run_id: str
    tables: dict[str, str]
    fact: dict[fact_layers.Place, fact_layers.Segment]
    high_water: dict[str, int]
    #: Buckets by natural key that the employees lie in.
    buckets: int


@dataclass
class LoadResult:
    """What a load did; counts by name such as ``department_inserted``."""

    run_id: str
    status: str
    staging_rows: int
    counts: dict[str, int] = field(default_factory=dict)
    rejected: int = 0
    error: str | None = None

    @property
    def inserted(self) -> int:
        return self.counts.get("fact_inserted", 0)

    @property
    def updated(self) -> int:
        return self.counts.get("fact_updated", 0)


class StarStore:
    """Loads and reads the star below ``root``."""

    def __init__(self, spark: SparkSession, root: str, lease_seconds: float = 600.0, segment_rows: int = fact_layers.SEGMENT_ROWS,
                 max_layers: int = fact_layers.MAX_LAYERS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.lease_seconds, self.segment_rows, self.max_layers = lease_seconds, segment_rows, max_layers
        self._files = Files(spark, self.root)

    # -- reading ---------------------------------------------------------

    def load_log(self) -> DataFrame:
        """One row per load, published or failed."""
        folders = [f"{self.root}/{f}" for f in ("states", "failures") if self._files.names(f"{self.root}/{f}")]
        return self.spark.read.schema(LOG_SCHEMA).json(folders) if folders else self.spark.createDataFrame([], LOG_SCHEMA)

    def current(self, load_number: int | None = None) -> State | None:
        """The published state, or that of an earlier load; one listing and one small file."""
        names = self._files.names(f"{self.root}/states")
        name = f"{load_number:012d}.json" if load_number is not None else names[-1] if names else None
        if name not in names:
            return None
        read = json.loads(self._files.read(f"{self.root}/states/{name}"))
        return State(read["load_number"], read["run_id"], read["tables"], fact_layers.from_state(read["fact"]), read["high_water"], read["buckets"])

    def star(self, load_number: int | None = None) -> s.Star:
        """The published star, or the one an earlier load published (its folders stay as they were)."""
        state = self.current(load_number)
        if state is None:
            raise FileNotFoundError(f"No star has been published below {self.root}")
        return s.Star(self._fact(state), {n: self._dimension(n, state) for n in DIMENSIONS},
                      self.risk_history(state.load_number))

    def table(self, name: str) -> DataFrame:
        return self.star().fact if name == "fact" else self.star().dimensions[name]

    def risk_history(self, load_number: int | None = None) -> DataFrame:
        """One row per employee and load: ``as_of`` and the probability of that load."""
        state = self.current(load_number)
        if state is None:
            return self.spark.createDataFrame([], HISTORY).drop("run_id")
        published = self.load_log().where((F.col("load_status") == "SUCCESS") & (F.col("load_number") <= state.load_number))
        rows = self.spark.read.schema(HISTORY).parquet(f"{self.root}/history")
        return rows.join(published.select("run_id"), "run_id", "left_semi").drop("run_id")

    def rejects(self, run_id: str) -> DataFrame:
        return s.rejected_rows(self.spark.read.parquet(self._path(run_id, "resolved")))

    def table_counts(self) -> DataFrame:
        """``(table_name, row_count)``; parquet footers answer the counts."""
        star = self.star()
        tables = {f"dim_{n}": t for n, t in star.dimensions.items()} | {"fact": star.fact}
        counts = [t.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                  for n, t in sorted(tables.items())]
        result = counts[0]
        for more in counts[1:]:
            result = result.unionByName(more)
        return result

    def _path(self, run_id: str, table: str) -> str:
        return f"{self.root}/runs/{run_id}/{table}"

    def _dimension(self, name: str, state: State | None) -> DataFrame:
        schema = ddl(DIMENSIONS[name])
        if state is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{state.tables[name]}")

    def _fact(self, state: State) -> DataFrame:
        return fact_layers.read(self.spark, self.root, state.fact).drop(SEGMENT)

    # -- writing ---------------------------------------------------------

    def _write(self, df: DataFrame, path: str, **counted: Column) -> dict[str, int]:
        """Write and return the row count and others, seen by the same job; the rows are checked against the files."""
        seen = Observation()
        df.observe(seen, F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in counted.items()]).write.parquet(path)
        require_same_count(seen.get["rows"], self.spark.read.schema(df.schema).parquet(path).count(), path)
        return seen.get

    def _write_merged(self, merged: DataFrame, path: str, name: str,
                      write: Callable[[DataFrame, str], None] = lambda df, path: df.write.parquet(path)) -> tuple[dict[str, int], dict[str, int]]:
        """Write a merged dimension without its action column; rows per action and per broken rule, from the same job."""
        seen, rules = Observation(), broken_rules(merged, DIMENSION_RULES[name])
        counted = {a: F.col(ACTION) == a for a in ("INSERT", "UPDATE")} | {f"r{i}": rule for i, rule in enumerate(rules.values())}
        write(merged.observe(seen, *[F.count_if(c).alias(n) for n, c in counted.items()]).drop(ACTION), path)
        broken = {f"dim_{name}:{rule}": seen.get[f"r{i}"] for i, rule in enumerate(rules) if seen.get[f"r{i}"]}
        return {"inserted": seen.get["INSERT"], "updated": seen.get["UPDATE"]}, broken

    def load(self, staging: DataFrame, as_of: dt.date, *, run_id: str | None = None,
             reset_constants: bool = False, keep_first_termination: bool = False,
             strict: bool = False, collation: str | None = None,
             started: dt.datetime | None = None) -> LoadResult:
        """Merge a staging table into the star and publish, or leave the star as it was.

        ``reset_constants`` lets the placeholder head, cost centre, family and
        region overwrite curated ones. ``keep_first_termination`` keeps the
        termination date that was set first. ``strict`` turns a broken staging
        constraint into a failed load. Rows that the dimensions or the fact may not
        hold fail the load in any case; rows that miss a dimension are rejected.
        A load that finds another one under way fails before its work.
        """
        run_id = run_id or uuid.uuid4().hex[:12]
        started = started or dt.datetime.now()
        result = LoadResult(run_id, "FAILED", 0)
        with Lease(self.spark, f"{self.root}/leases", run_id, self.lease_seconds) as lease:
            state = self.current()
            number = (state.load_number if state else 0) + 1
            try:
                made = self._load(staging, as_of, run_id, state, result, reset_constants,
                                  keep_first_termination, strict, collation)
                result.status = "SUCCESS"
                text = self._log_text(number, result, as_of, started, made)
                lease.check()
                if not self._files.publish(f"{self.root}/states/{number:012d}.json", text):
                    raise ConcurrentLoadError(f"Load {number} below {self.root} was published by another run")
            except Exception as error:
                result.status, result.error = "FAILED", str(error)
                self._files.write(f"{self.root}/failures/{run_id}.json", self._log_text(number - 1, result, as_of, started, {}))
                raise
        return result

    def _log_text(self, number: int, result: LoadResult, as_of: dt.date, started: dt.datetime, made: dict) -> str:
        done = result.status == "SUCCESS"
        return json.dumps({
            "load_number": number, "run_id": result.run_id, "load_status": result.status, "load_mode": "merge",
            "as_of": as_of.isoformat(), "load_start_time": started.isoformat(), "load_end_time": dt.datetime.now().isoformat(),
            "staging_rows": result.staging_rows, "counts": result.counts if done else {}, "rejected_rows": result.rejected if done else 0,
            "error_message": result.error, **made})

    def _load(self, staging, as_of, run_id, state: State | None, result, reset_constants, keep_first, strict, collation) -> dict:
        staged_path = self._path(run_id, "staging")
        result.staging_rows = self._write(staging, staged_path)["rows"]
        if result.staging_rows == 0:
            raise EmptyInputError("No rows in the staging table; the load is given up")
        staged = self.spark.read.schema(staging.schema).parquet(staged_path)
        if strict:
            broken = check_rules(staged, STAGING_RULES).where("violations > 0").collect()
            if broken:
                raise BrokenRulesError({f"staging:{b['rule']}": b["violations"] for b in broken})
        water = dict(state.high_water) if state else {}
        dealt = buckets.bucket_count(max(water.get("employee", 0), result.staging_rows), state.buckets if state else None)
        tables = self._merge_dimensions(staged, as_of, run_id, state, result, water, reset_constants, keep_first, dealt)
        written = {n: self.spark.read.schema(ddl(DIMENSIONS[n])).parquet(f"{self.root}/{p}") for n, p in tables.items()}
        resolved = s.resolve_keys(staged, written, collation, water["employee"])
        fact = self._merge_fact(resolved, run_id, state, result, water)
        return {"tables": tables, "fact": fact_layers.to_state(fact), "high_water": water, "buckets": dealt,
                "history_rows": self._keep_history(run_id, as_of)}

    def _merge_dimensions(self, staged: DataFrame, as_of: dt.date, run_id: str, state: State | None, result: LoadResult,
                          water: dict[str, int], reset_constants: bool, keep_first: bool, dealt: int) -> dict[str, str]:
        """Write all dimensions; their folders below the root."""
        rule = "changed" if reset_constants else "never"
        # table: source, natural key, updatable columns, update rule
        merges = {
            "department": (s.department_source(staged), ["department_name"],
                           ["department_head", "cost_center"], rule),
            "job_role": (s.job_role_source(staged), ["job_title", "job_level"], ["job_family"], rule),
            "location": (s.location_source(staged), ["city", "state", "country"], ["region"], rule),
        }
        tables = {n: f"runs/{run_id}/dim_{n}" for n in DIMENSIONS}

        def merge(name: str) -> tuple[dict[str, int], dict[str, int]]:
            source, keys, updatable, update = merges[name]
            # A null key can match nothing; its rows are rejected at the fact.
            source = source.na.drop("any", subset=keys)
            return self._write_merged(merge_type1(
                self._dimension(name, state) if state else None, source, keys, updatable, KEY_OF[name], update, water.get(name, 0)),
                f"{self.root}/{tables[name]}", name)

        def merge_employees() -> tuple[dict[str, int], dict[str, int]]:
            return self._merge_employees(s.employee_source(staged, as_of), run_id, state, water.get("employee", 0), dealt, keep_first, result.staging_rows)

        def add_dates() -> tuple[dict[str, int], dict[str, int]]:
            known = self._dimension("date", state)
            fresh = s.new_dates(known, staged).withColumn(ACTION, F.lit("INSERT"))
            return self._write_merged(known.withColumn(ACTION, F.lit("KEEP")).unionByName(fresh),
                                      f"{self.root}/{tables['date']}", "date")

        # The dimensions do not depend on one another.
        merged_tables = side_by_side(
            self.spark, {**{n: partial(merge, n) for n in merges}, "employee": merge_employees, "date": add_dates})
        broken: dict[str, int] = {}
        for name, (done, wrong) in merged_tables.items():
            water[name] = water.get(name, 0) + done["inserted"]
            result.counts |= {f"{name}_{k}": v for k, v in done.items()}
            broken |= wrong
        del result.counts["date_updated"]
        if broken:
            raise BrokenRulesError(broken)
        return tables

    def _merge_employees(self, source: DataFrame, run_id: str, state: State | None, water: int, dealt: int,
                         keep_first: bool, rows: int) -> tuple[dict[str, int], dict[str, int]]:
        """The one dimension that grows with the facts lies in buckets by its natural key.

        The source is shuffled once, into the same buckets; the target is joined as it lies.
        """
        keys, key = ["employee_id"], KEY_OF["employee"]
        columns = DIMENSIONS["employee"]
        given = {c: t for c, t in columns.items() if c != key}
        one, differ = one_row_per_key(source.na.drop("any", subset=keys), keys, dealt)
        seen, path = Observation(), self._path(run_id, "employee_source")
        watched = one.observe(seen, F.count_if(differ).alias("differ"), F.min(F.when(differ, F.col(keys[0]))).alias("first"))
        buckets.write(watched.select(*keys, "_row.*").select(*given), path, keys, dealt)
        if seen.get["differ"]:
            raise RepeatedSourceKeyError(f"The source repeats the key {keys[0]}={seen.get['first']}")
        with ExitStack() as open_tables:
            lying = open_tables.enter_context(buckets.opened(self.spark, path, given, keys, dealt))
            target = None
            if state and state.buckets == dealt:
                held = f"{self.root}/{state.tables['employee']}"
                target = open_tables.enter_context(buckets.opened(self.spark, held, columns, keys, dealt))
            elif state:  # dealt anew this once
                target = self._dimension("employee", state).repartition(dealt, *keys)
            fresh = lying.select(*keys)
            if target is not None:
                fresh = fresh.join(beside(target.select(*keys), water), keys, "left_anti")
            ids = beside(positions(fresh, keys, key, first=water + 1), rows)
            merged = merge_by_outer_join(target, lying, ids, keys, [c for c in given if c not in keys], key,
                                         ["termination_date"] if keep_first else []).select(*columns, ACTION)
            return self._write_merged(merged, self._path(run_id, "dim_employee"), "employee", partial(buckets.write, keys=keys, buckets=dealt))

    def _merge_fact(self, resolved: DataFrame, run_id: str, state: State | None, result: LoadResult,
                    water: dict[str, int]) -> dict[fact_layers.Place, fact_layers.Segment]:
        """Write the load's fact rows as a layer on the segments they fall in.

        Of the stored fact only the keys of these segments are read; the wide
        rows are shuffled once for the lookup and once to lie by segment.
        """
        path = self._path(run_id, "resolved")
        fits = F.size("reject_reasons") == 0
        renamed = {"attrition": "attrition_flag"}
        shown = resolved.withColumns({renamed.get(c, c): F.col(c) for c in resolved.columns} | {"headcount": F.lit(s.HEADCOUNT)})
        rules = {r: c for r, c in broken_rules(shown, FACT_RULES).items()}
        seen = Observation()
        (shown.observe(seen, F.count("*").alias("rows"), *[F.count_if(fits & c).alias(f"r{i}") for i, c in enumerate(rules.values())])
         .select(*resolved.columns).write.parquet(path))
        broken = {f"fact:{r}": seen.get[f"r{i}"] for i, r in enumerate(rules) if seen.get[f"r{i}"]}
        if broken:
            raise BrokenRulesError(broken)
        source = s.fact_source(self.spark.read.schema(resolved.schema).parquet(path))
        by_year = {r[0]: r[1] for r in source.groupBy(YEAR).count().collect()}
        if not by_year:
            raise LoadFailedError(
                f"Staging has {result.staging_rows} rows but no fact row was loaded")
        require_unique(source, list(KEYS))
        fact = dict(state.fact) if state else {}
        segments = fact_layers.segment_counts(fact, by_year, self.segment_rows)
        source = source.withColumn(SEGMENT, fact_layers.segment_of(segments))
        touched = {p: v for p, v in fact.items() if p[0] in by_year}
        if touched:
            hit = {(r[0], r[1]) for r in source.select(YEAR, SEGMENT).distinct().collect()}
            touched = {p: v for p, v in touched.items() if p in hit}
        fresh, known = source.select(*KEYS), None
        if touched:
            known = beside(fact_layers.read(self.spark, self.root, touched, ["metric_id"]).select(*KEYS, F.col("metric_id").alias("_old")), water["fact"])
            fresh = fresh.join(known, list(KEYS), "left_anti")
        ids = beside(positions(fresh, ["date_key", "employee_key"], "_new", first=water.get("fact", 0) + 1), result.staging_rows)
        rows = source.join(ids, list(KEYS), "left")
        number = F.col("_new")
        if known is not None:
            rows, number = rows.join(known, list(KEYS), "left"), F.coalesce("_old", "_new")
        layer = f"runs/{run_id}/fact"
        fact_layers.write(rows.select(*[number.alias(c) if c == "metric_id" else F.col(c) for c in FACT], YEAR, SEGMENT), f"{self.root}/{layer}")
        written = self.spark.read.schema(fact_layers.SCHEMA).parquet(f"{self.root}/{layer}")
        sizes = {(r[0], r[1]): (r[2], r[3]) for r in written.groupBy(YEAR, SEGMENT).agg(
            F.count("*"), F.count_if(F.col("metric_id") > water.get("fact", 0))).collect()}
        sent, inserted = sum(by_year.values()), sum(n for _, n in sizes.values())
        require_same_count(sent, sum(n for n, _ in sizes.values()), layer)
        result.counts |= {"fact_inserted": inserted, "fact_updated": sent - inserted}
        water["fact"] = water.get("fact", 0) + inserted
        result.rejected = result.staging_rows - sent
        stacked = fact_layers.stacked_on(fact, layer, sizes)
        return fact_layers.compacted(self.spark, self.root, stacked, f"runs/{run_id}/compact", self.max_layers)

    def _keep_history(self, run_id: str, as_of: dt.date) -> int:
        """Store what the load's facts predict, below its day and run."""
        layer = self.spark.read.schema(fact_layers.SCHEMA).parquet(self._path(run_id, "fact"))
        rows = layer.select("employee_key", "department_key", "attrition_probability")
        return self._write(rows, f"{self.root}/history/as_of={as_of.isoformat()}/run_id={run_id}")["rows"]

    def audit(self) -> DataFrame:
        """One row per load and table action: ``(load_number, table_name, action, rows)``."""
        counted = self.load_log().where("load_status = 'SUCCESS'").select(
            "load_number", F.explode("counts").alias("what", "rows"))
        return counted.select(
            "load_number", F.regexp_extract("what", "^(.*)_(inserted|updated)$", 1).alias("table_name"),
            F.regexp_extract("what", "^(.*)_(inserted|updated)$", 2).alias("action"), "rows")

    def rewritten(self, run_id: str) -> DataFrame:
        """``(date_year, segment, rows, layers)`` of the fact segments that a load wrote, with the layers they now have."""
        state = self.current()
        held = {p: v for p, v in (state.fact if state else {}).items() if any(x.startswith(f"runs/{run_id}/") for x in v.layers)}
        rows = [(y, n, v.rows, len(v.layers)) for (y, n), v in sorted(held.items())]
        return self.spark.createDataFrame(rows, f"{YEAR} int, {SEGMENT} int, rows long, layers int")
