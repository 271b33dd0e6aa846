"""Queries for the star load: dimensions, fact, merges, rejects, audits, refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import mapping as m
from checks.base_sql import AS_OF, FIRST_AS_OF, with_level
from checks.registry import query
from checks.table_queries import DATE_SHAPE
from rostermart.operators.merge import insert_absent
from rostermart.operators.quality import check_star
from rostermart.plans.refresh import refresh_star
from rostermart.plans.star import rejected_rows as rejects_of
from rostermart.plans.star import resolve_keys
from rostermart.schemas import DIMENSION_RULES, FACT_RULES, KEY_OF
from rostermart.sources import scratch
from rostermart.sources.star_store import BrokenRulesError, StarStore

EMPLOYEE_SHAPE = ("employee_key:i employee_id:s full_name:s gender:s ethnicity:s age_group:s hire_date:s "
                  "termination_date:s salary_band:s promotion_recent:i")
FACT_SHAPE = ("metric_id:i employee_key:i department_key:i job_role_key:i location_key:i date_key:i "
              "attrition_flag:i headcount:i tenure_months:d satisfaction_score:d attrition_probability:d "
              "salary:d overtime_hours:i")


@query("department_key:i department_name:s department_head:s cost_center:s",
       with_level("dims", "SELECT * FROM dep"))
def dim_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.star(spark, sf_dir).dimension("department")


@query("job_role_key:i job_title:s job_level:s job_family:s", with_level("dims", "SELECT * FROM job"))
def dim_job_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.star(spark, sf_dir).dimension("job_role")


@query("location_key:i city:s state:s country:s region:s", with_level("dims", "SELECT * FROM loc"))
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.star(spark, sf_dir).dimension("location")


@query(EMPLOYEE_SHAPE, with_level("dims", "SELECT * FROM emp"))
def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.star(spark, sf_dir).dimension("employee")


@query(DATE_SHAPE, with_level("dims", "SELECT * FROM dat"))
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.star(spark, sf_dir).dimension("date")


@query(FACT_SHAPE, with_level("fact", "SELECT * FROM fact"))
def fact_employee_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.star(spark, sf_dir).fact


# Keys after three loads: the first batch was numbered first, the rest after it.
KEYED = f"""
first_keys AS (SELECT employee_id, row_number() OVER (ORDER BY employee_id) AS employee_key FROM b1),
later_keys AS (SELECT employee_id, (SELECT count(*) FROM b1)
                 + row_number() OVER (ORDER BY employee_id) AS employee_key
               FROM stg WHERE employee_id NOT IN (SELECT employee_id FROM b1)),
keys AS (SELECT * FROM first_keys UNION ALL SELECT * FROM later_keys),
first_ids AS (SELECT k.employee_key, date_key, row_number() OVER (ORDER BY date_key, employee_key) AS metric_id
              FROM b1 JOIN keys k USING (employee_id)),
later_ids AS (SELECT k.employee_key, date_key, (SELECT count(*) FROM b1)
                + row_number() OVER (ORDER BY date_key, employee_key) AS metric_id
              FROM stg JOIN later_keys k USING (employee_id)),
ids AS (SELECT * FROM first_ids UNION ALL SELECT * FROM later_ids)"""


@query(EMPLOYEE_SHAPE, with_level("batch", f"""
  SELECT employee_key, employee_id, name AS full_name, gender, ethnicity, age_group, hire_date,
         CASE WHEN attrition = 1 THEN {AS_OF} END AS termination_date, salary_band,
         CASE WHEN promotion_date IS NOT NULL THEN 1 ELSE 0 END AS promotion_recent
  FROM stg JOIN keys USING (employee_id)""", KEYED))
def dim_employee_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.store_of_three_loads(spark, sf_dir).star().dimension("employee")


@query("metric_id:i employee_key:i date_key:i salary:d", with_level(
    "batch", "SELECT metric_id, employee_key, date_key, salary FROM stg JOIN keys USING (employee_id) "
             "JOIN ids USING (employee_key, date_key)", KEYED))
def fact_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.store_of_three_loads(spark, sf_dir).star().fact


def _action_counts() -> str:
    """Rows per load, table and action of the three loads."""
    keys = {"department": "department", "job_role": "job_role", "location": "(city, state, country)",
            "employee": "employee_id", "date": "date_key", "fact": "(employee_id, date_key)"}
    parts = []
    for table, key in keys.items():
        first, full = (f"(SELECT count(DISTINCT {key}) FROM {t})" for t in ("b1", "stg"))
        updates = table in ("employee", "fact")
        for load, inserted, updated in ((1, first, "0"), (2, f"{full} - {first}", first if updates else "0"),
                                        (3, "0", full if updates else "0")):
            parts.append(f"SELECT {load} AS load_number, '{table}' AS table_name, 'inserted' AS action, "
                         f"{inserted} AS rows")
            if table != "date":
                parts.append(f"SELECT {load}, '{table}', 'updated', {updated}")
    return " UNION ALL ".join(parts)


@query("load_number:i table_name:s action:s rows:i", with_level("batch", _action_counts()))
def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.store_of_three_loads(spark, sf_dir).audit()


@query("load_number:i load_status:s load_mode:s as_of:s staging_rows:i rejected_rows:i", with_level(
    "batch", f"""SELECT 1 AS load_number, 'SUCCESS' AS load_status, 'merge' AS load_mode, {FIRST_AS_OF} AS as_of,
      count(*) AS staging_rows, 0 AS rejected_rows FROM b1
    UNION ALL SELECT 2, 'SUCCESS', 'merge', {AS_OF}, count(*), 0 FROM stg
    UNION ALL SELECT 3, 'SUCCESS', 'merge', {AS_OF}, count(*), 0 FROM stg"""))
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.store_of_three_loads(spark, sf_dir).load_log()


@query("table_name:s row_count:i", with_level("dims", """
  SELECT 'dim_date' AS table_name, count(*) AS row_count FROM dat UNION ALL
  SELECT 'dim_department', count(*) FROM dep UNION ALL SELECT 'dim_employee', count(*) FROM emp UNION ALL
  SELECT 'dim_job_role', count(*) FROM job UNION ALL SELECT 'dim_location', count(*) FROM loc UNION ALL
  SELECT 'fact', count(*) FROM emp"""))
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.store(spark, sf_dir).table_counts()


@query("employee_id:s reasons:s", with_level("batch", """
  SELECT employee_id, concat_ws(',', 'employee',
    CASE WHEN department NOT IN (SELECT department FROM b1) THEN 'department' END,
    CASE WHEN job_role NOT IN (SELECT job_role FROM b1) THEN 'job_role' END,
    CASE WHEN (city, state, country) NOT IN (SELECT (city, state, country) FROM b1) THEN 'location' END,
    CASE WHEN date_key NOT IN (SELECT date_key FROM b1) THEN 'date' END) AS reasons
  FROM stg WHERE employee_id NOT IN (SELECT employee_id FROM b1)"""))
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everybody against the dimensions as the first of the loads left them."""
    old = m.store_of_three_loads(spark, sf_dir).star(load_number=1)
    found = rejects_of(resolve_keys(m.staging(spark, sf_dir), old.dimensions))
    return found.withColumn("reasons", F.array_join("reject_reasons", ","))


@query("nation_key:i nation:s", """
  SELECT row_number() OVER (ORDER BY n_name) AS nation_key, n_name AS nation FROM nation WHERE n_regionkey < 2
  UNION ALL SELECT (SELECT count(*) FROM nation WHERE n_regionkey < 2) + row_number() OVER (ORDER BY n_name),
    n_name FROM (SELECT DISTINCT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey
                 WHERE n_regionkey >= 2)""")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = m.table(spark, sf_dir, "nation")
    old = insert_absent(None, nation.where("n_regionkey < 2").select(F.col("n_name").alias("nation")),
                        ["nation"], "nation_key")
    used = m.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return insert_absent(old, used.select(F.col("n_name").alias("nation")), ["nation"], "nation_key",
                         high_water=old.count())


def _refreshed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return refresh_star(scratch.saved(m.staging(spark, sf_dir), "staging"))


@query("employee_id:s department_name:s job_title:s location_name:s employee_key:i attrition_flag:i "
       "headcount:i tenure_months:d satisfaction_score:d salary:d overtime_hours:i overtime_flag:i age:i",
       with_level("stg", """
  SELECT employee_id, department AS department_name, job_role AS job_title, location AS location_name,
         row_number() OVER (ORDER BY employee_id) AS employee_key, attrition AS attrition_flag, 1 AS headcount,
         tenure_months, satisfaction_score, salary, overtime_hours, overtime_flag, age FROM stg"""))
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _refreshed(spark, sf_dir)
    return (t["fact"].join(t["dim_employee"], "employee_key").join(t["dim_department"], "department_key")
            .join(t["dim_job_role"], "job_role_key").join(t["dim_location"], "location_key"))


def _star_rules() -> str:
    """Every rule of the star with no violation."""
    names = []
    for table, rules in [*((f"dim_{n}", r) for n, r in DIMENSION_RULES.items()), ("fact", FACT_RULES)]:
        names += [f"{table}:not_null:{c}" for c in rules.required]
        names += [f"{table}:max_length:{c}" for c in rules.max_length]
        names += [f"{table}:decimal:{c}" for c in rules.decimals]
        names += [f"{table}:between:{c}" for c in rules.between]
        names += [f"{table}:unique:{'+'.join(k)}" for k in rules.unique]
    names += [f"fact:foreign_key:{k}" for k in KEY_OF.values()]
    values = ", ".join(f"('{n}')" for n in names)
    return f"SELECT rule, 0 AS violations FROM (VALUES {values}) AS t(rule)"


@query("rule:s violations:i", _star_rules())
def star_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_star(m.star(spark, sf_dir))


@query("date_year:i segment:i rows:i layers:i", with_level("stg", """
  SELECT date_key // 10000 AS date_year, 0 AS segment, count(*) AS rows,
    CASE WHEN count(*) = count(*) FILTER (employee_id::BIGINT % 100 = 0) THEN 1 ELSE 2 END AS layers
  FROM stg GROUP BY 1 HAVING count(*) FILTER (employee_id::BIGINT % 100 = 0) > 0"""))
def late_rows_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of one row in a hundred wrote of the stored fact: a layer on some segments, and no other."""
    store = m.store_with_late_rows(spark, sf_dir)
    return store.rewritten(store.current().run_id)


@query("metric_id:i employee_id:s date_key:i salary:d", with_level("fact", """
  SELECT f.metric_id, e.employee_id, f.date_key, CASE WHEN e.employee_id::BIGINT % 100 = 0 THEN 1 ELSE f.salary END AS salary
  FROM fact f JOIN emp e USING (employee_key)"""))
def fact_with_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = m.store_with_late_rows(spark, sf_dir).star()
    return star.fact.join(star.dimension("employee").select("employee_key", "employee_id"), "employee_key")


@query("attempt:i rule:s violations:i published:i", with_level("stg", """
  SELECT * FROM (
    SELECT 1 AS attempt, 'dim_employee:not_null:gender' AS rule, count(*) FILTER (employee_id::BIGINT % 7 = 0) AS violations, 0 AS published FROM stg
    UNION ALL SELECT 1, 'dim_employee:max_length:full_name', count(*) FILTER (employee_id::BIGINT % 11 = 0), 0 FROM stg
    UNION ALL SELECT 2, 'fact:not_null:salary', count(*) FILTER (employee_id::BIGINT % 5 = 0), 0 FROM stg
    UNION ALL SELECT 2, 'fact:between:attrition_flag', count(*) FILTER (employee_id::BIGINT % 13 = 0), 0 FROM stg
  ) WHERE violations > 0"""))
def star_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of rows that the tables may not hold: the rules they break, and that neither is published."""
    rows, store = scratch.saved(m.staging(spark, sf_dir), "staging"), StarStore(spark, scratch.new_path(spark, "star-broken"))
    number = F.col("employee_id").cast("long")
    attempts = ({"gender": F.when(number % 7 != 0, F.col("gender")),
                 "name": F.when(number % 11 == 0, F.repeat("name", F.lit(20))).otherwise(F.col("name"))},
                {"salary": F.when(number % 5 != 0, F.col("salary")),
                 "attrition": F.when(number % 13 == 0, 2).otherwise(F.col("attrition"))})
    found = []
    for i, changes in enumerate(attempts):
        try:
            store.load(rows.withColumns(changes), m.AS_OF)
        except BrokenRulesError as error:
            found += [(i + 1, rule, n) for rule, n in error.violations.items()]
    published = store.load_log().where("load_status = 'SUCCESS'").count()
    return spark.createDataFrame([(*f, published) for f in found], "attempt int, rule string, violations long, published long")
