"""Queries for measures, trends, pages, access and models."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import mapping as m
from checks.base_sql import with_level
from checks.registry import query
from rostermart.functions import bands
from rostermart.plans import measures as g
from rostermart.plans import pages as p
from rostermart.plans import trends as t
from rostermart.plans.access import EXECUTIVE, MANAGER, has_access, secure
from rostermart.plans.filters import FilterContext, last_twelve_months
from rostermart.plans.model import (
    class_metrics, confusion, exact_auc, save_model, load_model, score, stratified_split, train)
from rostermart.plans.run import encoded_frame, run_job
from rostermart.plans.star import Star
from rostermart.sources import scratch
from rostermart.sources.tables import register_views


def _sql(body: str, *extra: str) -> str:
    return with_level("wide", body, *extra)


DEPARTED = "count(*) FILTER (attrition_flag = 1)"
BLANK_DEPARTED = f"nullif({DEPARTED}, 0)"


def _mean(column: str, only: str = "") -> str:
    return f"sum({column}) {only}::DOUBLE / count({column}) {only}"


@query("department_name:s headcount:i departures:i turnover_rate_pct:d", _sql("""
  SELECT department_name, count(*) AS headcount, sum(attrition_flag) AS departures,
         (sum(attrition_flag) * 2000 + count(*)) // (2 * count(*)) / 10.0 AS turnover_rate_pct
  FROM wide GROUP BY department_name"""))
def turnover_by_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.turnover_by_department(m.star(spark, sf_dir))


TURNOVER = """SELECT year, month, department_name, sum(headcount) AS headcount,
  sum(attrition_flag) AS departures, sum(attrition_flag) * 100.0::DOUBLE / sum(headcount) AS turnover_rate
  FROM wide GROUP BY year, month, department_name"""


@query("year:i month:i department_name:s headcount:i departures:i turnover_rate:d", _sql(TURNOVER))
def turnover_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views({"vw_turnover_summary": g.turnover_summary(m.star(spark, sf_dir))})
    return spark.table("vw_turnover_summary")


COUNTS = """SELECT department_name, gender, ethnicity, age_group, count(*) AS headcount FROM wide
  GROUP BY department_name, gender, ethnicity, age_group"""


@query("department_name:s gender:s ethnicity:s age_group:s headcount:i percentage:d", _sql(
    f"""SELECT *, headcount * 100.0::DOUBLE / sum(headcount) OVER (PARTITION BY department_name) AS percentage
    FROM ({COUNTS})"""))
def diversity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.diversity_metrics(m.star(spark, sf_dir))


@query("department_name:s gender:s ethnicity:s age_group:s headcount:i", _sql(COUNTS))
def diversity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.diversity_counts(m.star(spark, sf_dir))


RATES = f"""{BLANK_DEPARTED} * 100.0::DOUBLE / avg(headcount) AS attrition_rate_avg,
  {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS attrition_rate"""


@query("job_title:s attrition_rate_avg:d attrition_rate:d", _sql(
    f"SELECT job_title, {RATES} FROM wide GROUP BY job_title"))
def attrition_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.rate_by(m.star(spark, sf_dir), "job_title")


@query("attrition_rate_avg:d attrition_rate:d departures:i", _sql(
    f"SELECT {RATES}, {BLANK_DEPARTED} AS departures FROM wide"))
def attrition_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.evaluate(m.star(spark, sf_dir), ["attrition_rate_avg", "attrition_rate", "departures"])


MONTH_RATE = f"SELECT year, month, {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS attrition_rate"


@query("year:i month:i department_name:s attrition_rate:d", _sql(
    f"{MONTH_RATE}, department_name FROM wide GROUP BY ALL"))
def attrition_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.evaluate(m.star(spark, sf_dir), ["attrition_rate"], ["year", "month", "department_name"])


SCORECARD = f"""sum(headcount) AS headcount, {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS attrition_rate,
  {_mean('tenure_months')} AS avg_tenure, {_mean('satisfaction_score')} AS avg_satisfaction,
  {BLANK_DEPARTED} AS open_positions, {_mean('attrition_probability')} AS predicted_risk"""
SCORE_SHAPE = "headcount:i attrition_rate:d avg_tenure:d avg_satisfaction:d open_positions:i predicted_risk:d"


@query(f"department_name:s {SCORE_SHAPE}", _sql(
    f"SELECT department_name, {SCORECARD} FROM wide GROUP BY department_name"))
def dept_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.evaluate(m.star(spark, sf_dir), g.SCORECARD, ["department_name"])


@query(f"department_name:s gender:s {SCORE_SHAPE}", _sql(f"""
  SELECT department_name, gender, {SCORECARD} FROM wide
  WHERE job_title IN ('1-URGENT', '2-HIGH', '5-LOW') AND city LIKE 'NATION_%' AND city <= 'NATION_19'
    AND full_date BETWEEN DATE '1999-01-15' AND DATE '2001-06-30' GROUP BY department_name, gender"""))
def sliced_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = (FilterContext().where(job_title=["1-URGENT", "2-HIGH", "5-LOW"])
               .between("city", "NATION_", "NATION_19")
               .between("full_date", dt.date(1999, 1, 15), dt.date(2001, 6, 30)))
    return g.evaluate(m.star(spark, sf_dir), g.SCORECARD, ["department_name", "gender"], context)


@query(f"day:s {SCORE_SHAPE}", _sql(f"""
  SELECT CAST(full_date AS VARCHAR) AS day, {SCORECARD} FROM wide
  WHERE full_date IN (DATE '2001-06-14', DATE '2001-06-21', DATE '2001-07-05', DATE '2001-07-12', DATE '2001-07-19', DATE '2001-07-26', DATE '2001-05-31', DATE '1993-05-05')
    AND full_date BETWEEN DATE '2001-06-01' AND DATE '2001-07-31' GROUP BY full_date"""))
def sliced_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range on the day and chosen days hold together."""
    days = [dt.date(2001, 6, 14), dt.date(2001, 6, 21), *[dt.date(2001, 7, d) for d in (5, 12, 19, 26)], dt.date(2001, 5, 31), dt.date(1993, 5, 5)]
    context = FilterContext().between("full_date", dt.date(2001, 6, 1), dt.date(2001, 7, 31)).where(full_date=days)
    return g.evaluate(m.star(spark, sf_dir), g.SCORECARD, ["full_date"], context).withColumnRenamed(
        "full_date", "day").withColumn("day", F.col("day").cast("string"))


LAST_YEAR = """full_date > (SELECT max(full_date) FROM dat) - INTERVAL 12 MONTH"""


@query(f"department_name:s {SCORE_SHAPE}", _sql(
    f"SELECT department_name, {SCORECARD} FROM wide WHERE {LAST_YEAR} GROUP BY department_name"))
def default_slicer_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = m.star(spark, sf_dir)
    return g.evaluate(star, g.SCORECARD, ["department_name"], last_twelve_months(star))


@query("department_name:s avg_monthly_attrition:d", _sql(f"""
  SELECT department_name, avg(rate) AS avg_monthly_attrition FROM (
    SELECT department_name, month, {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS rate
    FROM wide GROUP BY department_name, month) GROUP BY department_name"""))
def avg_monthly_attrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.average_monthly_attrition(m.star(spark, sf_dir), ["department_name"])


@query("department_name:s departures:i attrition_rate:d avg_tenure_at_departure:d", _sql(f"""
  SELECT department_name, {BLANK_DEPARTED} AS departures,
         {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS attrition_rate,
         sum(tenure_months) FILTER (attrition_flag = 1)::DOUBLE
           / nullif(count(tenure_months) FILTER (attrition_flag = 1), 0) AS avg_tenure_at_departure
  FROM wide GROUP BY department_name"""))
def departure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.evaluate(m.star(spark, sf_dir), ["departures", "attrition_rate", "avg_tenure_at_departure"],
                      ["department_name"])


@query("month:i", _sql("SELECT DISTINCT month FROM wide WHERE department_name = 'BUILDING'"))
def months_with_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.distinct_values(m.star(spark, sf_dir), "month", FilterContext().where(department_name="BUILDING"))


def _long_distribution() -> str:
    parts = []
    for name, column in g.DIMENSION_SWITCH.items():
        parts.append(f"""SELECT department_name, '{name}' AS dimension, {column} AS category, count(*) AS n,
          count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY department_name) AS pct
          FROM wide GROUP BY department_name, {column}""")
        parts.append(f"""SELECT NULL, '{name}', {column}, count(*),
          count(*) * 100.0::DOUBLE / sum(count(*)) OVER () FROM wide GROUP BY {column}""")
    return " UNION ALL ".join(parts)


@query("department_name:s dimension:s category:s n:i pct:d", _sql(_long_distribution()))
def distribution_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.distribution_all(m.star(spark, sf_dir))


@query("department_name:s ethnicity:s n:i total:i pct:d", _sql("""
  SELECT c.department_name, c.ethnicity, c.n, d.total, c.n * 100.0::DOUBLE / d.total AS pct FROM (
    SELECT department_name, ethnicity, count(*) AS n FROM wide
    WHERE ethnicity IN ('ASIA', 'EUROPE', 'AFRICA') AND job_title <> '5-LOW' GROUP BY ALL) c JOIN (
    SELECT department_name, nullif(count(*) FILTER (gender = 'Female' AND salary_band = 'Top'), 0) AS total
    FROM wide WHERE job_title <> '5-LOW' GROUP BY ALL) d USING (department_name)"""))
def distribution_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = (FilterContext().where(ethnicity=["ASIA", "EUROPE", "AFRICA"]).where(gender="Female")
               .where(salary_band="Top").between("job_title", high="5"))
    return g.distribution(m.star(spark, sf_dir), "ethnicity", ["department_name"], context)


@query("department_name:s category:s n:i pct:d", _sql("""
  SELECT department_name, age_group AS category, count(*) AS n,
         count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY department_name) AS pct
  FROM wide GROUP BY department_name, age_group"""))
def distribution_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.selected_distribution(m.star(spark, sf_dir), "Age Group", ["department_name"])


MATRIX = ("Female", "Male", "Non-Binary")


@query("is_total:i department_name:s " + " ".join(f"{v}:d" for v in MATRIX), _sql("""
  SELECT 0 AS is_total, department_name""" + "".join(
    f", nullif(count(*) FILTER (gender = '{v}'), 0) * 100.0::DOUBLE / count(*) AS \"{v}\"" for v in MATRIX)
    + " FROM wide GROUP BY department_name UNION ALL SELECT 1, NULL" + "".join(
    f", nullif(count(*) FILTER (gender = '{v}'), 0) * 100.0::DOUBLE / count(*)" for v in MATRIX)
    + " FROM wide"))
def distribution_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.distribution_matrix(m.star(spark, sf_dir), "gender", MATRIX)


@query("department_name:s year:i category:s share:d previous_share:d change:d", _sql("""
  SELECT coalesce(a.department_name, b.department_name) AS department_name,
         coalesce(a.year, b.year + 1) AS year, coalesce(a.category, b.category) AS category,
         a.share, b.share AS previous_share,
         CASE WHEN b.share IS NOT NULL THEN coalesce(a.share, 0) - b.share END AS change
  FROM shares a FULL JOIN shares b
    ON a.department_name = b.department_name AND a.year = b.year + 1 AND a.category = b.category
  WHERE coalesce(a.year, b.year + 1) IN (SELECT year FROM dat)""", """
shares AS (SELECT department_name, year, age_group AS category, count(*) * 100.0::DOUBLE
    / sum(count(*)) OVER (PARTITION BY department_name, year) AS share
  FROM wide GROUP BY department_name, year, age_group)"""))
def yoy_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.yoy_diversity(m.star(spark, sf_dir), "age_group", ["department_name"])


@query("department_name:s year:i month:i headcount_rolling:i departures_rolling:i attrition_rate_rolling:d "
       "avg_satisfaction_rolling:d", _sql("""
  SELECT department_name, year, month, headcount_rolling, departures_rolling,
         nullif(departures_rolling, 0) * 100.0::DOUBLE / headcount_rolling AS attrition_rate_rolling,
         s::DOUBLE / c AS avg_satisfaction_rolling
  FROM (SELECT department_name, year, month, sum(h) OVER w AS headcount_rolling,
               sum(d) OVER w AS departures_rolling, sum(s) OVER w AS s, sum(c) OVER w AS c
        FROM (SELECT department_name, year, month, sum(headcount) AS h, sum(attrition_flag) AS d,
                     sum(satisfaction_score) AS s, count(satisfaction_score) AS c
              FROM wide GROUP BY department_name, year, month)
        WINDOW w AS (PARTITION BY department_name ORDER BY year * 12 + month
                     RANGE BETWEEN 11 PRECEDING AND CURRENT ROW))"""))
def rolling_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.rolling_months(m.star(spark, sf_dir))


@query("department_name:s year:i month:i measure:s value:d is_min:i is_max:i", _sql("""
  SELECT *, CASE WHEN value = min(value) OVER w THEN 1 ELSE 0 END AS is_min,
         CASE WHEN value = max(value) OVER w THEN 1 ELSE 0 END AS is_max FROM points
  WINDOW w AS (PARTITION BY department_name, measure)""", f"""
months12 AS (SELECT department_name, year, month, sum(headcount)::DOUBLE AS headcount,
  {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS attrition_rate, {_mean('tenure_months')} AS avg_tenure,
  {_mean('satisfaction_score')} AS avg_satisfaction, {BLANK_DEPARTED}::DOUBLE AS open_positions
  FROM wide WHERE {LAST_YEAR} GROUP BY department_name, year, month),
points AS (UNPIVOT months12 ON headcount, attrition_rate, avg_tenure, avg_satisfaction, open_positions
  INTO NAME measure VALUE value)"""))
def sparkline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ignored = FilterContext().between("full_date", dt.date(1999, 1, 1), dt.date(1999, 2, 1))
    return t.sparklines(m.star(spark, sf_dir), context=ignored)


@query("year:i month:i attrition_rate:d reference_rate:d", _sql(f"""
  SELECT *, (SELECT {DEPARTED} * 100.0::DOUBLE / sum(headcount) FROM wide) AS reference_rate
  FROM ({MONTH_RATE} FROM wide GROUP BY year, month)"""))
def trend_with_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.trend_with_reference(m.star(spark, sf_dir))


@query("employee_key:i year:i month:i attrition_probability:d reference:d", with_level("batch", """
  SELECT employee_key, 2000 AS year, 7 AS month, attrition_probability, 0.15 AS reference
  FROM b1 JOIN keys USING (employee_id)
  UNION ALL SELECT employee_key, 2002, 1, attrition_probability, 0.15 FROM stg JOIN keys USING (employee_id)""", """
keys AS (SELECT employee_id, row_number() OVER (ORDER BY hire_date >= DATE '2000-07-01', employee_id)
         AS employee_key FROM stg)"""))
def risk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.risk_history(m.store_of_three_loads(spark, sf_dir).risk_history())


RISK_LEVEL = """CASE WHEN attrition_probability >= 0.30 THEN 'High'
  WHEN attrition_probability >= 0.15 THEN 'Medium' ELSE 'Low' END"""
RISK_SHAPE = ("employee_key:i full_name:s job_title:s tenure_months:d satisfaction_score:d "
              "attrition_probability:d risk_level:s")


@query(RISK_SHAPE, _sql(f"SELECT *, {RISK_LEVEL} AS risk_level FROM wide"))
def risk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.risk_table(m.star(spark, sf_dir), rows=None)


@query(RISK_SHAPE, _sql(f"""SELECT *, {RISK_LEVEL} AS risk_level FROM wide
  WHERE department_name = 'MACHINERY' ORDER BY attrition_probability DESC, employee_key LIMIT 15 OFFSET 15"""))
def risk_table_second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, inside = m.star(spark, sf_dir), FilterContext().where(department_name="MACHINERY")
    rows = p.risk_table(star, inside).collect()
    last = (rows[-1]["attrition_probability"], rows[-1]["employee_key"]) if rows else None
    return p.risk_table(star, inside, after=last)


DEPARTURE_SHAPE = ("employee_key:i full_name:s job_title:s hire_date:s termination_date:s tenure_months:d "
                   "satisfaction_score:d overtime_hours:i salary_band:s")


@query(DEPARTURE_SHAPE, _sql("SELECT * FROM wide WHERE attrition_flag = 1"))
def departure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.departure_records(m.star(spark, sf_dir), rows=None)


@query(DEPARTURE_SHAPE, _sql("""SELECT * FROM wide WHERE attrition_flag = 1 AND department_name = 'BUILDING'
  ORDER BY termination_date DESC, employee_key LIMIT 20"""))
def departures_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.departures_page(m.star(spark, sf_dir), "BUILDING")["records"]


@query("department_name:s job_title:s n:i", _sql("""
  SELECT * EXCLUDE (place) FROM (
    SELECT department_name, job_title, count(*) AS n,
           rank() OVER (PARTITION BY department_name ORDER BY count(*) DESC) AS place
    FROM wide GROUP BY department_name, job_title) WHERE place = 1"""))
def top_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.common_roles(m.star(spark, sf_dir))


@query("band_order:i tenure_band:s headcount:i departures:i attrition_rate:d", _sql(f"""
  SELECT band_order, CASE band_order WHEN 1 THEN '0-12mo' WHEN 2 THEN '13-36mo' WHEN 3 THEN '37-60mo'
           ELSE '60+mo' END AS tenure_band, sum(headcount) AS headcount, {BLANK_DEPARTED} AS departures,
         {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS attrition_rate
  FROM (SELECT *, CASE WHEN tenure_months <= 12 THEN 1 WHEN tenure_months <= 36 THEN 2
                       WHEN tenure_months <= 60 THEN 3 ELSE 4 END AS band_order FROM wide)
  GROUP BY band_order"""))
def tenure_band_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.rate_by_tenure_band(m.star(spark, sf_dir))


@query("department_name:s attrition_status:s satisfaction_status:s risk_status:s above_target:i", _sql(f"""
  SELECT department_name, CASE WHEN a < 10 THEN 'green' WHEN a <= 20 THEN 'yellow' WHEN a > 20 THEN 'red' END
           AS attrition_status,
         CASE WHEN s >= 4 THEN 'green' WHEN s >= 3 THEN 'yellow' ELSE 'red' END AS satisfaction_status,
         CASE WHEN r < 0.15 THEN 'green' WHEN r <= 0.3 THEN 'yellow' ELSE 'red' END AS risk_status,
         CASE WHEN r > 0.15 THEN 1 ELSE 0 END AS above_target
  FROM (SELECT department_name, {BLANK_DEPARTED} * 100.0::DOUBLE / sum(headcount) AS a,
               {_mean('satisfaction_score')} AS s, {_mean('attrition_probability')} AS r
        FROM wide GROUP BY department_name)"""))
def kpi_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.kpi_status(m.star(spark, sf_dir))


@query("l_linestatus:s risk:s band:s n:i", """
  SELECT l_linestatus, CASE WHEN l_discount >= 0.3 THEN 'High' WHEN l_discount >= 0.15 THEN 'Medium'
           ELSE 'Low' END AS risk,
         CASE WHEN l_quantity <= 12 THEN '0-12mo' WHEN l_quantity <= 36 THEN '13-36mo'
              WHEN l_quantity <= 60 THEN '37-60mo' ELSE '60+mo' END AS band, count(*) AS n
  FROM lineitem GROUP BY ALL""")
def band_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.table(spark, sf_dir, "lineitem").groupBy(
        "l_linestatus", bands.risk_level(F.col("l_discount")).alias("risk"),
        bands.tenure_band(F.col("l_quantity")).alias("band")).agg(F.count("*").alias("n"))


@query("employee_key:i full_name:s department_name:s job_title:s city:s region:s tenure_months:d "
       "attrition_probability:d risk_level:s above_target:i promotion_recent:i salary_band:s "
       "satisfaction_score:d overtime_hours:i", _sql(f"""
  SELECT *, {RISK_LEVEL} AS risk_level, CASE WHEN attrition_probability > 0.15 THEN 1 ELSE 0 END AS above_target
  FROM wide"""))
def risk_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.employee_profiles(m.star(spark, sf_dir))


# -- access ----------------------------------------------------------------


def _headed(spark: SparkSession, sf_dir: str) -> Star:
    """The star with a curated head per department: ``<department>@example.com``."""
    star = m.star(spark, sf_dir)
    named = star.dimensions["department"].withColumn(
        "department_head", F.concat(F.lower("department_name"), F.lit("@example.com")))
    return replace(star, dimensions={**star.dimensions, "department": named})


def _mapped(star: Star) -> DataFrame:
    """Ana sees three departments, Ben one."""
    people = (F.when(F.col("department_name") <= "FURNITURE", "ana@example.com")
              .when(F.col("department_name") == "MACHINERY", "ben@example.com"))
    return star.dimensions["department"].select(
        F.col("department_key").alias("map_id"), people.alias("user_email"), "department_key",
        F.lit(MANAGER).alias("role_name")).where("user_email is not null")


@query(f"department_name:s {SCORE_SHAPE}", _sql(
    f"SELECT department_name, {SCORECARD} FROM wide WHERE department_name = 'BUILDING' GROUP BY department_name"))
def rls_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = secure(_headed(spark, sf_dir), "building@example.com", [MANAGER])
    return g.evaluate(seen, g.SCORECARD, ["department_name"])


@query(f"department_name:s {SCORE_SHAPE}", _sql(
    f"SELECT department_name, {SCORECARD} FROM wide GROUP BY department_name"))
def rls_executive(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = secure(_headed(spark, sf_dir), "chief@example.com", [MANAGER, EXECUTIVE])
    return g.evaluate(seen, g.SCORECARD, ["department_name"])


@query(f"department_name:s {SCORE_SHAPE}", _sql(
    f"SELECT department_name, {SCORECARD} FROM wide WHERE false GROUP BY department_name"))
def rls_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = secure(_headed(spark, sf_dir), "building@example.com", ["Intern"])
    return g.evaluate(seen, g.SCORECARD, ["department_name"])


@query(DEPARTURE_SHAPE, _sql("""
  SELECT * FROM wide WHERE attrition_flag = 1 AND department_name <= 'FURNITURE'"""))
def rls_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _headed(spark, sf_dir)
    return p.departure_records(secure(star, "ana@example.com", [MANAGER], _mapped(star)), rows=None)


@query("employee_id:s", _sql("SELECT employee_id FROM emp JOIN wide USING (employee_key) "
                             "WHERE department_name = 'MACHINERY'"))
def rls_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _headed(spark, sf_dir)
    return secure(star, "ben@example.com", [MANAGER], _mapped(star)).dimension("employee")


@query("who:s employee_key:i year:i month:i attrition_probability:d", _sql("""
  SELECT who, employee_key, 2002 AS year, 1 AS month, attrition_probability
  FROM wide JOIN (SELECT * FROM (VALUES ('chief', ''), ('building', 'BUILDING'), ('ana', 'AUTOMOBILE'), ('ana', 'BUILDING'), ('ana', 'FURNITURE')) AS v(who, d))
    ON d = department_name OR d = ''"""))
def rls_risk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk history under each kind of right; a user without a known role sees none."""
    star = _headed(spark, sf_dir)
    seen = {"chief": secure(star, "chief@example.com", [EXECUTIVE]), "building": secure(star, "building@example.com", [MANAGER]),
            "ana": secure(star, "ana@example.com", [MANAGER], _mapped(star)), "intern": secure(star, "building@example.com", ["Intern"])}
    parts = [t.risk_history(s.history).select(F.lit(who).alias("who"), "employee_key", "year", "month", "attrition_probability") for who, s in seen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("who:s has_access:i", """SELECT 'building@example.com' AS who, 1 AS has_access UNION ALL
  SELECT 'nobody@example.com', 0""")
def rls_has_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _headed(spark, sf_dir)
    seen = [has_access(secure(star, who, [MANAGER])).select(F.lit(who).alias("who"), "has_access")
            for who in ("building@example.com", "nobody@example.com")]
    return seen[0].unionByName(seen[1])


# -- models ----------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return m.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("attrition"),
        ((key % 50).cast("double") / 100).alias("score"),
        F.when(key % 50 >= 25, 1.0).otherwise(0.0).alias("prediction"))


@query("accuracy:d precision:d recall:d f1:d auc_roc:d", with_level(None, """
  SELECT (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy, tp::DOUBLE / (tp + fp) AS precision,
         tp::DOUBLE / (tp + fn) AS recall, 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1,
         (rank_sum - (tp + fn) * (tp + fn + 1) / 2.0) / ((tp + fn)::DOUBLE * (fp + tn)) AS auc_roc
  FROM (SELECT count(*) FILTER (y = 1 AND s >= 25) AS tp, count(*) FILTER (y = 0 AND s >= 25) AS fp,
               count(*) FILTER (y = 1 AND s < 25) AS fn, count(*) FILTER (y = 0 AND s < 25) AS tn FROM scored),
       (SELECT sum(pos * (before + (n + 1) / 2.0))::DOUBLE AS rank_sum FROM (
          SELECT pos, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS before
          FROM (SELECT s, count(*) AS n, sum(y) AS pos FROM scored GROUP BY s)))""", """
scored AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_orderkey % 50 AS s FROM orders)"""))
def metrics_from_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    area = exact_auc(scored, "score")
    return class_metrics(confusion(scored)).withColumn("auc_roc", F.lit(area))


@query("part:s rows:i departures:i")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = stratified_split(_scored(spark, sf_dir), "attrition", 0.2, 42, ["o_orderkey"])
    named = parts[0].withColumn("part", F.lit("train")).unionByName(parts[1].withColumn("part", F.lit("test")))
    return named.groupBy("part").agg(F.count("*").alias("rows"), F.sum("attrition").alias("departures"))


@query("attrition:i rows:i in_both:i share_holds:i", """
  SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS attrition, count(*) AS rows, 0 AS in_both,
         1 AS share_holds FROM orders GROUP BY 1""")
def split_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class: all rows are in one part and the test part has a fifth, within four deviations."""
    parts = stratified_split(_scored(spark, sf_dir), "attrition", 0.2, 42, ["o_orderkey"])
    marked = parts[0].withColumn("test", F.lit(0)).unionByName(parts[1].withColumn("test", F.lit(1)))
    per_row = marked.groupBy("o_orderkey", "attrition").agg(
        F.max("test").alias("test"), (F.max("test") - F.min("test")).alias("both"))
    off = F.abs(F.avg("test") - 0.2) <= 4 * F.sqrt(F.lit(0.16) / F.count("*"))
    return per_row.groupBy("attrition").agg(
        F.count("*").alias("rows"), F.sum("both").alias("in_both"), off.cast("int").alias("share_holds"))


_trained: dict = {}


def _training(spark: SparkSession, sf_dir: str):
    """Both models on the encoded table, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trained:
        table = m.featured(spark, sf_dir).drop("src_ordinal", "attrition_probability")
        frame = scratch.saved(encoded_frame(table, m.JOB, skip=["name"]), "model")
        _trained[key] = (train(frame, m.JOB.model), frame)
    return _trained[key]


@query("place:i model_name:s accuracy:d precision:d recall:d f1:d auc_roc:d")
def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir)[0].comparison


@query("position:i feature:s importance:d")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir)[0].importances


@query("position:i feature:s importance:d")
def top_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.top_factors(_training(spark, sf_dir)[0].importances)


@query("employee_id:i attrition:i attrition_probability:d")
def scored_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, frame = _training(spark, sf_dir)
    path = scratch.new_path(spark, "model")
    save_model(result.models[result.best_name], path)
    return score(load_model(path), frame)


@query("property:s holds:i", with_level("cur", """
  SELECT property, 1 AS holds FROM (VALUES ('importances_of_forest_sum_to_one'), ('loaded_model_scores_alike'),
    ('comparison_in_order_of_auc'), ('repeat_fit_is_equal'), ('gradient_is_small'), ('test_rows_by_class')) AS t(property)
  WHERE (SELECT count(*) FROM cur) > 0"""))
def model_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for any fitted models, checked on the whole table."""
    result, frame = _training(spark, sf_dir)
    forest = result.models["random_forest"].stages[-1]
    path = scratch.new_path(spark, "model")
    save_model(result.models["logistic_regression"], path)
    both = score(result.models["logistic_regression"], frame).select("employee_id", F.col("attrition_probability").alias("a")).join(
        score(load_model(path), frame).select("employee_id", F.col("attrition_probability").alias("b")), "employee_id")
    spec = replace(m.JOB.model, algorithms=("logistic_regression",))
    again = train(frame, spec)
    aucs = [r.auc_roc for r in result.comparison.orderBy("place").collect()]
    linear, other = result.models["logistic_regression"].stages[-1], again.models["logistic_regression"].stages[-1]
    training, test = stratified_split(frame, "attrition", spec.test_size, spec.seed, ["employee_id"], exact=True)
    counts = {r.attrition: r.n for r in frame.groupBy("attrition").agg(F.count("*").alias("n")).collect()}
    tested = {r.attrition: r.n for r in test.groupBy("attrition").agg(F.count("*").alias("n")).collect()}
    # The stated objective: mean log loss plus the squared coefficients times half of regParam.
    fitted = result.models["logistic_regression"].transform(training)
    error = (vector_to_array("probability")[1] - F.col("attrition"))
    slopes = fitted.agg(F.count("*").alias("n"), *[F.avg(error * F.col(f"`{c}`")).alias(f"g{i}") for i, c in enumerate(result.features)],
                        *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(result.features)]).first()
    reg = 1.0 / (float(m.JOB.model.params["logistic_regression"].get("C", 1.0)) * slopes.n)
    gradient = max(abs(slopes[f"g{i}"] + reg * float(linear.coefficients[i])) / max(slopes[f"s{i}"], 1.0) for i in range(len(result.features)))
    holds = {
        "importances_of_forest_sum_to_one": abs(sum(forest.featureImportances.toArray()) - 1) < 1e-6,
        "loaded_model_scores_alike": both.where(F.abs(F.col("a") - F.col("b")) > 1e-12).isEmpty(),
        "comparison_in_order_of_auc": aucs == sorted(aucs, reverse=True),
        "repeat_fit_is_equal": bool((abs(linear.coefficients.toArray() - other.coefficients.toArray()) < 1e-9).all()),
        "gradient_is_small": gradient < 0.01,
        "test_rows_by_class": all(abs(tested.get(c, 0) - 0.2 * n) <= 1 for c, n in counts.items()),
    }
    return spark.createDataFrame([(k, int(v)) for k, v in holds.items()], "property string, holds int")


@query("attrition:i rows:i outside:i", with_level("cur", """
  SELECT attrition, count(*) AS rows, 0 AS outside FROM cur GROUP BY attrition"""))
def score_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every employee has a probability from 0 to 1."""
    result, frame = _training(spark, sf_dir)
    inside = F.coalesce(F.col("attrition_probability").between(0, 1), F.lit(False))
    return score(result.models[result.best_name], frame).groupBy("attrition").agg(
        F.count("*").alias("rows"), F.count_if(~inside).alias("outside"))


@query("stage_name:s status:s row_count:i", with_level("cur", """
  SELECT stage_name, 'success' AS status, (SELECT count(*) FROM cur) AS row_count FROM (VALUES
    ('ingestion'), ('transformation'), ('modeling'), ('sql_loading')) AS t(stage_name)"""))
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from a CSV of every record to the published star."""
    source = scratch.new_path(spark, "source")
    m.raw_employees(spark, sf_dir).drop("src_ordinal", "attrition_probability").write.csv(source, header=True)
    done = run_job(spark, m.JOB, source, scratch.new_path(spark, "run"), m.AS_OF)
    return done.audit(spark)
