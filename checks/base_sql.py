"""The SQL side of the mapping: common table expressions that each query picks from."""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"
FIRST_AS_OF = "DATE '2000-07-01'"
FIRST_BATCH_END = "DATE '2000-07-01'"

RAW = """
raw AS (
  SELECT o.o_custkey AS employee_id, o.o_orderkey AS src_ordinal, c.c_name AS name,
         c.c_mktsegment AS department, o.o_orderpriority AS job_role,
         CAST(o.o_orderdate AS DATE) AS hire_date, CAST(20 + c.c_custkey % 45 AS INT) AS age,
         CASE c.c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Non-Binary' END AS gender,
         r.r_name AS ethnicity, o.o_totalprice AS salary,
         CAST(10 + o.o_orderkey % 41 AS DOUBLE) / 10 AS satisfaction_score,
         CAST(o.o_orderkey % 31 AS INT) AS overtime_hours,
         CASE WHEN o.o_orderkey % 5 < 2
              THEN CAST(o.o_orderdate + INTERVAL '400' DAY AS DATE) END AS promotion_date,
         CASE n.n_nationkey % 3 WHEN 0 THEN n.n_name
              WHEN 1 THEN concat(n.n_name, ', ', r.r_name)
              ELSE concat(n.n_name, ', ', r.r_name, ', EARTH') END AS location,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS attrition,
         CAST(o.o_orderkey % 50 AS DOUBLE) / 100 AS attrition_probability
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CUR = """
cur AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY hire_date DESC, src_ordinal DESC) AS nth
    FROM raw) WHERE nth = 1)"""


def months(day: str, as_of: str = AS_OF) -> str:
    return f"round(datediff('day', {day}, {as_of}) / 30.44, 1)"


FEAT = f"""
feat AS (
  SELECT *, {months('hire_date')} AS tenure_months,
    CASE WHEN age < 0 OR age > 100 THEN NULL WHEN age <= 25 THEN 'Under 25' WHEN age <= 35 THEN '25-34'
         WHEN age <= 45 THEN '35-44' WHEN age <= 55 THEN '45-54' ELSE '55+' END AS age_group,
    CASE WHEN salary < 0 OR salary > 500000 THEN NULL WHEN salary <= 40000 THEN 'Entry'
         WHEN salary <= 60000 THEN 'Mid' WHEN salary <= 80000 THEN 'Senior'
         WHEN salary <= 100000 THEN 'Executive' ELSE 'Top' END AS salary_band,
    CASE WHEN overtime_hours > 10 THEN 1 ELSE 0 END AS overtime_flag,
    {months('promotion_date')} AS promotion_recency
  FROM cur)"""

STG = """
stg AS (
  SELECT CAST(employee_id AS VARCHAR) AS employee_id, name, department, job_role, hire_date, age, gender,
         ethnicity, CAST(salary AS DECIMAL(12,2)) AS salary,
         CAST(satisfaction_score AS DECIMAL(4,2)) AS satisfaction_score, overtime_hours, promotion_date,
         location, attrition, CAST(tenure_months AS DECIMAL(6,2)) AS tenure_months, age_group, salary_band,
         overtime_flag, CAST(promotion_recency AS DECIMAL(6,1)) AS promotion_recency,
         CAST(attrition_probability AS DECIMAL(5,4)) AS attrition_probability,
         trim(string_split(location, ',')[1]) AS city,
         CASE WHEN location LIKE '%,%' THEN trim(string_split(location, ',')[2]) ELSE 'Unknown' END AS state,
         CASE WHEN location LIKE '%,%,%'
              THEN trim(substr(location, length(string_split(location, ',')[1])
                                         + length(string_split(location, ',')[2]) + 3))
              ELSE 'Unknown' END AS country,
         CAST(strftime(hire_date, '%Y%m%d') AS INT) AS date_key
  FROM feat)"""

DIMS = f"""
dep AS (SELECT row_number() OVER (ORDER BY department) AS department_key, department AS department_name,
               'TBD' AS department_head, 'TBD' AS cost_center FROM (SELECT DISTINCT department FROM stg)),
job AS (SELECT row_number() OVER (ORDER BY job_role) AS job_role_key, job_role AS job_title,
               'Standard' AS job_level, 'General' AS job_family FROM (SELECT DISTINCT job_role FROM stg)),
loc AS (SELECT row_number() OVER (ORDER BY city, state, country) AS location_key, city, state, country,
               'Unknown' AS region FROM (SELECT DISTINCT city, state, country FROM stg)),
emp AS (SELECT row_number() OVER (ORDER BY employee_id) AS employee_key, employee_id, name AS full_name,
               gender, ethnicity, age_group, hire_date,
               CASE WHEN attrition = 1 THEN {AS_OF} END AS termination_date, salary_band,
               CASE WHEN promotion_date IS NOT NULL THEN 1 ELSE 0 END AS promotion_recent FROM stg),
dat AS (SELECT DISTINCT date_key, hire_date AS full_date, year(hire_date) AS year,
               quarter(hire_date) AS quarter, month(hire_date) AS month, monthname(hire_date) AS month_name,
               dayofweek(hire_date) + 1 AS day_of_week,
               CASE WHEN last_day(hire_date) = hire_date THEN 1 ELSE 0 END AS is_month_end FROM stg)"""

FACT = """
fact AS (
  SELECT row_number() OVER (ORDER BY s.date_key, e.employee_key) AS metric_id, e.employee_key,
         d.department_key, j.job_role_key, l.location_key, s.date_key, s.attrition AS attrition_flag,
         1 AS headcount, s.tenure_months, s.satisfaction_score, s.attrition_probability, s.salary,
         s.overtime_hours
  FROM stg s JOIN emp e ON e.employee_id = s.employee_id JOIN dep d ON d.department_name = s.department
  JOIN job j ON j.job_title = s.job_role JOIN loc l ON l.city = s.city AND l.state = s.state
       AND l.country = s.country)"""

# Facts with all dimension columns, for the measures.
WIDE = """
wide AS (
  SELECT f.*, d.department_name, j.job_title, l.city, l.state, l.country, l.region, e.full_name, e.gender,
         e.ethnicity, e.age_group, e.hire_date, e.termination_date, e.salary_band, e.promotion_recent,
         t.full_date, t.year, t.month
  FROM fact f JOIN dep d USING (department_key) JOIN job j USING (job_role_key)
  JOIN loc l USING (location_key) JOIN emp e USING (employee_key) JOIN dat t USING (date_key))"""

# The part of stg in the first of two loads.
BATCH = f"""
b1 AS (SELECT * FROM stg WHERE hire_date < {FIRST_BATCH_END})"""

LEVELS = {
    "raw": [RAW],
    "cur": [RAW, CUR],
    "feat": [RAW, CUR, FEAT],
    "stg": [RAW, CUR, FEAT, STG],
    "batch": [RAW, CUR, FEAT, STG, BATCH],
    "dims": [RAW, CUR, FEAT, STG, DIMS],
    "fact": [RAW, CUR, FEAT, STG, DIMS, FACT],
    "wide": [RAW, CUR, FEAT, STG, DIMS, FACT, WIDE],
}


def with_level(level: str | None, body: str, *extra: str) -> str:
    """``body`` after the expressions of ``level`` and any of its own."""
    parts = [*(LEVELS[level] if level else []), *extra]
    return ("WITH " + ",".join(parts) + "\n" if parts else "") + body
