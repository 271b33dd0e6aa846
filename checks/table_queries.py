"""Queries for reading, cleaning, features, encodings and quality."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import mapping as m
from checks.base_sql import AS_OF, with_level
from checks.registry import query
from rostermart.functions.naming import standardize_columns
from rostermart.functions.parsing import parse_number
from rostermart.functions.places import place_parts
from rostermart.functions.dates import calendar_rows, dense_calendar
from rostermart.operators.clean import coerce_types, coercion_log, feature_log
from rostermart.operators.encode import bucket_columns, label_encode, model_frame, onehot_encode, onehot_vector
from rostermart.operators.features import derive_features
from rostermart.operators.latest import drop_repeated_rows, keep_latest
from rostermart.operators.nulls import null_counts, null_rows, require_columns, treat_nulls
from rostermart.operators.quality import (
    CountMismatchError, check_rules, class_counts, orphans, repeated_keys, require_rows, require_same_count, with_defaults)
from rostermart.plans.measures import employee_profile
from rostermart.plans.run import first_seen_order, ingest_file, named_and_formats
from rostermart.plans.star import misfits
from rostermart.schemas import Constraints
from rostermart.sources import scratch
from rostermart.sources.employees import read_employees

FEATURE_SHAPE = "employee_id:i tenure_months:d age_group:s salary_band:s overtime_flag:i promotion_recency:d"
EMPLOYEE_SHAPE = ("employee_id:i src_ordinal:i name:s department:s job_role:s hire_date:s age:i gender:s "
                  "ethnicity:s salary:d satisfaction_score:d overtime_hours:i promotion_date:s location:s "
                  "attrition:i")


@query("o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:d o_orderday:s o_orderpriority:s", """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderday,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "csv")
    orders = m.table(spark, sf_dir, "orders").withColumn("o_orderday", F.col("o_orderdate").cast("date"))
    (orders.drop("o_orderdate").withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 7 == 0, "N/A").otherwise(F.col("o_orderpriority")))
     .write.csv(path, header=True))
    text = read_employees(spark, path, ["o_orderkey", "o_custkey", "o_orderday"])
    return text.withColumn("o_totalprice", parse_number(F.col("o_totalprice")))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records with derived nulls in name, department and salary."""
    place = F.col("src_ordinal")
    return m.raw_employees(spark, sf_dir).withColumns({
        "name": F.when(place % 7 != 0, F.col("name")),
        "department": F.when(place % 11 != 0, F.col("department")),
        "salary": F.when(place % 13 != 0, F.col("salary"))})


GAPS = """
gaps AS (SELECT * REPLACE (CASE WHEN src_ordinal % 7 <> 0 THEN name END AS name,
                           CASE WHEN src_ordinal % 11 <> 0 THEN department END AS department,
                           CASE WHEN src_ordinal % 13 <> 0 THEN salary END AS salary) FROM raw)"""
GAP_SHAPE = "src_ordinal:i employee_id:i name:s department:s salary:d promotion_date:s"
GAP_COLUMNS = "src_ordinal, employee_id, name, department, salary, promotion_date"


@query(GAP_SHAPE, with_level("raw", f"""SELECT {GAP_COLUMNS} FROM gaps
  WHERE name IS NOT NULL AND department IS NOT NULL AND salary IS NOT NULL""", GAPS))
def null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treat_nulls(_with_gaps(spark, sf_dir), "drop", m.JOB.ingest.required)


@query(GAP_SHAPE, with_level("raw", """SELECT src_ordinal, employee_id, coalesce(name, '') AS name,
  coalesce(department, '') AS department, coalesce(salary, 0) AS salary, promotion_date FROM gaps""", GAPS))
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treat_nulls(_with_gaps(spark, sf_dir), "fill_default", m.JOB.ingest.required)


@query("src_ordinal:i missing:s", with_level("raw", """
  SELECT src_ordinal, concat_ws(',', CASE WHEN name IS NULL THEN 'name' END,
    CASE WHEN department IS NULL THEN 'department' END, CASE WHEN salary IS NULL THEN 'salary' END) AS missing
  FROM gaps WHERE name IS NULL OR department IS NULL OR salary IS NULL""", GAPS))
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = null_rows(_with_gaps(spark, sf_dir), m.JOB.ingest.required)
    return found.withColumn("missing", F.array_join("null_columns", ","))


@query("column_name:s null_rows:i", with_level("raw", """
  SELECT 'name' AS column_name, count(*) - count(name) AS null_rows FROM gaps
  UNION ALL SELECT 'department', count(*) - count(department) FROM gaps
  UNION ALL SELECT 'salary', count(*) - count(salary) FROM gaps
  UNION ALL SELECT 'promotion_date', count(*) - count(promotion_date) FROM gaps""", GAPS))
def null_count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(_with_gaps(spark, sf_dir), ["name", "department", "salary", "promotion_date"])


@query(EMPLOYEE_SHAPE, with_level("cur", "SELECT * FROM cur"))
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.employees(spark, sf_dir)


@query("user_id:i event_id:i event_type:s value:d", """
  SELECT user_id, event_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
  WHERE nth = 1""")
def dedup_latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(m.table(spark, sf_dir, "events"), "user_id", "ts", [F.col("event_id").desc()])


@query("user_id:i event_type:s", "SELECT DISTINCT user_id, event_type FROM events")
def drop_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_rows(m.table(spark, sf_dir, "events").select("user_id", "event_type"))


def _as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text columns with bad dates and numbers."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    return m.table(spark, sf_dir, "orders").select(
        key.alias("src_ordinal"),
        F.when(key % 9 == 0, "not-a-date").when(key % 9 == 1, "2023-02").when(key % 9 == 2, "01/20/2023")
        .otherwise(day).alias("hire_date"),
        F.when(key % 8 == 0, "unknown").when(key % 8 == 1, "1d").when(key % 8 == 2, " 1e3 ")
        .otherwise(F.col("o_totalprice").cast("string")).alias("salary"),
        F.when(key % 5 != 0, (20 + key % 45).cast("string")).alias("age"))


AS_TEXT = """
typed AS (SELECT o_orderkey AS src_ordinal,
    CASE WHEN o_orderkey % 9 > 2 THEN CAST(o_orderdate AS DATE) END AS hire_date,
    CASE WHEN o_orderkey % 8 = 2 THEN 1000.0 WHEN o_orderkey % 8 > 2 THEN o_totalprice END AS salary,
    CASE WHEN o_orderkey % 5 <> 0 THEN 20 + o_orderkey % 45 END AS age FROM orders)"""


@query("src_ordinal:i hire_date:s salary:d age:d", with_level(None, "SELECT * FROM typed", AS_TEXT))
def coerced_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_types(_as_text(spark, sf_dir))


@query("column_name:s operation:s rows_affected:i values_imputed:i", """
  SELECT 'hire_date' AS column_name, 'convert_to_datetime' AS operation, count(*) AS rows_affected,
         count(*) FILTER (o_orderkey % 9 <= 2) AS values_imputed FROM orders
  UNION ALL SELECT 'salary', 'convert_to_numeric', count(*), count(*) FILTER (o_orderkey % 8 < 2) FROM orders
  UNION ALL SELECT 'age', 'convert_to_numeric', count(*), 0 FROM orders""")
def coercion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coercion_log(_as_text(spark, sf_dir))


@query("order_key:i night_shift_days:i price:d buyer:i", """
  SELECT o_orderkey AS order_key, o_orderkey % 31 AS night_shift_days, o_totalprice AS price,
         o_custkey AS buyer FROM orders""")
def standardized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_columns(m.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order Key"), (F.col("o_orderkey") % 31).alias("Night-Shift  Days"),
        F.col("o_totalprice").alias("price(€)"), F.col("o_custkey").alias(" Buyer% ")))


@query(FEATURE_SHAPE, with_level("feat", "SELECT * FROM feat"))
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.featured(spark, sf_dir)


@query("src_ordinal:i tenure_months:d salary_band:s overtime_flag:i age_group:s", with_level("raw", f"""
  SELECT src_ordinal, round(datediff('day', hire_date, {AS_OF}) / 30.44, 1) AS tenure_months,
    CASE WHEN salary IS NULL THEN NULL WHEN salary <= 40000 THEN 'Entry' WHEN salary <= 60000 THEN 'Mid'
         WHEN salary <= 80000 THEN 'Senior' WHEN salary <= 100000 THEN 'Executive'
         WHEN salary <= 500000 THEN 'Top' END AS salary_band,
    CASE WHEN overtime_hours > 10 THEN 1 ELSE 0 END AS overtime_flag,
    CASE WHEN age <= 25 THEN 'Under 25' WHEN age <= 35 THEN '25-34' WHEN age <= 45 THEN '35-44'
         WHEN age <= 55 THEN '45-54' ELSE '55+' END AS age_group FROM gaps""", GAPS))
def features_of_all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(_with_gaps(spark, sf_dir), m.JOB.clean.features, m.AS_OF)


@query("column_name:s operation:s rows_affected:i values_imputed:i", with_level("feat", """
  SELECT 'tenure_months' AS column_name, 'derive_feature_months_since_hire' AS operation,
         count(tenure_months) AS rows_affected, 0 AS values_imputed FROM feat
  UNION ALL SELECT 'age_group', 'derive_feature_bucket', count(age_group), 0 FROM feat
  UNION ALL SELECT 'salary_band', 'derive_feature_bucket', count(salary_band), 0 FROM feat
  UNION ALL SELECT 'overtime_flag', 'derive_feature_threshold', count(overtime_flag), 0 FROM feat
  UNION ALL SELECT 'promotion_recency', 'derive_feature_months_since_event', count(promotion_recency), 0
  FROM feat"""))
def feature_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_log(m.featured(spark, sf_dir), m.JOB.clean.features)


CODED = ("name", "department", "job_role", "gender", "ethnicity", "location")


def _first_seen(column: str) -> str:
    return f"""
code_{column} AS (SELECT {column}, row_number() OVER (ORDER BY first) - 1 AS code FROM (
  SELECT {column}, min(place) AS first FROM (
    SELECT {column}, row_number() OVER (ORDER BY hire_date DESC, employee_id) AS place FROM feat)
  GROUP BY {column}))"""


CODES_SQL = "SELECT f.employee_id" + "".join(f", code_{c}.code AS {c}" for c in CODED)
CODED_FROM = " FROM feat f " + " ".join(f"JOIN code_{c} ON code_{c}.{c} = f.{c}" for c in CODED)


@query("employee_id:i " + " ".join(f"{c}:i" for c in CODED),
       with_level("feat", CODES_SQL + CODED_FROM, *[_first_seen(c) for c in CODED]))
def label_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_encode(m.featured(spark, sf_dir), CODED, first_seen_order(m.JOB))


GENDERS = ("Female", "Male", "Non-Binary")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ONEHOT = [("gender", v) for v in GENDERS] + [("department", v) for v in SEGMENTS]


@query("src_ordinal:i " + " ".join(f"{c}_{v}:i" for c, v in ONEHOT), with_level(
    "raw", "SELECT src_ordinal, " + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, v in ONEHOT) + " FROM gaps", GAPS))
def onehot_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_gaps(spark, sf_dir).select("src_ordinal", "gender", "department")
    return onehot_encode(rows, ["gender", "department"])


@query("column_name:s ones:i", """
  SELECT 'buyer_b' || CAST(o_custkey % 997 AS VARCHAR) AS column_name, count(*) AS ones FROM orders GROUP BY ALL""")
def onehot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Far more than 200 values in one column; each becomes a column, summed here."""
    rows = m.table(spark, sf_dir, "orders").select(F.concat(F.lit("b"), F.col("o_custkey") % 997).alias("buyer"))
    wide = onehot_encode(rows, ["buyer"])
    sums = wide.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in wide.columns])
    return sums.unpivot([], wide.columns, "column_name", "ones")


@query("order_key:i buyer_width:i buyer_place:i priority_place:i ones:i", """
  WITH texts AS (SELECT o_orderkey, 'o' || CAST(o_orderkey AS VARCHAR) AS buyer, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS priority FROM orders)
  SELECT o_orderkey AS order_key, (SELECT count(DISTINCT buyer) FROM texts) AS buyer_width, dense_rank() OVER (ORDER BY buyer) - 1 AS buyer_place,
    CASE WHEN priority IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY priority NULLS LAST) - 1 END AS priority_place,
    CASE WHEN priority IS NULL THEN 1 ELSE 2 END AS ones FROM texts""")
def onehot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value for every row, and a column with nulls: where each row's sparse vectors hold their one."""
    rows = m.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.concat(F.lit("o"), "o_orderkey").alias("buyer"),
        F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("priority"))
    parts = onehot_vector(rows, ["buyer", "priority"]).select(
        "order_key", *[F.from_json(F.to_json(F.struct(F.col(f"{c}_vec").alias("v"))), "v struct<size:int,indices:array<int>>")["v"].alias(c)
                       for c in ("buyer", "priority")])
    place = lambda c: F.coalesce(F.get(f"{c}.indices", F.lit(0)), F.lit(-1))
    return parts.select("order_key", F.col("buyer.size").alias("buyer_width"), place("buyer").alias("buyer_place"),
                        place("priority").alias("priority_place"), (F.size("buyer.indices") + F.size("priority.indices")).alias("ones"))


@query("column_name:s misfits:i", """
  SELECT 'salary' AS column_name, count(*) AS misfits FROM orders WHERE o_totalprice * 100000 >= 9999999999.995
  UNION ALL SELECT 'satisfaction_score', count(*) FROM orders WHERE o_custkey % 200 >= 100""")
def staging_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that the staging columns cannot hold are counted, not lost."""
    rows = m.table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") * 100000).cast("double").alias("salary"), (F.col("o_custkey") % 200).alias("satisfaction_score"),
        F.col("o_orderpriority").alias("job_role"))
    return spark.createDataFrame(list(misfits(rows).items()), "column_name string, misfits long")


@query("form:s lines:i failed:i", """
  SELECT 'short' AS form, count(*) AS lines, 0 AS failed FROM orders UNION ALL SELECT 'long', count(*), 1 FROM orders""")
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files with headers: lines with too few cells are filled, one line with too many in a late file fails the read."""
    orders = m.table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    found = []
    for form, odd in (("short", F.col("o_orderkey") % 3 == 0), ("long", F.col("o_orderkey") == last)):
        cells = F.concat_ws(",", "o_orderpriority", "o_custkey")
        line = F.when(odd, F.col("o_orderpriority") if form == "short" else F.concat(cells, F.lit(",more"))).otherwise(cells)
        path = scratch.new_path(spark, f"csv-{form}")
        # No quotes: the commas of a line are its cells; the header is that of the one column.
        lines = orders.repartitionByRange(12, "o_orderkey").sortWithinPartitions("o_orderkey").select(line.alias("name,key"))
        lines.write.option("header", True).option("quote", "\u0000").option("sep", "\u0001").csv(path)
        try:
            read = read_employees(spark, path, form="csv").agg(F.count("name").alias("n")).first()["n"]
            found.append((form, read, 0))
        except Exception as error:  # the message says which line
            if "More than 2 cells" not in str(error):
                raise
            found.append((form, orders.count(), 1))
    return spark.createDataFrame(found, "form string, lines long, failed int")


@query("employee_id:i bonus_points:d team_size:i badge:s kinds:s", with_level("cur", """
  SELECT employee_id, CASE WHEN src_ordinal % 9 <> 0 THEN (src_ordinal % 1000) * 0.25 END AS bonus_points, src_ordinal % 17 AS team_size,
    CASE WHEN employee_id = (SELECT min(employee_id) FROM cur) THEN 'none yet' ELSE CAST(src_ordinal AS VARCHAR) END AS badge,
    'double bigint string' AS kinds FROM cur"""))
def run_extra_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that no job names: numbers with gaps, whole numbers, and digits with one text among them."""
    people, source = scratch.saved(m.employees(spark, sf_dir), "people"), scratch.new_path(spark, "source")
    first, place = people.agg(F.min("employee_id")).first()[0], F.col("src_ordinal")
    people.withColumns({
        "Bonus Points": F.when(place % 9 != 0, (place % 1000) * 0.25), "Team-Size": place % 17,
        "Badge": F.when(F.col("employee_id") == first, "none yet").otherwise(place.cast("string")),
    }).drop("src_ordinal", "attrition_probability").write.csv(source, header=True)
    named, options = named_and_formats(ingest_file(spark, m.JOB, source), m.JOB)
    typed, asked = coerce_types(named, **options), ["bonus_points", "team_size", "badge"]
    kinds = dict(typed.dtypes)
    return typed.select("employee_id", *asked, F.lit(" ".join(kinds[c] for c in asked)).alias("kinds"))


@query("employee_id:i hire_date:s promotion_date:s review_date:s lost:i", with_level("cur", """
  SELECT employee_id, hire_date, promotion_date, CASE WHEN iso = (SELECT iso FROM first) THEN review END AS review_date,
    (SELECT count(*) FROM t WHERE iso <> (SELECT iso FROM first)) AS lost FROM t""", """
t AS (SELECT *, hire_date + CAST(src_ordinal % 300 AS INT) AS review, src_ordinal % 3 = 0 AS iso FROM cur)""", """
first AS (SELECT iso FROM t ORDER BY strftime(hire_date, '%m/%d/%Y') DESC, CAST(employee_id AS VARCHAR) DESC LIMIT 1)"""))
def run_us_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates month first, dates with dots, and a column of two formats, whose first row decides."""
    source, review = scratch.new_path(spark, "source"), F.expr("date_add(hire_date, cast(src_ordinal % 300 as int))")
    m.employees(spark, sf_dir).withColumns({
        "Hire Date": F.date_format("hire_date", "MM/dd/yyyy"), "Promotion Date": F.date_format("promotion_date", "dd.MM.yyyy"),
        "Review Date": F.when(F.col("src_ordinal") % 3 == 0, F.date_format(review, "yyyy-MM-dd")).otherwise(F.date_format(review, "M/d/yyyy")),
    }).drop("hire_date", "promotion_date", "src_ordinal", "attrition_probability").write.csv(source, header=True)
    ingest = dataclasses.replace(m.JOB.ingest, latest_by="Hire Date", required=("employee_id", "Hire Date"))
    job = dataclasses.replace(m.JOB, ingest=ingest)
    named, options = named_and_formats(ingest_file(spark, job, source), job)
    lost = coercion_log(named, **options).where("column_name = 'review_date'").first()["values_imputed"]
    return coerce_types(named, **options).select("employee_id", "hire_date", "promotion_date", "review_date", F.lit(lost).alias("lost"))


@query("employee_id:i department:i age:i salary:d age_group:i salary_band:i promotion_recency:d attrition:i",
       with_level("feat", """SELECT f.employee_id, code_department.code AS department, age, salary,
  CASE age_group WHEN 'Under 25' THEN 0 WHEN '25-34' THEN 1 WHEN '35-44' THEN 2 WHEN '45-54' THEN 3
       WHEN '55+' THEN 4 ELSE -1 END AS age_group,
  CASE salary_band WHEN 'Entry' THEN 0 WHEN 'Mid' THEN 1 WHEN 'Senior' THEN 2 WHEN 'Executive' THEN 3
       WHEN 'Top' THEN 4 ELSE -1 END AS salary_band,
  coalesce(promotion_recency, 0) AS promotion_recency, attrition
  FROM feat f JOIN code_department ON code_department.department = f.department""", _first_seen("department")))
def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = label_encode(m.featured(spark, sf_dir), ["department"], first_seen_order(m.JOB))
    return model_frame(coded, bucket_columns(m.JOB.clean.features))


@query("c_custkey:i city:s state:s country:s", with_level(None, """
  SELECT c_custkey, CASE n_nationkey % 5 WHEN 4 THEN '' ELSE n_name END AS city,
    CASE WHEN n_nationkey % 5 IN (1, 2, 3) THEN r_name ELSE 'Unknown' END AS state,
    CASE n_nationkey % 5 WHEN 2 THEN 'EARTH' WHEN 3 THEN 'EARTH, SOL' ELSE 'Unknown' END AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""))
def parse_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation, region = F.col("n_nationkey"), F.col("n_name"), F.col("r_name")
    joined = m.table(spark, sf_dir, "customer").join(
        m.table(spark, sf_dir, "nation"), F.col("c_nationkey") == key).join(
        m.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    text: Column = (
        F.when(key % 5 == 0, nation).when(key % 5 == 1, F.concat(nation, F.lit(", "), region))
        .when(key % 5 == 2, F.concat(nation, F.lit(" , "), region, F.lit(", EARTH")))
        .when(key % 5 == 3, F.concat(nation, F.lit(","), region, F.lit(",EARTH, SOL"))).otherwise(""))
    return joined.select("c_custkey", *[c.alias(n) for n, c in place_parts(text).items()])


DATE_SHAPE = "date_key:i full_date:s year:i quarter:i month:i month_name:s day_of_week:i is_month_end:i"
DATE_SQL = """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, dayofweek(d) + 1 AS day_of_week,
  CASE WHEN last_day(d) = d THEN 1 ELSE 0 END AS is_month_end FROM """


@query(DATE_SHAPE, DATE_SQL + "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = m.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return calendar_rows(days, "day")


@query(DATE_SHAPE, DATE_SQL + """(SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
  INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = m.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return dense_calendar(days, "day")


@query("rule:s violations:i", """
  SELECT 'not_null:o_orderkey' AS rule, count(*) - count(o_orderkey) AS violations FROM orders
  UNION ALL SELECT 'not_null:label', count(*) FILTER (o_orderkey % 10 = 0) FROM orders
  UNION ALL SELECT 'max_length:o_orderpriority', count(*) FILTER (length(o_orderpriority) > 6) FROM orders
  UNION ALL SELECT 'decimal:o_totalprice', count(*) FILTER (round(o_totalprice, 2) >= 100000) FROM orders
  UNION ALL SELECT 'between:month', count(*) FILTER (month(o_orderdate) NOT BETWEEN 1 AND 11) FROM orders
  UNION ALL SELECT 'unique:o_custkey', (SELECT count(*) FROM (
      SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1))
  UNION ALL SELECT 'foreign_key:l_suppkey', (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (
      SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3))""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = m.table(spark, sf_dir, "orders").withColumns({
        "month": F.month("o_orderdate"),
        "label": F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority"))})
    rows = check_rules(orders, Constraints(
        required=("o_orderkey", "label"), max_length={"o_orderpriority": 6},
        decimals={"o_totalprice": (7, 2)}, between={"month": (1, 11)}))
    repeats = repeated_keys(orders, ["o_custkey"]).agg(F.count("*").alias("violations")).select(
        F.lit("unique:o_custkey").alias("rule"), "violations")
    suppliers = m.table(spark, sf_dir, "supplier").where("s_nationkey <> 3")
    lost = orphans(m.table(spark, sf_dir, "lineitem"), "l_suppkey", suppliers, "s_suppkey").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).select(
        F.lit("foreign_key:l_suppkey").alias("rule"), "violations")
    return rows.unionByName(repeats).unionByName(lost)


@query("o_orderkey:i o_orderpriority:s region:s", """
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'none' ELSE o_orderpriority END AS o_orderpriority, 'Unknown' AS region FROM orders""")
def defaults_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in a column and a column that is not there get their default."""
    rows = m.table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")))
    return with_defaults(rows, {"o_orderpriority": "none", "region": "Unknown"})


@query("label:i rows:i", "SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, count(*) AS rows FROM orders GROUP BY ALL")
def label_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.from_orders(m.table(spark, sf_dir, "orders"))
    return spark.createDataFrame(list(class_counts(rows, "attrition").items()), "label int, rows long")


@query("refused:s because:s", """
  SELECT 'columns' AS refused, 'Missing required columns: badge, o_week' AS because
  UNION ALL SELECT 'empty', 'No rows in orders of status X; the load is given up'
  UNION ALL SELECT 'counts', 'orders: ' || count(*) || ' rows sent, ' || count(*) FILTER (o_orderstatus = 'F') || ' stored' FROM orders
  UNION ALL SELECT 'label', 'o_custkey is neither 0 nor 1 in ' || count(*) FILTER (o_custkey NOT IN (0, 1)) || ' rows' FROM orders
  UNION ALL SELECT 'path', 'there is no such file'""")
def refused_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks of inputs say about the orders."""
    orders, nowhere = m.table(spark, sf_dir, "orders"), scratch.new_path(spark, "nowhere")
    done = orders.where("o_orderstatus = 'F'")
    cases = {
        "columns": lambda: require_columns(orders, ["o_week", "o_orderkey", "badge"]),
        "empty": lambda: require_rows(orders.where("o_orderstatus = 'X'"), "orders of status X"),
        "counts": lambda: require_same_count(orders.count(), done.count(), "orders"),
        "label": lambda: class_counts(orders, "o_custkey"),
        "path": lambda: read_employees(spark, nowhere)}
    found = []
    for name, check in cases.items():
        try:
            check()
        except FileNotFoundError as error:
            found.append((name, "there is no such file" if str(error) == nowhere else str(error)))
        except (ValueError, CountMismatchError) as error:
            found.append((name, str(error)))
    return spark.createDataFrame(found, "refused string, because string")


def _described(column: str) -> str:
    parts = {"count": f"CAST(count({column}) AS DOUBLE)", "mean": f"sum({column})::DOUBLE / count({column})",
             "std": f"stddev_samp({column}::DOUBLE)", "min": f"min({column})::DOUBLE",
             "max": f"max({column})::DOUBLE", "25%": f"quantile_cont({column}::DOUBLE, 0.25)",
             "50%": f"quantile_cont({column}::DOUBLE, 0.5)", "75%": f"quantile_cont({column}::DOUBLE, 0.75)"}
    return " UNION ALL ".join(
        f"SELECT 'describe' AS section, '{column}' AS item, '{k}' AS metric, {v} AS value FROM stg"
        for k, v in parts.items())


@query("section:s item:s metric:s value:d", with_level("stg", f"""
  SELECT 'overall' AS section, '' AS item, 'attrition_rate' AS metric,
         sum(attrition)::DOUBLE / count(*) AS value FROM stg
  UNION ALL SELECT 'overall', '', 'promotion_rate', count(promotion_date)::DOUBLE / count(*) FROM stg
  UNION ALL SELECT 'department', department, 'rows', count(*)::DOUBLE FROM stg GROUP BY department
  UNION ALL {_described('salary')} UNION ALL {_described('satisfaction_score')}"""))
def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_profile(scratch.saved(m.staging(spark, sf_dir), "staging"))
