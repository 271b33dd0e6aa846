import datetime as dt
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rostermart.config import CleanSpec, FeatureSpec, JobSpec
from rostermart.functions import bands
from rostermart.functions.dates import date_parts, dense_calendar
from rostermart.functions.derive import LOGICS, above, bucket_label, feature_logic, months_between_dates
from rostermart.functions.naming import renamed_columns, snake_case, standardize_columns
from rostermart.functions.parsing import parse_date, parse_number
from rostermart.functions.places import place_parts
from rostermart.functions.ratios import percent, safe_divide, tenth_percent
from rostermart.operators.clean import change_log, coerce_types, coercion_log, feature_log, planned_coercions
from rostermart.operators.features import derive_features
from rostermart.operators.latest import drop_repeated_rows

AS_OF = dt.date(2024, 6, 1)


WORD = st.text("abcxyz0189", min_size=1, max_size=6)


@given(st.text(max_size=40))
def test_names_hold_nothing_else_and_stay(text):
    name = snake_case(text)
    assert re.fullmatch("([a-z0-9]+(_[a-z0-9]+)*)?", name)
    assert snake_case(name) == name


@given(st.lists(WORD, min_size=1, max_size=5), st.text("_ -\t", min_size=1, max_size=4), st.text(".$%()/é€", max_size=3))
def test_words_are_joined_and_signs_fall_out(words, between, signs):
    assert snake_case(between + between.join(w[:1].upper() + signs + w[1:] for w in words) + between) == "_".join(words)


def test_standardize(spark):
    df = spark.createDataFrame([("Ines", 7)], "`Cost Centre` string, shift_no int")
    assert standardize_columns(df).columns == ["cost_centre", "shift_no"]
    assert renamed_columns(df) == {"Cost Centre": "cost_centre"}


def test_names_that_meet_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="a_b"):
        standardize_columns(df)


def test_dates(spark):
    texts = ["1998-11-02", "soon", "1998-11", "07/24/1998", "1999-02-29", "1998-1-5", None, "1998-11-02 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(parse_date(F.col("t"))).collect()]
    assert got == [dt.date(1998, 11, 2), *[None] * 7]
    two = df.select(parse_date(F.col("t"), ["yyyy-MM-dd", "MM/dd/yyyy"])).collect()
    assert two[3][0] == dt.date(1998, 7, 24)


def test_numbers(spark):
    texts = {"41": 41.0, " 17.25 ": 17.25, "1e3": 1000.0, "-.5": -0.5, "1d": None, "many": None, "1f": None,
             "0x10": None, "": None, "1_000": None, "+7.": 7.0, "inf": float("inf"), "nan": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["n"] for r in df.withColumn("n", parse_number(F.col("t"))).collect()} == texts


def test_coercion(spark):
    df = spark.createDataFrame(
        [("1998-11-02", "41", "Ines"), ("soon", "many", "Olu"), (None, None, "Tove")],
        "hire_date string, age string, name string")
    typed = coerce_types(df)
    assert dict(typed.dtypes) == {"hire_date": "date", "age": "double", "name": "string"}
    assert {tuple(r) for r in coercion_log(df).collect()} == {
        ("hire_date", "convert_to_datetime", 3, 1), ("age", "convert_to_numeric", 3, 1)}


def test_typed_columns_are_left_alone(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1), 30, 5)], "hire_date date, age int, update_count int")
    assert planned_coercions(df) == []
    assert coercion_log(df).count() == 0


def test_repeats_meet_after_typing(spark):
    df = spark.createDataFrame([("k7", "41"), ("k7", "41.0"), ("k8", "17")], "employee_id string, age string")
    assert drop_repeated_rows(coerce_types(df)).count() == 2
    assert drop_repeated_rows(df).count() == 3


def test_whole_log(spark):
    raw = spark.createDataFrame([("2023-01-15", "30", "A")] * 2, "`Hire Date` string, `Age` string, `Name` string")
    named = standardize_columns(raw)
    specs = [FeatureSpec("old", "age", "threshold", {"threshold": 25})]
    done = derive_features(drop_repeated_rows(coerce_types(named)), specs, AS_OF)
    log = change_log(renamed_columns(raw), coercion_log(named), 2, 1, feature_log(done, specs), "label", ["name"])
    assert {tuple(r) for r in log.collect()} == {
        ("*", "standardize_column_names", 3, 0), ("hire_date", "convert_to_datetime", 2, 0),
        ("age", "convert_to_numeric", 2, 0), ("*", "remove_duplicates", 1, 0),
        ("old", "derive_feature_threshold", 1, 0), ("name", "encode_label", 1, 0)}
    quiet = change_log({}, coercion_log(done), 1, 1, feature_log(done, []), "label", [])
    assert quiet.count() == 0


def test_buckets(spark):
    edges, labels = [0, 25, 35, 45, 55, 100], ["Under 25", "25-34", "35-44", "45-54", "55+"]
    values = {0: "Under 25", 25: "Under 25", 25.5: "25-34", 35: "25-34", 45: "35-44", 55: "45-54", 100: "55+",
              101: None, -1: None, None: None, float("nan"): None}
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")
    got = [r[0] for r in df.select(bucket_label(F.col("v"), edges, labels)).collect()]
    assert got == list(values.values())


def test_flag_and_months(spark):
    df = spark.createDataFrame([(10.0, dt.date(2024, 5, 1)), (10.5, None), (None, dt.date(2020, 2, 29)),
                                (float("nan"), AS_OF)], "h double, d date")
    got = df.select(above(F.col("h"), 10), months_between_dates(F.col("d"), AS_OF)).collect()
    assert [r[0] for r in got] == [0, 1, 0, 0]
    assert [r[1] for r in got] == [round(31 / 30.44, 1), None, round(1554 / 30.44, 1), 0.0]


def test_months_count_whole_days(spark):
    df = spark.sql("select timestamp_ntz'2024-06-01 12:00:00' a, timestamp_ntz'2024-05-01 00:00:00' b, "
                   "timestamp'2024-05-01 08:00:00' c")
    got = df.select(*[months_between_dates(F.col(c), AS_OF) for c in "abc"]).first()
    assert list(got) == [round(-1 / 30.44, 1) + 0.0, round(31 / 30.44, 1), round(30 / 30.44, 1)]


def test_features_in_order_and_skips(spark, caplog):
    specs = CleanSpec(features=(
        FeatureSpec("months", "hire_date", "months_since_hire"),
        FeatureSpec("long", "months", "threshold", {"threshold": 12}),
        FeatureSpec("x", "hire_date", "no_such_logic"),
        FeatureSpec("y", "no_such_column", "threshold", {"threshold": 1}))).features
    df = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2024, 5, 1),)], "hire_date date")
    out = derive_features(df, specs, AS_OF)
    assert out.columns == ["hire_date", "months", "long"]
    assert [r["long"] for r in out.collect()] == [1, 0]
    assert "no_such_logic" in caplog.text and "no_such_column" in caplog.text


def test_a_logic_can_be_added(spark):
    @feature_logic("doubled")
    def doubled(spec, source, as_of):
        return source * 2

    try:
        out = derive_features(spark.createDataFrame([(2,)], "a int"), [FeatureSpec("b", "a", "doubled")], AS_OF)
        assert out.collect() == [(2, 4)]
    finally:
        del LOGICS["doubled"]


def test_places(spark):
    texts = {"Austin, TX, USA": ("Austin", "TX", "USA"), "Austin,TX": ("Austin", "TX", "Unknown"),
             " Austin ": ("Austin", "Unknown", "Unknown"), "a, b, c, d": ("a", "b", "c, d"),
             "": ("", "Unknown", "Unknown"), None: (None, None, None)}
    df = spark.createDataFrame([(t,) for t in texts], "location string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in place_parts(F.col("location")).items()]).collect()]
    assert got == list(texts.values())


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27),), (dt.date(2024, 3, 2),), (None,)], "d date")
    rows = {r["date_key"]: r for r in dense_calendar(df, "d").collect()}
    assert sorted(rows) == [20240227, 20240228, 20240229, 20240301, 20240302]
    leap = rows[20240229]
    assert (leap["is_month_end"], leap["quarter"], leap["month_name"], leap["day_of_week"]) == (1, 1, "February", 5)
    assert rows[20240228]["is_month_end"] == 0
    assert list(date_parts(F.col("d"))) == dense_calendar(df, "d").columns


def test_bands(spark):
    df = spark.createDataFrame([(0.30, 12.0), (0.15, 12.5), (0.1499, 60.0), (None, 60.1)], "p double, m double")
    got = df.select(bands.risk_level(F.col("p")), bands.tenure_band(F.col("m")),
                    bands.attrition_status(F.col("m"))).collect()
    assert [r[0] for r in got] == ["High", "Medium", "Low", "Low"]
    assert [r[1] for r in got] == ["0-12mo", "13-36mo", "37-60mo", "60+mo"]
    assert [r[2] for r in got] == ["yellow", "yellow", "red", "red"]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 8), (0, 4), (5, 0), (2469, 20000)], "a long, b long")
    got = df.select(percent(F.col("a"), F.col("b")), safe_divide(F.col("a"), F.col("b"), 0),
                    tenth_percent(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [12.5, 0.0, None, 12.345]
    assert [r[1] for r in got] == [0.125, 0.0, 0.0, 0.12345]
    assert [r[2] for r in got] == [12.5, 0.0, None, 12.3]


def test_job_from_file(tmp_path):
    import json

    from rostermart.config import DEFAULT_JOB

    path = tmp_path / "job.json"
    path.write_text(json.dumps({**DEFAULT_JOB, "database": {"connection_string": "secret", "staging_table": "s"}}))
    job = JobSpec.from_file(str(path))
    assert job.staging_table == "s" and "secret" not in repr(job)
    assert [f.name for f in job.clean.features] == [
        "tenure_months", "age_group", "salary_band", "overtime_flag", "promotion_recency"]
