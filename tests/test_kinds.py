import copy
import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from rostermart.config import DEFAULT_JOB, JobSpec
from rostermart.operators.clean import coerce_types, coercion_log
from rostermart.operators.kinds import (
    INTEGER, NUMBER, date_formats, number_kinds, number_metrics, with_numbers)
from rostermart.plans.run import ingest_file, named_and_formats
from tests.conftest import plan_of


def kinds_of(df):
    return number_kinds(df.columns, df.agg(*number_metrics(df.columns)).first().asDict())


def texts(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{n}` string" for n in names))


def test_a_column_is_what_all_its_values_are(spark):
    df = texts(spark, whole=["4", " -12 ", None], part=["4", "1e3", None], word=["4", "1.5", "n. a."],
               none=[None, None, None], long=["1", "9" * 19, None], **{"with blank": ["7", "8", "+9"]})
    kinds = kinds_of(df)
    assert kinds == {"whole": INTEGER, "part": NUMBER, "long": NUMBER, "with blank": INTEGER}
    typed = with_numbers(df, kinds)
    assert dict(typed.dtypes) == {"whole": "bigint", "part": "double", "word": "string", "none": "string",
                                  "long": "double", "with blank": "bigint"}
    assert [r["whole"] for r in typed.collect()] == [4, -12, None]


def test_an_empty_table_has_no_numbers(spark):
    assert kinds_of(texts(spark, a=["1"]).where("false")) == {}


@pytest.mark.parametrize(("values", "chosen"), [
    (["2021-03-04", None], "yyyy-MM-dd"), (["03/04/2021", "3/25/2021"], "M/d/yyyy"), (["03/04/2021", "25/3/2021"], "d/M/yyyy"),
    (["03/04/2021", "05/06/2021"], "M/d/yyyy"), (["4.3.2021"], "d.M.yyyy"), (["2021-03-04 10:11:12"], "yyyy-MM-dd HH:mm:ss"),
    (["02/30/2021"], "yyyy-MM-dd"), ([None], "yyyy-MM-dd")])
def test_date_format_that_all_values_fit(spark, values, chosen):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, day_date string")
    assert date_formats(df, ["day_date"], ["n"]) == {"day_date": (chosen,)}


def test_the_first_row_decides_over_mixed_formats(spark):
    rows = [(9, None), (8, "12/31/2020"), (7, "2020-12-30"), (6, "31.12.2020"), (5, "12/29/2020")]
    df = spark.createDataFrame(rows, "n int, day_date string").repartition(3)
    options = {"date_formats": date_formats(df, ["day_date"], ["n"])}
    got = {r["n"]: r["day_date"] for r in coerce_types(df, **options).collect()}
    assert got == {9: None, 8: dt.date(2020, 12, 31), 7: None, 6: None, 5: dt.date(2020, 12, 29)}
    assert coercion_log(df, **options).collect() == [("day_date", "convert_to_datetime", 5, 2)]


def test_all_columns_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("cast(id as string) a", "cast(id as string) b", "cast(id as string) c").write.parquet(path)
    df = spark.read.parquet(path)
    assert plan_of(df.agg(*number_metrics(df.columns))).count("FileScan") == 1


def job(**transformation):
    spec = copy.deepcopy(DEFAULT_JOB)
    spec["ingestion"] |= {"required_columns": ["id", "Start Date"], "dedup_key": "id", "dedup_sort": "Start Date"}
    spec["transformation"] |= transformation
    return JobSpec.from_mapping(spec)


@pytest.fixture
def source(tmp_path):
    # The row without a date goes; its points are read all the same. The older row of 02 goes, too.
    path = tmp_path / "in.csv"
    path.write_text("id,Start Date,Points,Age,Note\n01,02/03/2021,5,31,a\n02,12/25/2021,,32,7\n02,01/25/2021,6.5,x,8\n03,,8,33,9\n")
    return str(path)


@pytest.mark.parametrize("strategy", ["drop", "fill_default"])
def test_a_job_finds_numbers_and_date_formats(spark, source, strategy):
    spec = job()
    spec = dataclasses.replace(spec, ingest=dataclasses.replace(
        spec.ingest, null_strategy=strategy, required=(*spec.ingest.required, "Points") if strategy == "fill_default" else spec.ingest.required))
    found = ingest_file(spark, spec, source)
    assert found.kinds == {"Points": NUMBER}
    named, options = named_and_formats(found, spec)
    rows = {r["id"]: (r["start_date"], r["points"], r["age"], r["note"]) for r in coerce_types(named, **options).collect()}
    wanted = {"01": (dt.date(2021, 2, 3), 5.0, 31.0, "a"), "02": (dt.date(2021, 12, 25), None, 32.0, "7")}
    if strategy == "fill_default":
        # An empty text, which the fill leaves, is no date of any format, so the latest row decides.
        wanted = {"01": wanted["01"], "02": (dt.date(2021, 12, 25), 0.0, 32.0, "7"), "03": (None, 8.0, 33.0, "9")}
    assert rows == wanted


def test_a_job_may_name_formats_and_number_columns(spark, source):
    spec = job(infer_numbers=False, number_columns=["note", "age"], date_formats=["dd/MM/yyyy"])
    found = ingest_file(spark, spec, source)
    assert found.kinds == {}
    named, options = named_and_formats(found, spec)
    rows = coerce_types(named, **options)
    assert dict(rows.dtypes)["points"] == "string"
    assert {(r["id"], r["start_date"], r["note"]) for r in rows.collect()} == {("01", dt.date(2021, 3, 2), None), ("02", None, 7.0)}
    lost = {r["column_name"]: r["values_imputed"] for r in coercion_log(named, **options).collect()}
    assert lost == {"start_date": 1, "note": 1, "age": 0}
    assert found.table.where(F.col("id") == "03").count() == 0
