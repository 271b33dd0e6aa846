import datetime as dt
import random

import pytest

from rostermart.functions.parsing import NULL_TOKENS
from rostermart.operators.latest import keep_latest
from rostermart.operators.nulls import (
    MissingColumnsError, null_counts, null_rows, require_columns, treat_nulls)
from rostermart.sources.employees import read_employees, with_row_index
from tests.conftest import plan_of

REQUIRED = ["employee_id", "name", "department", "hire_date"]


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def records(seed, rows, gap=0.0, keys=None):
    """Random records, with a share of empty cells in any column; few ``keys`` repeat."""
    rng, base = random.Random(seed), dt.date(1990, 1, 1)
    made = []
    for i in range(rows):
        cells = [f"k{rng.randrange(keys) if keys else i}", f"n{rng.randrange(50)}", rng.choice(["Kiln", "Harbour", "Foundry"]),
                 str(base + dt.timedelta(days=i * 37 % 9973)), f"s{i}"]
        made.append([None if rng.random() < gap else c for c in cells])
    return made


def as_csv(made):
    return "\n".join([",".join([*REQUIRED, "shift"]), *[",".join(c or "" for c in row) for row in made]]) + "\n"


def test_cells_are_read_as_they_are(spark, csv):
    made = records(3, 300, gap=0.1)
    df = read_employees(spark, csv(as_csv(made)), REQUIRED)
    assert df.columns == [*REQUIRED, "shift"] and {t for _, t in df.dtypes} == {"string"}
    assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, made), key=str)


def test_missing_columns_are_named_in_order(spark, csv):
    with pytest.raises(MissingColumnsError) as error:
        read_employees(spark, csv("employee_id,shift\nk7,early\n"), REQUIRED)
    assert error.value.missing_columns == ["department", "hire_date", "name"]
    assert "department, hire_date, name" in str(error.value)


def test_required_columns_are_raw_names(spark, csv):
    df = read_employees(spark, csv("employee_id,Hire Date\n1,2020-01-01\n"))
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["hire_date"])


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_employees(spark, str(tmp_path / "nowhere.csv"), REQUIRED)


def test_lines_with_other_numbers_of_cells(spark, csv):
    assert read_employees(spark, csv("a,b,c\n1\n2,3\n4,5,6\n")).collect() == [("1", None, None), ("2", "3", None), ("4", "5", "6")]
    with pytest.raises(Exception, match="More than 2 cells"):
        read_employees(spark, csv("a,b\n1,2\n3,4,5\n", "wide.csv")).select("a").collect()


def test_form_is_an_argument(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) as a").write.parquet(str(tmp_path / "folder"))
    assert read_employees(spark, str(tmp_path / "folder"), form="parquet").count() == 3


def test_null_tokens(spark, csv):
    cells = [t for t in NULL_TOKENS if t] + ["none", " NA", "0", "nil"]
    df = read_employees(spark, csv("a,b\n" + "".join(f'{i},"{c}"\n' for i, c in enumerate(cells))))
    kept = {r["b"] for r in df.where("b is not null").collect()}
    # The reader trims nothing and only exact tokens are null.
    assert kept == {"none", " NA", "0", "nil"}


def test_quotes_and_line_breaks(spark, csv):
    path = csv('a,b\n1,"x, ""y"""\n2,"two\nlines"\n')
    assert sorted(read_employees(spark, path, multi_line=True).collect()) == [
        ("1", 'x, "y"'), ("2", "two\nlines")]


def test_parquet_source(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame([(1, "NA"), (2, "x")], "employee_id long, name string").write.parquet(path)
    df = read_employees(spark, path, ["employee_id"])
    assert sorted(df.collect()) == [(1, None), (2, "x")]


def test_headers_have_to_agree(spark, csv, tmp_path):
    csv("a,b\n1,2\n", "one.csv")
    csv("b,a\n3,4\n", "two.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_employees(spark, str(tmp_path)).collect()


def test_row_index_follows_the_file(spark, csv):
    path = csv("n\n" + "".join(f"v{i}\n" for i in range(500)))
    df = with_row_index(read_employees(spark, path, file_order=True))
    assert sorted((r["row_index"], r["n"]) for r in df.collect()) == [(i, f"v{i}") for i in range(500)]


@pytest.mark.parametrize("strategy", ["drop", "fill_default"])
def test_gaps_in_required_columns(spark, csv, strategy):
    made = records(4, 400, gap=0.15)
    df = treat_nulls(read_employees(spark, csv(as_csv(made)), REQUIRED), strategy, REQUIRED)
    if strategy == "drop":
        wanted = [tuple(r) for r in made if None not in r[:4]]
    else:
        wanted = [(*[c or "" for c in r[:4]], r[4]) for r in made]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(wanted, key=str)


def test_fill_number_columns_that_are_still_text(spark, csv):
    df = read_employees(spark, csv("Age,name,note\n,,\n"))
    assert treat_nulls(df, "fill_default", ["Age", "name"]).collect() == [("0", "", None)]


def test_fill_numbers_and_leave_other_columns(spark):
    df = spark.createDataFrame([(None, None, None)], "age int, score double, note string")
    assert treat_nulls(df, "fill_default", ["age", "score"]).collect() == [(0, 0.0, None)]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="Unknown null strategy"):
        treat_nulls(spark.createDataFrame([(1,)], "a int"), "guess", ["a"])


def test_null_report(spark, csv):
    made = records(5, 300, gap=0.08)
    gaps = [[c for c, cell in zip(REQUIRED, row) if cell is None] for row in made]
    df = with_row_index(read_employees(spark, csv(as_csv(made)), REQUIRED, file_order=True))
    found = {r["row_index"]: r["null_columns"] for r in null_rows(df, REQUIRED).collect()}
    assert found == {i: g for i, g in enumerate(gaps) if g}
    assert dict(map(tuple, null_counts(df, REQUIRED).collect())) == {c: sum(c in g for g in gaps) for c in REQUIRED}


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, score double")
    assert null_rows(df, ["score"]).count() == 1
    assert treat_nulls(df, "drop", ["score"]).count() == 1


def test_keep_latest(spark, csv):
    made = records(6, 500, keys=40)
    df = keep_latest(read_employees(spark, csv(as_csv(made)), REQUIRED), "employee_id", "hire_date")
    latest = {}
    for row in sorted(made, key=lambda r: r[3]):
        latest[row[0]] = tuple(row)
    assert {r["employee_id"]: tuple(r) for r in df.collect()} == latest


def test_keep_latest_edges(spark):
    df = spark.createDataFrame(
        [(None, "2020", 1), (None, "2021", 2), (1, None, 3), (1, "2019", 4), (2, None, 5)],
        "k int, d string, n int")
    assert {r["n"] for r in keep_latest(df, "k", "d").collect()} == {2, 4, 5}
    assert keep_latest(df, "other", "d").count() == 5


def test_keep_latest_shrinks_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "2020", 1)], "k int, d string, n int")
    plan = plan_of(keep_latest(df, "k", "d"))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert "SinglePartition" not in plan


def test_ten_thousand_rows(spark, csv):
    text = "employee_id,name,department,hire_date\n" + "".join(
        f"{i},Employee_{i},Eng,2015-01-{i % 28 + 1:02d}\n" for i in range(1, 10001))
    df = read_employees(spark, csv(text), REQUIRED)
    assert keep_latest(treat_nulls(df, "drop", REQUIRED), "employee_id", "hire_date").count() == 10000
