import copy
import datetime as dt
import random

import pytest

from rostermart.config import DEFAULT_JOB, JobSpec, ModelSpec
from rostermart.plans import measures as g
from rostermart.plans.model import score, train
from rostermart.plans.run import encoded_frame, run_job
from rostermart.sources.star_store import StarStore

AS_OF = dt.date(2024, 6, 1)


def small_job(**ingest):
    job = copy.deepcopy(DEFAULT_JOB)
    job["model"]["hyperparameters"]["random_forest"] = {"n_estimators": 5, "max_depth": 4}
    job["ingestion"].update(ingest)
    return JobSpec.from_mapping(job)


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    rng = random.Random(9)
    lines = ["Employee ID,Name,Department,Job-Role,Hire Date,Age,Gender,Ethnicity,Salary,Satisfaction Score,"
             "Overtime Hours,Promotion Date,Location,Attrition"]
    for i in range(240):
        promoted = "2023-05-01" if i % 3 == 0 else ""
        lines.append(f'E{i % 200:04d},Person {i % 200},{rng.choice(["Eng", "Ops", "HR"])},{rng.choice(["Dev", "Lead"])},'
                     f'20{15 + i // 30}-0{1 + i % 9}-15,{22 + i % 40},{rng.choice(["Male", "Female"])},'
                     f'{rng.choice("AB")},{35000 + 400 * i},{1 + i % 5},{i % 31},{promoted},'
                     f'"Austin, TX, USA",{int(rng.random() < 0.3)}')
    lines.append("E9999,,Eng,Dev,2020-01-15,30,Male,A,50000,3,5,,Austin,0")
    path = tmp_path_factory.mktemp("in") / "people.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


REQUIRED = ["Employee ID", "Name", "Department", "Hire Date"]


def test_whole_run(spark, source, tmp_path):
    job = small_job(required_columns=REQUIRED, dedup_key="Employee ID", dedup_sort="Hire Date")
    root = str(tmp_path / "star")
    done = run_job(spark, job, source, root, AS_OF, model_path=str(tmp_path / "model"))
    assert [s.error_message for s in done.stages] == [None] * 4
    assert done.final_status == "success"
    assert [(s.stage_name, s.row_count) for s in done.stages] == [
        ("ingestion", 200), ("transformation", 200), ("modeling", 200), ("sql_loading", 200)]
    assert done.load.inserted == 200 and done.load.rejected == 0
    star = StarStore(spark, root).star()
    assert star.dimension("employee").where("employee_id like 'E0%'").count() == 200
    assert star.fact.where("attrition_probability between 0 and 1").count() == 200
    assert star.fact.select("attrition_probability").distinct().count() > 10
    assert g.turnover_by_department(star).count() == 3
    log = {(r["column_name"], r["operation"]) for r in done.log.collect()}
    assert ("*", "standardize_column_names") in log and ("hire_date", "convert_to_datetime") in log
    assert ("age_group", "derive_feature_bucket") in log and ("department", "encode_label") in log
    assert spark.read.parquet(f"{root}/stage_log").count() == 4


def test_onehot_model_input(spark):
    job = JobSpec.from_mapping({**DEFAULT_JOB, "transformation": {
        **DEFAULT_JOB["transformation"], "encoding_strategy": "onehot"}})
    rows = [(f"E{i}", AS_OF, "Sr. Dev" if i % 2 else "Lead", "Under 25", float(i), i % 3 == 0) for i in range(200)]
    featured = spark.createDataFrame(
        rows, "employee_id string, hire_date date, job_role string, age_group string, age double, left boolean"
    ).selectExpr("* except (left)", "cast(left as int) as attrition")
    frame = encoded_frame(featured, job)
    assert frame.columns == ["employee_id", "age_group", "age", "attrition", "job_role_vec"]
    result = train(frame, ModelSpec(("logistic_regression",), 0.2, 42, {}))
    assert {r["feature"] for r in result.importances.collect()} == {"age_group", "age", "job_role_Lead", "job_role_Sr. Dev"}
    scored = score(result.models["logistic_regression"], frame)
    assert scored.where("attrition_probability between 0 and 1").count() == 200


def test_stops_at_the_first_failure(spark, source, tmp_path):
    job = small_job(required_columns=["Employee ID", "Badge"])
    done = run_job(spark, job, source, str(tmp_path / "star"), AS_OF)
    assert done.final_status == "failure"
    assert [(s.stage_name, s.status) for s in done.stages] == [("ingestion", "failure")]
    assert "Badge" in done.stages[0].error_message
    audit = done.audit(spark).first()
    assert audit["status"] == "failure" and audit["row_count"] == 0
