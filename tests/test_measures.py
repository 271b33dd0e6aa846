import datetime as dt
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rostermart.plans import measures as g
from rostermart.plans import pages as p
from rostermart.plans import trends as t
from rostermart.plans.access import EXECUTIVE, MANAGER, MAP_SCHEMA, has_access, secure
from rostermart.plans.filters import FilterContext, last_twelve_months
from rostermart.plans.star import Star
from rostermart.schemas import DIMENSIONS, FACT, ddl
from rostermart.sources.tables import register_views
from tests.conftest import plan_of

D = dt.date
DAYS = [D(2021, 3, 31), D(2021, 12, 1), D(2023, 1, 31), D(2023, 2, 28), D(2024, 1, 31), D(2024, 2, 1)]
# employee: department, gender, ethnicity, age group, day, left, satisfaction, tenure, probability
PEOPLE = [
    (1, "F", "A", "x", 0, 1, 1.0, 10, 0.1), (1, "M", "A", "x", 0, 0, 2.0, 20, 0.2),
    (1, "F", "B", "y", 2, 1, 3.0, 30, 0.3), (1, "F", "A", "y", 3, 0, 4.0, 40, 0.4),
    (1, "M", "B", "x", 4, 1, 5.0, 50, 0.5), (2, "F", "A", "x", 1, 0, 1.5, 60, 0.6),
    (2, "F", "B", "x", 3, 0, 2.5, 70, 0.7), (2, "M", "B", "y", 5, 1, 3.5, 80, 0.8),
    (2, "M", "A", "y", 5, 0, 4.5, 90, 0.1499), (2, "N", "A", "y", 4, 0, 1.0, 12, 0.15),
]


def key_of(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("star")

    def table(rows, schema, name):
        path = str(root / name)
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    def num(x):
        from decimal import Decimal

        return Decimal(str(x))

    facts = [(i + 1, i + 1, dep, 1 + i % 2, 1, key_of(DAYS[day]), left, 1, num(ten), num(sat), num(prob),
              num(1000 * i), i, DAYS[day].year)
             for i, (dep, _, _, _, day, left, sat, ten, prob) in enumerate(PEOPLE)]
    employees = [(i + 1, f"e{i + 1}", f"P{i + 1}", gen, eth, age, DAYS[day],
                  D(2024, 3, 1 + i) if left else None, "Mid", 0)
                 for i, (_, gen, eth, age, day, left, *_rest) in enumerate(PEOPLE)]
    dates = [(key_of(d), d, d.year, (d.month + 2) // 3, d.month, d.strftime("%B"), 1, 0) for d in DAYS]
    return Star(table(facts, ddl(FACT) + ", date_year int", "fact"), {
        "department": table([(1, "Eng", "ann", "c"), (2, "Ops", "bob", "c")], ddl(DIMENSIONS["department"]), "d"),
        "job_role": table([(1, "Dev", "Standard", "G"), (2, "Lead", "Standard", "G")],
                          ddl(DIMENSIONS["job_role"]), "j"),
        "location": table([(1, "C", "S", "L", "Unknown")], ddl(DIMENSIONS["location"]), "l"),
        "employee": table(employees, ddl(DIMENSIONS["employee"]), "e"),
        "date": table(dates, ddl(DIMENSIONS["date"]), "t")})


@pytest.fixture(scope="module")
def flat():
    pdf = pd.DataFrame(PEOPLE, columns=["dep", "gender", "ethnicity", "age_group", "day", "left", "sat",
                                        "ten", "prob"])
    pdf["date"] = [DAYS[i] for i in pdf["day"]]
    pdf["year"] = [d.year for d in pdf["date"]]
    return pdf


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_blank_or_zero(star):
    early = FilterContext().between("full_date", D(2021, 12, 1), D(2021, 12, 1))
    row = g.evaluate(star, ["headcount", "departures", "attrition_rate"], [], early).first()
    assert tuple(row) == (1, None, None)
    row = g.evaluate(star, ["headcount", "departures", "attrition_rate"], [], early, blank_as_null=False).first()
    assert tuple(row) == (1, 0, 0.0)
    nobody = FilterContext().where(gender="?")
    assert tuple(g.evaluate(star, ["headcount", "attrition_rate_avg"], [], nobody).first()) == (None, None)


def test_unknown_names(star):
    with pytest.raises(ValueError, match="Unknown measures"):
        g.evaluate(star, ["wealth"])
    with pytest.raises(ValueError, match="No such column"):
        FilterContext().where(colour="red")
    with pytest.raises(ValueError, match="No values"):
        FilterContext().where(gender=[])


def test_scorecard(star, flat):
    got = by_key(g.evaluate(star, g.SCORECARD, ["department_name"]), "department_name")
    for name, dep in (("Eng", 1), ("Ops", 2)):
        part = flat[flat["dep"] == dep]
        row = got[(name,)]
        assert row["headcount"] == len(part) and row["open_positions"] == part["left"].sum()
        assert row["avg_tenure"] == pytest.approx(part["ten"].mean())
        assert row["avg_satisfaction"] == pytest.approx(part["sat"].mean())
        assert row["predicted_risk"] == pytest.approx(part["prob"].mean())


@pytest.mark.parametrize("column", ["gender", "ethnicity", "age_group"])
@pytest.mark.parametrize("filters", [{}, {"gender": ["F"]}, {"ethnicity": ["A"], "age_group": ["x"]},
                                     {"gender": ["F", "M"], "ethnicity": ["B"], "department_name": ["Eng"]}])
def test_distribution_against_brute_force(star, flat, column, filters):
    got = by_key(g.distribution(star, column, ["department_name"], FilterContext().where(**filters)),
                 "department_name", column)
    wanted = {}
    for name, dep in (("Eng", 1), ("Ops", 2)):
        if name not in filters.get("department_name", [name]):
            continue
        part = flat[flat["dep"] == dep]
        rest = part
        for c, values in filters.items():
            if c in ("gender", "ethnicity", "age_group") and c != column:
                rest = rest[rest[c].isin(values)]
        for value in sorted(part[column].unique()):
            if value in filters.get(column, [value]):
                n, total = int((part[column] == value).sum()), len(rest)
                wanted[(name, value)] = (n, total or None, n * 100 / total if total else None)
    assert {k: (r["n"], r["total"], r["pct"]) for k, r in got.items()} == {
        k: (n, t_, pytest.approx(s) if s is not None else None) for k, (n, t_, s) in wanted.items()}


def test_a_share_can_pass_one_hundred(star):
    got = by_key(g.distribution(star, "gender", [], FilterContext().where(ethnicity="A", age_group="x")), "gender")
    assert got[("F",)]["pct"] == pytest.approx(500 / 3)


def test_distribution_with_a_second_employee_column(star, flat):
    got = by_key(g.distribution(star, "gender", ["ethnicity"]), "ethnicity", "gender")
    # The numerator drops the ethnicity of the axis, the denominator keeps it.
    for eth in ("A", "B"):
        total = int((flat["ethnicity"] == eth).sum())
        for gen in set(flat[flat["ethnicity"] == eth]["gender"]):
            row = got[(eth, gen)]
            assert (row["n"], row["total"]) == (int((flat["gender"] == gen).sum()), total)


def test_shares_add_up(star):
    sums = g.distribution_all(star).groupBy("department_name", "dimension").agg(F.sum("pct").alias("s"))
    assert all(r["s"] == pytest.approx(100) for r in sums.collect()) and sums.count() == 9
    views = g.diversity_metrics(star).groupBy("department_name").agg(F.sum("percentage").alias("s"))
    assert all(r["s"] == pytest.approx(100) for r in views.collect())


def test_one_scan_of_the_fact(star):
    # Fact and each joined dimension once; year on year reads the calendar a second time, a trend's line the facts.
    scans = {g.diversity_metrics(star): 3, g.distribution(star, "gender", ["department_name"]): 3,
             g.distribution_all(star): 3, t.yoy_diversity(star, "gender"): 4, t.trend_with_reference(star): 3}
    for df, wanted in scans.items():
        assert plan_of(df).count("FileScan") == wanted


def test_selector_falls_back_to_gender(star):
    one = g.selected_distribution(star, "Gender", []).collect()
    assert sorted(g.selected_distribution(star, "Nonsense", []).collect()) == sorted(one)
    assert {r["category"] for r in g.selected_distribution(star, "Age Group", []).collect()} == {"x", "y"}


def test_year_on_year_uses_calendar_years(star):
    got = by_key(t.yoy_diversity(star, "gender"), "year", "category")
    # 2022 has no facts, so 2023 has nothing to compare with.
    assert got[(2023, "F")]["change"] is None and got[(2023, "F")]["share"] == 100.0
    # F has gone in 2024 and counts as 0; M and N are new and have no change.
    assert got[(2024, "F")]["change"] == -100.0 and got[(2024, "F")]["share"] is None
    assert got[(2024, "M")]["change"] is None and got[(2024, "M")]["share"] == 75.0
    # Years outside the calendar do not appear.
    assert {y for y, _ in got} == {2021, 2023, 2024}


def test_rolling_counts_missing_months(star):
    got = by_key(t.rolling_months(star), "department_name", "year", "month")
    assert got[("Eng", 2023, 1)]["headcount_rolling"] == 1
    assert got[("Eng", 2024, 1)]["headcount_rolling"] == 2  # 2023-02 and 2024-01, not 2023-01
    assert got[("Eng", 2024, 1)]["avg_satisfaction_rolling"] == 4.5


def test_sparkline_window(star):
    got = t.sparklines(star, context=FilterContext().between("full_date", D(2021, 1, 1), D(2021, 2, 1)))
    heads = by_key(got.where("measure = 'headcount'"), "department_name", "year", "month")
    # (2023-02-01, 2024-02-01]
    assert {k: r["value"] for k, r in heads.items()} == {
        ("Eng", 2023, 2): 1.0, ("Eng", 2024, 1): 1.0, ("Ops", 2023, 2): 1.0, ("Ops", 2024, 1): 1.0,
        ("Ops", 2024, 2): 2.0}
    assert heads[("Ops", 2024, 2)]["is_max"] == 1 and heads[("Ops", 2023, 2)]["is_min"] == 1
    blank = got.where("measure = 'open_positions' and department_name = 'Ops' and month = 1")
    assert blank.count() == 0


def test_default_slicer(star):
    context = last_twelve_months(star)
    assert g.evaluate(star, ["headcount"], [], context).first()[0] == 6
    assert (context.conditions[0].low, context.conditions[0].high) == (D(2023, 2, 2), D(2024, 2, 1))


def test_monthly_average_skips_blank_months(star, flat):
    got = g.average_monthly_attrition(star).first()[0]
    rates = []
    for _, part in flat.groupby([d.month for d in flat["date"]]):
        if part["left"].sum():
            rates.append(part["left"].sum() * 100 / len(part))
    assert got == pytest.approx(sum(rates) / len(rates))


def test_risk_table_pages(star):
    whole = [(r["attrition_probability"], r["employee_key"]) for r in p.risk_table(star, rows=100).collect()]
    assert whole == sorted(whole, key=lambda x: (-x[0], x[1]))
    shown, after = [], None
    while True:
        page = [(r["attrition_probability"], r["employee_key"]) for r in p.risk_table(star, rows=3, after=after).collect()]
        if not page:
            break
        shown += page
        after = page[-1]
    assert shown == whole


def test_departure_pages(star):
    whole = [r["employee_key"] for r in p.departure_records(star, rows=10).collect()]
    assert whole == [8, 5, 3, 1]
    first = p.departure_records(star, rows=2).collect()[-1]
    rest = p.departure_records(star, rows=2, after=(first["termination_date"], first["employee_key"]))
    assert [r["employee_key"] for r in rest.collect()] == [3, 1]


def test_pages_have_data(star, spark):
    for part in (p.turnover_page(star), p.diversity_page(star, "Ethnicity"), p.department_page(star),
                 p.departures_page(star, "Eng")):
        for name, df in part.items():
            assert df.count() > 0, name
    importance = spark.createDataFrame([(i, f"f{i}", float(i % 5)) for i in range(12)],
                                       "position int, feature string, importance double")
    history = spark.createDataFrame([(3, 1, 0.2, D(2024, 1, 5)), (3, 1, 0.4, D(2024, 1, 9)), (4, 1, 0.9, D(2024, 1, 9))],
                                    "employee_key long, department_key long, attrition_probability double, as_of date")
    page = p.risk_profile_page(replace(star, history=history), 3, importance)
    assert page["profile"].first()["full_name"] == "P3" and page["profile"].first()["risk_level"] == "High"
    assert [r["position"] for r in page["factors"].collect()] == [4, 9, 3, 8, 2, 7, 1, 6]
    assert page["history"].first()["attrition_probability"] == pytest.approx(0.3)
    assert page["history"].first()["reference"] == 0.15


def test_common_roles_show_ties(star):
    got = p.common_roles(star).collect()
    assert {(r["department_name"], r["job_title"]) for r in got} == {("Eng", "Dev"), ("Ops", "Lead")}
    tie = p.common_roles(star, FilterContext().where(employee_key=[1, 2]))
    assert {r["job_title"] for r in tie.collect()} == {"Dev", "Lead"}


def test_date_filters_prune_the_fact(star):
    plan = plan_of(g.evaluate(star, ["headcount"], [], FilterContext().between("full_date", D(2023, 1, 1))))
    assert "GreaterThanOrEqual(date_key,20230101)" in plan and "dim" not in plan


def test_year_filters_prune_folders(spark, tmp_path, star):
    path = str(tmp_path / "by_year")
    star.fact.write.partitionBy("date_year").parquet(path)
    by_year = star.with_fact(spark.read.parquet(path))
    df = g.evaluate(by_year, ["headcount"], [], FilterContext().where(year=[2023, 2024]))
    assert df.first()[0] == 7
    partitions = plan_of(df).split("PartitionFilters: [")[1]
    assert "date_year" in partitions[:partitions.index("]")] and "IN (2023,2024)" in partitions


def test_conditions_reach_the_scan(star):
    plan = plan_of(g.evaluate(star, ["headcount"], [], FilterContext().where(gender=["F", "M"], city="C")))
    assert "In(gender, [F,M])" in plan and "EqualTo(city,C)" in plan


def test_views(spark, star):
    register_views({"vw_diversity_metrics": g.diversity_metrics(star)})
    assert spark.sql("select sum(headcount) from vw_diversity_metrics").first()[0] == 10


# -- access ----------------------------------------------------------------


def headcounts(star):
    return {r[0]: r[1] for r in g.evaluate(star, ["headcount"], ["department_name"]).collect()}


def test_manager_sees_own_department(star):
    mine = secure(star, "ann", [MANAGER])
    assert headcounts(mine) == {"Eng": 5}
    assert mine.fact.count() == 5
    assert {r["employee_id"] for r in mine.dimension("employee").collect()} == {f"e{i}" for i in range(1, 6)}
    assert [r["department_name"] for r in mine.dimension("department").collect()] == ["Eng"]


def test_executive_sees_all(star):
    assert headcounts(secure(star, "who", [EXECUTIVE])) == {"Eng": 5, "Ops": 5}
    assert headcounts(secure(star, "ann", [MANAGER, EXECUTIVE])) == {"Eng": 5, "Ops": 5}


@pytest.mark.parametrize("roles", [[], ["Intern"], [EXECUTIVE.lower()]])
def test_no_known_role_sees_nothing(star, roles):
    closed = secure(star, "ann", roles)
    assert headcounts(closed) == {}
    assert all(closed.dimension(n).count() == 0 for n in DIMENSIONS)
    assert has_access(closed).first()[0] == 0


def test_mapped_departments_add_up(spark, star):
    mapping = spark.createDataFrame([(1, "ann", 2, MANAGER), (2, "eve", 2, MANAGER), (3, "eve", 2, MANAGER)], MAP_SCHEMA)
    assert headcounts(secure(star, "ann", [MANAGER], mapping)) == {"Eng": 5, "Ops": 5}
    assert headcounts(secure(star, "eve", [MANAGER], mapping)) == {"Ops": 5}
    assert headcounts(secure(star, "zoe", [MANAGER], mapping)) == {}


def test_has_access(star):
    assert has_access(secure(star, "ann", [MANAGER])).first()[0] == 1
    assert has_access(secure(star, "zoe", [MANAGER])).first()[0] == 0


def test_history_and_plain_dimensions_obey_access(spark, star):
    history = spark.createDataFrame([(k, 1, 0.1 * k, D(2024, 1, 5)) for k in range(1, 11)],
                                    "employee_key long, department_key long, attrition_probability double, as_of date")
    importance = spark.createDataFrame([(0, "f", 1.0)], "position int, feature string, importance double")
    whole = replace(star, history=history)
    shown = {}
    for who, roles in (("ann", [MANAGER]), ("zoe", [MANAGER]), ("ann", ["Intern"]), ("x", [EXECUTIVE])):
        mine = secure(whole, who, roles)
        shown[who, roles[0]] = {k for k in range(1, 11) if p.risk_profile_page(mine, k, importance)["history"].count()}
        assert {r["employee_key"] for r in mine.dimensions["employee"].collect()} == shown[who, roles[0]]
    assert shown == {("ann", MANAGER): {1, 2, 3, 4, 5}, ("zoe", MANAGER): set(), ("ann", "Intern"): set(), ("x", EXECUTIVE): set(range(1, 11))}


def test_range_and_chosen_days_hold_together(star):
    day = FilterContext().where(full_date=[DAYS[2], DAYS[0]])
    both = day.between("full_date", D(2023, 1, 1), D(2023, 12, 31))
    assert g.evaluate(star, ["headcount"], [], both).first()[0] == g.evaluate(star, ["headcount"], [], FilterContext().where(full_date=DAYS[2])).first()[0]
    assert g.evaluate(star, ["headcount"], [], last_twelve_months(star, FilterContext().where(full_date=DAYS[2]))).first()[0] is None


def test_drill_through_obeys_access(star):
    mine = secure(star, "ann", [MANAGER])
    assert p.departures_page(mine, "Ops")["records"].count() == 0
    assert {r["employee_key"] for r in p.risk_table(mine, rows=None).collect()} == {1, 2, 3, 4, 5}
    assert p.risk_table(mine, FilterContext().where(employee_key=8), rows=None).count() == 0
