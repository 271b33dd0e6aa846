import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import mapping as m
from rostermart.operators.merge import (
    RepeatedSourceKeyError, beside, insert_absent, merge_by_outer_join, merge_type1, one_row_per_key, require_unique)
from rostermart.operators.quality import EmptyInputError, check_rules, check_star, require_same_count, with_defaults
from rostermart.plans.star import resolve_keys, to_staging
from rostermart.schemas import STAGING_RULES
from rostermart.sources import buckets, scratch
from rostermart.sources.lease import ConcurrentLoadError, Lease
from rostermart.sources.star_store import BrokenRulesError, LoadFailedError, StarStore
from rostermart.sources.tables import write_staging
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    return scratch.saved(m.staging(spark, sf_dir), "staging")


@pytest.fixture
def store(spark, tmp_path):
    return StarStore(spark, str(tmp_path / "star"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_rules(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], "id long, k string, v string")
    source = spark.createDataFrame([("a", "y"), ("b", "new"), ("d", "w"), (None, "n")], "k string, v string")
    changed = merge_type1(target, source, ["k"], ["v"], "id", "changed", 3)
    assert rows(changed.select("id", "v", "merge_action").where("id <= 3")) == [
        (1, "y", "UPDATE"), (2, None, "KEEP"), (3, "z", "KEEP")]
    assert {(r["k"], r["id"]) for r in changed.where("merge_action = 'INSERT'").collect()} == {(None, 4), ("d", 5)}
    always = merge_type1(target, source, ["k"], ["v"], "id", "always", 3)
    assert {r["id"] for r in always.where("merge_action = 'UPDATE'").collect()} == {1, 2}
    never = merge_type1(target, source, ["k"], ["v"], "id", "never", 3)
    assert never.where("merge_action = 'UPDATE'").count() == 0
    with pytest.raises(ValueError, match="update rule"):
        merge_type1(target, source, ["k"], ["v"], "id", "sometimes")


def test_insert_absent_keeps_the_first(spark):
    source = spark.createDataFrame([("b", 2), ("a", 5), ("b", 1)], "k string, v int")
    assert rows(insert_absent(None, source, ["k"], "id")) == [(1, "a", 5), (2, "b", 1)]
    old = spark.createDataFrame([(1, "a", 9)], "id long, k string, v int")
    assert rows(insert_absent(old, source, ["k"], "id", high_water=1)) == [(1, "a", 9), (2, "b", 1)]


def test_second_load_inserts_nothing_and_keeps_keys(store, staged):
    first = store.load(staged, m.AS_OF)
    before = rows(store.star().fact.drop("date_year")), rows(store.star().dimension("employee"))
    again = store.load(staged, m.AS_OF)
    after = rows(store.star().fact.drop("date_year")), rows(store.star().dimension("employee"))
    assert first.inserted == staged.count() and first.updated == 0 and first.rejected == 0
    assert again.inserted == 0 and again.updated == first.inserted
    assert before == after
    assert all(n == 0 for k, n in again.counts.items() if k.endswith("inserted"))
    assert check_star(store.star()).where("violations > 0").count() == 0


def test_rejects_and_facts_add_up(store, staged):
    broken = staged.withColumn("job_role", F.when(F.col("age") > 40, F.col("job_role")))
    result = store.load(broken, m.AS_OF)
    assert result.inserted + result.rejected == result.staging_rows == staged.count()
    rejected = store.rejects(result.run_id)
    assert rejected.count() == result.rejected > 0
    assert {tuple(r["reject_reasons"]) for r in rejected.collect()} == {("job_role",)}


def test_null_keys_are_rejected_and_make_no_dimension_rows(store, staged):
    gaps = staged.withColumns({
        "department": F.when(F.col("age") > 30, F.col("department")),
        "employee_id": F.when(F.col("age") < 60, F.col("employee_id"))})
    for _ in range(2):
        result = store.load(gaps, m.AS_OF)
        star = store.star()
        assert star.dimension("department").where("department_name is null").count() == 0
        assert star.dimension("employee").where("employee_id is null").count() == 0
        reasons = {r for row in store.rejects(result.run_id).collect() for r in row["reject_reasons"]}
        assert reasons == {"employee", "department"}
        assert result.inserted + result.updated + result.rejected == result.staging_rows


def test_a_dimension_without_rows(store, staged):
    with pytest.raises(LoadFailedError):
        store.load(staged.withColumn("department", F.lit(None).cast("string")), m.AS_OF)


def test_whole_rows_may_repeat_but_not_facts(spark):
    same = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "c")], "k int, v string")
    require_unique(same, ["k"], equal_rows=True)
    with pytest.raises(RepeatedSourceKeyError, match="k=1"):
        require_unique(same, ["k"])
    with pytest.raises(RepeatedSourceKeyError, match="k=1"):
        require_unique(same.unionByName(spark.createDataFrame([(1, "z")], "k int, v string")), ["k"], True)


def test_a_failed_load_leaves_the_star(spark, store, staged):
    store.load(staged, m.AS_OF)
    before, runs = rows(store.star().fact.drop("date_year")), store.current().run_id
    twice = staged.unionByName(staged.withColumn("name", F.lit("other")))
    with pytest.raises(RepeatedSourceKeyError):
        store.load(twice, m.AS_OF)
    with pytest.raises(EmptyInputError):
        store.load(staged.where("false"), m.AS_OF)
    with pytest.raises(LoadFailedError):
        store.load(staged.withColumn("job_role", F.lit(None).cast("string")), m.AS_OF)
    assert store.current().run_id == runs
    assert rows(store.star().fact.drop("date_year")) == before
    failed = store.load_log().where("load_status = 'FAILED'")
    assert failed.count() == 3 and failed.where("error_message is null").count() == 0


def test_strict_load_names_the_rule(store, staged):
    with pytest.raises(ValueError, match="staging:max_length:department"):
        store.load(staged.withColumn("department", F.repeat("department", F.lit(40))), m.AS_OF, strict=True)
    assert store.current() is None
    with pytest.raises(FileNotFoundError):
        store.star()


def raised(staged, years):
    return staged.where(F.year("hire_date").isin(*years)).withColumn("salary", F.lit(1).cast("decimal(12,2)"))


def test_only_touched_segments_get_a_layer(spark, staged, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"), segment_rows=5)
    store.load(staged, m.AS_OF)
    before = store.current().fact
    years = sorted({y for y, _ in before})
    assert any(n > 0 for _, n in before) and all(len(s.layers) == 1 for s in before.values())
    one = staged.where(F.year("hire_date") == years[-1]).orderBy("employee_id").limit(1).withColumn("salary", F.lit(1).cast("decimal(12,2)"))
    result = store.load(one, m.AS_OF)
    after = store.current().fact
    changed = [p for p in after if after[p] != before.get(p)]
    assert len(changed) == 1 and changed[0][0] == years[-1] and store.rewritten(result.run_id).count() == 1
    fact = store.star().fact
    assert fact.count() == staged.count() == sum(s.rows for s in after.values())
    assert fact.where("salary = 1").count() == 1
    assert fact.select("metric_id").distinct().count() == staged.count()


def test_layers_are_made_one_again(spark, staged, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"), max_layers=2)
    store.load(staged, m.AS_OF)
    some = staged.where(F.col("age") % 2 == 0)
    heights = []
    for salary in (10, 20, 30, 40):
        store.load(some.withColumn("salary", F.lit(salary).cast("decimal(12,2)")), m.AS_OF)
        heights.append(max(len(v.layers) for v in store.current().fact.values()))
        fact = store.star().fact
        assert fact.where(F.col("salary") == salary).count() == some.count() and fact.count() == staged.count()
    assert heights == [2, 1, 2, 1]
    assert store.star(2).fact.where("salary = 10").count() == some.count()


def test_a_layer_with_all_keys_replaces_those_below(store, staged):
    for _ in range(3):
        store.load(staged, m.AS_OF)
    assert {len(v.layers) for v in store.current().fact.values()} == {1}


def test_late_and_new_rows_in_one_load(spark, staged, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"), segment_rows=20)
    old = staged.where(F.col("age") % 3 != 0)
    store.load(old, m.AS_OF)
    result = store.load(staged.where(F.col("age") % 3 != 1), m.AS_OF)
    new, again = staged.where(F.col("age") % 3 == 0).count(), staged.where(F.col("age") % 3 == 2).count()
    assert (result.inserted, result.updated) == (new, again)
    ids = [r[0] for r in store.star().fact.select("metric_id").collect()]
    assert sorted(ids) == list(range(1, staged.count() + 1))


def test_broken_rules_publish_nothing(store, staged):
    store.load(staged, m.AS_OF)
    broken = staged.withColumns({"gender": F.when(F.col("age") > 40, F.col("gender")),
                                 "salary_band": F.when(F.col("age") < 30, F.repeat("salary_band", F.lit(10))).otherwise(F.col("salary_band"))})
    with pytest.raises(BrokenRulesError) as caught:
        store.load(broken, m.AS_OF)
    assert caught.value.violations == {"dim_employee:not_null:gender": staged.where("age <= 40").count(),
                                       "dim_employee:max_length:salary_band": staged.where("age < 30 AND length(salary_band) > 3").count()}
    unpaid = staged.withColumn("salary", F.when(F.col("age") > 30, F.col("salary")))
    with pytest.raises(BrokenRulesError, match="fact:not_null:salary"):
        store.load(unpaid, m.AS_OF)
    flagged = staged.withColumn("attrition", F.lit(2))
    with pytest.raises(BrokenRulesError, match="fact:between:attrition_flag"):
        store.load(flagged, m.AS_OF)
    assert store.current().load_number == 1 and check_star(store.star()).where("violations > 0").count() == 0
    assert store.load_log().where("load_status = 'FAILED' AND error_message LIKE 'Table rules are broken%'").count() == 3
    assert store.risk_history().count() == staged.count()


def test_a_second_load_fails_before_its_work(spark, store, staged):
    with Lease(spark, f"{store.root}/leases", "other") as other:
        with pytest.raises(ConcurrentLoadError, match="other is under way"):
            store.load(staged, m.AS_OF, run_id="late")
        other.check()
    assert not store._files.exists(f"{store.root}/runs/late")
    store.load(staged, m.AS_OF)


def test_a_dead_load_is_taken_over(spark, store, staged):
    dead = Lease(spark, f"{store.root}/leases", "dead", seconds=-1)
    dead._renew = lambda: None
    dead.acquire()
    assert store.load(staged, m.AS_OF).status == "SUCCESS"
    with pytest.raises(ConcurrentLoadError, match="taken over"):
        dead.check()


def test_a_load_that_was_taken_over_does_not_publish(spark, store, staged, monkeypatch):
    slow = StarStore(spark, store.root, lease_seconds=-1)  # runs out at once and is not renewed
    monkeypatch.setattr(Lease, "_renew", lambda self: None)
    inner = slow._load

    def overtaken(*args):
        made = inner(*args)
        store.load(staged.where("age > 30"), m.AS_OF, run_id="fast")
        return made

    monkeypatch.setattr(slow, "_load", overtaken)
    with pytest.raises(ConcurrentLoadError, match="taken over"):
        slow.load(staged, m.AS_OF, run_id="slow")
    assert store.current().run_id == "fast" and store.star().fact.count() == staged.where("age > 30").count()
    assert {r[0] for r in store.risk_history().select("as_of").distinct().collect()} == {m.AS_OF}
    assert store.risk_history().count() == staged.where("age > 30").count()


def test_states_do_not_grow_with_the_loads(spark, store, staged):
    few = staged.orderBy("employee_id").limit(3)
    sizes = []
    for _ in range(6):
        store.load(few, m.AS_OF)
        sizes.append(len(store._files.read(f"{store.root}/states/{len(sizes) + 1:012d}.json")))
    assert max(sizes[1:]) - min(sizes[1:]) <= 8  # digits of counts and times alone


def test_fact_wide_writes_of_a_load(spark, store, staged):
    """Staging, resolved rows and the layer; ids are numbered on the keys alone."""
    wide, at = [], scratch.saved

    def watched(df, label):
        wide.append((label, len(df.columns)))
        return at(df, label)

    scratch.saved = watched
    try:
        store.load(staged, m.AS_OF, run_id="one")
    finally:
        scratch.saved = at
    assert all(n <= 10 for _, n in wide)  # no copy has the width of a fact
    assert {n for n in store._files.names(f"{store.root}/runs/one") if not n.startswith("dim_")} == {
        "staging", "resolved", "fact", "employee_source"}


def test_outer_join_merge_equals_the_plain_one(spark):
    old = [(i, f"k{i}", None if i % 4 == 0 else f"a{i}", i) for i in range(1, 40)]
    new = [(f"k{i}", None if i % 5 == 0 else f"b{i}", -i) for i in range(25, 60)]
    target = spark.createDataFrame(old, "id long, k string, kept string, v int")
    source = spark.createDataFrame(new, "k string, kept string, v int")
    plain = merge_type1(target, source, ["k"], ["kept", "v"], "id", "always", 39, keep_known=["kept"])
    ids = plain.where("merge_action = 'INSERT'").select("k", "id")
    joined = merge_by_outer_join(target, source, ids, ["k"], ["kept", "v"], "id", ["kept"])
    assert joined.columns == plain.columns
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 4])
def test_the_target_of_a_merge_is_not_shuffled(spark, tmp_path, n):
    kinds = {"id": "bigint", "k": "string", "v": "bigint"}
    old = spark.range(300).select(F.col("id"), F.concat(F.lit("k"), "id").alias("k"), (F.col("id") * 2).alias("v"))
    new = spark.range(200, 500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    buckets.write(old.repartition(n, "k"), str(tmp_path / "old"), ["k"], n)
    one, differ = one_row_per_key(new.unionByName(new), ["k"], n)
    assert one.where(differ).count() == 0 and plan_of(one).count("Exchange") == 1  # the source, once
    buckets.write(one.select("k", "_row.*"), str(tmp_path / "new"), ["k"], n)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with buckets.opened(spark, str(tmp_path / "old"), kinds, ["k"], n) as target, \
                buckets.opened(spark, str(tmp_path / "new"), {"k": "string", "v": "bigint"}, ["k"], n) as source:
            assert "Exchange" not in plan_of(source.join(target.select("k"), "k", "left_anti"))
            ids = spark.range(300, 500).select(F.concat(F.lit("k"), "id").alias("k"), "id")
            merged = merge_by_outer_join(target, source, ids, ["k"], ["v"], "id")
            assert plan_of(merged).count("Exchange") == 1  # the new ids
            assert {r[0]: r[1] for r in merged.groupBy("merge_action").count().collect()} == {"INSERT": 200, "UPDATE": 100, "KEEP": 200}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_counts():
    assert [buckets.bucket_count(n, per_bucket=10) for n in (0, 10, 11, 41, 80)] == [1, 1, 2, 8, 8]
    assert [buckets.bucket_count(n, 2, per_bucket=10) for n in (1, 40, 41)] == [2, 2, 8]


def test_a_bucket_is_work_for_one_task():
    """Some hundred thousand employees are not sorted by a single task."""
    assert all(n / buckets.bucket_count(n) <= 250_000 for n in (899_940, 5_400_000))
    assert 1_500_000 / buckets.bucket_count(1_500_000, buckets.bucket_count(300_000)) <= 250_000


def test_a_large_side_is_not_sent_through_the_driver(spark):
    rows, few = spark.range(100), spark.range(50)
    assert "BroadcastHashJoin" in plan_of(rows.join(beside(few, 50), "id"))
    assert "SortMergeJoin" in plan_of(rows.join(beside(few, 900_000), "id", "left"))
    assert plan_of(rows.join(beside(few, 900_000), "id", "left_anti")).count("Broadcast") == 0


def test_buckets_are_dealt_anew_when_they_grow(store, staged, monkeypatch):
    few = staged.orderBy("employee_id").limit(10)
    store.load(few, m.AS_OF)
    counts = buckets.bucket_count
    monkeypatch.setattr(buckets, "bucket_count", lambda rows, held=None: counts(rows, held, per_bucket=20))
    store.load(staged, m.AS_OF)
    assert store.current().buckets == 8
    store.load(staged, m.AS_OF)
    people = store.star().dimension("employee")
    assert people.count() == staged.count() == people.select("employee_key").distinct().count() == store.star().fact.count()
    old = {r["employee_id"]: r["employee_key"] for r in store.star(1).dimension("employee").collect()}
    now = {r["employee_id"]: r["employee_key"] for r in people.collect()}
    assert all(now[i] == k for i, k in old.items())
    assert not [t for t in store.spark.catalog.listTables() if t.name.startswith("rostermart_")]


def test_placeholders_do_not_reset_curated_values(spark, staged, tmp_path):
    for reset, wanted in ((False, "Ann"), (True, "TBD")):
        store = StarStore(spark, str(tmp_path / f"s{reset}"))
        store.load(staged, m.AS_OF)
        path = f"{store.root}/{store.current().tables['department']}"
        curated = scratch.saved(store.star().dimension("department").withColumn(
            "department_head", F.lit("Ann")), "curated")
        curated.write.mode("overwrite").parquet(path)
        result = store.load(staged, m.AS_OF, reset_constants=reset)
        heads = {r["department_head"] for r in store.star().dimension("department").collect()}
        assert heads == {wanted}
        assert result.counts["department_updated"] == (5 if reset else 0)


@pytest.mark.parametrize("keep", [True, False])
def test_first_termination_date(store, staged, keep):
    store.load(staged, dt.date(2001, 9, 1))
    store.load(staged, m.AS_OF, keep_first_termination=keep)
    days = {r[0] for r in store.star().dimension("employee").select("termination_date").distinct().collect()}
    assert days == {None, dt.date(2001, 9, 1) if keep else m.AS_OF}


def test_an_earlier_load_can_be_read(store, staged):
    store.load(m.first_batch(staged), m.AS_OF)
    store.load(staged, m.AS_OF)
    assert store.star(1).fact.count() == m.first_batch(staged).count() < store.star().fact.count()
    with pytest.raises(FileNotFoundError):
        store.star(7)


def test_history_keeps_every_load(store, staged):
    store.load(staged, dt.date(2001, 9, 1))
    store.load(staged, m.AS_OF)
    history = store.risk_history()
    assert history.count() == 2 * staged.count()
    assert {r[0] for r in history.select("as_of").distinct().collect()} == {dt.date(2001, 9, 1), m.AS_OF}


def test_collation_of_the_lookup(store, staged):
    store.load(staged, m.AS_OF)
    lower = staged.withColumn("department", F.lower("department"))
    dims = store.star().dimensions
    assert resolve_keys(lower, dims).where(F.size("reject_reasons") > 0).count() == staged.count()
    assert resolve_keys(lower, dims, "UTF8_LCASE").where(F.size("reject_reasons") > 0).count() == 0


def test_staging_projection_and_rules(spark):
    df = spark.createDataFrame([(7, "x" * 60, 1e12)], "employee_id long, gender string, salary double")
    out = to_staging(df, m.LOAD_TIME)
    row = out.first()
    assert row["employee_id"] == "7" and row["salary"] is None and row["load_timestamp"] == m.LOAD_TIME
    broken = {r["rule"]: r["violations"] for r in check_rules(out, STAGING_RULES).collect()}
    assert broken["max_length:gender"] == 1 and broken["not_null:salary"] == 1
    assert broken["not_null:employee_id"] == 0 and "not_null:promotion_date" not in broken


def test_decimal_range(spark):
    from decimal import Decimal

    from rostermart.schemas import Constraints

    texts = ["99.99", "99.994", "99.995", "-99.995", "100", "1e9", "NaN", None]
    df = spark.createDataFrame([(None if t is None else float(t), t) for t in texts], "d double, t string")
    rules = Constraints(decimals={"d": (4, 2), "t": (4, 2)})
    assert rows(check_rules(df, rules)) == [("decimal:d", 5), ("decimal:t", 5)]
    exact = spark.createDataFrame([(Decimal("99.994"),), (Decimal("99.995"),)], "d decimal(10,3)")
    assert rows(check_rules(exact, Constraints(decimals={"d": (4, 2)}))) == [("decimal:d", 1)]


def test_defaults_and_counts(spark, tmp_path):
    df = spark.createDataFrame([(None,), (2,)], "promotion_recent int")
    out = with_defaults(df, {"promotion_recent": 0, "headcount": 1})
    assert rows(out) == [(0, 1), (2, 1)]
    assert write_staging(out, str(tmp_path / "stg")) == 2
    with pytest.raises(RuntimeError, match="3 rows sent, 2 stored"):
        require_same_count(3, 2, "staging")
