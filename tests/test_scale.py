"""Plans and skew: what must hold on a large table."""

import contextlib
import io
import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from kpiloom.functions.dates import workdays, workdays_between
from kpiloom.operators.history import freeze_history
from kpiloom.operators.joins import null_safe_join
from kpiloom.operators.rows import first_rows
from kpiloom.plans import completeness, progress, slots

FOLDER = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    return printed.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_product(spark, name):
    plan = physical(queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert node not in plan


@pytest.mark.parametrize("name", ["violation_list", "completeness_by_doctor", "recency_bands"])
def test_null_safe_joins_stay_equi_joins_without_broadcast(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("plan_progress_week", "GreaterThanOrEqual(o_orderdate"),
        ("plan_progress_combined", "LessThan(o_orderdate"),
        ("open_minutes_today", "GreaterThan(ts"),
        ("star_cards", "LessThanOrEqual(l_shipdate"),
        ("star_schedule", "GreaterThanOrEqual(l_shipdate"),
    ],
)
def test_date_limits_reach_the_scan(spark, name, pushed):
    assert pushed in formatted(queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["nearest_slot_gp", "open_minutes_today", "booking_status_clean", "calls_pivot_10d", "weekday_pivot_plan"])
def test_results_do_not_depend_on_the_session_zone(spark, name):
    results = []
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            results.append(Counter(tuple(row) for row in queries()[name](spark, FOLDER).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1]


def test_first_row_is_limited_before_the_shuffle(spark):
    plan = physical(queries()["first_per_key"](spark, FOLDER))
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:]


def test_grouped_reports_combine_before_the_shuffle(spark):
    for name in ("nearest_slot_gp", "calendar_gaps", "calls_by_agent", "plan_progress_ytd", "open_minutes_today"):
        plan = physical(queries()[name](spark, FOLDER))
        assert "partial_" in plan[plan.rindex("Exchange hashpartitioning"):]


def test_history_and_progress_read_only_needed_columns(spark):
    plan = formatted(queries()["plan_progress_ytd"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_hot_card_never_makes_its_pairs(spark):
    """A third of both sides without a card number, all stays different: 400 million pairs, counted but not produced."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    card = F.when(~hot, F.col("id").cast("string"))
    admissions = spark.range(n).select(
        card.alias("card_number"), F.lit("P").alias("patient_name"), F.lit("Unit").alias("admission_unit"),
        (F.col("id") % 5).cast("string").alias("doctor_name"), F.lit("Удовлет").alias("state_on_admission"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("exam_time"), (F.col("id") / 1500).alias("minutes_to_exam"),
        F.lit("x").alias("lab_ref"), F.lit(None).cast("string").alias("ecg_ref"), F.lit(None).cast("string").alias("instr_ref"),
        F.lit("01.01").alias("admit_date"), F.lit("dx").alias("diagnosis"),
    )
    times = spark.range(n).select(
        card.alias("card_number"), F.lit("Терапия").alias("profile_unit"), (F.col("id") / 1200).alias("stay_minutes")
    )
    rates = completeness.completeness(admissions, times, main_site="М")
    expected = Counter()
    for key in range(5):
        of_doctor = [i for i in range(n) if i % 5 == key]
        expected[str(key)] = sum(1 for i in of_doctor if i % 3) + sum(1 for i in of_doctor if i % 3 == 0) * (n // 3)
    assert {row["doctor_name"]: row["patients"] for row in rates.collect()} == expected
    flagged = completeness.flag_admissions(admissions, times, main_site="М")
    assert flagged.count() == n
    assert completeness.violations(flagged).count() <= 2 * n
    assert completeness.mean_stay(admissions, times, main_site="М").count() == 1


def test_hot_resource(spark):
    """One resource holds a third of all cells; the answer equals a plain loop."""
    rng = random.Random(5)
    start = datetime(2024, 1, 10)
    data = []
    for number in range(6000):
        resource = 1 if number % 3 == 0 else rng.randrange(2, 40)
        begin = start + timedelta(minutes=15 * rng.randrange(3000))
        flag = rng.randrange(2)
        data.append((resource, begin, begin + timedelta(minutes=15), "Врач", rng.randrange(2), 1815, f"d{number}", flag, 1 - flag, number))
    cells = spark.createDataFrame(
        data,
        "resource_id INT, begin_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, resource_type STRING, is_used INT, specialty_id INT, "
        "department_name STRING, ac_doctor INT, ac_internet INT, seq INT",
    ).withColumns({name: F.lit("x") for name in ("subdivision_name", "doctor_full_name", "specialty_name")})
    now = datetime(2024, 1, 20, 12)
    found = slots.first_free_cells(cells, now=now, tie_break=["seq"])
    free = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[1], r[2], r[9])):
        if row[4] == 0 and row[2] > now:
            free[row[0]].append(row)

    def wait(rows, place):
        return next(((row[2].date() - now.date()).days for row in rows if row[place] == 1), 9999)

    expected = {key: (rows[0][6], wait(rows, 7), wait(rows, 8)) for key, rows in free.items()}
    ours = {r["resource_id"]: (r["department_name"], r["wait_days"], r["self_booking_wait_days"]) for r in found.collect()}
    assert ours == expected


@pytest.fixture
def small_skew(spark):
    """Adaptive thresholds scaled down to test data, broadcasts off."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_grouping_after_a_join_splits_a_hot_key(spark, small_skew):
    """Two thirds of the cells belong to one resource, resources are too large to broadcast."""
    n = 200_000
    resource = F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 5000)
    cells = spark.range(0, n, 1, 16).select(
        resource.alias("resource_id"), (F.lit("2024-01-10 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int") % 9000)).alias("begin_time"),
        F.lit(0).alias("is_used"), F.lit(1).alias("ac_doctor"), (F.col("id") % 2).cast("int").alias("ac_internet"),
        F.lit("dep").alias("department_name"), F.col("id").alias("seq"),
    ).withColumn("end_time", F.col("begin_time") + F.expr("INTERVAL 15 MINUTES"))
    resources = spark.range(5000).select(
        F.col("id").alias("resource_id"), F.lit("Врач").alias("resource_type"), F.lit(1815).alias("specialty_id"),
        *[F.lit("x").alias(name) for name in ("subdivision_name", "doctor_full_name", "specialty_name")],
    )
    joined = cells.join(resources, "resource_id", "left")
    now = datetime(2024, 1, 12, 12)
    rows, plan = final_plan(slots.first_free_cells(joined, now=now, tie_break=["seq"]))
    assert "SortMergeJoin(skew=true)" in plan
    assert len({row["resource_id"] for row in rows}) == len(rows)
    hot = next(row for row in rows if row["resource_id"] == 1)
    assert (hot["wait_days"], hot["self_booking_wait_days"]) == (0, 0)
    minutes = {r["resource_id"]: r["open_minutes"] for r in slots.open_minutes(joined.withColumn("access_code", F.lit(1)), day=date(2024, 1, 11)).collect()}
    inside = [i for i in range(n) if 1440 < i % 9000 < 2880]
    assert minutes[1] == 15.0 * sum(1 for i in inside if i % 3 != 0 or i % 5000 == 1)


def test_row_level_join_splits_a_hot_key(spark, small_skew):
    left = spark.range(0, 120_000, 1, 16).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("n"))
    right = spark.range(0, 120_000, 1, 16).select(F.col("id").alias("k"), F.lit("x" * 5).alias("v")).where("k % 3 = 0")
    right = right.unionByName(spark.createDataFrame([(None, "missing")], "k BIGINT, v STRING"))
    joined = null_safe_join(left, right, ["k"])
    rows, plan = final_plan(joined.groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    assert "SortMergeJoin(skew=true)" in plan
    assert {row["v"]: row["n"] for row in rows} == {"xxxxx": 40_000, "missing": 80_000}


def test_first_rows_against_a_loop(spark):
    rng = random.Random(7)
    data = [("hot" if n % 3 == 0 else f"k{rng.randrange(50)}", rng.randrange(10**6), n) for n in range(5000)]
    best = {}
    for key, order, number in data:
        best[key] = min(best.get(key, (order, number)), (order, number))
    df = spark.createDataFrame(data, "k STRING, o INT, n INT").repartition(16)
    assert {r["k"]: (r["o"], r["n"]) for r in first_rows(df, ["k"], ["o", "n"]).collect()} == best


def test_total_is_the_sum_of_its_units(spark):
    rng = random.Random(3)
    units = {"A": 0.5, "B": 0.3, "C": 0.2}
    day = date(2024, 1, 1)
    data = [(rng.choice(list(units)), day + timedelta(days=rng.randrange(30)), str(n)) for n in range(900)]
    cards = spark.createDataFrame(data, "unit STRING, date_close DATE, card_number STRING")
    weights = spark.createDataFrame(list(units.items()), "unit STRING, weight DOUBLE")
    span = progress.Span(end=date(2024, 1, 20), due=1000)
    rows = progress.plan_progress(cards, weights, progress.Plan(9999, 248), span).collect()
    total = next(row for row in rows if row["unit"] == "TOTAL")
    others = [row for row in rows if row["unit"] != "TOTAL"]
    assert total["done"] == sum(row["done"] for row in others) == sum(1 for _, d, _ in data if d <= span.end)
    assert total["target"] == sum(row["target"] for row in others)


def test_history_keeps_every_stored_cell(spark):
    rng = random.Random(11)
    stored = {(f"u{rng.randrange(9)}", rng.randrange(30)): rng.randrange(99) for _ in range(120)}
    new = {(f"u{rng.randrange(9)}", rng.randrange(40)): rng.randrange(99) for _ in range(200)}
    frames = [
        spark.createDataFrame([(*key, value) for key, value in cells.items()], "unit STRING, week INT, n INT") for cells in (new, stored)
    ]
    frozen = {(r["unit"], r["week"]): r["n"] for r in freeze_history(*frames, ["unit", "week"]).collect()}
    assert frozen == {**new, **stored}


def test_stored_weeks_in_one_pass(spark):
    rng = random.Random(12)
    cards = spark.createDataFrame(
        [
            (rng.choice(["u", "v", None]), date(2024, 1, 1) + timedelta(days=rng.randrange(60)), rng.choice([None, "c"]), rng.choice([True, False, None]))
            for _ in range(400)
        ],
        "unit STRING, date_close DATE, card_number STRING, known BOOLEAN",
    )
    until = date(2024, 2, 20)
    was_stored = F.col("known") & (F.col("date_close") <= F.lit(date(2024, 1, 20)))
    one_pass = progress.weekly_facts_as_stored(cards, until, was_stored)
    both = freeze_history(progress.weekly_facts(cards, until), progress.weekly_facts(cards.where(was_stored), until), ["unit", "period_start"])
    assert Counter(map(tuple, one_pass.select(both.columns).collect())) == Counter(map(tuple, both.collect()))
    assert formatted(queries()["history_freeze"](spark, FOLDER)).count("Scan parquet") <= 2  # the node and its details


def test_workdays_add_up(spark):
    rng = random.Random(13)
    days_off = [date(2024, 1, 1) + timedelta(days=rng.randrange(700)) for _ in range(40)]
    spans = []
    for _ in range(200):
        start = date(2023, 6, 1) + timedelta(days=rng.randrange(600))
        middle = start + timedelta(days=rng.randrange(200))
        spans.append((start, middle, middle + timedelta(days=1 + rng.randrange(200))))
    df = spark.createDataFrame(spans, "a DATE, b DATE, c DATE")
    a, b, c = (F.col(name) for name in "abc")
    after = F.date_add(b, 1)
    rows = df.select(a, c, workdays(a, b, days_off) + workdays(after, c, days_off), workdays(a, c, days_off)).collect()
    for start, end, parts, whole in rows:
        assert parts == whole == workdays_between(start, end, days_off)
