"""Reports on small invented hospital rows with worked results."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from kpiloom import schemas
from kpiloom.plans import calls, closures, completeness, extracts, prescriptions, progress, recency, slots, tickets


def as_set(df):
    return {tuple(row) for row in df.collect()}


def as_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


# --- plan progress -----------------------------------------------------------

CARDS = "unit STRING, date_close DATE, card_number STRING, doctor_name STRING"
SUNDAY, MONDAY = date(2024, 1, 14), date(2024, 1, 8)


def cards(frame):
    rows = [("A", date(2024, 1, 3), f"c{n}", "d1") for n in range(3)]
    rows += [("A", SUNDAY, "c3", "d2"), ("A", SUNDAY, None, "d2"), ("A", date(2024, 1, 15), "c4", "d1")]
    rows += [("B", date(2024, 1, 2), "c5", "d3"), ("X", SUNDAY, "c6", None), (None, SUNDAY, "c7", "d1")]
    return frame(CARDS, *rows)


def test_plan_row_figures(frame):
    plan = progress.Plan(annual=184233, year_days=248)
    span = progress.Span(end=SUNDAY, due=184233 // 248 * 10)
    many = frame(CARDS, *[("A", SUNDAY, str(n), "d") for n in range(2000)])
    weights = frame("unit STRING, weight DOUBLE", ("A", 0.304))
    rows = as_set(progress.plan_progress(many, weights, plan, span))
    assert ("A", 56006, 2255, 2000, 88.67) in rows
    # The total is measured against the cut targets.
    assert ("TOTAL", 56006, 2255, 2000, round(100 * 2000 / 2255, 2)) in rows


def test_plan_progress_combined(frame):
    plan = progress.Plan(annual=100, year_days=10, total_label="ALL")
    weights = frame("unit STRING, weight DOUBLE", ("A", 0.75), ("B", 0.25))
    year = progress.Span(end=SUNDAY, due=plan.due(date(2024, 1, 1), SUNDAY))
    week = progress.Span(start=MONDAY, end=SUNDAY, due=plan.due(MONDAY, SUNDAY))
    rows = {row["unit"]: row for row in progress.plan_progress_combined(cards(frame), weights, plan, year, week).collect()}
    assert set(rows) == {"A", "B", "ALL"}
    assert tuple(rows["A"]) == ("A", 75, 75, 4, 5.33, 37, 1, 2.67)
    assert tuple(rows["B"]) == ("B", 25, 25, 1, 4.0, None, None, None)
    assert tuple(rows["ALL"]) == ("ALL", 100, 100, 5, 5.0, 37, 1, 2.7)


def test_daily_counts_stand_for_the_cards(frame):
    spans = {"year": progress.Span(end=SUNDAY, due=0), "week": progress.Span(start=MONDAY, end=SUNDAY, due=0)}
    daily = progress.daily_counts(cards(frame), ["unit", "doctor_name"])
    for keys in (["unit"], ["unit", "doctor_name"]):
        assert as_set(progress.period_counts(daily, keys, spans)) == as_set(progress.period_counts(cards(frame), keys, spans))


def test_cumulative_vs_period_and_scope(frame):
    scoped = progress.in_scope(cards(frame), ["A", "B"])
    by_doctor = progress.cumulative_vs_period(scoped, ["unit", "doctor_name"], cutoff=SUNDAY, start=MONDAY, end=SUNDAY)
    assert as_set(by_doctor) == {("A", "d1", 3, 0), ("A", "d2", 1, 1), ("B", "d3", 1, 0)}
    outside = progress.out_of_scope(cards(frame), ["A", "B"])
    assert as_set(outside) == {("X", None, "c6", "2024-01-14"), (None, "d1", "c7", "2024-01-14")}


# --- admission department ----------------------------------------------------

def admission_frames(frame):
    exam = datetime(2024, 1, 1, 10)
    head = (77,)
    rows = [
        (*head, "1", "P1", "Приемное общее", "D1", None, None, "dx", "Удовлет", exam, 60.0, "x", None, None),
        (*head, "2", "P2", "Приемное общее", "D1", None, None, "dx", "Тяжелое", exam, 31.0, None, None, None),
        (*head, "3", "P3", "Приемное другое", "D1", None, None, "dx", "Тяжелое", None, 30.0, None, "e", None),
        (*head, "4", None, "Приемное ОСП 2", "D2", None, None, "dx", "Удовлет", exam, None, None, None, "i"),
        (*head, None, "P5", "Приемное ОСП 2", "D2", None, None, "dx", "Удовлет", exam, 5.0, "x", None, None),
        (*head, "6", "P6", "Приемное общее", "D1", None, None, "dx", "Удовлет", exam, 5.0, "x", None, None),
        (*head, "7", "P7", "Приемное общее", None, None, None, "dx", "Удовлет", exam, 5.0, "x", None, None),
    ]
    times = [
        ("1", "Терапия", None, None, 100.0),
        ("2", "Терапия", None, None, 100.0),
        ("3", None, None, None, 30.0),
        ("4", "Терапия", None, None, 50.0),
        (None, "Терапия", None, None, 50.0),
        (None, None, None, None, 4.0),
        ("6", "А и Реан", None, None, 50.0),
    ]
    return frame(schemas.ADMISSIONS, *rows), frame(schemas.ADMISSION_TIMES, *times)


def test_completeness(frame):
    admissions, times = admission_frames(frame)
    main = completeness.completeness(admissions, times, main_site="М")
    # D1 works in two units, so there are two rows; card 6 has the excluded profile.
    assert as_rows(main) == [("D1", 1, 0, 100, 0), ("D1", 2, 100, 50, 50)]
    others = completeness.completeness(
        admissions, times, main_site="М", main=False, unit_labels={"Приемное ОСП 2": "ОСП 2"}
    )
    # Card 4 has no name, the admission without a card matches both times without one.
    assert as_rows(others) == [("D2", "ОСП 2", 2, 150, 150, 50)]
    unlabelled = completeness.completeness(admissions, times, main_site="М", main=False)
    assert as_rows(unlabelled) == [("D2", None, 2, 150, 150, 50)]


def test_violations_and_clean_rows_are_all_rows(frame):
    admissions, times = admission_frames(frame)
    flagged = completeness.flag_admissions(admissions, times, main_site="М")
    listed = completeness.violations(flagged)
    assert {(r["card_number"], r["exam_done"], r["referral_done"], r["time_correct"]) for r in listed.collect()} == {
        ("2", "Да", "Нет", "Нет"), ("3", "Нет", "Да", "Нет"), ("4", "Да", "Да", "Нет"), (None, "Да", "Да", "Нет"),
        ("7", "Да", "Да", "Нет"),
    }
    clean = flagged.where("exam_done AND referral_done").agg(F.sum("on_time")).first()[0]
    copies = [df.agg(F.sum("copies")).first()[0] for df in (listed, flagged)]
    assert clean + copies[0] == copies[1]
    hidden = listed.drop("copies")
    assert hidden.distinct().count() == hidden.count()
    assert as_set(listed.where("card_number IS NULL").select("time_correct", "copies")) == {("Нет", 1)}
    twice = completeness.flag_admissions(admissions, times.unionByName(times), main_site="М")
    assert twice.count() == flagged.count() and flagged.count() <= times.count() + admissions.count()
    assert as_set(twice.groupBy("card_number").agg(F.sum("copies"))) == {
        ("1", 2), ("2", 2), ("3", 2), ("4", 2), (None, 4), ("7", 1),
    }


def test_mean_stay(frame):
    admissions, times = admission_frames(frame)
    assert as_set(completeness.mean_stay(admissions, times, main_site="М")) == {("Приемное общее", 100), ("Приемное другое", 30)}
    assert as_set(completeness.mean_stay(admissions, times, main_site="М", main=False)) == {("Приемное ОСП 2", 35)}


def test_rates_count_copies_like_a_plain_join(frame):
    admissions, times = admission_frames(frame)
    admissions = admissions.unionByName(admissions.where("card_number IS NULL"))
    times = times.unionByName(times.where("card_number IS NULL OR card_number = '2'"))
    joined = admissions.join(times, admissions.card_number.eqNullSafe(times.card_number), "left").where("doctor_name IS NOT NULL")
    plain = joined.where("NOT (profile_unit <=> 'А и Реан')").groupBy("admission_unit").agg(
        F.count("patient_name").alias("n"), F.rint(F.avg("stay_minutes")).cast("long").alias("stay")
    )
    expected = {row["admission_unit"]: (row["n"], row["stay"]) for row in plain.collect()}
    others = completeness.completeness(admissions, times, main_site="М", main=False)
    assert [row["patients"] for row in others.collect()] == [expected["Приемное ОСП 2"][0]]
    assert as_set(completeness.mean_stay(admissions, times, main_site="М", main=False)) == {
        ("Приемное ОСП 2", expected["Приемное ОСП 2"][1])
    }


def test_parts_of_minutes_count_like_a_plain_join(frame):
    """Random stays and minutes with parts of minutes, hot and missing cards."""
    rng = random.Random(3)
    values = [None, -1.5, 0.0, 0.25, 29.5, 30.0, 30.5, 59.9, 60.0, 60.5, 61.0, 90.0]
    cards = [None, None, "1", "2", "3"]
    admissions = [
        (1, rng.choice(cards), "P", "Приемное общее", rng.choice("AB"), "01.01", "10:00", "dx", rng.choice(["Удовлет", "Тяжелое"]),
         None, rng.choice(values), "x", None, None) for _ in range(120)
    ]
    times = [(rng.choice(["1", "2", None]), rng.choice(["Терапия", None, "А и Реан"]), None, None, rng.choice(values)) for _ in range(150)]
    expected = {}
    for a in admissions:
        found = [t for t in times if t[0] == a[1]] or [(None, None, None, None, None)]
        for t in found:
            if t[1] != "А и Реан":
                limit = 60 if a[8] == "Удовлет" else 30
                good = a[10] is not None and t[4] is not None and a[10] < t[4] and a[10] <= limit
                n, ok = expected.get(a[4], (0, 0))
                expected[a[4]] = (n + 1, ok + good)
    flagged = completeness.flag_admissions(
        frame(schemas.ADMISSIONS, *admissions), frame(schemas.ADMISSION_TIMES, *times), main_site="М"
    )
    found = flagged.groupBy("doctor_name").agg(F.sum("copies"), F.sum("on_time")).collect()
    assert {row[0]: (row[1], row[2]) for row in found} == expected


def test_whole_minutes_by_type_need_no_running_sums(frame):
    admissions, times = admission_frames(frame)
    whole = completeness.flag_admissions(
        admissions.withColumn("minutes_to_exam", F.col("minutes_to_exam").cast("long")),
        times.withColumn("stay_minutes", F.col("stay_minutes").cast("decimal(9,0)")), main_site="М",
    )
    general = completeness.flag_admissions(admissions, times, main_site="М")
    columns = ["card_number", "profile_unit", "copies", "on_time"]
    assert as_set(whole.select(*columns)) == as_set(general.select(*columns))
    plans = [df._jdf.queryExecution().optimizedPlan().toString().count("Window") for df in (whole, general)]
    assert plans[0] == 0 and plans[1] > 0


def test_a_hot_card_with_parts_of_minutes_has_no_large_running_sum(spark, frame):
    """Half a million different stays of no card: the running sum's partitions stay small, the counts right."""
    n = 500_000
    times = spark.range(n).select(
        F.lit(None).cast("string").alias("card_number"), F.lit("Терапия").alias("profile_unit"),
        (F.lit(10.0) + F.col("id") / n).alias("stay_minutes"),
    )
    asked = [10.0, 10.25, 10.5000001, 10.999999, 11.0]
    admissions = frame(
        schemas.ADMISSIONS,
        *[(1, None, f"P{k}", "Приемное общее", "D", "01.01", "10:00", "dx", "Тяжелое", None, m, "x", None, None) for k, m in enumerate(asked)],
    )
    flagged = completeness.flag_admissions(admissions, times, main_site="М")
    found = {r["minutes_to_exam"]: (r["copies"], r["on_time"]) for r in flagged.collect()}
    values = [10.0 + k / n for k in range(n)]
    assert found == {m: (n, sum(v > m for v in values)) for m in asked}


# --- closures ----------------------------------------------------------------

def test_weekday_closures(frame):
    done, exam = "Обследование пройдено", "404н Диспансеризация"
    report = frame(
        schemas.CHECKUP_REPORT,
        (77, "ОСП 1 каб", "08.01.2024 00:00:00", done, exam, None),
        (77, "ОСП 1 каб", "14.01.2024 23:59:59", done, "404н Профилактические медицинские осмотры", "P"),
        (77, "Центр", "09.01.2024 10:00:00", done, exam, "P"),
        (77, "Центр", "15.01.2024 00:00:00", done, exam, "P"),
        (77, "Центр", "09.01.2024 10:00:00", "Отказ", exam, "P"),
        (77, "Центр", "09.01.2024 10:00:00", done, "Другое", "P"),
        (78, "Центр", "09.01.2024 10:00:00", done, exam, "P"),
    )
    plan = frame("unit STRING, plan BIGINT", ("ОСП 1", 4), ("Г", 3), ("ОСП 2", 9))
    table = closures.weekday_closures(report, plan, org_id=77, main_site="Г", first=MONDAY, last=SUNDAY)
    assert as_set(table.select("unit", "Понедельник", "Вторник", "Воскресенье", "total", "plan")) == {
        ("ОСП 1", 1, None, 1, 2, 4), ("Г", None, 1, None, 1, 3),
    }
    assert as_set(closures.closure_rates(table, "ALL")) == {("ОСП 1", 50), ("Г", 33), ("ALL", 43)}


# --- prescriptions -----------------------------------------------------------

AS_OF = date(2024, 1, 10)


def bookings(frame):
    def row(name, moment, mark, seq, subdivision="ОСП 1"):
        return subdivision, "1", f"№1 {name} Б В, 1990", moment, mark, seq

    return frame(
        schemas.BOOKINGS,
        row("Алла", datetime(2024, 1, 9, 9), "Запись отменена", 1),
        row("Алла", datetime(2024, 1, 9, 12), "Явка", 2),  # the first one of the day counts
        row("Борис", datetime(2024, 1, 9), "Неявка", 3),
        row("Вера", datetime(2024, 1, 10), "Неявка", 4),  # not before the day: still planned
        row("Глеб", datetime(2024, 1, 8, 9), "Явка", 5),
        row("Дина", datetime(2024, 1, 8, 9), None, 6),
        row("Итог", datetime(2024, 1, 8, 9), "Явка", 7, "Общий ИТОГ"),
        row("Егор", datetime(2024, 1, 8, 9), "Запись перенесена", 8),
        ("ОСП 1", "1", None, datetime(2024, 1, 8, 9), "Явка", 9),
        row("Жанна", datetime(2024, 1, 8, 9), "Явка", 10, None),
    )


def issued(frame):
    def row(name, day, seq, department="ОСП 1 терапия"):
        return department, f"s{seq}", day, "D", "i", f"{name} б в", "c", "a", "drug", 1.0, seq

    rows = [
        row("алла", "09.01.2024", 1), row("Борис", "09.01.2024", 2), row("Вера", "10.01.2024", 3),
        row("Глеб", "08.01.2024", 4, "ОСП 1 хирургия"), row("Глеб", "08.01.2024", 5, "ЦАОП"), row("Зоя", "10.01.2024", 6),
        row("Глеб", "09.01.2024", 7), row("Жанна", "08.01.2024", 8, None),
    ]
    return prescriptions.first_prescriptions(frame(schemas.PRESCRIPTIONS, *rows))


def test_clean_bookings(frame):
    kept, noshow = prescriptions.clean_bookings(bookings(frame), as_of=AS_OF)
    assert as_set(kept.select("patient_name", "mark")) == {
        ("ВЕРА Б В", "Запланирован"), ("ГЛЕБ Б В", "Явка"), ("ЖАННА Б В", "Явка"),
    }
    assert as_set(noshow.select("patient_name", "mark")) == {("БОРИС Б В", "Неявка")}


def test_reconciliation(frame):
    kept, noshow = prescriptions.clean_bookings(bookings(frame), as_of=AS_OF)
    rx = issued(frame)
    assert as_set(rx.select("patient_name", "seq")) == {
        ("АЛЛА Б В", 1), ("БОРИС Б В", 2), ("ВЕРА Б В", 3), ("ГЛЕБ Б В", 4), ("ЗОЯ Б В", 6), ("ГЛЕБ Б В", 7), ("ЖАННА Б В", 8),
    }
    missing = prescriptions.missing_booking(rx, kept, as_of=AS_OF)
    assert as_set(missing.select("patient_name", "subdivision")) == {("ЗОЯ Б В", "ОСП 1")}
    came = prescriptions.noshow_fulfilled(noshow, rx)
    assert as_set(came.select("patient_name", "booked_at", "series_number")) == {
        ("БОРИС Б В", "2024-01-09 вне расписания", "s2")
    }


def test_compliance(frame):
    kept, _ = prescriptions.clean_bookings(bookings(frame), as_of=AS_OF)
    by_department = prescriptions.compliance(issued(frame), kept, as_of=AS_OF)
    assert as_set(by_department) == {("ОСП 1 терапия", 3, 0, 0), ("ОСП 1 хирургия", 1, 1, 100)}
    assert as_set(prescriptions.compliance_rollup(by_department, "ALL")) == {("ОСП 1", 4, 1, 25), ("ALL", 4, 1, 25)}


def test_rollup_ratio_from_sums(frame):
    by_department = frame(
        "department STRING, prescriptions BIGINT, by_rule BIGINT, by_rule_pct BIGINT", ("ОСП 1 а", 10, 5, 50), ("ОСП 2", 30, 30, 100)
    )
    rows = as_set(prescriptions.compliance_rollup(by_department, "ALL"))
    assert ("ALL", 40, 35, 88) in rows


# --- schedule ----------------------------------------------------------------

CELL = (
    "resource_id BIGINT, begin_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, resource_type STRING, doctor_full_name STRING, "
    "equipment_name STRING, equipment_type STRING, cabinet_number STRING, access_code INT, is_used INT, specialty_id INT, "
    "specialty_name STRING, department_name STRING, subdivision_name STRING, ac_doctor INT, ac_internet INT"
)
NOW = datetime(2024, 1, 10, 12)


def cell(resource, begin, *, kind="Врач", used=0, doctor=1, internet=0, specialty=1815, room="1", code=64, minutes=15, department="dep",
         equipment="Компьютерный томограф"):
    end = datetime.fromtimestamp(begin.timestamp() + 60 * minutes)
    return (
        resource, begin, end, kind, f"doc{resource}", f"eq{resource}", equipment, room, code, used, specialty, "spec", department, "sub",
        doctor, internet,
    )


def test_doctor_waits(frame):
    cells = frame(
        CELL,
        cell(1, datetime(2024, 1, 10, 9)),  # over
        cell(1, datetime(2024, 1, 11, 9), used=1),
        cell(1, datetime(2024, 1, 12, 9), doctor=0, department="first free"),
        cell(1, datetime(2024, 1, 13, 9)),
        cell(1, datetime(2024, 1, 20, 9), internet=1),
        cell(2, datetime(2024, 1, 11, 9), internet=1),  # within a day on both
        cell(3, datetime(2024, 1, 11, 9), specialty=7),  # no self-booking at all
        cell(4, datetime(2024, 1, 12, 9), specialty=None, internet=1),
        cell(5, datetime(2024, 1, 12, 9), used=1),
        cell(6, datetime(2024, 1, 10, 11, 50), internet=1),  # still running now
        cell(7, datetime(2024, 1, 30, 9), kind="Кабинет"),
    )
    found = slots.first_free_cells(cells, now=NOW)
    assert as_set(found.select("resource_id", "department_name", "wait_days", "self_booking_wait_days")) == {
        (1, "first free", 3, 10), (2, "dep", 1, 1), (3, "dep", 1, 9999), (4, "dep", 2, 2), (6, "dep", 0, 0), (7, "dep", 20, 9999),
    }
    assert as_set(slots.general_practice_waits(found).select("resource_id")) == {(1,)}
    assert as_set(slots.specialist_waits(found).select("resource_id")) == {(3,)}


def test_equipment_waits(frame):
    kind = {"kind": "Оборудование"}
    cells = frame(
        CELL,
        cell(1, datetime(2024, 1, 12, 9), **kind),
        cell(2, datetime(2024, 1, 12, 9), doctor=0, **kind),
        cell(3, datetime(2024, 1, 12, 9), room="Стационар 1", **kind),
        cell(4, datetime(2024, 1, 12, 9), room=None, **kind),
        cell(5, datetime(2024, 1, 12, 9), equipment="УЗИ", **kind),
        cell(6, datetime(2024, 1, 12, 9)),
    )
    found = slots.equipment_waits(slots.first_free_cells(cells, now=NOW))
    assert found.columns == ["resource_id", "subdivision_name", "department_name", "equipment_name", "cabinet_number", "wait_days"]
    assert as_set(found.select("resource_id", "wait_days")) == {(1, 2), (2, 9999)}


def test_schedule_gaps(frame):
    first = date(2024, 1, 10)
    every_day = [cell(1, datetime(2024, 1, 10 + n, 9)) for n in range(22)]
    cells = frame(
        CELL,
        *every_day,
        *[cell(2, datetime(2024, 1, 10 + n, 9), used=1) for n in range(22) if n not in (3, 21)],
        cell(3, datetime(2024, 1, 10, 9), kind="Кабинет"),
        cell(4, datetime(2024, 3, 10, 9)),
    )
    gaps = {row["resource_id"]: row["missing_dates"] for row in slots.doctor_gaps(slots.date_gaps(cells, first=first)).collect()}
    assert set(gaps) == {2, 4}
    assert gaps[2] == "2024-01-13, 2024-01-31"
    assert len(gaps[4].split(", ")) == 22


def test_open_minutes(frame):
    cells = frame(
        CELL,
        cell(1, datetime(2024, 1, 10)),  # at midnight exactly
        cell(1, datetime(2024, 1, 10, 0, 15)),
        cell(1, datetime(2024, 1, 10, 9), code=111),
        cell(1, datetime(2024, 1, 10, 10), code=None, minutes=20),
        cell(1, datetime(2024, 1, 11)),
        cell(2, datetime(2024, 1, 10, 9), code=111),
    )
    assert as_set(slots.open_minutes(cells, day=date(2024, 1, 10))) == {(1, 35.0)}


# --- calls -------------------------------------------------------------------

def phone_calls(frame):
    ok, missed = "успешный", "пропущенный"
    raw = frame(
        schemas.CALLS,
        (1, "SIP/ext1", ok, "in", "2024-01-10", "10:00"), (1, "SIP/ext1", ok, "in", "2023-12-31", "10:00"),
        (1, "SIP/ext1", ok, "in", "2023-12-30", "10:00"), (1, "SIP/ext2", ok, None, "2024-01-09", "10:00"),
        (1, "SIP/ext9", ok, "in", "2024-01-09", "10:00"), (1, None, missed, "in", "2024-01-08", "10:00"),
        (1, None, missed, "in", "2024-01-08", "11:00"), (2, "SIP/ext1", ok, "in", "2024-01-10", "10:00"),
        (1, "SIP/ext1", None, "in", "2024-01-10", "10:00"),
    )
    return calls.line_calls(raw, line=1, agents=(("ext1", "A"), ("ext2", "B")))


def test_call_counts(frame):
    found = phone_calls(frame)
    assert as_set(calls.calls_by_status(found)) == {("успешный", 4), ("пропущенный", 2)}
    assert as_set(calls.calls_by_agent(found)) == {("A", 3), ("B", 0)}


def test_last_days_of_calls(frame):
    found = phone_calls(frame)
    day = date(2024, 1, 10)
    table = calls.answered_by_day(found, as_of=day)
    assert len(table.columns) == 12
    picked = ["agent", "`2023-12-31`", "`2024-01-09`", "`2024-01-10`", "`2024-01-05`"]
    assert as_set(table.select(picked)) == {("A", 1, 0, 1, 0), ("B", 0, 1, 0, 0), ("TOTAL", 1, 1, 1, 0)}
    missed = dict(as_set(calls.missed_by_day(found, as_of=day)))
    assert len(missed) == 11 and missed[date(2024, 1, 8)] == 2 and sum(missed.values()) == 2
    board = calls.call_board(found, as_of=day)
    assert board.columns == table.columns
    assert as_set(board.where("agent <> 'MISSED'")) == as_set(table)
    assert as_set(board.where("agent = 'MISSED'").select("`2024-01-08`", "`2024-01-10`")) == {(2, 0)}
    assert as_set(calls.recent_totals(found, as_of=day)) == {("answered", 4), ("missed", 2)}


def test_board_has_a_missed_row_without_misses(frame):
    found = phone_calls(frame).where("status = 'успешный'")
    board = calls.call_board(found, as_of=date(2024, 1, 10))
    assert as_set(board.where("agent = 'MISSED'").select("`2024-01-08`")) == {(0,)}


# --- tickets -----------------------------------------------------------------

def test_tickets(frame):
    parts = '["Заявка № 12 ", {"type":"hashtag","text":"#ОСП 3"}, "\\n#ЕМИАС"]'
    messages = frame(
        "id BIGINT, author STRING, text STRING",
        (4, None, '"Заявка №1"'), (5, "a", '"без номера"'), (6, "a", parts), (7, "b", '"Заявка N7 #Закрыта #Кирова"'),
        (8, "b", '"Заявка №8 #ОСП_1 #ОСП_2"'), (9, "b", '"Заявка №9 #ОСП №3 #закрыта"'),
    ).withColumn("text", F.parse_json("text"))
    found = tickets.tickets(messages, link_base="u/")
    assert as_set(found) == {
        (12, "u/6", "a", "Открыто", "ОСП_3", "ЕМИАС", "Заявка №12 #ОСП_3 #ЕМИАС"),
        (7, "u/7", "b", "Решено", "Кирова_38", "", "Заявка №7 #Решено #Кирова"),
        (8, "u/8", "b", "Открыто", "ОСП_1, ОСП_2", "", "Заявка №8 #ОСП_1 #ОСП_2"),
        (9, "u/9", "b", "Открыто", "", "", "Заявка №9 #ОСП_№3 #закрыта"),
    }
    assert as_set(tickets.ticket_status_counts(found)) == {("Открыто", 3), ("Решено", 1)}
    assert as_set(tickets.open_by_group(found)) == {("ОСП_3", 1), ("ОСП_1, ОСП_2", 1), ("", 1)}


# --- recency -----------------------------------------------------------------

def test_recency(frame):
    day = date(2024, 3, 1)

    def patient(name, middle="П", org=77):
        return org, "ОСП 2 отд", name, "И", middle, 1950, 74, None

    patients = frame(
        schemas.FOLLOWUP_PATIENTS,
        patient("A"), patient("B"), patient("C"), patient("D"), patient("E"), patient("F", None), patient("G", org=78),
    )
    visits = frame(
        "tap_number STRING, tap_date DATE, mkab_number STRING, last_name STRING, first_name STRING, middle_name STRING, birth_year STRING",
        ("1", date(2024, 1, 31), "m", "A", "И", "П", "1950"), ("2", date(2024, 1, 1), "m", "A", "И", "П", "1950"),
        ("3", date(2024, 2, 1), "m", "B", "И", "П", "1950"), ("4", date(2024, 2, 10), "m", "C", "И", "П", "1950"),
        ("5", date(2024, 2, 11), "m", "D", "И", "П", "1950"), ("6", date(2024, 1, 1), "m", "F", "И", None, "1950"),
        ("7", date(2024, 2, 29), "m", "E", "И", "П", "1951"),
    )
    bands = recency.recency(patients, visits, org_id=77, as_of=day)
    assert as_set(bands.select("last_name", "subdivision", "tap_date", "band")) == {
        ("A", "ОСП 2", date(2024, 1, 31), "red"), ("B", "ОСП 2", date(2024, 2, 1), "yellow"),
        ("C", "ОСП 2", date(2024, 2, 10), "yellow"), ("D", "ОСП 2", date(2024, 2, 11), ""),
        ("E", "ОСП 2", None, ""), ("F", "ОСП 2", date(2024, 1, 1), "red"),
    }


def test_recency_from_latest_visits_only(frame):
    tables = {
        "visits": frame(
            "tap_number STRING, visited_at TIMESTAMP_NTZ, is_closed INT, patient_id INT",
            ("1", datetime(2024, 1, 1), 1, 1), ("2", datetime(2024, 2, 20), 1, 1), ("3", datetime(2024, 2, 25), 0, 1),
            ("4", datetime(2024, 2, 10), 1, 2), ("5", datetime(2024, 2, 9), 1, 3), ("6", datetime(2024, 2, 28), 1, None),
        ),
        # Patients 2 and 3 are the same person twice.
        "patients": frame(
            "patient_id INT, card_number STRING, last_name STRING, first_name STRING, middle_name STRING, birth_date DATE",
            (1, "m1", "A", "Иван", "П", date(1950, 1, 1)), (2, "m2", "B", "Иван", None, date(1950, 1, 1)),
            (3, "m3", "B", "Игорь", None, date(1950, 5, 5)),
        ),
    }
    patients = frame(schemas.FOLLOWUP_PATIENTS, (77, "ОСП 2", "A", "И", "П", 1950, 74, None), (77, "ОСП 2", "B", "И", None, 1950, 74, None))
    expected = {("A", "m1", date(2024, 2, 20), ""), ("B", "m2", date(2024, 2, 10), "yellow")}
    for latest_only in (True, False):
        visits = extracts.patient_visits(tables, since=date(2024, 1, 1), latest_only=latest_only)
        bands = recency.recency(patients, visits, org_id=77, as_of=date(2024, 3, 1))
        assert as_set(bands.select("last_name", "mkab_number", "tap_date", "band")) == expected


def test_visits_of_one_day_are_ordered_by_time(frame):
    visits = frame(
        "tap_number STRING, tap_date DATE, visited_at TIMESTAMP_NTZ, last_name STRING, first_name STRING, middle_name STRING, birth_year STRING",
        ("9", date(2024, 1, 1), datetime(2024, 1, 1, 9), "A", "И", None, "1950"),
        ("1", date(2024, 1, 1), datetime(2024, 1, 1, 12), "A", "И", None, "1950"),
    )
    assert as_set(recency.latest_visits(visits).select("tap_number")) == {("1",)}
    assert as_set(recency.latest_visits(visits.drop("visited_at")).select("tap_number")) == {("9",)}


# --- extracts ----------------------------------------------------------------

BEGIN, END = datetime(2024, 1, 10, 9), datetime(2024, 1, 10, 9, 15)


def schedule_tables(frame):
    def a_cell(day, resource, doctor=1, busy=1):
        return day, BEGIN, END, busy, doctor, resource, 111, 0, 0

    return {
        "cells": frame(
            "date TIMESTAMP_NTZ, begin_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, busy_type_id INT, doctor_id INT, resource_id BIGINT, "
            "access_code INT, is_used INT, is_out_schedule INT",
            a_cell(datetime(2024, 1, 10), 1), a_cell(datetime(2024, 1, 9), 1), a_cell(datetime(2024, 1, 10), 2),
            a_cell(datetime(2024, 1, 10), 3, doctor=2, busy=None), a_cell(datetime(2024, 1, 10), None),
        ),
        "busy_types": frame("busy_type_id INT, name STRING", (1, "прием")),
        "doctors": frame("doctor_id INT, last_name STRING, first_name STRING, middle_name STRING", (1, "Аа", "Б", "В"), (2, "Гг", None, "Д")),
        "resources": frame(
            "resource_id BIGINT, resource_type_id INT, equipment_id INT, room_id INT, specialty_id INT, department_id INT, in_time INT",
            (1, 1, 1, 1, 5, 1, 1), (2, 1, None, None, None, None, 0), (3, 9, 2, None, 6, 2, 1),
        ),
        "resource_types": frame("resource_type_id INT, name STRING", (1, "Врач")),
        "equipment": frame("equipment_id INT, name STRING, equipment_type_id INT", (1, "eq", 1), (2, "eq2", None)),
        "equipment_types": frame("equipment_type_id INT, name STRING", (1, "type")),
        "rooms": frame("room_id INT, number STRING", (1, "101")),
        "specialties": frame("specialty_id INT, name STRING", (5, "spec")),
        "departments": frame("department_id INT, name STRING, subdivision_id INT", (1, "dep", 1), (2, "dep2", None)),
        "subdivisions": frame("subdivision_id INT, name STRING", (1, "sub")),
    }


def test_schedule_view(frame):
    view = extracts.schedule_view(schedule_tables(frame), as_of=date(2024, 1, 10))
    assert as_set(view) == {
        (1, BEGIN, END, "Врач", "АА Б В", "eq", "type", "101", "прием", 111, 0, 0, 5, "spec", "dep", "sub", 1, 1, 1, 1, 1, 1),
        (3, BEGIN, END, None, None, "eq2", None, None, None, 111, 0, 0, None, None, "dep2", None, 1, 1, 1, 1, 1, 1),
    }
    shown = extracts.only_shown(frame("resource_id BIGINT", (1,), (2,), (None,)), schedule_tables(frame))
    assert as_set(shown) == {(1,)}
    names = [part.split()[0] for part in schemas.SCHEDULE_CELLS.split(", ")]
    assert view.columns == names


def test_visits_and_cards_views(frame):
    units = {
        "departments": frame("department_id INT, name STRING, subdivision_id INT", (1, "dep", 1)),
        "subdivisions": frame("subdivision_id INT, name STRING", (1, "sub")),
    }
    visits = extracts.visits_view(
        {
            "visits": frame(
                "tap_number STRING, visited_at TIMESTAMP_NTZ, is_closed INT, patient_id INT, resource_id INT",
                ("1", datetime(2024, 1, 1), 1, 1, 1), ("2", datetime(2024, 1, 2), 0, 1, 1), ("3", datetime(2023, 12, 31, 23), 1, 1, 1),
                ("4", datetime(2024, 1, 2, 5), 1, None, None),
            ),
            "patients": frame(
                "patient_id INT, card_number STRING, last_name STRING, first_name STRING, middle_name STRING, birth_date DATE",
                (1, "m1", "Аа", "Бб", None, date(1950, 5, 5)),
            ),
            "resources": frame("resource_id INT, department_id INT", (1, 1)),
            **units,
        },
        since=date(2024, 1, 1),
    )
    assert as_set(visits) == {
        ("1", date(2024, 1, 1), "m1", "АА", "Б", None, "1950", "dep", "sub"),
        ("4", date(2024, 1, 2), None, None, None, None, None, None, None),
    }
    card = "date_open DATE, date_close TIMESTAMP_NTZ, card_number STRING, is_closed INT, close_reason_guid STRING, card_type_guid STRING, resource_id INT"
    cards_found = extracts.cards_view(
        {
            "cards": frame(
                card,
                (None, datetime(2025, 1, 1), "1", 1, "ab-1", "T1", 1), (None, datetime(2025, 1, 1, 0, 1), "2", 1, "ab-1", "T1", 1),
                (None, datetime(2024, 5, 1), "3", 1, "AB-1", "t2", 2), (None, datetime(2024, 5, 1), "4", 1, "AB-1", "t3", 1),
                (None, datetime(2024, 5, 1), "5", 1, None, "t2", 1), (None, datetime(2024, 5, 1), "6", 0, "AB-1", "t2", 1),
            ),
            "resources": frame("resource_id INT, doctor_id INT, department_id INT", (1, 1, 1)),
            "doctors": frame("doctor_id INT, last_name STRING, first_name STRING, middle_name STRING", (1, "Аа", "Б", "В")),
            **units,
        },
        since=date(2024, 1, 1), until=date(2025, 1, 1), reason="Ab-1", card_types=["t1", "T2"],
    )
    assert as_set(cards_found.select("card_number", "subdivision_name", "doctor_full_name")) == {
        ("1", "sub", "АА Б В"), ("3", None, None),
    }
