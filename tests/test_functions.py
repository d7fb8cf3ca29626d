"""Column functions on worked examples."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kpiloom.functions import dates as D
from kpiloom.functions import numbers as N
from kpiloom.functions import text as X
from kpiloom.functions import tickets as K
from kpiloom.session import shuffle_settings


def values(frame, schema, items, build):
    """The expression built on one column, per item."""
    df = frame(f"i INT, v {schema}", *enumerate(items))
    return [row[0] for row in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_half_even(frame):
    assert values(frame, "DOUBLE", [0.5, 1.5, 2.5, None], N.half_even) == [0.0, 2.0, 2.0, None]
    assert values(frame, "DOUBLE", [88.665, 0.125, 0.375], lambda c: N.half_even(c, 2)) == [88.66, 0.12, 0.38]


def test_percent(frame):
    df = frame("a BIGINT, b BIGINT", (35, 40), (1, 8), (1, 0))
    assert [row[0] for row in df.select(N.percent(F.col("a"), F.col("b"))).collect()] == [88.0, 12.0, None]
    assert [row[0] for row in df.select(N.share_percent(F.col("a"), F.col("b"))).collect()] == [88.0, 12.0, None]


def test_share_divides_first(frame):
    # 100 * 55 / 200 is the tie 27.5 exactly; 55 / 200 * 100 lies above it.
    df = frame("a BIGINT, b BIGINT", (57, 200))
    row = df.select(N.percent(F.col("a"), F.col("b")), N.share_percent(F.col("a"), F.col("b"))).first()
    assert row[0] == 28.0
    assert row[1] == round(57 / 200 * 100)


def test_access_flags(frame):
    df = frame("code INT", (111,), (8,), (None,))
    rows = df.select([flag.alias(name) for name, flag in N.access_flags(F.col("code")).items()]).collect()
    assert tuple(rows[0]) == (1, 1, 1, 1, 1, 1)
    assert tuple(rows[1]) == (0, 0, 0, 1, 0, 0)
    assert tuple(rows[2]) == (0, 0, 0, 0, 0, 0)


def test_gap_score(frame):
    assert values(frame, "DOUBLE", [1.96, 1.97, 2.995, 3.0, -4.0, None], N.gap_score) == [5, 3, 3, 0, 5, None]


@pytest.mark.parametrize(
    "as_of, first, past_monday, past_sunday",
    [
        (date(2024, 1, 15), date(2024, 1, 8), date(2024, 1, 8), date(2024, 1, 14)),
        (date(2024, 1, 17), date(2024, 1, 15), date(2024, 1, 8), date(2024, 1, 14)),
        (date(2024, 1, 1), date(2023, 12, 25), date(2023, 12, 25), date(2023, 12, 31)),
    ],
)
def test_reporting_period(frame, as_of, first, past_monday, past_sunday):
    period = D.reporting_period(as_of)
    assert (period.first, period.last) == (first, as_of)
    assert (period.past_monday, period.past_sunday) == (past_monday, past_sunday)
    columns = D.period_columns(F.col("d"))
    row = frame("d DATE", (as_of,)).select([column.alias(name) for name, column in columns.items()]).first().asDict()
    assert row == {
        "first_date": period.first,
        "last_date": period.last,
        "yesterday": period.yesterday,
        "past_monday": period.past_monday,
        "past_sunday": period.past_sunday,
        "year_start": period.year_start,
    }


def test_workdays(frame):
    days_off = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 6)]
    assert D.workdays_between(date(2024, 1, 1), date(2024, 1, 14), days_off) == 8
    with pytest.raises(ValueError):
        D.workdays_between(date(2024, 1, 2), date(2024, 1, 1))
    spans = [
        (date(2024, 1, 1), date(2024, 1, 14)),
        (date(2024, 1, 6), date(2024, 1, 7)),
        (date(2023, 12, 30), date(2024, 2, 29)),
        (date(1969, 12, 28), date(1970, 1, 9)),
        (date(2024, 1, 3), date(2024, 1, 3)),
    ]
    rows = frame("a DATE, b DATE", *spans).select(D.workdays(F.col("a"), F.col("b"), days_off)).collect()
    assert [row[0] for row in rows] == [D.workdays_between(a, b, days_off) for a, b in spans]


def test_workdays_start_after_end(frame):
    df = frame("a DATE, b DATE", (date(2024, 1, 2), date(2024, 1, 1)))
    with pytest.raises(PySparkException):
        df.select(D.workdays(F.col("a"), F.col("b"))).collect()


def test_time_labels(frame):
    moments = [datetime(2024, 1, 2), datetime(2024, 1, 2, 10, 0)]
    assert values(frame, "TIMESTAMP_NTZ", moments, D.minute_label) == ["2024-01-02 вне расписания", "2024-01-02 10:00"]
    assert values(frame, "DATE", [date(2024, 1, 1), date(2024, 1, 7)], D.weekday_label) == ["Понедельник", "Воскресенье"]
    assert values(frame, "DATE", [date(2024, 3, 9)], D.day_month) == ["09.03"]
    assert D.week_heading(date(2024, 1, 8), date(2024, 1, 14)) == "08.01-14.01"


def test_spans_of_time(frame):
    df = frame("a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", (datetime(2024, 1, 1, 23, 50), datetime(2024, 1, 2, 0, 5, 30)))
    row = df.select(D.minutes_between(F.col("a"), F.col("b")), D.days_until(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (15.5, 1)


def test_parsing(frame):
    texts = ["05.01.2024 10:00:01", "2024-01-05", None]
    parsed = values(frame, "STRING", texts, lambda c: D.parse_timestamp(c, "dd.MM.yyyy HH:mm:ss"))
    assert parsed == [datetime(2024, 1, 5, 10, 0, 1), None, None]
    assert values(frame, "STRING", ["05.01.2024", "x"], lambda c: D.parse_date(c, "dd.MM.yyyy")) == [date(2024, 1, 5), None]


def test_department(frame):
    units = [
        "Поликлиника ОСП №3 каб. 1", "ОСП 2", "ОСП  4", "ЦАОП центр", "ул. Ленинградская", "Централизованное отделение",
        None, "Лаборатория", "ЦАОП ОСП 5",
    ]
    assert values(frame, "STRING", units, X.department) == [
        "ОСП №3", "ОСП 2", "ОСП  4", "ЦАОП", "Ленинградская 9", "Ленинградская 9", "Не указано", "Лаборатория", "ОСП 5",
    ]


def test_sites(frame):
    units = ["Приемное ОСП 2", "ОСП 3 второй корпус", "ОСП 4, ОСП 5", "Общее"]
    assert values(frame, "STRING", units, lambda c: X.site_suffix(c, "М")) == ["ОСП 2", "М", "ОСП 4", "М"]
    assert values(frame, "STRING", units, lambda c: X.site_prefix(c, "М")) == ["М", "ОСП 3", "ОСП 4", "М"]


def test_ordered_rules(frame):
    rules = (("ab", "first"), ("b", "second"))
    assert values(frame, "STRING", ["xab", "xb", "x", None], lambda c: X.first_match(c, rules)) == ["first", "second", None, None]
    assert values(frame, "STRING", ["xab", "xb", "x", None], lambda c: X.current_unit(c, rules)) == ["first", "second", "x", None]


def test_booking_name(frame):
    names = ["№1 Альфа Бета Гамма, 1.1.1990", "№1 Альфа Бета", None, "№2 а б в,г,"]
    assert values(frame, "STRING", names, X.booking_name) == ["АЛЬФА БЕТА ГАММА", None, None, "А Б ВГ"]


def test_full_name_is_null_with_a_null_part(frame):
    df = frame("a STRING, b STRING, c STRING", ("Аа", "Бб", "Вв"), ("Аа", None, "Вв"))
    names = df.select(X.full_name(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [row[0] for row in names] == ["АА ББ ВВ", None]


def test_repair(frame):
    good = "Привет, ёж №5 — «да»"
    garbled = good.encode("cp1251").decode("latin1")
    df = X.repair_strings(frame("a STRING, n INT, b STRING", (garbled, 1, "plain"), (None, 2, "Ïðèâåò")))
    assert [tuple(row) for row in df.collect()] == [(good, 1, "plain"), (None, 2, "Привет")]


def test_display_texts(frame):
    assert values(frame, "STRING", ["a b c"], X.stacked) == ["a\nb\nc"]
    assert values(frame, "BOOLEAN", [True, False], X.yes_no) == ["Да", "Нет"]


def test_ticket_spellings_in_order(frame):
    texts = [
        "Заявка № 5", "Заявка  №5", "Заявка N 5", "Заявка N5", "#Открыта", "#Решена", "#решено", "#Закрыта", "#ОСП 3", "#ОСП №3",
    ]
    assert values(frame, "STRING", texts, K.unify_spelling) == [
        "Заявка №5", "Заявка №5", "Заявка №5", "Заявка №5", "#Открыто", "#Решено", "#Решено", "#Решено", "#ОСП_3", "#ОСП_№3",
    ]


def test_ticket_tags(frame):
    texts = ["#ОСП_1 и #Кирова и #ОСП_2 #ОСП_1", "#ОСП_№3", "#Общая #ЦАОП #Ленинградская"]
    assert values(frame, "STRING", texts, lambda c: K.listed(K.groups(c))) == [
        "ОСП_1, ОСП_2, ОСП_1, Кирова_38", "", "Ленинградская_9, ЦАОП, Общая",
    ]
    assert values(frame, "STRING", ["#Проект #ЕМИАС", "-"], lambda c: K.listed(K.themes(c))) == ["ЕМИАС, Проект", ""]
    assert values(frame, "STRING", ["#Решено", "#закрыто"], K.status) == ["Решено", "Открыто"]
    assert values(frame, "STRING", ["Заявка №12 x", "нет"], K.ticket_digits) == ["12", ""]


def test_plain_text(frame):
    contents = ['"a\\nb"', '["a", {"type":"bold","text":"b\\nc"}, "d"]', '""', "[]"]
    assert values(frame, "STRING", contents, lambda c: K.plain_text(F.parse_json(c))) == ["a b", "ab cd", "", ""]


def test_shuffle_settings():
    assert shuffle_settings(10, 8) == {"spark.sql.shuffle.partitions": "16"}
    assert shuffle_settings(200 * 2**20 * 1000 + 1, 8) == {"spark.sql.shuffle.partitions": "1001"}
