"""Words, codes and patterns that have to equal what the source
systems write, or the results change.  Names of people, phone lines, chat ids
and organisation numbers are not here: they are parameters of the reports.
"""

# Calendar labels, Monday first.
WEEKDAYS = (
    "Понедельник",
    "Вторник",
    "Среда",
    "Четверг",
    "Пятница",
    "Суббота",
    "Воскресенье",
)

# Site codes inside unit names.
SITE_AT_END = r"ОСП \d$"
SITE_AT_START = r"^ОСП \d"
SITE_CODE = r"ОСП \d"
SITE_ANYWHERE = r"ОСП №?\d"
SITE_CODE_NUMBERED = r"ОСП №?\d"

# Unit names that belong to a site without carrying its code: (word, site).
SITE_WORDS = (
    ("ЦАОП", "ЦАОП"),
    ("Ленинградская", "Ленинградская 9"),
    ("Централизованное отделение", "Ленинградская 9"),
)
SITE_UNKNOWN = "Не указано"

# Admission department.
STATE_SATISFACTORY = "Удовлет"
EXAM_LIMIT_SATISFACTORY = 60
EXAM_LIMIT_OTHER = 30
PROFILE_EXCLUDED = "А и Реан"
YES = "Да"
NO = "Нет"

# Booking marks and summary lines of the booking report.
MARK_NO_SHOW = "Неявка"
MARK_CANCELLED = "Запись отменена"
MARK_MOVED = "Запись перенесена"
MARK_PLANNED = "Запланирован"
SUMMARY_WORDS = ("Максимум", "Итог", "Среднее", "Количество")
MIDNIGHT = "00:00"
OUTSIDE_SCHEDULE = "вне расписания"

# Check-up closures.
CLOSURE_DONE = "Обследование пройдено"
CLOSURE_EXAMS = (
    "404н Диспансеризация",
    "404н Профилактические медицинские осмотры",
)

# Schedule cells.
RESOURCE_DOCTOR = "Врач"
RESOURCE_EQUIPMENT = "Оборудование"
ROOM_INPATIENT = "Стационар"
SCANNER_TYPES = (
    "Магнитно-резонансный томограф",
    "Компьютерный томограф",
    "Компьютерные томографы",
)
GENERAL_SPECIALTIES = (1815, 1816, 1857, 1858, 1895)
ACCESS_NOT_OPEN = 111
NO_SLOT = 9999
ACCESS_BITS = {
    "ac_registrar": 1,
    "ac_doctor": 2,
    "ac_internet": 4,
    "ac_other_mo": 8,
    "ac_infomat": 32,
    "ac_call_center": 64,
}

# Calls.
CALL_ANSWERED = "успешный"
CALL_MISSED = "пропущенный"

# Support tickets: spellings are replaced in this order.
TICKET_SPELLINGS = (
    ("Заявка № ", "Заявка №"),
    ("Заявка  №", "Заявка №"),
    ("Заявка N ", "Заявка №"),
    ("Заявка N", "Заявка №"),
    ("#Открыта", "#Открыто"),
    ("#Решена", "#Решено"),
    ("#решено", "#Решено"),
    ("#Закрыта", "#Решено"),
    ("#ОСП ", "#ОСП_"),
    ("#ОСП №", "#ОСП_"),
)
TICKET_WORD = "Заявка"
TICKET_NUMBER = r"Заявка №(\d+)"
TICKET_SITE_TAG = r"#(ОСП_\d)"
TICKET_GROUP_TAGS = (
    ("#Кирова", "Кирова_38"),
    ("#Ленинград", "Ленинградская_9"),
    ("#ЦАОП", "ЦАОП"),
    ("#Общая", "Общая"),
)
TICKET_THEME_TAGS = (
    ("#ЕМИАС", "ЕМИАС"),
    ("#Оснащение", "Оснащение"),
    ("#Списание", "Списание"),
    ("#Проект", "Проект"),
)
TICKET_SOLVED_TAG = "#Решено"
TICKET_SOLVED = "Решено"
TICKET_OPEN = "Открыто"
TICKET_INTRO_RECORDS = 3

# Days since the last visit.
BAND_RED_DAYS = 30
BAND_YELLOW_DAYS = 20

# Gap to plan in percent points: score 5 below the first limit, 3 below the second, else 0.
GAP_LIMITS = (1.97, 3.0)
