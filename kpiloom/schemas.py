"""Declared layouts of the report sources as DDL text (by name, never inferred)."""

ADMISSIONS = (
    "org_id BIGINT, card_number STRING, patient_name STRING, admission_unit STRING, doctor_name STRING, "
    "admit_date STRING, admit_time STRING, diagnosis STRING, state_on_admission STRING, exam_time TIMESTAMP_NTZ, "
    "minutes_to_exam DOUBLE, lab_ref STRING, ecg_ref STRING, instr_ref STRING"
)
ADMISSION_TIMES = (
    "card_number STRING, profile_unit STRING, transfer_time TIMESTAMP_NTZ, "
    "stay_minutes_from_exam DOUBLE, stay_minutes DOUBLE"
)
CHECKUP_REPORT = (
    "org_id BIGINT, unit STRING, closed_at STRING, close_reason STRING, exam_type STRING, patient_name STRING"
)
PRESCRIPTIONS = (
    "department STRING, series_number STRING, issue_date STRING, doctor_name STRING, insurance_no STRING, "
    "patient_name STRING, category_code STRING, address STRING, drug STRING, quantity DOUBLE, seq BIGINT"
)
BOOKINGS = (
    "subdivision STRING, room STRING, patient_name STRING, booked_at TIMESTAMP_NTZ, mark STRING, seq BIGINT"
)
CHECKUP_CARDS = (
    "date_open DATE, date_close DATE, card_number STRING, subdivision_name STRING, doctor_full_name STRING"
)
SCHEDULE_CELLS = (
    "resource_id BIGINT, begin_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, resource_type STRING, "
    "doctor_full_name STRING, equipment_name STRING, equipment_type STRING, cabinet_number STRING, "
    "cell_type STRING, access_code INT, is_used INT, is_out_schedule INT, specialty_id INT, specialty_name STRING, "
    "department_name STRING, subdivision_name STRING, ac_registrar INT, ac_doctor INT, ac_internet INT, "
    "ac_other_mo INT, ac_infomat INT, ac_call_center INT"
)
VISITS = (
    "tap_number STRING, tap_date DATE, mkab_number STRING, last_name STRING, first_name STRING, "
    "middle_name STRING, birth_year INT, department_name STRING, subdivision_name STRING"
)
FOLLOWUP_PATIENTS = (
    "org_id BIGINT, unit STRING, last_name STRING, first_name STRING, middle_name STRING, birth_year INT, "
    "age INT, last_visit STRING"
)
CALLS = (
    "incoming_line BIGINT, first_answerer STRING, status STRING, type STRING, call_date STRING, call_time STRING"
)
CHAT_MESSAGE = "id BIGINT, author STRING, text VARIANT"
CHAT_EXPORT = f"messages ARRAY<STRUCT<{CHAT_MESSAGE}>>"
DAILY_COUNTS = (
    "day DATE, digest STRING, unit STRING, department STRING, doctor_name STRING, cards BIGINT, rows BIGINT"
)
HISTORY = (
    "unit STRING, period_start DATE, period_end DATE, target BIGINT, fact BIGINT, efficiency DOUBLE"
)
