"""The report jobs from landed files or base tables to published tables.

A job takes its sources, the date it reports on and an output folder, and
writes one table per report.  Names, organisation numbers, lines and labels are
arguments.  A report file is given by path, or as the `Newest` one of a folder.
Frames that several reports read are stored once and deleted after the run.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import schemas
from kpiloom.functions.dates import reporting_period
from kpiloom.functions.text import Rules, department, repair_strings, stacked
from kpiloom.operators.history import stored_periods
from kpiloom.operators.incremental import refreshed_days, refreshed_latest, row_digests
from kpiloom.operators.lineage import cut_lineage, stages_removed
from kpiloom.operators.rows import sorted_report
from kpiloom.plans import calls as C
from kpiloom.plans import closures as K
from kpiloom.plans import completeness as A
from kpiloom.plans import extracts as X
from kpiloom.plans import prescriptions as R
from kpiloom.plans import progress as P
from kpiloom.plans import recency as V
from kpiloom.plans import slots as S
from kpiloom.plans import tickets as T
from kpiloom.sinks.tables import (
    append_history,
    is_publish_day,
    published_table,
    replace_table,
    stored_history,
    write_by_unit,
    write_csv,
)
from kpiloom.sinks.versions import manifests, publish, published
from kpiloom.sources.chat import exported_messages
from kpiloom.sources.config import config_table
from kpiloom.sources.files import Newest, NewestPerUnit, source_paths, staged_by_content
from kpiloom.sources.reports import report_scan, tag_by_file, tag_by_unit, with_sequence


@stages_removed()
def admission_job(
    spark: SparkSession,
    clinical_path: str | Newest,
    times_path: str | Newest,
    out: str,
    *,
    org_id: int,
    main_site: str,
    unit_labels: Mapping[str, str],
    clinical_skip: Collection[int] = (0, 2),
    times_skip: Collection[int] = (*range(11), 12),
    times_footer: int = 1,
    clinical_headings: Mapping[str, str] | None = None,
    times_headings: Mapping[str, str] | None = None,
    narrow: Collection[str] = (),
) -> None:
    """Completeness by doctor, violations per unit and mean stay, for the main and the other sites.

    Columns of the violations named in ``narrow`` are written one word per line.
    """
    clinical = report_scan(spark, clinical_path, schemas.ADMISSIONS, skip_rows=clinical_skip, headings=clinical_headings)
    clinical = clinical.where(F.col("org_id") == org_id)
    times = report_scan(
        spark, times_path, schemas.ADMISSION_TIMES, skip_rows=times_skip, skip_footer=times_footer, headings=times_headings
    )
    # Five reports read the two frames, three of them the joined one: each is made once.
    clinical, times = (cut_lineage(df.drop("source_file", "block", "place")) for df in (clinical, times))
    flagged = cut_lineage(A.flag_admissions(clinical, times, main_site=main_site))
    for name, main in (("main", True), ("other_sites", False)):
        write_csv(A.rates(flagged, main_site=main_site, main=main, unit_labels=unit_labels), f"{out}/completeness_{name}")
        write_csv(A.mean_stay(clinical, times, main_site=main_site, main=main), f"{out}/mean_stay_{name}")
    listed = A.violations(flagged)
    listed = listed.withColumns({name: stacked(F.col(name)) for name in narrow})
    write_by_unit(listed, f"{out}/violations", "admission_unit", order=["doctor_name"])


@stages_removed()
def closures_job(
    spark: SparkSession,
    path: str | Newest,
    out: str,
    *,
    org_id: int,
    main_site: str,
    weekly_plan: Mapping[str, int],
    as_of: date,
    total_label: str,
    skip_rows: Collection[int] = (0,),
    headings: Mapping[str, str] | None = None,
) -> None:
    """Closures per weekday and percent of the plan for the reporting period."""
    period = reporting_period(as_of)
    report = report_scan(spark, path, schemas.CHECKUP_REPORT, skip_rows=skip_rows, headings=headings)
    plan = config_table(spark, weekly_plan, "unit STRING, plan BIGINT")
    table = cut_lineage(
        K.weekday_closures(report, plan, org_id=org_id, main_site=main_site, first=period.first, last=period.last)
    )
    write_csv(table, f"{out}/closures")
    write_csv(K.closure_rates(table, total_label), f"{out}/closure_rates")


@stages_removed()
def prescriptions_job(
    spark: SparkSession,
    prescription_path: str | Newest | NewestPerUnit,
    booking_path: str | Newest,
    stage: str,
    out: str,
    *,
    departments: Mapping[str, str],
    as_of: date,
    total_label: str,
    prescription_skip: Collection[int] = tuple(range(1, 12)),
    prescription_footer: int = 18,
    booking_skip: Collection[int] = (1, 2),
    booking_footer: int = 4,
    prescription_headings: Mapping[str, str] | None = None,
    booking_headings: Mapping[str, str] | None = None,
) -> None:
    """Prescriptions against bookings; the stage tables are reused until a file of theirs changes.

    The department of a prescription is that of its file: ``departments`` has
    it by file name, or by unit if the newest file of each unit is asked for.
    """
    columns = schemas.PRESCRIPTIONS.removeprefix("department STRING, ").removesuffix(", seq BIGINT")

    prescription_files, booking_files = source_paths(spark, prescription_path), source_paths(spark, booking_path)

    def scan_prescriptions() -> DataFrame:
        scanned = report_scan(
            spark, prescription_files, columns, skip_rows=prescription_skip, skip_footer=prescription_footer, name_part=".csv",
            headings=prescription_headings,
        )
        if isinstance(prescription_path, NewestPerUnit):
            return with_sequence(tag_by_unit(scanned, prescription_path, departments))
        return with_sequence(tag_by_file(scanned, departments))

    def scan_bookings() -> DataFrame:
        return with_sequence(
            report_scan(
                spark, booking_files, schemas.BOOKINGS.removesuffix(", seq BIGINT"), skip_rows=booking_skip,
                skip_footer=booking_footer, name_part=".csv", headings=booking_headings,
            )
        )

    # Each of these three is read by several reports.
    prescriptions = staged_by_content(spark, f"{stage}/prescriptions", scan_prescriptions, prescription_files, name_part=".csv")
    bookings = staged_by_content(spark, f"{stage}/bookings", scan_bookings, booking_files, name_part=".csv")
    issued = R.first_prescriptions(prescriptions)
    kept, noshow = R.clean_bookings(bookings, as_of=as_of)
    issued, kept = cut_lineage(issued.drop("seq", "source_file")), cut_lineage(kept)
    write_by_unit(R.missing_booking(issued, kept, as_of=as_of), f"{out}/missing_booking", "subdivision")
    write_csv(R.noshow_fulfilled(noshow, issued), f"{out}/noshow_fulfilled")
    by_department = cut_lineage(R.compliance(issued, kept, as_of=as_of))
    write_csv(by_department, f"{out}/compliance")
    write_csv(R.compliance_rollup(by_department, total_label), f"{out}/compliance_rollup")


DAILY_KEYS = ["unit", "department", "doctor_name"]


def kept_daily_counts(cards: DataFrame, path: str, digests: DataFrame | None = None) -> DataFrame:
    """`plans.progress.daily_counts` of all days, kept at ``path``: days whose digest is the stored one are not read again."""
    stored = published(cards.sparkSession, path, schemas.DAILY_COUNTS)
    if digests is None:
        digests = row_digests(cards, "date_close")
    counts = refreshed_days(cards, "date_close", digests, stored, lambda part: P.daily_counts(part, DAILY_KEYS))
    publish(counts, path)
    found = published(cards.sparkSession, path, schemas.DAILY_COUNTS).where("rows IS NOT NULL")
    return found.drop("digest").withColumnRenamed("day", "date_close")


def kept_latest_visits(visits: DataFrame, path: str, added: DataFrame | None = None, gone: DataFrame | None = None) -> DataFrame:
    """The latest visit per person, kept at ``path``.

    ``added`` are the visits that are new or corrected since the last run,
    ``gone`` the numbers of deleted and corrected ones.  All ``visits`` are read
    in the first run, or if neither is given, and else only for persons whose
    stored visit is gone.
    """
    spark = visits.sparkSession
    columns = [name for name in (*V.PERSON, "mkab_number", "tap_number", "tap_date", "visited_at") if name in visits.columns]
    visits = visits.select(*columns).withColumn("birth_year", F.col("birth_year").try_cast("int"))
    if manifests(spark, path) and added is not None and gone is not None:
        latest = refreshed_latest(
            published(spark, path), visits, added.withColumn("birth_year", F.col("birth_year").try_cast("int")), gone,
            person=V.PERSON, key="tap_number", latest=V.latest_visits,
        )
    else:
        latest = V.latest_visits(visits)
    publish(latest.select(*columns), path)
    return published(spark, path)


@stages_removed()
def progress_job(
    cards: DataFrame,
    history_path: str,
    out: str,
    *,
    weights: Mapping[str, float],
    plan: P.Plan,
    as_of: date,
    repair: bool = False,
    counts_path: str | None = None,
    digests: DataFrame | None = None,
    week_headings: bool = False,
) -> None:
    """Plan monitoring over the check-up cards view.

    All figures come from one pass over the cards, or, with ``counts_path``, from
    the daily counts stored there, of which only days that changed are counted
    again.  ``digests`` (see `incremental.file_digests`) tells which without
    reading the cards; by default their rows do.  The daily table is replaced on every run; the weekly ones, the list of cards
    outside the units and the history are written on the publishing day only.
    """
    spark = cards.sparkSession
    period = reporting_period(as_of)
    named = (repair_strings(cards) if repair else cards).select(
        department(F.col("subdivision_name")).alias("unit"),
        F.col("subdivision_name").alias("department"),
        F.col("doctor_full_name").alias("doctor_name"),
        "card_number",
        F.col("date_close").cast("date").alias("date_close"),
    )
    table = config_table(spark, weights, "unit STRING, weight DOUBLE")
    year_start = date(period.past_sunday.year, 1, 1)
    due = plan.due(year_start, period.past_sunday)
    if counts_path is None:
        daily = cut_lineage(P.daily_counts(named.where(F.col("date_close") <= F.lit(period.yesterday)), DAILY_KEYS))
    else:
        daily = kept_daily_counts(named, counts_path, digests).where(F.col("date_close") <= F.lit(period.yesterday))
    yesterday = P.plan_progress(daily, table, plan, P.Span(start=year_start, end=period.yesterday, due=due))
    replace_table(yesterday, f"{out}/daily")
    if not is_publish_day(as_of):
        return
    start, end = period.past_monday, period.past_sunday
    cumulative, week = P.Span(start=year_start, end=end, due=due), P.Span(start=start, end=end, due=plan.due(start, end))
    combined = cut_lineage(P.plan_progress_combined(daily, table, plan, cumulative, week))
    weekly = combined.where(F.col("done_week").isNotNull()).select(
        "unit",
        F.col("target_week").alias("target"),
        F.col("done_week").alias("done"),
        F.col("efficiency_week").alias("efficiency"),
    )
    append_history(
        P.week_history(weekly, start, end), history_path, schemas.HISTORY, ["unit", "period_start"], as_of=as_of
    )
    history = stored_history(spark, history_path, schemas.HISTORY)
    weeks = stored_periods(history, "period_start")
    total = combined.select("unit", "annual_plan", "target", "done", "efficiency")
    weekly = P.published_progress(total, history, weeks)
    replace_table(P.with_week_headings(weekly, weeks) if week_headings else weekly, f"{out}/weekly")
    scoped = P.in_scope(daily, list(weights))
    for name, keys in (("departments", ["department"]), ("doctors", ["department", "doctor_name"])):
        counts = P.cumulative_vs_period(scoped, keys, cutoff=end, start=start, end=end)
        replace_table(sorted_report(counts, *keys), f"{out}/{name}")
    outside = P.out_of_scope(named, list(weights))
    replace_table(sorted_report(outside, "unit", "doctor_name"), f"{out}/outside")


def cards_job(
    tables: X.Tables,
    history_path: str,
    out: str,
    *,
    since: date,
    reason: str,
    card_types: Sequence[str],
    weights: Mapping[str, float],
    plan: P.Plan,
    as_of: date,
    repair: bool = False,
) -> None:
    """`progress_job` from the base tables: check-up cards of a reason and kinds, closed since a date."""
    cards = X.cards_view(tables, since=since, until=as_of, reason=reason, card_types=card_types)
    progress_job(cards, history_path, out, weights=weights, plan=plan, as_of=as_of, repair=repair)


@stages_removed()
def schedule_job(tables: X.Tables, out: str, *, now: datetime, repair: bool = False) -> None:
    """Schedule gaps, waits for doctors and scanners and open minutes, from the base tables."""
    cells = X.schedule_cells(tables, as_of=now.date())

    def named(found: DataFrame) -> DataFrame:
        rows = cut_lineage(X.name_resources(found, tables))  # one row per resource, read by several reports
        return repair_strings(rows) if repair else rows

    gaps = named(S.date_gaps(cells, first=now.date(), columns=["doctor_id"]))
    write_csv(sorted_report(S.doctor_gaps(gaps), "subdivision_name"), f"{out}/gaps")
    found = named(S.first_free_cells(cells, now=now, columns=["doctor_id"]))
    order = ("subdivision_name", "specialty_name")
    write_csv(sorted_report(S.general_practice_waits(found), *order), f"{out}/general_practice")
    write_csv(sorted_report(S.specialist_waits(found), *order), f"{out}/specialists")
    write_csv(sorted_report(S.equipment_waits(found), "subdivision_name"), f"{out}/scanners")
    minutes = S.open_minutes(cells, day=now.date())
    write_csv(X.only_shown(minutes, tables), f"{out}/open_minutes")


@stages_removed()
def calls_job(
    spark: SparkSession, path: str | Newest, out: str, *, line: int, agents: Rules, as_of: date, total_label: str, missed_label: str,
    headings: Mapping[str, str] | None = None,
) -> None:
    """Counts by status and agent, the board of the last days and its two totals."""
    scanned = report_scan(spark, path, schemas.CALLS, headings=headings).drop("source_file", "block", "place")
    calls = cut_lineage(C.line_calls(scanned, line=line, agents=agents))
    replace_table(C.calls_by_status(calls), f"{out}/by_status")
    replace_table(C.calls_by_agent(calls), f"{out}/by_agent")
    board = C.call_board(calls, as_of=as_of, total_label=total_label, missed_label=missed_label)
    replace_table(board, f"{out}/board")
    replace_table(C.recent_totals(calls, as_of=as_of), f"{out}/totals")


@stages_removed()
def tickets_job(spark: SparkSession, path: str | Newest, out: str, *, link_base: str) -> None:
    """All tickets of a chat export of any layout, counts by status, open ones by group."""
    messages = exported_messages(spark, path)
    replace_table(T.tickets(messages, link_base=link_base), f"{out}/tickets")
    found = published_table(spark, f"{out}/tickets")
    replace_table(T.ticket_status_counts(found), f"{out}/by_status")
    replace_table(T.open_by_group(found), f"{out}/open_by_group")


@stages_removed()
def recency_job(
    spark: SparkSession,
    patients_path: str | Newest,
    visits: DataFrame,
    out: str,
    *,
    org_id: int,
    as_of: date,
    skip_rows: Sequence[int] = (0,),
    headings: Mapping[str, str] | None = None,
) -> None:
    """Followed-up patients with their latest visit, one folder per subdivision, oldest visit first.

    ``visits`` is the visits view or `extracts.patient_visits`, of which the
    latest ones suffice, such as those of `kept_latest_visits`.
    """
    patients = report_scan(spark, patients_path, schemas.FOLLOWUP_PATIENTS, skip_rows=skip_rows, headings=headings)
    found = V.recency(patients, visits, org_id=org_id, as_of=as_of)
    write_by_unit(found, out, "subdivision", order=["tap_date"])


def visits_job(
    patients_path: str | Newest,
    tables: X.Tables,
    out: str,
    *,
    since: date,
    org_id: int,
    as_of: date,
    skip_rows: Sequence[int] = (0,),
) -> None:
    """`recency_job` from the base tables: the latest closed visit of each patient since a date."""
    visits = X.patient_visits(tables, since=since, latest_only=True)
    recency_job(visits.sparkSession, patients_path, visits, out, org_id=org_id, as_of=as_of, skip_rows=skip_rows)
