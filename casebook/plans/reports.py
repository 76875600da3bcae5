"""Read queries: dashboard, case list, review list, case detail, run log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions.text import UNDETERMINED, ascii_like, ascii_lower, mean2, or_else
from casebook.operators.spread import prefix_fold
from casebook.sources.work import Work

ACTION_STATUSES = ("CAN_BO_SUNG", "DANG_SO_HOA", "CHO_KIEM_TRA")
ACTION_ROWS = 10
RUN_ROWS = 50
HISTORY_ROWS = 12
#: Case columns a search looks into.
SEARCHED = ("person_name_display", "person_name_raw", "citizen_id")
MAX_PAGE_SIZE = 200
DEFAULT_PAGE_SIZE = 50


def present(cases: DataFrame) -> DataFrame:
    return cases.filter("is_present")


# --- dashboard ---------------------------------------------------------------------------


def unit_status_totals(cases: DataFrame) -> DataFrame:
    """Present cases summed per unit and status: the small base of all dashboard figures.

    Progress is summed as a decimal, so the result does not depend on the order of rows.
    """
    return (
        present(cases)
        .groupBy(or_else(F.col("unit_code"), UNDETERMINED).alias("unit"), F.col("effective_status").alias("status"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("progress_percent").cast("decimal(9,2)")).alias("progress"),
            F.sum("missing_priority1_count").alias("missing_p1"),
        )
    )


def status_histogram(totals: DataFrame) -> DataFrame:
    """Cases per status; the five known statuses always appear."""
    zero = totals.sparkSession.createDataFrame([(s, 0) for s in schema.CASE_STATUSES], "status string, n bigint")
    return totals.select("status", "n").union(zero).groupBy("status").agg(F.sum("n").alias("n"))


def overall(totals: DataFrame) -> DataFrame:
    """Total cases, mean progress, missing priority-1 types, cases still to be worked on."""
    summed = totals.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.sum("progress").alias("_progress"),
        F.coalesce(F.sum("missing_p1"), F.lit(0)).alias("missing_p1"),
        F.coalesce(F.sum(F.when(F.col("status").isin("DANG_SO_HOA", "CHUA_XU_LY"), F.col("n"))), F.lit(0)).alias(
            "open_cases"
        ),
        F.count_distinct("unit").alias("units"),
    )
    return summed.select(
        "total", mean2(F.col("_progress"), F.col("total")).alias("progress"), "missing_p1", "open_cases", "units"
    )


def unit_progress(totals: DataFrame) -> DataFrame:
    """Mean progress and number of cases per unit, in code-point order."""
    return (
        totals.groupBy("unit")
        .agg(F.sum("progress").alias("_progress"), F.sum("n").alias("n"))
        .select("unit", mean2(F.col("_progress"), F.col("n")).alias("progress"), F.col("n").alias("count"))
        .orderBy("unit")
    )


def needs_action() -> Column:
    return F.col("effective_status").isin(*ACTION_STATUSES) | (F.col("warning_count") > 0)


def action_queue(cases: DataFrame, rows: int = ACTION_ROWS) -> DataFrame:
    """The first cases that need attention."""
    return present(cases).filter(needs_action()).orderBy("case_key").limit(rows)


def active_warnings(warnings: DataFrame) -> DataFrame:
    """All active warnings, those of absent cases included."""
    return warnings.filter("active").agg(F.count("*").alias("n"))


def run_log(runs: DataFrame, rows: int = RUN_ROWS) -> DataFrame:
    return runs.orderBy(F.desc("run_id")).limit(rows)


def last_run(runs: DataFrame) -> DataFrame:
    return run_log(runs, 1)


@dataclass(frozen=True)
class Dashboard:
    counts: DataFrame
    overall: DataFrame
    units: DataFrame
    actions: DataFrame
    warnings: DataFrame
    last_run: DataFrame


def dashboard(cases: DataFrame, warnings: DataFrame, runs: DataFrame) -> Dashboard:
    """All dashboard parts. The cases are aggregated once: three parts share a cached base of
    one row per unit and status."""
    totals = unit_status_totals(cases).cache()
    return Dashboard(
        counts=status_histogram(totals),
        overall=overall(totals),
        units=unit_progress(totals),
        actions=action_queue(cases),
        warnings=active_warnings(warnings),
        last_run=last_run(runs),
    )


# --- case list ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CaseFilter:
    q: str = ""
    status: str = ""
    unit: str = ""
    warning: bool = False
    missing_p1: bool = False


@dataclass(frozen=True)
class CasePage:
    items: DataFrame
    page: int
    page_size: int
    total: int
    total_pages: int


def matches(f: CaseFilter) -> Column:
    """Conjunction of the filters that look at the case row alone."""
    terms = [F.col("is_present")]
    if f.q:
        terms.append(reduce(lambda a, b: a | b, [ascii_like(F.col(n), f.q) for n in SEARCHED]))
    if f.status:
        terms.append(F.col("effective_status") == f.status)
    if f.unit:
        terms.append(F.col("unit_code") == f.unit)
    if f.missing_p1:
        terms.append(F.col("missing_priority1_count") > 0)
    return reduce(lambda a, b: a & b, terms)


def filter_cases(cases: DataFrame, f: CaseFilter, warnings: DataFrame | None = None) -> DataFrame:
    """Cases passing all filters. The warning filter is a semi join on the distinct cases with
    an active warning, so many warnings of one case collapse before the shuffle."""
    chosen = cases.filter(matches(f))
    if f.warning:
        warned = warnings.filter("active").select("case_key").distinct()
        chosen = chosen.join(warned, "case_key", "left_semi")
    return chosen


def sort_value(sort: str) -> tuple[Column, bool]:
    """What the case list is sorted by, and whether it descends."""
    ascending = {
        "progress": F.col("progress_percent"),
        "name": ascii_lower(F.coalesce("person_name_display", "folder_name")),
    }
    return (ascending[sort], False) if sort in ascending else (F.col("last_scanned_at"), True)


def sort_columns(sort: str) -> list[Column]:
    """Sort order of the case list; the case key breaks ties."""
    value, descending = sort_value(sort)
    return [value.desc() if descending else value.asc(), F.asc("case_key")]


def clamp_page(page: int, page_size: int, total: int) -> tuple[int, int, int]:
    """(page, page size, total pages) within bounds; there is always one page."""
    size = min(max(page_size, 1), MAX_PAGE_SIZE)
    pages = max(1, -(-total // size))
    return min(max(page, 1), pages), size, pages


def page_numbers(requests: DataFrame, total: Column) -> DataFrame:
    """The clamp of many (``page``, ``page_size``) requests against ``total`` rows."""
    size = F.least(F.greatest(F.col("page_size"), F.lit(1)), F.lit(MAX_PAGE_SIZE))
    pages = F.greatest(F.lit(1), F.ceil(total / size))
    return requests.select(
        *requests.columns,
        size.cast("bigint").alias("size"),
        pages.cast("bigint").alias("total_pages"),
        F.least(F.greatest(F.col("page"), F.lit(1)), pages).cast("bigint").alias("shown_page"),
    )


def page_rows(chosen: DataFrame, sort: str, page: int, page_size: int) -> DataFrame:
    return chosen.orderBy(*sort_columns(sort)).offset((page - 1) * page_size).limit(page_size)


def page_at(chosen: DataFrame, sort: str, page: int, page_size: int, work: Work) -> DataFrame:
    """Any page by its number; no task holds the rows before it.

    The sort values and keys are range-partitioned, rows are counted by range (one number for each partition), and only the
    ranges that hold the page are read and partitioned again, until little more than the page is left. The page's
    rows, at most ``MAX_PAGE_SIZE``, are then fetched by key.
    """
    value, descending = sort_value(sort)
    order = [F.desc("_value") if descending else F.asc("_value"), F.asc("case_key")]
    left, before = chosen.select(value.alias("_value"), "case_key"), (page - 1) * page_size
    rows = None
    while rows is None or rows > 4 * page_size:
        ranged = left.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
        kept = work.keep(ranged, "ranges", by="_range")
        sizes = sorted(tuple(r) for r in kept.groupBy("_range").count().collect())
        wanted, passed, skipped = [], 0, 0
        for number, size in sizes:
            if passed + size <= before:
                skipped = passed + size
            elif passed < before + page_size:
                wanted.append((number, size))
            passed += size
        found = sum(size for _, size in wanted)
        left = kept.filter(F.col("_range").isin([n for n, _ in wanted])).drop("_range")
        before -= skipped
        if rows is not None and found >= rows:
            break  # ranges of very few rows, or equal values throughout
        rows = found
    keys = left.orderBy(*order).offset(before).limit(page_size)
    return chosen.join(F.broadcast(keys.select("case_key")), "case_key", "left_semi").orderBy(*sort_columns(sort))


def page_after(chosen: DataFrame, sort: str, value: object, key: str, page_size: int) -> DataFrame:
    """The rows that follow the one with this ``sort_value`` (None for a null) and case key.

    Tasks keep ``page_size`` rows however far the page lies; ``page_rows`` keeps all pages before it too.
    """
    by, descending = sort_value(sort)
    tie = by.eqNullSafe(F.lit(value)) & (F.col("case_key") > key)
    if value is None:  # nulls are the least values
        later = F.lit(False) if descending else by.isNotNull()
    elif descending:
        later = (by < F.lit(value)) | by.isNull()
    else:
        later = by > F.lit(value)
    return chosen.filter(later | tie).orderBy(*sort_columns(sort)).limit(page_size)


def case_page(
    cases: DataFrame,
    f: CaseFilter,
    warnings: DataFrame | None = None,
    sort: str = "updated",
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    work: Work | None = None,
) -> CasePage:
    """One page of the case list. With ``work`` pages far down cost no more than near ones."""
    chosen = filter_cases(cases, f, warnings)
    total = chosen.count()
    page, size, pages = clamp_page(page, page_size, total)
    items = page_rows(chosen, sort, page, size) if work is None else page_at(chosen, sort, page, size, work)
    return CasePage(items, page, size, total, pages)


def distinct_units(cases: DataFrame) -> DataFrame:
    return present(cases).filter("unit_code is not null").select("unit_code").distinct().orderBy("unit_code")


def case_picker(cases: DataFrame) -> DataFrame:
    return (
        present(cases)
        .select("case_key", "folder_name", "person_name_display")
        .orderBy(F.coalesce("person_name_display", "folder_name"), "case_key")
    )


def one_case(cases: DataFrame, key: str) -> DataFrame:
    return cases.filter(F.col("case_key") == key)


def one_document(documents: DataFrame, path: str) -> DataFrame:
    return documents.filter((F.col("relative_path") == path) & F.col("is_present"))


# --- review list and case detail ---------------------------------------------------------


def review_list(cases: DataFrame, warnings: DataFrame) -> DataFrame:
    """Present cases with their number of active warnings, 0 included."""
    counted = warnings.filter("active").groupBy("case_key").agg(F.count("*").alias("_n"))
    return (
        present(cases)
        .select("case_key", "folder_name", "person_name_display", "effective_status")
        .join(counted, "case_key", "left")
        .withColumn("warning_count", F.coalesce("_n", F.lit(0)).cast("bigint"))
        .drop("_n")
        .orderBy("folder_name", "case_key")
    )


def present_documents(documents: DataFrame) -> DataFrame:
    return documents.filter("is_present")


def severity_rank() -> Column:
    """0 for WARNING, which a case's detail shows before ERROR, else 1."""
    return F.when(F.col("severity") == "WARNING", 0).otherwise(1)


def numbered(rows: DataFrame, order: list[str], keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Rows with their ``position`` (from 1) among the rows of their case, of which there may be any number.

    ``order`` must be unique within a case.
    """
    folded = prefix_fold(rows, ["case_key"], order, sums={"_before": F.lit(1)}, lasts={}, keep=keep)
    return folded.withColumn("position", (F.col("_before") + 1).cast("bigint")).drop("_before")


def recent_history(history: DataFrame, rows: int = HISTORY_ROWS) -> DataFrame:
    """The newest audit rows of every case (``position`` 1 is the newest).

    The rank filter lets Spark drop surplus rows before the shuffle.
    """
    newest = Window.partitionBy("case_key").orderBy(F.desc("created_at"), F.desc("seq"))
    return history.withColumn("position", F.row_number().over(newest)).filter(F.col("position") <= rows)


def detail_counts(
    cases: DataFrame, documents: DataFrame, warnings: DataFrame, history: DataFrame
) -> DataFrame:
    """For every case: how many documents, active warnings and audit rows its detail shows."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("case_key").agg(F.count("*").alias(name))

    joined = (
        cases.select("case_key", "effective_status", "progress_percent")
        .join(counted(documents.filter("is_present"), "documents"), "case_key", "left")
        .join(counted(warnings.filter("active"), "warnings"), "case_key", "left")
        .join(counted(history, "history"), "case_key", "left")
    )
    return joined.withColumns(
        {
            **{n: F.coalesce(n, F.lit(0)).cast("bigint") for n in ("documents", "warnings", "history")},
            "history_shown": F.least(F.coalesce("history", F.lit(0)), F.lit(HISTORY_ROWS)).cast("bigint"),
        }
    )


@dataclass(frozen=True)
class CaseDetail:
    case: DataFrame
    documents: DataFrame
    warnings: DataFrame
    history: DataFrame
    checklist: DataFrame


def case_detail(
    key: str,
    cases: DataFrame,
    documents: DataFrame,
    warnings: DataFrame,
    history: DataFrame,
    overrides: DataFrame,
    catalog: DataFrame,
    evidence: DataFrame | None = None,
) -> CaseDetail:
    """Everything about one case. The key filter reaches every scan; nothing is written."""
    from casebook.operators.checklist import checklist, type_facts

    here = F.col("case_key") == key
    facts = type_facts(
        documents.filter(here), overrides.filter(here), evidence.filter(here) if evidence is not None else None
    )
    return CaseDetail(
        case=one_case(cases, key),
        documents=documents.filter(here & F.col("is_present")).orderBy("relative_path"),
        warnings=warnings.filter(here & F.col("active")).orderBy(severity_rank(), "created_at", "fingerprint"),
        history=history.filter(here).orderBy(F.desc("created_at"), F.desc("seq")),
        checklist=checklist(one_case(cases, key), facts, catalog).orderBy("priority", "code"),
    )


def require_case(cases: DataFrame, key: str) -> DataFrame:
    """The case, or an error if there is none."""
    found = one_case(cases, key)
    if found.limit(1).count() == 0:
        raise LookupError(f"unknown case: {key}")
    return found


def warnings_of_cases(warnings: DataFrame, cases: DataFrame) -> DataFrame:
    """Active warnings of the present cases."""
    return warnings.filter("active").join(present(cases).select("case_key"), "case_key", "left_semi")
