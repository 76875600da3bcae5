"""The physical plans that matter for scale."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from casebook import schema
from casebook.operators import checklist, status
from casebook.plans import reports
from casebook.sources.catalog import pin
from casebook.sources.state import StateStore

AT = datetime(2026, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = StateStore(spark, str(tmp_path_factory.mktemp("state")))
    draft = made.draft()
    keys = spark.range(50).select(F.concat(F.lit("c"), "id").alias("case_key"), F.lit(True).alias("is_present"))
    draft.replace("cases", schema.conform(keys, "cases"))
    documents = keys.withColumns(
        {"relative_path": F.concat("case_key", F.lit("/x.pdf")), "taxonomy_code": F.lit("01"), "parse_status": F.lit("OK")}
    )
    draft.replace("documents", schema.conform(documents, "documents"))
    for table in ("warnings", "checklist_overrides"):
        draft.replace(table, schema.empty(spark, schema.TABLES[table]))
    draft.append("case_history", schema.empty(spark, schema.TABLES["case_history"]))
    draft.publish()
    return made


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [(f"{n:02d}", f"T{n}", f"{n:02d}.T{n}", 1, True, "CHUA_XAC_DINH") for n in range(1, 6)]
    return pin(spark.createDataFrame(rows, schema.TABLES["catalog"]))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_recompute_joins_by_key_and_hashes(store, catalog):
    tables = [store.read(t) for t in ("cases", "documents")]
    text = plan(
        status.case_figures(*tables, catalog, store.read("checklist_overrides"), store.read("warnings"))
    )
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SortAggregate" not in text and "Python" not in text
    assert "HashAggregate" in text


def test_facts_read_only_what_they_need(store):
    facts = checklist.type_facts(store.read("documents"), store.read("checklist_overrides"))
    documents = next(line for line in scans(facts) if "parse_status" in line)
    for unused in ("sha256", "filename", "taxonomy_name", "size_bytes"):
        assert unused not in documents.split("ReadSchema")[1]


def test_case_detail_filters_reach_every_scan(store, catalog):
    tables = [store.read(t) for t in ("cases", "documents", "warnings", "case_history", "checklist_overrides")]
    detail = reports.case_detail("c7", *tables, catalog)
    for part in (detail.case, detail.documents, detail.warnings, detail.history, detail.checklist):
        assert scans(part) and all("EqualTo(case_key,c7)" in line for line in scans(part))
    assert detail.documents.count() == 1 and detail.checklist.count() == 5


def test_top_rows_are_limited_before_the_shuffle(store):
    text = plan(reports.recent_history(store.read("case_history")))
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(reports.action_queue(store.read("cases")))


def test_pages_after_a_row_keep_one_page(store):
    number = F.substring("case_key", 2, 9).cast("int")
    cases = store.read("cases").withColumns(
        {
            "progress_percent": F.when(number % 7 > 0, (number % 3).cast("double")),
            "last_scanned_at": F.when(number % 5 > 0, F.timestamp_seconds(number % 4)),
        }
    )
    for sort, field in (("progress", "progress_percent"), ("updated", "last_scanned_at")):
        whole = [(r["case_key"], r[field]) for r in cases.orderBy(*reports.sort_columns(sort)).collect()]
        seen = whole[:1]
        while len(seen) < len(whole):
            key, value = seen[-1]
            page = reports.page_after(cases, sort, value, key, 20)
            assert "TakeOrderedAndProject(limit=20," in plan(page)
            found = [(r["case_key"], r[field]) for r in page.collect()]
            assert found
            seen += found
        assert seen == whole


def test_require_case(store):
    assert reports.require_case(store.read("cases"), "c1").count() == 1
    with pytest.raises(LookupError):
        reports.require_case(store.read("cases"), "nobody")


def test_dashboard_parts(spark, store):
    board = reports.dashboard(store.read("cases"), store.read("warnings"), store.read("scan_runs"))
    assert {r["status"]: r["n"] for r in board.counts.collect() if r["status"]} == dict.fromkeys(schema.CASE_STATUSES, 0)
    assert board.overall.first()["total"] == 50
    assert [r["unit"] for r in board.units.collect()] == ["Chưa xác định"]
    empty = reports.dashboard(store.read("cases").limit(0), store.read("warnings"), store.read("scan_runs"))
    assert (empty.overall.first()["total"], empty.overall.first()["progress"]) == (0, 0.0)
    assert board.warnings.first()["n"] == 0 and board.last_run.count() == 0 and board.actions.count() == 0
