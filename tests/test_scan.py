from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from casebook.plans import reports
from casebook.plans.scan import scan
from casebook.plans.updates import submit_actions
from casebook.sources.catalog import check_entries, load_catalog, read_entries
from casebook.sources.state import StateStore
from tests.builders import BASES, archive, entries, junk, numbered_cases, pdf, write_catalog

ONE = BASES[1] + ".pdf"
START = datetime(2026, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def env(spark, tmp_path):
    root = tmp_path / "root"
    root.mkdir()
    catalog = load_catalog(spark, write_catalog(tmp_path / "types.json"))
    store = StateStore(spark, str(tmp_path / "state"))
    clock = iter(START + timedelta(hours=n) for n in range(100))

    def run(**options):
        return scan(store, str(root), catalog, at=next(clock), tasks=2, **options)

    return root, store, run


def rows(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def act(store, spark, at, **fields):
    names = ("case_key", "action", "code", "status", "note", "reviewed_by")
    row = tuple(fields.get(n) for n in names) + (at, 1)
    kinds = ", ".join(f"{n} string" for n in names)
    return submit_actions(store, spark.createDataFrame([row], f"{kinds}, ts timestamp, seq bigint"), at=at)


def test_catalog_rules(spark, tmp_path):
    write = lambda extra: write_catalog(tmp_path / "c.json", extra)
    with pytest.raises(ValueError, match="exactly 104"):
        load_catalog(spark, write(entries()[:103]))
    with pytest.raises(ValueError, match="lack id"):
        load_catalog(spark, write([*entries()[:103], {"id": "104", "name_vi": ""}]))
    (tmp_path / "c.json").write_text('{"other": 1}')
    with pytest.raises(ValueError, match="no document_types"):
        load_catalog(spark, str(tmp_path / "c.json"))
    odd = [*entries(), "text", 5, {"id": "01", "name_vi": "New", "filename_base": "01.New", "priority": 9}]
    got = rows(load_catalog(spark, write(odd)), "code")
    assert len(got) == 104 and got["01"]["name"] == "New" and got["01"]["priority"] == 3
    plain = [{k: v for k, v in e.items() if k != "priority"} for e in entries()]
    path = write(plain)
    check_entries(read_entries(spark, path))
    assert rows(load_catalog(spark, path), "code")["01"]["priority"] == 3


def test_an_archive_of_situations(spark, env):
    root, store, run = env
    folders = archive(root)
    result = run()
    assert (result.status, result.folders_seen, result.files_seen) == ("SUCCESS", 7, 13), result
    assert (result.cases_created, result.docs_created) == (7, 13)
    cases = rows(store.read("cases"), "case_key")
    untouched = {"loose", "bare"}  # nothing in them counts as a document
    assert {k for k, f in folders.items() if cases[f.name]["auto_status"] == "CHUA_XU_LY"} == untouched
    assert {cases[f.name]["auto_status"] for k, f in folders.items() if k not in untouched} == {"CHO_KIEM_TRA"}
    assert {k: cases[f.name]["document_count"] for k, f in folders.items()} == {
        "tidy": 2, "series": 3, "copies": 3, "foreign": 1, "spoilt": 1, "loose": 0, "bare": 0,
    }
    assert cases[folders["tidy"].name]["person_name_display"] == "Mai Quynh Chi"
    kinds: dict = {}
    for r in store.read("warnings").filter("active").collect():
        kinds.setdefault(r["case_key"], []).append(r["warning_type"])
    assert {k: sorted(v) for k, v in kinds.items()} == {
        folders["loose"].name: ["SAI_TEN_FILE", "SAI_TEN_THU_MUC"],
        folders["foreign"].name: ["FILE_NGOAI_TAXONOMY"],
        folders["copies"].name: ["TRUNG_TAI_LIEU"] * 3,
        folders["spoilt"].name: ["FILE_KHONG_DOC_DUOC"],
    }
    page = reports.case_page(store.read("cases"), reports.CaseFilter(q="quynh"))
    assert (page.total, [r["case_key"] for r in page.items.collect()]) == (1, [folders["tidy"].name])
    warned = reports.case_page(store.read("cases"), reports.CaseFilter(warning=True), store.read("warnings"))
    assert warned.total == 4
    again = run()
    assert (again.cases_created, again.cases_updated, again.docs_created, again.docs_updated) == (0, 7, 0, 13)
    assert again.warnings_created == 0
    broken = store.read("documents").filter(F.col("relative_path").startswith(folders["spoilt"].name + "/01")).first()
    assert broken["parse_status"] == "FILE_KHONG_DOC_DUOC", "an unreadable file stays unreadable"
    assert store.read("scan_runs").count() == 2
    assert reports.last_run(store.read("scan_runs")).first()["run_id"] == again.run_id
    assert '"files_seen":13' in reports.last_run(store.read("scan_runs")).first()["summary_json"]


def test_rescan_keeps_drops_and_restores(env):
    root, store, run = env
    file = pdf(root / "Case" / ONE)
    run()
    first = store.read("documents").first()
    assert first["page_count"] == 1 and len(first["sha256"]) == 64
    run()
    assert store.read("documents").first()["last_hashed_at"] == first["last_hashed_at"]
    file.unlink()
    run()
    gone = store.read("documents").first()
    assert not gone["is_present"] and gone["sha256"] == first["sha256"]
    junk(file)
    run()
    back = store.read("documents").first()
    assert back["is_present"] and back["parse_status"] == "FILE_KHONG_DOC_DUOC"
    assert back["first_seen_at"] == first["first_seen_at"]


def test_lost_and_scoped_cases(spark, env):
    root, store, run = env
    for name in ("A", "B"):
        pdf(root / name / ONE)
    run()
    pdf(root / "A" / "sub" / "deep" / (BASES[4] + ".PDF"))
    pdf(root / "B" / (BASES[4] + ".pdf"))
    only_a = spark.createDataFrame([("A",)], "case_key string")
    scoped = run(scope=only_a)
    assert (scoped.folders_seen, scoped.files_seen, scoped.docs_created) == (1, 2, 1)
    assert store.read("documents").count() == 3
    cases = rows(store.read("cases"), "case_key")
    assert (cases["A"]["document_count"], cases["B"]["document_count"]) == (2, 1)
    for file in sorted(root.glob("B/*")):
        file.unlink()
    (root / "B").rmdir()
    assert run(scope=spark.createDataFrame([("B",)], "case_key string")).folders_seen == 0
    assert rows(store.read("cases"), "case_key")["B"]["is_present"]
    run()
    assert not rows(store.read("cases"), "case_key")["B"]["is_present"]
    assert not rows(store.read("documents"), "case_key", "filename")[("B", ONE)]["is_present"]


def test_ignored_hidden_and_linked_names(env):
    root, store, run = env
    case = root / "Case"
    pdf(case / ONE)
    pdf(case / "_x.pdf")
    for skipped in (".y.pdf", "~$z.pdf", "Thumbs.db", "note.txt"):
        pdf(case / skipped)
    pdf(case / ".hidden" / ONE)
    pdf(case / "Ảnh #1 + %41" / "B.PDF")
    outside = pdf(root.parent / "elsewhere" / ONE)
    (case / "link.pdf").symlink_to(outside)
    (case / "linked").symlink_to(outside.parent)
    (root / ".git").mkdir()
    (root / "Empty").mkdir()
    result = run()
    assert (result.folders_seen, result.files_seen) == (2, 3)
    assert {r["relative_path"] for r in store.read("documents").collect()} == {
        f"Case/{ONE}", "Case/_x.pdf", "Case/Ảnh #1 + %41/B.PDF",
    }


def test_failed_scan_publishes_only_its_run(env):
    root, store, run = env
    pdf(root / "Case" / ONE)
    run()
    before = store.read("documents").collect()
    root.rename(root.parent / "moved")
    result = run()
    assert result.status == "ERROR" and result.errors == 1 and result.error_messages
    assert store.read("documents").collect() == before
    log = store.read("scan_runs").orderBy("run_id").collect()
    assert [r["status"] for r in log] == ["SUCCESS", "ERROR"]


def test_progress_overrides_completion_and_reopening(spark, env):
    root, store, run = env
    file = pdf(root / "Case" / ONE)
    run()
    at = START + timedelta(minutes=5)
    step = lambda n: at + timedelta(minutes=n)
    case = lambda: store.read("cases").first()
    assert case()["progress_percent"] == round(300 / (2 * 3 + 102), 2)
    act(store, spark, step(1), case_key="Case", action="override", code="02", status="CAN_BO_SUNG")
    assert (case()["auto_status"], case()["missing_type_count"], case()["missing_priority1_count"]) == ("CAN_BO_SUNG", 1, 1)
    act(store, spark, step(2), case_key="Case", action="override", code="01", status="KHONG_PHAT_SINH")
    assert case()["type_count"] == 1, "a file beats an override"
    act(store, spark, step(3), case_key="Case", action="complete", reviewed_by="operator")
    assert case()["effective_status"] == "HOAN_THANH"
    file.write_bytes(file.read_bytes() + b"x")
    run()
    changed = case()
    assert (changed["effective_status"], changed["auto_status"]) == ("HOAN_THANH", "CAN_BO_SUNG")
    flagged = store.read("warnings").filter("warning_type = 'CHANGED_AFTER_COMPLETION' and active")
    assert flagged.count() == 1 and changed["warning_count"] == 2, "with the folder name warning"
    act(store, spark, START + timedelta(hours=1, minutes=30), case_key="Case", action="reopen")
    reopened = case()
    assert (reopened["manual_status"], reopened["effective_status"]) == (None, "CAN_BO_SUNG")
    history = store.read("case_history").orderBy("created_at", "seq").collect()
    assert [(h["event_type"], h["from_status"], h["to_status"]) for h in history] == [
        ("AUTO_STATUS_CHANGED", "CHUA_XU_LY", "CHO_KIEM_TRA"),
        ("CHECKLIST_OVERRIDE", None, None),
        ("AUTO_STATUS_CHANGED", "CHO_KIEM_TRA", "CAN_BO_SUNG"),
        ("CHECKLIST_OVERRIDE", None, None),
        ("MARK_COMPLETED", "CAN_BO_SUNG", "HOAN_THANH"),
        ("REOPENED", "HOAN_THANH", "CHUA_XU_LY"),
        ("AUTO_STATUS_CHANGED", "CHUA_XU_LY", "CAN_BO_SUNG"),
    ]
    assert history[1]["detail"] == "02: None -> CAN_BO_SUNG"
    assert history[5]["detail"] == (
        "Hồ sơ từng được đánh dấu hoàn thành lúc 2026-01-01T00:08:00.000000+00:00 bởi operator."
    )


def test_rejected_actions_change_nothing(spark, env):
    root, store, run = env
    pdf(root / "Case" / ONE)
    run()
    before = store.read("cases").collect()
    reasons = [
        act(store, spark, START, **fields).first()["reason"]
        for fields in (
            {"case_key": "None", "action": "complete"},
            {"case_key": "Case", "action": "manual_status", "status": "HOAN_THANH"},
            {"case_key": "Case", "action": "override", "code": "105", "status": "CAN_BO_SUNG"},
        )
    ]
    assert reasons == ["unknown case", "invalid case status", "invalid type code"]
    assert store.read("cases").collect() == before


def test_pages_of_many_cases(env):
    root, store, run = env
    numbered_cases(root, 120)
    run()
    cases = store.read("cases")
    seen = []
    for page in (1, 2, 3):
        got = reports.case_page(cases, reports.CaseFilter(), sort="name", page=page, page_size=50)
        seen += [r["case_key"] for r in got.items.collect()]
    assert got.total_pages == 3 and len(seen) == 120 == len(set(seen))
    last = reports.case_page(cases, reports.CaseFilter(), page=999, page_size=500)
    assert (last.page, last.page_size, last.total_pages) == (1, 200, 1)
    assert reports.case_page(cases, reports.CaseFilter(q="nobody")).total_pages == 1


def test_export_makes_a_new_copy_each_time(spark, env, tmp_path):
    root, store, run = env
    pdf(root / "Case" / ONE)
    run()
    first = store.export(str(tmp_path / "backup"), datetime(2026, 1, 1, 0, 0, 0, 1))
    second = store.export(str(tmp_path / "backup"), datetime(2026, 1, 1, 0, 0, 0, 2))
    assert first != second and Path(first).name == "20260101-000000-000001"
    assert spark.read.parquet(f"{first}/documents").count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.export(str(tmp_path / "backup"), datetime(2026, 1, 1, 0, 0, 0, 1))
