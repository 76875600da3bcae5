from __future__ import annotations

import hashlib
import io
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from casebook import schema
from casebook.plans.scan import scan
from casebook.plans.updates import submit_imports
from casebook.sources import content, listing
from casebook.sources.catalog import load_catalog
from casebook.sources.manifest import evidence_or_empty, manifest_pages, manifest_sources, read_manifests
from casebook.sources.state import StateStore
from casebook.sources.work import Work
from casebook.streaming.actions import read_action_files, start
from tests.builders import BASES, junk, pdf, write_catalog

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def test_page_counter_across_blocks():
    count = content.simple_page_counter()
    page = b"<< /Type /Page >>"
    for filler in range(1 << 20, (1 << 20) - 40, -1):
        data = b"%PDF-1.4 /Type /Pages " + b" " * (1000 + filler) + page * 3
        assert count(io.BytesIO(data)) == 3, filler
    assert count(io.BytesIO(b"%PDF-1.5 /Type /ObjStm")) is None
    assert count(io.BytesIO(b"%PDF-1.5")) == 0
    with pytest.raises(ValueError):
        count(io.BytesIO(b"not a pdf"))


def test_probe_reads_digest_and_pages(spark, tmp_path):
    good = pdf(tmp_path / "a" / "good.pdf", pages=3)
    junk(tmp_path / "a" / "bad.pdf")
    pdf(tmp_path / "a" / "empty.pdf", pages=0)
    names = ["a/good.pdf", "a/bad.pdf", "a/empty.pdf", "a/vanished.pdf"]
    paths = spark.createDataFrame([(n, 10) for n in names], "relative_path string, size_bytes bigint")
    assert content.task_count(paths) == 4
    got = {r["relative_path"]: r for r in content.probe_files(paths, str(tmp_path), 2).collect()}
    assert got["a/good.pdf"]["sha256"] == hashlib.sha256(good.read_bytes()).hexdigest()
    assert [(got[n]["page_count"], got[n]["readable"]) for n in names] == [(3, True), (None, False), (0, False), (None, False)]
    assert got["a/vanished.pdf"]["sha256"] is None
    custom = content.probe_files(paths, str(tmp_path), 1, lambda stream: len(stream.read()))
    assert custom.filter("relative_path = 'a/bad.pdf'").first()["page_count"] == 9
    whole = spark.read.format("binaryFile").load(f"{good}").select(content.digest(F.col("content")).alias("d"))
    assert whole.first()["d"] == got["a/good.pdf"]["sha256"]


def test_uri_roots_use_arrow_file_systems(tmp_path):
    pdf(tmp_path / "a" / "x.pdf")
    read = listing.directory_reader(listing.IGNORED)
    assert [(e[0], e[1]) for e in read(f"file://{tmp_path}")] == [("a", True)]


def test_inventory_listing(spark):
    rows = [("s3://b/root/A/x.pdf", 1, 2), ("s3://b/root/A/s/y.PDF", 1, 2), ("s3://b/root/top.pdf", 1, 2),
            ("s3://b/root/A/../../z.pdf", 1, 2), ("s3://b/other/A/x.pdf", 1, 2), ("s3://b/root/A/n.txt", 1, 2)]
    inventory = spark.createDataFrame(rows, "path string, size_bytes bigint, mtime_ns bigint")
    files = listing.listing_from_inventory(inventory, "s3://b/root/")
    assert [r["relative_path"] for r in listing.in_listing_order(files).collect()] == ["A/s/y.PDF", "A/x.pdf"]
    folders = listing.folders_from_inventory(files, "s3://b/root/").collect()
    assert [tuple(r) for r in folders] == [("A", "s3://b/root/A", "A")]


def test_manifests_and_imports_end_to_end(spark, tmp_path):
    root = tmp_path / "root"
    pdf(root / "Case" / (BASES[5] + ".pdf"))
    store = StateStore(spark, str(tmp_path / "state"))
    scan(store, str(root), load_catalog(spark, write_catalog(tmp_path / "types.json")), at=START, tasks=2)
    token, broken = "a" * 32, "b" * 32
    for name, body in (
        (
            token,
            json.dumps(
                {
                    "case_id": "Case",
                    "sources": [{"name": "scan.pdf", "stored": "source-001.pdf", "sha256": "d1"}],
                    "pages": [
                        {"page_id": f"p{n}", "source_name": "scan.pdf", "source_path": "source-001.pdf", "source_page": n, "preview_name": f"p{n}.png"}
                        for n in (1, 2)
                    ],
                }
            ),
        ),
        (broken, "{not json"),
    ):
        (tmp_path / "staging" / name).mkdir(parents=True)
        (tmp_path / "staging" / name / "manifest.json").write_text(body)
    manifests = read_manifests(spark, str(tmp_path / "staging"))
    assert [r["page_id"] for r in manifest_pages(manifests).orderBy("position").collect()] == ["p1", "p2"]
    assert manifest_sources(manifests).first()["allowed"]
    requests = spark.createDataFrame(
        [(t, "Case", "05", "2026-01-01", "", START, [("p2", 90), ("p1", 0)]) for t in (token, broken)], schema.REQUESTS
    )
    plan = submit_imports(store, requests, manifests, at=START)
    assert [r["filename"] for r in plan.names.collect()] == [BASES[5] + ".2.pdf"]
    assert [r["rename_to"] for r in plan.renames.collect()] == [BASES[5] + ".1.pdf"]
    assert [r["reason"] for r in plan.rejected.collect()] == ["unreadable session"]
    stored = store.read("import_events").first()
    assert (stored["source_files"], stored["source_sha256"]) == (["scan.pdf", "scan.pdf"], {"scan.pdf": "d1"})
    assert (stored["document_date"], stored["note"]) == ("2026-01-01", None)


def test_versions_are_isolated(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    rows = lambda *keys: spark.createDataFrame([(k, "01", "CAN_BO_SUNG", None, START) for k in keys], schema.TABLES["checklist_overrides"])
    assert store.version() == 0 and store.read("cases").count() == 0
    first, rival = store.draft(), store.draft()
    first.replace("checklist_overrides", rows("a"))
    rival.replace("checklist_overrides", rows("z"))
    assert store.read("checklist_overrides").count() == 0, "a draft is invisible"
    assert first.publish() == 1
    with pytest.raises(RuntimeError, match="someone else"):
        rival.publish()
    second = store.draft()
    second.replace("checklist_overrides", second.read("checklist_overrides").union(rows("b")))
    second.publish()
    assert store.read("checklist_overrides").count() == 2
    assert store.read("checklist_overrides", version=1).count() == 1


def test_append_compacts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("casebook.sources.state.MAX_PARTS", 3)
    store = StateStore(spark, str(tmp_path))
    for n in range(5):
        draft = store.draft()
        draft.append("scan_runs", spark.range(n, n + 1).select(F.col("id").alias("run_id")))
        draft.publish()
    assert sorted(r["run_id"] for r in store.read("scan_runs").collect()) == list(range(5))
    assert len(store.content()["tables"]["scan_runs"]) == 2


def test_action_stream_applies_each_batch_once(spark, tmp_path):
    root = tmp_path / "root"
    pdf(root / "Case" / (BASES[1] + ".pdf"))
    store = StateStore(spark, str(tmp_path / "state"))
    scan(store, str(root), load_catalog(spark, write_catalog(tmp_path / "types.json")), at=START, tasks=2)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    action = {"case_key": "Case", "action": "override", "code": "02", "status": "CAN_BO_SUNG", "ts": "2026-01-01T01:00:00Z", "seq": 1}
    bad = ['{"case_key": "Case", "seq": "one"}', "no json", "[1]"]
    (inbox / "1.json").write_text("\n".join([json.dumps(action), *bad, "", json.dumps({**action, "case_key": "Nobody", "seq": 9})]))

    def run(checkpoint):
        stream = read_action_files(spark, str(inbox))
        start(store, stream, str(tmp_path / checkpoint)).awaitTermination()

    run("checkpoint")
    assert store.read("cases").first()["missing_type_count"] == 1
    unread = spark.read.parquet(f"{tmp_path}/checkpoint-rejected-unread/batch=0")
    assert sorted(r["unread"] for r in unread.collect()) == sorted(bad)
    assert [r["case_key"] for r in spark.read.parquet(f"{tmp_path}/checkpoint-rejected/batch=0").collect()] == ["Nobody"]
    version, history = store.version(), store.read("case_history").count()
    run("fresh checkpoint")
    assert (store.version(), store.read("case_history").count()) == (version, history), "batch 0 came twice"
    (inbox / "2.json").write_text(json.dumps({**action, "status": "KHONG_PHAT_SINH", "ts": "2026-01-01T02:00:00Z", "seq": 2}))
    run("checkpoint")
    assert store.read("cases").first()["missing_type_count"] == 0


def test_optional_evidence(spark):
    assert evidence_or_empty(spark, None).count() == 0


def test_work_needs_a_shared_folder_on_clusters(spark, tmp_path):
    work = Work(spark)
    kept = work.keep(spark.range(3), "three")
    assert kept.count() == 3
    work.drop()
