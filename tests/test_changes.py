"""One change set per scan, counts that move by differences, and where a scan's input comes from."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from casebook.operators import checklist, deltas, diff
from casebook.plans.scan import scan
from casebook.sources import listing
from casebook.sources.catalog import load_catalog, pin, same_codes
from casebook.sources.state import StateStore
from casebook.sources.work import Work
from tests.builders import BASES, entries, junk, pdf, write_catalog
from workload import spark_queries as queries
from workload.inputs import Inputs

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def counts(df):
    return sorted((tuple(r) for r in df.select(*deltas.KEYS, "n").collect()), key=str)


def test_counts_follow_every_kind_of_change(spark, tmp_path):
    root, store = tmp_path / "root", StateStore(spark, str(tmp_path / "state"))
    catalog = load_catalog(spark, write_catalog(tmp_path / "types.json"))
    for case in ("North", "South"):
        pdf(root / case / (BASES[1] + ".pdf"))
        pdf(root / case / (BASES[2] + ".pdf"))
    junk(root / "North" / (BASES[4] + ".pdf"))
    clock = iter(START + timedelta(hours=n) for n in range(20))

    def run(**options):
        result = scan(store, str(root), options.pop("catalog", catalog), at=next(clock), tasks=2, **options)
        assert result.status == "SUCCESS", result.error_messages
        assert counts(store.read("document_counts")) == counts(deltas.document_counts(store.read("documents")))
        return result

    first = run()
    assert (first.folders_seen, first.files_seen, first.docs_created, first.cases_created) == (2, 5, 5, 2)
    pdf(root / "North" / (BASES[1] + ".pdf"), pages=3)  # changed
    pdf(root / "North" / (BASES[4] + ".pdf"))  # becomes readable
    (root / "South" / (BASES[2] + ".pdf")).unlink()  # gone
    pdf(root / "East" / "999.unknown.pdf")  # new
    second = run()
    assert (second.docs_created, second.docs_updated, second.cases_created, second.cases_updated) == (1, 4, 1, 2)
    pdf(root / "South" / (BASES[5] + ".pdf"))
    pdf(root / "North" / (BASES[5] + ".pdf"))
    assert run(scope=spark.createDataFrame([("South",)], "case_key string")).docs_created == 1
    # a catalog with another code: the unchanged file of that code is judged anew
    other = [*entries()[:103], {"id": "999", "name_vi": "New", "filename_base": "999.unknown", "priority": 1}]
    fresh = load_catalog(spark, write_catalog(tmp_path / "other.json", other))
    assert not same_codes(catalog, fresh) and same_codes(catalog, catalog)
    run(catalog=fresh)
    assert store.read("documents").filter("taxonomy_code = '999' and parse_status = 'OK'").count() == 1

    failed = scan(store, str(root), catalog, at=next(clock), scope=spark.createDataFrame([("Nowhere",)], "case_key string"))
    assert failed.status == "ERROR" and "Nowhere" in failed.error_messages[0]


def test_a_scan_from_an_inventory_lists_nothing(spark, tmp_path, monkeypatch):
    root, store = tmp_path / "root", StateStore(spark, str(tmp_path / "state"))
    catalog = load_catalog(spark, write_catalog(tmp_path / "types.json"))
    files = [pdf(root / "North" / (BASES[1] + ".pdf")), pdf(root / "South" / "deep" / (BASES[2] + ".pdf"))]
    rows = [(str(f), os.stat(f).st_size, os.stat(f).st_mtime_ns) for f in files]
    found = listing.listing_from_inventory(spark.createDataFrame(rows, "path string, size_bytes long, mtime_ns long"), str(root))
    for name in ("list_folders", "list_pdfs", "folders_of_cases"):
        monkeypatch.setattr(listing, name, lambda *a, **b: pytest.fail("listed"))
    result = scan(store, str(root), catalog, at=START, files=found, tasks=2)
    assert (result.folders_seen, result.files_seen, result.docs_created) == (2, 2, 2)
    north = spark.createDataFrame([("North",)], "case_key string")
    again = scan(store, str(root), catalog, at=START + timedelta(hours=1), files=found, scope=north, tasks=2)
    assert (again.folders_seen, again.files_seen, again.docs_updated) == (1, 1, 1)


def test_scoped_folders_are_looked_up_alone(spark, tmp_path):
    (tmp_path / "A").mkdir()
    (tmp_path / "B").write_text("a file")
    (tmp_path / "L").symlink_to(tmp_path / "A")
    keys = spark.createDataFrame([(k,) for k in ("A", "A", "B", "L", "missing", "../A", "")], "case_key string")
    found = listing.folders_of_cases(spark, str(tmp_path), keys, 2).collect()
    assert [tuple(r) for r in found] == [("A", f"{tmp_path}/A", "A")]
    with pytest.raises(Exception, match="FileNotFound"):
        listing.folders_of_cases(spark, str(tmp_path / "none"), keys, 2).collect()


@pytest.fixture
def tables(spark):
    columns = "case_key string, relative_path string, filename string, taxonomy_code string, parse_status string, size_bytes long, mtime_ns long, is_present boolean, last_hashed_at timestamp"
    from casebook import schema

    stored = [(f"c{n % 3}", f"c{n % 3}/01.T.{n}.pdf", f"01.T.{n}.pdf", "01", "OK", 5, n, n % 4 != 0, START) for n in range(30)]
    prior = schema.conform(spark.createDataFrame(stored, columns), "documents")
    now = [(f"c{n % 3}/01.T.{n}.pdf", f"c{n % 3}", 5 + (n % 5 == 0), n) for n in range(4, 36)]
    files = spark.createDataFrame(now, schema.LISTING)
    probe = spark.createDataFrame([(p, "d", 1, True) for p, *_ in now], schema.PROBE)
    catalog = pin(spark.createDataFrame([("01", "T", "01.T", 1, True, "CHUA_XAC_DINH")], schema.TABLES["catalog"]))
    return prior, files, probe, catalog, spark.createDataFrame([("c0",), ("c1",)], "case_key string")


def test_one_join_of_prior_and_listing(spark, tables):
    prior, files, probe, catalog, touched = tables
    work = Work(spark)
    changes = diff.change_set(prior, files)
    text = plan(changes)
    final = text[text.index("Final Plan") : text.index("Initial Plan")] if "Initial Plan" in text else text
    assert final.count("FullOuter") == 1
    kept = work.keep(changes, "changes")
    at = F.lit(START)
    after = diff.upsert_documents(kept, probe, catalog, touched, at)
    assert "FullOuter" not in plan(after)  # the listing is not joined with the stored documents again
    assert after.count() == 36
    kinds = {r["change_kind"]: r["count"] for r in kept.groupBy("change_kind").count().collect()}
    assert kinds == {"NEW": 6, "GONE": 4, "UNCHANGED": 15, "CHANGED": 11}
    differences = deltas.count_deltas(diff.moved_documents(kept, probe, catalog, touched, at))
    assert counts(deltas.apply_deltas(deltas.document_counts(prior), differences)) == counts(deltas.document_counts(after))
    # differences read rows that changed only, and no stored document
    scanned = plan(differences)
    assert "UNCHANGED" not in scanned and "In(change_kind, [CHANGED,NEW])" in scanned.replace("[NEW,CHANGED]", "[CHANGED,NEW]")
    work.drop()


def test_counters_ride_on_the_writing_jobs(spark, tables):
    prior, files, *_ = tables
    counted, work = diff.Counted(), Work(spark)
    work.keep(counted.watch(diff.change_set(prior, files), diff.file_counters()), "changes")
    work.keep(counted.watch(diff.change_set(prior.limit(0), files.limit(0)), {"none": F.count_if(F.col("change_kind") == "NEW")}), "empty")
    assert counted.values() == {"files_seen": 32, "docs_created": 6, "docs_updated": 26, "none": 0}
    work.drop()


SMALLEST = "/root/testdata/sf0.001"


def test_stored_counts_follow_from_the_change_set(spark):
    i = Inputs(spark, SMALLEST)
    prior = queries.documents_previous(i)
    assert counts(deltas.stored_counts(diff.change_set(prior, i.view("listing")))) == counts(deltas.document_counts(prior)) != []


def test_evidence_may_come_as_counts(spark):
    i = Inputs(spark, SMALLEST)
    held = deltas.document_counts(queries.documents_previous(i))
    facts = [checklist.facts_from_counts(held, queries.overrides(i), e).orderBy("case_key", "code").collect() for e in (i.view("evidence"), checklist.external_evidence(i.view("evidence")))]
    assert facts[0] == facts[1] != []


def test_rules_and_recompute_find_only_what_they_read(spark):
    kept = queries.scanned_documents(Inputs(spark, SMALLEST))
    assert kept.filter("not is_present").isEmpty() and not kept.isEmpty()
    assert "size_bytes" not in kept.columns


def test_changes_write_each_shared_step_once(spark, monkeypatch):
    names = []
    keep = Work.keep
    monkeypatch.setattr(Work, "keep", lambda self, df, name, by=None: names.append(name) or keep(self, df, name, by))
    changed = queries.QUERIES["recompute_from_changes"](spark, SMALLEST)
    assert {"evidence", "cases", "concerned", "stored-warnings"} <= set(names) and len(names) == len(set(names))
    assert changed.exceptAll(queries.QUERIES["case_status"](spark, SMALLEST).select(*changed.columns)).isEmpty()
