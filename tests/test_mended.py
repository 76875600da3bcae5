"""Faults that were mended stay mended."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from casebook import schema
from casebook.functions import names, text
from casebook.operators import imports
from casebook.sources import listing
from casebook.sources.catalog import pin
from casebook.sources.work import Work


def test_ignore_patterns_match_whole_names(spark):
    paths = ["C/xThumbs.db", "C/01.a~$b.pdf", "C/Thumbs.db", "C/~$x.pdf", "A/.git/x.pdf", "A/a.pdf"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r[0]: r[1] for r in rows.select("p", names.is_ignored(F.col("p"), listing.IGNORED)).collect()}
    assert got == dict(zip(paths, [False, False, True, True, True, False], strict=True))


def test_inventory_applies_ignore_patterns_and_keeps_empty_cases(spark):
    rows = [(f"/r/{p}", 1, 2) for p in ("A/a.pdf", "A/.git/x.pdf", "A/~$x.pdf", "B/note.txt")]
    found = listing.listing_from_inventory(spark.createDataFrame(rows, "path string, size_bytes long, mtime_ns long"), "/r")
    assert [r["relative_path"] for r in found.collect()] == ["A/a.pdf"]
    keys = spark.createDataFrame([("B",)], "case_key string")
    assert {r["case_key"] for r in listing.folders_from_inventory(found, "/r", keys).collect()} == {"A", "B"}


def test_audit_times_are_utc_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        row = spark.range(1).select(text.iso_micros(F.timestamp_micros(F.lit(0).cast("long")))).first()
        assert row[0] == "1970-01-01T00:00:00.000000+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_imports_remember_earlier_batches(spark):
    rows = [(f"{n:02d}", f"T{n}", f"{n:02d}.T{n}", 1, True, "CHUA_XAC_DINH") for n in range(1, 6)]
    catalog = pin(spark.createDataFrame(rows, schema.TABLES["catalog"]))
    stored = [("c1/05.T5.pdf", "c1", "05.T5.pdf", True), ("c1/04.T4.2.pdf", "c1", "04.T4.2.pdf", False)]
    documents = spark.createDataFrame(stored, "relative_path string, case_key string, filename string, is_present boolean")
    old, new = "a" * 32, "b" * 32
    given = [("c1", old, "05.T5.2.pdf"), ("c1", old, "04.T4.2.pdf")]  # the second was seen by a scan and is gone again
    events = spark.createDataFrame(given, "case_key string, token string, filename string")
    taken = imports.existing_numbers(imports.with_planned(documents, events), catalog)
    assert {(r["code"], r["max_sequence"], r["plain_exists"]) for r in taken.collect()} == {("05", 2, True)}

    asked = [(t, "c1", "05", [("p1", 0)], datetime(2026, 1, 1)) for t in (old, new)]
    requests = spark.createDataFrame(
        asked, "token string, case_key string, type_id string, pages array<struct<id:string,rotation:int>>, requested_at timestamp"
    )
    manifests = spark.createDataFrame(
        [(t, "c1", [("a.pdf", "a.pdf", "0")], [("p1", "a.pdf")]) for t in (old, new)],
        "token string, case_key string, sources array<struct<name:string,stored:string,sha256:string>>, pages array<struct<page_id:string,source_name:string>>",
    )
    cases = spark.createDataFrame([("c1", True)], "case_key string, is_present boolean")
    judged = imports.judge_requests(requests, manifests, cases, catalog, events)
    assert {r["token"]: r["reason"] for r in judged.collect()} == {old: "session already used", new: None}
    named = imports.assign_sequences(judged.filter("reason is null"), taken, catalog, Work(spark).keep)
    assert [(r["filename"], r["rename_from"]) for r in named.collect()] == [("05.T5.3.pdf", None)]
