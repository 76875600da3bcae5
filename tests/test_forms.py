"""Timestamp forms, far pages and uploads against plain Python."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from casebook.functions.text import format_datetime
from casebook.operators import imports
from casebook.plans import reports
from casebook.sources.work import Work


def shown(written: str) -> str:
    try:
        return datetime.fromisoformat(written.strip().replace("Z", "+00:00")).strftime("%d/%m/%Y %H:%M")
    except ValueError:
        return written.strip()


def stamps() -> list[str]:
    rng = random.Random(5)
    dates = ["2024-02-29", "2023-02-29", "20240229", "2024-13-01", "2020-W53-7", "2024-W53-1", "2020W537", "2024W05", "2024-W05", "2024W051", "2024-W05-8", "2024-W00-1", "9999-W52-7", "1000-01-01", "0000-01-01", "2024-1-1"]
    clocks = ["", "T", "T10", " 10:11", "x10:11:12", "T10:11:12.5", "T10:11:12,123456789", "T1011", "T101112", "T101112.25", "T24:00", "T23:60", "T23:59:60", "T10:1112", "T1", "é08:00", "-12:30", "T10:11:12."]
    offsets = ["", "Z", "+07:00", "-0530", "+05", "+23:59:59", "+24:00", "+99:99", "+01:99", "+1", "+010", "-", "+01:00:00.5"]
    out = [d + c + o for d in dates for c in clocks for o in offsets]
    out += [f"2024W{n}" for n in ("05112", "0511", "051123", "0511234", "05a")] + ["2024-W05-1123", "2024-W05-123", "bad", "2024", " 2024-01-01\n", "2024-01-01T10:00\n+01:00"]
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return out + [f"20{digits(rng.randint(4, 14))}" for _ in range(200)]


def trailing(written: str) -> bool:
    """The interpreter overlooks one odd character between a time and its offset; that is no ISO form."""
    head = max(written.rfind("+"), written.rfind("-"))
    return head > 10 and not written[head - 1].isdigit()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh"])
def test_every_iso_form(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(w,) for w in dict.fromkeys(stamps()) if not trailing(w.replace("Z", "+00:00"))]
        got = spark.createDataFrame(rows, "w string").select("w", format_datetime(F.col("w")).alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(got) > 2000
    assert {r["w"]: r["s"] for r in got} == {w: shown(w) for (w,) in rows}


def test_any_page_by_number(spark):
    rng = random.Random(2)
    values = [rng.choice([None, *(float(n) for n in range(40))]) for _ in range(3000)]
    rows = [(f"k{n:05d}", v, True) for n, v in enumerate(values)]
    df = spark.createDataFrame(rows, "case_key string, progress_percent double, is_present boolean").repartition(5)
    want = [k for k, v, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))]
    work = Work(spark)
    for page in (1, 7, 88, 100, 101):
        got = [r["case_key"] for r in reports.page_at(df, "progress", page, 30, work).collect()]
        assert got == want[(page - 1) * 30 : page * 30]
    shown = reports.case_page(df, reports.CaseFilter(), sort="progress", page=999, page_size=30, work=work)
    assert (shown.page, shown.total_pages) == (100, 100)
    assert [r["case_key"] for r in shown.items.collect()] == want[-30:]
    assert reports.page_at(df.limit(0), "progress", 1, 30, work).collect() == []
    work.drop()


def test_uploads_become_manifests(spark):
    files = [
        ("a", 1, "dir/one.PDF", 2), ("a", 2, "photo.jpeg", None), ("a", 3, "two.pdf", 1),
        ("b", 1, "fine.png", None), ("b", 2, "bad.pdf", None), ("b", 3, "worse.exe", None),
        ("c", 1, "none.pdf", 0), ("d", 1, "", None), ("e", 1, ".pdf", 3),
    ]
    uploads = spark.createDataFrame([(t, f"case {t}", p, n, f"sha {n}", c) for t, p, n, c in files], "token string, case_key string, position int, name string, sha256 string, page_count int")
    sessions = spark.createDataFrame([(t, f"case {t}") for t in "abcdef"], "token string, case_key string")
    named, work = imports.named_uploads(uploads), Work(spark)
    judged = work.keep(imports.judge_uploads(sessions, named), "judged")
    assert {r["token"]: (r["reason"], r["file"]) for r in judged.collect()} == {
        "a": (None, None), "b": ("unreadable PDF", "bad.pdf"), "c": ("PDF without pages", "none.pdf"),
        "d": ("file type not allowed", ""), "e": ("file type not allowed", ".pdf"), "f": ("nothing to upload", None),
    }
    pages = imports.upload_pages(named, judged, work.keep)
    got = [tuple(r) for r in pages.orderBy("number").select("page_id", "source_name", "source_path", "source_page", "preview_name").collect()]
    assert got == [
        ("p1", "one.PDF", "source-001.pdf", 1, "p1.png"), ("p2", "one.PDF", "source-001.pdf", 2, "p2.png"),
        ("p3", "photo.jpeg", "source-002.jpeg", None, "p3.png"), ("p4", "two.pdf", "source-003.pdf", 1, "p4.png"),
    ]
    (manifest,) = imports.manifests_of_uploads(named, pages).collect()
    assert [s["stored"] for s in manifest["sources"]] == ["source-001.pdf", "source-002.jpeg", "source-003.pdf"]
    assert [p["page_id"] for p in manifest["pages"]] == ["p1", "p2", "p3", "p4"]
    work.drop()


def test_last_entry_of_a_name_wins(spark):
    row = spark.range(1).select(F.expr("array(struct('a' as k, 1 as v), struct('b' as k, 2 as v), struct('a' as k, 3 as v), struct(null as k, 4 as v))").alias("e"))
    assert row.select(imports._by_name(F.col("e"), "k", "v").alias("m")).first()["m"] == {"a": 3, "b": 2}
