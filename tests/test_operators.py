"""Operators against brute force on small random inputs."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from casebook import schema
from casebook.operators import actions, checklist, imports, spread, status, warnings
from casebook.plans import updates
from casebook.sources.catalog import pin
from casebook.sources.work import Work
from workload.inputs import Inputs

START = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [
        (f"{n:02d}", f"Type {n}", f"{n:02d}.Type_{n}", n % 3 + 1, n != 9, "KHONG_PHAT_SINH" if n == 8 else "CHUA_XAC_DINH")
        for n in range(1, 10)
    ]
    return pin(spark.createDataFrame(rows, schema.TABLES["catalog"]))


def table(spark, name, rows):
    fields = schema.TABLES[name].fieldNames()
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], schema.TABLES[name])


def test_prefix_fold_equals_a_loop(spark):
    rng = random.Random(1)
    rows = []
    for n in range(400):
        key = "hot" if n % 3 else f"k{rng.randrange(4)}"
        rows.append((key, rng.randrange(50), n, rng.randrange(5), rng.choice([None, "a", "b"])))
    df = spark.createDataFrame(rows, "k string, t int, id int, x int, v string")
    out = spread.prefix_fold(
        df, ["k"], ["t", "id"], {"before": F.col("x")}, {"latest": F.col("v")}, Work(spark).keep
    )
    got = {r["id"]: (r["before"], r["latest"]) for r in out.collect()}
    want, total, last = {}, {}, {}
    for key, _, n, x, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want[n] = (total.get(key, 0), last.get(key))
        total[key] = total.get(key, 0) + x
        last[key] = v if v is not None else last.get(key)
    assert got == want


def test_group_count(spark):
    facts = spark.createDataFrame([("hot" if n % 3 else f"k{n % 7}", n) for n in range(300)], "k string, id int")
    counted = {r["id"]: r["n"] for r in spread.count_in_group(facts, ["k"], "n").collect()}
    sizes = {r["k"]: r["count"] for r in facts.groupBy("k").count().collect()}
    assert counted == {r["id"]: sizes[r["k"]] for r in facts.collect()}


def test_hot_groups_are_split_at_run_time(spark):
    """A group with most of the rows is joined to its count in several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 900))
        rows = spark.range(0, 60_000, 1, 8).select(key.alias("k"), "id")
        counted = spread.count_in_group(rows, ["k"], "n")
        got = {(r["k"] == "hot", r["n"]) for r in counted.collect()}
        assert (True, 40_000) in got and len({n for hot, n in got if hot}) == 1
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_copies_are_counted_within_their_case(spark):
    rows = [("hot", "h", n) for n in range(120)] + [(f"k{n % 40}", f"d{n % 3}", 1000 + n) for n in range(150)]
    rows += [("hot", None, 5000 + n) for n in range(30)]
    df = spark.createDataFrame(rows, "case_key string, sha256 string, id int")
    got = {r["id"]: r["copies"] for r in warnings.with_duplicate_count(df, ["case_key"], "sha256", "id").collect()}
    sizes: dict = {}
    for case, digest, n in rows:
        sizes[(case, digest)] = sizes.get((case, digest), 0) + 1
    assert got == {n: 1 if digest is None else sizes[(case, digest)] for case, digest, n in rows}


def test_running_fold_cuts_a_single_hot_key(spark):
    """One key holding all rows still falls into several chunks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.lit(1).alias("x"))
    kept = []

    def keep(rows, name):
        kept.append(Work(spark).keep(rows, name))
        return kept[-1]

    try:
        out = spread.prefix_fold(df, ["k"], ["t"], {"before": F.col("x")}, {}, keep)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.filter("before != t").count() == 0 and out.count() == 4000
    sizes = [r["count"] for r in kept[0].groupBy("_chunk").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def random_state(spark, seed):
    rng = random.Random(seed)
    cases = [
        {
            "case_key": f"c{n}",
            "manual_status": rng.choice([None, None, "DANG_SO_HOA", "HOAN_THANH"]),
            "effective_status": rng.choice(schema.CASE_STATUSES),
            "auto_status": "CHUA_XU_LY",
            "completed_at": rng.choice([None, START - timedelta(days=rng.randrange(3))]),
            "reviewed_by": rng.choice([None, "", "r"]),
            "is_present": True,
        }
        for n in range(8)
    ]
    documents = [
        {
            "case_key": f"c{rng.randrange(7)}",
            "relative_path": f"p{n}",
            "taxonomy_code": rng.choice([None, "01", "02", "05", "09", "77"]),
            "parse_status": rng.choice(["OK", "OK", "MALFORMED_NAME"]),
            "is_present": rng.random() < 0.9,
            "last_hashed_at": START - timedelta(days=rng.randrange(3)),
        }
        for n in range(20)
    ]
    overrides = [
        {"case_key": f"c{n}", "taxonomy_code": code, "status": rng.choice(schema.CHECKLIST_STATUSES)}
        for n in range(8)
        for code in rng.sample(["01", "02", "03", "08", "09"], 2)
    ]
    evidence = [(f"c{rng.randrange(8)}", rng.choice([None, "03", "08"])) for _ in range(6)]
    return cases, documents, overrides, evidence


def expected_checklist(case, documents, overrides, evidence, types):
    out = {}
    for t in types:
        if not t["active"]:
            continue
        files = sum(
            1
            for d in documents
            if d["case_key"] == case and d["is_present"] and d["parse_status"] == "OK" and d["taxonomy_code"] == t["code"]
        )
        n = max(files, sum(1 for c, e in evidence if c == case and e == t["code"]))
        o = overrides.get((case, t["code"]))
        out[t["code"]] = ("CO_TAI_LIEU" if n else o or t["default_applicability"], n, o is not None, t["priority"])
    return out


def figures_of(items):
    weight = {1: 3, 2: 2, 3: 1}
    total = sum(weight[p] for *_, p in items.values())
    done = sum(weight[p] for s, _, _, p in items.values() if s in schema.CHECKLIST_DONE)
    missing = [p for s, _, _, p in items.values() if s == "CAN_BO_SUNG"]
    return round(100.0 * done / total, 2), sum(n for _, n, *_ in items.values()), len(missing), missing.count(1)


@pytest.mark.parametrize("seed", [1, 2])
def test_checklist_and_rollup_agree_with_a_loop(spark, catalog, seed):
    cases, documents, overrides, evidence = random_state(spark, seed)
    types = [r.asDict() for r in catalog.collect()]
    facts = checklist.type_facts(
        table(spark, "documents", documents),
        table(spark, "checklist_overrides", overrides),
        spark.createDataFrame(evidence, schema.EVIDENCE),
    )
    keys = table(spark, "cases", cases)
    listed: dict[str, dict] = {}
    for r in checklist.checklist(keys, facts, catalog).collect():
        listed.setdefault(r["case_key"], {})[r["code"]] = (r["status"], r["document_count"], r["has_override"], r["priority"])
    stored = {(o["case_key"], o["taxonomy_code"]): o["status"] for o in overrides}
    want = {c["case_key"]: expected_checklist(c["case_key"], documents, stored, evidence, types) for c in cases}
    assert listed == want
    rolled = checklist.rollup(keys.select("case_key"), facts, catalog).collect()
    assert {
        r["case_key"]: (r["progress_percent"], r["document_count"], r["missing_type_count"], r["missing_priority1_count"])
        for r in rolled
    } == {k: figures_of(items) for k, items in want.items()}


@pytest.mark.parametrize("query", ["cần BỔ", "type 8", "3 KHÔNG", "lIệu 1", "liệu 1 ưt2", "ƯT1", "0", " 05 ", "", "nothing"])
def test_checklist_search_equals_reading_all_rows(spark, catalog, query):
    cases, documents, overrides, evidence = random_state(spark, 3)
    facts = checklist.type_facts(
        table(spark, "documents", documents),
        table(spark, "checklist_overrides", overrides),
        spark.createDataFrame(evidence, schema.EVIDENCE),
    )
    keys = table(spark, "cases", cases)
    want = checklist.find_in_checklist(checklist.checklist(keys, facts, catalog), query)
    got = checklist.search_checklist(keys, facts, catalog, query)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_checklist_search_makes_no_row_that_does_not_match(spark, catalog):
    cases = spark.createDataFrame([(f"c{n}",) for n in range(50)], "case_key string")
    facts = spark.createDataFrame([("c1", "02", 0, "CAN_BO_SUNG", None)], "case_key string, code string, n long, override_status string, last_hashed_at timestamp")
    found = checklist.search_checklist(cases, facts, catalog, "cần bổ")
    assert [(r["case_key"], r["code"], r["has_override"]) for r in found.collect()] == [("c1", "02", True)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the text is not looked at above the unnesting
    assert "Generate inline" in plan and "Contains" not in plan.split("Generate inline")[0]


def one_by_one(batch, cases, documents, overrides, evidence, types):
    """Apply actions singly with a recompute after each; the audit rows they leave."""
    state = {c["case_key"]: dict(c) for c in cases}
    stored = {(o["case_key"], o["taxonomy_code"]): o["status"] for o in overrides}
    out = []

    def recompute(key, ts):
        case = state[key]
        _, n, missing, _ = figures_of(expected_checklist(key, documents, stored, evidence, types))
        auto = "CHUA_XU_LY" if n == 0 else "CAN_BO_SUNG" if missing else "CHO_KIEM_TRA"
        effective = case["manual_status"] or auto
        if effective != case["effective_status"]:
            kind = "MANUAL_STATUS_CHANGED" if case["manual_status"] else "AUTO_STATUS_CHANGED"
            out.append((key, ts, kind, case["effective_status"], effective, "recompute"))
        case["effective_status"] = effective

    for a in sorted(batch, key=lambda a: (a["ts"], a["seq"])):
        key, ts = a["case_key"], a["ts"]
        case = state[key]
        before = case["effective_status"]
        if a["action"] == "override":
            old = stored.get((key, a["code"]))
            stored[(key, a["code"])] = a["status"]
            out.append((key, ts, "CHECKLIST_OVERRIDE", None, None, f"{a['code']}: {old} -> {a['status']}"))
        elif a["action"] == "manual_status":
            case["manual_status"] = case["effective_status"] = a["status"]
            out.append((key, ts, "MANUAL_STATUS_CHANGED", before, a["status"], None))
        elif a["action"] == "complete":
            case.update(
                manual_status="HOAN_THANH", effective_status="HOAN_THANH", completed_at=ts, reviewed_by=a["reviewed_by"]
            )
            out.append((key, ts, "MARK_COMPLETED", before, "HOAN_THANH", a["reviewed_by"]))
        elif a["action"] == "reopen":
            detail = None
            if case["completed_at"]:
                stamp = case["completed_at"].strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")
                who = case["reviewed_by"] or "không xác định"
                detail = f"Hồ sơ từng được đánh dấu hoàn thành lúc {stamp} bởi {who}."
            case.update(manual_status=None, effective_status="CHUA_XU_LY", completed_at=None, reviewed_by=None)
            out.append((key, ts, "REOPENED", before, "CHUA_XU_LY", detail))
        else:
            case["note"] = a["note"]
            out.append((key, ts, "NOTE_UPDATED", None, None, a["note"]))
            continue
        recompute(key, ts)
    return out, state, stored


@pytest.mark.parametrize("seed", [3, 4])
def test_action_batches_equal_single_actions(spark, catalog, seed):
    cases, documents, overrides, evidence = random_state(spark, seed)
    rng = random.Random(seed)
    kinds = ["override"] * 5 + ["manual_status", "complete", "reopen", "note"]
    batch = []
    for n in range(150):
        kind = rng.choice(kinds)
        batch.append(
            {
                "case_key": "c0" if n % 3 else f"c{rng.randrange(8)}",
                "action": kind,
                "code": rng.choice(["01", "02", "03", "04", "08"]) if kind == "override" else None,
                "status": rng.choice(["CAN_BO_SUNG", "KHONG_PHAT_SINH", "CHUA_XAC_DINH"])
                if kind == "override"
                else rng.choice(["CHUA_XU_LY", "DANG_SO_HOA"])
                if kind == "manual_status"
                else None,
                "note": f"n{n}" if kind == "note" else None,
                "reviewed_by": rng.choice([None, "", "x"]) if kind == "complete" else None,
                "ts": START + timedelta(minutes=rng.randrange(600)),
                "seq": n,
            }
        )
    fields = schema.ACTIONS.fieldNames()
    types = [r.asDict() for r in catalog.collect()]
    result = updates.apply_actions(
        Work(spark),
        spark.createDataFrame([tuple(a[f] for f in fields) for a in batch], schema.ACTIONS),
        table(spark, "cases", cases),
        table(spark, "documents", documents),
        catalog,
        table(spark, "checklist_overrides", overrides),
        table(spark, "warnings", []),
        F.lit(datetime(2026, 2, 1)),
        spark.createDataFrame(evidence, schema.EVIDENCE),
    )
    want, state, stored = one_by_one(batch, cases, documents, overrides, evidence, types)
    got = result.history.orderBy("created_at", "seq").collect()
    columns = ("case_key", "created_at", "event_type", "from_status", "to_status", "detail")
    assert [tuple(r[c] for c in columns) for r in got] == want
    after = {r["case_key"]: r for r in result.cases.collect()}
    touched = {a["case_key"] for a in batch if a["action"] != "note"}
    for key, case in state.items():
        fields = ("manual_status", "completed_at", "reviewed_by", "note")
        assert tuple(after[key][f] for f in fields) == tuple(case.get(f) for f in fields), key
        if key in touched:
            assert after[key]["effective_status"] == case["effective_status"]
    assert {(r["case_key"], r["taxonomy_code"]): r["status"] for r in result.overrides.collect()} == stored
    assert result.rejected.count() == 0


def test_review_pending_and_status_order(spark):
    cells = [(0, True, 1), (1, True, 1), (1, False, 1), (1, False, 0)]
    df = spark.createDataFrame(cells, "d int, r boolean, m int")
    got = [r["s"] for r in df.select(status.auto_status(F.col("d"), F.col("r"), F.col("m")).alias("s")).collect()]
    assert got == ["CHUA_XU_LY", "DANG_SO_HOA", "CAN_BO_SUNG", "CHO_KIEM_TRA"]


def test_unreadable_and_badly_named_file_warns_twice(spark, catalog):
    documents = table(
        spark,
        "documents",
        [
            {"case_key": "c", "relative_path": "c/x.pdf", "filename": "x.pdf", "parse_status": "FILE_KHONG_DOC_DUOC", "is_present": True},
            {"case_key": "c", "relative_path": "c/01.other.pdf", "filename": "01.other.pdf", "parse_status": "OK", "is_present": True},
        ],
    )
    got = warnings.document_warnings(documents, catalog).orderBy("relative_path", "warning_type").collect()
    assert [(r["warning_type"], r["severity"]) for r in got] == [
        ("SAI_TEN_FILE", "WARNING"),
        ("FILE_KHONG_DOC_DUOC", "ERROR"),
        ("SAI_TEN_FILE", "WARNING"),
    ]
    assert got[0]["message"] == "Tên file khác tên chuẩn catalog: 01.other.pdf"
    assert got[1]["fingerprint"] == "c:c/x.pdf:FILE_KHONG_DOC_DUOC:Không đọc được PDF."


def request(token, pages, case="c", type_id="05", at=0):
    return (token * 32, case, type_id, "", "", START + timedelta(hours=at), pages)


def plan(spark, catalog, names, requests, manifests=None):
    cases = table(spark, "cases", [{"case_key": "c", "is_present": True}, {"case_key": "gone", "is_present": False}])
    documents = table(
        spark, "documents", [{"case_key": "c", "filename": n, "relative_path": f"c/{n}", "is_present": True} for n in names]
    )
    sources = [("scan.pdf", "s1", "d1"), ("photo.jpg", "s2", "d2")]
    pages = [("p1", "scan.pdf", "s1", 1, "p1.png"), ("p2", "scan.pdf", "s1", 2, "p2.png"), ("p3", "photo.jpg", "s2", None, "p3.png")]
    m = [(t * 32, c, sources, pages) for t, c in (manifests or [(r[0][0], r[1]) for r in requests])]
    return updates.plan_imports(
        Work(spark),
        spark.createDataFrame(requests, schema.REQUESTS),
        spark.createDataFrame(
            m,
            "token string, case_key string, sources array<struct<name:string,stored:string,sha256:string>>, pages "
            "array<struct<page_id:string,source_name:string,source_path:string,source_page:int,preview_name:string>>",
        ),
        documents,
        cases,
        catalog,
        F.lit(START),
    )


PAGES = [("p3", 90), ("p1", 0)]


def test_import_names(spark, catalog):
    base = "05.Type_5"
    three = [request(t, PAGES, at=n) for n, t in enumerate("abc")]
    fresh = plan(spark, catalog, [], three)
    assert [r["filename"] for r in fresh.names.orderBy("token").collect()] == [f"{base}.pdf", f"{base}.2.pdf", f"{base}.3.pdf"]
    assert [(r["rename_from"], r["rename_to"]) for r in fresh.renames.collect()] == [(f"{base}.pdf", f"{base}.1.pdf")]
    plain = plan(spark, catalog, [f"{base}.pdf"], three)
    assert [r["filename"] for r in plain.names.orderBy("token").collect()] == [f"{base}.{n}.pdf" for n in (2, 3, 4)]
    assert plain.renames.count() == 1
    numbered = plan(spark, catalog, [f"{base}.pdf", f"{base}.7.pdf", f"{base}.x.pdf", "05.Type_51.9.pdf"], three[:1])
    assert [r["filename"] for r in numbered.names.collect()] == [f"{base}.8.pdf"]
    assert numbered.renames.count() == 0
    row = fresh.provenance.filter("filename = '05.Type_5.pdf'").first()
    assert row["source_files"] == ["photo.jpg", "scan.pdf"]
    assert row["source_sha256"] == {"photo.jpg": "d2", "scan.pdf": "d1"}


def test_import_rejects(spark, catalog):
    requests = [
        request("a", PAGES, type_id="UNKNOWN"),
        request("b", []),
        request("c", [("p1", 0), ("p1", 0)]),
        request("d", [("p9", 0)]),
        request("e", [("p1", 45)]),
        request("f", PAGES, case="gone"),
        request("0", PAGES),
        request("x", PAGES),
        request("1", PAGES),
    ]
    manifests = [(t, c) for t, c in zip("abcdefx0", ["c"] * 5 + ["gone", "c", "other"])]
    got = {r["token"][0]: r["reason"] for r in plan(spark, catalog, [], requests, manifests).rejected.collect()}
    assert got == {
        "a": "invalid type code",
        "b": "invalid page list",
        "c": "invalid page list",
        "d": "invalid page list",
        "e": "invalid rotation",
        "f": "unknown case",
        "0": "session of another case",
        "x": "unreadable session",
        "1": "unreadable session",
    }


def test_long_page_lists(spark):
    asked = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "z")], "request int, page_id string")
    known = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "request int, page_id string")
    got = {r["request"]: r["valid"] for r in imports.page_list_checks(asked, known).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_old_case_tables_are_upgraded(spark):
    old = table(spark, "cases", [{"case_key": "c"}]).drop("type_count", "missing_type_count")
    row = schema.conform(old, "cases").first()
    assert (row["type_count"], row["missing_type_count"]) == (0, 0)


def test_transitions_need_a_change(spark):
    rows = [("a", None, "X", "Y"), ("b", "Y", "X", "Y"), ("c", None, "X", "X"), ("d", None, None, "X")]
    df = spark.createDataFrame(
        rows, "case_key string, manual_status string, old_effective_status string, effective_status string"
    )
    got = {r["case_key"]: r["event_type"] for r in status.status_transitions(df, F.lit(START)).collect()}
    assert got == {"a": "AUTO_STATUS_CHANGED", "b": "MANUAL_STATUS_CHANGED", "d": "AUTO_STATUS_CHANGED"}


def test_latest_override_breaks_ties_by_sequence(spark):
    rows = [("c", "override", "01", s, None, None, START, n) for n, s in enumerate(["CAN_BO_SUNG", "KHONG_PHAT_SINH"])]
    df = spark.createDataFrame(rows, schema.ACTIONS)
    assert actions.latest_overrides(df).first()["status"] == "KHONG_PHAT_SINH"


def test_prefix_fold_joins_totals_of_few_keys_and_keeps_null_keys(spark):
    rows = [("hot", n, 1) for n in range(300)] + [(None, n, 1) for n in range(300)] + [(f"k{n}", 0, 1) for n in range(50)]
    df = spark.createDataFrame(rows, "k string, t int, x int")
    out = spread.prefix_fold(df, ["k"], ["t"], {"before": F.col("x")}, {}, Work(spark).keep)
    got = out.collect()
    assert len(got) == len(rows) and all(r["before"] == r["t"] for r in got)
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_judging_requests_carries_no_sources_and_rejects_need_no_names(spark, catalog):
    requests = [request("a", PAGES), request("b", PAGES, type_id="77"), request("a", PAGES), request("a", PAGES, at=-1)]
    done = plan(spark, catalog, [], requests, [("a", "c"), ("b", "c")])
    assert sorted((r["token"][0], r["reason"]) for r in done.rejected.collect()) == [
        ("a", "session already used"), ("a", "session already used"), ("b", "invalid type code")
    ]
    kept = sorted(p.name.split("-", 1)[1] for p in Path(done.work.path.removeprefix("file:")).iterdir())
    assert kept == ["checked", "judged"]
    stored = {c for d in ("001-checked", "002-judged") for c in spark.read.parquet(f"{done.work.path}/{d}").columns}
    assert not stored & {"_sources", "_pages"}
    assert [r["source_files"] for r in done.provenance.collect()] == [["photo.jpg", "scan.pdf"]]


def test_pages_of_uploads_are_summed_by_hashing(spark):
    uploads = spark.createDataFrame([("a", "c", 1, "x.pdf", "s", 2), ("a", "c", 2, "y.exe", "s", 1), ("b", "c", 1, "z.png", "s", None)], "token string, case_key string, position int, name string, sha256 string, page_count int")
    named = imports.named_uploads(uploads)
    judged = imports.judge_uploads(spark.createDataFrame([("a", "c"), ("b", "c")], "token string, case_key string"), named)
    assert {tuple(r) for r in judged.collect()} == {("a", "c", "file type not allowed", "y.exe"), ("b", "c", None, None)}
    text = judged._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and all("problem" in line for line in text.splitlines() if "SortAggregate" in line)


def test_dealt_tables_fall_into_tasks_of_so_many_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("workload.inputs.ROWS_A_TASK", 100)
    spark.range(950).selectExpr("id % 90 as k", "id").write.parquet(f"{tmp_path}/lineitem.parquet")
    given = Inputs(spark, str(tmp_path))
    given.deal("lineitem", "k")
    dealt = given.table("lineitem").withColumn("part", F.spark_partition_id())
    assert dealt.rdd.getNumPartitions() == 10 and dealt.select("id").distinct().count() == 950
    assert dealt.select("k", "part").distinct().count() == 90
