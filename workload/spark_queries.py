"""The registered queries: library operators over the input views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions import names, text
from casebook.operators import actions, checklist, deltas, diff, imports, status, warnings
from casebook.plans import reports, search, updates
from casebook.plans import scan as scans
from casebook.sources import catalog as catalogs
from casebook.sources import listing, manifest
from workload.inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# --- folder and file names ---------------------------------------------------------------


@query
def folder_parse(i: Inputs) -> DataFrame:
    return names.with_folder_parts(i.view("folders")).drop("folder_path", "folder_name")


@query
def folder_invalid(i: Inputs) -> DataFrame:
    return names.with_folder_parts(i.view("folders")).filter("not folder_valid").select("case_key")


def parsed_files(i: Inputs) -> DataFrame:
    files = names.with_file_parts(i.view("files").select("relative_path", "filename"))
    known = catalogs.with_catalog(files, i.catalog, "file_code")
    return known.withColumns(
        {
            "status": names.name_status(F.col("file_code"), F.col("file_slug"), F.col("catalog_known")),
            "canonical": names.is_canonical(F.col("file_slug"), F.col("catalog_slug")),
        }
    )


@query
def filename_parse(i: Inputs) -> DataFrame:
    return parsed_files(i).select(
        "relative_path", "file_code", "file_sequence", "file_slug", "status", "canonical"
    )


@query
def parse_status_counts(i: Inputs) -> DataFrame:
    return parsed_files(i).groupBy("status", "canonical").agg(F.count("*").alias("n"))


@query
def canonical_match(i: Inputs) -> DataFrame:
    return (
        parsed_files(i)
        .filter("status = 'OK'")
        .groupBy("file_code", "catalog_name")
        .agg(F.count_if("canonical").alias("matching"), F.count_if(~F.col("canonical")).alias("different"))
    )


@query
def canonical_name(i: Inputs) -> DataFrame:
    return (
        parsed_files(i)
        .filter("status = 'OK'")
        .select(
            "relative_path",
            names.canonical_filename(F.col("catalog_base"), F.lit(None).cast("bigint")).alias("plain"),
            names.canonical_filename(F.col("catalog_base"), F.greatest("file_sequence", F.lit(1))).alias("numbered"),
        )
    )


@query
def path_containment(i: Inputs) -> DataFrame:
    """Stored paths as written by hand: some climb out of the root."""
    climbing = F.when(F.col("k") % 3 == 0, F.concat(F.lit("../"), "relative_path")).when(
        F.col("k") % 3 == 1, F.concat(F.lit("a/./b/../../"), "relative_path")
    )
    paths = i.view("files").select("k", F.coalesce(climbing, F.concat(F.lit("/"), "relative_path")).alias("path"))
    return paths.select("k", names.stays_inside(F.col("path")).alias("inside"))


@query
def path_ignored(i: Inputs) -> DataFrame:
    prefix = (
        F.when(F.col("k") % 5 == 0, ".x/")
        .when(F.col("k") % 5 == 1, "~$")
        .when(F.col("k") % 10 == 2, "Thumbs.db/")
        .when(F.col("k") % 5 == 2, "xThumbs.db/")  # near misses
        .when(F.col("k") % 10 == 3, "01.a~$b.pdf/")
        .when(F.col("k") % 10 == 4, "thumbs.db/")
        .otherwise("")
    )
    paths = i.view("files").select("k", F.concat(prefix, "filename").alias("path"))
    patterns = ("Thumbs.db", ".DS_Store", "~$*")
    return paths.select("k", names.is_ignored(F.col("path"), patterns).alias("ignored"))


# --- catalog -----------------------------------------------------------------------------


@query
def catalog_normalize(i: Inputs) -> DataFrame:
    entries = i.view("entries").withColumn("pos", F.col("n"))
    return catalogs.normalize(entries).withColumn("slug", names.catalog_slug(F.col("filename_base")))


@query
def catalog_lookup(i: Inputs) -> DataFrame:
    asked = i.view("requests").select("type_id")
    return catalogs.valid_codes(asked, i.catalog, "type_id").groupBy("type_id", "code_valid").agg(
        F.count("*").alias("n")
    )


@query
def catalog_seed(i: Inputs) -> DataFrame:
    loaded = i.catalog.withColumn("active", F.lit(True))
    return catalogs.seed(i.state("stored_catalog", "catalog"), loaded)


# --- evidence, checklist, roll-up --------------------------------------------------------


def documents_previous(i: Inputs) -> DataFrame:
    return i.state("documents_previous", "documents")


def cases_previous(i: Inputs) -> DataFrame:
    return i.state("cases_previous", "cases")


def overrides(i: Inputs) -> DataFrame:
    return i.state("overrides", "checklist_overrides")


def facts_previous(i: Inputs) -> DataFrame:
    return checklist.type_facts(documents_previous(i), overrides(i), i.view("evidence"))


@query
def docs_per_type(i: Inputs) -> DataFrame:
    return checklist.document_evidence(documents_previous(i))


@query
def external_evidence(i: Inputs) -> DataFrame:
    return checklist.external_evidence(i.view("evidence"))


@query
def evidence_merge(i: Inputs) -> DataFrame:
    return checklist.merge_evidence(
        checklist.document_evidence(documents_previous(i)), checklist.external_evidence(i.view("evidence"))
    )


def checklist_previous(i: Inputs) -> DataFrame:
    return checklist.checklist(cases_previous(i), facts_previous(i), i.catalog)


@query
def checklist_rows(i: Inputs) -> DataFrame:
    return checklist_previous(i)


@query
def checklist_without_evidence(i: Inputs) -> DataFrame:
    """The external source is optional."""
    facts = checklist.type_facts(documents_previous(i), overrides(i), None)
    return (
        checklist.checklist(cases_previous(i), facts, i.catalog)
        .groupBy("code", "status", "has_override")
        .agg(F.count("*").alias("n"), F.sum("document_count").alias("documents"))
    )


@query
def checklist_search(i: Inputs) -> DataFrame:
    found = checklist.search_checklist(cases_previous(i), facts_previous(i), i.catalog, " cần BỔ ")
    return found.select("case_key", "code", "status")


@query
def type_picker(i: Inputs) -> DataFrame:
    return checklist.find_types(i.catalog, "BẢN blue").select("code", "name")


@query
def case_progress(i: Inputs) -> DataFrame:
    rolled = checklist.rollup(cases_previous(i).select("case_key"), facts_previous(i), i.catalog)
    return rolled.select("case_key", "progress_percent")


@query
def case_rollup(i: Inputs) -> DataFrame:
    rolled = checklist.rollup(cases_previous(i).select("case_key"), facts_previous(i), i.catalog)
    return rolled.drop("progress_percent", "last_hashed_at")


# --- scan: diff, upserts, tombstones -----------------------------------------------------


@query
def scan_diff(i: Inputs) -> DataFrame:
    return diff.diff_listing(documents_previous(i), i.view("listing")).select(
        "relative_path", "case_key", "change_kind"
    )


@query
def scan_to_probe(i: Inputs) -> DataFrame:
    return diff.paths_to_probe(diff.diff_listing(documents_previous(i), i.view("listing")))


@query
def docs_not_listed(i: Inputs) -> DataFrame:
    return diff.not_listed(documents_previous(i), i.view("listing"), "relative_path").select(
        "relative_path", "case_key"
    )


@query
def cases_not_listed(i: Inputs) -> DataFrame:
    return diff.not_listed(cases_previous(i), i.view("folders"), "case_key").select("case_key")


def changes_now(i: Inputs) -> DataFrame:
    """The change set of a full scan, written once as a scan does."""
    return i.kept("changes", lambda: diff.change_set(documents_previous(i), i.view("listing")))


def documents_now(i: Inputs) -> DataFrame:
    touched = diff.touched_cases(cases_previous(i), i.view("folders"), full=True)
    return diff.upsert_documents(changes_now(i), i.view("probe"), i.catalog, touched, i.t1)


def cases_now(i: Inputs) -> DataFrame:
    found = diff.upsert_cases(cases_previous(i), i.view("folders"), i.t1)
    return diff.tombstone_cases(found, i.view("folders"), i.t1)


@query
def docs_upsert(i: Inputs) -> DataFrame:
    return documents_now(i).filter("is_present")


@query
def docs_tombstone(i: Inputs) -> DataFrame:
    return documents_now(i).filter("not is_present")


@query
def cases_upsert(i: Inputs) -> DataFrame:
    found = diff.upsert_cases(cases_previous(i), i.view("folders"), i.t1)
    return found.select(
        "case_key", "folder_path", "m1", "m5", "citizen_id", "person_name_display", "unit_code",
        "auto_status", "effective_status", "is_present", "first_seen_at", "last_seen_at",
        "last_scanned_at", "completed_at", "note",
    )


@query
def cases_tombstone(i: Inputs) -> DataFrame:
    return cases_now(i).filter("not is_present").select(
        "case_key", "effective_status", "last_seen_at", "last_scanned_at"
    )


def unit_scope(i: Inputs) -> DataFrame:
    """A scoped scan: the listed cases of one unit."""
    return i.view("folders").filter("folder_name like '07.%'")


@query
def scoped_diff(i: Inputs) -> DataFrame:
    scope = unit_scope(i)
    prior = diff.limit_to(documents_previous(i), scope)
    listing = diff.limit_to(i.view("listing"), scope)
    return diff.diff_listing(prior, listing).select("relative_path", "case_key", "change_kind")


@query
def scoped_upsert(i: Inputs) -> DataFrame:
    """After a scan of one unit: the documents of other units stay as they were."""
    scope = unit_scope(i)
    changes = i.kept("scoped_changes", lambda: diff.change_set(documents_previous(i), diff.limit_to(i.view("listing"), scope)))
    touched = diff.touched_cases(cases_previous(i), scope, full=False)
    after = diff.upsert_documents(changes, i.view("probe"), i.catalog, touched, i.t1)
    return after.select("relative_path", "parse_status", "is_present", "last_seen_at", "last_hashed_at")


def counted_scan(i: Inputs) -> dict[str, int]:
    """The tables of a scan, written with their counters."""
    counted = diff.Counted()
    i.kept("changes", lambda: counted.watch(diff.change_set(documents_previous(i), i.view("listing")), diff.file_counters()))
    i.kept("cases", lambda: counted.watch(cases_now(i), diff.case_counters()))
    i.kept("merged", lambda: counted.watch(merged_warnings(i), diff.warning_counters()))
    return counted.values()


@query
def scan_counters(i: Inputs) -> DataFrame:
    """Counters that ride on the jobs that write a scan's tables."""
    return i.spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counted_scan(i).items()])


@query
def schema_upgrade(i: Inputs) -> DataFrame:
    """A case table of an earlier version: columns it lacks get their defaults, kinds are those of today."""
    old = cases_previous(i).drop("type_count", "missing_type_count", "note").withColumn("document_count", F.col("document_count").cast("int"))
    now = schema.conform(old.withColumn("of_old", F.lit(1)), "cases")
    return now.select("case_key", "type_count", "missing_type_count", "note", "document_count", F.lit(len(now.columns)).alias("n_columns"))


@query
def records_json(i: Inputs) -> DataFrame:
    """A read result as JSON records."""
    shown = reports.filter_cases(cases(i), reports.CaseFilter(status="CAN_BO_SUNG")).select("case_key", "effective_status", "unit_code", "document_count")
    return shown.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


@query
def run_summary(i: Inputs) -> DataFrame:
    """The run log row of the scan."""
    result = scans.ScanResult(run_id=1, counters=counted_scan(i))
    row = scans.run_row(i.spark, result, datetime(2024, 1, 20))
    return row.select("run_id", "status", "started_at", "folders_seen", "files_seen", "docs_created", "warnings_created", "errors", "summary_json")


# --- warnings ----------------------------------------------------------------------------


#: What warning rules and recompute read of a document.
_READ = ("case_key", "relative_path", "filename", "taxonomy_code", "sha256", "parse_status", "is_present", "last_hashed_at")


def scanned_documents(i: Inputs) -> DataFrame:
    """The new snapshot's present documents, written before rules and recompute read them: what these read."""
    return i.kept("documents", lambda: documents_now(i).filter("is_present").select(*_READ))


def raised_now(i: Inputs) -> DataFrame:
    return warnings.scan_warnings(i.view("folders"), scanned_documents(i), i.catalog)


def merged_warnings(i: Inputs) -> DataFrame:
    return warnings.merge_warnings(
        i.state("warnings_previous", "warnings"), raised_now(i), i.t1, scanned=i.view("folders")
    )


def warnings_now(i: Inputs) -> DataFrame:
    """After the scan, plus reviews reported from outside."""
    return schema.conform(merged_warnings(i), "warnings").unionByName(i.state("reviews", "warnings"))


def rule(i: Inputs, kind: str, prefix: str = "") -> DataFrame:
    raised = warnings.document_warnings(scanned_documents(i), i.catalog)
    wanted = raised.filter((F.col("warning_type") == kind) & F.startswith("message", F.lit(prefix)))
    return wanted.select("relative_path", "severity", "message", "fingerprint")


@query
def warn_bad_folder(i: Inputs) -> DataFrame:
    return warnings.folder_warnings(i.view("folders")).select("case_key", "severity", "message", "fingerprint")


@query
def warn_malformed_name(i: Inputs) -> DataFrame:
    return rule(i, "SAI_TEN_FILE", "Tên file không theo mẫu")


@query
def warn_not_canonical(i: Inputs) -> DataFrame:
    return rule(i, "SAI_TEN_FILE", "Tên file khác tên chuẩn")


@query
def warn_unknown_type(i: Inputs) -> DataFrame:
    return rule(i, "FILE_NGOAI_TAXONOMY")


@query
def warn_duplicate(i: Inputs) -> DataFrame:
    return rule(i, "TRUNG_TAI_LIEU")


@query
def warn_unreadable(i: Inputs) -> DataFrame:
    return rule(i, "FILE_KHONG_DOC_DUOC")


@query
def warn_union(i: Inputs) -> DataFrame:
    return raised_now(i).groupBy("warning_type", "severity").agg(F.count("*").alias("n"))


@query
def warn_lifecycle(i: Inputs) -> DataFrame:
    return merged_warnings(i).select("fingerprint", "active", "created_at", "updated_at", "is_new")


@query
def dup_in_case(i: Inputs) -> DataFrame:
    present = documents_previous(i).filter("is_present").select("case_key", "relative_path", "sha256")
    return warnings.with_duplicate_count(present, ["case_key"], "sha256", "relative_path").filter("copies > 1")


@query
def dup_text(i: Inputs) -> DataFrame:
    """Content digests of whole texts, and which repeat within a source."""
    digested = i.table("documents").select("doc_id", "source", F.sha2("text", 256).alias("sha256"))
    return warnings.with_duplicate_count(digested, ["source"], "sha256", "doc_id")


@query
def dup_groups(i: Inputs) -> DataFrame:
    digested = i.table("documents").select("source", F.sha2("text", 256).alias("sha256"))
    return warnings.duplicate_groups(digested, ["source"], "sha256")


# --- case status (flagship) --------------------------------------------------------------


def figures_now(i: Inputs) -> DataFrame:
    return status.case_figures(
        cases_now(i).filter("is_present"), scanned_documents(i), i.catalog, overrides(i), warnings_now(i),
        i.view("evidence"),
    )


@query
def case_status(i: Inputs) -> DataFrame:
    """Completeness and status of every case after a scan: the flagship query."""
    return figures_now(i).drop("review_pending", "old_effective_status", "manual_status")


@query
def recompute_from_changes(i: Inputs) -> DataFrame:
    """The flagship's figures by differences: stored counts and figures, and what the scan changed.

    What several steps read is written once: stored warnings, evidence counts, the cases, and who is concerned.
    """
    stored = i.kept("stored-warnings", lambda: i.state("warnings_previous", "warnings"))
    evidence = i.kept("evidence", lambda: checklist.external_evidence(i.view("evidence")))
    counts = i.kept("counts", lambda: deltas.stored_counts(changes_now(i)))
    before = i.kept("figures", lambda: status.figures_from_facts(
        cases_previous(i).filter("is_present"), checklist.facts_from_counts(counts, overrides(i), evidence), i.catalog, stored,
    ))
    touched = diff.touched_cases(cases_previous(i), i.view("folders"), full=True)
    sides = ("change_kind", *[diff.BEFORE + n for n in deltas.COUNTED])
    documents = i.kept("documents", lambda: diff.moved_documents(
        changes_now(i), i.view("probe"), i.catalog, touched, i.t1, unchanged=True
    ).select(*_READ, *sides))
    differences = i.kept("deltas", lambda: deltas.count_deltas(documents.filter("change_kind <> 'UNCHANGED'")))
    read = ("case_key", "relative_path", "warning_type", "message", "active", "was_active")
    reviews = i.state("reviews", "warnings").withColumn("was_active", F.lit(False))
    found = warnings.scan_warnings(i.view("folders"), documents, i.catalog)
    merged = warnings.merge_warnings(stored, found, i.t1, scanned=i.view("folders"))
    raised = i.kept("merged", lambda: merged.select(*read).unionByName(reviews.select(*read)))
    present = i.kept("cases", lambda: cases_now(i).filter("is_present"))
    concerned = i.kept("concerned", lambda: deltas.moved_cases(before, present, differences, raised))
    after = deltas.figures_after(before, concerned, present, counts, differences, i.catalog, overrides(i), raised, evidence)
    return after.drop("review_pending", "old_effective_status", "manual_status")


@query
def counts_from_changes(i: Inputs) -> DataFrame:
    """Document counts after the scan, by differences."""
    touched = diff.touched_cases(cases_previous(i), i.view("folders"), full=True)
    moved = diff.moved_documents(changes_now(i), i.view("probe"), i.catalog, touched, i.t1)
    return deltas.apply_deltas(deltas.document_counts(documents_previous(i)), deltas.count_deltas(moved))


@query
def case_snapshot(i: Inputs) -> DataFrame:
    """The case table after the recompute; absent cases keep their figures."""
    renewed = status.with_figures(cases_now(i), figures_now(i), i.t1)
    return renewed.select(
        "case_key", "auto_status", "manual_status", "effective_status", "progress_percent",
        "document_count", "warning_count", "is_present", "last_scanned_at",
    )


@query
def status_transitions(i: Inputs) -> DataFrame:
    return status.status_transitions(figures_now(i), i.t1).drop("seq")


@query
def changed_after_completion(i: Inputs) -> DataFrame:
    facts = checklist.type_facts(scanned_documents(i), overrides(i), None)
    return status.changed_after_completion(cases_now(i).filter("is_present"), facts)


@query
def recompute_warnings(i: Inputs) -> DataFrame:
    """Warnings after the recompute: changes after completion are raised and counted."""
    done = status.recompute(
        cases_now(i), scanned_documents(i), i.catalog, overrides(i),
        i.kept("warnings", lambda: warnings_now(i)), i.t1, i.view("evidence"), keep=i.work.keep,
    )
    return done.warnings.groupBy("warning_type", "active").agg(F.count("*").alias("n"))


# --- dashboard ---------------------------------------------------------------------------


def cases(i: Inputs) -> DataFrame:
    return i.view("cases")


def totals(i: Inputs) -> DataFrame:
    return reports.unit_status_totals(cases(i))


@query
def dash_status_counts(i: Inputs) -> DataFrame:
    return reports.status_histogram(totals(i))


@query
def dash_totals(i: Inputs) -> DataFrame:
    return reports.overall(totals(i))


@query
def dash_units(i: Inputs) -> DataFrame:
    return reports.unit_progress(totals(i))


@query
def dash_actions(i: Inputs) -> DataFrame:
    return reports.action_queue(cases(i)).select("case_key", "effective_status", "warning_count")


@query
def dash_warnings(i: Inputs) -> DataFrame:
    return reports.active_warnings(i.view("warnings"))


@query
def last_run(i: Inputs) -> DataFrame:
    return reports.last_run(i.view("runs"))


@query
def run_log(i: Inputs) -> DataFrame:
    return reports.run_log(i.view("runs"))


# --- case list ---------------------------------------------------------------------------

SHOWN = ("case_key", "person_name_display", "effective_status", "unit_code", "progress_percent")


def listed(i: Inputs, **f: object) -> DataFrame:
    return reports.filter_cases(cases(i), reports.CaseFilter(**f), i.view("warnings")).select(*SHOWN)


@query
def case_search(i: Inputs) -> DataFrame:
    return listed(i, q="LE van")


@query
def case_search_accent(i: Inputs) -> DataFrame:
    """Only ASCII letters are folded: the lower-case accented query finds nothing upper-case."""
    return listed(i, q="đỗ").unionByName(listed(i, q="Đỗ tHị_1"))


@query
def case_search_indexed(i: Inputs) -> DataFrame:
    """Searches through postings: plain, with a wildcard, with a filter, and too short for a posting."""
    index = search.index_cases(cases(i), i.work)
    asked = (dict(q="LE van"), dict(q="Đỗ tHị_1"), dict(q="NGUYEN", warning=True), dict(q="07"))
    found = [search.search_cases(index, reports.CaseFilter(**f), i.work, i.view("warnings")) for f in asked]
    return reduce(DataFrame.unionByName, [f.select(F.lit(n).alias("search"), *SHOWN) for n, f in enumerate(found)])


@query
def case_filter_status_unit(i: Inputs) -> DataFrame:
    return listed(i, status="CAN_BO_SUNG", unit="07")


@query
def case_with_warning(i: Inputs) -> DataFrame:
    return listed(i, warning=True)


@query
def case_missing_p1(i: Inputs) -> DataFrame:
    return listed(i, missing_p1=True)


@query
def case_filter_all(i: Inputs) -> DataFrame:
    return listed(i, q="THị", status="CAN_BO_SUNG", warning=True, missing_p1=True)


@query
def case_filter_total(i: Inputs) -> DataFrame:
    return listed(i, q="nguyen", warning=True).agg(F.count("*").alias("total"))


def paged(i: Inputs, sort: str, page: int) -> DataFrame:
    chosen = reports.filter_cases(cases(i), reports.CaseFilter())
    return reports.page_rows(chosen, sort, page, 50).select(*SHOWN)


@query
def case_page_name(i: Inputs) -> DataFrame:
    return paged(i, "name", 3)


@query
def case_page_progress(i: Inputs) -> DataFrame:
    return paged(i, "progress", 2)


@query
def case_page_updated(i: Inputs) -> DataFrame:
    return paged(i, "updated", 1)


@query
def case_page_after(i: Inputs) -> DataFrame:
    """The page after the last row of page 2."""
    chosen = reports.filter_cases(cases(i), reports.CaseFilter())
    value, _ = reports.sort_value("name")
    before = reports.page_rows(chosen, "name", 2, 50)
    last = before.agg(F.max(F.struct(value.alias("value"), "case_key")).alias("last")).first()["last"]
    return reports.page_after(chosen, "name", last["value"], last["case_key"], 50).select(*SHOWN)


@query
def case_page_far(i: Inputs) -> DataFrame:
    """A page four fifths down the list, by its number."""
    total = reports.filter_cases(cases(i), reports.CaseFilter()).count()
    page = -(-total // 50) * 4 // 5
    return reports.case_page(cases(i), reports.CaseFilter(), sort="name", page=page, page_size=50, work=i.work).items.select(*SHOWN)


@query
def page_clamp(i: Inputs) -> DataFrame:
    asked = i.table("orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 60 - 5).alias("page"),
        (F.col("o_custkey") % 300 - 5).alias("page_size"),
    )
    total = reports.present(cases(i)).agg(F.count("*")).scalar()
    return reports.page_numbers(asked, total)


@query
def distinct_units(i: Inputs) -> DataFrame:
    return reports.distinct_units(cases(i))


@query
def case_picker(i: Inputs) -> DataFrame:
    return reports.case_picker(cases(i))


@query
def case_lookup(i: Inputs) -> DataFrame:
    return reports.one_case(cases(i), "05.000.036.001.5_000000000005_le_VAN_5").select(*SHOWN)


@query
def document_lookup(i: Inputs) -> DataFrame:
    """The last path of the previous snapshot, looked up by its name."""
    documents = documents_previous(i)
    path = reports.present_documents(documents).agg(F.max("relative_path")).first()[0]
    return reports.one_document(documents, path).select("relative_path", "sha256", "parse_status")


# --- reviews and details -----------------------------------------------------------------


@query
def review_list(i: Inputs) -> DataFrame:
    return reports.review_list(cases(i), i.view("warnings"))


@query
def detail_documents(i: Inputs) -> DataFrame:
    return reports.present_documents(documents_previous(i)).select(
        "case_key", "relative_path", "filename", "page_count", text.ui_label(F.col("parse_status")).alias("label")
    )


@query
def detail_warnings(i: Inputs) -> DataFrame:
    return reports.warnings_of_cases(i.view("warnings"), cases(i)).select(
        "case_key", "fingerprint", "severity", text.ui_label(F.col("warning_type")).alias("label"), "message"
    )


@query
def detail_documents_order(i: Inputs) -> DataFrame:
    shown = reports.present_documents(documents_previous(i)).select("case_key", "relative_path")
    return reports.numbered(shown, ["relative_path"], i.work.keep)


@query
def detail_warnings_order(i: Inputs) -> DataFrame:
    shown = i.view("warnings").filter("active").select(
        "case_key", reports.severity_rank().alias("rank"), "created_at", "fingerprint"
    )
    return reports.numbered(shown, ["rank", "created_at", "fingerprint"], i.work.keep).select(
        "case_key", "fingerprint", "position"
    )


@query
def detail_history_top12(i: Inputs) -> DataFrame:
    return reports.recent_history(i.view("history")).select(
        "case_key", "position", "seq", text.ui_label(F.col("event_type")).alias("label"), "detail"
    )


@query
def detail_counts(i: Inputs) -> DataFrame:
    return reports.detail_counts(cases(i), documents_previous(i), i.view("warnings"), i.view("history"))


@query
def detail_one_case(i: Inputs) -> DataFrame:
    """The checklist of one case, as its detail shows it."""
    detail = reports.case_detail(
        "05.000.036.001.5_000000000005_le_VAN_5", cases_previous(i), documents_previous(i),
        i.view("warnings"), i.view("history"), overrides(i), i.catalog, i.view("evidence"),
    )
    return detail.checklist


# --- operator actions --------------------------------------------------------------------


def checked(i: Inputs) -> actions.Checked:
    return actions.check_actions(i.view("actions"), cases_previous(i), i.catalog)


@query
def reject_actions(i: Inputs) -> DataFrame:
    return checked(i).rejected.select("seq", "case_key", "action", "reason")


@query
def accept_actions(i: Inputs) -> DataFrame:
    return checked(i).accepted.groupBy("case_key", "action").agg(F.count("*").alias("n"))


@query
def override_latest(i: Inputs) -> DataFrame:
    return actions.latest_overrides(i.view("accepted"))


@query
def override_merge(i: Inputs) -> DataFrame:
    return actions.merge_overrides(overrides(i), i.view("accepted"))


@query
def action_fold(i: Inputs) -> DataFrame:
    state = actions.final_case_state(i.view("accepted"))
    return actions.apply_case_state(cases_previous(i), state).select(
        "case_key", "manual_status", "completed_at", "reviewed_by"
    )


@query
def note_latest(i: Inputs) -> DataFrame:
    state = actions.final_case_state(i.view("accepted"))
    return actions.apply_case_state(cases_previous(i), state).select("case_key", "note")


def replayed(i: Inputs) -> DataFrame:
    return updates.replay_actions(
        i.work, i.view("accepted"), cases_previous(i), documents_previous(i), i.catalog, overrides(i),
        i.state("reviews", "warnings"), i.view("evidence"),
    )


@query
def override_audit(i: Inputs) -> DataFrame:
    facts = facts_previous(i)
    return actions.with_previous_override(i.view("accepted"), facts, i.work.keep).select(
        "seq",
        "evidence",
        text.override_detail(F.col("code"), F.col("old_status"), F.col("status")).alias("detail"),
    )


@query
def action_replay(i: Inputs) -> DataFrame:
    """Each action with the effective status of its case before and after it."""
    return replayed(i).select(
        "seq", "case_key", "action", "effective_before", "effective_after", "completed_before", "reviewed_before"
    )


@query
def action_history(i: Inputs) -> DataFrame:
    return actions.audit_rows(replayed(i))


@query
def reopen_audit(i: Inputs) -> DataFrame:
    return actions.audit_rows(replayed(i)).filter("event_type = 'REOPENED'").select("case_key", "seq", "detail")


# --- imports -----------------------------------------------------------------------------


def named_documents(i: Inputs) -> DataFrame:
    return i.state("named_files", "documents")


def import_requests(i: Inputs, chosen: str = "true") -> DataFrame:
    """Requests (those with a number ``k`` that is ``chosen``) with their page lists: some empty, with repeats, unknown pages
    or odd angles."""
    k = F.col("k")
    page = lambda n: F.struct(
        F.concat(F.lit("p"), F.when((k % 43 == 0) & (n == 2), n - 1).otherwise(n).cast("string")).alias("id"),
        (F.when(k % 47 == 0, 45).otherwise(90) * n.cast("int") - 180).cast("int").alias("rotation"),
    )
    count = F.col("n_pages") + F.when(k % 53 == 0, 3).otherwise(0)
    pages = F.when(k % 59 == 0, F.array().cast("array<struct<id:string,rotation:int>>")).otherwise(
        F.transform(F.sequence(F.lit(1).cast("bigint"), count), page)
    )
    return i.view("requests").filter(chosen).select(
        "token", "case_key", "type_id", "document_date", "note", pages.alias("pages"), "requested_at"
    )


def manifests(i: Inputs) -> DataFrame:
    """Upload sessions: four pages of a scan and a photo. One in 61 belongs to another case."""
    k = F.col("k")
    source = lambda name: F.struct(
        F.lit(name).alias("name"), F.lit("s").alias("stored"), F.sha2(F.concat(k.cast("string"), F.lit(name)), 256).alias("sha256")
    )
    page = lambda n: F.struct(
        F.concat(F.lit("p"), n.cast("string")).alias("page_id"),
        F.when(n % 3 == 0, "photo.jpg").otherwise("scan.pdf").alias("source_name"),
        F.lit("s").alias("source_path"),
        n.cast("int").alias("source_page"),
        F.lit("x.png").alias("preview_name"),
    )
    return i.view("requests").select(
        "token",
        F.when(k % 61 == 0, "other").otherwise(F.col("case_key")).alias("case_key"),
        F.array(source("scan.pdf"), source("photo.jpg")).alias("sources"),
        F.transform(F.sequence(F.lit(1), F.lit(5)), page).alias("pages"),
    )


def import_plan(i: Inputs) -> updates.ImportPlan:
    return updates.plan_imports(
        i.work, import_requests(i), manifests(i), named_documents(i), cases(i), i.catalog, i.t1
    )


@query
def max_sequence(i: Inputs) -> DataFrame:
    return imports.existing_numbers(named_documents(i), i.catalog)


@query
def next_name(i: Inputs) -> DataFrame:
    """Name preview for every case and type asked for."""
    known = F.col("type_id") != "UNKNOWN"
    wanted = i.view("requests").filter(known).select("case_key", F.col("type_id").alias("code")).distinct()
    return imports.next_filename(imports.existing_numbers(named_documents(i), i.catalog), i.catalog, wanted)


@query
def import_names(i: Inputs) -> DataFrame:
    return import_plan(i).names


def import_again(i: Inputs, chosen: str) -> updates.ImportPlan:
    """A further batch, after one of the requests with even numbers whose files no scan has seen yet."""
    even = import_requests(i, "k % 2 = 0")
    first = updates.plan_imports(i.work, even, manifests(i), named_documents(i), cases(i), i.catalog, i.t0)
    events = i.kept("import_events", lambda: first.provenance.select("token", "case_key", "filename"))  # what a plan reads of them
    return updates.plan_imports(
        i.work, import_requests(i, chosen), manifests(i), named_documents(i), cases(i), i.catalog, i.t1, events
    )


@query
def import_second_batch(i: Inputs) -> DataFrame:
    """Names of a second batch go on after those of the first."""
    return import_again(i, "k % 2 = 1").names


@query
def import_token_reuse(i: Inputs) -> DataFrame:
    """Requests of which every other one names a session that an earlier batch has used up."""
    return import_again(i, "k % 3 = 0").rejected


@query
def import_renames(i: Inputs) -> DataFrame:
    return import_plan(i).renames


@query
def import_rejects(i: Inputs) -> DataFrame:
    return import_plan(i).rejected


@query
def import_provenance(i: Inputs) -> DataFrame:
    return import_plan(i).provenance.select(
        "token",
        "filename",
        "document_date",
        F.to_json("source_files").alias("source_files"),
        F.to_json("source_sha256").alias("source_sha256"),
    )


@query
def page_list_check(i: Inputs) -> DataFrame:
    """Turns of conversations as pages of a request, against the turns of the previous one."""
    turns = i.table("conversations").select("conv_id", F.col("turn").alias("page_id"))
    asked = turns.select(F.col("conv_id").alias("request"), "page_id")
    known = turns.select((F.col("conv_id") + 1).alias("request"), "page_id")
    return imports.page_list_checks(asked, known)


@query
def rotation_check(i: Inputs) -> DataFrame:
    angles = i.table("orders").select("o_orderkey", (F.col("o_orderkey") * 15 - 300).alias("rotation"))
    return angles.withColumn("valid", text.valid_rotation(F.col("rotation")))


@query
def upload_type_check(i: Inputs) -> DataFrame:
    k = F.col("page_id")
    ending = F.get(F.split(F.lit(".jpg,.JPEG,.png,.pdf,.gif,,.pdf.exe,.tar.PDF"), ","), (k % 8).cast("int"))
    uploads = i.table("pages").select("page_id", F.concat(F.lit("upload"), k.cast("string"), ending).alias("name"))
    return uploads.withColumn("allowed", text.allowed_upload(F.col("name")))


# --- display -----------------------------------------------------------------------------


@query
def labels(i: Inputs) -> DataFrame:
    """Labels of all codes met in warnings, history and statuses, and of free text."""
    codes = (
        i.view("warnings").select(F.col("warning_type").alias("value"))
        .union(i.view("history").select("event_type"))
        .union(cases(i).select("effective_status"))
        .union(documents_previous(i).select("parse_status"))
        .union(i.table("orders").select("o_orderpriority"))
        .union(i.table("customer").select(F.concat(F.lit(" "), F.upper("c_mktsegment"), F.lit("_X "))))
        .union(cases(i).select(F.col("is_present").cast("string")))
        .union(cases(i).select("manual_status"))
    )
    return codes.groupBy(
        "value", text.ui_label(F.col("value")).alias("label"), text.ui_label(F.col("value"), "?").alias("or_given")
    ).agg(F.count("*").alias("n"))


@query
def format_ts(i: Inputs) -> DataFrame:
    return i.view("stamps").select("event_id", text.format_datetime(F.col("written")).alias("shown"))


@query
def format_day(i: Inputs) -> DataFrame:
    return i.view("stamps").select("event_id", text.format_date(F.col("written")).alias("shown"))


@query
def format_ts_forms(i: Inputs) -> DataFrame:
    return i.view("stamp_forms").select("event_id", text.format_datetime(F.col("written")).alias("shown"))


# --- uploads -----------------------------------------------------------------------------


def uploads(i: Inputs) -> tuple[DataFrame, DataFrame]:
    i.deal("lineitem", "l_orderkey")
    named = i.kept("named_uploads", lambda: imports.named_uploads(i.view("uploads")).drop("sha256"))
    return named, i.kept("judged_uploads", lambda: imports.judge_uploads(i.view("sessions"), named))


@query
def upload_rejects(i: Inputs) -> DataFrame:
    return uploads(i)[1].filter("reason is not null")


@query
def upload_manifest(i: Inputs) -> DataFrame:
    """The pages that accepted upload sessions offer, numbered over all files of a session."""
    return imports.upload_pages(*uploads(i), i.work.keep)


@query
def manifest_check(i: Inputs) -> DataFrame:
    """Manifests as texts: what is wrong with each and the text itself."""
    parsed = manifest.parse_manifests(i.view("manifest_texts"))
    return parsed.select("token", F.when(F.col("pages").isNotNull(), F.size("pages")).alias("n_pages"), "case_key", "reason", "broken")


# --- listings ----------------------------------------------------------------------------


@query
def folded_names(i: Inputs) -> DataFrame:
    return i.view("odd_names").select("k", names.folded(F.col("relative_path")).alias("folded"))


@query
def listing_order(i: Inputs) -> DataFrame:
    return listing.with_positions(i.view("odd_names").select("relative_path"), i.work.keep)


@query
def inventory_listing(i: Inputs) -> DataFrame:
    return listing.listing_from_inventory(i.view("inventory"), "/data")
