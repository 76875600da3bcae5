"""The scan: list, compare, read what changed, raise warnings, recompute, publish."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schema
from casebook.operators import deltas, diff, status, warnings
from casebook.sources import catalog as catalogs
from casebook.sources import content, listing
from casebook.sources.state import StateStore
from casebook.sources.work import Work


# Names of the stored run columns, which the run log row and its JSON summary hold in this order.
_COUNTERS = tuple(n for n in schema.TABLES["scan_runs"].fieldNames() if n.endswith(("_seen", "_created", "_updated")))


@dataclass
class ScanResult:
    """What a scan reports: the run number, its outcome, the counters (as attributes too) and the time it took."""

    run_id: int
    status: str = "SUCCESS"
    counters: dict[str, int] = field(default_factory=lambda: dict.fromkeys(_COUNTERS, 0))
    error_messages: list[str] = field(default_factory=list)
    duration_ms: int = 0

    def __getattr__(self, name: str) -> int:
        if name in _COUNTERS:
            return self.counters[name]
        raise AttributeError(name)

    @property
    def errors(self) -> int:
        return len(self.error_messages)

    def values(self) -> dict[str, object]:
        """All values by their stored names."""
        own = {n: self.counters[n] for n in _COUNTERS}
        shown = {"run_id": self.run_id, "status": self.status, **own, "errors": self.errors}
        return {**shown, "error_messages": self.error_messages, "duration_ms": self.duration_ms}


def moment(at: datetime) -> Column:
    """A point in time as a column, independent of the session time zone."""
    utc = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    whole = int(utc.replace(microsecond=0).timestamp()) * 1_000_000
    return F.timestamp_micros(F.lit(whole + utc.microsecond))


def scan(
    store: StateStore,
    root: str,
    catalog: DataFrame,
    at: datetime | None = None,
    scope: DataFrame | None = None,
    evidence: DataFrame | None = None,
    page_counter: Callable | None = None,
    ignore: tuple[str, ...] = listing.IGNORED,
    tasks: int | None = None,
    folders: DataFrame | None = None,
    files: DataFrame | None = None,
) -> ScanResult:
    """Scan all case folders under ``root``, or those whose keys are in ``scope``.

    With ``files`` (``listing.listing_from_inventory``), and ``folders`` where some are empty, nothing is listed. A scope
    may name stored cases only; their folders are looked up one by one. A failure is recorded in the run log and
    nothing else of the scan is published.
    """
    spark = store.spark
    started, begun = at or datetime.now(timezone.utc), time.perf_counter()
    result = ScanResult(run_id=store.version() + 1)
    work = Work(spark)
    try:
        draft = store.draft()
        found = _scan(spark, draft, work, root, catalog, moment(started), scope, evidence, page_counter, ignore, tasks, folders, files)
        result.counters.update(found)
    except Exception as failure:
        draft = store.draft()
        result.status = "ERROR"
        result.error_messages.append(str(failure).splitlines()[0])
    finally:
        work.drop()
    result.duration_ms = int((time.perf_counter() - begun) * 1000)
    draft.append("scan_runs", run_row(spark, result, started))
    draft.publish()
    return result


def run_row(spark: SparkSession, result: ScanResult, started: datetime) -> DataFrame:
    """The run log row, with a JSON summary of the result."""
    values = result.values()
    summary = F.to_json(
        F.struct(*[_literal(v).alias(n) for n, v in values.items()]), {"ignoreNullFields": "false"}
    )
    counters = [n for n in values if n not in ("error_messages",)]
    return spark.range(1).select(
        *[_literal(values[n]).alias(n) for n in counters],
        moment(started).alias("started_at"),
        F.current_timestamp().alias("ended_at"),
        summary.alias("summary_json"),
    )


def _literal(value: object) -> Column:
    if isinstance(value, list):
        return F.array(*[F.lit(v) for v in value]).cast("array<string>")
    return F.lit(value).cast("bigint") if isinstance(value, int) else F.lit(value)


def _listed(spark, work, root, scope, prior_cases, ignore, tasks, folders, files) -> tuple[DataFrame, DataFrame]:
    """Folders and files of the scan, each written once."""
    if scope is not None:
        unknown = scope.select("case_key").join(prior_cases.select("case_key"), "case_key", "left_anti").first()
        if unknown:
            raise ValueError(f"unknown case: {unknown['case_key']}")
    if files is None and folders is None:
        found = listing.list_folders(spark, root, ignore) if scope is None else listing.folders_of_cases(spark, root, scope, tasks)
    else:
        found = diff.limit_to(listing.folders_from_inventory(files, root) if folders is None else folders, scope)
    found = work.keep(found.select(*schema.FOLDERS.fieldNames()), "folders")
    listed = listing.list_pdfs(work, found, root, tasks, ignore) if files is None else diff.limit_to(files, found)
    return found, work.keep(listed, "files")


def _scan(
    spark, draft, work, root, catalog, at, scope, evidence, page_counter, ignore, tasks, folders, files
) -> dict[str, int]:
    tasks = tasks or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    full, counted = scope is None, diff.Counted()
    known_types = draft.read("catalog")
    types = catalogs.pin(catalogs.seed(known_types, catalog))
    prior_cases, prior_documents, prior_warnings = (draft.read(t) for t in ("cases", "documents", "warnings"))

    folders, files = _listed(spark, work, root, scope, prior_cases, ignore, tasks, folders, files)

    # a scoped scan compares, and reads again, the documents of its cases only
    comparable = prior_documents if full else diff.limit_to(prior_documents, folders)
    compared = counted.watch(diff.change_set(comparable, files), diff.file_counters())
    compared = work.keep(compared, "changes")
    paths = diff.paths_to_probe(compared)
    probed = work.keep(content.probe_files(paths, root, content.task_count(paths), page_counter), "probe")

    touched = diff.touched_cases(prior_cases, folders, full)
    renewed = diff.upsert_documents(compared, probed, types, touched, at)
    if not full:
        renewed = renewed.unionByName(prior_documents.join(folders.select("case_key"), "case_key", "left_anti"))
    documents = draft.replace("documents", renewed)
    counts = draft.replace(
        "document_counts", _counts(draft, compared, probed, known_types, types, touched, at, documents)
    )
    listed = diff.upsert_cases(prior_cases, folders, at)
    cases = counted.watch(diff.tombstone_cases(listed, folders, at) if full else listed, diff.case_counters())
    cases = work.keep(cases, "cases")

    scanned = documents if full else diff.limit_to(documents, folders)
    raised = warnings.scan_warnings(folders, scanned, types)
    merged = warnings.merge_warnings(prior_warnings, raised, at, scanned=folders)
    merged = work.keep(counted.watch(merged, diff.warning_counters()), "warnings")

    done = status.recompute(
        schema.conform(cases, "cases"), documents, types, draft.read("checklist_overrides"), schema.conform(merged, "warnings"), at,
        evidence, scope=None if full else folders, keep=work.keep, counts=counts,
    )
    draft.replace("catalog", types)
    draft.replace("cases", done.cases)
    draft.replace("warnings", done.warnings)
    draft.append("case_history", done.transitions)
    return counted.values()


def _counts(draft, compared, probed, known_types, types, touched, at, documents) -> DataFrame:
    """The document counts after the scan: the stored ones and the differences of what changed.

    A state of an earlier version has none; they are then counted once. Where the catalog's codes have changed, documents
    of other cases than the scanned ones keep theirs until they are scanned, as their rows do.
    """
    if not draft.has("document_counts"):
        return deltas.document_counts(documents)
    moved = diff.moved_documents(compared, probed, types, touched, at, unchanged=not catalogs.same_codes(known_types, types))
    return deltas.apply_deltas(draft.read("document_counts"), deltas.count_deltas(moved))
