"""Comparing a listing with the stored snapshot; case and document upserts and tombstones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions import names
from casebook.sources.catalog import with_catalog


def change_kind(prior_known: Column, listed: Column, same: Column) -> Column:
    return (
        F.when(listed & ~prior_known, "NEW")
        .when(listed & same, "UNCHANGED")
        .when(listed, "CHANGED")
        .otherwise("GONE")
    )


#: What a change carries of the stored document, each under this prefix.
BEFORE = "p_"
#: What only documents that are not listed need of it; the others get it from their file.
_OF_GONE = ("filename", "taxonomy_name", "sequence_no", "priority", "size_bytes", "mtime_ns", "last_seen_at")
_CARRIED = [f.name for f in schema.TABLES["documents"].fields if f.name not in ("case_key", "relative_path")]


def change_set(prior: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per path known to either side: its change kind, the listed size and time, and the stored document's values.

    A file is unchanged if size and modification time agree and it was present before. Everything a scan does to
    documents follows from this table: what to read, the next snapshot, tombstones, counters and count differences.
    It is written, so listed files carry only what they keep.
    """
    p = prior.select("relative_path", F.col("case_key").alias("_case"), *[F.col(n).alias(BEFORE + n) for n in _CARRIED])
    c = listing.select("relative_path", "case_key", "size_bytes", "mtime_ns")
    same = F.col("p_is_present") & (F.col("p_size_bytes") == F.col("size_bytes")) & (F.col("p_mtime_ns") == F.col("mtime_ns"))
    carried = {n: F.col(BEFORE + n) for n in _CARRIED}
    carried |= {n: F.when(F.col("size_bytes").isNull(), carried[n]) for n in _OF_GONE}
    return p.join(c, "relative_path", "full_outer").select(
        "relative_path",
        F.coalesce("case_key", "_case").alias("case_key"),
        change_kind(F.col("p_is_present").isNotNull(), F.col("size_bytes").isNotNull(), same).alias("change_kind"),
        "size_bytes",
        "mtime_ns",
        *[column.alias(BEFORE + n) for n, column in carried.items()],
    )


def diff_listing(prior: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per path known to either side, with its change kind."""
    return change_set(prior, listing).select("relative_path", "case_key", "change_kind", "size_bytes", "mtime_ns")


def paths_to_probe(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("change_kind").isin("NEW", "CHANGED")).select("relative_path", "size_bytes")


def not_listed(prior: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key is no longer listed."""
    return prior.join(listing.select(key), key, "left_anti")


def limit_to(df: DataFrame, scope: DataFrame | None) -> DataFrame:
    """Rows of the cases in ``scope`` (any number of keys); everything without a scope."""
    if scope is None:
        return df
    return df.join(scope.select("case_key"), "case_key", "left_semi")


def _present(listed: DataFrame, catalog: DataFrame, at: Column) -> DataFrame:
    """Listed files as documents, next to what was stored of them."""
    named = listed.withColumn("_name", F.element_at(F.split("relative_path", "/"), -1))
    parsed = with_catalog(names.with_file_parts(named, "_name"), catalog, "file_code")
    status = names.name_status(F.col("file_code"), F.col("file_slug"), F.col("catalog_known"))
    return parsed.select(
        "case_key",
        "relative_path",
        F.col("_name").alias("filename"),
        F.col("file_code").alias("taxonomy_code"),
        F.col("catalog_name").alias("taxonomy_name"),
        F.col("file_sequence").alias("sequence_no"),
        F.col("catalog_priority").alias("priority"),
        "size_bytes",
        "mtime_ns",
        "sha256",
        "page_count",
        F.when(F.col("readable"), status).otherwise(schema.UNREADABLE).alias("parse_status"),
        F.lit(True).alias("is_present"),
        F.coalesce("p_first_seen_at", at).alias("first_seen_at"),
        at.alias("last_seen_at"),
        "last_hashed_at",
        "change_kind",
        *[BEFORE + n for n in _CARRIED],
    )


def _fresh(changes: DataFrame, probe: DataFrame, at: Column) -> DataFrame:
    """New and changed files with what the probe found; a file it lacks is unreadable."""
    found = probe.select("relative_path", "sha256", "page_count", "readable")
    rows = changes.filter(F.col("change_kind").isin("NEW", "CHANGED")).join(found, "relative_path", "left")
    return rows.withColumns({"readable": F.coalesce("readable", F.lit(False)), "last_hashed_at": at})


def _unchanged(changes: DataFrame) -> DataFrame:
    """Unchanged files keep digest, page count, hash time and an unreadable mark."""
    return changes.filter("change_kind = 'UNCHANGED'").withColumns(
        {
            "sha256": F.col("p_sha256"),
            "page_count": F.col("p_page_count"),
            "readable": F.col("p_parse_status") != schema.UNREADABLE,
            "last_hashed_at": F.col("p_last_hashed_at"),
        }
    )


def _gone(changes: DataFrame, touched: DataFrame, at: Column) -> DataFrame:
    """Stored documents that are not listed; those of touched cases become absent."""
    marked = touched.select("case_key", F.lit(True).alias("_touched"))
    rows = changes.filter("change_kind = 'GONE'").join(marked, "case_key", "left")
    stored = {n: F.col(BEFORE + n) for n in _CARRIED}
    stored["is_present"] = F.col("p_is_present") & F.col("_touched").isNull()
    stored["last_seen_at"] = F.when(F.col("_touched"), at).otherwise(F.col("p_last_seen_at"))
    return rows.select(
        "case_key", "relative_path", *[c.alias(n) for n, c in stored.items()], "change_kind", *[BEFORE + n for n in _CARRIED]
    )


def moved_documents(
    changes: DataFrame, probe: DataFrame, catalog: DataFrame, touched: DataFrame, at: Column, unchanged: bool = False
) -> DataFrame:
    """Documents after the scan next to their stored values (``p_...``), without the unchanged ones.

    Unchanged files are only of interest here (``unchanged``) where the catalog's codes have changed: their names are
    then judged anew.
    """
    listed = _fresh(changes, probe, at)
    if unchanged:
        listed = listed.unionByName(_unchanged(changes))
    return _present(listed, catalog, at).unionByName(_gone(changes, touched, at))


def upsert_documents(
    changes: DataFrame, probe: DataFrame, catalog: DataFrame, touched: DataFrame, at: Column
) -> DataFrame:
    """The next document snapshot from a change set, which is read once for each kind of change: keep it first.

    ``probe`` holds digest, page count and readability of the new and changed files, ``touched`` the cases whose
    unlisted documents become absent.
    """
    return schema.conform(moved_documents(changes, probe, catalog, touched, at, unchanged=True), "documents")


#: Columns next to those of the case table that a scan counts by.
CASE_MARKS = ("is_listed", "is_new")


def upsert_cases(prior: DataFrame, folders: DataFrame, at: Column) -> DataFrame:
    """New cases start unprocessed; known ones get names and seen times refreshed.

    ``is_listed`` and ``is_new`` say which rows have a folder and which were not stored before.
    """
    found = names.with_folder_parts(folders).withColumn("at", at).alias("f")
    refreshed = ("folder_path", "folder_name", *names.FOLDER_COLUMNS)
    counters = ("document_count", "warning_count", "missing_priority1_count", "type_count", "missing_type_count")
    kept = ("manual_status", "completed_at", "reviewed_by", "note")
    joined = prior.withColumn("known", F.lit(True)).alias("p").join(found, "case_key", "full_outer")
    return schema.conform(
        joined.selectExpr(
            "case_key",
            *[f"case when f.folder_name is not null then f.{n} else p.{n} end as {n}" for n in refreshed],
            f"coalesce(p.auto_status, '{schema.UNPROCESSED}') as auto_status",
            f"coalesce(p.effective_status, '{schema.UNPROCESSED}') as effective_status",
            "coalesce(p.progress_percent, 0D) as progress_percent",
            *[f"coalesce(p.{n}, 0L) as {n}" for n in counters],
            "f.folder_name is not null or p.is_present as is_present",
            "coalesce(p.first_seen_at, f.at) as first_seen_at",
            "coalesce(f.at, p.last_seen_at) as last_seen_at",
            "coalesce(f.at, p.last_scanned_at) as last_scanned_at",
            *[f"p.{n}" for n in kept],
            "f.folder_name is not null as is_listed",
            "p.known is null as is_new",
        ),
        "cases",
        CASE_MARKS,
    )


def tombstone_cases(cases: DataFrame, folders: DataFrame, at: Column) -> DataFrame:
    """Mark present cases without a folder as absent (full scans only)."""
    flagged = cases.join(folders.select("case_key", F.lit(True).alias("_listed")), "case_key", "left")
    lost = F.col("is_present") & F.col("_listed").isNull()
    return schema.conform(
        flagged.withColumns(
            {
                "last_scanned_at": F.when(lost, at).otherwise(F.col("last_scanned_at")),
                "is_present": F.col("is_present") & ~lost,
            }
        ),
        "cases",
        [n for n in CASE_MARKS if n in cases.columns],
    )


def touched_cases(prior_cases: DataFrame, folders: DataFrame, full: bool) -> DataFrame:
    """Cases whose unlisted documents become absent: the scanned ones and, in a full scan,
    those that were present before and have lost their folder."""
    scanned = folders.select("case_key")
    if not full:
        return scanned
    return scanned.union(prior_cases.filter("is_present").select("case_key")).distinct()


def file_counters() -> dict[str, Column]:
    """Counters over a change set. Every file seen before counts as updated, changed or not."""
    kind = F.col("change_kind")
    return {
        "files_seen": F.count_if(kind != "GONE"),
        "docs_created": F.count_if(kind == "NEW"),
        "docs_updated": F.count_if(kind.isin("UNCHANGED", "CHANGED")),
    }


def case_counters() -> dict[str, Column]:
    """Counters over the case snapshot of a scan, with its marks."""
    return {
        "folders_seen": F.count_if("is_listed"),
        "cases_created": F.count_if(F.col("is_listed") & F.col("is_new")),
        "cases_updated": F.count_if(F.col("is_listed") & ~F.col("is_new")),
    }


def warning_counters() -> dict[str, Column]:
    return {"warnings_created": F.count_if("is_new")}


class Counted:
    """Counts rows while they are written: each set of counters rides on the job that writes its table."""

    def __init__(self):
        self._watched: list[Observation] = []

    def watch(self, df: DataFrame, counters: dict[str, Column]) -> DataFrame:
        watched = Observation()
        self._watched.append(watched)
        return df.observe(watched, *[c.alias(n) for n, c in counters.items()])

    def values(self) -> dict[str, int]:
        """All counters, once the tables are written."""
        return {name: int(n or 0) for watched in self._watched for name, n in watched.get.items()}
