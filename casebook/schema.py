"""Stored codes, table schemas and schema upgrade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The stored codes of the data model.
CHECKLIST_STATUSES = ("CO_TAI_LIEU", "KHONG_PHAT_SINH", "CHUA_XAC_DINH", "CAN_BO_SUNG")
CHECKLIST_DONE = ("CO_TAI_LIEU", "KHONG_PHAT_SINH")
CASE_STATUSES = ("CHUA_XU_LY", "DANG_SO_HOA", "CHO_KIEM_TRA", "CAN_BO_SUNG", "HOAN_THANH")
REVIEW_WARNING_TYPES = ("REVIEW_PENDING", "CAN_XAC_MINH")
DEFAULT_APPLICABILITY = "CHUA_XAC_DINH"
DEFAULT_PRIORITY = 3
CATALOG_SIZE = 104

# Upper bound on catalog rows. The contract asks for exactly CATALOG_SIZE codes
# per version; retired codes stay in the table, so the bound leaves room for them.
MAX_CATALOG_ROWS = 10_000

PRESENT = "CO_TAI_LIEU"
MISSING = "CAN_BO_SUNG"
COMPLETE = "HOAN_THANH"
UNPROCESSED = "CHUA_XU_LY"
UNREADABLE = "FILE_KHONG_DOC_DUOC"


_CASES = """
    case_key string, folder_path string, folder_name string,
    m1 string, m2 string, m3 string, m4 string, m5 string,
    citizen_id string, person_name_raw string, person_name_display string, unit_code string,
    auto_status string, manual_status string, effective_status string, progress_percent double,
    document_count bigint, warning_count bigint, missing_priority1_count bigint,
    type_count bigint, missing_type_count bigint, is_present boolean,
    first_seen_at timestamp, last_seen_at timestamp, last_scanned_at timestamp,
    completed_at timestamp, reviewed_by string, note string
"""
_DOCUMENTS = """
    case_key string, relative_path string, filename string, taxonomy_code string,
    taxonomy_name string, sequence_no bigint, priority int, size_bytes bigint, mtime_ns bigint,
    sha256 string, page_count int, parse_status string, is_present boolean,
    first_seen_at timestamp, last_seen_at timestamp, last_hashed_at timestamp
"""
_CATALOG = """
    code string, name string, filename_base string, priority int, active boolean,
    default_applicability string
"""
# Present documents of a case by type (null: none valid) and hash time: what the recompute needs of them.
_COUNTS = "case_key string, code string, last_hashed_at timestamp, n bigint"
_OVERRIDES = "case_key string, taxonomy_code string, status string, note string, updated_at timestamp"
_WARNINGS = """
    case_key string, relative_path string, warning_type string, severity string, message string,
    active boolean, fingerprint string, created_at timestamp, updated_at timestamp
"""
_HISTORY = """
    case_key string, event_type string, from_status string, to_status string, detail string,
    created_at timestamp, seq bigint
"""
_RUNS = """
    run_id bigint, started_at timestamp, ended_at timestamp, status string,
    folders_seen bigint, files_seen bigint, cases_created bigint, cases_updated bigint,
    docs_created bigint, docs_updated bigint, warnings_created bigint, errors bigint,
    duration_ms bigint, summary_json string
"""
_IMPORTS = """
    case_key string, token string, filename string, type_id string, document_date string,
    note string, source_files array<string>, source_sha256 map<string-string>, created_at timestamp
"""


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string-string>": T.MapType(T.StringType(), T.StringType()),
}


def _columns(text: str, **nested: T.StructType) -> T.StructType:
    """A schema from ``name type`` pairs; ``nested`` adds arrays of structs."""
    flat = [T.StructField(n, _TYPES[t]) for n, t in (pair.split() for pair in text.split(","))]
    return T.StructType(flat + [T.StructField(n, T.ArrayType(s)) for n, s in nested.items()])


TABLES: dict[str, T.StructType] = {
    "cases": _columns(_CASES),
    "documents": _columns(_DOCUMENTS),
    "document_counts": _columns(_COUNTS),
    "catalog": _columns(_CATALOG),
    "checklist_overrides": _columns(_OVERRIDES),
    "warnings": _columns(_WARNINGS),
    "case_history": _columns(_HISTORY),
    "scan_runs": _columns(_RUNS),
    "import_events": _columns(_IMPORTS),
}

LISTING = _columns("relative_path string, case_key string, size_bytes bigint, mtime_ns bigint")
FOLDERS = _columns("case_key string, folder_path string, folder_name string")
PROBE = _columns("relative_path string, sha256 string, page_count int, readable boolean")
EVIDENCE = _columns("case_key string, type_id string")
ACTIONS = _columns(
    "case_key string, action string, code string, status string, note string, reviewed_by string, "
    "ts timestamp, seq bigint"
)
MANIFEST = _columns(
    "case_id string",
    sources=_columns("name string, stored string, sha256 string"),
    pages=_columns(
        "page_id string, source_name string, source_path string, source_page int, preview_name string"
    ),
)
REQUESTS = _columns(
    "token string, case_key string, type_id string, document_date string, note string, requested_at timestamp",
    pages=_columns("id string, rotation int"),
)

# Values for columns that older tables lack.
ADDED_DEFAULTS: dict[str, dict[str, object]] = {
    "cases": {"type_count": 0, "missing_type_count": 0},
}


def conform(df: DataFrame, table: str, more: Sequence[str] = ()) -> DataFrame:
    """Bring ``df`` to the current schema of ``table``; absent columns get their default. Columns named in ``more`` stay."""
    defaults = ADDED_DEFAULTS.get(table, {})
    present = {f.name: f.dataType for f in df.schema.fields}

    def expression(field: T.StructField) -> str:
        if present.get(field.name) == field.dataType:
            return f"`{field.name}`"
        value = f"`{field.name}`" if field.name in present else str(defaults.get(field.name, "null"))
        return f"cast({value} as {field.dataType.simpleString()}) as `{field.name}`"

    return df.selectExpr(*[expression(f) for f in TABLES[table].fields], *more)


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
