"""Data-quality warning rules and the life cycle of stored warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions import names
from casebook.functions.text import fingerprint
from casebook.operators.spread import count_in_group
from casebook.sources.catalog import with_catalog

# Message texts; %s is the folder name, file name or code.
BAD_FOLDER_MESSAGE = "Tên thư mục không theo mẫu: %s"
BAD_FILE_MESSAGE = "Tên file không theo mẫu: %s"
UNKNOWN_TYPE_MESSAGE = "Mã tài liệu ngoài taxonomy: %s"
NOT_CANONICAL_MESSAGE = "Tên file khác tên chuẩn catalog: %s"
DUPLICATE_MESSAGE = "Có file trùng SHA-256 trong cùng hồ sơ."
UNREADABLE_MESSAGE = "Không đọc được PDF."
CHANGED_MESSAGE = "File nguồn thay đổi sau khi hồ sơ được đánh dấu hoàn thành."


def _message(template: str, value: Column | None = None) -> Column:
    if value is None:
        return F.lit(template)
    return F.concat(F.lit(template.removesuffix("%s")), value)


def duplicate_groups(documents: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Digests occurring more than once per key, with their number ``n``."""
    return (
        documents.filter(F.col(digest).isNotNull())
        .groupBy(*keys, digest)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )


def with_duplicate_count(documents: DataFrame, keys: list[str], digest: str, row_id: str) -> DataFrame:
    """Add ``copies``: how many rows of the same key share the digest (1 without a digest)."""
    # Rows without a digest get a group each.
    own = F.when(F.col(digest).isNull(), F.col(row_id).cast("string"))
    grouped = documents.withColumn("_group", F.coalesce(digest, own))
    return count_in_group(grouped, [*keys, "_group"], "copies").drop("_group")


def folder_warnings(folders: DataFrame) -> DataFrame:
    """Folders whose name does not parse."""
    bad = names.with_folder_parts(folders).filter(~F.col("folder_valid"))
    return _as_candidates(
        bad.select(
            "case_key",
            F.lit(None).cast("string").alias("relative_path"),
            F.lit("SAI_TEN_THU_MUC").alias("warning_type"),
            F.lit("WARNING").alias("severity"),
            _message(BAD_FOLDER_MESSAGE, F.col("folder_name")).alias("message"),
        )
    )


def document_warnings(documents: DataFrame, catalog: DataFrame) -> DataFrame:
    """All per-document rules in one pass over the present documents.

    The name rules look at the file name alone, so an unreadable and badly named file gives two.
    """
    present = documents.filter("is_present").select(
        "case_key", "relative_path", "filename", "sha256", "parse_status"
    )
    counted = with_duplicate_count(present, ["case_key"], "sha256", "relative_path")
    parsed = with_catalog(names.with_file_parts(counted), catalog, "file_code").withColumn(
        "_name_status", names.name_status(F.col("file_code"), F.col("file_slug"), F.col("catalog_known"))
    )

    def rule(condition: Column, kind: str, severity: str, message: Column) -> Column:
        return F.when(
            condition,
            F.struct(
                F.lit(kind).alias("warning_type"),
                F.lit(severity).alias("severity"),
                message.alias("message"),
            ),
        )

    status = F.col("_name_status")
    foreign = ~names.is_canonical(F.col("file_slug"), F.col("catalog_slug"))
    raised = F.array(
        rule(status == "MALFORMED_NAME", "SAI_TEN_FILE", "WARNING", _message(BAD_FILE_MESSAGE, F.col("filename"))),
        rule(
            status == "FILE_NGOAI_TAXONOMY",
            "FILE_NGOAI_TAXONOMY",
            "WARNING",
            _message(UNKNOWN_TYPE_MESSAGE, F.col("file_code")),
        ),
        rule(
            (status == "OK") & foreign,
            "SAI_TEN_FILE",
            "WARNING",
            _message(NOT_CANONICAL_MESSAGE, F.col("filename")),
        ),
        rule(F.col("copies") > 1, "TRUNG_TAI_LIEU", "WARNING", _message(DUPLICATE_MESSAGE)),
        rule(
            F.col("parse_status") == schema.UNREADABLE,
            "FILE_KHONG_DOC_DUOC",
            "ERROR",
            _message(UNREADABLE_MESSAGE),
        ),
    )
    return _as_candidates(
        parsed.select("case_key", "relative_path", F.explode(F.array_compact(raised)).alias("w")).select(
            "case_key", "relative_path", "w.*"
        )
    )


def change_warnings(cases: DataFrame) -> DataFrame:
    """Case-level warnings for cases changed after completion."""
    return _as_candidates(
        cases.select(
            "case_key",
            F.lit(None).cast("string").alias("relative_path"),
            F.lit("CHANGED_AFTER_COMPLETION").alias("warning_type"),
            F.lit("WARNING").alias("severity"),
            _message(CHANGED_MESSAGE).alias("message"),
        ),
        subject=F.lit("case"),
    )


def _as_candidates(df: DataFrame, subject: Column | None = None) -> DataFrame:
    who = F.col("relative_path") if subject is None else subject
    return df.withColumn(
        "fingerprint", fingerprint(F.col("case_key"), who, F.col("warning_type"), F.col("message"))
    )


def scan_warnings(folders: DataFrame, documents: DataFrame, catalog: DataFrame) -> DataFrame:
    """Union of all rule outputs for scanned folders and their documents."""
    return folder_warnings(folders).unionByName(document_warnings(documents, catalog))


def merge_warnings(
    prior: DataFrame, candidates: DataFrame, at: Column, scanned: DataFrame | None = None
) -> DataFrame:
    """The next warning snapshot.

    Warnings of scanned cases go inactive unless raised again; others keep their state.
    Candidates activate the stored warning of the same fingerprint or become new ones.
    ``is_new`` marks the latter, ``was_active`` says how they were stored.
    """
    if scanned is None:
        stored = prior.withColumn("_scanned", F.lit(False))
    else:
        marked = scanned.select("case_key", F.lit(True).alias("_scanned"))
        stored = prior.join(marked, "case_key", "left").withColumn("_scanned", F.coalesce("_scanned", F.lit(False)))
    p, c = stored.alias("p"), candidates.alias("c")
    raised = F.col("c.case_key").isNotNull()
    merged = p.join(c, "fingerprint", "full_outer")

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"p.{name}"), F.col(f"c.{name}")).alias(name)

    return merged.select(
        either("case_key"),
        either("relative_path"),
        either("warning_type"),
        either("severity"),
        either("message"),
        (raised | (F.col("p.active") & ~F.col("_scanned"))).alias("active"),
        "fingerprint",
        F.coalesce("p.created_at", at).alias("created_at"),
        F.when(raised | F.col("_scanned"), at).otherwise(F.col("p.updated_at")).alias("updated_at"),
        F.col("p.case_key").isNull().alias("is_new"),
        F.coalesce("p.active", F.lit(False)).alias("was_active"),
    )


def active_per_case(warnings: DataFrame) -> DataFrame:
    """Per case: active warnings, whether a review is pending, whether the change warning is up."""
    active = F.col("active")
    changed = (F.col("warning_type") == "CHANGED_AFTER_COMPLETION") & (F.col("message") == CHANGED_MESSAGE)
    return warnings.groupBy("case_key").agg(
        F.count_if(active).alias("active_warnings"),
        F.bool_or(active & F.col("warning_type").isin(*schema.REVIEW_WARNING_TYPES)).alias("review_pending"),
        F.bool_or(active & changed & F.col("relative_path").isNull()).alias("change_flagged"),
    )
