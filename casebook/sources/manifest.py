"""Upload session manifests and external evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions.text import allowed_upload


def parse_manifests(texts: DataFrame) -> DataFrame:
    """Manifests from rows of ``token`` and ``text``: ``token``, ``case_key``, ``sources``, ``pages`` and, where a session can't be
    used, a ``reason`` and the ``broken`` text. ``pages`` is null then, which rejects requests for that session."""
    parsed = texts.withColumns(
        {"_any": F.try_parse_json("text"), "_manifest": F.from_json("text", schema.MANIFEST, {"mode": "PERMISSIVE"})}
    )
    kind = F.schema_of_variant("_any")
    pages = F.schema_of_variant(F.try_variant_get("_any", "$.pages", "variant"))
    reason = (
        F.when(F.col("_any").isNull(), "not JSON")
        .when(~kind.startswith("OBJECT"), "not an object")
        .when(~F.coalesce(pages.startswith("ARRAY"), F.lit(False)) | F.col("_manifest.pages").isNull(), "no list of pages")
    )
    return parsed.withColumn("reason", reason).select(
        "token",
        F.col("_manifest.case_id").alias("case_key"),
        "_manifest.sources",
        F.when(F.col("reason").isNull(), F.col("_manifest.pages")).alias("pages"),
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("text")).alias("broken"),
    )


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifests of upload sessions, one per ``<token>/manifest.json`` below ``path``; the token is the name of the session's
    folder. See ``parse_manifests``."""
    raw = spark.read.text(f"{path.rstrip('/')}/*/manifest.json", wholetext=True)
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return parse_manifests(raw.select(folder.alias("token"), F.col("value").alias("text")))


def manifest_pages(manifests: DataFrame) -> DataFrame:
    """One row per offered page, in page order."""
    return manifests.select("token", "case_key", F.posexplode("pages").alias("position", "page")).select(
        "token", "case_key", "position", "page.*"
    )


def manifest_sources(manifests: DataFrame) -> DataFrame:
    return manifests.select("token", F.posexplode("sources").alias("position", "source")).select(
        "token", "position", "source.*", allowed_upload(F.col("source.name")).alias("allowed")
    )


def evidence_or_empty(spark: SparkSession, evidence: DataFrame | None) -> DataFrame:
    """External evidence is optional; without it there is none."""
    return schema.empty(spark, schema.EVIDENCE) if evidence is None else evidence
