"""The document-type catalog: reading, checking, normalizing, seeding, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook import schema
from casebook.functions.names import catalog_slug
from casebook.functions.text import priority_weight

_ENTRY = "id string, name_vi string, filename_base string, priority string"


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed entry (``pos`` keeps the file order); non-object entries are skipped."""
    raw = spark.read.schema("document_types string").json(path, multiLine=True)
    if raw.filter("document_types is null or document_types not like '[%'").limit(1).count():
        raise ValueError("the catalog file has no document_types list")
    items = raw.select(F.posexplode(F.from_json("document_types", T.ArrayType(T.StringType()))).alias("pos", "item"))
    return items.filter(F.col("item").startswith("{")).select(
        F.col("pos").cast("bigint").alias("pos"), F.from_json("item", _ENTRY).alias("e")
    ).select("pos", "e.*")


def normalize(entries: DataFrame) -> DataFrame:
    """Catalog table rows from raw entries; the last entry of a code wins."""
    last = F.max_by(F.struct("name_vi", "filename_base", "priority"), "pos").alias("e")
    return (
        entries.groupBy(F.col("id").alias("code"))
        .agg(last)
        .select(
            "code",
            F.col("e.name_vi").alias("name"),
            F.col("e.filename_base").alias("filename_base"),
            priority_or_default(F.col("e.priority").cast("int")).alias("priority"),
            F.lit(True).alias("active"),
            F.lit(schema.DEFAULT_APPLICABILITY).alias("default_applicability"),
        )
    )


def priority_or_default(priority: Column) -> Column:
    return F.when(priority.isin(1, 2, 3), priority).otherwise(schema.DEFAULT_PRIORITY)


def check_entries(entries: DataFrame, expected: int = schema.CATALOG_SIZE) -> None:
    """Raise unless every entry is complete and there are exactly ``expected`` codes."""

    def blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    found = entries.agg(
        F.count_if(blank("id") | blank("name_vi") | blank("filename_base")).alias("incomplete"),
        F.count_distinct("id").alias("codes"),
    ).first()
    if found["incomplete"]:
        raise ValueError(f"{found['incomplete']} catalog entries lack id, name_vi or filename_base")
    if found["codes"] != expected:
        raise ValueError(f"the catalog must list exactly {expected} codes, found {found['codes']}")


def load_catalog(spark: SparkSession, path: str, expected: int = schema.CATALOG_SIZE) -> DataFrame:
    entries = read_entries(spark, path)
    check_entries(entries, expected)
    return pin(normalize(entries))


def seed(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """Refresh name, priority and activity; keep stored defaults and codes that left."""
    old, new = stored.alias("o"), loaded.alias("n")

    def pick(name: str) -> Column:
        return F.coalesce(F.col(f"n.{name}"), F.col(f"o.{name}")).alias(name)

    return old.join(new, F.col("o.code") == F.col("n.code"), "full_outer").select(
        pick("code"),
        pick("name"),
        pick("filename_base"),
        pick("priority"),
        pick("active"),
        F.coalesce("o.default_applicability", "n.default_applicability").alias("default_applicability"),
    )


def pin(catalog: DataFrame) -> DataFrame:
    """Turn the catalog into a local relation after checking that it is small.

    Every later use is then a broadcast of known size. More rows than the bound mean that
    something other than a catalog was passed, which is an error rather than a slow path.
    """
    fields = [f.name for f in schema.TABLES["catalog"].fields]
    rows = catalog.select(*fields).limit(schema.MAX_CATALOG_ROWS + 1).toArrow()
    if rows.num_rows > schema.MAX_CATALOG_ROWS:
        raise ValueError(f"a catalog of more than {schema.MAX_CATALOG_ROWS} rows is not supported")
    return catalog.sparkSession.createDataFrame(rows)


def with_catalog(df: DataFrame, catalog: DataFrame, code: str) -> DataFrame:
    """Left join on the pinned catalog: adds ``catalog_name``, ``catalog_priority``,
    ``catalog_slug``, ``catalog_base`` and ``catalog_known``."""
    dim = F.broadcast(
        catalog.select(
            F.col("code").alias("_code"),
            F.col("name").alias("catalog_name"),
            F.col("priority").alias("catalog_priority"),
            catalog_slug(F.col("filename_base")).alias("catalog_slug"),
            F.col("filename_base").alias("catalog_base"),
        )
    )
    return (
        df.join(dim, F.col(code) == F.col("_code"), "left")
        .withColumn("catalog_known", F.col("_code").isNotNull())
        .drop("_code")
    )


def valid_codes(df: DataFrame, catalog: DataFrame, code: str) -> DataFrame:
    """Add ``code_valid``: in the catalog, or the literal ``UNKNOWN``."""
    known = with_catalog(df, catalog, code)
    return known.withColumn(
        "code_valid", F.coalesce(F.col("catalog_known") | (F.col(code) == "UNKNOWN"), F.lit(False))
    ).select(*df.columns, "code_valid")


def active_types(catalog: DataFrame) -> DataFrame:
    """The checklist skeleton of one case: code, name, priority, weight, default status."""
    return catalog.filter("active").select(
        "code",
        "name",
        "priority",
        priority_weight(F.col("priority")).alias("weight"),
        F.col("default_applicability").alias("default_status"),
    )


def same_codes(one: DataFrame, other: DataFrame) -> bool:
    """Whether two catalogs (small, see ``pin``) know the same codes."""
    marked = one.select("code", F.lit(1).alias("side")).unionByName(other.select("code", F.lit(2).alias("side")))
    sides = marked.distinct().groupBy("code").agg(F.count("*").alias("n"))
    return sides.filter("n < 2").isEmpty()
