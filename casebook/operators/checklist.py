"""Evidence per case and type, the checklist, and its per-case roll-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions.text import percent, ui_label
from casebook.sources.catalog import active_types


def is_valid_document() -> Column:
    return F.col("is_present") & (F.col("parse_status") == "OK") & F.col("taxonomy_code").isNotNull()


def document_evidence(documents: DataFrame) -> DataFrame:
    """Valid documents per case and type."""
    return (
        documents.filter(is_valid_document())
        .groupBy("case_key", F.col("taxonomy_code").alias("code"))
        .agg(F.count("*").alias("n"))
    )


def external_evidence(evidence: DataFrame) -> DataFrame:
    """Externally reported documents per case and type."""
    return (
        evidence.filter("type_id is not null")
        .groupBy("case_key", F.col("type_id").alias("code"))
        .agg(F.count("*").alias("n"))
    )


def type_facts(
    documents: DataFrame, overrides: DataFrame, evidence: DataFrame | None = None
) -> DataFrame:
    """Everything known about (case, type) pairs, from the documents themselves."""
    valid = is_valid_document()
    counted = documents.filter("is_present").select(
        "case_key",
        F.when(valid, F.col("taxonomy_code")).alias("code"),
        F.when(valid, 1).otherwise(0).cast("bigint").alias("file"),
        "last_hashed_at",
    )
    return _facts(counted, overrides, evidence)


def facts_from_counts(counts: DataFrame, overrides: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """The same from document counts (``operators.deltas``), without reading a document."""
    counted = counts.select(
        "case_key", "code", F.when(F.col("code").isNotNull(), F.col("n")).otherwise(0).alias("file"), "last_hashed_at"
    )
    return _facts(counted, overrides, evidence)


def _facts(counted: DataFrame, overrides: DataFrame, evidence: DataFrame | None) -> DataFrame:
    """Document counts, evidence and overrides per (case, type), in one shuffle.

    The three inputs are stacked and aggregated once, instead of being aggregated and
    outer-joined one by one; only pairs with some fact appear. ``n`` is the larger of the two
    evidence counts. ``last_hashed_at`` is the newest hash time of present documents; files
    without a valid type report it under a null code. Override statuses travel as numbers:
    aggregates over fixed-width values are hashed, those over text would sort every row first.
    """
    none = F.lit(None)
    stacked = counted.select(
        "case_key", "code", "file", F.lit(0).alias("external"), none.cast("int").alias("override"), "last_hashed_at"
    )
    if evidence is not None:
        # documents as reported, or their counts (``external_evidence``)
        as_counts = "type_id" not in evidence.columns
        stacked = stacked.unionByName(
            (evidence if as_counts else evidence.filter("type_id is not null")).select(
                "case_key",
                F.col("code" if as_counts else "type_id").alias("code"),
                F.lit(0).alias("file"),
                F.col("n").alias("external") if as_counts else F.lit(1).alias("external"),
                none.cast("int").alias("override"),
                none.cast("timestamp").alias("last_hashed_at"),
            )
        )
    stacked = stacked.unionByName(
        overrides.select(
            "case_key",
            F.col("taxonomy_code").alias("code"),
            F.lit(0).alias("file"),
            F.lit(0).alias("external"),
            _status_number(F.col("status")).alias("override"),
            none.cast("timestamp").alias("last_hashed_at"),
        )
    )
    statuses = F.array(*[F.lit(s) for s in schema.CHECKLIST_STATUSES])
    return (
        stacked.groupBy("case_key", "code")
        .agg(
            F.greatest(F.sum("file"), F.sum("external")).alias("n"),
            F.max("override").alias("_override"),
            F.max("last_hashed_at").alias("last_hashed_at"),
        )
        .select(
            "case_key",
            "code",
            "n",
            F.when(F.col("_override").isNotNull(), F.get(statuses, F.col("_override") - 1)).alias("override_status"),
            "last_hashed_at",
        )
    )


def _status_number(status: Column) -> Column:
    """Position of a checklist status, from 1; other values are an error."""
    number = F.array_position(F.array(*[F.lit(s) for s in schema.CHECKLIST_STATUSES]), status)
    return F.when(number == 0, F.raise_error(F.concat(F.lit("unknown checklist status: "), status)).cast("int")).otherwise(
        number.cast("int")
    )


def merge_evidence(files: DataFrame, external: DataFrame) -> DataFrame:
    """Both evidence counts per (case, type), full outer; the larger one counts."""
    f, e = files.withColumnRenamed("n", "f"), external.withColumnRenamed("n", "e")
    return f.join(e, ["case_key", "code"], "full_outer").select(
        "case_key",
        "code",
        F.greatest(F.coalesce("f", F.lit(0)), F.coalesce("e", F.lit(0))).cast("bigint").alias("n"),
    )


def item_status(n: Column, override: Column, default: Column) -> Column:
    """Evidence beats an override, an override beats the default."""
    return F.when(n > 0, schema.PRESENT).otherwise(F.coalesce(override, default))


def checklist(cases: DataFrame, facts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every case with every active type.

    A case carries its few facts as a map (at most one entry per catalog code) next to the
    constant list of types; the types are unnested from that list in place, so the
    cases x types rows are produced at the end of the plan and never shuffled.
    """
    types = active_types(catalog)
    per_case = (
        facts.join(F.broadcast(types.select("code")), "code", "left_semi")
        .groupBy("case_key")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("code", F.struct("n", "override_status").alias("fact")))
            ).alias("_facts")
        )
    )
    listed = types.agg(
        F.sort_array(F.collect_list(F.struct("priority", "code", "name", "weight", "default_status")))
    ).scalar()
    rows = (
        cases.select("case_key")
        .join(per_case, "case_key", "left")
        .withColumn("_types", listed)
        .select("case_key", "_facts", F.inline("_types"))
        .withColumn("_fact", F.try_element_at("_facts", "code"))
    )
    n = F.coalesce(F.col("_fact.n"), F.lit(0)).cast("bigint")
    return rows.select(
        "case_key",
        "code",
        "name",
        "priority",
        item_status(n, F.col("_fact.override_status"), F.col("default_status")).alias("status"),
        n.alias("document_count"),
        F.col("_fact.override_status").isNotNull().alias("has_override"),
    )


def _shown(status: Column) -> Column:
    """What a checklist row shows up to its count, in lower case."""
    return F.lower(F.concat_ws(" ", "code", "name", ui_label(status)))


def _shown_priority() -> Column:
    return F.lower(F.when(F.col("priority") == 1, "ƯT1").otherwise("ƯT2"))


def _contains(before: Column, count: Column, after: Column, query: str) -> Column:
    """Whether a shown row contains the query. Blanks stand around the count, and lower case does not look past a blank."""
    return F.contains(F.concat_ws(" ", before, count.cast("string"), after), F.lower(F.lit(query.strip())))


def find_in_checklist(rows: DataFrame, query: str) -> DataFrame:
    """Checklist rows whose shown text contains the query, ignoring case."""
    return rows.filter(_contains(_shown(F.col("status")), F.col("document_count"), _shown_priority(), query))


def search_checklist(cases: DataFrame, facts: DataFrame, catalog: DataFrame, query: str) -> DataFrame:
    """The rows of ``find_in_checklist`` over the whole checklist, without building the cases x types rows.

    A type nobody has said anything about shows the same text in every case, so whether that contains the query is found
    out once per type. Texts of facts are put together from parts made once per type and status. Each case then unnests
    its matching facts and the matching types without a fact.
    """
    statuses = {s: f"_shown_{n}" for n, s in enumerate(schema.CHECKLIST_STATUSES)}
    zero = F.lit(0).cast("bigint")
    types = active_types(catalog).withColumns(
        {
            "_default": _shown(F.col("default_status")),
            "_priority": _shown_priority(),
            **{column: _shown(F.lit(s)) for s, column in statuses.items()},
        }
    )
    types = types.withColumn("_by_default", _contains(F.col("_default"), zero, F.col("_priority"), query))
    n, override = F.coalesce(F.col("n"), F.lit(0)).cast("bigint"), F.col("override_status")
    status = item_status(n, override, F.col("default_status"))
    text = F.when(n > 0, F.col(statuses[schema.PRESENT]))
    for s, column in statuses.items():
        text = text.when(override == s, F.col(column))

    def row(status: Column, count: Column, has_override: Column, of: Callable[[str], Column] = F.col) -> Column:
        return F.struct(
            of("code").alias("code"),
            of("name").alias("name"),
            of("priority").alias("priority"),
            status.alias("status"),
            count.alias("document_count"),
            has_override.alias("has_override"),
        )

    said = (
        facts.join(F.broadcast(types), "code")
        .withColumn("_found", _contains(text.otherwise(F.col("_default")), n, F.col("_priority"), query))
        .filter("_found or _by_default")
        .groupBy("case_key")
        .agg(
            F.collect_list(F.when(F.col("_by_default"), F.col("code"))).alias("_said"),
            F.collect_list(F.when(F.col("_found"), row(status, n, override.isNotNull()))).alias("_rows"),
        )
    )
    by_default = types.filter("_by_default").agg(
        F.sort_array(F.collect_list(F.struct("priority", "code", "name", "default_status")))
    ).scalar()
    unsaid = F.transform(
        F.filter("_types", lambda t: ~F.coalesce(F.array_contains("_said", t["code"]), F.lit(False))),
        lambda t: row(t["default_status"], zero, F.lit(False), lambda name: t[name]),
    )
    joined = cases.select("case_key").join(said, "case_key", "left").withColumn("_types", by_default)
    found = F.when(F.col("_rows").isNull(), unsaid).otherwise(F.concat("_rows", unsaid))
    return joined.select("case_key", F.inline(found))


def find_types(catalog: DataFrame, query: str) -> DataFrame:
    """Catalog rows whose code and name contain the query, ignoring case."""
    return catalog.filter(
        F.contains(F.lower(F.concat_ws(" ", "code", "name")), F.lower(F.lit(query.strip())))
    )


def rollup(cases: DataFrame, facts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Progress and counters per case, without building the cases x types rows.

    A type nobody has said anything about contributes its default, which is the same for
    every case. So each case starts from the catalog's totals and only its own facts are
    added as differences to them.
    """
    types = active_types(catalog)
    done = lambda status: status.isin(*schema.CHECKLIST_DONE)
    one = lambda condition: F.when(condition, 1).otherwise(0)

    def counters(status: Column, weight: Column, priority: Column) -> dict[str, Column]:
        return {
            "done_weight": F.when(done(status), weight).otherwise(0),
            "type_count": one(status == schema.PRESENT),
            "missing_type_count": one(status == schema.MISSING),
            "missing_priority1_count": one((status == schema.MISSING) & (priority == 1)),
        }

    default = counters(F.col("default_status"), F.col("weight"), F.col("priority"))
    base = types.agg(
        F.struct(
            F.coalesce(F.sum("weight"), F.lit(0)).alias("weight"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in default.items()],
        )
    ).scalar()

    status = item_status(F.col("n"), F.col("override_status"), F.col("default_status"))
    actual = counters(status, F.col("weight"), F.col("priority"))
    changes = (
        facts.join(F.broadcast(types.drop("name")), "code", "left")
        .withColumn("_typed", F.col("weight").isNotNull())
        .groupBy("case_key")
        .agg(
            F.sum(F.when(F.col("_typed"), F.col("n"))).alias("document_count"),
            *[F.sum(F.when(F.col("_typed"), actual[n] - default[n])).alias(f"_{n}") for n in actual],
            F.max("last_hashed_at").alias("last_hashed_at"),
        )
    )
    joined = cases.join(changes, "case_key", "left").withColumn("_base", base)

    def total(name: str) -> Column:
        return (F.col(f"_base.{name}") + F.coalesce(F.col(f"_{name}"), F.lit(0))).cast("bigint")

    return joined.select(
        *cases.columns,
        percent(total("done_weight"), F.col("_base.weight")).alias("progress_percent"),
        F.coalesce("document_count", F.lit(0)).cast("bigint").alias("document_count"),
        total("type_count").alias("type_count"),
        total("missing_type_count").alias("missing_type_count"),
        total("missing_priority1_count").alias("missing_priority1_count"),
        "last_hashed_at",
    )
