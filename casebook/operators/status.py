"""Case recompute: counters, progress, workflow status and its transitions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schema
from casebook.operators.checklist import facts_from_counts, rollup, type_facts
from casebook.operators.diff import limit_to
from casebook.operators.warnings import active_per_case, change_warnings, merge_warnings


@dataclass(frozen=True)
class Recomputed:
    cases: DataFrame
    warnings: DataFrame
    transitions: DataFrame


def auto_status(documents: Column, review_pending: Column, missing: Column) -> Column:
    return (
        F.when(documents == 0, schema.UNPROCESSED)
        .when(review_pending, "DANG_SO_HOA")
        .when(missing > 0, schema.MISSING)
        .otherwise("CHO_KIEM_TRA")
    )


def changed_after_completion(cases: DataFrame, facts: DataFrame) -> DataFrame:
    """Completed cases with a present document hashed after the completion."""
    newest = facts.groupBy("case_key").agg(F.max("last_hashed_at").alias("_newest"))
    return (
        cases.filter("completed_at is not null")
        .join(newest, "case_key")
        .filter("_newest > completed_at")
        .select("case_key")
    )


def case_figures(
    cases: DataFrame,
    documents: DataFrame,
    catalog: DataFrame,
    overrides: DataFrame,
    warnings: DataFrame,
    evidence: DataFrame | None = None,
) -> DataFrame:
    """Fresh figures and statuses of the given cases, with what the recompute needs to know."""
    return figures_from_facts(cases, type_facts(documents, overrides, evidence), catalog, warnings)


def figures_from_facts(cases: DataFrame, facts: DataFrame, catalog: DataFrame, warnings: DataFrame) -> DataFrame:
    """Figures of the given cases from what is known per (case, type) and the warnings.

    One aggregate over documents, evidence and overrides and one over warnings, both joined to
    the cases at case grain. The change-after-completion warning is accounted for in
    ``warning_count`` before it is written: it adds one where it is due and not yet active.
    """
    slim = cases.select(
        "case_key", "manual_status", "effective_status", "completed_at", "last_scanned_at"
    ).withColumnRenamed("effective_status", "old_effective_status")
    figures = rollup(slim, facts, catalog).join(active_per_case(warnings), "case_key", "left")
    due = F.coalesce(F.col("last_hashed_at") > F.col("completed_at"), F.lit(False))
    flagged = F.coalesce("change_flagged", F.lit(False))
    auto = auto_status(
        F.col("document_count"),
        F.coalesce("review_pending", F.lit(False)),
        F.col("missing_type_count"),
    )
    return figures.withColumns(
        {
            "changed_after_completion": due,
            "warning_count": F.coalesce("active_warnings", F.lit(0)) + F.when(due & ~flagged, 1).otherwise(0),
            "auto_status": auto,
            "effective_status": F.coalesce("manual_status", auto),
        }
    ).select(
        "case_key",
        "auto_status",
        "manual_status",
        "effective_status",
        "old_effective_status",
        "progress_percent",
        "document_count",
        F.col("warning_count").cast("bigint").alias("warning_count"),
        "missing_priority1_count",
        "type_count",
        "missing_type_count",
        F.coalesce("review_pending", F.lit(False)).alias("review_pending"),
        "changed_after_completion",
    )


_FIGURES = (
    "auto_status",
    "effective_status",
    "progress_percent",
    "document_count",
    "warning_count",
    "missing_priority1_count",
    "type_count",
    "missing_type_count",
)


def with_figures(cases: DataFrame, figures: DataFrame, at: Column) -> DataFrame:
    """Write fresh figures into the case snapshot; cases without figures stay as they are."""
    f = figures.select("case_key", *[F.col(n).alias(f"_{n}") for n in _FIGURES])
    joined = cases.join(f, "case_key", "left")
    renewed = F.col("_auto_status").isNotNull()
    return schema.conform(
        joined.withColumns(
            {
                **{n: F.when(renewed, F.col(f"_{n}")).otherwise(F.col(n)) for n in _FIGURES},
                "last_scanned_at": F.when(renewed, F.coalesce("last_scanned_at", at)).otherwise(
                    F.col("last_scanned_at")
                ),
            }
        ),
        "cases",
    )


def status_transitions(figures: DataFrame, at: Column) -> DataFrame:
    """Audit rows for cases whose effective status changed in a recompute."""
    changed = figures.filter(~F.col("old_effective_status").eqNullSafe(F.col("effective_status")))
    return changed.select(
        "case_key",
        F.when(F.col("manual_status").isNull(), "AUTO_STATUS_CHANGED")
        .otherwise("MANUAL_STATUS_CHANGED")
        .alias("event_type"),
        F.col("old_effective_status").alias("from_status"),
        F.col("effective_status").alias("to_status"),
        F.lit("recompute").alias("detail"),
        at.alias("created_at"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def recompute(
    cases: DataFrame,
    documents: DataFrame,
    catalog: DataFrame,
    overrides: DataFrame,
    warnings: DataFrame,
    at: Column,
    evidence: DataFrame | None = None,
    scope: DataFrame | None = None,
    require_present: bool = True,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    counts: DataFrame | None = None,
) -> Recomputed:
    """Recompute all present cases, or those in ``scope``. After an action the case is
    recomputed whether it is present or not. All three results read the figures: ``keep``
    writes them once. With ``counts`` (see ``operators.deltas``) no document is read."""
    chosen = cases.filter("is_present") if require_present else cases
    # With a scope, only its rows are aggregated; without one nothing is filtered.
    reported = None if evidence is None else limit_to(evidence, scope)
    if counts is None:
        facts = type_facts(limit_to(documents, scope), limit_to(overrides, scope), reported)
    else:
        facts = facts_from_counts(limit_to(counts, scope), limit_to(overrides, scope), reported)
    figures = figures_from_facts(limit_to(chosen, scope), facts, catalog, limit_to(warnings, scope))
    if keep is not None:
        figures = keep(figures, "figures")
    raised = change_warnings(figures.filter("changed_after_completion"))
    return Recomputed(
        cases=with_figures(cases, figures, at),
        warnings=schema.conform(merge_warnings(warnings, raised, at), "warnings"),
        transitions=status_transitions(figures, at),
    )
