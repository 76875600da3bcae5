"""Batches of operator actions: checks, latest values, audit trail."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions.text import override_detail, reopen_detail
from casebook.operators.checklist import item_status, rollup
from casebook.operators.spread import prefix_fold
from casebook.operators.status import auto_status
from casebook.operators.warnings import active_per_case

OVERRIDE, MANUAL, COMPLETE_CASE, REOPEN, NOTE = "override", "manual_status", "complete", "reopen", "note"

Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Checked:
    accepted: DataFrame
    rejected: DataFrame


def _is(*kinds: str) -> Column:
    return F.col("action").isin(*kinds)


def rejection_reason(code_active: Column, case_known: Column) -> Column:
    """Why an action is refused; null if it is fine."""
    return (
        F.when(~F.coalesce(_is(OVERRIDE, MANUAL, COMPLETE_CASE, REOPEN, NOTE), F.lit(False)), "unknown action")
        .when(
            _is(OVERRIDE) & ~F.coalesce(F.col("status").isin(*schema.CHECKLIST_STATUSES), F.lit(False)),
            "invalid checklist status",
        )
        .when(_is(OVERRIDE) & ~code_active, "invalid type code")
        .when(
            _is(MANUAL)
            & ~F.coalesce(
                F.col("status").isin(*[s for s in schema.CASE_STATUSES if s != schema.COMPLETE]),
                F.lit(False),
            ),
            "invalid case status",
        )
        .when(~case_known, "unknown case")
        .when(F.col("ts").isNull(), "no action time")
    )


def check_actions(actions: DataFrame, cases: DataFrame, catalog: DataFrame) -> Checked:
    """Split actions into accepted ones and rejects with a ``reason``."""
    codes = F.broadcast(
        catalog.filter("active").select(F.col("code"), F.lit(True).alias("_code_active"))
    )
    known = cases.select("case_key", F.lit(True).alias("_known"))
    flagged = actions.join(codes, "code", "left").join(known, "case_key", "left")
    judged = flagged.withColumn(
        "reason",
        rejection_reason(
            F.coalesce("_code_active", F.lit(False)), F.coalesce("_known", F.lit(False))
        ),
    ).select(*actions.columns, "reason")
    return Checked(
        accepted=judged.filter("reason is null").drop("reason"),
        rejected=judged.filter("reason is not null"),
    )


def latest_overrides(accepted: DataFrame) -> DataFrame:
    """The last override per case and type."""
    last = F.max_by(F.struct("status", "note", "ts"), F.struct("ts", "seq")).alias("o")
    return (
        accepted.filter(_is(OVERRIDE))
        .groupBy("case_key", F.col("code").alias("taxonomy_code"))
        .agg(last)
        .select(
            "case_key",
            "taxonomy_code",
            F.col("o.status").alias("status"),
            F.col("o.note").alias("note"),
            F.col("o.ts").alias("updated_at"),
        )
    )


def merge_overrides(stored: DataFrame, accepted: DataFrame) -> DataFrame:
    """The next override table: actions replace stored rows of the same case and type."""
    new = latest_overrides(accepted)
    kept = stored.join(new.select("case_key", "taxonomy_code"), ["case_key", "taxonomy_code"], "left_anti")
    return schema.conform(kept, "checklist_overrides").unionByName(new)


def final_case_state(accepted: DataFrame) -> DataFrame:
    """Manual status, completion and note after all actions of a case.

    A field of the result is a struct, null where no action touched it. Every value is a
    ``max_by``, which combines before the shuffle, so no case is sorted or collected.
    """
    position = F.struct("ts", "seq")

    def last_of(value: Column, *kinds: str) -> Column:
        return F.max_by(value, F.when(_is(*kinds), position))

    manual = F.when(_is(COMPLETE_CASE), schema.COMPLETE).when(_is(MANUAL), F.col("status"))
    completion = F.struct(
        F.when(_is(COMPLETE_CASE), F.col("ts")).alias("completed_at"),
        F.when(_is(COMPLETE_CASE), F.col("reviewed_by")).alias("reviewed_by"),
    )
    return accepted.groupBy("case_key").agg(
        last_of(F.struct(manual.alias("manual_status")), MANUAL, COMPLETE_CASE, REOPEN).alias("manual"),
        last_of(completion, COMPLETE_CASE, REOPEN).alias("completion"),
        last_of(F.struct("note"), NOTE).alias("noted"),
        F.bool_or(~_is(NOTE)).alias("recompute"),
    )


def apply_case_state(cases: DataFrame, state: DataFrame) -> DataFrame:
    """Write the final action state into the case snapshot; figures are left to the recompute."""
    joined = cases.join(state, "case_key", "left")

    def chosen(field: str, touched: str, name: str) -> Column:
        return F.when(F.col(touched).isNotNull(), F.col(f"{touched}.{field}")).otherwise(F.col(name))

    return schema.conform(
        joined.withColumns(
            {
                "manual_status": chosen("manual_status", "manual", "manual_status"),
                "completed_at": chosen("completed_at", "completion", "completed_at"),
                "reviewed_by": chosen("reviewed_by", "completion", "reviewed_by"),
                "note": chosen("note", "noted", "note"),
            }
        ),
        "cases",
    )


def with_previous_override(accepted: DataFrame, facts: DataFrame, keep: Keep) -> DataFrame:
    """Override actions with the status in force before them (``old_status``, null if none)
    and the evidence count of their type (``evidence``).

    Stored facts go in as the first row of their (case, type), so they need no join.
    """
    overrides = accepted.filter(_is(OVERRIDE)).select(
        *accepted.columns, F.lit(None).cast("bigint").alias("n")
    )
    stored = facts.filter("code is not null").select(
        "case_key",
        "code",
        F.col("override_status").alias("status"),
        F.lit("stored").alias("action"),
        F.lit(-1).cast("bigint").alias("seq"),
        _beginning().alias("ts"),
        "n",
    )
    rows = overrides.unionByName(stored, allowMissingColumns=True)
    folded = prefix_fold(
        rows,
        ["case_key", "code"],
        ["ts", "seq"],
        sums={},
        lasts={"old_status": F.col("status"), "evidence": F.col("n")},
        keep=keep,
    )
    return folded.filter("action != 'stored'").select(
        *accepted.columns, "old_status", F.coalesce("evidence", F.lit(0)).alias("evidence")
    )


def _beginning() -> Column:
    """Where stored state stands in the order of actions: before all of them, at the first moment that can be written."""
    return F.timestamp_micros(F.lit(-62_135_596_800_000_000))


def override_changes(accepted: DataFrame, facts: DataFrame, catalog: DataFrame, keep: Keep) -> DataFrame:
    """Override actions with the former status and the change in the number of missing types."""
    defaults = F.broadcast(
        catalog.filter("active").select("code", F.col("default_applicability").alias("_default"))
    )

    def missing(status: Column) -> Column:
        item = item_status(F.col("evidence"), status, F.col("_default"))
        return F.when(item == schema.MISSING, 1).otherwise(0)

    return (
        with_previous_override(accepted, facts, keep)
        .join(defaults, "code")
        .withColumn("missing_change", missing(F.col("status")) - missing(F.col("old_status")))
        .select(*accepted.columns, "old_status", "missing_change")
    )


def replay(
    accepted: DataFrame,
    changes: DataFrame,
    cases: DataFrame,
    facts: DataFrame,
    catalog: DataFrame,
    warnings: DataFrame,
    keep: Keep,
) -> DataFrame:
    """Each action with the state of its case just before and just after it.

    The result equals applying the actions one by one with a recompute after each, on
    otherwise unchanged documents, evidence and warnings: the automatic status depends on the
    actions only through the number of missing types, which is a running sum over overrides.
    """
    others = accepted.filter(~_is(OVERRIDE))

    start = (
        rollup(
            cases.select("case_key", "manual_status", "effective_status", "completed_at", "reviewed_by"),
            facts,
            catalog,
        )
        .join(active_per_case(warnings).select("case_key", "review_pending"), "case_key", "left")
        .select(
            "case_key",
            F.lit("stored").alias("action"),
            F.lit(-1).cast("bigint").alias("seq"),
            _beginning().alias("ts"),
            F.struct(
                "document_count",
                "missing_type_count",
                F.coalesce("review_pending", F.lit(False)).alias("review_pending"),
                "effective_status",
            ).alias("_start"),
            F.struct("manual_status").alias("_manual"),
            F.struct("completed_at", "reviewed_by").alias("_completion"),
        )
    )
    manual = F.when(
        _is(MANUAL, COMPLETE_CASE, REOPEN),
        F.struct(
            F.when(_is(COMPLETE_CASE), schema.COMPLETE).when(_is(MANUAL), F.col("status")).alias("manual_status")
        ),
    )
    completion = F.when(
        _is(COMPLETE_CASE, REOPEN),
        F.struct(
            F.when(_is(COMPLETE_CASE), F.col("ts")).alias("completed_at"),
            F.when(_is(COMPLETE_CASE), F.col("reviewed_by")).alias("reviewed_by"),
        ),
    )
    steps = changes.unionByName(others, allowMissingColumns=True).withColumns(
        {"_manual": manual, "_completion": completion}
    )
    folded = prefix_fold(
        steps.unionByName(start, allowMissingColumns=True),
        ["case_key"],
        ["ts", "seq"],
        sums={
            "_missing_before": F.coalesce("missing_change", F.lit(0)),
            "_recomputes_before": F.when(_is("stored", NOTE), 0).otherwise(1),
        },
        lasts={
            "_case": F.col("_start"),
            "_manual_before": F.col("_manual"),
            "_completion_before": F.col("_completion"),
        },
        keep=keep,
    ).filter("action != 'stored'")

    def auto(missing_now: Column) -> Column:
        return auto_status(
            F.col("_case.document_count"),
            F.col("_case.review_pending"),
            F.col("_case.missing_type_count") + missing_now,
        )

    missing_after = F.col("_missing_before") + F.coalesce("missing_change", F.lit(0))
    manual_after = F.when(F.col("_manual").isNotNull(), F.col("_manual.manual_status")).otherwise(
        F.col("_manual_before.manual_status")
    )
    before = F.when(F.col("_recomputes_before") == 0, F.col("_case.effective_status")).otherwise(
        F.coalesce(F.col("_manual_before.manual_status"), auto(F.col("_missing_before")))
    )
    return folded.select(
        *accepted.columns,
        "old_status",
        before.alias("effective_before"),
        manual_after.alias("manual_after"),
        F.coalesce(manual_after, auto(missing_after)).alias("effective_after"),
        F.col("_completion_before.completed_at").alias("completed_before"),
        F.col("_completion_before.reviewed_by").alias("reviewed_before"),
    )


def audit_rows(replayed: DataFrame) -> DataFrame:
    """History rows of replayed actions: one per action, and one more where the recompute
    after it changed the effective status. ``seq`` orders the two."""
    null = F.lit(None).cast("string")
    reopened = F.lit(schema.UNPROCESSED)

    def event(kind: str, source: Column, target: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("event_type"),
            source.alias("from_status"),
            target.alias("to_status"),
            detail.alias("detail"),
        )

    before, after = F.col("effective_before"), F.col("effective_after")
    action_event = (
        F.when(
            _is(OVERRIDE),
            event(
                "CHECKLIST_OVERRIDE",
                null,
                null,
                override_detail(F.col("code"), F.col("old_status"), F.col("status")),
            ),
        )
        .when(_is(MANUAL), event("MANUAL_STATUS_CHANGED", before, F.col("status"), null))
        .when(_is(COMPLETE_CASE), event("MARK_COMPLETED", before, F.lit(schema.COMPLETE), F.col("reviewed_by")))
        .when(
            _is(REOPEN),
            event(
                "REOPENED",
                before,
                reopened,
                reopen_detail(F.col("completed_before"), F.col("reviewed_before")),
            ),
        )
        .otherwise(event("NOTE_UPDATED", null, null, F.col("note")))
    )
    left_with = F.when(_is(OVERRIDE), before).when(_is(REOPEN), reopened)
    recompute_event = F.when(
        _is(OVERRIDE, REOPEN) & (left_with != after),
        event("", left_with, after, F.lit("recompute")).withField(
            "event_type",
            F.when(F.col("manual_after").isNull(), "AUTO_STATUS_CHANGED").otherwise("MANUAL_STATUS_CHANGED"),
        ),
    )
    return replayed.select(
        "case_key",
        F.col("ts").alias("created_at"),
        "seq",
        F.posexplode(F.array_compact(F.array(action_event, recompute_event))).alias("_pos", "_event"),
    ).select(
        "case_key",
        "_event.*",
        "created_at",
        (F.col("seq") * 2 + F.col("_pos")).alias("seq"),
    )
