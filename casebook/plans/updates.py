"""Batches of operator actions and of document imports, from input rows to new snapshots."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame

from casebook.operators import actions, imports
from casebook.operators.checklist import type_facts
from casebook.operators.diff import limit_to
from casebook.operators.status import recompute
from casebook.plans.scan import moment
from casebook.sources.catalog import pin
from casebook.sources.state import StateStore
from casebook.sources.work import Work


@dataclass(frozen=True)
class ActionResult:
    cases: DataFrame
    overrides: DataFrame
    warnings: DataFrame
    history: DataFrame
    rejected: DataFrame


@dataclass(frozen=True)
class ImportPlan:
    """A planned batch. Names are given, and kept, when something that needs them is first asked for."""

    rejected: DataFrame
    work: Work
    named_by: Callable[[], DataFrame]
    provenance_by: Callable[[DataFrame], DataFrame]

    @cached_property
    def named(self) -> DataFrame:
        return self.work.keep(self.named_by(), "named")

    @property
    def names(self) -> DataFrame:
        return self.named.drop("rename_from", "rename_to")

    @property
    def renames(self) -> DataFrame:
        return imports.renames(self.named)

    @property
    def provenance(self) -> DataFrame:
        return self.provenance_by(self.named)


def replay_actions(
    work: Work,
    accepted: DataFrame,
    cases: DataFrame,
    documents: DataFrame,
    catalog: DataFrame,
    overrides: DataFrame,
    warnings: DataFrame,
    evidence: DataFrame | None = None,
) -> DataFrame:
    """Accepted actions with case state before and after; the shared parts are kept.

    Only the cases acted on are looked at.
    """
    acted = work.keep(accepted.select("case_key").distinct(), "acted_cases")
    facts = type_facts(
        limit_to(documents, acted),
        limit_to(overrides, acted),
        None if evidence is None else limit_to(evidence, acted),
    )
    facts = work.keep(facts, "action_facts")
    changes = work.keep(actions.override_changes(accepted, facts, catalog, work.keep), "action_changes")
    return actions.replay(
        accepted,
        changes,
        limit_to(cases, acted),
        facts,
        catalog,
        limit_to(warnings, acted),
        work.keep,
    )


def apply_actions(
    work: Work,
    batch: DataFrame,
    cases: DataFrame,
    documents: DataFrame,
    catalog: DataFrame,
    overrides: DataFrame,
    warnings: DataFrame,
    at: Column,
    evidence: DataFrame | None = None,
) -> ActionResult:
    """Apply a batch of actions: new case, override and warning snapshots, history rows, rejects.

    The history holds what single actions with a recompute after each would have written. The
    change-after-completion warning is raised from the state after the whole batch.
    """
    checked = actions.check_actions(batch, cases, catalog)
    accepted = work.keep(checked.accepted, "accepted")
    replayed = replay_actions(work, accepted, cases, documents, catalog, overrides, warnings, evidence)
    state = work.keep(actions.final_case_state(accepted), "action_state")
    merged = work.keep(actions.merge_overrides(overrides, accepted), "action_overrides")
    moved = actions.apply_case_state(cases, state)
    done = recompute(
        moved, documents, catalog, merged, warnings, at, evidence,
        scope=state.filter("recompute").select("case_key"), require_present=False, keep=work.keep,
    )
    return ActionResult(
        cases=done.cases,
        overrides=merged,
        warnings=done.warnings,
        history=actions.audit_rows(replayed),
        rejected=checked.rejected,
    )


def plan_imports(
    work: Work,
    requests: DataFrame,
    manifests: DataFrame,
    documents: DataFrame,
    cases: DataFrame,
    catalog: DataFrame,
    at: Column,
    events: DataFrame | None = None,
) -> ImportPlan:
    """Names, renames, provenance rows and rejects for a batch of import requests.

    ``events`` holds the provenance of earlier batches: their names count as taken until a scan has seen the files, and
    their sessions as used up.

    The parts read tables kept in ``work``; drop that once they have been used.
    """
    checked = work.keep(imports.check_requests(requests, manifests, cases, catalog), "checked")
    whole = imports.use_sessions(checked, events)
    judged = work.keep(whole.select("token", "case_key", "type_id", "requested_at", "reason"), "judged")

    def named() -> DataFrame:
        known = documents if events is None else imports.with_planned(documents, events)
        taken = imports.existing_numbers(known, catalog)
        return imports.assign_sequences(judged.filter("reason is null"), taken, catalog, work.keep)

    return ImportPlan(
        rejected=judged.filter("reason is not null").select("token", "case_key", "type_id", "reason"),
        work=work,
        named_by=named,
        provenance_by=lambda given: imports.provenance_rows(whole.filter("reason is null"), manifests, given, at),
    )


def submit_actions(
    store: StateStore,
    batch: DataFrame,
    at: datetime | None = None,
    evidence: DataFrame | None = None,
    batch_id: tuple[str, int] | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Apply actions to the stored state and publish it; returns the rejected ones.

    With ``rejects`` they are also kept in that folder, as parquet, before the state is published.
    """
    work, draft = Work(store.spark), store.draft()
    try:
        result = apply_actions(
            work,
            work.keep(batch, "batch"),
            draft.read("cases"),
            draft.read("documents"),
            pin(draft.read("catalog")),
            draft.read("checklist_overrides"),
            draft.read("warnings"),
            moment(at or datetime.now(timezone.utc)),
            evidence,
        )
        if rejects:
            result.rejected.write.mode("overwrite").parquet(rejects)
            rejected = store.spark.read.schema(result.rejected.schema).parquet(rejects)
        else:
            rejected = Work(store.spark).keep(result.rejected, "rejected")
        draft.append("case_history", result.history)
        draft.replace("cases", result.cases)
        draft.replace("warnings", result.warnings)
        draft.replace("checklist_overrides", result.overrides)
        draft.publish(batch_id)
    finally:
        work.drop()
    return rejected


def submit_imports(
    store: StateStore, requests: DataFrame, manifests: DataFrame, at: datetime | None = None
) -> ImportPlan:
    """Plan imports against the stored state and record their provenance."""
    work, draft = Work(store.spark), store.draft()
    plan = plan_imports(
        work,
        requests,
        manifests,
        draft.read("documents"),
        draft.read("cases"),
        pin(draft.read("catalog")),
        moment(at or datetime.now(timezone.utc)),
        draft.read("import_events"),
    )
    draft.append("import_events", plan.provenance)
    draft.publish()
    return plan
