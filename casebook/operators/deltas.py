"""Recompute from changes: document counts that move by signed differences.

What progress and status need of a case's documents is how many it has of each type and when the newest was hashed. Both
follow from counts per (case, type, hash time), and such counts can be taken back: a document that goes, or changes, takes
one away where it was, and adds one where it is now. The newest hash time is the largest with a positive count, so
even that moves without reading the documents that stayed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.operators.checklist import facts_from_counts
from casebook.operators.diff import BEFORE, limit_to
from casebook.operators.status import figures_from_facts

KEYS = ("case_key", "code", "last_hashed_at")
#: What counts need of a document's stored values.
COUNTED = ("taxonomy_code", "parse_status", "is_present", "last_hashed_at")


def _valid_code(prefix: str) -> Column:
    """The type of a valid document, null for others."""
    return F.when(F.col(f"{prefix}parse_status") == "OK", F.col(f"{prefix}taxonomy_code"))


def document_counts(documents: DataFrame) -> DataFrame:
    """Present documents per case, type (null: none valid) and hash time."""
    present = documents.filter("is_present").select("case_key", _valid_code("").alias("code"), "last_hashed_at")
    return present.groupBy(*KEYS).agg(F.count("*").alias("n"))


def stored_counts(changes: DataFrame) -> DataFrame:
    """The counts of the stored documents, from a change set (``diff.change_set``), which has all of them."""
    return document_counts(changes.select("case_key", *[F.col(BEFORE + n).alias(n) for n in COUNTED]))


def count_deltas(moved: DataFrame) -> DataFrame:
    """Signed differences of the counts from documents next to their stored values (``diff.moved_documents``)."""

    def side(prefix: str, sign: int) -> Column:
        there = F.coalesce(F.col(f"{prefix}is_present"), F.lit(False))
        return F.struct(
            _valid_code(prefix).alias("code"),
            F.col(f"{prefix}last_hashed_at").alias("last_hashed_at"),
            F.when(there, sign).otherwise(0).cast("bigint").alias("n"),
        )

    both = moved.select("case_key", F.inline(F.array(side(BEFORE, -1), side("", 1))))
    return both.filter("n <> 0").groupBy(*KEYS).agg(F.sum("n").alias("n")).filter("n <> 0")


def apply_deltas(counts: DataFrame, deltas: DataFrame) -> DataFrame:
    """The counts after the changes."""
    both = counts.select(*KEYS, "n").unionByName(deltas.select(*KEYS, "n"))
    return both.groupBy(*KEYS).agg(F.sum("n").alias("n")).filter("n <> 0")


def moved_cases(figures: DataFrame, cases: DataFrame, deltas: DataFrame, warnings: DataFrame) -> DataFrame:
    """Cases whose figures may differ from the stored ``figures``: those with count differences, with a warning that was
    raised, retired or is new (``was_active`` differs from ``active``), and those without stored figures."""
    turned = warnings.filter("active <> was_active").select("case_key")
    fresh = cases.join(figures.select("case_key"), "case_key", "left_anti").select("case_key")
    return deltas.select("case_key").union(turned).union(fresh).distinct()


def figures_after(
    figures: DataFrame,
    moved: DataFrame,
    cases: DataFrame,
    counts: DataFrame,
    deltas: DataFrame,
    catalog: DataFrame,
    overrides: DataFrame,
    warnings: DataFrame,
    evidence: DataFrame | None = None,
) -> DataFrame:
    """Figures of ``cases``: those of ``moved`` cases from counts and differences, the others as stored.

    Catalog, overrides and evidence are those of the stored figures; cases concerned by other changes belong to ``moved``.
    """
    now = apply_deltas(limit_to(counts, moved), limit_to(deltas, moved))
    facts = facts_from_counts(now, limit_to(overrides, moved), None if evidence is None else limit_to(evidence, moved))
    renewed = figures_from_facts(limit_to(cases, moved), facts, catalog, limit_to(warnings, moved))
    stored = figures.join(moved, "case_key", "left_anti").join(cases.select("case_key"), "case_key", "left_semi")
    return renewed.unionByName(stored.select(*renewed.columns))
