"""Quality rules learned as a decision list.

Sequential covering: grow a conjunction of thresholds on statistics, condition by condition, by FOIL's gain on two
thirds of the labelled rows; prune it from the end while that does not make it worse on the remaining third; add the rule
if it is precise enough; take the rows it covers away; go on. The rules, in the order found, become one nested
``when ... otherwise`` expression, which is all that a table is judged by.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import table
from casebook.llm.text_stats import COUNTS, RATIOS, with_stats
from casebook.sources.work import Work

#: Labelled rows the rules are learned from at most: those with the least hash of their id, from all over the table.
MOST_LABELLED = 50_000
#: Thresholds tried for each statistic and condition.
CUTS = 48
MOST_CONDITIONS, MOST_RULES = 4, 24


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] > self.cut if self.above else values[self.name] <= self.cut

    def column(self) -> Column:
        return F.col(self.name) > F.lit(self.cut) if self.above else F.col(self.name) <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    inside, rule = np.ones(bad.size, bool), []
    while len(rule) < MOST_CONDITIONS:
        p0, n0 = int(bad[inside].sum()), int(inside.sum())
        if p0 == 0 or p0 == n0:
            break
        before, best = np.log2(p0 / n0), (1e-9, None)
        for name, column in values.items():
            own, hit = column[inside], bad[inside]
            order = np.argsort(own, kind="stable")
            own, hit = own[order], np.cumsum(hit[order])
            ends = np.flatnonzero(own[1:] > own[:-1])  # the last row at or below each possible threshold
            if not ends.size:
                continue
            if ends.size > CUTS:  # thresholds between quantiles, of all rows and of the bad ones
                among = np.interp(np.linspace(0, p0, CUTS // 2), hit, np.arange(own.size))
                wanted = np.concatenate([np.linspace(0, own.size - 1, CUTS // 2), among])
                ends = np.unique(ends[np.minimum(np.searchsorted(ends, wanted), ends.size - 1)])
            low_p, low_n = hit[ends], ends + 1
            for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - before), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), Condition(name, above, float((own[ends[k]] + own[ends[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(values)
    return tuple(rule)


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = covered(rule, values, bad.size)
    p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(values: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, least: int = 3, seed: int = 5) -> list[Rule]:
    """Rules whose rows are bad with at least ``precision``, best first; none if nothing can be learned."""
    rng = np.random.default_rng(seed)
    left, rules = np.arange(bad.size), []
    while len(rules) < MOST_RULES and bad[left].sum() >= least:
        order = rng.permutation(left)
        grow, prune = np.sort(order[: 2 * len(order) // 3]), np.sort(order[2 * len(order) // 3 :])
        of = lambda rows: {k: v[rows] for k, v in values.items()}
        rule = _grow(of(grow), bad[grow])
        held = of(prune)
        while len(rule) > 1 and _worth(rule[:-1], held, bad[prune]) >= _worth(rule, held, bad[prune]):
            rule = rule[:-1]
        inside = covered(rule, of(left), left.size)
        if not rule or bad[left][inside].sum() < max(least, precision * inside.sum()):
            break
        rules.append(rule)
        left = left[~inside]
    return rules


def expression(rules: list[Rule], found: Column, otherwise: Column) -> Column:
    """``found`` for rows that a rule covers, asked in their order, else ``otherwise``."""
    out = otherwise
    for rule in reversed(rules):
        whole = rule[0].column()
        for c in rule[1:]:
            whole = whole & c.column()
        out = F.when(whole, found).otherwise(out)
    return out


def rule_number(rules: list[Rule]) -> Column:
    """The number (from 0) of the rule that decides a row, null if none does."""
    out = F.lit(None).cast("int")
    for n, rule in reversed(list(enumerate(rules))):
        whole = rule[0].column()
        for c in rule[1:]:
            whole = whole & c.column()
        out = F.when(whole, F.lit(n)).otherwise(out)
    return out


def learn_rules(measured: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = MOST_LABELLED) -> list[Rule]:
    """Rules for label 0 from at most ``most`` labelled rows of a measured table, also where an id has many rows (those with
    the least hash of their id, then the least values); rows without a label teach nothing."""
    known = labels.where(F.col(label_col).isNotNull()).select(labels["doc_id"].alias("_id"), F.col(label_col).alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_label").limit(most)
    # the sample has a bounded number of short rows, so it can be sent to all tasks
    rows = measured.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", *RATIOS, "_label")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "_label", *RATIOS).limit(most).toPandas()
    rows = rows.sort_values(["doc_id", "_label", *RATIOS], kind="stable")
    return learn({r: rows[r].to_numpy() for r in RATIOS}, (rows["_label"] == 0).to_numpy())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, COUNTS, ``base_failed``, ``kept`` and ``rule`` (the deciding rule's number).

    Null or empty texts have no words and fail the base test. Repeated rows are judged one by one; without usable labels
    the base test decides alone.
    """
    work = Work(docs.sparkSession)
    measured = work.keep(with_stats(docs), "stats")
    rules = learn_rules(measured, labels)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = F.when(base_failed, F.lit(False)).otherwise(expression(rules, F.lit(False), F.lit(True)))
    return measured.select("doc_id", *COUNTS, base_failed.alias("base_failed"), kept.alias("kept"), rule_number(rules).alias("rule"))


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
