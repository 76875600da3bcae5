"""Substring search over cases by postings of trigrams.

``LIKE %q%`` alone reads every case. The index holds, for each three characters in a row of a searched field, the cases that
have them, in each file sorted by these characters, so that a search reads the postings of its own trigrams only. Cases that have all
of them are then read from the folders of their buckets and checked by the same condition as without an index, so both
give the same rows. The index belongs to one snapshot of the cases and is written anew with it.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.text import ascii_lower
from casebook.plans.reports import SEARCHED, CaseFilter, filter_cases
from casebook.sources.work import Work

GRAM = 3
BUCKETS = 256


@dataclass(frozen=True)
class CaseIndex:
    cases: DataFrame  # all columns and ``_bucket``, a folder for each bucket
    postings: DataFrame  # ``gram``, ``_bucket``, ``case_key``


def grams(text: Column) -> Column:
    """All trigrams of a text, folded as the search folds; none if it is null or shorter."""
    folded = ascii_lower(text)
    count = F.length(folded) - (GRAM - 1)
    found = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda k: F.substring(folded, k, F.lit(GRAM)))
    return F.coalesce(F.when(count > 0, found), F.array().cast("array<string>"))


def query_grams(query: str) -> list[str]:
    """Trigrams that every match of ``%query%`` has; what stands next to a wildcard is in none."""
    folded = query.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    runs = re.split("[%_]", folded)
    return sorted({run[k : k + GRAM] for run in runs for k in range(len(run) - GRAM + 1)})


def index_cases(cases: DataFrame, work: Work, buckets: int = BUCKETS) -> CaseIndex:
    """Writes the index. Postings are made from the written cases, part by part, and sorted by trigram within each file: no
    trigram is gathered anywhere, however many cases have it, and a search reads of every file what its trigrams cover."""
    placed = cases.withColumn("_bucket", F.pmod(F.xxhash64("case_key"), F.lit(buckets)).cast("int"))
    kept = work.keep(placed.hint("rebalance", "_bucket"), "indexed-cases", by="_bucket")
    own = F.array_distinct(F.concat(*[grams(F.col(c)) for c in SEARCHED]))
    postings = kept.select(F.explode(own).alias("gram"), "_bucket", "case_key")
    return CaseIndex(kept, work.keep(postings.sortWithinPartitions("gram"), "postings"))


def search_cases(index: CaseIndex, f: CaseFilter, work: Work, warnings: DataFrame | None = None) -> DataFrame:
    """The rows of ``filter_cases``. A query without three literal characters in a row reads all cases."""
    wanted = query_grams(f.q)
    if not wanted:
        return filter_cases(index.cases, f, warnings).drop("_bucket")
    posted = index.postings.filter(F.col("gram").isin(wanted)).groupBy("_bucket", "case_key").agg(F.count("*").alias("n"))
    hits = work.keep(posted.filter(F.col("n") == len(wanted)).select("_bucket", "case_key"), "hits")
    buckets = sorted(r[0] for r in hits.select("_bucket").distinct().collect())  # no more than there are buckets
    chosen = index.cases.filter(F.col("_bucket").isin(buckets)).join(hits.select("case_key"), "case_key", "left_semi")
    return filter_cases(chosen.select(*index.cases.columns), f, warnings).drop("_bucket")
