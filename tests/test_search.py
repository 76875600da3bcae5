"""Search through trigram postings gives what reading every case gives, and reads less."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from casebook.plans import search
from casebook.plans.reports import CaseFilter, filter_cases
from casebook.sources.work import Work

SCHEMA = "case_key string, is_present boolean, person_name_display string, person_name_raw string, citizen_id string, gram string"


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(2)
    parts = ["Nguyễn", "LE", "Van", "đỗ", "ĐỖ", "Thị_1", "100%", "a\\b", "aaaa", "x", "İß", "😀😀😀", "o'Neil"]
    name = lambda: rng.choice([None, "", " ".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))])
    rows = [(f"case {k}", k % 7 != 0, name(), name(), rng.choice([None, str(rng.randint(0, 10**6))]), "own") for k in range(400)]
    return spark.createDataFrame(rows, SCHEMA).persist()


@pytest.fixture(scope="module")
def index(spark, cases):
    return search.index_cases(cases, Work(spark), buckets=32)


QUERIES = ("le van", "LE VAN", "đỗ thị", "Thị_1", "thị%le", "100%", "a\\b", "aaa", "aaaaa", "İß", "😀😀😀 le", "o'n", "x", "", "%", "12", "345", "nothing like it", "e v", "   ")


@pytest.mark.parametrize("q", QUERIES)
def test_same_rows_as_reading_all_cases(spark, cases, index, q):
    rows = lambda df: sorted((tuple(r) for r in df.select(*cases.columns).collect()), key=str)
    assert rows(search.search_cases(index, CaseFilter(q=q), Work(spark))) == rows(filter_cases(cases, CaseFilter(q=q)))


def test_only_posted_buckets_are_read(spark, cases, index):
    one = cases.where("is_present and length(citizen_id) = 6").orderBy("case_key").first()
    found = search.search_cases(index, CaseFilter(q=one["citizen_id"]), Work(spark))
    assert one["case_key"] in [r["case_key"] for r in found.collect()]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket#\d+ (=|IN)", plan), plan
    assert re.search(r"PushedFilters: \[In\(gram", index.postings.filter(F.col("gram").isin("abc", "def"))._jdf.queryExecution().executedPlan().toString())
    in_all = index.cases.select("_bucket").distinct().count()
    assert in_all > 20 and len(set(re.findall(r"_bucket#\d+ = (\d+)", plan))) == 1, plan  # one bucket of them is read
    assert found.columns == cases.columns
    gone = search.search_cases(index, CaseFilter(q="zzzz"), Work(spark))
    assert gone.count() == 0


def test_an_empty_table_of_cases(spark, cases):
    index = search.index_cases(cases.limit(0), Work(spark))
    assert search.search_cases(index, CaseFilter(q="le van"), Work(spark)).count() == 0


def test_wildcards_are_in_no_trigram():
    assert search.query_grams("ABc_de%fgh") == ["abc", "fgh"] and search.query_grams("a_b") == []


def test_postings_are_made_from_the_written_cases_without_a_shuffle(spark, cases):
    seen = {}

    class Watched(Work):
        def keep(self, df, name, by=None):
            seen[name] = df._jdf.queryExecution().executedPlan().toString()
            return super().keep(df, name, by)

    postings = search.index_cases(cases, Watched(spark), buckets=8).postings
    assert "Exchange" not in seen["postings"] and "FileScan parquet" in seen["postings"]
    by_file = postings.select(F.input_file_name().alias("f"), "gram").collect()
    for name in {r["f"] for r in by_file}:
        grams = [r["gram"].encode() for r in by_file if r["f"] == name]
        assert grams == sorted(grams)
