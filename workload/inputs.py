"""Spark side of the input views."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schema
from casebook.sources.catalog import pin
from casebook.sources.work import Work
from workload.views import T0, T1, TABLES, VIEWS, dependencies


#: Rows of a dealt table that one task sorts.
ROWS_A_TASK = 500_000


class Inputs:
    """The views as DataFrames over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._views: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def deal(self, name: str, key: str) -> None:
        """Has the views read a table dealt by ``key`` to tasks of about ``ROWS_A_TASK`` rows.

        Partitions that are merged by their compressed size may unfold to many times that when they are sorted.
        """
        whole = self.table(name)
        self._tables[name] = whole.repartition(max(1, -(-whole.count() // ROWS_A_TASK)), key)

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            sql = VIEWS[name]
            frames = {n: self.view(n) for n in dependencies(sql, VIEWS)}
            frames.update({t: self.table(t) for t in TABLES if "{" + t + "}" in sql})
            if "catalog" in frames:
                frames["catalog"] = self.catalog_with_slug
            body = sql.replace("{sha}", "sha2(").replace("{end}", ", 256)")
            self._views[name] = self.spark.sql(body, **frames)
        return self._views[name]

    @cached_property
    def catalog(self) -> DataFrame:
        """The catalog, checked to be small and pinned."""
        return pin(self.view("catalog"))

    @cached_property
    def catalog_with_slug(self) -> DataFrame:
        return self.catalog.withColumn("slug", F.expr("substring(filename_base, length(code) + 2)"))

    def state(self, view: str, table: str) -> DataFrame:
        return schema.conform(self.view(view), table)

    @cached_property
    def work(self) -> Work:
        return Work(self.spark)

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A result several steps of a query share, written once."""
        key = f"kept {name}"
        if key not in self._views:
            self._views[key] = self.work.keep(build(), name)
        return self._views[key]

    @property
    def t0(self) -> Column:
        return F.expr(T0)

    @property
    def t1(self) -> Column:
        return F.expr(T1)
