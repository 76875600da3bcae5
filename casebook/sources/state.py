"""Versioned state tables: parquet folders and one small file per published version."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from casebook import schema

# Tables are written in ranges of these columns, so that reading one case touches few row
# groups. The trailing columns let a single large case span many files.
CLUSTERING = {
    "cases": ["case_key"],
    "documents": ["case_key", "relative_path"],
    "checklist_overrides": ["case_key", "taxonomy_code"],
    "warnings": ["case_key", "fingerprint"],
    "case_history": ["case_key", "created_at", "seq"],
    "import_events": ["case_key", "token"],
}
MAX_PARTS = 64


class StateStore:
    """Reads the newest published version; ``draft`` prepares the next one.

    A version names the folders each table consists of. Writers never change files of a
    published version, and a draft that is not published is invisible.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        path, system = self._path(f"{self.base}/versions")
        if not system.exists(path):
            return 0
        names = [s.getPath().getName() for s in system.listStatus(path)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def content(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        if number == 0:
            return {"tables": {}, "batches": {}}
        text = self.spark.read.text(f"{self.base}/versions/{number:010d}.json", wholetext=True).first()
        return json.loads(text["value"])

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table in the current schema; columns it lacks get their defaults."""
        parts = self.content(version)["tables"].get(table, [])
        frames = [schema.conform(self.spark.read.parquet(p), table) for p in parts]
        if not frames:
            return schema.empty(self.spark, schema.TABLES[table])
        return reduce(DataFrame.unionByName, frames)

    def draft(self) -> Draft:
        return Draft(self)

    def export(self, target: str, at: datetime | None = None) -> str:
        """Copy all tables to a new folder named after the moment; never overwrites."""
        moment = at or datetime.now(timezone.utc)
        folder = f"{target.rstrip('/')}/{moment.strftime('%Y%m%d-%H%M%S-%f')}"
        number = self.version()
        for table in schema.TABLES:
            self.read(table, number).write.mode("errorifexists").parquet(f"{folder}/{table}")
        return folder

    def publish(self, content: dict, number: int) -> None:
        """Make a version visible. Creating the file fails if someone else published first."""
        path, system = self._path(f"{self.base}/versions/{number:010d}.json")
        pending, _ = self._path(f"{self.base}/pending/{uuid.uuid4().hex}.json")
        out = system.create(pending, False)
        out.write(bytearray(json.dumps(content), "utf-8"))
        out.close()
        system.mkdirs(path.getParent())
        if system.exists(path) or not system.rename(pending, path):
            raise RuntimeError(f"version {number} was published by someone else")


class Draft:
    """The next version in the making."""

    def __init__(self, store: StateStore):
        self.store = store
        self.before = store.version()
        self.content = store.content(self.before)
        self.folder = f"{store.base}/data/{self.before + 1:010d}-{uuid.uuid4().hex[:8]}"

    def read(self, table: str) -> DataFrame:
        return self.store.read(table, self.before)

    def has(self, table: str) -> bool:
        return table in self.content["tables"]

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """Write the new content of a table and read it back, which also cuts the lineage."""
        self.content["tables"][table] = [self._write(table, df)]
        return self._again(table)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows; a table of too many parts is written anew as one."""
        parts = self.content["tables"].setdefault(table, [])
        parts.append(self._write(table, df))
        if len(parts) > MAX_PARTS:
            frames = [schema.conform(self.store.spark.read.parquet(p), table) for p in parts]
            whole = reduce(DataFrame.unionByName, frames)
            self.content["tables"][table] = [self._write(table, whole, "whole-")]

    def publish(self, batch: tuple[str, int] | None = None) -> int:
        if batch is not None:
            self.content.setdefault("batches", {})[batch[0]] = batch[1]
        self.store.publish(self.content, self.before + 1)
        return self.before + 1

    def _write(self, table: str, df: DataFrame, prefix: str = "") -> str:
        path = f"{self.folder}/{prefix}{table}"
        rows = schema.conform(df, table)
        columns = CLUSTERING.get(table)
        if columns:
            rows = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
        rows.write.mode("errorifexists").parquet(path)
        return path

    def _again(self, table: str) -> DataFrame:
        path = self.content["tables"][table][0]
        return self.store.spark.read.schema(schema.TABLES[table]).parquet(path)
