"""Listing case folders and their PDF files as distributed jobs.

Spark's own file sources hide names starting with an underscore, follow linked folders, know
no empty folders and keep the whole listing on the driver. Here tasks read directories and
stream the entries out; the driver holds none of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions.names import folded, is_ignored, stays_inside
from casebook.operators.spread import prefix_fold
from casebook.sources.work import Work

# Shell patterns of names that are never looked at.
IGNORED = ("Thumbs.db", ".DS_Store", "~$*")

_ROWS = 10_000
_FOUND = "case_key string, relative_path string, is_dir boolean, size_bytes bigint, mtime_ns bigint"


def directory_reader(ignore: tuple[str, ...]) -> Callable[[str], Iterator[tuple]]:
    """A function yielding (name, is_dir, size, mtime in ns) of a directory's wanted entries.

    Nested, so that it travels to executors by value. Local paths use the operating system,
    which tells links apart; other URIs use Arrow's file systems.
    """

    def read(path: str):
        import fnmatch
        import os

        def wanted(name: str) -> bool:
            return not name.startswith(".") and not any(fnmatch.fnmatch(name, p) for p in ignore)

        if "://" in path and not path.startswith("file://"):
            from pyarrow import fs

            system, where = fs.FileSystem.from_uri(path)
            for info in system.get_file_info(fs.FileSelector(where)):
                if wanted(info.base_name):
                    is_dir = info.type == fs.FileType.Directory
                    yield info.base_name, is_dir, 0 if is_dir else info.size, info.mtime_ns or 0
            return
        with os.scandir(path.removeprefix("file://")) as entries:
            for entry in entries:
                if not wanted(entry.name) or entry.is_symlink():
                    continue
                stat = entry.stat(follow_symlinks=False)
                yield entry.name, entry.is_dir(follow_symlinks=False), stat.st_size, stat.st_mtime_ns

    return read


def list_folders(spark: SparkSession, root: str, ignore: tuple[str, ...] = IGNORED) -> DataFrame:
    """Immediate sub-folders of ``root``, empty ones included. A missing root is an error.

    One directory can only be read as one stream, so this is one task; it holds a batch of
    names at a time.
    """
    root = root.rstrip("/")
    read = directory_reader(ignore)

    def folders(batches):
        import pandas as pd

        for batch in batches:
            for base in batch["root"]:
                rows = []
                for name, is_dir, _, _ in read(base):
                    if is_dir:
                        rows.append((name, f"{base}/{name}", name))
                    if len(rows) >= _ROWS:
                        yield pd.DataFrame(rows, columns=["case_key", "folder_path", "folder_name"])
                        rows = []
                yield pd.DataFrame(rows, columns=["case_key", "folder_path", "folder_name"], dtype=object)

    start = spark.range(1).select(F.lit(root).alias("root"))
    return start.mapInPandas(folders, schema.FOLDERS)


def folders_of_cases(spark: SparkSession, root: str, cases: DataFrame, tasks: int) -> DataFrame:
    """The folders of the named cases (``case_key``) that exist, without listing ``root``.

    Each is looked up by itself, spread over tasks. A missing root is an error, as in a listing.
    """
    root = root.rstrip("/")
    keys = cases.select("case_key").distinct().filter(stays_inside(F.col("case_key")) & (F.col("case_key") != ""))

    def existing(batches):
        import os

        remote = "://" in root and not root.startswith("file://")
        if remote:
            from pyarrow import fs

            system, base = fs.FileSystem.from_uri(root)
        else:
            base = root.removeprefix("file://")

        def is_dir(path: str) -> bool:
            if remote:
                return system.get_file_info(path).type == fs.FileType.Directory
            return os.path.isdir(path) and not os.path.islink(path)

        for batch in batches:
            if len(batch) and not (is_dir(base) if remote else os.path.isdir(base)):
                raise FileNotFoundError(root)
            yield batch[[is_dir(f"{base}/{key}") for key in batch["case_key"]]]

    found = keys.repartition(tasks).mapInPandas(existing, "case_key string")
    return found.select("case_key", F.concat(F.lit(f"{root}/"), "case_key").alias("folder_path"), F.col("case_key").alias("folder_name"))


def list_pdfs(
    work: Work, folders: DataFrame, root: str, tasks: int, ignore: tuple[str, ...] = IGNORED
) -> DataFrame:
    """PDF files of the given case folders at any depth.

    Two rounds: the case folders themselves, then the sub-folders found, which are spread
    again so that a case with many of them occupies many tasks. The first round is kept,
    because a file system may answer differently when asked twice.
    """
    root = root.rstrip("/")
    read = directory_reader(ignore)

    def scanner(deep: bool):
        def scan(batches):
            import pandas as pd

            columns = ["case_key", "relative_path", "is_dir", "size_bytes", "mtime_ns"]
            for batch in batches:
                rows = []
                for case_key, start in zip(batch["case_key"], batch["relative_path"]):
                    pending = [start]
                    while pending:
                        where = pending.pop()
                        for name, is_dir, size, mtime in read(f"{root}/{where}"):
                            path = f"{where}/{name}"
                            if is_dir and deep:
                                pending.append(path)
                            elif is_dir or name.lower().endswith(".pdf"):
                                rows.append((case_key, path, is_dir, size, mtime))
                            if len(rows) >= _ROWS:
                                yield pd.DataFrame(rows, columns=columns)
                                rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

        return scan

    starts = folders.select("case_key", F.col("case_key").alias("relative_path")).repartition(tasks)
    first = work.keep(starts.mapInPandas(scanner(deep=False), _FOUND), "entries")
    nested = first.filter("is_dir").select("case_key", "relative_path").repartition(tasks)
    files = first.filter("not is_dir").unionByName(nested.mapInPandas(scanner(deep=True), _FOUND))
    return files.select(*[f.name for f in schema.LISTING.fields])


def listing_from_inventory(
    inventory: DataFrame, root: str, ignore: tuple[str, ...] = IGNORED
) -> DataFrame:
    """A listing from an inventory table (``path``, ``size_bytes``, ``mtime_ns``) with absolute
    paths under ``root``; the way to go for object stores with more files than can be walked."""
    prefix = root.rstrip("/") + "/"
    relative = F.substring(F.col("path"), F.lit(len(prefix) + 1), F.length("path"))
    return (
        inventory.filter(F.startswith("path", F.lit(prefix)))
        .withColumn("relative_path", relative)
        .filter(F.lower("relative_path").endswith(".pdf") & F.contains("relative_path", F.lit("/")))
        .filter(stays_inside(F.col("relative_path")) & ~is_ignored(F.col("relative_path"), ignore))
        .select(
            "relative_path",
            F.substring_index("relative_path", "/", 1).alias("case_key"),
            F.col("size_bytes").cast("bigint").alias("size_bytes"),
            F.col("mtime_ns").cast("bigint").alias("mtime_ns"),
        )
    )


def folders_from_inventory(
    listing: DataFrame, root: str, case_keys: DataFrame | None = None
) -> DataFrame:
    """The folders that hold at least one listed file, and those of ``case_keys`` (``case_key``).

    A listing knows no empty folders: pass the keys of all folders where there may be some.
    """
    base = root.rstrip("/")
    keys = listing.select("case_key")
    if case_keys is not None:
        keys = keys.unionByName(case_keys.select("case_key"))
    return keys.distinct().select(
        "case_key",
        F.concat(F.lit(f"{base}/"), "case_key").alias("folder_path"),
        F.col("case_key").alias("folder_name"),
    )


def in_listing_order(listing: DataFrame) -> DataFrame:
    """Files by their case-folded paths."""
    return listing.orderBy(folded(F.col("relative_path")), "relative_path")


def with_positions(listing: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Files with their ``position`` (from 1) in listing order; only ranges of it are sorted in a task."""
    rows = listing.withColumns({"_all": F.lit(0), "_folded": folded(F.col("relative_path"))})
    placed = prefix_fold(rows, ["_all"], ["_folded", "relative_path"], {"_before": F.lit(1)}, {}, keep)
    return placed.withColumn("position", (F.col("_before") + 1).cast("bigint")).drop("_all", "_folded", "_before")
