"""Content digests and readability of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schema

FILES_PER_TASK = 2_000
BYTES_PER_TASK = 1 << 30


def digest(content: Column) -> Column:
    """SHA-256 in hex of content that is already a column."""
    return F.sha2(content, 256)


def simple_page_counter() -> Callable:
    """The default page counter: reads blocks, looks for the header and for page objects.

    Pages inside compressed object streams cannot be counted this way; then the count is
    unknown (None) but the file is readable. Pass a real parser's counter where it matters.
    """

    def count(stream) -> int | None:
        import re

        page = re.compile(rb"/Type\s*/Page[^A-Za-z]")
        keep, tail, pages, packed = 64, b"", 0, False
        head = stream.read(1024)
        if b"%PDF-" not in head:
            raise ValueError("not a PDF file")
        block = head
        while block:
            text = tail + block
            # A match inside the part that is kept was counted with the block before.
            pages += sum(1 for m in page.finditer(text) if m.end() > len(tail))
            packed = packed or b"/ObjStm" in text
            tail, block = text[-keep:], stream.read(1 << 20)
        return None if packed and not pages else pages

    return count


def task_count(paths: DataFrame) -> int:
    """Tasks for reading: by number of files and by bytes, since few paths may mean much data."""
    found = paths.agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("b")).first()
    wanted = max(found["n"] // FILES_PER_TASK, found["b"] // BYTES_PER_TASK) + 1
    spread = paths.sparkSession.sparkContext.defaultParallelism
    return int(max(wanted, min(found["n"], spread), 1))


def probe_files(paths: DataFrame, root: str, tasks: int, page_counter: Callable | None = None) -> DataFrame:
    """Digest, page count and readability of files given by ``relative_path``.

    Only these files are opened. A file is read in blocks, so its size does not matter. An
    error of the page counter or zero pages make it unreadable. A file that has gone since
    the listing has no digest and is unreadable.
    """
    root = root.rstrip("/")
    count = page_counter or simple_page_counter()

    def probe(batches):
        import hashlib

        import pandas as pd

        def opened(path: str):
            if "://" in path and not path.startswith("file://"):
                from pyarrow import fs

                system, where = fs.FileSystem.from_uri(path)
                return system.open_input_file(where)
            return open(path.removeprefix("file://"), "rb")

        def examine(relative_path: str):
            try:
                with opened(f"{root}/{relative_path}") as stream:
                    state = hashlib.sha256()
                    while block := stream.read(1 << 20):
                        state.update(block)
                    stream.seek(0)
                    try:
                        pages = count(stream)
                    except Exception:
                        return state.hexdigest(), None, False
            except FileNotFoundError:
                return None, None, False
            return state.hexdigest(), pages, pages is None or pages >= 1

        for batch in batches:
            for start in range(0, len(batch), 1000):
                names = list(batch["relative_path"][start : start + 1000])
                rows = [(name, *examine(name)) for name in names]
                out = pd.DataFrame(rows, columns=["relative_path", "sha256", "page_count", "readable"])
                yield out.astype({"page_count": "Int32"})

    spread = paths.select("relative_path").repartition(tasks, "relative_path")
    return spread.mapInPandas(probe, schema.PROBE)
