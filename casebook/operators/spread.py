"""Counts and running folds that stay balanced when one key holds a large share of the rows.

Joins of many rows to a table that is unique on the key are plain joins on the left side's key: adaptive execution splits a
hot partition of the left side, by its measured size, and repeats only the matching rows of the other side.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_in_group(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the number of rows sharing ``keys``, however many there are.

    The counts combine before their shuffle, and only groups of two or more are joined back. The hash as a further join
    key has the counts shuffled anew: adaptive execution splits a hot group only where both sides come from a shuffle.
    """
    own = F.xxhash64(*keys)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").withColumn("_hash", own)
    joined = rows.withColumn("_hash", own).join(counts, [*keys, "_hash"], "left")
    return joined.withColumn(name, F.coalesce("_n", F.lit(1).cast("bigint"))).drop("_n", "_hash")


def prefix_fold(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    lasts: dict[str, Column],
    keep: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """Add, per row, the sum (``sums``) and the last non-null value (``lasts``) over the rows
    of the same key that come before it in ``order``, which must be unique within a key.

    The rows are range-partitioned by key and order, so even a single key falls into chunks of
    about equal size; adaptive execution merges neighbours only while they are small, which
    keeps chunk numbers in order. Rows are sorted within one (key, chunk) only. Few keys lie in more
    than one chunk, at most as many as there are chunks: for these, what earlier chunks contribute is folded over the
    per-chunk totals and added. ``keep`` writes the chunked rows, since both steps have to see the same chunks.
    """
    ranged = rows.repartitionByRange(*keys, *order)
    cut = keep(ranged.withColumn("_chunk", F.spark_partition_id()), "chunks")
    piece = [*keys, "_chunk"]
    w_rows = Window.partitionBy(*piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    w_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    inner = cut.withColumns(
        {
            **{f"_in_{n}": F.coalesce(F.sum(c).over(w_rows), F.lit(0)) for n, c in sums.items()},
            **{f"_in_{n}": F.last(c, ignorenulls=True).over(w_rows) for n, c in lasts.items()},
        }
    )
    # Found by hashes: a key that shares its hash with another gets totals too, which are right as well.
    own = F.xxhash64(*keys)
    spans = cut.groupBy(own.alias("_hash")).agg(F.min("_chunk").alias("_lo"), F.max("_chunk").alias("_hi"))
    several = F.broadcast(spans.filter("_lo < _hi").select("_hash"))
    position = F.struct(*order)
    totals = cut.withColumn("_hash", own).join(several, "_hash", "left_semi").groupBy("_hash", *piece).agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()],
        *[F.max_by(c, F.when(c.isNotNull(), position)).alias(f"_t_{n}") for n, c in lasts.items()],
    )
    carry = totals.select(
        "_hash",
        *[F.col(n).alias(f"_k_{n}") for n in piece],
        *[F.coalesce(F.sum(f"_t_{n}").over(w_chunks), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_t_{n}", ignorenulls=True).over(w_chunks).alias(f"_c_{n}") for n in lasts],
    )
    same = [F.col("_chunk") == F.col("_k__chunk"), *[F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in keys]]
    met = inner.withColumn("_own", own).join(F.broadcast(carry), reduce(and_, same, F.col("_own") == F.col("_hash")), "left")
    return met.select(
        *rows.columns,
        *[(F.col(f"_in_{n}") + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(F.col(f"_in_{n}"), F.col(f"_c_{n}")).alias(n) for n in lasts],
    )
