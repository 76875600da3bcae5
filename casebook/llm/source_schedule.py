"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equally many words. Slot t takes the point frac(t * golden ratio), which falls into one
source's share of the unit interval; these points spread so evenly that any run of slots holds each source nearly in
proportion. The r-th slot of a source takes the r-th block of the source's documents, shuffled by a hash of their id, cut
into blocks of equally many words, and begun anew when all are used.

Which source a slot goes to is arithmetic on its number, so slots are made in parallel; ranks and running sums are taken
in two levels (inside chunks, and over the totals of chunks), so a source may hold any share of the rows.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import WORD, map_batches, ranked_within, table, word_count
from casebook.sources.work import Work

#: A mix names its sources one by one; more than this is taken for a mistake and refused.
MOST_SOURCES = 100_000
#: A source is used so many times at most.
MOST_REPEATS = 3
#: The golden ratio's fraction of 2**31, rounded to an odd number: t * STEP mod 2**31 visits every value once.
STEP, CYCLE = 1327217885, 1 << 31
SLOTS_IN_CHUNK, ROWS_IN_CHUNK = 1_000_000, 5_000


def targets(sizes: list[int], weights: list[int], repeats: int = MOST_REPEATS) -> list[float]:
    """Shares by weight of all words, none above ``repeats`` times its source; what is above is shared again."""
    total, found = sum(sizes), [Fraction(0)] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        rest, weight = total - sum(found[n] for n in range(len(sizes)) if n not in free), sum(weights[n] for n in free)
        shares = {n: Fraction(rest) * weights[n] / weight for n in free}
        above = {n for n in free if shares[n] > repeats * sizes[n]}
        for n in above or free:
            found[n] = Fraction(repeats * sizes[n]) if above else shares[n]
        free = free - above if above else set()
    return [float(t) for t in found]


def default_weights(sources: list[str | None]) -> list[int]:
    return [1 + n % 3 for n in range(len(sources))]


class Mix:
    """Plan of a mix over the rows of ``docs`` (an id, ``source``, ``text``; other columns are kept with ``keep``).

    A null source is a source of its own, the last; a null text has no words; repeated rows and null ids are rows like
    others. Every frame made here depends on the rows alone, so reruns agree; rows equal in id, source and size may trade
    places. ``weights`` gets the sources (by code point, null last) and returns a positive weight for each.
    """

    def __init__(self, docs: DataFrame, weights=default_weights, block_words: int = 1024, keep: tuple[str, ...] = (), id_col: str = "doc_id", seed: int = 17):
        spark = docs.sparkSession
        self.id, self.block, self.kept = id_col, block_words, keep
        self.work = Work(spark)
        self.rows = self.work.keep(
            docs.select(
                F.monotonically_increasing_id().alias("_row"),
                docs[id_col].alias(id_col),
                docs["source"].cast("string").alias("source"),
                word_count(docs["text"]).alias("size"),
                *(docs[c].alias(f"_kept_{c}") for c in keep),
            ),
            "rows",
        )
        found = self.rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
        if len(found) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        self.names = [r["source"] for r in found]
        self.sizes = [int(r["size"]) for r in found]
        self.targets = targets(self.sizes, list(weights(self.names)))
        self.words = [int(t) for t in self.targets]  # what the mix takes of each
        self.count = sum(int(r["n"]) for r in found)
        fields = "_source string, _no int, source_size long, target double, _words long"
        values = list(zip(self.names, range(len(found)), self.sizes, self.targets, self.words, strict=True))
        self.sources = F.broadcast(spark.createDataFrame(values, fields))  # at most MOST_SOURCES short rows
        self.spark, self.seed = spark, seed

    def placed(self) -> DataFrame:
        """Rows with their source's figures and ``_start``, the words before them in their source's shuffled order."""
        key = F.xxhash64(F.lit(self.seed), F.col(self.id))
        chunks = max(1, self.count // ROWS_IN_CHUNK)
        lean = self.rows.select("_row", self.id, "source", "size").withColumn("_key", F.shiftrightunsigned(key, 1))
        lean = lean.join(self.sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        # the chunks follow the order of the key: equal ranges of its upper 31 bits
        chunk = F.floor(F.shiftrightunsigned(F.col("_key"), 32) * F.lit(chunks) / F.lit(float(CYCLE)))
        return ranked_within(lean, ["_no"], ["_key", self.id, "size", "_row"], chunk, F.col("size"), "_start").drop("_key")

    def slots(self) -> DataFrame:
        """``slot``, ``_no`` and ``rank``: the schedule, and at its end what few slots a source still lacks."""
        total, block = sum(self.words), self.block
        n = -(-total // block)
        ends = np.cumsum(self.targets) / max(1.0, sum(self.targets))

        def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
            slot = batch["id"].to_numpy()
            point = (slot % CYCLE) * STEP % CYCLE / CYCLE
            at = np.minimum(np.searchsorted(ends, point, side="right"), len(ends) - 1)
            return pa.RecordBatch.from_arrays([batch["id"], pa.array(at.astype(np.int32))], ["slot", "_no"])

        points = map_batches(self.spark.range(n), pick, "slot long, _no int")
        ranked = ranked_within(points, ["_no"], ["slot"], F.floor(F.col("slot") / SLOTS_IN_CHUNK), F.lit(1).cast("long"), "rank")
        need = [-(-w // block) for w in self.words]
        needed = F.broadcast(self.spark.createDataFrame(list(enumerate(need)), "_n int, _need long")) if need else None
        if needed is None:
            return ranked
        ranked = self.work.keep(ranked.join(needed, F.col("_no") == F.col("_n")).where("rank < _need").select("slot", "_no", "rank"), "slots")
        had = {r["_no"]: r["count"] for r in ranked.groupBy("_no").count().collect()}  # a row for each source
        short, at = [], n
        for no, most in enumerate(need):
            if (have := had.get(no, 0)) < most:
                short.append((at, no, have, most))
                at += most - have
        late = self.spark.createDataFrame(short, "_at long, _no int, _from long, _to long")
        late = late.select("_no", "_at", "_from", F.explode(F.sequence("_from", F.col("_to") - 1)).alias("rank"))
        return ranked.unionByName(late.select((F.col("_at") + F.col("rank") - F.col("_from")).alias("slot"), "_no", "rank"))

    def pieces(self) -> DataFrame:
        """The mix itself: ``slot``, ``_row``, the id, ``pass`` (from 0), ``first_word`` (from 0) and ``words``."""
        block = F.lit(self.block)
        passes = self.placed().where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))))
        low = F.col("_start") + F.col("pass") * F.col("source_size")
        high = F.least(low + F.col("size"), F.col("_words"))
        cut = passes.select("_row", self.id, "_no", "pass", low.alias("_low"), high.alias("_high")).where("_low < _high")
        last = F.floor((F.col("_high") - 1) / block)
        blocks = cut.withColumn("_rank", F.explode(F.sequence(F.floor(F.col("_low") / block), last)))
        begin = F.greatest("_low", F.col("_rank") * block)
        slots = self.slots().withColumnRenamed("_no", "_slot_no")
        return blocks.join(slots, (F.col("_no") == F.col("_slot_no")) & (F.col("_rank") == F.col("rank"))).select(
            "slot",
            "_row",
            self.id,
            "pass",
            (begin - F.col("_low")).alias("first_word"),
            (F.least("_high", (F.col("_rank") + 1) * block) - begin).alias("words"),
        )

    def taken(self) -> DataFrame:
        """Per row: id, ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes of it."""
        sums = self.pieces().groupBy(F.col("_row").alias("_taken_row")).agg(F.sum("words").alias("taken"))
        rows = self.rows.select("_row", self.id, "source", "size").join(self.sources, F.col("source").eqNullSafe(F.col("_source")))
        return rows.join(sums, F.col("_row") == F.col("_taken_row"), "left").select(
            self.id, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
        )

    def documents(self) -> DataFrame:
        """The kept columns of the mixed rows, one row for each pass; of a pass that is cut short, the leading words."""
        sums = self.pieces().groupBy(F.col("_row").alias("_taken_row"), "pass").agg(F.sum("words").alias("_taken"))
        rows = self.rows.join(sums, F.col("_row") == F.col("_taken_row"))
        words = F.slice(F.regexp_extract_all(F.col("_kept_text"), F.lit(f"({WORD})"), 1), 1, F.col("_taken").cast("int"))
        text = F.when(F.col("_taken") == F.col("size"), F.col("_kept_text")).otherwise(F.array_join(words, " "))
        out = {c: F.col(f"_kept_{c}") for c in self.kept} | {"text": text}
        if "n_chars" in out:
            out["n_chars"] = F.char_length(text).cast("long")
        return rows.select(*(v.alias(k) for k, v in out.items()))


def op8_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).taken()
