"""Packing documents into sequences of at most ``max_tokens`` tokens by patterns.

Only the histogram of lengths is needed to decide what goes together, and it has at most ``max_tokens`` entries however
many documents there are. The driver enumerates patterns of a few (rounded) lengths that fill a sequence, fits how often
each is used to the histogram by non-negative least squares, rounds these counts to what is there, and packs what is
left by best fit, again by length and count. The plan says which ranks of each length go to which sequences; Spark ranks
the pieces of each length and looks their places up.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import map_batches, ranked_within, slices, table
from casebook.llm.word_ids import word_ids
from casebook.sources.work import Work

#: Lengths are rounded up to one of so many classes when patterns are enumerated.
CLASSES = 256
#: Documents in an enumerated pattern at most.
PATTERN_DOCS = 3
#: Pieces sorted in one task while ranks are given.
CHUNK_ROWS = 20_000


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """The x >= 0 with the least |a x - b| (active-set method of Lawson and Hanson)."""
    m, n = a.shape
    x, passive = np.zeros(n), np.zeros(n, bool)
    target = a.T @ b
    for _ in range(rounds or 3 * m):
        gain = a.T @ (b - a @ x)
        gain[passive] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * max(1.0, float(np.abs(b).max(initial=0))):
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            own = a[:, at]
            solved = np.linalg.solve(own.T @ own + 1e-10 * np.eye(at.size), target[at])
            if (solved > 0).all():
                x[:] = 0
                x[at] = solved
                break
            low = solved <= 0
            old = x[at]
            step = float(np.min(old[low] / np.maximum(old[low] - solved[low], 1e-300)))
            old = old + step * (solved - old)
            old[low & (old <= 1e-12)] = 0
            x[at] = old
            if (gone := at[old <= 0]).size == 0:
                gone = at[low][:1]
            x[gone] = 0
            passive[gone] = False
    return x


def patterns(present: np.ndarray, full: int, most: int) -> list[tuple[int, ...]]:
    """Descending tuples of up to ``most`` of the classes ``present`` whose sum is ``full``, or less than a fiftieth
    below it when no class fills the gap."""
    classes = [int(c) for c in present[::-1]]
    found: set[tuple[int, ...]] = set()

    def grow(head: tuple[int, ...], left: int, start: int) -> None:
        fits = [n for n in range(start, len(classes)) if classes[n] <= left]
        if not fits:
            found.add(head)
        elif len(head) == most - 1:
            found.add((*head, classes[fits[0]]))
        else:
            for n in fits:
                grow((*head, classes[n]), left - classes[n], n)

    grow((), full, 0)
    return sorted((f for f in found if 50 * sum(f) > 49 * full), reverse=True)


@dataclass
class Plan:
    """Runs of ranks, sorted by (length, first): rank r of a run goes to sequence ``sequence + r - first`` at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = np.int64(1) << np.int64(44)
        run = np.searchsorted(self.length * wide + self.first, lengths * wide + ranks, side="right") - 1
        return self.sequence[run] + ranks - self.first[run], self.offset[run]


def plan_packing(counts: np.ndarray, max_tokens: int, classes: int = CLASSES, pattern_docs: int = PATTERN_DOCS) -> Plan:
    """``counts[n]``: pieces of n tokens, for n from 1 to ``max_tokens``."""
    step = -(-max_tokens // classes)
    full = max_tokens // step
    left = counts.astype(np.int64).copy()
    groups: list[tuple[list[int], int]] = []  # lengths in a sequence, and how many such sequences
    groups_at: dict[int, list[int]] = {}  # free tokens -> groups

    def add(lengths: list[int], times: int) -> None:
        groups_at.setdefault(max_tokens - sum(lengths), []).append(len(groups))
        groups.append((lengths, times))

    class_of = -(-np.arange(max_tokens + 1) // step)
    class_of[max_tokens] = full  # a whole sequence also where rounding up would go beyond it
    by_class = np.bincount(class_of[1:], weights=left[1:], minlength=full + 2)
    present = np.flatnonzero(by_class[: full + 1] > 0)
    present = present[present > 0]
    if present.size:
        options = patterns(present, full, pattern_docs) or [(full,)]
        matrix = np.zeros((full + 1, len(options)))
        for n, option in enumerate(options):
            for c in option:
                matrix[c, n] += 1
        fitted = nnls(matrix[present], by_class[present] / by_class.sum()) * by_class.sum()
        inside = [np.flatnonzero(class_of == c)[::-1] for c in range(full + 1)]
        for n in np.argsort(-fitted):
            option = options[n]
            need: dict[int, int] = {}
            for c in option:
                need[c] = need.get(c, 0) + 1
            times = min(int(round(fitted[n])), *(int(left[inside[c]].sum()) // k for c, k in need.items()))
            while times > 0:  # the longest of a class first, the last as long as fits; as many alike at once as there are
                lengths, taken = [], np.zeros_like(left)
                for c in option[:-1]:
                    own = inside[c][left[inside[c]] > taken[inside[c]]]
                    lengths.append(int(own[0]) if own.size else 0)
                    taken[lengths[-1]] += 1
                room = max_tokens - sum(lengths)
                fits = np.flatnonzero(left[: room + 1] > taken[: room + 1])
                lengths.append(int(fits[-1]) if fits.size else 0)
                taken[lengths[-1]] += 1
                if taken[0] or lengths[-1] <= (option[-1] - 1) * step:
                    break
                alike = min([times, *(int(left[x] // taken[x]) for x in np.flatnonzero(taken))])
                left -= taken * alike
                add(lengths, alike)
                times -= alike
    for n in range(max_tokens, 0, -1):  # best fit for the rest, longest first
        rest = int(left[n])
        for free in sorted(f for f in groups_at if f >= n):
            while rest and free - n >= 0 and groups_at.get(free):
                g = groups_at[free].pop()
                lengths, times = groups[g]
                copies = min(free // n, -(-rest // times)) if times <= rest else 1
                used = min(times, rest // copies) or 1
                groups[g] = (lengths, times - used)
                if times - used:
                    groups_at[free].append(g)
                add([*lengths, *[n] * copies], used)
                rest -= used * copies
            if not rest:
                break
        if rest:
            each = max_tokens // n
            if rest // each:
                add([n] * each, rest // each)
            if rest % each:
                add([n] * (rest % each), 1)
        left[n] = 0
    runs, given, base = [], np.zeros(max_tokens + 1, np.int64), 0
    for lengths, times in groups:
        if not times:
            continue
        offset = 0
        for n in lengths:
            runs.append((n, int(given[n]), base, offset))
            given[n] += times
            offset += n
        base += times
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4).T.copy()
    return Plan(*columns, base)


def tokenized_pieces(docs: DataFrame, model: str, max_tokens: int, end_id: int = 1, ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece of a row: id, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32`` and, if asked for, the ``ids``.

    A row's tokens are its text's and then ``end_id``; only rows of more than ``max_tokens`` are cut. A null text counts
    as empty (one piece of one token); repeated rows and null ids stay.
    """
    schema = f"{id_col} long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids

    def run(batch: pa.RecordBatch):
        known = word_ids(model)
        end, width = np.array([end_id], "<u4").tobytes(), 4 * max_tokens
        for part in slices(batch, "t"):
            rows: list[tuple] = []
            for key, text in zip(part["i"].to_pylist(), part["t"].to_pylist(), strict=True):
                tokens = known.of(text or "") + end
                for n, at in enumerate(range(0, len(tokens), width)):
                    own = tokens[at : at + width]
                    rows.append((key, n, at // 4, len(own) // 4, zlib.crc32(own), np.frombuffer(own, "<u4") if ids else None))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            names = (id_col, "piece", "start", "length", "ids_crc32", "ids")
            keep = 5 + ids
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in range(keep)], names[:keep])

    return map_batches(docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].cast("string").alias("t")), run, schema)


def pack(pieces: DataFrame, max_tokens: int, id_col: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (id, ``piece``, ``length`` from 1 to ``max_tokens``).

    ``pieces`` is read three times and should be a written table. Equal rows may trade places, which changes nothing.
    """
    found = pieces.groupBy("length").count().collect()  # at most max_tokens rows
    counts = np.zeros(max_tokens + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["count"]
    plan = plan_packing(counts, max_tokens)
    chunks = max(1, int(counts.sum()) // CHUNK_ROWS)
    spread = F.pmod(F.xxhash64(id_col, "piece"), F.lit(chunks))
    ranked = ranked_within(pieces, ["length"], [id_col, "piece"], spread, F.lit(1).cast("long"), "_rank")
    names = pieces.columns
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sequence, offset = plan.places(batch["length"].to_numpy(), batch["_rank"].to_numpy())
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return map_batches(ranked, run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, for pieces that were made with their ids."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda s: s["ids"])).alias("ids"))


def packed_documents(docs: DataFrame, model: str, max_tokens: int, end_id: int = 1) -> DataFrame:
    """Tokenizes and packs; the pieces are written once."""
    work = Work(docs.sparkSession)
    return pack(work.keep(tokenized_pieces(docs, model, max_tokens, end_id), "pieces"), max_tokens)


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096)
