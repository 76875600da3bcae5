"""Removal of byte strings that an earlier document has too, by blockwise suffix sorting.

A window (a string of ``window`` bytes) is removed from a document if it also starts in a document with a smaller id.
Comparing all suffixes of a corpus with each other would shuffle each byte many times over, so the work is narrowed first
without losing a match:

1. Every window holds an anchor, the substring of GRAM bytes with the least hash. Equal windows hold the same anchor at
   the same distance. Neighbouring windows with one anchor make a run; its span is the bytes they cover. Runs are shuffled
   by anchor. A run whose whole span occurs around the same anchor in an earlier document is settled: all its windows go.
2. Of the runs left, those whose anchor occurs in other spans are open. Their suffixes are sorted, one bucket of suffixes
   (by first byte) at a time, in blocks of spans that lie together by anchor. Suffixes are compared by their first V bytes;
   longer ties are settled by the precomputed rank of the next position of a difference-cover sample (and the last bytes of
   the window, which that rank may not reach), so a bucket needs a few numbers for each suffix, however long ties are.
   Spans are laid out with anchors at multiples of V: suffixes that may be equal then have their next sample at the same
   distance.
3. Where the spans of one anchor fill more than a block, the equal strings of the blocks are merged by their digests.

A copy inside one batch of documents is settled there, so a passage that a third of all documents share sends one row for
each batch to the shuffle. Nothing is held but one batch of documents or spans.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import binary_values, flat_bytes, flat_values, map_batches, mix64, release, slices, table, texts_as_bytes
from casebook.sources.work import Work

#: Bytes of an anchor.
GRAM = 16
#: Depth to which suffixes are compared byte by byte, and a difference cover of it: the differences of these residues
#: modulo V give every residue.
V, COVER = 16, (0, 1, 2, 5, 8)
#: Bytes of texts hashed at once: what is computed for them stays in a core's cache.
HASHED_BYTES = 1 << 17
_B = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_U = np.uint64


def _gram_hashes(flat: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each position on (fewer positions than bytes, by length - 1)."""
    doubled, size, done, out = flat.astype(np.uint64) + _U(1), 1, 0, None
    while True:
        if length & size:
            n = flat.size - done - size + 1
            out = doubled[:n].copy() if out is None else out[:n] * _U(pow(_B, size, 1 << 64)) + doubled[done : done + n]
            done += size
        if done == length:
            return mix64(out)
        doubled = doubled[: doubled.size - size] * _U(pow(_B, size, 1 << 64)) + doubled[size:]
        size *= 2


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


@functools.cache
def _common_powers(base: int) -> np.ndarray:
    return _powers(base, 2 * HASHED_BYTES)


def _powers_of(base: int, n: int) -> np.ndarray:
    return _common_powers(base)[:n] if n <= 2 * HASHED_BYTES else _powers(base, n)


_BYTES = mix64(np.arange(256, dtype=np.uint64) + _U(77))


def _span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, whatever its place."""
    sums = np.zeros(flat.size + 1, np.uint64)
    np.cumsum(_BYTES[flat] * _powers_of(_B, flat.size + 1)[:-1], out=sums[1:])
    back = _powers_of(pow(_B, -1, 1 << 64), flat.size + 1)
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def runs(texts: list[bytes], window: int) -> dict[str, np.ndarray]:
    """The runs of windows with one anchor: text ``n``, first window ``lo``, how many ``count``, anchor's distance from
    the first window ``at``, the ``anchor``'s hash and a hash of the ``span``."""
    return _runs(*flat_bytes(texts), window)


def _runs(flat: np.ndarray, offsets: np.ndarray, window: int) -> dict[str, np.ndarray]:
    grams = window - GRAM + 1
    empty = {k: np.zeros(0, np.int64) for k in ("n", "lo", "count", "at")} | {k: np.zeros(0, np.uint64) for k in ("anchor", "span")}
    if flat.size < window:
        return empty
    hashes = _gram_hashes(flat, GRAM)
    # the upper bits of the hash, then the position: the least is the leftmost of the least hash
    bits = max(26, int(hashes.size).bit_length())
    least = (hashes >> _U(bits) << _U(bits)) | np.arange(hashes.size, dtype=np.uint64)
    size = 1
    while size * 2 <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < grams:
        least = np.minimum(least[: least.size - (grams - size)], least[grams - size :])
    of = np.repeat(np.arange(offsets.size - 1), np.diff(offsets))[: least.size]
    valid = np.arange(least.size) + window <= offsets[of + 1]
    starts = np.flatnonzero(valid)
    if not starts.size:
        return empty
    anchor = (least[starts] & _U((1 << bits) - 1)).astype(np.int64)
    new = np.ones(starts.size, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (of[starts[1:]] != of[starts[:-1]])
    first = np.flatnonzero(new)
    lo, count = starts[first], np.diff(np.append(first, starts.size))
    anchor, n = anchor[first], of[starts[first]]
    at = anchor - lo
    span = _span_hashes(flat, lo, lo + count - 1 + window)
    return {"n": n, "lo": lo - offsets[n], "count": count, "at": at, "anchor": hashes[anchor], "span": mix64(span + at.astype(np.uint64) * _U(_B))}


def found_runs(docs: DataFrame, window: int) -> DataFrame:
    """``key`` (the anchor; something else for settled runs), ``doc``, ``lo`` and ``packed``: 51 bits of the span's hash,
    then the number of windows, the anchor's distance (6 bits each) and whether the run is settled. This is what is
    shuffled, so it is kept narrow."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t", 3 << 20):
            pieces, rows = [], 0
            for piece in slices(part, "t", HASHED_BYTES):
                own = _runs(*flat_values(piece["t"]), window)
                own["n"] = own["n"] + rows
                rows += piece.num_rows
                pieces.append(own)
            found = {c: np.concatenate([p[c] for p in pieces]) for c in pieces[0]}
            if not found["n"].size:
                continue
            doc = part["i"].to_numpy()[found["n"]]
            # within this batch only the earliest document with a span goes on
            order = np.lexsort((doc, found["span"], found["anchor"]))
            same = np.zeros(order.size, bool)
            same[1:] = (found["span"][order[1:]] == found["span"][order[:-1]]) & (found["anchor"][order[1:]] == found["anchor"][order[:-1]])
            group = np.cumsum(~same) - 1
            sure = np.zeros(order.size, bool)
            sure[order] = doc[order] > doc[order[np.flatnonzero(~same)]][group]
            key = np.where(sure, mix64(doc.astype(np.uint64) * _U(_B) + found["lo"].astype(np.uint64)), found["anchor"])
            packed = (found["span"] >> _U(13) << _U(13)) | ((found["count"] << 7) | (found["at"] << 1) | sure).astype(np.uint64)
            columns = [key.view(np.int64), doc, found["lo"], packed.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc", "lo", "packed"])

    return map_batches(docs.select("i", "t"), run, "key long, doc long, lo long, packed long")


def one_text(docs: DataFrame, work: Work) -> tuple[DataFrame, DataFrame | None]:
    """``i`` and ``t`` of the rows that take part: those with an id, and where an id repeats with several texts, the
    rows with one of them (the least by hash). Also such ids (``_several``, ``_low``), None if there are none."""
    rows = docs.where(docs["doc_id"].isNotNull()).select(docs["doc_id"].cast("long").alias("i"), docs["text"].cast("string").alias("t"))
    several = rows.groupBy("i").agg(F.min(F.xxhash64("t")).alias("_low"), F.max(F.xxhash64("t")).alias("_high")).where("_low < _high")
    several = work.keep(several.select(F.col("i").alias("_several"), "_low"), "several")
    if not several.take(1):
        return rows, None
    rows = rows.join(several, F.col("i") == F.col("_several"), "left")
    return rows.where(F.col("_low").isNull() | (F.xxhash64("t") == F.col("_low"))).select("i", "t"), several


def cover_ranks(flat: np.ndarray, positions: np.ndarray, length: int) -> np.ndarray:
    """For each sample position the rank of the ``length`` bytes there among all of them; equal strings share one."""
    words = [_big_endian(flat, positions + k, min(8, length - k)) for k in range(0, length, 8)]
    order = np.lexsort(words[::-1])
    new = np.zeros(order.size, bool)
    for w in words:
        new[1:] |= w[order[1:]] != w[order[:-1]]
    ranks = np.empty(order.size, np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _big_endian(flat: np.ndarray, positions: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(positions.size, np.uint64)
    for k in range(size):
        out = (out << _U(8)) | flat[positions + k].astype(np.uint64)
    return out


def equal_windows(flat: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """A number for each start such that windows are equal if their numbers are. ``flat`` is padded with V + window bytes;
    windows that may be equal start at the same residue modulo V."""
    middle = window - V
    ahead = np.array([min((c - r) % V for c in COVER) for r in range(V)])  # to the next sample, by residue
    asked = np.zeros(flat.size + V, bool)
    asked[starts + ahead[starts % V]] = True
    samples = np.flatnonzero(asked)
    rank_at = np.zeros(flat.size + V, np.int64)
    rank_at[samples] = cover_ranks(flat, samples, middle)
    numbers, given = np.empty(starts.size, np.int64), 0
    for bucket in np.unique(flat[starts]):  # one bucket of suffixes at a time
        own = np.flatnonzero(flat[starts] == bucket)
        at = starts[own]
        keys = [
            _big_endian(flat, at, 8),
            _big_endian(flat, at + 8, V - 8),
            at % V,
            rank_at[at + ahead[at % V]],
            _big_endian(flat, at + middle, 8),
            _big_endian(flat, at + middle + 8, V - 8),
        ]
        order = np.lexsort(keys[::-1])
        new = np.zeros(order.size, bool)
        for k in keys:
            new[1:] |= k[order[1:]] != k[order[:-1]]
        numbers[own[order]] = np.cumsum(new) + given
        given += int(new.sum()) + 1
    return numbers


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` items in turn: which it belongs to and its number there."""
    of = np.repeat(np.arange(counts.size), counts)
    return of, np.arange(of.size) - np.repeat(np.cumsum(counts) - counts, counts)


def _repeated(flat: np.ndarray, starts: np.ndarray, keys: np.ndarray, window: int) -> np.ndarray:
    """The places in ``starts`` of windows that may occur twice with one key: those whose hash does."""
    hashes = _gram_hashes(flat, window)[starts] + keys
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(starts.size, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def settle_block(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """Windows of open runs that an earlier document has, as runs ``lo`` and ``count``: for anchors that lie wholly in this
    block (sorted by anchor) all of them, for the first and the last anchor also each window left with its digest.

    Windows whose hash occurs once with their anchor are no others' equals; only the suffixes of the rest are sorted.
    """
    key, doc, lo = (batch[c].to_numpy() for c in ("key", "doc", "lo"))
    count, at = batch["count"].to_numpy().astype(np.int64), batch["at"].to_numpy().astype(np.int64)
    spans, offsets = flat_values(batch["bytes"])
    lead = (-at) % V  # so that each anchor is at a multiple of V
    sizes = lead + count - 1 + window
    slots = -(-sizes // V) * V
    begins = np.cumsum(slots) - slots
    flat = np.zeros(int(slots.sum()) + 2 * (V + window), np.uint8)
    flat[np.arange(spans.size) + np.repeat(begins + lead - offsets[:-1], np.diff(offsets))] = spans
    of, step = _spread(count)
    starts = begins[of] + lead[of] + step
    own = _repeated(flat, starts, mix64(key.view(np.uint64))[of], window)
    numbers = equal_windows(flat, starts[own], window)
    # equal windows count only within an anchor: a chance likeness elsewhere has runs of its own
    docs, keys = doc[of[own]], key[of[own]]
    order = np.lexsort((docs, keys, numbers))
    new = np.ones(order.size, bool)
    new[1:] = (numbers[order[1:]] != numbers[order[:-1]]) | (keys[order[1:]] != keys[order[:-1]])
    least = docs[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
    gone = np.zeros(starts.size, bool)
    gone[own[order]] = docs[order] > least
    # neighbouring windows that go are one row
    first = gone.copy()
    first[1:] &= ~gone[:-1] | (of[1:] != of[:-1])
    last = gone.copy()
    last[:-1] &= ~gone[1:] | (of[:-1] != of[1:])
    heads, tails = np.flatnonzero(first), np.flatnonzero(last)
    edge = np.flatnonzero(~gone & ((key[of] == key[0]) | (key[of] == key[-1])))
    digests = [hashlib.blake2b(flat[n : n + window], digest_size=16).digest() for n in starts[edge]]
    rows = np.concatenate([heads, edge])
    columns = [
        pa.array(doc[of[rows]]),
        pa.array(lo[of[rows]] + step[rows]),
        pa.array(np.concatenate([tails - heads + 1, np.ones(edge.size, np.int64)]).astype(np.int32)),
        pa.concat_arrays([pa.nulls(heads.size, pa.binary()), pa.array(digests, pa.binary())]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc", "lo", "count", "digest"])


def _span_bytes(rows: DataFrame, window: int) -> DataFrame:
    """The bytes of the open runs, from the texts of their documents."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t", 1 << 20):
            flat, offsets = flat_values(part["t"])
            of = np.repeat(np.arange(part.num_rows), pc.list_value_length(part["runs"]).to_numpy())
            runs = part["runs"].flatten()
            key, lo, packed = (runs.field(c).to_numpy() for c in ("key", "lo", "packed"))
            count, at = packed >> 7 & 63, packed >> 1 & 63
            spans = binary_values(flat, offsets[of] + lo, count - 1 + window)
            arrays = [pa.array(key), pa.array(part["i"].to_numpy()[of]), pa.array(lo), pa.array(count.astype(np.int16)), pa.array(at.astype(np.int16)), spans]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "doc", "lo", "count", "at", "bytes"])

    return map_batches(rows, run, "key long, doc long, lo long, count short, at short, bytes binary")


def repeated_windows(docs: DataFrame, window: int = 50, work: Work | None = None) -> DataFrame:
    """``doc``, ``lo`` and ``count``: runs of windows that an earlier document has. ``docs`` has ``i`` and ``t``."""
    if not max(2 * V, GRAM) <= window <= GRAM + 62:
        raise ValueError(f"a window has {2 * V} to {GRAM + 62} bytes")
    spark = docs.sparkSession
    work = work or Work(spark)
    # one shuffle serves both windows
    rows = found_runs(docs, window).repartition("key").withColumn("span", F.shiftright("packed", 1))
    rows = rows.withColumn("first", F.min("doc").over(Window.partitionBy("key", "span")))
    by_key = Window.partitionBy("key")
    rows = rows.withColumn("low", F.min("first").over(by_key)).withColumn("high", F.max("first").over(by_key))
    settled = (F.col("packed").bitwiseAND(1) == 1) | (F.col("doc") > F.col("first"))
    judged = rows.withColumn("settled", settled).where(F.col("settled") | (F.col("low") < F.col("high")))
    judged = work.keep(judged.select("key", "doc", "lo", "packed", "settled"), "judged")
    del rows
    release(spark)
    unsettled = judged.where(~F.col("settled")).groupBy("doc").agg(F.collect_list(F.struct("key", "lo", "packed")).alias("runs"))
    spans = _span_bytes(docs.join(unsettled, F.col("i") == F.col("doc")).select("i", "t", "runs"), window)
    spans = spans.repartition("key").sortWithinPartitions("key", "doc")
    blocks = work.keep(map_batches(spans, lambda b: settle_block(b, window), "doc long, lo long, count int, digest binary"), "blocks")
    del spans
    release(spark)
    edges = blocks.where("digest is not null")
    least = edges.groupBy("digest").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select(F.col("digest").alias("_d"), "least")
    merged = edges.join(least, F.col("digest") == F.col("_d")).where("doc > least")
    met = blocks.where("digest is null").select("doc", "lo", "count").unionByName(merged.select("doc", "lo", "count"))
    count = F.shiftright("packed", 7).bitwiseAND(63).cast("int")
    return judged.where("settled").select("doc", "lo", count.alias("count")).unionByName(met)


def covered_bytes(size: int, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` bytes the windows cover."""
    change = np.zeros(size + 1, np.int64)
    ends = np.minimum(starts + counts - 1 + window, size)
    np.add.at(change, np.minimum(starts, size), 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(docs: DataFrame, window: int = 50, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns of every row, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (the bytes
    that are left).

    Rows with a null id take no part: nothing is removed from them or because of them. A null text is empty. Rows that
    repeat an id are no earlier documents for each other; where they differ in text, those with one of the texts take part.
    """
    work = Work(docs.sparkSession)
    usable, several = one_text(docs, work)
    found = repeated_windows(usable, window, work)
    mine = found.groupBy("doc").agg(F.collect_list(F.struct("lo", "count")).alias("gone"))
    same = F.col("_i") == F.col("doc")
    if several is not None:
        mine = mine.join(several, F.col("doc") == F.col("_several"), "left")
        same = same & (F.col("_low").isNull() | (F.xxhash64("_t") == F.col("_low")))
    texts = docs.select(docs["doc_id"].cast("long").alias("_i"), docs["text"].cast("string").alias("_t"), *(docs[c].alias(f"_c{n}") for n, c in enumerate(columns)))
    rows = texts.join(mine, same, "left").drop("doc", "_i", "_several", "_low")
    schema = T.StructType(list(docs.select(*columns).schema.fields))
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "binary")):
        schema = schema.add(name, kind)

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "_t"):
            out = []
            gone = part["gone"].flatten()
            lo, count = gone.field("lo").to_numpy(), gone.field("count").to_numpy().astype(np.int64)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(part["gone"]), 0).to_numpy())
            for text, begin, end in zip(texts_as_bytes(part["_t"]), np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
                if begin < end:
                    mask = covered_bytes(len(text), lo[begin:end], count[begin:end], window)
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                else:
                    spans, kept = 0, text
                out.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [*(part[f"_c{n}"] for n in range(len(columns))), *(pa.array([r[n] for r in out], kinds[n]) for n in range(5))]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_batches(rows, run, schema)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
