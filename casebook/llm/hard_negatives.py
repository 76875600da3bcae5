"""Hard negatives by rotated one-bit codes and deterministic score intervals.

Rows are laid in blocks of about BLOCK rows that lie together by label. A block has a centre c; a row x keeps, of the rotated
residual r = R(x - c): its length, the signs of its components as packed bits (the code, a unit vector o of components
+-1/sqrt(d)) and the stored alignment a = <o, r> / |r|. For an anchor q with rotated q' = Rq

    <x, q> = <c, q> + <r, q'>   and   r = |r| (a o + sqrt(1 - a^2) w)   with w a unit vector orthogonal to o,

so with t = <o, q'> the score lies within |r| sqrt(1 - a^2) sqrt(|q|^2 - t^2) of <c, q> + |r| a t (Cauchy-Schwarz on w). t comes from
population counts: q' is rounded to PLANES bits a component, and each bit plane is counted against the code; what the rounding
lost is a vector whose length is known and widens the interval. The interval holds for every row, so rows outside what
is asked for are left out without loss; all others are scored as integers.

Anchors, in blocks too, meet every block of rows: first to find their positives, then the negatives for the score range of
each positive. A task holds one block of either kind.

Rows with a null label, a null vector or a null or non-finite component take no part. Vectors of different lengths are not
compared. Equal rows count once; rows that share an id but differ are rows of their own, and rows with the anchor's id
are not its candidates. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm.common import table
from casebook.sources.work import Work

#: Rows of a block of rows and of a block of anchors; anchors that are estimated at once.
BLOCK, ANCHORS, AT_ONCE = 8192, 1024, 64
#: Bits of a rounded component of an anchor.
PLANES = 6
#: Relative slack for the rounding of the estimates themselves.
SLACK = 1e-6


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Codes, lengths and alignments of the rows of a block."""

    def __init__(self, vectors: np.ndarray):
        n, self.dim = vectors.shape
        self.centre = vectors.mean(0)
        turned = (vectors - self.centre) @ rotation(self.dim).T
        self.length = np.sqrt((turned * turned).sum(1))
        bits = turned >= 0
        packed = np.zeros((n, -(-self.dim // 64) * 8), np.uint8)
        own = np.packbits(bits, axis=1, bitorder="little")
        packed[:, : own.shape[1]] = own
        self.codes = np.ascontiguousarray(packed.view("<u8").T)
        self.alignment = np.abs(turned).sum(1) / np.sqrt(self.dim) / np.maximum(self.length, 1e-300)
        self.apart = np.sqrt(np.maximum(0.0, 1 - self.alignment**2))

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of ``anchors`` with all rows: two tables, a row for each anchor."""
        turned = anchors @ rotation(self.dim).T
        size = np.sqrt((anchors * anchors).sum(1))
        low = turned.min(1)
        step = np.maximum((turned.max(1) - low) / ((1 << PLANES) - 1), 1e-300)
        rounded = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        lost = turned - (low[:, None] + step[:, None] * rounded)
        off = np.sqrt((lost * lost).sum(1))
        counted = np.zeros((len(anchors), self.length.size), np.int64)
        for plane in range(PLANES):
            bits = np.zeros((len(anchors), self.codes.shape[0] * 8), np.uint8)
            own = np.packbits(((rounded >> plane) & 1).astype(np.uint8), axis=1, bitorder="little")
            bits[:, : own.shape[1]] = own
            for word, mask in zip(self.codes, bits.view("<u8").T, strict=True):
                counted += np.bitwise_count(word[None, :] & mask[:, None]).astype(np.int64) << plane
        ones = np.bitwise_count(self.codes).sum(0).astype(np.int64)
        signed = low[:, None] * (2 * ones - self.dim)[None, :] + step[:, None] * (2 * counted - rounded.sum(1)[:, None])
        t = signed / np.sqrt(self.dim)
        off = off[:, None] + SLACK * size[:, None]
        rest = np.sqrt(np.maximum(0.0, (size**2)[:, None] - np.maximum(0.0, np.abs(t) - off) ** 2)) * self.apart
        middle = (anchors @ self.centre)[:, None]
        reach = size[:, None] * self.length[None, :]
        slack = SLACK * (reach + np.abs(middle) + 1)
        lows = middle + np.maximum(-reach, self.length * (self.alignment * (t - off) - rest)) - slack
        highs = middle + np.minimum(reach, self.length * (self.alignment * (t + off) + rest)) + slack
        return lows, highs


def integer_scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    largest = lambda x: max(float(x.max(initial=0)), -float(x.min(initial=0)))
    most = largest(rows) * largest(anchor) * max(1, anchor.size)
    if most < 2**53:  # a double holds every sum
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return rows @ anchor


def _packed(rows: DataFrame, size: int, longs: tuple[str, ...], lists: tuple[str, ...]) -> DataFrame:
    """Rows as blocks of up to ``size`` rows of one dim: ``block``, ``dim`` and every named column as packed 64-bit numbers.
    Partitions are sorted by dim; a list has the same length in all rows of a dim."""
    schema = "block long, dim int, " + ", ".join(f"{c} binary" for c in (*longs, *lists))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32

        def block(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            number += 1
            data = [part[c].to_numpy().astype(np.int64).tobytes() for c in longs]
            data += [part[c].combine_chunks().flatten().to_numpy().astype(np.int64).tobytes() for c in lists]
            arrays = [pa.array([number]), pa.array([part["dim"][0].as_py()], pa.int32()), *(pa.array([d], pa.binary()) for d in data)]
            return pa.RecordBatch.from_arrays(arrays, ["block", "dim", *longs, *lists])

        def cut(held: pa.Table, last: bool) -> Iterator[pa.RecordBatch | pa.Table]:
            while held.num_rows:
                other = np.flatnonzero(held["dim"].to_numpy() != held["dim"][0].as_py())
                stop = min(size, int(other[0]) if other.size else held.num_rows)
                if stop == held.num_rows < size and not last:
                    break
                yield block(held.slice(0, stop))
                held = held.slice(stop)
            yield held

        held = None
        for batch in batches:
            one = pa.Table.from_batches([batch])
            *done, held = cut(one if held is None else pa.concat_tables([held, one]), False)
            yield from done
        if held is not None:
            yield from list(cut(held, True))[:-1]

    return rows.select("dim", *longs, *lists).mapInArrow(run, schema)


def _numbers(data: bytes, width: int | None = None) -> np.ndarray:
    own = np.frombuffer(data, np.int64)
    return own if width is None else own.reshape(-1, width)


def _cells(anchors: DataFrame, blocks: DataFrame, fn: Callable[[dict, dict, Codes], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn(anchors, rows, codes of the rows)`` for every block of anchors with every block of rows of the same dim."""
    cells = anchors.select("dim", F.col("block").alias("a_block")).join(blocks.select("dim", "block"), "dim").select("a_block", "block")
    own = [F.col(c).alias(f"a_{c}") for c in anchors.columns if c != "dim"]
    # files of blocks are small for what they hold, and a block of anchors is needed once for each block of rows: by the
    # estimate of its size Spark would broadcast that
    sent = cells.join(anchors.select(*own).hint("merge"), "a_block").drop("a_block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch[c][n].as_py() for c in batch.schema.names}
                if row["block"] != last:
                    v = _numbers(row["v"], row["dim"])
                    held = {c: _numbers(row[c]) for c in ("id", "row", "label")} | {"v": v}, Codes(v.astype(np.float64))
                    last = row["block"]
                out = fn(row, *held)
                if out is not None:
                    yield out

    return sent.join(blocks.hint("merge"), "block").mapInArrow(run, schema)


def _estimated(row: dict, codes: Codes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, vector and score intervals of each anchor of a block."""
    v = _numbers(row["a_v"], row["dim"])
    for begin in range(0, len(v), AT_ONCE):
        lows, highs = codes.intervals(v[begin : begin + AT_ONCE].astype(np.float64))
        for k in range(len(lows)):
            yield begin + k, v[begin + k], lows[k], highs[k]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, values.size - k)[values.size - k] if values.size >= k else -np.inf


def _best(scores: np.ndarray, rows: dict, at: np.ndarray, most: int) -> np.ndarray:
    """Which of the scored rows ``at`` are the best, in order."""
    return np.lexsort((rows["row"][at], rows["id"][at], -scores))[:most]


def best_alike(row: dict, rows: dict, codes: Codes, most: int) -> pa.RecordBatch | None:
    """The best rows of each anchor's own label in a block."""
    ids, keys, labels = (_numbers(row[c]) for c in ("a_id", "a_row", "a_label"))
    if not np.isin(labels, rows["label"]).any():
        return None
    out = []
    for n, anchor, lows, highs in _estimated(row, codes):
        own = np.flatnonzero((rows["label"] == labels[n]) & (rows["id"] != ids[n]))
        at = own[highs[own] >= _kth(lows[own], most)]
        scores = integer_scores(rows["v"][at], anchor)
        best = _best(scores, rows, at, most)
        out.append((np.full(best.size, ids[n]), np.full(best.size, keys[n]), rows["id"][at[best]], rows["row"][at[best]], scores[best]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["anchor_id", "a_row", "id", "row", "score"])


def best_different(row: dict, rows: dict, codes: Codes, most: int, share: tuple[int, int], positives: int) -> pa.RecordBatch | None:
    """The best rows of other labels in a block, within the range of scores of each of an anchor's positives."""
    ids, keys, labels = (_numbers(row[c]) for c in ("a_id", "a_row", "a_label"))
    asked = _numbers(row["a_asked"], 3 * positives).reshape(-1, positives, 3)  # place (0: none), id and score of each positive
    out = []
    for n, anchor, lows, highs in _estimated(row, codes):
        different = np.flatnonzero((rows["label"] != labels[n]) & (rows["id"] != ids[n]))
        lows, highs = lows[different], highs[different]
        ranges = []
        for place, positive, score in asked[n].tolist():
            least, largest = -(-share[0] * score // 100), share[1] * score // 100
            if place and least <= largest:
                floor = max(least, _kth(lows[(lows >= least) & (highs <= largest)], most))
                ranges.append((place, positive, score, least, largest, floor))
        if not ranges:
            continue
        # the ranges of an anchor's positives lie in each other for the most part: a row is scored once for all of them
        at = different[(highs >= min(r[-1] for r in ranges)) & (lows <= max(r[-2] for r in ranges))]
        scores = integer_scores(rows["v"][at], anchor)
        order = np.argsort(scores)
        in_order = scores[order]
        for place, positive, score, least, largest, _ in ranges:
            first, last = np.searchsorted(in_order, least), np.searchsorted(in_order, largest, side="right")
            first = max(first, np.searchsorted(in_order, in_order[max(first, last - most)])) if first < last else last
            inside = order[first:last]  # the best of the range and all that tie with the last of them
            best = inside[_best(scores[inside], rows, at[inside], most)]
            same = [np.full(best.size, x) for x in (ids[n], keys[n], place, positive, score)]
            out.append((*same, rows["id"][at[best]], rows["row"][at[best]], scores[best]))
    if not out:
        return None
    names = ["anchor_id", "a_row", "place", "positive_id", "positive_score", "id", "row", "score"]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)


def _ranked(rows: DataFrame, keys: tuple[str, ...], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id``, ``label``, ``v`` (whole components), ``dim`` and ``row`` (tells rows of one id apart), equal rows once."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    picked = rows.select(rows[id_col].cast("long").alias("id"), rows[label_col].cast("long").alias("label"), rows[vector_col].cast("array<double>").alias("v"))
    picked = picked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)).where(good)
    return picked.select("id", "label", whole.alias("v")).distinct().withColumns({"dim": F.size("v"), "row": F.xxhash64("label", "v")})


def mined(
    rows: DataFrame,
    anchors: Callable[[DataFrame], DataFrame],
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    share: tuple[int, int] = (50, 95),
    scale: int = 256,
    block: int = BLOCK,
    anchor_block: int = ANCHORS,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label, the ``negatives`` best rows of other labels whose
    score is within ``share`` per cent of the positive's. ``anchors`` picks the anchors from rows of id, label and v."""
    work = Work(rows.sparkSession)
    usable = work.keep(_usable(rows, id_col, label_col, vector_col, scale), "rows")
    laid = lambda df: df.repartitionByRange("dim", "label", "row", "id").sortWithinPartitions("dim", "label", "row", "id")
    blocks = work.keep(_packed(laid(usable), block, ("id", "row", "label"), ("v",)), "blocks")
    picked = work.keep(anchors(usable), "anchors")
    asking = work.keep(_packed(laid(picked), anchor_block, ("id", "row", "label"), ("v",)), "asking")
    found = _cells(asking, blocks, lambda a, r, c: best_alike(a, r, c, positives), "anchor_id long, a_row long, id long, row long, score long")
    alike = _ranked(found, ("anchor_id", "a_row"), positives)
    triple = F.array(F.col("rank").cast("long"), "id", "score")
    per_anchor = alike.groupBy("anchor_id", "a_row").agg(F.flatten(F.sort_array(F.collect_list(triple))).alias("asked"))
    padded = F.slice(F.concat("asked", F.array_repeat(F.lit(0).cast("long"), 3 * positives)), 1, 3 * positives)
    known = picked.join(per_anchor, (F.col("id") == F.col("anchor_id")) & (picked["row"] == F.col("a_row"))).select(*picked.columns, padded.alias("asked"))
    asking = work.keep(_packed(laid(known), anchor_block, ("id", "row", "label"), ("v", "asked")), "asking-again")
    schema = "anchor_id long, a_row long, place long, positive_id long, positive_score long, id long, row long, score long"
    found = _cells(asking, blocks, lambda a, r, c: best_different(a, r, c, negatives, share, positives), schema)
    best = _ranked(found, ("anchor_id", "a_row", "place"), negatives)
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(rows.withColumn("label", moved), lambda usable: usable.where("id % 50 = 0"))


OP12_SQL = r"""
with vectors as (
  select vec_id as id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id as anchor_id, a.label = b.label as alike, b.id, list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * b.v[k]))::bigint as score
  from vectors a join vectors b on a.id % 50 = 0 and a.id <> b.id
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id,
  row_number() over (partition by p.anchor_id, positive_id order by score desc, id)::integer as rank,
  id as negative_id, positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not alike and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""
