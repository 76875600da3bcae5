"""Toxicity by a factorization machine over hashed terms.

    logit = b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,      x_i = 1 for each distinct term of the text

A pair of terms, such as an insult and a mention of a group, has a weight of its own through the inner product of the
terms' factors, which weights for single terms cannot give. Terms are lower-cased words without punctuation at their
ends, hashed to a fixed number of cells, so the model has a fixed size however many words there are. It is fitted on a
bounded sample of labelled rows and scores every whole text in one pass without a shuffle. Null and empty texts have no
terms and get the bias alone; repeated rows are scored one by one; columns that are not named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Remembered, ascending, flat_values, give_back, map_batches, slices, table, texts_as_bytes
from casebook.sources.work import Work

#: Cells that terms are hashed to.
CELLS = 1 << 18
#: Labelled rows the model is fitted on at most (those with the least hash of their id), each with its whole text.
MOST_LABELLED = 24_000
#: Terms, the most evenly spread of the sample, among which pairs are looked for that tell more than their terms do.
PAIRED = 2_048
#: Factors of a term.
FACTORS = 6
_EDGE = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""


def _cell(term: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(term) % CELLS


class TermCells(Remembered):
    """term -> its cell."""

    def __missing__(self, term: bytes) -> int:
        return self.put(term, _cell(term))


_cells = TermCells()


def terms_of(text: bytes) -> set[bytes]:
    """The distinct terms of a text: its words in lower case without punctuation at their ends."""
    words = set(text.decode("utf-8", "replace").lower().encode().split())
    return {word.strip(_EDGE) for word in words} - {b""}


def cells_of(text: bytes) -> np.ndarray:
    """The distinct cells of a text's terms, ascending."""
    terms = terms_of(text)
    return ascending(np.fromiter(map(_cells.__getitem__, terms), np.int64, len(terms)))


def all_cells(texts: list[bytes]) -> list[np.ndarray]:
    """``cells_of`` of each text, for a whole table: most terms are rare there, and to hash one takes less than to remember it."""
    import xxhash

    hashed = (np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms)) for terms in map(terms_of, texts))
    return [ascending((own % np.uint64(CELLS)).astype(np.int64)) for own in hashed]


@dataclass
class Model:
    bias: float
    weight: np.ndarray  # CELLS
    factor: np.ndarray  # CELLS x FACTORS

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        sizes = np.array([r.size for r in rows])
        if (full := np.flatnonzero(sizes)).size:
            flat, starts = np.concatenate([rows[n] for n in full]), np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            used = self.weight[flat] != 0  # a cell that no labelled row taught anything adds nothing
            v = np.zeros((flat.size, self.factor.shape[1]))
            v[used] = self.factor[flat[used]]
            out[full] += np.add.reduceat(self.weight[flat], starts)
            out[full] += 0.5 * (np.add.reduceat(v, starts) ** 2 - np.add.reduceat(v * v, starts)).sum(1)
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -40, 40)))


def _fit_of(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log-likelihood of ``hits`` labels among ``n`` rows at their own share."""
    hits, miss = np.maximum(hits, 0), np.maximum(n - hits, 0)
    part = lambda k: np.where(k > 0, k * np.log(np.maximum(k, 1e-300) / np.maximum(n, 1e-300)), 0)
    return part(hits) + part(miss)


def _gains(n: np.ndarray, hits: np.ndarray, rows: float, positives: float) -> np.ndarray:
    """Likelihood ratio statistic of each cell's presence (in ``n`` rows, ``hits`` of them labelled) and the label."""
    base = _fit_of(np.array(positives), np.array(rows))
    return 2 * (_fit_of(hits, n) + _fit_of(positives - hits, rows - n) - base)


def telling(n: np.ndarray, hits: np.ndarray, rows: float, positives: float, least: float) -> np.ndarray:
    """Cells whose presence and the label depend on each other: the statistic is at least ``least``."""
    return np.flatnonzero(_gains(n, hits, rows, positives) >= least)


def spread(n: np.ndarray, rows: float, most: int = PAIRED, least: int = 20) -> np.ndarray:
    """The ``most`` cells that at least ``least`` rows have and lack, those nearest to half of the rows first."""
    even = np.minimum(n, rows - n)
    order = np.lexsort((np.arange(len(n)), -even))[:most]
    return np.sort(order[even[order] >= least])


def paired(rows: list[np.ndarray], labels: np.ndarray, cells: np.ndarray, least: float) -> np.ndarray:
    """Of ``cells`` those in a pair that tells at least ``least`` more about the label than its two terms by themselves.

    Two terms may each say nothing about the label while having both, or just one of them, says all.
    """
    place = np.full(CELLS, -1)
    place[cells] = np.arange(cells.size)
    both, hits = (np.zeros((cells.size, cells.size), np.float32) for _ in "nh")
    met = np.empty_like(both)
    for at in range(0, len(rows), 512):
        part = [place[r] for r in rows[at : at + 512]]
        own = np.zeros((len(part), cells.size), np.float32)
        for k, p in enumerate(part):
            own[k, p[p >= 0]] = 1
        both += np.matmul(own.T, own, out=met)
        marked = own[labels[at : at + 512] > 0]
        hits += np.matmul(marked.T, marked, out=met)
    del met
    total, positives = float(len(rows)), float(labels.sum())
    n, h = both.diagonal().astype(float), hits.diagonal().astype(float)
    alone, base = _gains(n, h, total, positives), _fit_of(np.array(positives), np.array(total))
    found = np.zeros(cells.size, bool)
    for k in range(cells.size):
        n11, h11 = both[k].astype(float), hits[k].astype(float)
        split = _fit_of(h11, n11) + _fit_of(h[k] - h11, n[k] - n11) + _fit_of(h - h11, n - n11) + _fit_of(positives - h[k] - h + h11, total - n[k] - n + n11)
        found[k] = (2 * (split - base) - alone - alone[k] >= least).any()
    return cells[found]


def fit(rows: list[np.ndarray], labels: np.ndarray, least: float = 16.0, least_pair: float = 48.0, epochs: int = 40, rate: float = 0.05, decay: float = 2e-4, seed: int = 3) -> Model:
    """Logistic loss, Adam, minibatches, over the terms that tell something about the label by themselves (``telling``) or
    in a pair (``paired``)."""
    model = Model(0.0, np.zeros(CELLS, np.float64), np.zeros((CELLS, FACTORS)))
    positives = int(labels.sum())
    if not rows or positives in (0, len(rows)):
        model.bias = 0.0 if not rows else (4.0 if positives else -4.0)
        return model
    rng = np.random.default_rng(seed)
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [r.size for r in rows])
    n, hits = np.bincount(flat, minlength=CELLS).astype(float), np.bincount(flat, labels[of], CELLS)
    alone = telling(n, hits, len(rows), positives, least)
    own = np.union1d(alone, paired(rows, labels, spread(n, len(rows)), least_pair))
    number = np.full(CELLS, -1, np.int32)
    number[own] = np.arange(own.size)
    rows = [(n := number[r])[n >= 0] for r in rows]
    width = 1 + FACTORS
    theta = np.concatenate([np.zeros((own.size, 1)), rng.normal(0, 0.01, (own.size, FACTORS))], 1)
    bias = float(np.log(positives / (len(rows) - positives)))
    moment, second, steps = np.zeros_like(theta), np.zeros_like(theta), 0
    bias_m = bias_s = 0.0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        lr = rate * (1 - epoch / epochs) + rate * 0.05
        for at in range(0, len(rows), 1024):
            batch = [n for n in order[at : at + 1024]]
            sizes = np.array([rows[n].size for n in batch])
            flat = np.concatenate([rows[n] for n in batch])
            of = np.repeat(np.arange(len(batch)), sizes)
            x = theta[flat]
            sums = np.stack([np.bincount(of, x[:, k], len(batch)) for k in range(width)], 1)
            squares = np.bincount(of, (x[:, 1:] ** 2).sum(1), len(batch))
            logit = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[batch]) / len(batch)
            e = error[of]
            grad = np.empty_like(theta)
            grad[:, 0] = np.bincount(flat, e, own.size)
            for k in range(1, width):
                grad[:, k] = np.bincount(flat, e * (sums[of, k] - x[:, k]), own.size)
            steps += 1
            moment = 0.9 * moment + 0.1 * grad
            second = 0.99 * second + 0.01 * grad * grad
            bias_m, bias_s = 0.9 * bias_m + 0.1 * error.sum(), 0.99 * bias_s + 0.01 * error.sum() ** 2
            fix1, fix2 = 1 - 0.9**steps, 1 - 0.99**steps
            theta -= lr * ((moment / fix1) / (np.sqrt(second / fix2) + 1e-6) * np.minimum(1, np.abs(grad) * 1e9) + decay / rate * theta)
            bias -= lr * (bias_m / fix1) / (np.sqrt(bias_s / fix2) + 1e-6)
    model.bias = bias
    model.weight[own], model.factor[own] = theta[:, 0], theta[:, 1:]
    return model


def labelled_cells(docs: DataFrame, labels: DataFrame, label_col: str, most: int = MOST_LABELLED) -> DataFrame:
    """``id``, ``label``, ``cells`` and three min-hashes (``looks``) of the documents of at most ``most`` labels that are not
    held out; rows of ``labels`` without an id or a label teach nothing."""
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out("doc_id"))
    sample = known.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id", "_label").limit(most)
    # the sample's ids are bounded in number, so they can be sent to all tasks
    rows = docs.select(docs["doc_id"].alias("i"), docs["text"].cast("string").alias("t")).join(F.broadcast(sample), F.col("i") == F.col("_id"))

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t"):
            rows = [cells_of(t) for t in texts_as_bytes(part["t"])]
            looks = [np.array([r[np.argmin(r * k % 2147483647)] if r.size else -1 for k in (48271, 69621, 16807)]).tobytes() for r in rows]
            found = [r.astype(np.int32).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([part["i"], part["_label"], pa.array(looks, pa.binary()), pa.array(found, pa.binary())], ["id", "label", "looks", "cells"])

    return map_batches(rows.select("i", "t", "_label"), run, "id long, label int, looks binary, cells binary")


def _cell_counts(sample: DataFrame) -> DataFrame:
    """``cell``, the number of rows that have it and how many of them are labelled; at most CELLS rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.frombuffer(c, np.int32) for c in batch["cells"].to_pylist()]
        labels = np.repeat(batch["label"].to_numpy().astype(float), [r.size for r in rows])
        flat = np.concatenate(rows)
        n, hits = np.bincount(flat, minlength=CELLS), np.bincount(flat, labels, CELLS).astype(np.int64)
        own = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(n[own]), pa.array(hits[own])], ["cell", "n", "hits"])

    return map_batches(sample.select("label", "cells"), run, "cell long, n long, hits long").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def held_out(id_col: str):
    """Rows kept from fitting: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", most: int = MOST_LABELLED, least: float = 16.0) -> Model:
    """The model of at most ``most`` labelled rows, also where an id has many rows.

    Rows that agree in three min-hashes, so copies and near copies, count once: they would make all of their words look
    telling. Terms are counted in tasks over whole texts; the driver gets the cells that can matter only, for each row no
    more than PAIRED and those that tell by themselves.
    """
    work = Work(docs.sparkSession)
    try:
        looked = labelled_cells(docs, labels, label_col, most)
        one = looked.groupBy("looks", "label").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "cells")).alias("r"))
        sample = work.keep(one.select("r.h", "r.id", "label", "looks", "r.cells").orderBy("h", "id", "label", "looks").limit(most), "labelled")
        rows, positives = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
        n, hits = np.zeros(CELLS), np.zeros(CELLS)
        # as arrays: a Python object for each of up to CELLS rows would stay in the driver's memory
        counted = _cell_counts(sample).toArrow()
        n[counted["cell"]], hits[counted["cell"]] = counted["n"], counted["hits"]
        del counted
        wanted = np.zeros(CELLS, bool)
        if rows:
            wanted[spread(n, rows)] = wanted[telling(n, hits, rows, positives, least)] = True

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [np.frombuffer(c, np.int32) for c in batch["cells"].to_pylist()]
            return pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array([r[wanted[r]].tobytes() for r in rows], pa.binary())], ["id", "label", "cells"])

        found = map_batches(sample.select("id", "label", "cells"), run, "id long, label int, cells binary").orderBy("id", "label", "cells").toArrow()
        flat, ends = flat_values(found["cells"].combine_chunks())
        labels = found["label"].to_numpy().astype(np.float64)
        return fit(np.split(flat.view(np.int32), ends[1:-1] // 4) if labels.size else [], labels, least)
    finally:
        work.drop()
        found = flat = None
        give_back()


def with_scores(docs: DataFrame, model: Model, columns: tuple[str, ...], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The named columns of ``docs`` and the ``score_col`` (0 to 1) of each row's whole text; a null counts as empty."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.bias, model.weight.astype(np.float32), model.factor.astype(np.float32)))  # CELLS x (1 + FACTORS)
    source = docs.select(docs[text_col].cast("string").alias("_scored_text"), *(docs[c].alias(f"_kept_{n}") for n, c in enumerate(columns)))
    schema = docs.select(*columns).schema.add(score_col, "double")

    def run(batch: pa.RecordBatch):
        own = Model(*shared.value)
        for part in slices(batch, "_scored_text"):
            scores = own.scores(all_cells(texts_as_bytes(part["_scored_text"])))
            yield pa.RecordBatch.from_arrays([*(part[f"_kept_{n}"] for n in range(len(columns))), pa.array(scores)], [*columns, score_col])

    return map_batches(source, run, schema)


#: Documents at or above this score are taken for toxic.
TOXIC = 0.7


def op5_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    scored = with_scores(docs, model, ("doc_id",))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
