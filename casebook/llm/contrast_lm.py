"""Cross-entropy difference of two matched n-gram models.

A target and a background model of one form share one vocabulary: all words of the corpus. Each token's loss is
-log p(word | word before), a pair's relative frequency mixed with the word's own; a document's score is the mean over its
tokens of the target's loss less the background's, so the lower, the more the document is like the target. A document's
own counts are left out of the models when it is scored, else documents would look like whatever they were counted in.

Counts are exact, one for each word and each pair of words, known by 64-bit keys. They never meet in one place: documents
are in blocks of about ``BLOCK_BYTES``; a block sends its distinct keys with their counts to buckets of the keys' range, a
bucket adds up what all blocks sent, and sends each block the totals of the block's own keys. However common a key, a
block sends it once, and the number of buckets grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import mix64, release, slices, table, texts_as_bytes, word_hashes
from casebook.sources.work import Work

#: Text of a block (a longer document is a block of its own), and of the corpus for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 4 << 20
#: Share of the pair's relative frequency in a token's probability, and what every word is counted more than seen.
PAIR_SHARE, MORE = 0.6, 0.1
WORDS, PAIRS = 0, 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all words, keys of each word with the one before, whether there is one before, and words of each text."""
    lists = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in lists], np.int64)
    words = word_hashes().of([w for own in lists for w in own])
    pairs, follows = np.zeros(words.size, np.uint64), np.ones(words.size, bool)
    if words.size > 1:
        pairs[1:] = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    firsts = np.cumsum(sizes) - sizes
    follows[firsts[sizes > 0]] = False
    return words, pairs, follows, sizes


def in_blocks(marked: DataFrame) -> DataFrame:
    """Adds ``block``: rows that follow one another in a task, about BLOCK_BYTES of ``t``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in slices(batch, "t"):
                size = sum(map(len, texts_as_bytes(part["t"])))
                if held and held + size > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += size
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, block, np.int64))], [*part.schema.names, "block"])

    return marked.mapInArrow(run, "i long, t string, is_target boolean, block long")


def _planes(values: np.ndarray) -> bytes:
    """64-bit values byte by byte, so that bytes that are mostly zero lie together and are compressed."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _buckets(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each key; it rises with the key."""
    return (((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)


def _sent(block: int, kind: int, keys: np.ndarray, chosen: np.ndarray, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket: its distinct keys, ascending, with their counts in all texts and in the ``chosen`` ones."""
    own, n_all = np.unique(keys, return_counts=True)
    n_target = np.zeros(own.size, np.int64)
    of_target, counts = np.unique(keys[chosen], return_counts=True)
    n_target[np.searchsorted(own, of_target)] = counts
    used, starts = np.unique(_buckets(own, n_buckets), return_index=True)
    for bucket, start, stop in zip(used.tolist(), starts.tolist(), [*starts[1:].tolist(), own.size], strict=True):
        part = own[start:stop]
        steps = np.diff(part, prepend=np.uint64(0))
        columns = [_planes(steps), _planes(n_all[start:stop]), _planes(n_target[start:stop])]
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([kind]), pa.array([bucket]), *(pa.array([c], pa.binary()) for c in columns)], ["block", "kind", "bucket", "keys", "n_all", "n_target"])


def sent(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """What each block sends to each bucket; a block that is read in several parts sends several times."""

    def flush(block: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        words, pairs, follows, is_target = (np.concatenate(c) for c in zip(*parts, strict=True))
        if words.size:
            yield from _sent(block, WORDS, words, is_target, n_buckets)
        if follows.any():
            yield from _sent(block, PAIRS, pairs[follows], is_target[follows], n_buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = -1, []
        for batch in batches:
            for part in slices(batch, "t"):
                ids = part["block"].to_numpy()
                cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), ids.size]
                for start, stop in zip(cuts, cuts[1:]):  # noqa: B905
                    if ids[start] != now:
                        yield from flush(now, parts)
                        now, parts = int(ids[start]), []
                    run_of = part.slice(start, stop - start)
                    words, pairs, follows, sizes = tokens(texts_as_bytes(run_of["t"]))
                    parts.append((words, pairs, follows, np.repeat(run_of["is_target"].to_numpy(zero_copy_only=False).astype(bool), sizes)))
        yield from flush(now, parts)

    return blocks.select("block", "t", "is_target").mapInArrow(run, "block long, kind long, bucket long, keys binary, n_all binary, n_target binary")


def _added(group: pa.Table) -> pa.Table:
    """Of one bucket: for each block and kind the totals of the block's keys, ascending; on one row of each kind also the
    number of distinct keys and the sums of all counts."""
    bucket, out = group["bucket"][0].as_py(), []
    for kind in (WORDS, PAIRS):
        rows = [r for r in group.select(["block", "kind", "keys", "n_all", "n_target"]).to_pylist() if r["kind"] == kind]
        if not rows:
            continue
        keys = [np.cumsum(_values(r["keys"]), dtype=np.uint64) for r in rows]
        own, back = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for name in ("n_all", "n_target"):
            total = np.zeros(own.size, np.int64)
            np.add.at(total, back, np.concatenate([_values(r[name]) for r in rows]).astype(np.int64))
            totals.append(total)
        places: dict[int, list[np.ndarray]] = {}
        for row, at in zip(rows, np.split(back, np.cumsum([k.size for k in keys])[:-1]), strict=True):
            places.setdefault(row["block"], []).append(at)
        figures = [own.size, int(totals[0].sum()), int(totals[1].sum())]
        for block, several in places.items():
            at = several[0] if len(several) == 1 else np.unique(np.concatenate(several))
            out.append((block, kind, bucket, _planes(totals[0][at]), _planes(totals[1][at]), *figures))
            figures = [0, 0, 0]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _ADDED.types, strict=True)], schema=_ADDED)


_ADDED = pa.schema([(n, pa.binary() if n.startswith("n_") else pa.int64()) for n in ("block", "kind", "bucket", "n_all", "n_target", "distinct", "sum_all", "sum_target")])


def added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket").applyInArrow(_added, "block long, kind long, bucket long, n_all binary, n_target binary, distinct long, sum_all long, sum_target long")


def _own_counts(keys: np.ndarray, of: np.ndarray, n_keys: int) -> np.ndarray:
    """How often each token's key (0 to n_keys - 1) occurs in its text."""
    _, back, counts = np.unique(of * n_keys + keys, return_inverse=True, return_counts=True)
    return counts[back]


def scored(blocks: DataFrame, totals: DataFrame) -> DataFrame:
    """Per row of ``i``, ``t``, ``is_target`` and ``block``: doc_id, ``n_tokens``, ``target_loss`` and ``background_loss``
    (means over tokens) and ``score``, their difference; the last three are null for texts without words, so for null and
    empty ones. ``totals`` are what ``added`` gives."""
    sums = totals.where(F.col("kind") == WORDS).agg(F.sum("distinct"), F.sum("sum_target"), F.sum("sum_all")).first()
    vocabulary, *all_words = (float(x or 0) for x in sums)
    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]

    def of_block(group: pa.Table, kind: int, keys: np.ndarray) -> tuple[np.ndarray, int, list[np.ndarray]]:
        """Each key's place among the distinct ones, their number, and each key's counts in the target and in all."""
        own, back = np.unique(keys, return_inverse=True)
        rows = sorted((r for r in group.select(["kind", "bucket", "n_target", "n_all"]).to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
        counts = [np.concatenate([np.zeros(0, np.uint64), *(_values(r[n]) for r in rows)]).astype(np.float64) for n in ("n_target", "n_all")]
        if counts[0].size != own.size:
            raise ValueError(f"{counts[0].size} counts for {own.size} keys")
        return back, own.size, [c[back] for c in counts]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [tokens(texts_as_bytes(part["t"])) for batch in left.select(["t"]).to_batches() for part in slices(batch, "t")]
        words, pairs, follows, sizes = (np.concatenate(c) for c in zip(*parts, strict=True))
        of, full = np.repeat(np.arange(sizes.size), sizes), sizes > 0
        in_target = left["is_target"].to_numpy().astype(np.int64)[of]
        word_at, n_words, word_counts = of_block(right, WORDS, words)
        pair_at, n_pairs, pair_counts = of_block(right, PAIRS, pairs[follows])
        own_words, own_pairs = _own_counts(word_at, of, n_words), _own_counts(pair_at, of[follows], n_pairs)
        means = []
        for counts_w, counts_p, total, counted_in in zip(word_counts, pair_counts, all_words, (in_target, np.ones_like(in_target)), strict=True):
            seen = counts_w - own_words * counted_in
            p = (seen + MORE) / (total - sizes[of] * counted_in + MORE * vocabulary)
            before = np.zeros(words.size)
            before[1:] = seen[:-1]
            elsewhere = np.zeros(words.size)
            elsewhere[follows] = counts_p - own_pairs * counted_in[follows]
            known = follows & (before > 0)
            p[known] = PAIR_SHARE * elsewhere[known] / before[known] + (1 - PAIR_SHARE) * p[known]
            mean = np.zeros(sizes.size)
            if full.any():
                mean[full] = np.add.reduceat(-np.log(p), (np.cumsum(sizes) - sizes)[full]) / sizes[full]
            means.append(mean)
        put = lambda v: pa.array(v, pa.float64(), mask=~full)
        return pa.Table.from_arrays([left["i"], pa.array(sizes), put(means[0]), put(means[1]), put(means[0] - means[1])], names)

    both = blocks.groupBy("block").cogroup(totals.drop("distinct", "sum_all", "sum_target").groupBy("block"))
    return both.applyInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def contrast(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Scores all of ``docs``; the target is the documents named in ``target_ids`` (``doc_id``), the background all.

    Repeated rows are counted and scored one by one; a null id is never in the target.
    """
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("_id")).where("_id is not null").distinct()
    rows = docs.select(docs["doc_id"].cast("long").alias("i"), docs["text"].cast("string").alias("t"))
    # a merge join at any size: what is shuffled then grows in step with the input
    marked = rows.join(chosen.hint("merge"), F.col("i") == F.col("_id"), "left").select("i", "t", F.col("_id").isNotNull().alias("is_target"))
    spark, work = docs.sparkSession, Work(docs.sparkSession)
    blocks = work.keep(in_blocks(marked), "blocks")
    release(spark)
    n_bytes = blocks.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    totals = work.keep(added(sent(blocks, max(1, -(-n_bytes // BUCKET_BYTES)))), "totals")
    release(spark)
    return scored(blocks, totals)


def op4_contrast_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return contrast(table(spark, sf_dir, "documents"), good)
