"""Removal of word windows that occur earlier in the corpus, by FM-indexes over shards of it.

1. Equal windows have the same anchor, the gram of GRAM words with the least hash. Neighbouring windows with one anchor
   make a run, and the words they cover its span; runs with equal spans inside one slice of documents travel as one row.
   Only anchors that occur at least twice can hold a repeat; the others go no further.
2. Each different span is fetched once, from its first place, and dealt to a shard by its anchor. A shard is indexed
   (``fm_index.FMIndex``), and its spans are streamed through backward search: matching statistics of ``window`` words give
   the interval of all places of each window, and the least of these places is the window's first. An anchor with more
   than CROWD spans is spread over several shards; for its windows the first places of the shards are merged by a 128-bit
   digest of the words.
3. A run's windows are repeats where their first place is earlier than the run's own. Documents drop the words covered.

A shard holds about SHARD words, a slice a few MB of texts; nothing else is held in memory.

Rows with a null id take no part: nothing is removed from them or because of them. A null text is empty. Places are ordered
by (doc_id, first word), so rows that repeat an id are copies of one document: nothing is removed because of the same
place in another of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.llm.common import map_batches, mix64, release, slices, table, texts_as_bytes
from casebook.llm.fm_index import FMIndex
from casebook.llm.word_stream import gram_hashes, hashed_words
from casebook.sources.work import Work

GRAM = 6
#: Words of a shard, and different spans of an anchor that go to one shard.
SHARD, CROWD = 1 << 19, 2048
_U = np.uint64


def runs(words: np.ndarray, counts: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: text ``n``, first window ``lo``, ``count`` of windows, hashes of ``anchor`` and ``span``."""
    gram = min(GRAM, window)
    empty = {k: np.zeros(0, np.int64) for k in ("n", "lo", "count")} | {k: np.zeros(0, _U) for k in ("anchor", "span")}
    if words.size < window:
        return empty
    hashes = gram_hashes(words, gram)
    # the upper bits, then the place: the least is the leftmost of the least hash
    bits = int(hashes.size).bit_length()
    least = (hashes >> _U(bits) << _U(bits)) | np.arange(hashes.size, dtype=_U)
    grams, size = window - gram + 1, 1
    while size * 2 <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < grams:
        least = np.minimum(least[: least.size - (grams - size)], least[grams - size :])
    of = np.repeat(np.arange(counts.size), counts)
    starts = np.flatnonzero(of[: least.size] == of[window - 1 :])
    if not starts.size:
        return empty
    anchor = (least[starts] & _U((1 << bits) - 1)).astype(np.int64)
    new = np.ones(starts.size, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (of[starts[1:]] != of[starts[:-1]])
    first = np.flatnonzero(new)
    lo, count, anchor = starts[first], np.diff(np.append(first, starts.size)), anchor[first]
    span, longest = mix64(count.astype(_U)), int(count.max()) + window - 1
    for k in range(longest):
        own = k < count + window - 1
        span[own] = mix64((span[own] ^ words[lo[own] + k]) * _U(0x9E3779B97F4A7C15) + _U(k))
    n = of[lo]
    return {"n": n, "lo": lo - (np.cumsum(counts) - counts)[n], "count": count, "anchor": hashes[anchor], "span": span}


_PLACE = pa.struct([("doc", pa.int64()), ("mark", pa.int64()), ("lo", pa.int64())])
_RUN = "anchor long, span long, count short, doc long, mark long, lo long, more array<struct<doc: long, mark: long, lo: long>>"


def found_runs(docs: DataFrame, window: int) -> DataFrame:
    """The runs of ``docs`` (doc, mark, t): one row for equal spans of a slice, with its first place and ``more`` places."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t", 2 << 20):
            words, counts = hashed_words(texts_as_bytes(part["t"]))
            found = runs(words, counts, window)
            if not found["n"].size:
                continue
            doc, mark = part["doc"].to_numpy()[found["n"]], part["mark"].to_numpy()[found["n"]]
            order = np.lexsort((found["lo"], doc, found["span"], found["anchor"]))
            anchor, span, lo = found["anchor"][order], found["span"][order], found["lo"][order]
            new = np.ones(order.size, bool)
            new[1:] = (span[1:] != span[:-1]) | (anchor[1:] != anchor[:-1])
            doc, mark, count = doc[order], mark[order], found["count"][order]
            heads, rest = np.flatnonzero(new), np.flatnonzero(~new)
            ends = np.append(heads[1:], order.size)
            offsets = np.append(0, np.cumsum(ends - heads - 1)).astype(np.int32)
            places = pa.StructArray.from_arrays([pa.array(c[rest]) for c in (doc, mark, lo)], fields=list(_PLACE))
            arrays = [pa.array(anchor[heads].view(np.int64)), pa.array(span[heads].view(np.int64)), pa.array(count[heads], pa.int16())]
            arrays += [pa.array(c[heads]) for c in (doc, mark, lo)] + [pa.ListArray.from_arrays(pa.array(offsets), places)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor", "span", "count", "doc", "mark", "lo", "more"])

    return map_batches(docs, run, _RUN)


def _fetched(rows: DataFrame, window: int) -> DataFrame:
    """The hashed words of spans, from the texts of their documents (doc, t, spans)."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t", 2 << 20):
            words, counts = hashed_words(texts_as_bytes(part["t"]))
            begins = np.cumsum(counts) - counts
            lists = part["spans"]
            values, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
            lo, count = values.field("lo").to_numpy(), values.field("count").to_numpy().astype(np.int64)
            at = np.repeat(begins, sizes) + lo
            cut = [words[a : a + c + window - 1].tobytes() for a, c in zip(at.tolist(), count.tolist(), strict=True)]
            doc = np.repeat(part["doc"].to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays(
                [values.field("anchor"), values.field("span"), values.field("parts"), pa.array(doc), pa.array(lo), pa.array(cut, pa.binary())],
                ["anchor", "span", "parts", "doc", "lo", "words"],
            )

    return map_batches(rows, run, "anchor long, span long, parts int, doc long, lo long, words binary")


_JUDGED = "anchor long, span long, doc long, lo long, gone long, at short, digest binary, f_doc long, f_lo long"


def judge_shard(rows: pa.Table, window: int) -> pa.Table:
    """First places of all windows of a shard's spans, by backward search.

    A row for each span with the windows (bits of ``gone``) that start earlier somewhere; and where the span's anchor is spread
    over several shards, a row for each window with the digest of its words and its first place here.
    """
    lengths = np.array([len(w) // 8 for w in rows["words"].to_pylist()], np.int64)
    symbols = np.frombuffer(b"".join(rows["words"].to_pylist()), _U)
    doc, lo, parts = (rows[c].to_numpy() for c in ("doc", "lo", "parts"))
    index = FMIndex(symbols, lengths, window)
    of = np.repeat(np.arange(lengths.size), lengths)
    step = np.arange(symbols.size) - (np.cumsum(lengths) - lengths)[of]
    # places in order of (document, word): the number of a place is its rank
    order = np.lexsort((lo[of] + step, doc[of]))
    new = np.ones(order.size, bool)
    new[1:] = (doc[of[order[1:]]] != doc[of[order[:-1]]]) | ((lo[of] + step)[order[1:]] != (lo[of] + step)[order[:-1]])
    rank = np.empty(order.size, np.int64)
    rank[order] = np.cumsum(new) - 1
    by_rank = order[new]
    value = np.full(symbols.size + lengths.size, np.iinfo(np.int64).max)
    value[np.arange(symbols.size) + of] = rank
    length, low, _ = index.matching_statistics(symbols, lengths)
    at = np.flatnonzero(length == window)
    first = index.least_in_runs(value)[low[at]]
    gone = np.zeros(lengths.size, np.int64)
    early = first < rank[at]
    np.bitwise_or.at(gone, of[at[early]], np.int64(1) << step[at[early]])
    spread = parts[of[at]] > 1
    w, f = at[spread], by_rank[first[spread]]
    digests = [hashlib.blake2b(symbols[a : a + window].tobytes(), digest_size=16).digest() for a in w.tolist()]
    anchor, span = rows["anchor"].to_numpy(), rows["span"].to_numpy()
    n = lengths.size
    nulls = lambda kind: pa.nulls(n, kind)
    own = [pa.array(anchor), pa.array(span), pa.array(doc), pa.array(lo), pa.array(gone), nulls(pa.int16()), nulls(pa.binary()), nulls(pa.int64()), nulls(pa.int64())]
    more = [anchor[of[w]], span[of[w]], doc[of[w]], lo[of[w]], np.zeros(w.size, np.int64), step[w].astype(np.int16)]
    more = [*(pa.array(c) for c in more), pa.array(digests, pa.binary()), pa.array(doc[of[f]]), pa.array((lo[of] + step)[f])]
    names = ["anchor", "span", "doc", "lo", "gone", "at", "digest", "f_doc", "f_lo"]
    return pa.concat_tables([pa.table(own, names), pa.table(more, names)])


def _shards(rows: DataFrame, window: int, shard: int) -> DataFrame:
    """``judge_shard`` over whole (anchor, part) groups of partitions sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "words", shard):
                held.append(pa.table(part.columns, part.schema.names))
                size += sum(map(len, part["words"].to_pylist())) // 8
                if size < shard:
                    continue
                whole = pa.concat_tables(held)
                key = np.stack([whole["anchor"].to_numpy(), whole["part"].to_numpy()])
                last = np.flatnonzero((key != key[:, -1:]).any(0))
                cut = int(last[-1]) + 1 if last.size else 0  # the last group may go on
                if cut:
                    yield from judge_shard(whole.slice(0, cut), window).to_batches(max_chunksize=8192)
                    held = [whole.slice(cut).combine_chunks()]
                    size = sum(map(len, held[0]["words"].to_pylist())) // 8
        if held:
            yield from judge_shard(pa.concat_tables(held), window).to_batches(max_chunksize=8192)

    return rows.mapInArrow(run, _JUDGED)


def repeated_windows(docs: DataFrame, window: int, work: Work, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """``doc``, ``mark``, ``lo`` and ``gone`` (bits, from the window at ``lo`` on) of runs with windows that start earlier."""
    if not GRAM < window <= GRAM + 61:
        raise ValueError(f"a window has {GRAM + 1} to {GRAM + 61} words")
    spark = docs.sparkSession
    all_runs = found_runs(docs, window)
    anchors = all_runs.groupBy("anchor").agg(F.sum(F.size("more") + 1).alias("n")).where("n > 1").select("anchor")
    kept = work.keep(all_runs.join(anchors, "anchor"), "runs")
    release(spark)
    first = F.min(F.struct("doc", "lo", "mark")).alias("first")
    spans = kept.groupBy("anchor", "span", "count").agg(first)
    per_anchor = spans.groupBy("anchor").agg(F.ceil(F.count("*") / crowd).cast("int").alias("parts"))
    spans = spans.join(per_anchor, "anchor").select("anchor", "span", "count", "parts", "first.*")
    own = spans.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).agg(F.collect_list(F.struct("anchor", "span", "parts", "lo", "count")).alias("spans"))
    fetched = _fetched(docs.join(own, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))).select("doc", "t", "spans"), window)
    part = F.pmod("span", "parts").cast("int")
    dealt = fetched.withColumn("part", part)
    judged = _shards(dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part"), window, shard)
    judged = work.keep(judged, "judged")
    del spans, per_anchor, own, fetched, dealt
    release(spark)

    wide = judged.where("digest is not null")
    least = wide.groupBy("digest").agg(F.min(F.struct("f_doc", "f_lo")).alias("first"))
    late = F.col("first") < F.struct(F.col("doc").alias("f_doc"), (F.col("lo") + F.col("at")).alias("f_lo"))
    merged = wide.join(least, "digest").where(late).select("anchor", "span", "doc", "lo", F.expr("shiftleft(1L, cast(at as int))").alias("gone"))
    verdicts = judged.where("digest is null").select("anchor", "span", "doc", "lo", "gone").unionByName(merged)
    verdicts = verdicts.groupBy("anchor", "span").agg(F.min("doc").alias("_doc"), F.min("lo").alias("_lo"), F.bit_or("gone").alias("_gone"))

    places = F.concat(F.array(F.struct("doc", "mark", "lo")), "more")
    each = kept.join(verdicts, ["anchor", "span"]).select("count", "_doc", "_lo", "_gone", F.inline(places))
    is_first = (F.col("doc") == F.col("_doc")) & (F.col("lo") == F.col("_lo"))
    # a later place of a span: each of its windows has an earlier one in the first place
    every = F.expr("shiftleft(1L, cast(count as int)) - 1")
    return each.select("doc", "mark", "lo", F.when(is_first, F.col("_gone")).otherwise(every).alias("gone")).where("gone <> 0")


def covered_words(size: int, starts: np.ndarray, gone: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` words the windows cover that the bits of ``gone`` name."""
    change = np.zeros(size + 1, np.int64)
    for bit in range(int(gone.max()).bit_length()):
        at = starts[(gone >> bit) & 1 == 1] + bit
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(
    docs: DataFrame, window: int = 20, columns: tuple[str, ...] = ("doc_id",), shard: int = SHARD, crowd: int = CROWD
) -> DataFrame:
    """The named columns of every row, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept`` (the words that are left,
    joined by a space)."""
    work = Work(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc"), docs["text"].cast("string").alias("t"), *(docs[c].alias(f"_c{n}") for n, c in enumerate(columns)))
    # rows that repeat an id with another text are told apart by it; equal rows are looked at once
    mark = F.xxhash64("t")
    usable = texts.where("doc is not null and t is not null").select("doc", mark.alias("mark"), "t")
    again = work.keep(usable.groupBy("doc", "mark").agg(F.count("*").alias("n")).where("n > 1").select("doc", "mark"), "again")
    if again.take(1):
        many = usable.join(again, ["doc", "mark"], "left_semi").groupBy("doc", "mark").agg(F.first("t").alias("t"))
        usable = usable.join(again, ["doc", "mark"], "left_anti").unionByName(many)
    gone = repeated_windows(usable, window, work, shard, crowd)
    mine = gone.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).agg(F.collect_list(F.struct("lo", "gone")).alias("gone"))
    rows = texts.join(mine, (F.col("doc") == F.col("_doc")) & (mark == F.col("_mark")), "left").drop("_doc", "_mark", "doc")
    schema = T.StructType(list(docs.select(*columns).schema.fields))
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string"), ("kept", "binary")):
        schema = schema.add(name, kind)

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t"):
            out = []
            for text, own in zip(texts_as_bytes(part["t"]), part["gone"].to_pylist(), strict=True):
                words = text.split()
                left = words
                if own:
                    starts, bits = (np.array([g[c] for g in own], np.int64) for c in ("lo", "gone"))
                    mask = covered_words(len(words), starts, bits, window)
                    left = [words[k] for k in np.flatnonzero(~mask)]
                kept = b" ".join(left)
                out.append((len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            arrays = [*(part[f"_c{n}"] for n in range(len(columns))), *(pa.array([r[n] for r in out], kinds[n]) for n in range(4))]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_batches(rows, run, schema)


def op11_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP11_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), each as (
  select doc_id, len(w) as n, unnest(w) as word, unnest(range(1, len(w) + 1)) as p,
    unnest(list_transform(range(1, len(w) + 1), lambda k: case when k + 19 <= len(w) then sha256(array_to_string(w[k : k + 19], ' ')) end)) as own
  from words
), judged as (
  select doc_id, p, word,
    own is not null and row_number() over (partition by own order by doc_id, p) > 1 as again
  from each
), marked as (
  select doc_id, p, word, coalesce(max(case when again then p end) over (partition by doc_id order by p) >= p - 19, false) as gone
  from judged
), left_over as (
  select doc_id, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by p) filter (where not gone) as kept
  from marked group by doc_id
)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words w left join left_over l on l.doc_id = w.doc_id
"""
