"""Near-duplicates by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one node from the start, so copies cost nothing here. Then

  1. each tree puts the nodes in the order of a sequence of min-hashes of its own, all trees in one range-partitioned
     sort. Neighbours in an order that share its first ``DEPTH`` min-hashes are candidates; the order goes on behind
     them, so a neighbour is one with the longest common prefix and a crowded region is divided as deep as it takes;
  2. candidates whose signatures do not rule them out are confirmed on the full shingle sets of the texts: first the most
     alike of each node, then, of those still apart, one of each two components. Confirmed links make components;
  3. a region (the nodes that share the first ``DEPTH`` min-hashes of a tree) that still holds several components is
     searched exactly: its sets go through an index on their rarest shingles. Sets that reach the similarity share one
     within the first few in order of rarity; the positions of a shared shingle and the sizes of the sets bound what
     they can have in common. Components meet others only: what has been joined is not compared again.

Pairs just at the threshold share a region in some tree with probability 0.99999; nothing caps partners or candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import ascending, map_batches, mix64, slices, table, texts_as_bytes
from casebook.llm.components import components
from casebook.llm.word_stream import hashed_words
from casebook.sources.work import Work

TREES, LABEL = 16, 6
HASHES = TREES * LABEL
#: Min-hashes that the nodes of a region share, and those after them by which a region is sorted.
DEPTH, FURTHER = 3, 12
#: Neighbours looked at on either side in each order; what they miss is left to the index.
NEAR = 2
#: Sizes of sets are told apart by this factor in the keys of the index.
BAND = 1.08
#: Signatures estimate the similarity with a deviation of at most 0.051; a pair is ruled out at this much below.
MARGIN = 0.22
#: Bytes of texts whose words are hashed at once: what is computed for them stays in a core's cache.
HASHED_BYTES = 1 << 19
_rng = np.random.default_rng(20)
_XOR, _TIMES = _rng.integers(0, 1 << 32, HASHES, np.uint32), _rng.integers(0, 1 << 31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Hashes (64 bits, ascending) of each text's distinct shingles; with fewer words, of the whole sequence."""
    words, counts = hashed_words([t.lower() for t in texts])
    of = np.repeat(np.arange(len(texts)), counts)
    left = np.cumsum(counts)[of] - np.arange(words.size)  # words of the text from this one on
    out = words.copy()
    for k in range(1, min(width, words.size)):
        head = out[: words.size - k]
        np.copyto(head, mix64(head + np.uint64(k)) * _STEP + words[k:], where=left[: words.size - k] > k)
    out = mix64(out + np.minimum(left, width).astype(np.uint64))
    begins = (left >= width) | (left == counts[of])
    ends = np.cumsum(np.bincount(of[begins], minlength=len(texts)))
    return [ascending(own) for own in np.split(out[begins], ends[:-1])]


def signature(own: np.ndarray) -> np.ndarray:
    """The low 16 bits of HASHES min-hashes of a set."""
    low = (own >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, low.size, 8192):
        np.minimum(out, ((low[None, at : at + 8192] ^ _XOR[:, None]) * _TIMES[:, None]).min(1), out=out)
    return out.astype("<u2")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)


def nodes_of(sets: list[np.ndarray]) -> np.ndarray:
    """The node of each set: 64 bits made from two sums over its shingles and its size."""
    parts = [(own.sum(dtype=np.uint64), mix64(own).sum(dtype=np.uint64), own.size) for own in sets]
    first, second, size = np.array(parts, np.uint64).reshape(-1, 3).T
    return mix64(mix64(first + mix64(size)) * _STEP + second).view(np.int64)


def described(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node`` and ``signature`` of each row; without shingles no signature."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t", HASHED_BYTES):
            sets = shingle_sets(texts_as_bytes(part["t"]), width)
            marks = [signature(own).tobytes() if own.size else None for own in sets]
            columns = [part["i"], part["h"], pa.array([own.size for own in sets], pa.int64()), pa.array(nodes_of(sets)), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "signature"])

    text = docs["text"].cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("i"), F.xxhash64(text).alias("h"), text.alias("t"))
    return map_batches(rows, run, "doc_id long, text_hash long, n_shingles long, node long, signature binary")


def in_trees(nodes: DataFrame) -> DataFrame:
    """``node``, its ``region`` in each tree and its ``order`` within, the big-endian min-hashes after the region's."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = np.repeat(batch["node"].to_numpy(), TREES)
        trees = np.tile(np.arange(TREES), batch.num_rows)
        marks = np.repeat(_signatures(batch["signature"]), TREES, 0)
        values = np.take_along_axis(marks, (trees[:, None] * LABEL + np.arange(DEPTH + FURTHER)) % HASHES, 1)
        region = mix64(trees.astype(np.uint64) + np.uint64(1))
        for k in range(DEPTH):
            region = mix64(region * _STEP + values[:, k].astype(np.uint64))
        raw = np.ascontiguousarray(values[:, DEPTH:].astype(">u2")).tobytes()
        order = pa.Array.from_buffers(pa.binary(2 * FURTHER), len(ids), [None, pa.py_buffer(raw)]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(region.view(np.int64)), order], ["node", "region", "order"])

    return map_batches(nodes.select("node", "signature"), run, "node long, region long, order binary")


def neighbours(rows: DataFrame) -> DataFrame:
    """Distinct ``u`` > ``v`` that lie at most NEAR apart in the order of a region.

    Neighbours on both sides of a partition's edge do not meet here; the index finds them if their region is still open.
    """
    keys = ["region", "order", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            before = min(NEAR, len(node))
            region = np.concatenate([region[len(region) - before :], batch["region"].to_numpy()])
            node = np.concatenate([node[len(node) - before :], batch["node"].to_numpy()])
            for far in range(1, NEAR + 1):
                new = max(0, before - far)
                a, b = node[new : len(node) - far], node[new + far :]
                met = region[new : len(node) - far] == region[new + far :]
                if met.any():
                    a, b = a[met], b[met]
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

    in_order = rows.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return in_order.select("region", "node").mapInArrow(run, "u long, v long").distinct()


def _plausible(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Of pairs (u, v) those whose signatures agree in at least a share ``least``, with that share as ``near``."""
    of = lambda name: nodes.select(F.col("node").alias(name), F.col("signature").alias(f"mark_{name}"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = (_signatures(batch["mark_u"]) == _signatures(batch["mark_v"])).mean(1)
        rows = pa.RecordBatch.from_arrays([batch["u"], batch["v"], pa.array(near)], ["u", "v", "near"])
        return rows.filter(pa.array(near >= least))

    both = pairs.select("u", "v").join(of("u"), "u").join(of("v"), "v")
    return map_batches(both.select("u", "v", "mark_u", "mark_v"), run, "u long, v long, near double")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node``, its size ``n`` and its shingles ``items`` (ascending, eight bytes each), for ``wanted`` nodes, each found by
    its least id ``head``. An id may have several texts: only those that make the node count."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t", HASHED_BYTES):
            sets = shingle_sets(texts_as_bytes(part["t"]), width)
            found = np.flatnonzero(nodes_of(sets) == part["node"].to_numpy())
            columns = [part["node"].take(pa.array(found)), pa.array([sets[k].size for k in found], pa.int64()), pa.array([sets[k].tobytes() for k in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "items"])

    rows = docs.select(docs["doc_id"].cast("long").alias("_id"), docs["text"].cast("string").alias("t")).join(wanted, F.col("_id") == F.col("head"))
    return map_batches(rows.select("node", "t"), run, "node long, n long, items binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are alike enough."""
    of = lambda name: sets.select(F.col("node").alias(name), F.col("items").alias(f"items_{name}"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        alike = []
        for a, b in zip(batch["items_u"], batch["items_v"], strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            common = np.intersect1d(a, b, assume_unique=True).size
            alike.append(common > 0 and 100 * common >= per_cent * (a.size + b.size - common))
        return batch.select(["u", "v"]).filter(pa.array(alike, pa.bool_()))

    both = pairs.select("u", "v").join(of("u"), "u").join(of("v"), "v")
    return map_batches(both.select("u", "v", "items_u", "items_v"), run, "u long, v long")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (u, v) of different components, with these as ``a`` and ``b``, the larger first."""
    of = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    rows = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left")
    rows = rows.withColumn("of_u", F.coalesce("of_u", "u")).withColumn("of_v", F.coalesce("of_v", "v")).where("of_u <> of_v")
    return rows.select(*pairs.columns, F.greatest("of_u", "of_v").alias("a"), F.least("of_u", "of_v").alias("b"))


def _most_alike(pairs: DataFrame, *by: str) -> DataFrame:
    """Of pairs (u, v, near) the most alike one for each value of ``by``."""
    best = pairs.groupBy(*by).agg(F.max(F.struct("near", "u", "v")).alias("best"))
    return best.select("best.u", "best.v", "best.near").distinct()


def _exploded(sets: DataFrame) -> DataFrame:
    """``node`` and ``item`` for each shingle of each set."""

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "items"):
            own = [np.frombuffer(x.as_buffer(), np.int64) for x in part["items"]]
            nodes = np.repeat(part["node"].to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(own))], ["node", "item"])

    return map_batches(sets.select("node", "items"), run, "node long, item long")


def _band(size: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(size, 1)) / np.log(BAND)).astype(np.int64)


def postings(rows: DataFrame, per_cent: int) -> DataFrame:
    """Index entries of sets (``node``, ``component``, ``n``, ``shared``: a struct of frequency and shingle for each shingle that
    another set has too): ``probe``, ``key``, ``node``, ``component``, ``n``, ``at``.

    In the order of rarity the shingle at position ``at`` (from 0) can be the first common one of two sets only if what is
    left from it on reaches the overlap they need. A set asks (``probe``) sets of its size or less, one key for each band
    of sizes that are still possible, and is asked by sets of its size or more.
    """

    def run(batch: pa.RecordBatch):
        for at_row in range(batch.num_rows):
            node, component, n = (batch[c][at_row].as_py() for c in ("node", "component", "n"))
            shared = batch["shared"][at_row].values
            items = shared.field("item").to_numpy()
            items = items[np.lexsort((items, shared.field("seen").to_numpy()))]
            at = n - len(items) + np.arange(len(items))
            low = -(-per_cent * n // 100)
            high = np.minimum(n, (n - at) * (100 + per_cent) // per_cent - n)
            asks = high >= low
            first, last = _band(np.array([low]))[0], _band(high[asks])
            counts = last - first + 1
            bands = np.repeat(first, counts.sum()) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            asked = 2 * per_cent * n <= (n - at) * (100 + per_cent)
            item = np.concatenate([np.repeat(items[asks], counts), items[asked]])
            band = np.concatenate([bands, np.full(asked.sum(), _band(np.array([n]))[0])])
            key = mix64(item.view(np.uint64) + mix64(band.astype(np.uint64) + np.uint64(1))).view(np.int64)
            probe = np.arange(len(key)) < counts.sum()
            whole = lambda v: pa.array(np.full(len(key), v, np.int64))
            place = np.concatenate([np.repeat(at[asks], counts), at[asked]])
            if len(key):
                yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(key), whole(node), whole(component), whole(n), pa.array(place)], ["probe", "key", "node", "component", "n", "at"])

    return map_batches(rows, run, "probe boolean, key long, node long, component long, n long, at long")


def index_pairs(sets: DataFrame, scope: DataFrame, per_cent: int, work: Work) -> DataFrame:
    """Distinct ``u`` > ``v`` of different components among the nodes of ``scope`` (node, component), with all whose sets reach
    the similarity.

    Where a key's largest component meets itself nothing is listed: the others ask it and are asked by it.
    """
    every = sets.select("node", "n").join(scope, "node")
    items = _exploded(sets.join(scope.select("node"), "node", "left_semi"))
    seen = items.groupBy("item").agg(F.count("*").alias("seen")).where("seen > 1")
    shared = items.join(seen, "item").groupBy("node").agg(F.collect_list(F.struct("seen", "item")).alias("shared"))
    entries = work.keep(postings(shared.join(every, "node").select("node", "component", "n", "shared"), per_cent), "postings")
    sizes = entries.groupBy("key", "component").agg(F.count("*").alias("size"))
    keys = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).getField("component").alias("main"), F.count("*").alias("of")).where("of > 1")
    entries = work.keep(entries.join(keys.select("key", "main"), "key"), "open-postings")
    asking, asked = (entries.where(F.col("probe") == p).select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "n", "at", "main"))) for p, s in ((True, 1), (False, 2)))
    possible = F.expr(f"component_1 <> component_2 and n_1 >= n_2 and {per_cent} * (n_1 + n_2) <= {100 + per_cent} * least(n_1 - at_1, n_2 - at_2)")
    main_1, main_2 = F.expr("component_1 = main_1"), F.expr("component_2 = main_2")

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        both = left.withColumnRenamed("key", "key_1").join(right, (F.col("key_1") == F.col("key")) & possible)
        return both.select(F.greatest("node_1", "node_2").alias("u"), F.least("node_1", "node_2").alias("v"))

    return met(asking.where(~main_1), asked).unionByName(met(asking.where(main_1), asked.where(~main_2))).distinct()


def linked(docs: DataFrame, width: int = 5, per_cent: int = 80, work: Work | None = None, text_hash: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (the least id that can be reached) and ``kept``; with ``text_hash``
    also that (``xxhash64`` of the text), which with the id names the row.

    Null and empty texts have no shingles and stand alone, as do rows with a null id (their component is null, and they
    are kept). Equal rows are one document; of an id with several texts each text is a document of that id. Columns
    other than doc_id and text are not read.
    """
    work = work or Work(docs.sparkSession)
    least = per_cent / 100 - MARGIN
    rows = work.keep(described(docs, width), "described")
    nodes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("head"), F.first("signature").alias("signature"))
    nodes = work.keep(nodes, "nodes")

    trees = work.keep(in_trees(nodes), "trees")
    shared = trees.groupBy("region").agg(F.count("*").alias("size")).where("size > 1").select("region")
    regions = work.keep(trees.join(shared, "region"), "regions")
    pairs = work.keep(_plausible(neighbours(regions), nodes, least), "neighbours")

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        return work.keep(_sets(docs, wanted.join(nodes.select("node", "head"), "node"), width), name)

    def joined(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """Components after more links: what was joined ``before`` is one star for each component, not all its links."""
        if before is not None:
            if links.isEmpty():
                return before
            links = links.unionByName(before.select(F.col("node").alias("u"), F.col("component").alias("v")))
        return work.keep(components(links, work), "components")

    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    sets = sets_of(ends, "sets")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "near"))
    best = _most_alike(both, "u").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = work.keep(_confirmed(best, sets, per_cent), "links")
    found = joined(links)
    found = joined(work.keep(_confirmed(_most_alike(_apart(pairs, found), "a", "b"), sets, per_cent), "links"), found)

    named = regions.select("region", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = work.keep(named, "named")
    open_regions = named.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("region")
    scope = work.keep(named.join(open_regions, "region", "left_semi").select("node", "component").distinct(), "scope")
    sets = sets_of(scope.select("node"), "open-sets")
    more = work.keep(_plausible(index_pairs(sets, scope, per_cent, work), nodes, least), "more-pairs")
    found = joined(work.keep(_confirmed(_most_alike(_apart(more, found), "a", "b"), sets, per_cent), "links"), found)
    found = joined(work.keep(_confirmed(_apart(more, found), sets, per_cent), "links"), found)

    named = nodes.select("node", "head").join(found, "node", "left").select("node", "head", F.coalesce("component", "node").alias("component"))
    heads = named.groupBy("component").agg(F.min("head").alias("least"))
    named = named.join(heads, "component").select(F.col("node").alias("_node"), "least")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("least")), "doc_id"))
    out = rows.join(named, F.col("node") == F.col("_node"), "left").select("doc_id", "n_shingles", own.alias("component_id"), "text_hash")
    out = out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_hash")
    return out if text_hash else out.drop("text_hash")


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), width=2, per_cent=80)


OP7_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), pairs as (
  select doc_id, case when len(w) = 0 then []::varchar[] when len(w) = 1 then [w[1]]
    else list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) end as s
  from words
), sets as (select doc_id, list_sort(s) as s, len(s) as n from pairs),
classes as (select s, n, min(doc_id) as node from sets where n > 0 group by s, n),
items as (select node, n, unnest(s) as item from classes),
common as (
  select a.node as u, b.node as v, a.n as n_u, b.n as n_v, count(*) as shared
  from items a join items b on a.item = b.item and a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by all
), links as (select u, v from common where 100 * shared >= 80 * (n_u + n_v - shared)),
edges as (select u, v from links union all select v, u from links),
reach as (
  with recursive r(node, root) as (
    select node, node from classes
    union
    select e.v, r.root from r join edges e on e.u = r.node
  ) select node, min(root) as component from r group by node
)
select s.doc_id, s.n::bigint as n_shingles, coalesce(r.component, s.doc_id) as component_id, s.doc_id = coalesce(r.component, s.doc_id) as kept
from sets s left join classes c on s.s = c.s and s.n = c.n left join reach r on r.node = c.node
"""
