"""Approximate nearest neighbours by NN-descent and greedy graph search.

The neighbour graph starts from blocks of rows that fall together under random projections. Then each round joins
every node with its neighbours and with the nodes it is a neighbour of, and lets these meet: neighbours of neighbours are
likely neighbours. A meeting only yields pairs that are better than the worst neighbour kept, and only pairs with a member
that is new since the last round meet again. Rounds end when few neighbours change.

Queries walk the graph: each keeps a list of its best candidates and expands the best ones not yet expanded, round by
round, until the list has none left or the rounds are over.

Nearness is the inner product. With one more component that brings all vectors to the length of the longest, the largest
inner product with a query is the nearest of these vectors too, so norms may differ. Graph and search work on components
rounded to bytes on each vector's own scale, so a long vector doesn't blur the others; what they find is scored exactly, in double precision, on the original vectors. Equal vectors are one
node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm.common import map_batches, release, table
from casebook.sources.work import Work

#: Neighbours of a node in the graph, and of the nodes it is a neighbour of, so many take part in a meeting.
NEIGHBOURS = 32
#: Random orders the graph starts from, and rows of a block.
STARTS, BLOCK = 4, 128
#: Rounds at most; they end earlier when fewer than this share of the neighbours changes.
ROUNDS, SETTLED = 6, 0.02
#: Length of a query's list, candidates expanded in a round, and rounds.
LIST, EXPANDED, SEARCH_ROUNDS = 160, 32, 5


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows whose vector is not null, empty or zero and has only finite numbers;
    rows that repeat an id count once."""
    vector = rows[vector_col].cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = rows.select(rows[id_col].cast("long").alias("id"), vector.alias("vector")).where("id is not null and size(vector) > 0")
    found = found.where(finite & F.exists("vector", lambda x: x != 0))
    return found.groupBy("id").agg(F.min("vector").alias("vector"))


#: Bytes of a code after its components: their scale, what the fill-up component lacks to the longest norm, and that
#: times the longest norm, as float32.
TAIL = 12


def _matrix(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components, and the two figures of the fill-up component, of each code."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    tail = np.ascontiguousarray(raw[:, -TAIL:]).view("<f4")
    return raw[:, :-TAIL].view(np.int8).astype(np.float32) * tail[:, :1], tail[:, 1], tail[:, 2]


def _products(codes: list[bytes]) -> np.ndarray:
    """Inner products of all codes with the fill-up component, less the square of the longest norm."""
    x, lack, by_longest = _matrix(codes)
    return x @ x.T + np.outer(lack, lack) - by_longest[:, None] - by_longest[None, :]


def coded(nodes: DataFrame, longest: float, seed: int) -> DataFrame:
    """``node``, ``code`` (components as bytes, their scale, and how far the component that fills up to the longest norm
    is from it) and, as ``places``, the node's place in STARTS random orders."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array(batch["vector"].to_pylist(), np.float64)
        squares = (x * x).sum(1)
        lack = squares / (longest + np.sqrt(np.maximum(0.0, longest**2 - squares)))
        scale = np.maximum(np.abs(x).max(1) / 127, 1e-300)
        tails = np.stack([scale, lack, lack * longest], 1).astype("<f4")
        code = np.rint(x / scale[:, None]).astype(np.int8)
        rng = np.random.default_rng(seed)
        signs = x @ rng.standard_normal((x.shape[1] + 1, STARTS * 16))[:-1]
        # 16 signs as one number, read as a Gray code so that neighbouring numbers differ in few signs
        bits = (signs.reshape(len(x), STARTS, 16) > 0).astype(np.int64)
        bits = np.bitwise_xor.accumulate(bits, axis=2)
        places = (bits << np.arange(15, -1, -1)).sum(2)
        codes = pa.array([c.tobytes() + t.tobytes() for c, t in zip(code, tails, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([batch["node"], codes, pa.array(places.tolist(), pa.list_(pa.int64()))], ["node", "code", "places"])

    return map_batches(nodes.select("node", "vector"), run, "node long, code binary, places array<long>")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each node; of an edge that is there twice the older counts."""
    once = edges.groupBy("u", "v").agg(F.max("score").alias("score"), F.bool_and("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("score"), "v"))
    return once.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def _block_pairs(blocks: DataFrame, k: int) -> DataFrame:
    """Within each block (arrays ``nodes``, ``codes``) every node's k best."""

    def run(batch: pa.RecordBatch):
        for own, codes in zip(batch["nodes"].to_pylist(), batch["codes"], strict=True):
            nodes = np.array(own)
            if nodes.size < 2:
                continue
            scores = _products(codes.as_py())
            np.fill_diagonal(scores, -np.inf)
            keep = min(k, nodes.size - 1)
            best = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            flat = np.take_along_axis(scores, best, 1).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, keep)), pa.array(nodes[best].ravel()), pa.array(flat, pa.float32())], ["u", "v", "score"])

    return map_batches(blocks, run, "u long, v long, score float")


def _meetings(centres: DataFrame) -> DataFrame:
    """Pairs that meet at a centre (array ``in`` of node, code, new, worst), if either would keep the other."""

    def run(batch: pa.RecordBatch):
        us, vs, scores_of = [], [], []
        for own in batch["in"].to_pylist():
            nodes = np.array([m["node"] for m in own])
            new = np.array([m["new"] for m in own], bool)
            if not new.any():
                continue
            worst = np.array([m["worst"] for m in own], np.float32)
            scores = _products([m["code"] for m in own])
            good = (new[:, None] | new[None, :]) & (scores > worst[:, None]) & (nodes[:, None] != nodes[None, :])
            a, b = np.nonzero(good)
            us.append(nodes[a])
            vs.append(nodes[b])
            scores_of.append(scores[a, b])
        if us:
            u, v, s = np.concatenate(us), np.concatenate(vs), np.concatenate(scores_of)
            order = np.lexsort((v, u))
            first = np.ones(order.size, bool)
            first[1:] = (u[order[1:]] != u[order[:-1]]) | (v[order[1:]] != v[order[:-1]])
            order = order[first]  # what met at several centres of this batch is sent once
            yield pa.RecordBatch.from_arrays([pa.array(u[order]), pa.array(v[order]), pa.array(s[order], pa.float32())], ["u", "v", "score"])

    return map_batches(centres, run, "u long, v long, score float")


def build_graph(codes: DataFrame, n: int, work: Work, k: int = NEIGHBOURS) -> DataFrame:
    """``u``, ``v``, ``score``, ``new``: up to k neighbours of every node of ``codes`` (a written table of n nodes)."""
    spark = work.spark
    blocks = max(1, -(-n // BLOCK))
    placed = codes.select("node", "code", F.posexplode("places").alias("start", "place"))
    # a block holds neighbouring places; a place with many nodes is dealt to blocks by hash
    counts = placed.groupBy("start", "place").agg(F.count("*").alias("n"))
    before = Window.partitionBy("start").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # at most 65,536 places for each start
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select(F.col("start").alias("_s"), F.col("place").alias("_p"), "n", "before")
    spread = F.pmod(F.xxhash64("node", "start"), F.col("n"))
    located = placed.join(F.broadcast(counts), (F.col("start") == F.col("_s")) & (F.col("place") == F.col("_p")))
    located = located.withColumn("block", F.floor((F.col("before") + spread) / F.lit(BLOCK)))
    gathered = located.groupBy("start", "block").agg(F.collect_list("node").alias("nodes"), F.collect_list("code").alias("codes"))
    first = _block_pairs(gathered.select("nodes", "codes"), k).withColumn("new", F.lit(True))
    graph = work.keep(_best(first, k), "graph-0")
    for number in range(1, ROUNDS + 1):
        worst = graph.groupBy("u").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
        back = graph.select(F.col("v").alias("centre"), F.col("u").alias("node"), "new")
        # those a node is a neighbour of: a node of very many of them meets k, others every round
        turn = F.row_number().over(Window.partitionBy("centre").orderBy(F.desc("new"), F.xxhash64("node", F.lit(number))))
        back = back.withColumn("_turn", turn).where(F.col("_turn") <= k).drop("_turn")
        both = graph.select(F.col("u").alias("centre"), F.col("v").alias("node"), "new").unionByName(back)
        both = both.groupBy("centre", "node").agg(F.bool_or("new").alias("new"))
        members = codes.select(F.col("node").alias("_n"), "code").join(worst, F.col("_n") == F.col("u"), "left").select("_n", "code", F.coalesce("worst", F.lit(float("-inf")).cast("float")).alias("worst"))
        met = both.join(members, F.col("node") == F.col("_n")).groupBy("centre").agg(F.collect_list(F.struct("node", "code", "new", "worst")).alias("in"))
        found = _meetings(met.select("in")).withColumn("new", F.lit(True))
        old = graph.withColumn("new", F.lit(False))
        graph = work.keep(_best(old.unionByName(found), k), f"graph-{number}")
        release(spark)
        if graph.where("new").count() < SETTLED * n * k:
            break
    return graph


def _merge(lists: DataFrame) -> DataFrame:
    """The LIST best of each query's list and new candidates; ``asked`` marks candidates that were expanded."""

    def run(batch: pa.RecordBatch):
        for q, code, held, met in zip(batch["q"].to_pylist(), batch["q_code"].to_pylist(), batch["held"].to_pylist(), batch["met"].to_pylist(), strict=True):
            nodes = np.array([h["node"] for h in held or ()], np.int64)
            scores = np.array([h["score"] for h in held or ()], np.float32)
            asked = np.array([h["asked"] for h in held or ()], bool)
            if met:
                more, at = np.unique(np.array([m["node"] for m in met]), return_index=True)
                x = _matrix([met[n]["code"] for n in at])[0]
                fresh = ~np.isin(more, nodes)
                own = _matrix([code])[0][0]  # a query's nearness is the inner product itself
                nodes = np.concatenate([nodes, more[fresh]])
                scores = np.concatenate([scores, (x @ own)[fresh]])
                asked = np.concatenate([asked, np.zeros(int(fresh.sum()), bool)])
            order = np.lexsort((nodes, -scores))[:LIST]
            out = [{"node": int(nodes[n]), "score": float(scores[n]), "asked": bool(asked[n])} for n in order]
            kind = pa.list_(pa.struct([("node", pa.int64()), ("score", pa.float32()), ("asked", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([pa.array([q], pa.int64()), pa.array([code], pa.binary()), pa.array([out], kind)], ["q", "q_code", "held"])

    return map_batches(lists, run, "q long, q_code binary, held array<struct<node:long,score:float,asked:boolean>>")


def walk(queries: DataFrame, graph: DataFrame, codes: DataFrame, work: Work) -> DataFrame:
    """``q`` and ``held``, the best candidates that a walk from the query's own node finds."""
    both = graph.select("u", "v").unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.xxhash64("u", "v")))
    # links are walked in both directions; of a node that very many link to, these many
    links = graph.select("u", "v").unionByName(both.withColumn("_r", rank).where(F.col("_r") <= 2 * NEIGHBOURS).select("u", "v")).distinct()
    links = work.keep(links.select(F.col("u").alias("_u"), F.col("v").alias("_v")), "links")
    lean = codes.select(F.col("node").alias("_n"), "code")
    empty = F.expr("cast(array() as array<struct<node:long,score:float,asked:boolean>>)")
    start = queries.join(lean, F.col("q") == F.col("_n")).select("q", F.col("code").alias("q_code"), empty.alias("held"))
    start = start.withColumn("met", F.array(F.struct(F.col("q").alias("node"), F.col("q_code").alias("code"))))
    now = work.keep(_merge(start), "walk-0")
    for number in range(1, SEARCH_ROUNDS + 1):
        open_ = F.filter("held", lambda h: ~h["asked"])
        ask = F.transform(F.slice(open_, 1, EXPANDED), lambda h: h["node"])
        asked = now.select("q", F.explode(ask).alias("asked_node"))
        if not asked.take(1):
            break
        met = asked.join(links, F.col("asked_node") == F.col("_u")).select("q", "_v").distinct().join(lean, F.col("_v") == F.col("_n"))
        met = met.groupBy(F.col("q").alias("_q")).agg(F.collect_list(F.struct(F.col("_v").alias("node"), "code")).alias("met"))
        marked = F.transform("held", lambda h: F.struct(h["node"].alias("node"), h["score"].alias("score"), (h["asked"] | F.array_contains("ask", h["node"])).alias("asked")))
        lists = now.withColumn("ask", ask).select("q", "q_code", marked.alias("held")).join(met, F.col("q") == F.col("_q"), "left").drop("_q")
        now = work.keep(_merge(lists), f"walk-{number}")
        release(work.spark)
    return now.select("q", "held")


def nearest(rows: DataFrame, every: int, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every``: ``query_id``, ``rank``, the id and ``score`` of the k nearest
    other rows found, ties to the smaller id.

    Vectors that are null, zero, or hold null or non-finite numbers take no part, nor do null ids; rows that repeat an id
    count once. Vectors of several lengths are searched among their like.
    """
    spark = rows.sparkSession
    work = Work(spark)
    vectors = work.keep(usable(rows, id_col, vector_col), "vectors")
    out = None
    for size in [r[0] for r in vectors.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()]:
        part = _nearest_of(vectors.where(F.size("vector") == size), every, k, work)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    return out.withColumnRenamed("id", id_col)


def _nearest_of(vectors: DataFrame, every: int, k: int, work: Work) -> DataFrame:
    nodes = work.keep(vectors.groupBy("vector").agg(F.min("id").alias("node")), "nodes")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = nodes.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    codes = work.keep(coded(nodes, longest, seed=1), "codes")
    graph = build_graph(codes, n, work)
    member = vectors.join(nodes.withColumnRenamed("vector", "_v"), F.col("vector") == F.col("_v")).select("id", "node")
    member = work.keep(member, "members")
    asking = member.where(F.pmod("id", F.lit(every)) == 0)
    found = walk(asking.select(F.col("node").alias("q")).distinct(), graph, codes, work)
    pairs = found.select("q", F.explode(F.transform("held", lambda h: h["node"])).alias("candidate"))
    exact = nodes.select(F.col("node").alias("_n"), "vector")
    pairs = pairs.join(exact, F.col("q") == F.col("_n")).select("q", "candidate", F.col("vector").alias("a"))
    pairs = pairs.join(exact, F.col("candidate") == F.col("_n")).select("q", "candidate", "a", F.col("vector").alias("b"))
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    score = pairs.select("q", "candidate", product.alias("score"))
    # of rows with one vector the k + 1 least ids are enough, whichever of them asks
    turn = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    few = member.withColumn("_t", turn).where(F.col("_t") <= k + 1).select(F.col("node").alias("_m"), "id")
    ranked = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "candidate"))
    score = score.withColumn("_r", ranked).where(F.col("_r") <= k + 1).drop("_r")
    rows = asking.select(F.col("id").alias("query_id"), F.col("node").alias("_q")).join(score, F.col("_q") == F.col("q"))
    rows = rows.join(few, F.col("candidate") == F.col("_m")).where("id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20)
