"""A prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns. A trie of height H is
cut at half depth: the sequences' first H/2 turns make the upper trie, and what follows a cut prefix makes one of the
lower tries. A cut prefix is named by its trie and its block of H/2 turns, and that name is the root of the lower trie; so
the upper trie and all lower ones are independent of each other and are cut again at the same time. Here all tries of one
height take a step together, as one Spark job over rows of (conversation, block):

* names go down: blocks are named from their halves (blocks of BASE turns in the tasks, doubled by joins above), then each
  root is the name of the root above it with the block between;
* totals go up: the trie heights double from BASE on; the totals at the roots of the lower tries are grafted onto the nodes of
  the upper trie above them.

Both take log2(depth / BASE) steps. What a step sends is at most one row for each turn, however long conversations are, and
a step's table is written, so a lost executor costs one step. Names are SHA-256 digests. No conversation, node or
list of members is ever held as a whole; hot nodes meet partial sums only.

Rows with a null conversation take no part. Turns come in the order of turn, null first; rows that share a turn come by role,
then by the digest of role and text. A null role or text is empty, and repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import table, word_count
from casebook.operators.spread import prefix_fold
from casebook.sources.work import Work

#: Turns of a block that a task cuts by itself; a power of two.
BASE = 4
#: Conversations whose ids are joined to one piece of text before nodes gather the pieces.
PIECE = 4096
ROOT = hashlib.sha256(b"root").digest()
_EMPTY = hashlib.sha256(b"").hexdigest()



_sha = lambda *parts: F.unhex(F.sha2(F.concat(*parts), 256))


def ordered_turns(rows: DataFrame, work: Work) -> DataFrame:
    """``conv``, ``pos`` (from 0), ``symbol`` (a digest of role and text) and ``words`` of every turn."""
    role, text = F.coalesce(rows["role"].cast("string"), F.lit("")), F.coalesce(rows["text"].cast("string"), F.lit(""))
    symbol = _sha(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.where(rows["conv_id"].isNotNull()).select(
        rows["conv_id"].cast("long").alias("conv"), rows["turn"].cast("long").alias("turn"), role.alias("role"), symbol.alias("symbol"), word_count(text).alias("words")
    )
    placed = prefix_fold(turns, ["conv"], ["turn", "role", "symbol"], {"pos": F.lit(1).cast("long")}, {}, work.keep)
    return placed.select("conv", F.col("pos").cast("long").alias("pos"), "symbol", "words")


def rebuilt(turns: DataFrame, work: Work, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """The turns and the lengths (conv, n) of conversations whose first h turns come from the first of their family:
    h is the CRC-32 of the id in decimal, modulo ``heads``. The first of the family of c is c - c % family, with the sign of c."""
    n = turns.groupBy("conv").agg(F.count("*").alias("own_n"))
    n = n.withColumns({"base": F.col("conv") - F.col("conv") % family, "h": F.crc32(F.col("conv").cast("string").cast("binary")) % heads})
    n = work.keep(n, "lengths")
    of_base = n.select(F.col("conv").alias("_base"), F.col("own_n").alias("_n"))
    n = n.join(of_base, F.col("base") == F.col("_base"), "left").withColumn("given", F.least("h", F.coalesce("_n", F.lit(0).cast("long"))))
    n = work.keep(n.select("conv", "base", "h", "given", (F.col("given") + F.greatest(F.col("own_n") - F.col("h"), F.lit(0))).alias("n")), "rebuilt-lengths")
    first = turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv", "_from")
    given = n.join(first, F.col("base") == F.col("_from")).where("pos < h").select("conv", "pos", "symbol", "words")
    own = turns.join(n, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "symbol", "words")
    return given.unionByName(own), n.select("conv", "n")


def _block_name(symbols: list[Column]) -> Column:
    """Name of a block of turns, from its halves."""
    half = len(symbols) // 2
    return symbols[0] if not half else _sha(_block_name(symbols[:half]), _block_name(symbols[half:]))


def _cut(root: Column, symbols: list[Column]) -> list[Column]:
    """Names of the prefixes with 0, 1, ... turns below ``root``: those of the upper trie, then those of the lower one, whose
    root is the cut prefix. Beyond the last turn names are null."""
    half = len(symbols) // 2
    if not half:
        return [root]
    return _cut(root, symbols[:half]) + _cut(_sha(root, _block_name(symbols[:half])), symbols[half:])


def _roots(blocks: DataFrame, levels: int, work: Work) -> DataFrame:
    """``conv``, ``block``, the name ``here`` of the prefix before each block and ``after`` it (null unless it is full).

    Full blocks are named in pairs, level by level; then every prefix of whole blocks is cut at half depth, each half at half
    depth again, and so on: a lower trie's root is named by the root above it and the block between.
    """
    full = blocks.where("name is not null").select("conv", "block", "name")
    names = [full]
    for level in range(1, levels):
        odd = F.col("block").bitwiseAND(1) == 1
        now = names[-1].groupBy("conv", F.shiftright("block", 1).alias("_pair")).agg(F.max(F.when(~odd, F.col("name"))).alias("l"), F.max(F.when(odd, F.col("name"))).alias("r"))
        names.append(work.keep(now.where("l is not null and r is not null").select("conv", F.col("_pair").alias("block"), _sha("l", "r").alias("name")), f"blocks-{level}"))
    rows = full.select("conv", (F.col("block") + 1).alias("block"), F.lit(ROOT).alias("root"))
    for level in range(levels - 1, -1, -1):
        above = F.shiftright("block", level)
        low = above.bitwiseAND(1) == 1
        between = names[level].select(F.col("conv").alias("_conv"), F.col("block").alias("_block"), F.col("name").alias("_name"))
        lower = rows.where(low).withColumn("_at", above - 1)
        lower = lower.join(between, (F.col("conv") == F.col("_conv")) & (F.col("_at") == F.col("_block"))).select("conv", "block", _sha("root", "_name").alias("root"))
        rows = work.keep(rows.where(~low).unionByName(lower), f"roots-{level}")
    here = rows.select("conv", "block", F.col("root").alias("here"), F.lit(None).cast("binary").alias("after"))
    after = rows.select("conv", (F.col("block") - 1).alias("block"), F.lit(None).cast("binary").alias("here"), F.col("root").alias("after"))
    return here.unionByName(after).groupBy("conv", "block").agg(F.max("here").alias("here"), F.max("after").alias("after"))


def paths(turns: DataFrame, work: Work, base: int = BASE) -> DataFrame:
    """``conv``, ``depth``, ``name``, ``parent`` (null at the root) and ``words`` of the last turn, for every prefix but the empty one."""
    turn = F.struct("pos", "symbol", "words")
    blocks = turns.groupBy("conv", F.floor(F.col("pos") / base).alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("in"))
    symbols = [F.get("in", F.lit(k)).getField("symbol") for k in range(base)]
    blocks = work.keep(blocks.withColumn("name", F.when(F.size("in") == base, _block_name(symbols))), "blocks")
    most = turns.agg(F.max("pos")).first()[0]
    levels = 0 if most is None else ((most + 1) // base).bit_length()
    roots = _roots(blocks, levels, work).withColumnsRenamed({"conv": "_conv", "block": "_block"})
    joined = blocks.join(roots, (F.col("conv") == F.col("_conv")) & (F.col("block") == F.col("_block")), "left")
    names = [*_cut(F.coalesce("here", F.lit(ROOT)), symbols), F.col("after")]
    each = [
        F.struct((F.col("block") * base + k + 1).alias("depth"), names[k + 1].alias("name"), names[k].alias("parent"), F.get("in", F.lit(k)).getField("words").alias("words"))
        for k in range(base)
    ]
    return joined.select("conv", F.inline(F.array(*each))).where("words is not null")


def _grafted(totals: DataFrame, there: DataFrame, lower: Column, above: Column, width: int) -> DataFrame:
    """Totals with those of some nodes (``lower``) added to the nodes that are above them in their block of ``width`` depths."""
    sums = ("n_leaves", "saved_tokens")
    down = totals.where(lower).select(F.col("conv").alias("_conv"), F.col("depth").alias("_depth"), above.alias("_block"), *(F.col(c) for c in sums))
    way = there.withColumn("_block", F.floor(F.col("depth") / width)).withColumnRenamed("conv", "_conv")
    added = down.join(way, ["_conv", "_block"]).where("depth < _depth").select("name", "depth", F.col("_conv").alias("conv"), *sums)
    both = totals.select("name", "depth", "conv", *sums).unionByName(added)
    return both.groupBy("name", "depth").agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in sums))


def ends_digest(ends: DataFrame) -> DataFrame:
    """``name`` and ``ends_sha256``: the digest of the ascending ids (``conv``) of each name, joined by commas.

    Ids are range-partitioned and joined to pieces there; a name's pieces are then hashed one after the other as they come."""
    ranged = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch["name"].to_pylist(), batch["conv"].to_pylist()
            out, begin = [], 0
            for n in range(1, len(ids) + 1):
                if n == len(ids) or names[n] != names[begin] or n - begin == PIECE:
                    out.append((names[begin], ids[begin], ",".join(map(str, ids[begin:n]))))
                    begin = n
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.string()))], ["name", "first", "ids"])

    joined = ranged.mapInArrow(pieces, "name binary, first long, ids string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch["name"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if name == last:
                    own.update(b",")
                else:
                    if own is not None:
                        out.append((last, own.hexdigest()))
                    last, own = name, hashlib.sha256()
                own.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], ["name", "ends_sha256"])
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([own.hexdigest()])], ["name", "ends_sha256"])

    return joined.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name binary, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame, work: Work, base: int = BASE) -> DataFrame:
    """The nodes of the trie of sequences ``turns`` (conv, pos, symbol, words) of the conversations ``lengths`` (conv, n).

    Per node ``conv_id`` (the least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``
    and ``ends_sha256``. Without conversations there is no node.
    """
    below = work.keep(paths(turns, work, base), "paths")
    nodes = below.groupBy("name", "parent", "depth", "words").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"))
    top = lengths.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "conv", "n_convs")
    nodes = nodes.unionByName(top)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("_name")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, F.col("name") == F.col("_name"), "left").drop("_name")
    nodes = work.keep(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")

    there = below.select("conv", "depth", "name").unionByName(lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name")))
    totals = nodes.select("name", "depth", "conv", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = work.keep(_grafted(totals, there, F.lit(True), F.floor(F.col("depth") / base), base), f"totals-{base}")
    width = base
    while width <= deepest:
        block = F.floor(F.col("depth") / width)
        is_root = (F.col("depth") % width == 0) & (block % 2 == 1)
        totals = work.keep(_grafted(totals, there, is_root, block - 1, width), f"totals-{2 * width}")
        width *= 2

    last = below.join(lengths, "conv").where("depth = n").select("name", "conv")
    ends = last.unionByName(lengths.where("n = 0").select(F.lit(ROOT).alias("name"), "conv"))
    digests = ends_digest(work.keep(ends, "ends"))
    parents = nodes.select(F.col("name").alias("_parent"), F.col("conv").alias("parent_conv_id"))
    whole = nodes.join(totals.select("name", "n_leaves", "saved_tokens"), "name").join(digests, "name", "left")
    whole = whole.join(parents, F.col("parent") == F.col("_parent"), "left")
    return whole.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark)
    turns = work.keep(ordered_turns(table(spark, sf_dir, "conversations"), work), "turns")
    sequences, lengths = rebuilt(turns, work)
    return trie(work.keep(sequences, "sequences"), work.keep(lengths, "sequence-lengths"), work)


OP13_SQL = r"""
with digits as (select conv_id, encode(conv_id::varchar) as d from (select distinct conv_id from conversations where conv_id is not null) c),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as symbol,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) as words
  from conversations where conv_id is not null
), sizes as (select conv_id, count(*) as n from turns group by conv_id),
crc as (  -- CRC-32, bit by bit over the decimal digits
  select conv_id, list_reduce(list_concat([4294967295::bigint], list_transform(range(1, length(conv_id::varchar) + 1), lambda k: ascii(substring(conv_id::varchar, k, 1))::bigint)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)::bigint[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) as c
  from digits
), plan as (
  select s.conv_id, n, s.conv_id - s.conv_id % 20 as base, xor(c, 4294967295) % 4 as h from sizes s join crc using (conv_id)
), given as (select p.*, least(h, coalesce(b.n, 0)) as k from plan p left join sizes b on b.conv_id = p.base),
seqs as (
  select g.conv_id, t.pos, symbol, words from given g join turns t on t.conv_id = g.base and t.pos < h
  union all
  select g.conv_id, t.pos - h + k, symbol, words from given g join turns t on t.conv_id = g.conv_id and t.pos >= h
), path as (
  select conv_id, pos + 1 as depth, words, sha256(string_agg(symbol, ',') over (partition by conv_id order by pos)) as name from seqs
  union all
  select conv_id, 0, 0, 'root' from given
), node as (select name, depth, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words from path group by name, depth),
up as (  -- each node with its way to the root
  select n.name, n.depth, w.name as above, w.depth as lvl from node n join path w on w.conv_id = n.conv_id and w.depth <= n.depth
), kids as (select above as name, count(*) as n_children from up where lvl = depth - 1 group by above),
own as (select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * words as saved from node n left join kids using (name)),
totals as (
  select above as name, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(saved) as saved from up join own using (name) group by above
), last as (select conv_id, max_by(name, depth) as name from path group by conv_id),
ends as (select name, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as e from last group by name)
select o.conv_id, o.depth::bigint as depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children::bigint as n_children, t.n_leaves::bigint as n_leaves, t.saved::bigint as saved_tokens,
  coalesce(e, sha256('')) as ends_sha256
from own o join totals t on t.name = o.name left join ends e on e.name = o.name
left join up u on u.name = o.name and u.lvl = o.depth - 1 left join node p on p.name = u.above
"""
