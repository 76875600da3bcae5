"""The trie of rebuilt conversations against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

from pyspark.sql import functions as F

from casebook.llm import conversation_trie
from casebook.sources.work import Work

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int, name string, words int"


def frame(spark, rows):
    """Turns with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def original(rows):
    own: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def brute(sequences):
    members: dict = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda node: len(node[-1][1].encode().split()) if node else 0
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        ends = ",".join(map(str, sorted(c for c in own if len(sequences[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        saved = sum((len(members[n]) - 1) * words(n) for n in below)
        out.append((min(own), len(node), parent, len(own), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, df, base=conversation_trie.BASE, plain=False):
    work = Work(spark)
    turns = work.keep(conversation_trie.ordered_turns(df, work), "turns")
    if plain:
        sequences, lengths = turns, turns.groupBy("conv").agg(F.count("*").alias("n"))
    else:
        sequences, lengths = conversation_trie.rebuilt(turns, work)
    return sorted((tuple(r) for r in conversation_trie.trie(work.keep(sequences, "s"), work.keep(lengths, "n"), work, base).collect()), key=str)


def made():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 26), 40, 41, 43, 65, 66, 67, 68, 1_000_003]:
        rows += [(c, t, "user", f"word{rng.randint(0, 1)} two\x0bthree") for t in range(rng.randint(1, 9))]
    shared = [(t, "user", f"turn {t}") for t in range(19)]
    rows += [(c, *turn) for c in (80, 81, 82, 83, 84) for turn in shared[: 19 - c % 3]]  # long and alike
    rows += [(90, 0, "a", "b:c"), (90, 1, "a:b", "c"), (91, 0, None, None), (91, None, "user", ""), (91, None, "user", ""), (91, 1, "", "")]
    rows += [(92, 5, "user", "tie b"), (92, 5, "user", "tie b"), (None, 0, "user", "nobody"), (-7, 0, "user", "negative"), (93, 0, "u", "é 日本 " * 500)]
    return rows


def test_nodes_are_those_of_brute_force(spark):
    rows = made()
    want = brute(rebuilt(original(rows)))
    assert found(spark, frame(spark, rows).repartition(3)) == want
    assert found(spark, frame(spark, rows), base=1) == want  # every cut is a Spark step


def test_long_conversations_as_they_are(spark):
    rows = [(c, t, "user", f"{t if t < 60 + c else -t}") for c in range(4) for t in range(70 + c)]
    assert found(spark, frame(spark, rows), plain=True) == brute(original(rows))


def test_pieces_of_ids_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 3)
    ends = spark.createDataFrame([(b"a", c) for c in range(-5, 20)] + [(b"b", 7)], "name binary, conv long").repartition(3)
    got = {bytes(r["name"]): r["ends_sha256"] for r in conversation_trie.ends_digest(ends).collect()}
    assert got == {b"a": hashlib.sha256(",".join(map(str, range(-5, 20))).encode()).hexdigest(), b"b": hashlib.sha256(b"7").hexdigest()}


def test_no_conversations_and_turnless_ones(spark):
    assert found(spark, frame(spark, []).limit(0)) == []
    lone = next(c for c in range(1, 40) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 0)  # its base is absent
    rows = [(lone, 0, "user", "x")]
    assert found(spark, frame(spark, rows)) == brute(rebuilt(original(rows))) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
