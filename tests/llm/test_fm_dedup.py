"""Word windows removed by FM-indexes, against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from casebook.llm import fm_dedup
from casebook.llm.fm_index import FMIndex
from casebook.llm.word_stream import hashed_words

SCHEMA = "doc_id long, text string, doc string, lo long, mark int, anchor string, gone long"


def frame(spark, rows):
    """Documents with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3) for i, t in rows], SCHEMA)


def brute(rows, window):
    """Every window against every other, by its words."""
    usable = {(i, t) for i, t in rows if i is not None}
    first: dict = {}
    for i, t in usable:
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        if i is not None:
            for k in range(len(words) - window + 1):
                if first[tuple(words[k : k + window])] < (i, k):
                    gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in fm_dedup.without_repeats(df, **options).drop("kept").collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(n))
    passage, long_one, phrase = words(60), words(4000), "one two three four five six seven eight"
    out = [(k, f"{words(rng.randint(0, 30))} {passage[: rng.randint(40, 170)]} {words(rng.randint(0, 20))}") for k in range(40)]
    out += [(100 + k, f"{words(14)} {phrase} {words(14)}") for k in range(40)]  # one gram in many contexts
    out += [(200, long_one), (201, long_one + " end"), (202, long_one.replace("a1", "zz")), (203, passage + "\t\n " + passage + "\x0b" + passage)]
    out += [(300, None), (301, ""), (302, " \n "), (303, "é\x1c日本 " * 25), (304, "a " * 19), (305, "a " * 20), (306, "a " * 300)]
    out += [(7, passage), (7, passage), (7, words(30) + " " + passage), (None, passage), (None, None), (-5, passage), (306, "a " * 300)]
    return out


def test_removed_words_are_those_of_brute_force(spark, rows):
    df = frame(spark, rows).repartition(3)
    want = brute(rows, 20)
    assert found(df) == want
    assert found(df, shard=300, crowd=3) == want  # many shards, anchors spread over several
    assert found(df.coalesce(1), crowd=1) == want
    assert found(df, window=7) == brute(rows, 7)


def test_empty_tables_and_bounds(spark, rows):
    assert found(frame(spark, rows).limit(0)) == []
    with pytest.raises(ValueError):
        fm_dedup.without_repeats(frame(spark, rows), window=3).collect()
    kept = {r["doc_id"]: r["kept"] for r in fm_dedup.without_repeats(frame(spark, [(1, "a  b"), (2, None)])).collect()}
    assert kept == {1: b"a b", 2: b""}


def test_matching_statistics_are_those_of_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        cap, kinds = int(rng.integers(2, 8)), int(rng.integers(1, 5))
        lengths = rng.integers(1, 15, size=rng.integers(1, 8))
        text = rng.integers(10, 10 + kinds, size=lengths.sum())
        index = FMIndex(text, lengths, cap)
        indexed = [list(s) for s in np.split(text, np.cumsum(lengths)[:-1])]
        sizes = rng.integers(1, 15, size=5)
        stream = rng.integers(10, 11 + kinds, size=sizes.sum())
        length, low, high = index.matching_statistics(stream, sizes)
        at = 0
        for query in np.split(stream, np.cumsum(sizes)[:-1]):
            for p in range(len(query)):
                places = {0: set()}
                for m in range(1, min(cap, len(query) - p) + 1):
                    places[m] = {int(index.starts[n] + x) for n, s in enumerate(indexed) for x in range(len(s) - m + 1) if s[x : x + m] == list(query[p : p + m])}
                longest = max(m for m, there in places.items() if there or m == 0)
                assert length[at] == longest
                if longest:
                    assert {int(p) for p in index.order[low[at] : high[at]]} == places[longest]
                at += 1


def test_words_are_cut_at_ascii_white_space():
    texts = [" a\tb ", "", "x" * 100 + "\x0b\x0c" + "x" * 99, "é \x1cé", "a"]
    hashes, counts = hashed_words([t.encode() for t in texts])
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    assert hashes[0] == hashes[-1] and len(set(hashes.tolist())) == 5


def test_a_shard_ends_between_anchors(spark):
    """Rows of one anchor in two record batches are judged together."""
    words = np.arange(20, dtype=np.uint64).tobytes()
    rows = [(5, k, 1, k, 0, words, 0) for k in range(50)]
    df = spark.createDataFrame(rows, "anchor long, span long, parts int, doc long, lo long, words binary, part int").coalesce(1)
    got = fm_dedup._shards(df, 20, 100).collect()
    assert sorted(r["doc"] for r in got if r["gone"]) == list(range(1, 50))
