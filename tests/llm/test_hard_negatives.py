"""Hard negatives against brute force, and the score intervals against exact scores."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np

from casebook.llm import hard_negatives
from casebook.llm.hard_negatives import Codes, integer_scores
from casebook.sources.work import Work

SCHEMA = "vec_id long, embedding array<double>, label int, id long, row string, v int, dim int, rank int"


def frame(spark, rows):
    """Vectors with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA)


def brute(rows, positives=5, negatives=3):
    fine = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, label, tuple(math.floor(256 * x) for x in v)))
    fine = sorted(set(fine))
    out = []
    for i, label, v in fine:
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, other == label) for j, other, w in fine if j != i and len(w) == len(v))
        for score, j, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and 50 * -score <= 100 * -s[0] <= 95 * -score]
            out += [(i, j, rank + 1, s[1], -score, -s[0]) for rank, s in enumerate(inside[:negatives])]
    return sorted(out)


def made(n, dim, seed, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        rows.append((i * 5, [c + rng.gauss(0, 1) for c in centres[rng.randrange(labels)]], label))
    return rows


def found(df, **options):
    got = hard_negatives.mined(df, lambda usable: usable.where("id % 50 = 0"), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_mined_rows_are_those_of_brute_force(spark):
    rows = made(300, 20, 1)
    rows += [(7, None, 1), (8, [], 1), (9, [math.nan] * 20, 1), (11, [None] + [1.0] * 19, 1), (12, [math.inf] + [1.0] * 19, 1), (13, [1.0] * 20, None), (None, [1.0] * 20, 1)]
    rows += [rows[0], rows[1], rows[1]]  # repeated rows
    rows += [(21 + k, rows[10][1], k % 3) for k in range(6)]  # ties
    rows += [(50, [0.0] * 20, 1), (100, [1e-9] * 20, 2)]  # an id with two vectors, zeros
    rows += [(1000 * 50 + k, [1.0, k / 10], k % 2) for k in range(60)]  # another length
    df = frame(spark, rows).repartition(4)
    want = brute(rows)
    assert len(want) > 100
    assert found(df) == want
    assert found(df, block=16, anchor_block=2) == want


def test_one_label_holds_most_rows(spark):
    rows = [(i, v, 1 if i % 3 else label) for i, v, label in made(200, 70, 2)]
    assert found(frame(spark, rows), block=32, positives=2, negatives=4) == brute(rows, 2, 4)


def test_empty_table_and_single_label(spark):
    rows = made(40, 5, 3, labels=1)
    assert found(frame(spark, rows).limit(0)) == []
    assert found(frame(spark, rows)) == []


def test_intervals_hold():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64, 100, 130):
        rows = np.floor(256 * rng.standard_normal((300, dim)))
        rows[3], rows[4] = 0, rows[5]
        anchors = np.floor(256 * rng.standard_normal((20, dim)))
        anchors[0], anchors[1] = 0, rows[7]
        low, high = Codes(rows).intervals(anchors)
        exact = anchors @ rows.T
        assert (low <= exact).all() and (exact <= high).all()
        reach = np.linalg.norm(anchors, axis=1)[:, None] * np.linalg.norm(rows - rows.mean(0), axis=1)
        assert dim < 64 or ((high - low) / 2).mean() < 0.75 * reach.mean()  # narrower than lengths alone say


def test_whole_numbers_are_scored_exactly():
    big = np.array([[2**31 - 1, 3], [2**31, 5]], np.int64)
    assert integer_scores(big, np.array([2**30, 7])).tolist() == [(2**31 - 1) * 2**30 + 21, 2**61 + 35]


def test_blocks_are_never_broadcast(spark):
    work = Work(spark)
    usable = work.keep(hard_negatives._usable(frame(spark, made(300, 20, 4)), "vec_id", "label", "embedding", 256), "rows")
    columns = ("id", "row", "label"), ("v",)
    blocks, asking = (work.keep(hard_negatives._packed(usable, size, *columns), "blocks") for size in (16, 4))
    cells = hard_negatives._cells(asking, blocks, lambda row, rows, codes: None, "id long")
    depths = [(line.find("- ") + 1, line) for line in cells._jdf.queryExecution().executedPlan().toString().splitlines()]
    sent = [n for n, (_, line) in enumerate(depths) if "BroadcastExchange" in line]
    for n in sent:
        inside = itertools.takewhile(lambda x, top=depths[n][0]: x[0] > top, depths[n + 1 :])
        assert not any("binary" in line for _, line in inside)
    assert sum("SortMergeJoin" in line for _, line in depths) >= 2
