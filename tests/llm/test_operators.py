"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casebook.llm import common, contrast_lm, decision_list, factor_machine, filter_cascade, lsh_forest, nn_descent, pattern_packing, source_schedule, suffix_dedup, token_prefixes, word_ids
from casebook.llm.text_stats import stats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "x") for i, t, s in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(["the", "red", "fox", "ran", "home", "and", "slept", "well", f"w{rng.randint(0, 400)}"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    base = sentence(rng, 120)
    passage = sentence(rng, 30)
    rows = [(1, base, "a"), (2, base, "a"), (3, base.replace("fox", "cat", 2), "b"), (4, None, None), (5, "", "b"), (6, "one", "c"), (7, "one", "c")]
    rows += [(10 + k, sentence(rng, 40) + " " + passage + " " + sentence(rng, 20), "ab"[k % 2]) for k in range(6)]
    rows += [(30, sentence(rng, 9000), "a"), (31, "é日本 <|endoftext|>\x1c  x's", "d"), (31, "é日本 <|endoftext|>\x1c  x's", "d"), (None, base, "a")]
    return frame(spark, rows).repartition(3).persist()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_prefix_counts_are_those_of_the_library(spark, docs):
    library = Tokenizer.from_file(BYTE)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = token_prefixes.count_prefixes(docs.where("doc_id is null or doc_id <> 30"), BYTE.replace(".json", ".tiktoken"), BYTE, limits=(5,), prefixes=True)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in got.collect():
        text = texts[r["doc_id"]]
        assert r["n_bytes"] == len(text.encode()) and r["n_tokens"] == count(text)
        if len(text) < 400:
            every = [count(text[:p]) for p in range(len(text) + 1)]
            assert r["prefix_tokens"] == every
            assert r["cut_5"] == max(p for p, n in enumerate(every) if n <= 5)
    assert token_prefixes.count_prefixes(docs.limit(0), BYTE.replace(".json", ".tiktoken"), BYTE).count() == 0


def test_totals_come_from_the_recurrence(monkeypatch):
    library, tables = Tokenizer.from_file(BYTE), token_prefixes.PrefixCounts(BYTE.replace(".json", ".tiktoken"), BYTE)
    texts = ["", "  a  b\n\nunbelievably w8k3j2 x's 'REst", "日本語 текст ’s ١٢٣ e\u0301 ǅ😀😀", "a<|endoftext|>b <|endo", "q" * 3000, "\u2003\u2003 x\u00a0 y", "12345678 ==== \x1c\x1d z"]
    rng = random.Random(3)
    texts += ["".join(chr(rng.choice([*range(32, 400), 0x2019, 0x65E5, 0x0301, 0x1F600, 0x2003, 10])) for _ in range(200)) for _ in range(40)]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]

    class Cut:  # what is left of the library is where it cuts pre-tokens
        pre_tokenizer = library.pre_tokenizer

    class Pairs:  # and of the encoder, which pairs of tokens may follow each other
        def _encode_single_piece(self, b, encode=tables.bpe._encode_single_piece):
            assert len(b) <= 2 * max(map(len, tables.ranks))
            return encode(b)

    monkeypatch.setattr(tables, "library", Cut())
    monkeypatch.setattr(tables, "bpe", Pairs())
    assert [tables.total(t) for t in texts] == want


def test_packing_keeps_all_tokens_in_gapless_sequences(spark, docs):
    library = Tokenizer.from_file(WORD)
    pieces = pattern_packing.tokenized_pieces(docs, WORD, 64, ids=True).persist()
    packed = pattern_packing.pack(pieces, 64).collect()
    want = sorted(x for r in docs.collect() for x in [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    assert sorted(t for r in packed for t in r["ids"]) == want
    by: dict = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-len(want) // 64) + 2
    assert pattern_packing.pack(pieces.limit(0), 64).count() == 0


def test_nnls_fits_without_negative_weights():
    rng = np.random.default_rng(0)
    a = rng.random((12, 30))
    x = np.maximum(0, rng.normal(size=30))
    got = pattern_packing.nnls(a, a @ x)
    assert (got >= 0).all() and np.abs(a @ got - a @ x).max() < 1e-6


def test_schedule_takes_targets_and_reruns_agree(spark, docs):
    order = lambda df: sorted(rows_of(df), key=str)
    first = order(source_schedule.Mix(docs, block_words=16).taken())
    assert first == order(source_schedule.Mix(docs.repartition(5), block_words=16).taken())
    assert len(first) == docs.count()
    by: dict = {}
    for _, size, source_size, target, taken in first:
        assert taken <= 3 * size
        by.setdefault((source_size, target), []).append(taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 1
    assert source_schedule.targets([10, 100, 0], [1, 2, 3]) == pytest.approx([30.0, 80.0, 0.0])
    assert source_schedule.Mix(docs.limit(0)).taken().count() == 0


def test_links_are_those_of_brute_force(spark, docs):
    def shingles(t, width):
        words = (t or "").encode().lower().split()
        return {b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()

    for width in (2, 5):
        sets = {r["doc_id"]: shingles(r["text"], width) for r in docs.collect() if r["doc_id"] is not None}
        root = {i: i for i in sets}
        for _ in sets:
            for a, x in sets.items():
                for b, y in sets.items():
                    if x and y and 100 * len(x & y) >= 80 * len(x | y):
                        root[a] = min(root[a], root[b])
        got = rows_of(lsh_forest.linked(docs, width=width).where("doc_id is not null"))
        assert {(i, n, c, k) for i, n, c, k in got} == {(i, len(sets[i]), root[i], root[i] == i) for i in sets}
    assert lsh_forest.linked(docs.limit(0)).count() == 0


def test_crowded_regions_are_divided(spark):
    rng = random.Random(5)
    words = sentence(rng, 200).split()
    near = []
    for k in range(150):  # more than a region may hold, all near each other
        own = list(words)
        own[k] = f"only{k}"
        near.append((k, " ".join(own), "a"))
    got = rows_of(lsh_forest.linked(frame(spark, near)))
    assert {c for _, _, c, _ in got} == {0}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_those_of_brute_force(spark, docs, seed):
    rng = random.Random(seed)
    unit = "".join(rng.choice("ab ") for _ in range(70))
    rows = [(k, "".join(rng.choice([unit, unit[5:], "x" * 60, rng.choice("abc")]) for _ in range(6)), "a") for k in range(25)]
    both = docs.unionByName(frame(spark, [(100 + i, t, s) for i, t, s in rows]))
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in both.where("doc_id is not null").collect()}
    least: dict = {}
    for i in sorted(texts, reverse=True):
        for p in range(len(texts[i]) - 49):
            least[texts[i][p : p + 50]] = i
    for i, n, removed, spans, digest, kept in rows_of(suffix_dedup.without_repeats(both.where("doc_id is not null"))):
        mask = np.zeros(len(texts[i]) + 1, bool)
        for p in range(len(texts[i]) - 49):
            if least[texts[i][p : p + 50]] < i:
                mask[p : p + 50] = True
        left = bytes(b for b, m in zip(texts[i], mask, strict=False) if not m)
        assert (n, removed, kept) == (len(texts[i]), int(mask.sum()), left)
        assert spans == int((mask[1:] & ~mask[:-1]).sum() + mask[0]) and digest == hashlib.sha256(left).hexdigest()
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


def test_a_block_sorts_only_what_may_repeat_and_gives_neighbouring_windows_as_one_row(monkeypatch):
    rng = np.random.default_rng(5)
    spans, sorted_ones, before = [bytes(rng.integers(97, 123, 70).astype(np.uint8)) for _ in range(40)], [], suffix_dedup.equal_windows
    rows = [(k // 4, k, 7, 21, 20, spans[k]) for k in range(40)] + [(5, 90, 3, 21, 20, spans[21])]
    rows.sort(key=lambda r: r[:2])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
    names = ["key", "doc", "lo", "count", "at", "bytes"]
    block = pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in range(6)], names)
    monkeypatch.setattr(suffix_dedup, "equal_windows", lambda flat, starts, window: sorted_ones.append(starts.size) or before(flat, starts, window))
    got = suffix_dedup.settle_block(block, 50).to_pylist()
    assert [(r["doc"], r["lo"], r["count"]) for r in got if r["digest"] is None] == [(90, 3, 21)]
    open_ones = {(r["doc"], r["lo"]): r["digest"] for r in got if r["digest"] is not None}
    assert open_ones == {(k, 7 + n): hashlib.blake2b(spans[k][n : n + 50], digest_size=16).digest() for k in (*range(4), *range(36, 40)) for n in range(21)}
    assert sorted_ones == [42]


def test_suffixes_with_long_ties_share_a_number():
    rng = np.random.default_rng(3)
    flat = np.concatenate([np.tile(rng.integers(97, 99, 16), 12), rng.integers(97, 99, 200), np.zeros(130)]).astype(np.uint8)
    starts = np.arange(0, 330)
    numbers = suffix_dedup.equal_windows(flat, starts, 50)
    of = lambda p: (flat[p : p + 50].tobytes(), p % suffix_dedup.V)
    assert all((numbers[a] == numbers[b]) == (of(a) == of(b)) for a in starts for b in starts[::7])


def test_url_rules(spark):
    urls = [None, "no-scheme", "http://A.Example.com/en/x?q", "https://www.example.com/en/", "http://b.net/fr", "http://b.net/fr/a/b#c", "http://com", "http://notcom/", "http://x.org/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_cascade.judge(pages, filter_cascade.RULES).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("a.example.com", "/en/x", "example.com/en/", "block"),
        3: ("www.example.com", "/en/", "www.example.com/en/", "allow"), 4: ("b.net", "/fr", None, "allow"), 5: ("b.net", "/fr/a/b", "net/fr/", "block"),
        6: ("com", "", None, "allow"), 7: ("notcom", "/", None, "allow"), 8: ("x.org", "/en/", None, "allow"),
    }
    assert filter_cascade.judge(pages.limit(0), filter_cascade.RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    from casebook.sources.work import Work

    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 3000, 10).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = filter_cascade.build(listed, universe, Work(spark))
    assert len(cascade.levels) > 1
    got = {r[0] for r in universe.where(cascade.holds(F.col("key"))).collect()}
    assert got == {r[0] for r in listed.collect()}


def test_neighbours_are_found(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16))
    x[50:90] = x[50]  # one vector many times
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)] + [(700, None), (720, [0.0] * 16), (740, [float("nan")] * 16), (760, [None] * 16)]
    got = rows_of(nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=20))
    x = x.astype(np.float32).astype(float)
    by: dict = {}
    for q, rank, v, score in got:
        assert score == pytest.approx(float(x[q] @ x[v]), abs=1e-9) and q != v and q < 700
        by.setdefault(q, []).append((rank, v, score))
    hits = 0
    for q in range(0, 600, 20):
        assert [r for r, _, _ in sorted(by[q])] == list(range(1, 21))
        scores = np.delete(x @ x[q], q)
        hits += sum(s >= np.sort(scores)[-20] - 1e-9 for _, _, s in by[q])
    assert hits / (30 * 20) >= 0.95
    assert nn_descent.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), every=20).count() == 0


def test_a_few_long_vectors_do_not_blur_the_others(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[[7, 1501, 2207]] *= 100
    rows = [(i, [float(v) for v in x[i]]) for i in range(3000)]
    got = rows_of(nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=60))
    hits = 0
    for q in range(0, 3000, 60):
        best = np.sort(np.delete(x @ x[q], q))[-20]
        hits += sum(s >= best - 1e-9 for i, _, _, s in got if i == q)
    assert hits / (50 * 20) >= 0.9


def test_quality_statistics_and_rules(spark):
    text = "a b c d e\na b c d e\n x# y\n\n"
    counts, _ = stats(text.encode())
    assert counts == [12, 13, 1, 1, 10]
    values = {"x": np.arange(300.0), "y": np.tile([0.0, 1.0, 2.0], 100)}
    bad = (values["x"] > 200) & (values["y"] > 0.5)
    rules = decision_list.learn(values, bad)
    found = np.zeros(300, bool)
    for rule in rules:
        found |= decision_list.covered(rule, values, 300)
    assert (found == bad).mean() > 0.97
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "w " * 50), (3, "w " * 50), (None, sentence(random.Random(1), 60))], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = decision_list.judge(docs, labels).collect()
    assert len(got) == 5 and sum(r["kept"] for r in got) == 1
    assert decision_list.judge(docs.limit(0), labels).count() == 0


def test_rules_come_from_a_bounded_number_of_rows(spark, monkeypatch):
    rows = [(k // 40, f"{'# ' * (k // 40 % 2 * 9)}{' '.join(f'v{k}x{n}' for n in range(20))}") for k in range(2400)]  # 40 texts for each id
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(60)] + [(None, 1), (5, None)], "doc_id long, quality int")
    taught = []
    learn = decision_list.learn
    monkeypatch.setattr(decision_list, "learn", lambda values, bad, **more: taught.append(bad.size) or learn(values, bad, **more))
    measured = decision_list.with_stats(docs)
    few, every = (decision_list.learn_rules(measured, labels, most=n) for n in (500, 50_000))
    assert taught == [500, 2400] and few and every


def test_pairs_of_terms_are_learned():
    rng = random.Random(4)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        words = sentence(rng, 12).split() + ["vile"] * a + ["folk"] * b
        rows.append(factor_machine.cells_of(" ".join(words).encode()))
        labels.append(float(a and b))
    model = factor_machine.fit(rows[:1000], np.array(labels[:1000]))
    assert ((model.scores(rows[1000:]) >= 0.7) == np.array(labels[1000:], bool)).mean() > 0.97
    assert factor_machine.fit([], np.zeros(0)).scores([np.zeros(0, np.int64)])[0] == 0.5


def test_pairs_of_terms_that_tell_nothing_alone():
    rng = random.Random(5)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(factor_machine.cells_of(" ".join(sentence(rng, 12).split() + ["vile"] * a + ["folk"] * b).encode()))
        labels.append(float(a != b))
    model = factor_machine.fit(rows[:2000], np.array(labels[:2000]))
    assert ((model.scores(rows[2000:]) >= 0.5) == np.array(labels[2000:], bool)).mean() > 0.97


def test_logits_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(6)
    weight, factor = rng.normal(size=factor_machine.CELLS), rng.normal(size=(factor_machine.CELLS, 3))
    rows = [np.sort(rng.choice(factor_machine.CELLS, k, replace=False)) for k in (0, 1, 2, 9, 40)]
    want = [0.5 + sum(weight[i] for i in r) + sum(factor[i] @ factor[j] for a, i in enumerate(r) for j in r[a + 1 :]) for r in rows]
    assert np.allclose(factor_machine.Model(0.5, weight, factor).logits(rows), want)


def test_whole_labelled_texts_and_many_rows_of_an_id(spark):
    rng = random.Random(8)
    long = " ".join(f"w{k}" for k in range(6000))
    rows = [(k, f"{sentence(rng, 20)} {long if k % 5 == 0 else ''} {'vile' if k % 2 else 'kind'}", "a") for k in range(0, 600)]
    rows += [(3, f"{sentence(rng, 9)} other{k}", "b") for k in range(900)] + [(None, "vile", "a"), (7, None, "a")]
    docs = frame(spark, rows + rows[:50])
    labels = spark.createDataFrame([(k, k % 2, "x", b"y") for k in range(600)] + [(None, 1, "x", b"y"), (4, None, "x", b"y")], "doc_id long, toxic int, text string, cells binary")
    sample = factor_machine.labelled_cells(docs, labels, "toxic")
    assert sample.agg(F.max(F.length("cells"))).first()[0] > 4 * 5900  # all terms of a long text, but for those that share a cell
    model = factor_machine.fit_on(docs, labels, most=300)
    got = factor_machine.with_scores(docs, model, ("doc_id", "key")).where("doc_id > 100").collect()
    assert sum((r["score"] >= 0.7) == bool(r["doc_id"] % 2) for r in got) / len(got) > 0.95
    empty = factor_machine.fit_on(docs.limit(0), labels)
    assert factor_machine.with_scores(docs.limit(0), empty, ("doc_id",)).count() == 0 and factor_machine.fit_on(docs, labels.limit(0)).bias == 0


def test_fitting_makes_no_python_object_for_each_row_or_cell(spark, docs, monkeypatch):
    labels = docs.where("doc_id is not null").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    taken, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: taken.append(collect(self)) or taken[-1])
    factor_machine.fit_on(docs, labels)
    assert max(map(len, taken), default=0) <= 1


def test_scores_of_null_and_empty_texts(spark, docs):
    labels = spark.createDataFrame([(1, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    model = factor_machine.fit_on(docs, labels)
    got = factor_machine.with_scores(docs, model, ("doc_id", "size")).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)


def test_losses_prefer_the_target(spark, docs):
    rng = random.Random(9)
    good = [(200 + k, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(40)), "a") for k in range(40)]
    other = [(100 + k, " ".join(rng.choice("one two three four alpha".split()) for _ in range(40)), "a") for k in range(40)]
    table = frame(spark, good + other).unionByName(docs.where("doc_id in (4, 5)"))
    got = {r["doc_id"]: r for r in contrast_lm.contrast(table, spark.range(204, 240).select(F.col("id").alias("doc_id"))).collect()}
    assert got[5]["score"] is None and got[4]["n_tokens"] == 0 and got[203]["n_tokens"] == 40
    assert max(got[k]["score"] for k in range(200, 240)) < min(got[100 + k]["score"] for k in range(40))
    assert contrast_lm.contrast(table.limit(0), spark.range(0).select(F.col("id").alias("doc_id"))).count() == 0


def test_links_within_a_crowded_template_are_found(spark):
    rng = random.Random(4)
    base, rows = [f"t{k}" for k in range(400)], []
    for k in range(300):  # about 0.7 alike to each other
        rows.append((k, [*base, *(f"d{k}-{n}" for n in range(85))]))
    for k in range(60):  # about 0.81 alike to one of them
        rows.append((1000 + k, [*rows[rng.randrange(300)][1][:-50], *(f"p{k}-{n}" for n in range(50))]))
    rng.shuffle(rows)
    sets = {i: set(zip(w, w[1:])) for i, w in rows}  # noqa: B905
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and root[i] != root[j] and 100 * len(both := sets[i] & sets[j]) >= 80 * (len(sets[i]) + len(sets[j]) - len(both)):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert 200 < len(set(root.values())) < 360
    found = lsh_forest.linked(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), width=2, per_cent=80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == root


def test_index_finds_all_links_between_components(spark):
    rng = random.Random(2)
    family = lambda k: [1000 * (k % 5) + n for n in rng.sample(range(40), 22 + k % 17)] + rng.sample(range(9000, 9100), k % 7)
    sets = {k: np.unique(np.array(family(k), np.uint64)) for k in range(120)}
    of = {k: k if k < 60 else 60 for k in sets}
    rows = [(k, len(s), bytearray(s.tobytes())) for k, s in sets.items()]
    got = lsh_forest.index_pairs(spark.createDataFrame(rows, "node long, n long, items binary"), spark.createDataFrame(list(of.items()), "node long, component long"), 60, lsh_forest.Work(spark))
    got = {tuple(r) for r in got.collect()}
    common = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    want = {(a, b) for a in sets for b in range(a) if of[a] != of[b] and 100 * common(a, b) >= 60 * (len(sets[a]) + len(sets[b]) - common(a, b))}
    assert want <= got and len(want) > 20 and all(of[a] != of[b] for a, b in got)


def test_texts_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(6)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b), (3, b + " more"), (4, c), (None, c)], "doc_id long, text string")
    found = lsh_forest.linked(docs, text_hash=True).join(docs.select("text", F.xxhash64("text").alias("text_hash")).distinct(), "text_hash")
    got = {(r["doc_id"], r["text"]): (r["component_id"], r["kept"]) for r in found.collect()}
    assert got == {(1, a): (1, True), (2, a): (1, False), (2, b): (2, True), (3, b + " more"): (2, False), (4, c): (4, True), (None, c): (None, True)}


@pytest.mark.parametrize("block", [8 << 20, 3000])
def test_contrast_counts_every_word_and_pair_by_itself(spark, monkeypatch, block):
    monkeypatch.setattr(contrast_lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(contrast_lm, "BUCKET_BYTES", block)
    rng = random.Random(8)
    # more distinct words than 2^18, so that fewer cells than words would mix up unrelated ones
    rows = [(k, " ".join([*(f"w{rng.randrange(1 << 30)}" for _ in range(10)), *(f"c{rng.randrange(9)}" for _ in range(6))])) for k in range(200 if block < 8 << 20 else 30000)]
    rows += [(5, rows[5][1]), (None, "c1 c2 c1"), (-1, None), (-2, " ")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = contrast_lm.contrast(table, spark.range(0, len(rows), 3).select(F.col("id").alias("doc_id"))).collect()
    assert len(got) == len(rows)
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for i, t in rows:
        w = (t or "").split()
        for row in (0, 1) if i is not None and i >= 0 and i % 3 == 0 else (1,):
            words[row].update(w)
            pairs[row].update(zip(w, w[1:]))  # noqa: B905
    text, size = dict(rows), len(words[1])
    for r in [x for x in got if x["doc_id"] is None or x["doc_id"] < 60]:
        w = (text[r["doc_id"]] or "").split()
        assert r["n_tokens"] == len(w) and (r["score"] is None) == (not w)
        for row, name in enumerate(["target_loss", "background_loss"]) if w else ():
            inside = row or (r["doc_id"] is not None and r["doc_id"] % 3 == 0)
            own, own_pairs = (Counter(w), Counter(zip(w, w[1:]))) if inside else (Counter(), Counter())  # noqa: B905
            loss = 0.0
            for k, x in enumerate(w):
                p = (words[row][x] - own[x] + 0.1) / (words[row].total() - own.total() + 0.1 * size)
                if k and (before := words[row][w[k - 1]] - own[w[k - 1]]):
                    p = 0.6 * (pairs[row][w[k - 1], x] - own_pairs[w[k - 1], x]) / before + 0.4 * p
                loss -= math.log(p)
            assert r[name] == pytest.approx(loss / len(w), rel=1e-9)


def test_a_worker_remembers_the_words_of_one_step_at_a_time(monkeypatch):
    words = [b"fox", b"ran", b"home"]
    known = word_ids.word_ids(WORD)
    memories = (factor_machine._cells, common.word_hashes(), known)
    first = factor_machine.cells_of(b" ".join(words)).tolist(), common.word_hashes().of(words).tolist(), known.of("fox ran home")
    assert [len(m) for m in memories] == [0, 0, 3]
    assert factor_machine.cells_of(b" ".join(words)).tolist() == first[0]
    assert [len(m) for m in memories] == [3, 0, 0]
    assert (common.word_hashes().of(words).tolist(), known.of("fox ran home")) == first[1:]
    monkeypatch.setattr(common.WordHashes, "most", 2)
    assert common.word_hashes().of(words).tolist() == first[1] and len(common.word_hashes()) == 1


def test_tasks_hand_freed_memory_back(monkeypatch):
    class Task:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    given = []
    monkeypatch.setattr(common, "trim", lambda: given.append(1))
    monkeypatch.setattr(common, "TRIM_BYTES", 64)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())], ["i"]) for n in (3, 0, 20, 5)]
    run = common.map_batches(Task(), lambda b: b if b.num_rows < 20 else iter([b, b]), "i long")
    assert [b.num_rows for b in run(iter(batches))] == [3, 20, 20, 5]
    assert len(given) == 2  # after the large batch and at the end


def test_pipeline_stages_return_documents(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs.select(*corpus_pipeline.COLUMNS)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if n < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == list(corpus_pipeline.COLUMNS)
        if name == "near_duplicates":
            ids = [r["doc_id"] for r in now.collect()]
            assert {1, 4, 5, 6, 31} <= set(ids) and not {2, 3, 7} & set(ids)
            assert ids.count(31) == 1 and ids.count(None) == 1  # equal rows are one document, rows without id stay
    assert now.count() > 0


def test_terms_and_shingles_of_many_texts_are_those_of_each():
    texts = [t.encode() for t in ("", "  ", "One", "one two", "a b c d e f a b c d e", "\u0391\u03a3. (\u0391\u03a3, \u0130x) \u212aa... !!", "x " * 40)] + [b"\xe4\xb8 x \xe4\xb8! \xff"]
    for text, cells in zip(texts, factor_machine.all_cells(texts), strict=True):
        terms = {w.strip(factor_machine._EDGE).decode("utf-8", "replace").lower().encode() for w in text.split()} - {b""}
        assert cells.tolist() == factor_machine.cells_of(text).tolist() == sorted({factor_machine._cell(t) for t in terms})
    for width in (1, 2, 5):
        sets = lsh_forest.shingle_sets(texts, width)
        words = [t.lower().split() for t in texts]
        want = [{tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for w in words]
        assert [own.size for own in sets] == [len(s) for s in want]
        assert all((np.diff(own.astype(object)) > 0).all() for own in sets)
        alone = [lsh_forest.shingle_sets([t], width)[0] for t in texts]
        assert [own.tolist() for own in sets] == [own.tolist() for own in alone]
        assert lsh_forest.nodes_of(sets).tolist() == lsh_forest.nodes_of(alone).tolist()
        for a, x in zip(sets, want, strict=True):
            for b, y in zip(sets, want, strict=True):
                assert np.intersect1d(a, b).size == len(x & y)
