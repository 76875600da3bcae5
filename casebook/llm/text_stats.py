"""Whole-text statistics for quality rules."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casebook.llm.common import map_batches, slices, texts_as_bytes

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
#: Odd multiplier that combines the hashes of the words of a window.
_STEP = np.uint64(0x9E3779B97F4A7C15)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios the rules are written in; all lie between 0 and 1 but the mean word length.
RATIOS = ("mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio", "upper_ratio", "punct_ratio", "digit_ratio", "stop_ratio", "top_word_ratio", "log_words", "line_words", "short_line_ratio")
_UPPER, _PUNCT, _DIGIT = re.compile(rb"[A-Z]"), re.compile(rb"[!?.,;:|\-_=+(){}\[\]]"), re.compile(rb"[0-9]")
_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    own = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = own[:n].copy()
    for k in range(1, window):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _STEP + own[k : k + n]
    order = np.argsort(mixed, kind="stable")
    alike = mixed[order[1:]] == mixed[order[:-1]]
    if not alike.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][alike]] = again[order[:-1][alike]] = True
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def stats(text: bytes) -> tuple[list[int], list[float]]:
    """COUNTS and RATIOS of one text."""
    words = text.split()
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(_SYMBOLS.findall(text))
    lines, seen, again, short, used = text.split(b"\n"), set(), 0, 0, 0
    for line in lines:
        if line.strip():
            again += line in seen
            seen.add(line)
            used += 1
            short += len(line) < 20
    repeats = repeated_words(words)
    size = max(1, len(text))
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    letters = len(text.translate(None, _NO_LETTERS))
    per = 1 / max(1, n)
    ratios = [
        chars * per,
        symbols / size,
        again / max(1, used),
        repeats * per,
        len(kinds) * per,
        len(_UPPER.findall(text)) / max(1, letters),
        len(_PUNCT.findall(text)) / size,
        len(_DIGIT.findall(text)) / size,
        sum(c for w, c in kinds.items() if len(w) <= 3) * per,
        max(kinds.values(), default=0) * per,
        float(np.log1p(n)),
        n / max(1, used),
        short / max(1, used),
    ]
    return [n, chars, symbols, again, repeats], ratios


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, COUNTS (long) and RATIOS (double) of its whole text; a null counts as empty."""
    schema = f"{id_col} long, " + ", ".join([*(f"{c} long" for c in COUNTS), *(f"{r} double" for r in RATIOS)])

    def run(batch: pa.RecordBatch):
        for part in slices(batch, "t"):
            found = [stats(t) for t in texts_as_bytes(part["t"])]
            counts = [pa.array([f[0][n] for f in found], pa.int64()) for n in range(len(COUNTS))]
            ratios = [pa.array([f[1][n] for f in found], pa.float64()) for n in range(len(RATIOS))]
            yield pa.RecordBatch.from_arrays([part["i"], *counts, *ratios], [id_col, *COUNTS, *RATIOS])

    return map_batches(docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].cast("string").alias("t")), run, schema)
