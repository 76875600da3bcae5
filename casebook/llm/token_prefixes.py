"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-level BPE text falls into chunks (a run of white space and the run of other characters after it) that the
tokenizer encodes independently, whatever follows. So the count at a prefix is the count at the start of its last chunk
plus the count of the begun chunk, and both are kept: ``PrefixCounts`` holds cumulative counts at all chunk starts and
computes, for a chunk, the counts at all of its prefixes. Inside a pre-token the recurrence is

    count[p] = count[p - len(t)] + 1

where t is the one token that ends at p and may follow the last token of the prefix before it: a pair of tokens may
follow each other when encoding their joined bytes gives this pair back. Truncation and budget questions are answered
from these tables; no text is encoded again.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import map_batches, slices, table

#: White space as the pre-tokenizer sees it (Unicode White_Space), written out because Python's \s has four more.
SPACE = "\t\n\x0b\x0c\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_SPACE_RUN = re.compile(f"[{SPACE}]+")
#: A blank after other white space: only then may a cut at each blank fall inside a run.
_RUN_BEFORE_BLANK = re.compile(f"[{SPACE}] ")
#: Beyond these characters the pre-tokenizer's own Unicode tables decide where a text is cut into pre-tokens.
_UNCOMMON = re.compile("[^\x00-\x7f\xa0-ſ]")
#: Chunks and pre-tokens remembered per Python worker, as many of each.
REMEMBERED = 800_000


class PrefixCounts:
    """Counts for one tokenizer: ``ranks`` is its rank file, ``model`` the same vocabulary for the tokenizers library."""

    def __init__(self, ranks: str, model: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = Tokenizer.from_file(model)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cut_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        import regex

        self.pieces = regex.compile(PATTERN)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        #: Ranks of tokens, and -1 for bytes that only begin one.
        self.begun = {token[:n]: -1 for token in self.ranks for n in range(1, len(token))} | self.ranks
        self.follows: dict[int, bool] = {}
        self.known: dict[str, int] = _Remembered(self.chunk_total)
        self.ended: dict[str, int] = _Remembered(lambda piece: self.piece(piece.encode())[-1])

    # one pre-token -----------------------------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if _UNCOMMON.search(text):
            return [text[start:end] for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.pieces.findall(text)

    def may_follow(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a``, both by rank."""
        if len(self.follows) >= REMEMBERED:
            self.follows.clear()
        found = self.follows[a << 32 | b] = self.bpe._encode_single_piece(self.tokens[a] + self.tokens[b]) == [a, b]
        return found

    def piece(self, b: bytes) -> list[int]:
        """Counts at all byte prefixes of one pre-token. The one token that ends at a prefix is the longest that may."""
        begun, follows, size = self.begun.get, self.follows.get, len(b) + 1
        count, last = [0] * size, [0] * size
        for start in range(size - 1):
            reached, before = count[start] + 1, last[start] << 32
            for p in range(start + 1, size):
                rank = begun(b[start:p])
                if rank is None:  # no token goes on from here
                    break
                if rank < 0 or count[p]:
                    continue
                if start:
                    fits = follows(before | rank)
                    if fits is None:
                        fits = self.may_follow(last[start], rank)
                    if not fits:
                        continue
                count[p], last[p] = reached, rank
        return count

    # one chunk ---------------------------------------------------------------------------------------------------

    def segment(self, text: str, counts: np.ndarray, start: int, base: int) -> tuple[int, int, int]:
        """Fills counts[start + 1 ... start + len(text)]; gives the count at the end, the last pre-token's start and the
        count there."""
        last, known, begin = 0, base, 0
        for piece in self.split(text):
            last, known, begin = begin, base, begin + len(piece)
            table = self.piece(piece.encode())
            at = 0
            for n, char in enumerate(piece, 1):
                at += len(char.encode())
                counts[start + last + n] = base + table[at]
            if piece in ("'re", "'ve", "'ll"):  # begun, these are an apostrophe and a letter
                counts[start + last + 1], counts[start + last + 2] = base + 1, base + 2
            base += table[-1]
        for run in _SPACE_RUN.finditer(text):  # a prefix that ends in white space ends in one pre-token
            if run.end() - run.start() > 1:
                before, at, table = counts[start + run.start()], 0, self.piece(run[0].encode())
                for n, char in enumerate(run[0], 1):
                    at += len(char.encode())
                    counts[start + run.start() + n] = before + table[at]
        return base, last, known

    def chunk(self, text: str) -> np.ndarray:
        """Counts at all prefixes (by characters) of one chunk; [-1] is its total."""
        counts = np.zeros(len(text) + 1, np.int64)
        base = start = 0
        cuts = [*self.cut_special.finditer(text), None]
        for cut in cuts:
            part = text[start : cut.start() if cut else len(text)]
            base, last, known = self.segment(part, counts, start, base)
            if cut:
                lead = part[last:]
                for p in range(cut.start() + 1, cut.end()):  # begun, a special string is ordinary text
                    begun = lead + text[cut.start() : p]
                    counts[p] = known + sum(self.piece(x.encode())[-1] for x in self.split(begun))
                start, base = cut.end(), base + 1
                counts[start] = base
        return counts

    def chunk_total(self, text: str) -> int:
        """The count at the end of one chunk, by the same recurrence."""
        if self.cut_special.search(text):
            return int(self.chunk(text)[-1])
        return sum(map(self.ended.__getitem__, self.split(text)))

    # one text ----------------------------------------------------------------------------------------------------

    def totals(self, text: str) -> tuple[list[str], np.ndarray]:
        """The chunks of a text and the counts at their ends."""
        if _RUN_BEFORE_BLANK.search(text) or not text:
            chunks = _CHUNKS.findall(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]
        return chunks, np.cumsum(np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks)))

    def total(self, text: str) -> int:
        return int(ends[-1]) if (ends := self.totals(text)[1]).size else 0

    def prefix_counts(self, text: str) -> np.ndarray:
        """Counts at all prefixes (by characters) of a text."""
        chunks, ends = self.totals(text)
        parts, base = [np.zeros(1, np.int64)], 0
        for chunk, end in zip(chunks, ends.tolist(), strict=True):
            parts.append(self.chunk(chunk)[1:] + base)
            base = end
        return np.concatenate(parts)

    def cut(self, chunks: list[str], ends: np.ndarray, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens."""
        whole = int(np.searchsorted(ends, limit, side="right"))
        kept = sum(map(len, chunks[:whole]))
        if whole == len(chunks):
            return kept
        inside = self.chunk(chunks[whole]) + (int(ends[whole - 1]) if whole else 0)
        return kept + int(np.flatnonzero(inside <= limit)[-1])


class _Remembered(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


@functools.cache
def counter(ranks: str, model: str) -> PrefixCounts:
    """One set of tables for each Python worker."""
    return PrefixCounts(ranks, model)


def count_prefixes(docs: DataFrame, ranks: str, model: str, limits: tuple[int, ...] = (), prefixes: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, ``n_tokens`` and ``cut_<limit>``, the characters of the longest prefix that
    has at most that many tokens; with ``prefixes`` also ``prefix_tokens``, the count at every prefix by characters
    (from 0), which answers any later question about the text.

    Rows map one to one: repeated rows and null ids stay, a null text counts as empty, columns other than the two named
    are not read. Each row is worked on alone, so there is no shuffle.
    """
    schema = f"{id_col} long, n_bytes long, n_tokens long" + "".join(f", cut_{n} long" for n in limits) + ", prefix_tokens array<int>" * prefixes

    def run(batch: pa.RecordBatch):
        tables = counter(ranks, model)
        for part in slices(batch, "t"):
            texts = [t or "" for t in part["t"].to_pylist()]
            rows = []
            for text in texts:
                chunks, ends = tables.totals(text)
                total = int(ends[-1]) if ends.size else 0
                rows.append((len(text.encode()), total, *(len(text) if total <= n else tables.cut(chunks, ends, n) for n in limits)))
            columns = [part["i"], *(pa.array([r[n] for r in rows], pa.int64()) for n in range(2 + len(limits)))]
            names = [id_col, "n_bytes", "n_tokens", *(f"cut_{n}" for n in limits)]
            if prefixes:
                columns.append(pa.array([tables.prefix_counts(t).astype(np.int32) for t in texts], pa.list_(pa.int32())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].cast("string").alias("t")), run, schema)


def op2_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, model = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
    counts = count_prefixes(table(spark, sf_dir, "documents"), ranks, model, limits=(512,))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "cut_512")
