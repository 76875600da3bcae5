"""Token ids of a lower-casing word BPE, word by word.

Words (cut at white space, which the tokenizer drops) are encoded independently of each other, so the ids of a text are
the ids of its words in turn. Ids are remembered for the words seen of late; a new word of common letters is merged by
the rank-based BPE of tiktoken, anything else is given to the tokenizers library itself.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np

from casebook.llm.common import Remembered

_WHITE = re.compile("[\t\n\x0b\x0c\r \u0085   -     　]+")
#: White space for str.split() alone, ordinary characters for the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: For these and special strings the library decides. The rest has one NFC form and lower-case letters of one character.
_UNCOMMON = re.compile("[^\x00-\x7f\xa0-įı-ſ]|<\\|")
#: Stands for the end of a word inside the rank table; no UTF-8 text holds this byte.
_END = b"\xff"
REMEMBERED = 400_000


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies (a fixed format): printable bytes for themselves,
    the others in turn from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class WordIds(Remembered):
    """word -> its ids as little-endian unsigned 32-bit integers."""

    most = REMEMBERED

    def __init__(self, model: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(model)
        with open(model, encoding="utf-8") as file:
            whole = json.load(file)
        letters, vocab, merges = _byte_letters(), whole["model"]["vocab"], whole["model"]["merges"]
        end = whole["model"]["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            ends = token.endswith(end) and len(token) > len(end)
            return bytes(letters[c] for c in (token[: -len(end)] if ends else token)) + _END * ends

        order: dict[bytes, int] = {}  # which pair is merged first
        ids: list[int] = []
        first = [chr_ + end for chr_ in letters if chr_ + end in vocab]
        for token in [*first, *(a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in merges)), *letters]:
            if (key := raw(token)) not in order:
                order[key] = len(ids)
                ids.append(vocab[token])
        self.ids = [np.array(n, "<u4").tobytes() for n in ids]
        self.bpe = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=order, special_tokens={})
        pattern = next(p["pattern"]["Regex"] for p in whole["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern)

    def __missing__(self, word: str) -> bytes:
        if _UNCOMMON.search(word):
            value = np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            low, ranks = word.lower(), []
            for piece in (low,) if low.isalpha() else self.pieces.findall(low):
                ranks += self.bpe._encode_single_piece(piece.encode() + _END)
            value = b"".join([self.ids[n] for n in ranks])
        if len(word) <= 64:
            self.put(word, value)
        return value

    def of(self, text: str) -> bytes:
        words = _WHITE.split(text) if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, words))


@functools.cache
def word_ids(model: str) -> WordIds:
    """One memory for each Python worker."""
    return WordIds(model)
