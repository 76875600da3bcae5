"""Words of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from casebook.llm.common import mix64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, back to back, and the number of words of each text.

    Eight bytes of every word are mixed in at a time, so the cost doesn't depend on how many different words there are.
    """
    flat = np.frombuffer(b" ".join([b"", *texts, bytes(8)]), np.uint8)
    space = _SPACE[flat]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    if starts.size > ends.size:  # the padding
        starts = starts[:-1]
    eights = np.lib.stride_tricks.as_strided(flat[:8].view("<u8"), (flat.size - 7,), (1,))
    out = mix64((ends - starts).astype(np.uint64) * _STEP)
    open_ = np.arange(starts.size)
    at, left = starts, ends - starts
    while open_.size:
        piece = eights[at] & _MASKS[np.minimum(left, 8)]
        out[open_] = mix64((out[open_] ^ piece) * _STEP)
        more = left > 8
        open_, at, left = open_[more], at[more] + 8, left[more] - 8
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    counts = np.diff(np.searchsorted(starts, offsets + 1))
    return out, counts


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each position on."""
    n = max(0, words.size - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix64((out ^ words[k : k + n]) * _STEP + np.uint64(k))
    return out
