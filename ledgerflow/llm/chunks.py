"""Whole texts as chunks that two kinds of subword tokenizers treat apart.

A chunk begins with a space that follows a character other than white space (or
with the space put before the text), so no token of a vocabulary whose pieces
hold a space only in front crosses from one chunk to the next.  Each distinct
chunk is worked on once, and texts are put together from the results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
CACHE_BYTES = 64_000_000
#: a part that ends so is not closed: white space (Unicode) and the mark that stands for a space
OPEN_END = "(?:^|[\t-\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{2581}])$"


def by_bytes(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold at most ``limit`` bytes, or one text."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    lo, done = 0, 0
    while lo < len(upto):
        hi = max(int(np.searchsorted(upto, done + limit, side="right")), lo + 1)
        yield lo, hi
        lo, done = hi, int(upto[hi - 1])


def chunked(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``distinct chunks (without the space before each), code of every chunk in
    order, bounds of each text among them``."""
    distinct, code, bounds = chunked_array(texts)
    return distinct.to_pylist(), code, bounds


def chunked_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``chunked``, with the distinct chunks left in Arrow."""
    parts = pc.split_pattern(texts, " ")
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    open_part = pc.match_substring_regex(coded.dictionary, OPEN_END).to_numpy(zero_copy_only=False)
    glued = open_part[code] if len(code) else np.zeros(0, bool)
    glued[bounds[1:] - 1] = False
    if not glued.any():
        return coded.dictionary, code, bounds
    distinct = coded.dictionary.to_pylist()
    begins = np.concatenate([[True], ~glued[:-1]])
    first = np.flatnonzero(begins)
    long = glued[first]
    known: dict[str, int] = {}
    out = code[first]
    ends = np.append(first[1:], len(code))
    for k in np.flatnonzero(long).tolist():
        word = " ".join([distinct[c] for c in code[first[k]:ends[k]].tolist()])
        out[k] = known.setdefault(word, len(distinct) + len(known))
    return pa.array(distinct + list(known), texts.type), out, np.searchsorted(first, bounds)


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]``, end to end."""
    total = int(size.sum())
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.repeat((start - (np.cumsum(size) - size)).astype(kind), size)
    at += np.arange(total, dtype=kind)
    return flat.take(at)


class Memory:
    """Results of chunks seen before, within a bound of bytes."""

    def __init__(self, work: Callable[[list[str]], list[bytes]], limit: int = CACHE_BYTES):
        self.work, self.limit = work, limit
        self.known: dict[str, bytes] = {}
        self.held = 0

    def __call__(self, chunks: list[str]) -> list[bytes]:
        """The result of each of some different chunks."""
        if self.held > self.limit:
            self.known.clear()
            self.held = 0
        out = list(map(self.known.get, chunks))
        missing = [i for i, r in enumerate(out) if r is None]
        if missing:
            new = [chunks[i] for i in missing]
            found = self.work(new)
            for i, r in zip(missing, found):
                out[i] = r
            kept = {c: r for c, r in zip(new, found) if len(c) < 200}
            self.known.update(kept)
            self.held += sum(map(len, kept)) + sum(map(len, kept.values())) + 180 * len(kept)
        return out
