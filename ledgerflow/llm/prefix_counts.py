"""Token counts of every prefix by dynamic programming.

A byte-pair encoding of a text ends in one token, and what stands before that
token is the encoding of the prefix it leaves.  So the encoding of every prefix
follows from shorter ones: of the tokens that end there, exactly one may follow
the last token of the prefix before it, namely the one that the merges would not
join or cut in that place (looked up pair by pair, and kept).  Its count is the
shorter prefix's count and one more.  A character that the vocabulary lacks
counts as its UTF-8 bytes and joins with nothing.

The programme runs once a distinct chunk (see ``chunks``); counts at all prefixes
of a text are running sums over its chunks.  Stored as differences (a byte a
code point), they answer questions about budgets and truncation without encoding
again: ``tokens_at`` and ``longest_within``.

A count may fall as a text grows (a longer token swallows several), so
``longest_within`` is the last prefix within the budget, not the first beyond it.

Defined cases: null text is empty and has no token; repeated rows are rows of
their own; an empty table gives no rows; null ids stay null; other columns are
ignored; long texts are summed in windows of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.chunks import Memory, by_bytes, chunked, gather
from ledgerflow.llm.common import whole_text

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
WINDOW = 1_000_000
PAIRS = 400_000
SPACE = "▁"


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class PrefixCounter:
    """Counts at all prefixes of chunks, for a vocabulary of scored pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {i: model.id_to_piece(i) for i in range(model.get_piece_size())}
        plain = [i for i in names if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.rank = {names[i]: -model.get_score(i) for i in plain}
        if any(a != SPACE and b == SPACE for p in self.rank for a, b in zip(p, p[1:])):
            raise ValueError("a piece holds a space behind another character")
        # pieces and their ends: 1 a token, 0 only the end of one, 2 not looked at yet
        self.kind = {p[i:]: 0 for p in self.rank for i in range(1, len(p))} | dict.fromkeys(self.rank, 2)
        self.follows: dict[str, dict[str, bool]] = {}
        self.pairs = 0

    def merged(self, text: str) -> list[str]:
        """The merges themselves, for single tokens and pairs of them."""
        parts, rank = list(text), self.rank
        keys = [rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
        while keys and (best := min(keys)) != np.inf:
            i = keys.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del keys[i]
            if i:
                keys[i - 1] = rank.get(parts[i - 1] + parts[i], np.inf)
            if i < len(keys):
                keys[i] = rank.get(parts[i] + parts[i + 1], np.inf)
        return parts

    def is_token(self, piece: str) -> int:
        """Whether the merges ever make this piece."""
        self.kind[piece] = int(self.merged(piece) == [piece])
        return self.kind[piece]

    def may_follow(self, before: str, piece: str) -> bool:
        self.pairs += 1
        if self.pairs > PAIRS:
            self.follows.clear()
            self.pairs = 0
        known = self.merged(before + piece) == [before, piece]
        self.follows.setdefault(before, {})[piece] = known
        return known

    def chunks(self, chunks: list[str]) -> list[bytes]:
        """Of each chunk: the count at each prefix of the space and the chunk, less the
        count before (int8).  In sorted order, a chunk goes on where the one before
        it parts from it."""
        kind, follows, rank = self.kind, self.follows, self.rank
        out = [b""] * len(chunks)
        old, last, count, step = "", [""], [0], []
        for k in sorted(range(len(chunks)), key=chunks.__getitem__):
            text = SPACE + chunks[k].replace(" ", SPACE)
            same = 0
            for a, b in zip(old, text):
                if a != b:
                    break
                same += 1
            old = text
            del last[same + 1:], count[same + 1:], step[same:]
            for end in range(same + 1, len(text) + 1):
                if text[end - 1] not in rank:
                    piece, now = "", count[-1] + len(text[end - 1].encode("utf-8", "replace"))
                else:
                    for begin in range(end - 1, -1, -1):
                        piece = text[begin:end]
                        token = kind[piece]
                        if token == 0 or (token == 2 and not self.is_token(piece)):
                            continue
                        before = last[begin]
                        if not before:
                            break
                        known = follows.get(before)
                        fits = known.get(piece) if known else None
                        if fits or (fits is None and self.may_follow(before, piece)):
                            break
                    now = count[begin] + 1
                step.append((now - count[-1]) & 255)
                last.append(piece)
                count.append(now)
            out[k] = bytes(step)
        return out


class TextCounts:
    """Counts of whole texts, a bounded number of characters at a time."""

    def __init__(self, path: str, limit: int, prefixes: bool):
        self.limit, self.prefixes = limit, prefixes
        self.memory = Memory(PrefixCounter(path).chunks)

    def slice(self, texts: pa.Array) -> tuple[list[int], list[int], list[bytes]]:
        """Of each text: its tokens, the code points of its longest prefix within
        the limit, and (on request) the differences at all prefixes."""
        distinct, code, bounds = chunked(texts)
        found = self.memory(distinct)
        size_of = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.frombuffer(b"".join(found), np.int8)
        at = (np.cumsum(size_of) - size_of)[code] if len(code) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(size_of[code])])
        ends = upto[bounds]
        tokens, fits = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        parts: list[list[bytes]] = [[] for _ in range(len(texts))] if self.prefixes else []
        lo, before, text, base = 0, 0, 0, 0
        while lo < len(code):
            hi = max(int(np.searchsorted(upto, upto[lo] + WINDOW, side="right")) - 1, lo + 1)
            step = gather(flat, at[lo:hi], size_of[code[lo:hi]])
            count = np.cumsum(step, dtype=np.int64) + before
            begin, end = int(upto[lo]), int(upto[hi])
            while text < len(texts) and ends[text] < end:
                i, j = max(int(ends[text]), begin), min(int(ends[text + 1]), end)
                here = count[i - begin:j - begin] - base
                inside = np.flatnonzero(here <= self.limit)
                if len(inside):
                    fits[text] = i - ends[text] + inside[-1]
                tokens[text] = here[-1]
                if self.prefixes:
                    parts[text].append(step[i - begin:j - begin].tobytes())
                if j < ends[text + 1]:
                    break
                base += int(here[-1])
                text += 1
            lo, before = hi, int(count[-1])
        blank = np.diff(ends) == 1  # the space before the text and nothing else
        tokens[blank] = 0
        return tokens.tolist(), fits.tolist(), [b"" if e else b"".join(p) for p, e in zip(parts, blank)]


def count_tokens(docs: DataFrame, limit: int = LIMIT, prefixes: bool = False, model_path: str | None = None) -> DataFrame:
    """One row a document: ``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` (code
    points of the longest prefix of at most ``limit`` tokens) and, if ``prefixes``,
    ``prefix``: the stored counts, for ``tokens_at`` and ``longest_within``."""
    path = model_path or default_model_path()
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + (", prefix binary" if prefixes else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TextCounts(path, limit, prefixes)
        for batch in batches:
            for lo, hi in by_bytes(batch.column(2)):
                tokens, fits, stored = counts.slice(batch.column(2).slice(lo, hi - lo))
                columns = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(tokens, pa.int64()),
                           pa.array([n > limit for n in tokens], pa.bool_()), pa.array(fits, pa.int64())]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
                if prefixes:
                    columns, names = [*columns, pa.array(stored, pa.binary())], [*names, "prefix"]
                yield pa.RecordBatch.from_arrays(columns, names)

    text = whole_text()
    return docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(run, schema)


def _counts(prefix: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(prefix, np.int8), dtype=np.int64)


def tokens_at(prefix: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points, from stored counts."""

    @F.pandas_udf("long")
    def look(prefix: pd.Series, chars: pd.Series) -> pd.Series:
        out = []
        for p, n in zip(prefix, chars):
            n = min(max(int(n), 0), max(len(p) - 1, 0))
            out.append(int(_counts(p)[n]) if n else 0)
        return pd.Series(out, dtype="int64")

    return look(prefix, chars)


def longest_within(prefix: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens, from stored counts."""

    @F.pandas_udf("long")
    def look(prefix: pd.Series, budget: pd.Series) -> pd.Series:
        out = []
        for p, n in zip(prefix, budget):
            inside = np.flatnonzero(_counts(p)[1:] <= int(n))
            out.append(int(inside[-1]) + 1 if len(inside) else 0)
        return pd.Series(out, dtype="int64")

    return look(prefix, budget)
