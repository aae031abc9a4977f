"""Token counts by byte-pair merging with a heap and a linked list.

A text starts as a list of symbols, one per character. The adjacent pair of lowest rank is popped
from a heap and merged, until no pair is left; the count is the number of symbols at the start
less the number of merges. No ids are produced. A character without a piece of its own stands for
its UTF-8 bytes, as the vocabulary falls back to bytes.

No piece of the vocabulary has a word mark behind another character, nor a line break, so merges
never cross such places: a text is counted piece of text by piece of text, and counts are
remembered up to a bound.

Defined results: a NULL or empty text has 0 tokens and 0 bytes. Every row is counted by itself, so
repeated rows and other columns make no difference. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.text import whole_text
from tillstream.llm.worker_memory import remember

LIMIT = 4096
MARK = "▁"
MAX_REMEMBERED = 400_000
MAX_KEY_CHARS = 64


class PieceCounter(dict):
    """Counts of parts of a text, by part."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            k
            for k in range(model.get_piece_size())
            if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))
        ]
        self.ranks = {model.id_to_piece(k): -model.get_score(k) for k in plain}
        if any(MARK in piece.lstrip(MARK) for piece in self.ranks):
            raise ValueError("a piece goes on into the next word")
        signs = set("".join(self.ranks))
        alone = "".join(x for x in "\n\r\t" if x not in signs)
        self._parts = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + f"|[{alone}]" * bool(alone)).findall

    def merged(self, text: str) -> int:
        """Symbols at the start less merges."""
        ranks, n = self.ranks, len(text)
        end = list(range(1, n + 1))  # of the symbol that starts here; the next one starts there
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = [
            (rank, k, k + 2)
            for k in range(n - 1)
            if (rank := ranks.get(text[k : k + 2])) is not None
        ]
        heapify(heap)
        merges = 0
        while heap:
            _, left, stop = heappop(heap)
            if not alive[left] or end[left] >= n or end[end[left]] != stop:
                continue  # one of the two has been merged since
            alive[end[left]] = False
            end[left] = stop
            merges += 1
            if stop < n:
                before[stop] = left
                rank = ranks.get(text[left : end[stop]])
                if rank is not None:
                    heappush(heap, (rank, left, end[stop]))
            if (first := before[left]) >= 0:
                rank = ranks.get(text[first:stop])
                if rank is not None:
                    heappush(heap, (rank, first, stop))
        symbols = n
        for k, x in enumerate(text):
            if x not in ranks and alive[k] and end[k] == k + 1:
                symbols += len(x.encode()) - 1
        return symbols - merges

    def __missing__(self, part: str) -> int:
        count = self.merged(part)
        if len(part) <= MAX_KEY_CHARS:
            if len(self) >= MAX_REMEMBERED:
                self.clear()
            self[part] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self._parts(MARK + text.replace(" ", MARK))))


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """One per worker process and file."""
    remember("bpe_count", _COUNTERS.clear)
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def token_count(text: Column, model: str) -> Column:
    """Number of tokens of each whole text."""

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        library = counter(model)
        return texts.map(library.count)

    return counted(whole_text(text))


def count_tokens(
    docs: DataFrame, model: str, text_col: str = "text", limit: int = LIMIT, prefix: str = ""
) -> DataFrame:
    """The documents with ``n_bytes``, ``n_tokens`` and ``over_limit``, each behind ``prefix``.

    These take the place of columns of the same name; with ``prefix`` both can stay. An empty table
    gives an empty table.
    """
    n_tokens = F.col(f"{prefix}n_tokens")
    return (
        docs.withColumn(f"{prefix}n_bytes", F.octet_length(whole_text(text_col)).cast("long"))
        .withColumn(f"{prefix}n_tokens", token_count(F.col(text_col), model))
        .withColumn(f"{prefix}over_limit", n_tokens > limit)
    )
