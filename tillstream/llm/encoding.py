"""Token ids of whole texts by the ``tokenizers`` library, remembered per word.

For a tokenizer that drops white space and never joins over it, the ids of a text are the ids of
its words in order. Most words occur again and again, so each worker keeps the ids that the library
gave for a word. What it keeps is bounded; beyond the bound it starts anew.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np

from tillstream.llm.worker_memory import give_back, remember

MAX_WORDS = 200_000
MAX_WORD_CHARS = 12_000_000
RUN_CHARS = 500_000

# Letters of one code point up to ÿ, then signs other than the apostrophe, that makes endings.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PROBES = (
    "Word", "word,", "WORD...", "a", "don't", "x<|endoftext|>y", "tab\tbed", "été!", "3rd", "Straße,",
    "ÀÉÎÕÜÝÞ", "ñandú;", "øre", "日本", "İx",
)


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte: itself if it can be seen, else one behind the bytes."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = [x for x in range(256) if x not in seen]
    return {x: chr(x) for x in seen} | {x: chr(256 + k) for k, x in enumerate(unseen)}


_SIGNS = _byte_signs()


class _Index(dict):
    """Number of each word; words not seen before are noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.largest_id = max(self._tokenizer.get_vocab(with_added_tokens=True).values())
        self._plain = True
        self._plain = self._ids(_PROBES) == self._whole(_PROBES)
        joined = self._whole([" ".join(_PROBES), "\n".join(_PROBES), "  ".join(_PROBES)])
        apart = [number for ids in self._whole(_PROBES) for number in ids]
        if any(ids != apart for ids in joined):
            raise ValueError(f"{path} does not keep to words")
        self._clear()
        give_back()

    def forget(self) -> None:
        """Drop what is remembered; a worker that waits for another task holds none of it."""
        self._clear()
        give_back()

    def _clear(self) -> None:
        self._index = _Index()
        self._chars = 0
        self._ids_of_words = array("I")
        self._starts = array("I")
        self._lengths = array("I")

    def _whole(self, texts: Sequence[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [x.ids for x in found]

    def _ids(self, words: Sequence[str]) -> list[list[int]]:
        """Ids per word. Plain words need no more of the library than its merges."""
        merges = self._tokenizer.model.tokenize
        out: list = [None] * len(words)
        rest = []
        for place, word in enumerate(words):
            if self._plain and (plain := _PLAIN.fullmatch(word)):
                letters = plain[1].lower()
                if not letters.isascii():
                    letters = letters.encode().decode("latin-1").translate(_SIGNS)
                ids = [x.id for x in merges(letters)]
                out[place] = ids + [x.id for x in merges(plain[2])] if plain[2] else ids
            else:
                rest.append(place)
        for place, ids in zip(rest, self._whole([words[k] for k in rest]), strict=True):
            out[place] = ids
        return out

    def _learn(self) -> None:
        words, self._index.new = self._index.new, []
        for word, ids in zip(words, self._ids(words), strict=True):
            self._starts.append(len(self._ids_of_words))
            self._lengths.append(len(ids))
            self._ids_of_words.extend(ids)
            self._chars += len(word)

    def _run(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._index) > MAX_WORDS or self._chars > MAX_WORD_CHARS:
            self._clear()
        number = self._index.__getitem__
        parts, counts = [], []
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            parts.append(np.fromiter(map(number, words), np.int32, len(words)))
            counts.append(len(words))
        self._learn()
        places = np.concatenate(parts)
        lengths = np.frombuffer(self._lengths, np.uint32)[places].astype(np.int64)
        ends = np.cumsum(lengths)
        starts = np.frombuffer(self._starts, np.uint32)[places] - (ends - lengths)
        source = np.repeat(starts, lengths)
        source += np.arange(len(source))
        ids = np.frombuffer(self._ids_of_words, np.uint32)[source] if len(source) else source
        per_text = np.add.reduceat(lengths, np.cumsum([0, *counts[:-1]]))
        return ids.astype(np.uint32), per_text

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first text, ids, number of ids per text)`` for one run of texts after the other."""
        first = chars = 0
        for end in range(1, len(texts) + 1):
            chars += len(texts[end - 1])
            if chars >= RUN_CHARS or end == len(texts):
                yield first, *self._run(texts[first:end])
                give_back()
                first, chars = end, 0

    def encode_ended(self, texts: Sequence[str], end_id: int) -> Iterator[np.ndarray]:
        """Ids of each text with ``end_id`` behind them."""
        for _, ids, lengths in self.encode(texts):
            ends = np.cumsum(lengths)
            ended = np.insert(ids, ends, end_id).astype("<u4")
            stops = ends + np.arange(1, len(ends) + 1)
            for start, stop in zip([0, *stops[:-1]], stops, strict=True):
                yield ended[start:stop]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and file."""
    remember("encoding", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").data)
