"""Elias-Fano lists: non-decreasing numbers in about 2 + log2(largest / count) bits each.

Each number is split: its low bits are stored as they are, its high part in unary, as a one at
position ``high + rank`` of a bit array. The k-th number needs the k-th one: ``select`` starts from
the sampled one before it and counts ones in a few bytes from there. The samples are stored with the
list, an eighth of a bit per number, so a list that is read is ready for use.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQBQQ")  # count, largest, low bits, bytes of low bits, bytes of high bits
_STEP = 64
# A position is kept for every so many ones, in 32 bits.
SAMPLE = 256
_BLOCK = 1 << 16

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(1).astype(np.int64)


class EliasFano:
    def __init__(
        self, count: int, largest: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray
    ) -> None:
        self.count, self.largest, self.bits = count, largest, bits
        self._low, self._high, self._samples = low, high, samples

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, np.uint64)
        if len(numbers) and (numbers[1:] < numbers[:-1]).any():
            raise ValueError("numbers must not decrease")
        count = len(numbers)
        largest = int(numbers[-1]) if count else 0
        bits = max(0, (largest // count).bit_length() - 1) if count else 0
        places = (numbers >> np.uint64(bits)).astype(np.int64) + np.arange(count)
        unary = np.zeros(int(places[-1]) + 1 if count else 0, np.uint8)
        unary[places] = 1
        low = np.zeros(count * bits, np.uint8)
        for first in range(0, count, _BLOCK):
            part = numbers[first : first + _BLOCK, None] >> np.arange(bits, dtype=np.uint64)
            low[first * bits : (first + len(part)) * bits] = (part & np.uint64(1)).ravel()
        pack = lambda x: np.packbits(x, bitorder="little")
        return cls(count, largest, bits, pack(low), pack(unary), places[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.count, self.largest, self.bits, len(self._low), len(self._high))
        return head + self._low.tobytes() + self._high.tobytes() + self._samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes | memoryview, at: int = 0) -> tuple[EliasFano, int]:
        """The list stored at a position, and the position behind it."""
        count, largest, bits, n_low, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        samples = np.frombuffer(data, "<u4", -(-count // SAMPLE), at)
        return cls(count, largest, bits, low, high, samples), at + samples.nbytes

    def select_many(self, ks: np.ndarray) -> np.ndarray:
        """``select`` of many at once, each from its sample; memory follows their number alone."""
        position = self._samples[ks // SAMPLE].astype(np.int64)
        byte = position // 8
        before = _ONES[self._high[byte] & ((1 << position % 8) - 1)]
        missing = ks % SAMPLE + before
        found = np.empty(len(ks), np.int64)
        left = np.arange(len(ks))
        window = np.arange(_STEP)
        while len(left):
            at = byte[left, None] + window
            held = np.where(at < len(self._high), self._high[np.minimum(at, len(self._high) - 1)], 0)
            ones = np.cumsum(_ONES[held], axis=1)
            here = ones[:, -1] > missing[left]
            done = left[here]
            inside = (ones[here] <= missing[done, None]).sum(axis=1)
            counted = np.where(inside > 0, ones[here][np.arange(len(done)), np.maximum(inside - 1, 0)], 0)
            value = held[here][np.arange(len(done)), inside]
            nth = (np.cumsum(_BITS[value], axis=1) <= (missing[done] - counted)[:, None]).sum(axis=1)
            found[done] = (byte[done] + inside) * 8 + nth
            missing[left] -= ones[:, -1]
            byte[left] += _STEP
            left = left[~here]
        return found

    def take(self, ks: np.ndarray) -> np.ndarray:
        """The numbers at some places, through ``select``."""
        ks = np.asarray(ks, np.int64)
        numbers = (self.select_many(ks) - ks).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            bit = ks[:, None] * self.bits + np.arange(self.bits)
            bits = (self._low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
            numbers |= bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))
        return numbers

    def select(self, k: int) -> int:
        """Position of the k-th one of the unary part."""
        position = int(self._samples[k // SAMPLE])
        missing = k % SAMPLE
        byte = position // 8
        # Ones before the sampled one in its byte are counted along.
        missing += int(_ONES[self._high[byte] & ((1 << position % 8) - 1)])
        while True:
            ones = np.cumsum(_ONES[self._high[byte : byte + 64]])
            inside = int(np.searchsorted(ones, missing, "right"))
            if inside < len(ones):
                missing -= int(ones[inside - 1]) if inside else 0
                bits = np.flatnonzero(
                    np.unpackbits(self._high[byte + inside : byte + inside + 1], bitorder="little")
                )
                return (byte + inside) * 8 + int(bits[missing])
            missing -= int(ones[-1])
            byte += 64

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, k: int) -> int:
        if not 0 <= k < self.count:
            raise IndexError(k)
        first = k * self.bits
        part = self._low[first // 8 : (first + self.bits + 7) // 8].tobytes()
        low = int.from_bytes(part, "little") >> first % 8 & ((1 << self.bits) - 1)
        return (self.select(k) - k) << self.bits | low

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.count]
        numbers = (places - np.arange(self.count)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            bits = np.unpackbits(self._low, bitorder="little")[: self.count * self.bits]
            weights = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
            for first in range(0, self.count, _BLOCK):
                part = bits[first * self.bits : (first + _BLOCK) * self.bits]
                numbers[first : first + _BLOCK] += part.reshape(-1, self.bits).astype(np.uint64) @ weights
        return numbers
