"""Static range asymmetric numeral system: many interleaved coders, one frequency table, checkpoints and checksums.

A block is a header, checkpoints and a stream of 32-bit words. Symbol i belongs to lane i % lanes; in each step every lane
decodes one symbol and then, if its state is low, takes the next word of the stream. A checkpoint holds the states of all lanes
and the place in the stream before a step, so a block can be decoded from any of them, and its parts in parallel.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

PROB_BITS = 20
LOW = np.uint64(1 << 31)
LANES = 2048
#: Steps from one checkpoint to the next.
EVERY = 256
MAGIC = b"rANS"
_HEAD = struct.Struct("<4sIIIIII")  # magic, table checksum, symbols, lanes, checkpoints, words, symbol checksum


@dataclass
class Table:
    """Frequencies that add up to 2**PROB_BITS; a symbol that never occurred has none."""

    freq: np.ndarray

    def __post_init__(self):
        self.freq = self.freq.astype(np.uint64)
        self.start = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - PROB_BITS)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.checksum = zlib.crc32(self.freq.astype("<u4").tobytes())

    @staticmethod
    def of(counts: np.ndarray) -> Table:
        """Frequencies in proportion to the counts, at least 1 for each symbol that occurs."""
        counts = np.asarray(counts, np.float64)
        used = np.flatnonzero(counts)
        if not len(used):
            return Table(np.array([1 << PROB_BITS]))
        if len(used) > 1 << (PROB_BITS - 1):
            raise ValueError("more symbols than the table has room for")
        freq = np.zeros(len(counts), np.int64)
        freq[used] = np.maximum(1, np.floor(counts[used] / counts.sum() * (1 << PROB_BITS)).astype(np.int64))
        # Rounding is settled with the largest frequencies, one after the other.
        rest = (1 << PROB_BITS) - int(freq.sum())
        for s in used[np.argsort(-freq[used], kind="stable")]:
            step = max(rest, 1 - int(freq[s]))
            freq[s] += step
            rest -= step
            if not rest:
                break
        return Table(freq)


def encode(symbols: np.ndarray, table: Table) -> bytes:
    n = len(symbols)
    lanes = min(LANES, 1 << max(0, (n // 64).bit_length() - 1)) if n else 1
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    bits, shift = np.uint64(PROB_BITS), np.uint64(32)
    words, states, places, written = [], [], [], 0
    for t in range(steps - 1, -1, -1):
        s = symbols[t * lanes : (t + 1) * lanes]
        x, f = state[: len(s)], table.freq[s]
        full = x >= table.limit[s]
        out = x[full].astype(np.uint32)
        words.append(out)
        written += len(out)
        x = np.where(full, x >> shift, x)
        q = x // f
        state[: len(s)] = (q << bits) + (x - q * f) + table.start[s]
        if t % EVERY == 0:
            states.append(state.copy())
            places.append(written)
    stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    head = _HEAD.pack(MAGIC, table.checksum, n, lanes, len(states), len(stream), zlib.crc32(symbols.astype("<u4").tobytes()))
    body = b"".join([head, *[np.uint32(written - p).astype("<u4").tobytes() + s.astype("<u8").tobytes()
                             for p, s in zip(places[::-1], states[::-1], strict=True)], stream.astype("<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The symbols from checkpoint `first` up to checkpoint `last`, or all."""
    body = memoryview(block)[:-4]
    if zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("the block is damaged")
    magic, made_with, n, lanes, checkpoints, n_words, checksum = _HEAD.unpack_from(body)
    if magic != MAGIC or made_with != table.checksum:
        raise ValueError("no block of this table")
    out = np.empty(n, np.uint32)
    if not n:
        return out
    size = 4 + 8 * lanes
    last = checkpoints if last is None else min(last, checkpoints)
    stream = np.frombuffer(body, "<u4", n_words, _HEAD.size + checkpoints * size)
    at = struct.unpack_from("<I", body, _HEAD.size + first * size)[0]
    state = np.frombuffer(body, "<u8", lanes, _HEAD.size + first * size + 4).copy()
    bits, shift, mask = np.uint64(PROB_BITS), np.uint64(32), np.uint64((1 << PROB_BITS) - 1)
    begin, end = first * EVERY * lanes, min(n, last * EVERY * lanes)
    for p in range(begin, end, lanes):
        stop = min(p + lanes, end)
        x = state[: stop - p]
        slot = x & mask
        s = table.symbol[slot.astype(np.int64)]
        out[p:stop] = s
        x = table.freq[s] * (x >> bits) + slot - table.start[s]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << shift) | stream[at : at + len(low)]
        at += len(low)
        state[: stop - p] = x
    out = out[begin:end]
    if len(out) == n and zlib.crc32(out.astype("<u4").tobytes()) != checksum:
        raise ValueError("the decoded symbols differ")
    return out
