"""Fill-in-the-middle transformation: texts cut at two random units and put together again in another order.

A unit is a run of ASCII letters or a single other code point. The bytes of the texts of a batch are put in four classes
and indexed by a wavelet matrix; ranks of the classes add up to the units and the code points before any byte, and a
bisection on those ranks, for all texts at once, finds the byte at which a given number of units ends.

Null texts count as empty; an empty text, a text that holds one of the markers and a share of all others stay plain. The
cuts depend on ``doc_id`` and the seed only (a null id counts as the empty text), so repeated rows are cut alike. Columns
of ``docs`` are kept, whatever their names; added columns evade them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import fresh, map_arrow, pieces, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of the texts that are transformed, and of these that put the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1

#: Classes of bytes: a letter after a letter, a letter that begins a run, the first byte of another code point, later bytes.
INNER, BEGIN, OTHER, TAIL = range(4)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_KIND = np.array([TAIL if 0x80 <= b < 0xC0 else OTHER for b in range(256)], np.uint8)
_KIND[_LETTER] = INNER


@dataclass
class Bits:
    """A bit vector that counts the ones before any place: totals before each 64-bit word and bits inside it."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, bits: np.ndarray) -> Bits:
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        words = packed.view("<u8")
        return cls(words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)


class WaveletMatrix:
    """Counts of each of four symbols before any place of a sequence."""

    def __init__(self, symbols: np.ndarray):
        high = symbols > 1
        self.size = len(symbols)
        self.high = Bits.of(high)
        self.low = Bits.of(np.concatenate([symbols[~high], symbols[high]]) & 1)
        self.zeros = self.size - int(np.count_nonzero(high))
        #: Ones of the low bits in front of the symbols with the high bit.
        self.split = int(self.low.rank(np.array([self.zeros]))[0])

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        ones = self.high.rank(places)
        if symbol > 1:
            low, n = self.low.rank(self.zeros + ones) - self.split, ones
        else:
            n = places - ones
            low = self.low.rank(n)
        return low if symbol & 1 else n - low


def classes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The class of every byte; runs of letters never span two texts."""
    kind, letter = _KIND[data], _LETTER[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    begins[heads] = letter[heads]
    kind[begins] = BEGIN
    return kind


class Units:
    """Units and code points of the texts in a batch, by ranks."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.matrix = WaveletMatrix(classes(data, bounds))
        self.start, self.stop = bounds[:-1], bounds[1:]
        self.base = self._before(self.start)
        self.n = self._before(self.stop) - self.base

    def _before(self, places: np.ndarray) -> np.ndarray:
        return self.matrix.rank(BEGIN, places) + self.matrix.rank(OTHER, places)

    def places(self, units: np.ndarray) -> np.ndarray:
        """For each text the byte at which so many of its units end: the last place with no more unit starts before it."""
        low, high = self.start.copy(), self.stop.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            fits = self._before(middle) - self.base <= units
            low = np.where(open_ & fits, middle, low)
            high = np.where(open_ & ~fits, middle - 1, high)
        return low

    def code_points(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        return stop - start - (self.matrix.rank(TAIL, stop) - self.matrix.rank(TAIL, start))


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits that depend on the id and the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``docs`` with n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output in place of text."""
    rest = [c for c in docs.columns if c != "text"]
    names = fresh(docs, "n", "form", "prefix_chars", "middle_chars", "output")
    h1, h2, form = fresh(docs, "h1", "h2", "kind")
    h = draws(F.col("doc_id"), seed)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    kind = (
        F.when((text == "") | marked | (h[2] % 100 >= transformed), "plain")
        .when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    )
    ready = docs.select(*[F.col(f"`{c}`") for c in rest], text.alias("text"), h[0].alias(h1), h[1].alias(h2), kind.alias(form))
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, bounds = utf8(batch.column("text"))
            units = Units(data, bounds)
            cuts = [batch.column(c).to_numpy() % (units.n + 1) for c in (h1, h2)]
            first, second = (units.places(f(*cuts)) for f in (np.minimum, np.maximum))
            kinds, raw, out = batch.column(form).to_pylist(), data.tobytes(), []
            for kind, a, b, c, d in zip(kinds, bounds[:-1].tolist(), first.tolist(), second.tolist(), bounds[1:].tolist(), strict=True):
                if kind == "plain":
                    out.append(raw[a:d])
                elif kind == "psm":
                    out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                else:
                    out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
            plain = np.array([k == "plain" for k in kinds], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in rest], pa.array(units.n), batch.column(form),
                    pa.array(units.code_points(bounds[:-1], first), mask=plain), pa.array(units.code_points(first, second), mask=plain),
                    pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(batch.column("text").type),
                ],
                names=[*rest, *names],
            )

    fields = ", ".join(f"`{c}` {t}" for c, t in zip(names, ("long", "string", "long", "long", "string"), strict=True))
    schema = ", ".join([*[f"`{c}` {ready.schema[c].dataType.simpleString()}" for c in rest], fields])
    return map_arrow(ready, run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that a transformed one was made from. A marker occurs once in it, as no text with a marker is transformed."""
    cell = F.col(output)

    def part(column: Column, marker: str, number: int) -> Column:
        return F.split_part(column, F.lit(marker), F.lit(number))

    middle, head = part(cell, MIDDLE, 2), part(cell, MIDDLE, 1)
    psm = F.concat(part(part(head, SUFFIX, 1), PREFIX, 2), middle, part(head, SUFFIX, 2))
    spm = F.concat(part(head, PREFIX, 2), middle, part(part(head, PREFIX, 1), SUFFIX, 2))
    return F.when(F.col(form) == "plain", cell).when(F.col(form) == "psm", psm).otherwise(spm)
