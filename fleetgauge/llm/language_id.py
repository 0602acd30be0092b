"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. One binary classifier per bit, a log-odds table over hashed byte n-grams, says on
which side of that bit's split of the languages a text lies; its calibrated logistic loss is weighted by how reliable the
bit is, and the codeword with the least weighted loss names the language. Texts whose nearest codewords lie close
together, or whose bits are further from every codeword than the code can correct, are flagged as ambiguous.

n-gram counts are gathered over all learning rows by one distributed aggregate, of which languages x buckets numbers reach
the driver, however large the table. Texts are lower-cased and every ASCII byte that is no letter counts as a space.

Null texts and texts without a letter get ``und`` and score 0, as does every text if nothing could be learned; they
teach nothing. With one language learned every text with a letter is of that language, with score 1. Repeated rows each
count and each get a row; any column but ``doc_id``, ``text`` and ``lang`` is passed by, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import fresh, map_arrow, pieces, utf8

NGRAMS = (2, 3, 4)
BUCKETS = 1 << 16
#: Count added to every bucket of every language.
SMOOTHING = 0.5
#: Up to this many languages every split of them is a bit; beyond it bits are drawn at random.
EXHAUSTIVE = 6
#: Learning rows that the calibration of the bits looks at, on average; counts come from all learning rows.
CALIBRATION_ROWS = 50_000
#: Margins are calibrated on a grid of this many steps in both directions, of this width.
STEPS, STEP = 512, 1 / 16
#: A text is ambiguous if its best language leads the next by less than this share of probability.
LEAD = 0.2
#: Positions that one numpy pass works on.
BLOCK = 1 << 21
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PLAIN = np.array([b if b >= 128 or 97 <= b < 123 else 32 for b in range(256)], np.uint8)


def codewords(languages: int) -> np.ndarray:
    """One row of bits per language; the rows of any two languages differ, no bit is the same for all."""
    if languages <= 1:
        return np.zeros((languages, 0), np.int8)
    if languages <= EXHAUSTIVE:
        splits = np.arange((1 << (languages - 1)) - 1)
        rest = [(splits >> j) & 1 for j in range(languages - 1)]
        return np.stack([np.ones_like(splits), *rest]).astype(np.int8)
    rng, best = np.random.default_rng(17), None
    bits = max(31, int(np.ceil(10 * np.log2(languages))))
    while best is None or best[0] == 0:
        for _ in range(20):
            code = rng.integers(0, 2, (languages, bits), dtype=np.int8)
            constant = code.min(axis=0) == code.max(axis=0)
            code[0, constant] = 1 - code[0, constant]
            least = least_distance(code)
            if best is None or least > best[0]:
                best = (least, code)
    return best[1]


def least_distance(code: np.ndarray) -> int:
    """Bits in which the two nearest codewords differ."""
    signs = 2.0 * code - 1
    apart = (code.shape[1] - signs @ signs.T) / 2
    np.fill_diagonal(apart, code.shape[1])
    return int(apart.min()) if len(code) > 1 else 0


@dataclass
class Model:
    """weights: log-odds of each bit (rows) and bucket; slope and offset turn a margin into log-odds; trust weighs the bits."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    offset: np.ndarray
    trust: np.ndarray

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each row of margins: number of the language, its probability, whether it is ambiguous, bits that disagree."""
        n = len(margins)
        if len(self.languages) == 1:
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool), np.zeros(n, np.int32)
        sides = 2.0 * self.code - 1
        odds = margins * self.slope + self.offset
        losses = np.stack([(self.trust * np.logaddexp(0.0, -odds * side)).sum(axis=1) for side in sides], axis=1)
        least = least_distance(self.code)
        shares = np.exp((losses.min(axis=1, keepdims=True) - losses) / least)
        shares /= shares.sum(axis=1, keepdims=True)
        best = losses.argmin(axis=1)
        off = ((odds > 0) != (self.code[best] > 0)).sum(axis=1).astype(np.int32)
        ordered = np.sort(shares, axis=1)
        unsure = (ordered[:, -1] - ordered[:, -2] < LEAD) | (off > (least - 1) // 2)
        return best, np.clip(shares[np.arange(n), best], 0.0, 1.0), unsure, off


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script; false for null."""
    data, bounds = utf8(texts)
    ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data], dtype=np.int64)])
    other = np.concatenate([[0], np.cumsum(data >= 128, dtype=np.int64)])
    found = ascii_letters[bounds[1:]] > ascii_letters[bounds[:-1]]
    for i in np.flatnonzero(~found & (other[bounds[1:]] > other[bounds[:-1]])):
        found[i] = _LETTER.search(data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")) is not None
    return found


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of all n-grams, order by order, in blocks of positions; texts rise within a block.

    A text is framed by spaces, and an n-gram that begins with two spaces does not count.
    """
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    space, after, none = (pa.scalar(s, pa.large_string()) for s in (" ", " " * (max(NGRAMS) - 1), ""))
    data, bounds = utf8(pc.binary_join_element_wise(space, low, after, none))
    data = _PLAIN[data]
    last = len(data) - max(NGRAMS) + 1
    for start in range(0, last, BLOCK):
        own = data[start : min(start + BLOCK, last) + max(NGRAMS) - 1]
        places = len(own) - max(NGRAMS) + 1
        kept = np.flatnonzero((own[:places] != 32) | (own[1 : places + 1] != 32))
        first, stop = np.searchsorted(bounds, [start, start + places - 1], "right") - 1
        inside = np.clip(bounds[first : stop + 2], start, start + places)
        text = np.repeat(np.arange(first, stop + 1), np.diff(inside))[kept]
        code = np.zeros(places, np.uint32)
        for k in range(max(NGRAMS)):
            code |= own[k : k + places].astype(np.uint32) << np.uint32(8 * k)
            if k + 1 in NGRAMS:
                mixed = (code[kept] ^ np.uint32(0x3C6EF372 * (k + 1) & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
                yield text, (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.intp)


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Mean log-odds of each text's n-grams for every bit, times the square root of their number."""
    sums, counts = np.zeros((len(texts), len(weights))), np.zeros(len(texts))
    for text, bucket in grams(texts):
        if not len(text):
            continue
        starts = np.flatnonzero(np.diff(text, prepend=-1))
        counts[text[starts]] += np.diff(starts, append=len(text))
        for b, own in enumerate(weights):
            sums[text[starts], b] += np.add.reduceat(own[bucket], starts, dtype=np.float64)
    return sums / np.sqrt(np.maximum(counts, 1))[:, None]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts per language of one partition; there are at most languages x buckets of them."""
    totals: dict[str, np.ndarray] = {}
    for batch in pieces(batches, "text"):
        use = has_letter(batch.column("text"))
        own = batch.filter(pa.array(use))
        names, number = np.unique(own.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        for text, bucket in grams(own.column("text")):
            found = np.bincount(number[text] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, counts in zip(names.tolist(), found, strict=True):
                totals[name] = totals.get(name, 0) + counts
    for name, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.record_batch({"lang": pa.array([name] * len(used), pa.string()), "bucket": used.astype(np.int32), "n": counts[used].astype(np.int64)})


def _histogram(model: Model):
    """Margins per bit and side of the split, counted on a grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(model.languages)}
        counts = np.zeros((len(model.weights), 2, 2 * STEPS + 1), np.int64)
        for batch in pieces(batches, "text"):
            own = batch.filter(pa.array(has_letter(batch.column("text"))))
            if not own.num_rows:
                continue
            side = model.code[[number[name] for name in own.column("lang").to_pylist()]]
            place = np.clip(np.rint(margins(own.column("text"), model.weights) / STEP), -STEPS, STEPS).astype(int) + STEPS
            for b in range(len(model.weights)):
                np.add.at(counts[b], (side[:, b], place[:, b]), 1)
        bit, side, place = np.nonzero(counts)
        yield pa.record_batch({"bit": bit.astype(np.int32), "side": side.astype(np.int32), "place": place.astype(np.int32),
                               "n": counts[bit, side, place]})

    return run


def logistic(x: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Slope and offset of the logistic curve through counts n[side, place] at x, and the share of x on the wrong side.

    Targets are drawn in from 0 and 1 by the number of rows, so that separable counts give a finite curve.
    """
    total = n.sum(axis=1)
    goal = np.array([1 / (total[0] + 2), (total[1] + 1) / (total[1] + 2)])
    weight, hits = n.sum(axis=0), goal @ n
    theta, ridge = np.array([1.0, 0.0]), np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta[0] * x + theta[1], -30, 30)))
        slack = weight * p - hits
        bend = weight * p * (1 - p) + 1e-9
        step = np.linalg.solve(np.array([[bend @ x**2, bend @ x], [bend @ x, bend.sum()]]) + ridge,
                               np.array([slack @ x, slack.sum()]) + ridge @ (theta - [1.0, 0.0]))
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    slope = max(theta[0], 1e-3)
    wrong = n[0][slope * x + theta[1] > 0].sum() + n[1][slope * x + theta[1] <= 0].sum()
    return slope, theta[1], (wrong + 0.5) / (total.sum() + 1)


def fit(docs: DataFrame, learn: Column, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Learn from the text and lang of the rows of ``docs`` that ``learn`` selects and whose lang is not null."""
    rows = docs.filter(learn & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counted = map_arrow(rows.select("text", "lang"), _count, "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, number = np.unique(found.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    counts = np.zeros((len(names), BUCKETS))
    counts[number, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    code = codewords(len(names))
    weights = [np.log(shares[bit == 1].mean(axis=0) / shares[bit == 0].mean(axis=0)) for bit in code.T]
    bits = code.shape[1]
    model = Model(names.tolist(), code, np.array(weights, np.float32).reshape(bits, BUCKETS), np.ones(bits), np.zeros(bits), np.ones(bits))
    if not bits:
        return model
    total = rows.count()
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(total, 1))) < calibration_rows
    seen = map_arrow(rows.filter(part).select("text", "lang"), _histogram(model), "bit int, side int, place int, n long")
    grid = np.zeros((bits, 2, 2 * STEPS + 1))
    for r in seen.groupBy("bit", "side", "place").agg(F.sum("n").alias("n")).collect():
        grid[r.bit, r.side, r.place] = r.n
    x = np.arange(-STEPS, STEPS + 1) * STEP
    for b in range(bits):
        model.slope[b], model.offset[b], wrong = logistic(x, grid[b])
        model.trust[b] = max(np.log((1 - wrong) / wrong), 1e-3)
    model.trust /= model.trust.mean()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), ambiguous and bits_off (bits that disagree with the codeword chosen)."""
    rest = [c for c in docs.columns if c != "text"]
    names = fresh(docs, "lang_pred", "score", "ambiguous", "bits_off")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array([*model.languages, UNKNOWN], object)
        for batch in pieces(batches, "text"):
            texts = batch.column("text")
            use = has_letter(texts) if model.languages else np.zeros(batch.num_rows, bool)
            best, share = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            unsure, off = np.ones(batch.num_rows, bool), np.zeros(batch.num_rows, np.int32)
            if use.any():
                best[use], share[use], unsure[use], off[use] = model.decode(margins(texts.filter(pa.array(use)), model.weights))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(known[best], pa.string()), pa.array(share), pa.array(unsure), pa.array(off)],
                names=[*rest, *names],
            )

    kept = docs.select(*rest, "text")
    fields = ", ".join(f"`{n}` {t}" for n, t in zip(names, ("string", "double", "boolean", "int"), strict=True))
    schema = ", ".join([*[f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in rest], fields])
    return map_arrow(kept, run, schema)
