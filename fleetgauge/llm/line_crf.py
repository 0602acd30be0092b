"""Quality classifier: a linear-chain conditional random field labels each line good or bad.

A line is described by shares of its bytes and words, and by the same shares of the lines around it; the chain adds a weight
for each pair of neighbouring labels. Forward and backward sums give the probability that a line is good, and the mean of
these, weighted by the lines' lengths, is calibrated to the probability that the document has label 1.

Labels are known of documents, not of lines, so the lines' labels are hidden. A document's label is a noisy label of each of its
lines, which a document of the other kind may hold as well. First a line by itself, without those around it, predicts the
label of its document; how sure it can be at best is read off the median line of the good documents and that of the bad
ones, and between these two the prediction becomes the probability that the line itself is good. The chain is fitted to these.
A line that looks like those of good documents so comes out good in a bad document too.

Fitting uses at most `sample_rows` labelled documents of either label, those with the least hash of their id, and of them as
many as have `sample_lines` lines together. Only the text is looked at. Scoring is one pass over the documents, without a
shuffle.

Defined results: null and empty texts are one empty line; null labels are not learnt from; repeated rows are scored alike;
without any label, or with one label only, the score is the share of that label or 0.5; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import SPACES, map_arrow, pieces, split_words

SAMPLE_ROWS = 4000
#: Lines of the documents of either label that a fit looks at; a document with over a tenth of them is left out.
SAMPLE_LINES = 100_000
EPOCHS = 150
#: Features of a line itself, with the constant; the others are of the lines around it.
OWN = 14
#: No hidden label is surer than this.
SURE = 0.98
_LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>{}[]=_~^@\\/"])
_MARK = np.isin(np.arange(256), [ord(c) for c in "!?"])
_STOP = np.isin(np.arange(256), [ord(c) for c in ".,;:"])


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines (with a constant), their lengths in bytes, and which lines belong to which text."""
    words = split_words(texts)
    data, bounds = words.data, words.bounds
    breaks = np.flatnonzero(data == 10)
    # A text has one line more than it has breaks.
    per_text = np.diff(np.searchsorted(breaks, bounds)) + 1
    first = np.concatenate([[0], np.cumsum(per_text)])
    start = np.empty(first[-1], np.int64)
    own = np.ones(first[-1], bool)
    own[first[:-1]] = False
    start[first[:-1]], start[own] = bounds[:-1], breaks + 1
    stop = np.empty(first[-1], np.int64)
    last = np.zeros(first[-1], bool)
    last[first[1:] - 1] = True
    stop[last], stop[~last] = bounds[1:], breaks
    length = stop - start

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[stop] - sums[start]

    hashes = words.hashes()
    line = np.searchsorted(start, words.starts, "right") - 1
    n_words = np.bincount(line, minlength=len(start))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])
    whole = np.zeros(len(start), np.uint64)
    nth = np.arange(len(hashes)) - np.searchsorted(words.starts, start)[line] + 1
    np.add.at(whole, line, hashes * nth.astype(np.uint64))
    doc = np.repeat(np.arange(len(per_text)), per_text)
    key = np.lexsort((whole, doc))
    twin = np.zeros(len(start), bool)
    pair = (whole[key][1:] == whole[key][:-1]) & (doc[key][1:] == doc[key][:-1])
    twin[key[1:][pair]] = twin[key[:-1][pair]] = True

    letters, n = np.maximum(total(_LETTERS[data]), 1), np.maximum(length, 1)
    w = np.maximum(n_words, 1)
    local = np.stack([
        np.log1p(length) / 8, np.log1p(n_words) / 6, total(_CAPITAL[data]) / letters, total(_SYMBOL[data]) / n,
        total(_MARK[data]) / w, total(_DIGIT[data]) / n, total(_STOP[data]) / w, total(data >= 128) / n,
        (length - total(SPACES[data])) / w / 12, np.bincount(line, same, len(start)) / w,
        np.bincount(line, again[np.argsort(order, kind="stable")], len(start)) / w, twin & (n_words > 0), n_words == 0,
    ], axis=1).astype(np.float32)
    before, after = np.zeros_like(local), np.zeros_like(local)
    before[1:], after[:-1] = local[:-1], local[1:]
    before[first[:-1]], after[first[1:] - 1] = 0, 0
    ends = np.zeros((len(start), 2), np.float32)
    ends[first[:-1], 0], ends[first[1:] - 1, 1] = 1, 1
    return np.concatenate([np.ones((len(start), 1), np.float32), local, before, after, ends], axis=1), length, first


@dataclass
class Chains:
    """Lines of several texts by step: lines of step t are those at place t of all texts that have so many."""

    first: np.ndarray

    def __post_init__(self):
        lengths = np.diff(self.first)
        self.order = np.argsort(-lengths, kind="stable")
        self.start = self.first[:-1][self.order]
        self.sizes = np.searchsorted(-lengths[self.order], -np.arange(lengths.max(initial=0)), "left")

    def sums(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums of each line and label, and the log sum of each text in `order`."""
        forward, backward = np.empty_like(unary), np.zeros_like(unary)
        for t, n in enumerate(self.sizes):
            at = self.start[:n] + t
            forward[at] = unary[at]
            if t:
                p = forward[at - 1]
                forward[at] += np.logaddexp(p[:, :1] + pair[0], p[:, 1:] + pair[1])
        for t in range(len(self.sizes) - 1, 0, -1):
            at = self.start[: self.sizes[t]] + t
            x = unary[at] + backward[at]
            backward[at - 1] = np.logaddexp(pair[:, 0] + x[:, :1], pair[:, 1] + x[:, 1:])
        first = self.first[:-1]
        return forward, backward, np.logaddexp(*(unary[first] + backward[first]).T)


@dataclass
class Model:
    """weights: of the features for label good; pair: of label pairs; scale, shift: from mean probability to score."""

    weights: np.ndarray
    pair: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def good(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability that each line is good."""
        unary = np.zeros((len(features), 2))
        unary[:, 1] = features @ self.weights
        forward, backward, total = Chains(first).sums(unary, self.pair)
        return np.exp(np.minimum(forward[:, 1] + backward[:, 1] - np.repeat(total, np.diff(first)), 0))

    def mean_good(self, features: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        weight = length + 1.0
        return np.add.reduceat(self.good(features, first) * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        m = self.mean_good(*line_features(texts))
        return 1 / (1 + np.exp(-(self.scale * m + self.shift)))


def adam(gradient, x: np.ndarray, epochs: int, rate: float = 0.1) -> np.ndarray:
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, epochs + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def hidden_labels(own: np.ndarray, length: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray,
                  epochs: int) -> np.ndarray:
    """Probability that each line is good, from its own features: what they say of the document's label, without its noise."""
    label = np.repeat(labels, np.diff(first))

    def slope(w: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(own @ w, -50, 50)))
        return own.T @ ((p - label) * weight) / len(labels) + 1e-4 * w

    p = 1 / (1 + np.exp(-np.clip(own @ adam(slope, np.zeros(own.shape[1]), epochs), -50, 50)))
    full = length > 0  # an empty line says nothing of either kind
    low, high = (np.median(p[some] if (some := full & (label == y)).any() else p[label == y]) for y in (0, 1))
    if high <= low:
        return np.clip(label, 1 - SURE, SURE)  # lines by themselves tell nothing: the document's label is all there is
    return np.clip((p - low) / (high - low), 1 - SURE, SURE)


def fit_model(features: np.ndarray, length: np.ndarray, first: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Weights of greatest conditional likelihood of the hidden labels (with a small penalty), and the calibration of the
    documents' scores."""
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(features.shape[1] if len(features) else 0), np.zeros((2, 2)),
                     constant=float(labels[0]) if len(labels) else 0.5)
    chains, per_text, n = Chains(first), np.diff(first), len(labels)
    inner = np.ones(len(features), bool)
    inner[first[1:] - 1] = False
    inner = np.flatnonzero(inner)
    # Either label weighs as much, and so does each document, whatever its number of lines.
    line_weight = np.repeat(0.5 / np.where(labels == 1, labels.mean(), 1 - labels.mean()) / per_text, per_text)
    good_line = hidden_labels(features[:, :OWN], length, first, labels, line_weight, epochs)
    each = np.stack([1 - good_line, good_line], axis=1)
    seen = (each[inner] * line_weight[inner][:, None]).T @ each[inner + 1]

    def gradient(x: np.ndarray) -> np.ndarray:
        pair, w = x[:4].reshape(2, 2), x[4:]
        unary = np.zeros((len(features), 2))
        unary[:, 1] = features @ w
        forward, backward, total = chains.sums(unary, pair)
        total = np.repeat(total, per_text)
        good = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - total, 0))
        both = np.exp(forward[inner][:, :, None] + pair + (unary + backward)[inner + 1][:, None, :] - total[inner][:, None, None])
        expected = (both * line_weight[inner][:, None, None]).sum(axis=0)
        return np.concatenate([(expected - seen).ravel() / n + 1e-3 * x[:4],
                               features.T @ ((good - good_line) * line_weight) / n + 1e-4 * w])

    x = adam(gradient, np.zeros(4 + features.shape[1]), epochs)
    model = Model(x[4:], x[:4].reshape(2, 2))
    mean = model.mean_good(features, length, first)
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))

    def slope(c: np.ndarray) -> np.ndarray:
        off = (1 / (1 + np.exp(-(c[0] * mean + c[1]))) - labels) * balance
        return np.array([(off * mean).mean() + 1e-4 * c[0], off.mean()])

    model.scale, model.shift = (float(c) for c in adam(slope, np.array([4.0, -2.0]), 600))
    return model


def labelled_sample(labels: DataFrame, label: str, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id and label of at most `rows` rows of either label among those to learn from."""
    known = labels.where(learn & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    each = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    return each[0].unionByName(each[1]).dropDuplicates(["doc_id"])


def within_lines(chosen: DataFrame, limit: int) -> DataFrame:
    """The chosen documents, one text for each id, whose lines with those of all before them of their label are `limit` at most.
    Documents with more than a tenth of that are left out."""
    n_lines, mark = F.size(F.split(F.coalesce("text", F.lit("")), "\n")), F.xxhash64("text")
    sizes = chosen.groupBy("doc_id", "label").agg(F.min(F.struct(n_lines.alias("n"), mark.alias("mark"))).alias("least"))
    sizes = sizes.where(F.col("least.n") * 10 <= limit)
    # At most twice the sample's rows.
    upto = F.sum("least.n").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(
        Window.unboundedPreceding, 0))
    fits = sizes.withColumn("upto", upto).where(F.col("upto") <= limit).select("doc_id", "least.mark")
    return chosen.withColumn("mark", mark).join(F.broadcast(fits), ["doc_id", "mark"]).dropDuplicates(["doc_id"]).drop("mark")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
        epochs: int = EPOCHS, sample_lines: int = SAMPLE_LINES) -> Model:
    """The model from labelled documents for which `learn`, a condition on doc_id, holds."""
    sample = F.broadcast(labelled_sample(labels, label, learn, sample_rows))  # at most 2 * sample_rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            features, length, first = line_features(batch.column("text"))
            for i in range(batch.num_rows):
                a, b = first[i], first[i + 1]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, 1), batch.column("label").slice(i, 1),
                    pa.array([features[a:b].astype(np.float32).tobytes()]), pa.array([length[a:b].astype(np.int64).tobytes()]),
                ], ["doc_id", "label", "features", "length"])

    chosen = within_lines(docs.select("doc_id", "text").join(sample, "doc_id"), sample_lines)
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = map_arrow(chosen, run, f"doc_id {kind}, label int, features binary, length binary").toPandas()
    got = got.sort_values(["doc_id", "features"]).drop_duplicates("doc_id")
    width = line_features(pa.array([""]))[0].shape[1]
    if not len(got):
        return fit_model(np.empty((0, width)), np.empty(0), np.zeros(1, np.int64), np.empty(0), epochs)
    features = np.concatenate([np.frombuffer(b, np.float32) for b in got["features"]]).reshape(-1, width)
    lengths = [np.frombuffer(b, np.int64) for b in got["length"]]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lengths])])
    return fit_model(features, np.concatenate(lengths), first, got["label"].to_numpy(float), epochs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            s = model.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score of 0.5 or more; all columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces([batch], batch.schema.names[at]):
                yield piece.filter(pa.array(model.score(piece.column(at)) >= 0.5))

    return map_arrow(docs, run, docs.schema)


def lines(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, line (from 0), n_bytes and good (probability) of every line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            features, length, first = line_features(batch.column("text"))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            p = model.good(features, first) if model.constant is None else np.full(len(doc), model.constant)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(np.arange(len(doc)) - first[doc]), pa.array(length),
                 pa.array(p)], ["doc_id", "line", "n_bytes", "good"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, line bigint, n_bytes bigint, good double")
