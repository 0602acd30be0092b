"""Toxic passages as maximum-scoring segments over token log-odds.

1. Log-odds. How many toxic and how many clean labelled documents hold a token (so that one document that repeats it counts
   once) is smoothed by a Dirichlet prior, in part in proportion to the token's count in the whole corpus. A token whose log-odds exceed
   `Z_LEAST` standard errors, and `ODDS_LEAST` by two of them, scores its log-odds; every other token costs `DRIFT`.
2. Segments. One scan of a text finds all maximal segments: those whose score no extension and no part exceeds. Its
   cost beyond finding the scoring tokens is in proportion to these tokens.
3. Extreme values. The best segment of a clean text of n tokens follows an extreme-value law: the number of segments of score
   s or more is K * n * exp(-lambda * s). Lambda comes from the token frequencies, K from the clean labelled documents. The
   evidence of a text is minus the log of that number for its best segment, plus what further significant segments add; a
   logistic curve, fitted on the same documents, turns it into a score between 0 and 1.

Fitting uses at most `sample_rows` labelled documents of either label; the prior and the token frequencies come from all
documents. Every token of the toxic documents of that sample is a candidate, so the sample bounds what is sent to the tasks.

Defined results: null and empty texts have no segment and get the score of no evidence; null labels are not learnt from;
repeated rows are scored alike; without any label, or with one label only, the score is the share of that label or 0.5; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import Words, cut, map_arrow, pieces, split_words
from fleetgauge.llm.line_crf import adam, labelled_sample

SAMPLE_ROWS = 8000
#: The prior of a token: a count of its own, and its share of so many tokens of the corpus.
PRIOR_EACH = 0.5
PRIOR_TOKENS = 1000.0
Z_LEAST = 3.0
#: Two standard errors below its log-odds, a token must still have so much.
ODDS_LEAST = 1.0
DRIFT = 0.25
SIGNIFICANT = 0.01
#: Tokens are runs of ASCII letters, lowered, and of bytes of other scripts.
_OTHER = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


def tokens_of(texts: pa.Array) -> Words:
    return split_words(texts, _OTHER, lower=True)


def maximal_segments(place: np.ndarray, gain: np.ndarray, drift: float) -> list[tuple[float, int, int]]:
    """(score, first token, last token) of all maximal segments, where tokens at `place` gain and all others cost drift."""
    found: list[tuple[float, float, int, int]] = []  # sums before and after, first, last
    total, at = 0.0, -1
    for p, g in zip(place.tolist(), gain.tolist(), strict=True):
        total -= drift * (p - at - 1)
        at, low, high, start = p, total, total + g, p
        total = high
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j -= 1
            if j < 0 or found[j][1] >= high:
                break
            low, start = found[j][0], found[j][2]
            del found[j:]
        found.append((low, high, start, p))
    return [(high - low, a, b) for low, high, a, b in found]


@dataclass
class Model:
    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    gains: np.ndarray = field(default_factory=lambda: np.empty(0))
    drift: float = DRIFT
    rate: float = 1.0
    log_k: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def segments(self, texts: pa.Array) -> tuple[Words, list[list[tuple[float, int, int]]]]:
        """The tokens, and the maximal segments of each text."""
        words = tokens_of(texts)
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        hit = np.flatnonzero(self.hashes[at] == hashes) if len(self.hashes) else np.empty(0, np.int64)
        gain, cuts = self.gains[at[hit]] if len(hit) else np.empty(0), np.searchsorted(hit, words.first)
        out = [maximal_segments(hit[a:b] - f, gain[a:b], self.drift) if b > a else []
               for a, b, f in zip(cuts, cuts[1:], words.first, strict=False)]
        return words, out

    def surprise(self, score: float, n: int) -> float:
        """Minus the log of the expected number of segments with such a score in a clean text of n tokens."""
        return self.rate * score - self.log_k - float(np.log(max(n, 1)))

    def evidence(self, texts: pa.Array) -> np.ndarray:
        words, found = self.segments(texts)
        out = np.full(len(found), self.surprise(0.0, 1) - 1.0)
        for i, (segments, n) in enumerate(zip(found, np.diff(words.first), strict=True)):
            if segments:
                each = sorted((self.surprise(s, n) for s, _, _ in segments), reverse=True)
                least = -np.log(SIGNIFICANT)
                out[i] = each[0] + sum(x - least for x in each[1:] if x > least)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.clip(self.scale * np.clip(self.evidence(texts), -30, 60) + self.shift, -50, 50)
        return 1 / (1 + np.exp(-x))


def sample_counts(chosen: DataFrame):
    """hash, toxic, clean (numbers of documents), clean_tokens of the tokens of toxic documents; then documents of either label,
    and tokens of the clean ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = tokens_of(batch.column("text"))
            label = batch.column("label").to_numpy(zero_copy_only=False)
            hashes = words.hashes()
            _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
            pairs = np.unique(np.stack([which, words.doc()]), axis=1)
            in_toxic = np.bincount(pairs[0], label[pairs[1]], len(one)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[one].view(np.int64)), pa.array(in_toxic),
                 pa.array(np.bincount(pairs[0], minlength=len(one)) - in_toxic),
                 pa.array(np.bincount(which, label[words.doc()] == 0, len(one)).astype(np.int64))],
                ["hash", "toxic", "clean", "clean_tokens"])

    counts = ("toxic", "clean", "clean_tokens")
    counted = map_arrow(chosen, run, "hash long, toxic long, clean long, clean_tokens long").groupBy("hash").agg(
        *[F.sum(c).alias(c) for c in counts])
    counted = cut(counted)
    either = chosen.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    n_tokens = counted.agg(F.sum("clean_tokens")).first()[0]
    kept = counted.where("toxic > 0").toPandas()
    return kept.sort_values("hash", key=lambda h: h.to_numpy().view(np.uint64)), either[0], either[1], n_tokens or 0


def corpus_counts(docs: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """How often each of the tokens occurs in all documents, and the number of all tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(hashes) + 1, np.int64)
        for batch in pieces(batches, "text"):
            own = tokens_of(batch.column("text")).hashes()
            at = np.minimum(np.searchsorted(hashes, own), max(len(hashes) - 1, 0))
            if len(hashes):
                counts[:-1] += np.bincount(at[hashes[at] == own], minlength=len(hashes))
            counts[-1] += len(own)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["token", "n"])

    got = map_arrow(docs.select("text"), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(hashes) + 1, np.int64)
    out[got["token"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out[:-1], int(out[-1])


def prior_counts(corpus: np.ndarray, n_corpus: int) -> np.ndarray:
    return PRIOR_EACH + PRIOR_TOKENS * corpus / max(n_corpus, 1)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, corpus: np.ndarray, n_corpus: int):
    """Log-odds of each token in toxic against clean text, and how many standard errors that is."""
    prior = prior_counts(corpus, n_corpus)
    y1, y0 = toxic + prior, clean + prior
    odds = np.log(y1 / (n_toxic + 2 * prior - y1)) - np.log(y0 / (n_clean + 2 * prior - y0))
    return odds, odds / np.sqrt(1 / y1 + 1 / y0)


def segment_rate(gains: np.ndarray, share: np.ndarray, drift: float) -> float:
    """The positive lambda at which the mean of exp(lambda * token score) is 1 in clean text."""
    if not len(gains) or (gains * share).sum() >= drift * (1 - share.sum()):
        return 1.0  # no root: segments of clean text do not stay short
    low, high = 1e-6, 60.0
    for _ in range(100):
        mid = (low + high) / 2
        mean = (share * np.exp(np.minimum(mid * gains, 600))).sum() + (1 - share.sum()) * np.exp(-mid * drift)
        low, high = (mid, high) if mean < 1 else (low, mid)
    return low


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model from labelled documents for which `learn`, a condition on doc_id, holds."""
    sample = labelled_sample(labels, label, learn, sample_rows)  # at most 2 * sample_rows ids
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    kept, n_toxic, n_clean, n_tokens = sample_counts(chosen)
    if not n_toxic or not n_clean:
        return Model(constant=1.0 if n_toxic else 0.0 if n_clean else 0.5)
    hashes = kept["hash"].to_numpy(np.int64).view(np.uint64)
    corpus, n_corpus = corpus_counts(docs, hashes)
    toxic, clean = kept["toxic"].to_numpy(np.int64), kept["clean"].to_numpy(np.int64)
    odds, z = log_odds(toxic, clean, n_toxic, n_clean, corpus, n_corpus)
    use = (z >= Z_LEAST) & (odds * (1 - 2 / np.maximum(z, 1)) >= ODDS_LEAST)
    share = (kept["clean_tokens"].to_numpy(np.int64)[use] + PRIOR_EACH) / (n_tokens + PRIOR_EACH * len(kept))
    model = Model(hashes[use], odds[use], DRIFT, segment_rate(odds[use], share, DRIFT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words, found = model.segments(batch.column("text"))
            best = np.array([max((s for s, _, _ in x), default=0.0) for x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(best), pa.array(np.diff(words.first)), pa.array(model.evidence(batch.column("text")))],
                ["label", "best", "n", "evidence"])

    seen = map_arrow(chosen, run, "label int, best double, n long, evidence double").toPandas()
    seen = seen.sort_values(["label", "n", "best"])
    y, n, best = seen["label"].to_numpy(float), np.maximum(seen["n"].to_numpy(float), 1), seen["best"].to_numpy()
    some = (y == 0) & (best > 0)
    # With lambda known, n * exp(-lambda * best) is exponential with mean 1 / K; a text without a gain is as good as one of 0.
    model.log_k = -float(np.log(np.mean((n * np.exp(-model.rate * best))[y == 0]))) if some.any() else 0.0
    x = np.clip(seen["evidence"].to_numpy() - model.log_k, -30, 60)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))

    def slope(c: np.ndarray) -> np.ndarray:
        off = (1 / (1 + np.exp(-np.clip(c[0] * x + c[1], -50, 50))) - y) * balance
        return np.array([(off * x).mean() + 1e-4 * c[0], off.mean()])

    model.scale, model.shift = (float(c) for c in adam(slope, np.array([1.0, 0.0]), 1000, 0.05))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            s = model.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def passages(docs: DataFrame, model: Model, significant: float = SIGNIFICANT) -> DataFrame:
    """doc_id, passage, segment_score, surprise of every segment that a clean text would hold less than `significant` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words, found = model.segments(batch.column("text"))
            texts = batch.column("text").to_pylist()
            rows = []
            for i, segments in enumerate(found):
                raw, first, base = (texts[i] or "").encode(), words.first[i], words.bounds[i]
                for s, a, b in segments:
                    if (x := model.surprise(s, words.first[i + 1] - first)) > -np.log(significant):
                        rows.append((i, raw[words.starts[first + a] - base : words.ends[first + b] - base].decode(), s, x))
            at, *out = [pa.array(c) for c in zip(*rows, strict=True)] if rows else [pa.array([]) for _ in names]
            ids = batch.column("doc_id").take(at.cast(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[c.cast(t) for c, t in zip(out, kinds, strict=True)]], names)

    names, kinds = ["doc_id", "passage", "segment_score", "surprise"], [pa.string(), pa.float64(), pa.float64()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, passage string, segment_score double, surprise double")
