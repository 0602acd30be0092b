"""Token counts of a unigram vocabulary by dynamic programming over a trie of the distinct pre-tokens.

The best segmentation of a word's first d characters depends on these alone. The distinct words of a chunk of text, sorted,
are the depth-first walk of their trie: the forward scores of a prefix are computed when the walk enters its node and serve
every word below it. At a word's node its count is stored, and each document adds up the counts of its words.

A piece of rank r scores -log(r + 2), so frequent pieces win; a character outside the vocabulary falls back to its bytes,
each a token. Of equal scores the segmentation with fewer tokens counts. Words found before in the same Python worker are
looked up; the store is emptied when full, which costs time only.

Defined results: null and empty texts have no tokens; repeated rows are counted alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetgauge.llm.common import map_arrow, pieces, split_words

SPACE = "▁"
MAX_STORED = 400_000
_stored: dict[str, dict[int, int]] = {}


class Vocabulary:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = -math.log(len(scores) + 2) - 5
        # Lengths of the pieces by their last two characters: only these are tried at a node.
        ends: dict[str, set[int]] = {}
        for piece in scores:
            ends.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: sorted(sizes) for end, sizes in ends.items() if len(end) == 2}

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each of the words, which must be sorted and distinct, with SPACE before them."""
        scores, lengths, unknown = self.scores, self.lengths, self.unknown
        best, tokens, before, out = [0.0], [0], "", []
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for d in range(shared + 1, len(word) + 1):
                last = word[d - 1]
                if (s := scores.get(last)) is not None:
                    high, few = best[d - 1] + s, tokens[d - 1] + 1
                else:
                    n = len(last.encode())
                    high, few = best[d - 1] + n * unknown, tokens[d - 1] + n
                for size in lengths.get(word[d - 2 : d], ()) if d > 1 else ():
                    if size > d:
                        break
                    if (s := scores.get(word[d - size : d])) is not None:
                        total = best[d - size] + s
                        if total > high or (total == high and tokens[d - size] + 1 < few):
                            high, few = total, tokens[d - size] + 1
                best.append(high)
                tokens.append(few)
            out.append(tokens[-1])
            before = word
        return out


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    plain = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return Vocabulary({piece: -math.log(rank + 2) for rank, piece in enumerate(plain)})


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every row. model: path of a sentencepiece file, the same on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, stored = vocabulary(model), _stored.setdefault(model, {})
        for batch in pieces(batches, "text"):
            words = split_words(batch.column("text"))
            codes, keys = pd.factorize(words.hashes())
            first = np.empty(len(keys), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            text, counts, new = words.data.tobytes(), np.zeros(len(keys), np.int64), []
            for i, (key, at) in enumerate(zip(keys.tolist(), first.tolist(), strict=True)):
                known = stored.get(key)
                if known is None:
                    new.append((SPACE + text[words.starts[at] : words.ends[at]].decode(), i))
                else:
                    counts[i] = known
            new.sort()
            found = vocab.counts([w for w, _ in new])
            at = [i for _, i in new]
            counts[at] = found
            if len(stored) + len(new) > MAX_STORED:
                stored.clear()
            if len(new) <= MAX_STORED:
                stored.update(zip(keys[at].tolist(), found, strict=True))
            sums = np.concatenate([[0], np.cumsum(counts[codes])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(words.first)), pa.array(np.diff(sums[words.first]))],
                ["doc_id", "n_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_words bigint, n_tokens bigint")
