"""Words that a sum of powers modulo 2**64 cannot tell apart are different words to every operator."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from fleetgauge.llm import queries, substring, token_store
from fleetgauge.llm.common import split_words

PAIR = ["".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(1024)) for flip in (0, 1)]


def test_hashes_tell_them_apart():
    words = split_words(pa.array([" ".join(PAIR), "x" * 128, "x" * 129, *PAIR]))
    found = words.hashes().tolist()
    assert len(set(found)) == 4 and found[0] == found[4] and found[1] == found[5]


def test_repeats_of_such_words(spark):
    docs = [(1, " ".join([PAIR[0]] * 20)), (2, " ".join([PAIR[1]] * 20)), (3, " ".join([PAIR[1]] * 20))]
    got = substring.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), texts=False)
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 0), (3, 20)]


def test_ids_of_such_words_and_of_random_texts():
    from tokenizers import Tokenizer

    file = queries.tokenizer_file("word_bpe_49k.json")
    library, own = Tokenizer.from_file(file), token_store.Encoder(file)
    rng = random.Random(6)
    alphabet = list("abzAZ09 .,'<|>\n\té×÷ßÀÞÿ日İﬁ🙂\x1c\x85½-_") + ["don't", "<|endoftext|>", "12a34", "It's ", "'S"]
    texts = [*PAIR, None, "", *["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(4000)]]
    for a in range(0, len(texts), 500):
        ids, bounds = own.encode(pa.array(texts[a : a + 500], pa.string()))
        for t, b, c in zip(texts[a : a + 500], bounds, bounds[1:], strict=False):
            assert ids[b:c].tolist() == [*library.encode(t or "", add_special_tokens=False).ids, token_store.END]


def test_forgetting_changes_no_ids(monkeypatch):
    own = token_store.Encoder(queries.tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcdé1.", k=rng.randint(1, 6))) for _ in range(30)) for _ in range(60)]
    whole = own.encode(pa.array(texts))[0]
    monkeypatch.setattr(token_store, "MAX_WORDS", 50)
    own.forget()
    parts = [own.encode(pa.array(texts[i : i + 3]))[0] for i in range(0, 60, 3)]
    assert np.array_equal(np.concatenate(parts), whole)
