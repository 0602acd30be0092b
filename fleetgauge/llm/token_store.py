"""Token ids in a compact binary file format, in ascending order of doc_id.

Writing: texts are dealt into ranges of doc_id, sorted, and encoded by the tokenizer; each document's ids end with `END`. Counts
of all ids give one frequency table for all blocks. Then the ids are coded in blocks of whole documents (see `rans`), each of
which can be read by itself. A store is a folder of three tables: `blocks` (part, start, doc_id and n of each document, and
the coded block), `table` (the counts) and nothing else to look up: start is the number of ids before the block.

Reading decodes each block on its own, so it is as parallel as there are blocks; checksums are verified.

Words (runs without ASCII white space) are encoded once per Python worker and looked up by their hash after that: neither the
normalizer nor the splitter of such a tokenizer looks across white space. Plain words are lowered and cut in pieces for a whole
batch at once, by a rule that gives the same pieces; the pieces themselves are always encoded by the library.

Defined results: a null text is an empty one, with END alone; equal ids follow each other in the order of their texts, null ids
come first; a text longer than a block is a block of its own; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fleetgauge.llm import rans
from fleetgauge.llm.common import LOWER, Words, map_arrow, pieces, shared_dir, split_words, stored

END = 1
BLOCK_TOKENS = 1 << 20
MAX_WORDS = 2_000_000
#: Words of these characters are lowered and split by PARTS; PARTS is the tokenizer's own pattern for lowered text.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
PARTS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if it is visible, else one of the first beyond the bytes."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: Classes of bytes in lowered plain text: each digit is a piece, as is each run of letters or of other bytes.
_LETTER, _DIGIT, _OTHER, _SLOW = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
#: Hashes of slow words are told from those of pieces by this.
_TAG = np.uint64(0x5851F42D4C957F2D)


def plain_units(words: Words) -> tuple[Words, np.ndarray]:
    """Pieces of the plain words, lowered, and whole other words, in text order; and which units are such words.

    Plain are words of visible ASCII and the Latin letters that UTF-8 writes with the lead byte C3, without an apostrophe, which may
    begin a contraction, and without the beginning of a special token.
    """
    raw = words.data
    before, after = np.zeros_like(raw), np.zeros_like(raw)
    before[1:], after[:-1] = raw[:-1], raw[1:]
    second = (before == 0xC3) & (raw >= 0x80) & (raw <= 0xBF)
    latin = second & (raw != 0x97) & (raw != 0xB7)
    lead = (raw == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    odd = ~(_VISIBLE[raw] | latin | lead) | (raw == 0x27) | ((raw == 0x3C) & (after == 0x7C))
    total = np.concatenate([[0], np.cumsum(odd, dtype=np.int32)])
    slow = total[words.ends] > total[words.starts]
    low = LOWER[raw]
    low[latin & (raw < 0x9F)] += 0x20
    kind = _CLASS[low]
    where = np.zeros(len(raw) + 1, np.int8)
    where[words.starts[slow]] += 1
    where[words.ends[slow]] -= 1
    in_slow = np.cumsum(where[:-1], dtype=np.int8).astype(bool)
    low[in_slow], kind[in_slow] = raw[in_slow], _SLOW
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    begins = np.zeros(len(raw), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begins &= np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    begins[words.starts] = True
    starts = np.flatnonzero(begins)
    # A unit ends where the next one of its word begins, or with the word.
    ends = np.append(starts[1:], len(raw))
    word = np.searchsorted(words.starts, starts, "right") - 1
    ends = np.minimum(ends, words.ends[word])
    return Words(low, words.bounds, starts, ends, np.searchsorted(starts, words.bounds)), slow[word]


class Encoder:
    """Ids of texts, as little-endian numbers of `type`; what was encoded before is looked up by its hash."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), END + 1)
        self.type = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.letters = byte_letters()
        # The short way holds only for a tokenizer whose splitter has this very pattern.
        self.plain = PARTS_PATTERN in str(self.tokenizer.pre_tokenizer).replace("\\\\", "\\") and "Lowercase" in str(self.tokenizer.normalizer)
        self.forget()

    def forget(self) -> None:
        """Known units: sorted hashes, and where their ids are in the pool."""
        self.keys, self.place, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, self.type)

    def piece(self, piece: bytes) -> list[int]:
        """Ids of a lowered piece."""
        named = piece.decode() if piece.isascii() else "".join(self.letters[b] for b in piece)
        return [t.id for t in self.tokenizer.model.tokenize(named)]

    def word(self, word: bytes) -> list[int]:
        text = word.decode()
        if self.plain and PLAIN.fullmatch(text) and "<|" not in text:
            return [i for p in PARTS.findall(text.lower()) for i in self.piece(p.encode())]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, keys: np.ndarray, coded: list[list[int]]) -> None:
        """Add units that are not known; when there are too many, all others are forgotten, which costs time only."""
        if len(self.keys) + len(keys) > MAX_WORDS:
            self.forget()
        count = np.fromiter(map(len, coded), np.int64, len(coded))
        place = len(self.pool) + np.cumsum(count) - count
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.place, self.count = np.insert(self.place, at, place[order]), np.insert(self.count, at, count[order])
        self.pool = np.concatenate([self.pool, np.fromiter((i for ids in coded for i in ids), self.type, int(count.sum()))])

    def known(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with END, and where each text's begin and end."""
        units = split_words(texts)
        slow = np.ones(len(units.starts), bool)
        if self.plain:
            units, slow = plain_units(units)
        hashes = units.hashes()
        hashes[slow] ^= _TAG
        codes, keys = pd.factorize(hashes)
        new = np.flatnonzero(~self.known(keys))
        if len(new) and len(self.keys) + len(new) > MAX_WORDS:
            self.forget()
            new = np.arange(len(keys))
        if len(new):
            first = np.empty(len(keys), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            own, data = first[new], units.data.tobytes()
            self.learn(keys[new], [
                self.word(data[a:b]) if whole else self.piece(data[a:b])
                for a, b, whole in zip(units.starts[own].tolist(), units.ends[own].tolist(), slow[own].tolist(), strict=True)
            ])
        at = np.searchsorted(self.keys, keys)
        n = self.count[at][codes] if len(keys) else np.empty(0, np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        bounds = total[units.first] + np.arange(len(units.first))
        out = np.full(bounds[-1], END, self.type)
        if len(keys):
            place = np.arange(total[-1])
            out[place + np.repeat(units.doc(), n)] = self.pool[place + np.repeat(self.place[at][codes] - total[:-1], n)]
        return out, bounds


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """part, before (ids of the part's earlier documents), doc_id, n, ids: in ascending doc_id, part after part."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, before = encoder(tokenizer), 0
        for batch in pieces(batches, "text"):
            ids, bounds = coder.encode(batch.column("text"))
            raw, width = ids.tobytes(), coder.type.itemsize
            yield pa.RecordBatch.from_arrays([
                batch.column("part"), pa.array(before + bounds[:-1]), batch.column("doc_id"), pa.array(np.diff(bounds)),
                pa.array([raw[a * width : b * width] for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()),
            ], ["part", "before", "doc_id", "n", "ids"])
            before += int(bounds[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(dealt.select("doc_id", "text", F.spark_partition_id().alias("part")), run,
                     f"part int, before bigint, doc_id {kind}, n bigint, ids binary")


def write(docs: DataFrame, path: str, tokenizer: str, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the store. tokenizer: path of a tokenizers file, the same on every executor."""
    held = stored(tokenized(docs, tokenizer))
    size, dtype = encoder(tokenizer).size, encoder(tokenizer).type

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    # One row for each id of the vocabulary, and for each part: both have a fixed bound.
    counted = map_arrow(held.select("ids"), count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counted.coalesce(1).write.parquet(f"{path}/table")
    table = read_table(held.sparkSession, path)
    sizes = sorted((r["part"], r["n"]) for r in held.groupBy("part").agg(F.sum("n").alias("n")).collect())
    base = dict(zip([p for p, _ in sizes], np.cumsum([0] + [n for _, n in sizes]).tolist(), strict=False))
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def block(rows: list[tuple]) -> pa.RecordBatch:
        part, before = rows[0][:2]
        ids = np.frombuffer(b"".join(r[4] for r in rows), dtype)
        return pa.RecordBatch.from_arrays([
            pa.array([base[part] + before], pa.int64()), pa.array([[r[2] for r in rows]], pa.list_(id_type)),
            pa.array([[r[3] for r in rows]], pa.list_(pa.int64())), pa.array([rans.encode(ids, table)], pa.binary())],
            ["start", "doc_ids", "sizes", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (size + row[3] > block_tokens or row[0] != rows[0][0]):
                    yield block(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[3]
        if rows:
            yield block(rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = map_arrow(held, run, f"start bigint, doc_ids array<{kind}>, sizes array<bigint>, block binary")
    coded.write.option("compression", "none").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> rans.Table:
    got = spark.read.parquet(f"{path}/table").toPandas()
    counts = np.zeros(int(got["id"].max()) + 1 if len(got) else 1, np.int64)
    counts[got["id"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return rans.Table.of(counts)


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and with ids the ids of every document."""
    table = read_table(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                symbols = rans.decode(row.column("block")[0].as_py(), table)
                size = row.column("sizes").flatten().to_numpy(zero_copy_only=False)
                stop = np.cumsum(size)
                raw = symbols.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(stop - size, stop, strict=True)]
                out = [row.column("doc_ids").flatten(), pa.array(row.column("start")[0].as_py() + stop - size),
                       pa.array(size), pa.array(crc, pa.int64())]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(stop - size, stop[-1:]), pa.int32()),
                                                        pa.array(symbols.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, names)

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return map_arrow(blocks.select("start", "doc_ids", "sizes", "block"), run,
                     f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * ids)


def new_store(spark: SparkSession) -> str:
    import uuid

    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
