"""Helpers that several operators share: the shared folder, free column names, and words of Arrow texts as numpy arrays."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
CHUNK_BYTES = 4 << 20
#: Separators of words: space and U+0009 to U+000D.
SPACES = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: SQL pattern of a run of separators.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

_ODD = 0x9E3779B97F4A7C15
#: Words of more bytes than this are hashed one by one: sums of powers modulo 2**64 can be made to agree for long words.
LONG_WORD = 128
_powers: dict[str, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where a local session has none, as in tests, a new temporary one."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        set_dir = tempfile.mkdtemp(prefix="llm-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """The rows as a Parquet table in the shared folder: denser than `cut`, for wide tables."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", None) is None:
        top = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='llm-code-')}/{top.name}", "zip", top.parent, top.name)
        context.addPyFile(archive)
        context._llm_shipped = archive


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that df does not have, in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        inverse = np.uint64(pow(_ODD, -1, 1 << 64))
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", np.uint64(_ODD)), ("down", inverse)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"]


@dataclass
class Words:
    """Words of some texts. starts, ends: byte places in data; first[d]..first[d + 1] are the words of text d."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        up, down = powers(len(self.data))
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        found = mix64(raw + (self.ends - self.starts).astype(np.uint64) * np.uint64(_ODD))
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            found[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes())
        return found

    def doc(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: none), and where each begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or not texts.buffers()[2]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Words: longest runs of bytes that are no separators; they never span two texts."""
    data, bounds = utf8(texts)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
    before[edges[0]], after[edges[1]] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a piece take at most limit bytes, or are one row."""
    for batch in batches:
        _, bounds = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def spans(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    if not lengths.sum():
        return np.empty(0, np.int64)
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
