"""Substring dedup by seed and extend: removes every passage of `length` words or more that stood earlier in the corpus.

1. Seeds. Of the hashes of `seed` consecutive words, winnowing selects the least in each window of `length` words (the
   rightmost of equals). Windows with equal words select equal seeds at equal places, so every repeat is met at a seed.
2. Extension. A seed extends both ways as far as windows select it: that stretch is a cell. Cells meet at their seed in one
   shuffle, ordered by content and place. A cell that stands earlier repeats as a whole, with one row for up to
   length - seed + 1 windows. Of a seed with several different cells (the ends of a repeat), the first cell of each content is
   extended window by window, which a second shuffle compares; a window's first occurrence always lies in such a cell.
3. Maximal repeats. The repeated windows of a document are merged into stretches, the longest there are, and cut out.

Both shuffles first meet within a chunk of text, where all but the earliest of equal cells or windows are settled at once. A
passage that a third of all documents share thus sends few rows, and no task gathers its documents.

Content is compared by two 64-bit hashes, that of the seed and that of the cell or window.

Defined results: null and empty texts have no words; a window starts earlier if its (doc_id, start) is smaller, a null id
before all others, so rows that repeat an id and text take nothing from each other and get equal results; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import Words, cut, map_arrow, mix64, pieces, powers, spans, split_words

LENGTH = 20
SEED = 6
_STEP = np.uint64(0xD6E8FEB86659FD93)


def seeds(words: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the place and hash of the seed of each, and sums from which hashes of word runs follow."""
    hashes = words.hashes()
    n = len(hashes)
    up, _ = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), sums
    value = np.zeros(n - seed + 1, np.uint64)
    for j in range(seed):
        value = value * _STEP + hashes[j : n - seed + 1 + j]
    value = mix64(value)
    gram, place, width = value, np.arange(len(value)), 1
    while width < length - seed + 1:
        step = min(width, length - seed + 1 - width)
        later = value[step:] <= value[:-step]
        value = np.where(later, value[step:], value[:-step])
        place = np.where(later, place[step:], place[:-step])
        width += step
    doc = words.doc()
    starts = np.flatnonzero(doc[: n - length + 1] == doc[length - 1 :])
    place = place[starts]
    return starts, place, gram[place], sums


def run_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the words start..stop; never 0."""
    _, down = powers(len(sums))
    out = mix64((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64) * _STEP)
    return np.maximum(out, np.uint64(1))


def order_of(ids: pa.Array) -> np.ndarray:
    """Rank of each row's id among the rows; equal ids have equal ranks, nulls the lowest."""
    if not ids.null_count and pa.types.is_integer(ids.type):
        return np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    values = ids.to_pylist()
    rank = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}))}
    return np.array([rank.get(v, -1) for v in values], np.int64)


def keyed(batch: pa.RecordBatch, seed_hash: np.ndarray, content: np.ndarray, doc: np.ndarray, start: np.ndarray,
          n: np.ndarray) -> pa.RecordBatch:
    """Rows (k1, k2, doc_id, tag, pos) of cells or windows; those with an earlier equal in this chunk are merged into
    stretches, marked by k2 = 0, with a k1 that spreads them."""
    rank = order_of(batch.column("doc_id"))[doc] if len(doc) else doc
    order = np.lexsort((start, rank, content, seed_hash))
    a, b = order[:-1], order[1:]
    same = (seed_hash[a] == seed_hash[b]) & (content[a] == content[b])
    begins = np.concatenate([[True], ~same]) if len(order) else np.empty(0, bool)
    head = order[np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))] if len(order) else order
    later = np.zeros(len(order), bool)
    later[order] = (rank[order] != rank[head]) | (start[order] != start[head])
    settled = np.flatnonzero(later)
    joins = np.zeros(len(settled), bool)
    if len(settled) > 1:
        p, q = settled[:-1], settled[1:]
        joins[1:] = (doc[p] == doc[q]) & (start[p] + n[p] == start[q])
    at = np.flatnonzero(~joins)
    total = np.add.reduceat(n[settled], at) if len(at) else np.empty(0, np.int64)
    first, keep = settled[at], np.flatnonzero(~later)
    rows = np.concatenate([keep, first])
    spread = mix64(seed_hash[first] + start[first].astype(np.uint64) * _STEP + doc[first].astype(np.uint64))
    k1 = np.concatenate([seed_hash[keep], spread])
    k2 = np.concatenate([content[keep], np.zeros(len(first), np.uint64)])
    pos = (start[rows] << 32) | np.concatenate([n[keep], total])
    from_doc = pa.array(doc[rows])
    return pa.RecordBatch.from_arrays(
        [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), batch.column("doc_id").take(from_doc),
         batch.column("tag").take(from_doc), pa.array(pos.astype(np.int64))], ["k1", "k2", "doc_id", "tag", "pos"])


def cells(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        words = split_words(batch.column("text"))
        starts, place, gram, sums = seeds(words, length, seed)
        new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
        n = np.diff(np.append(new, len(starts)))
        begin = starts[new]
        doc = words.doc()[begin]
        content = run_hash(sums, begin, begin + n + length - 1)
        yield keyed(batch, gram[new], content, doc, begin - words.first[doc], n)


def windows(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    """One row for each window of the given cells; the column cells has their positions."""
    for batch in pieces(batches, "text"):
        words = split_words(batch.column("text"))
        starts, place, gram, sums = seeds(words, length, seed)
        held = batch.column("cells")
        pos = held.flatten().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
        n = pos & 0xFFFFFFFF
        s = np.repeat((pos >> 32) + words.first[doc], n) + spans(n)
        order = np.argsort(s, kind="stable")
        s, doc = s[order], np.repeat(doc, n)[order]
        at = np.searchsorted(starts, s)
        yield keyed(batch, gram[at], run_hash(sums, s, s + length), doc, s - words.first[doc], np.ones(len(s), np.int64))


def compared(rows: DataFrame) -> DataFrame:
    """doc_id, tag, pos, repeat (stands earlier), open (the first of its content, at a seed with other contents)."""
    content = Window.partitionBy("k1", "k2").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    seed = Window.partitionBy("k1").orderBy("k2", "doc_id", "pos").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    head = F.first(F.struct("doc_id", F.shiftright("pos", 32).alias("start"))).over(content)
    mine = F.struct("doc_id", F.shiftright("pos", 32).alias("start"))
    return rows.select("*", head.alias("head"), (F.first("k2").over(seed) != F.last("k2").over(seed)).alias("several")).select(
        "doc_id", "tag", "pos", ((F.col("k2") == 0) | ~F.col("head").eqNullSafe(mine)).alias("repeat"), "several")


def by_document(rows: DataFrame, name: str) -> DataFrame:
    """The positions of each document in one row; a document has no more of them than words."""
    return rows.groupBy(F.col("doc_id").alias("of"), F.col("tag").alias("of_tag")).agg(F.collect_list("pos").alias(name))


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """of, of_tag (a document's id and text hash) and stretches: start << 32 | windows, of all windows that stand earlier."""
    tagged = tag(docs)
    schema = f"k1 bigint, k2 bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, tag int, pos bigint"
    met = cut(compared(map_arrow(tagged, lambda b: cells(b, length, seed), schema)).where("repeat or several"))
    unsure = by_document(met.where("not repeat"), "cells")
    extended = tagged.join(unsure, at_document()).drop("of", "of_tag")
    found = compared(map_arrow(extended, lambda b: windows(b, length, seed), schema)).where("repeat")
    return by_document(met.where("repeat").select("doc_id", "tag", "pos").unionByName(found.select("doc_id", "tag", "pos")),
                       "stretches")


def tag(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.hash("text").alias("tag"), "text")


def at_document():
    return F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("tag") == F.col("of_tag"))


def cut_out(words: Words, held: pa.Array, length: int) -> np.ndarray:
    """Which words of the texts stay."""
    pos = held.flatten().to_numpy(zero_copy_only=False) if len(held) else np.empty(0, np.int64)
    lengths = np.diff(held.offsets.to_numpy()) if not held.null_count else np.array([len(x or ()) for x in held.to_pylist()])
    start = (pos >> 32) + words.first[np.repeat(np.arange(len(held)), lengths)]
    depth = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + (pos & 0xFFFFFFFF) + length - 1, -1)
    return np.cumsum(depth[:-1]) == 0


def kept_text(words: Words, stay: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words that stay, each followed by a space, and where each text begins in that."""
    size = (words.ends - words.starts)[stay] + 1
    place = np.concatenate([[0], np.cumsum(size)])
    out = np.full(place[-1], 0x20, np.uint8)
    source = np.repeat(words.starts[stay] - place[:-1], size - 1) + (to := np.repeat(place[:-1], size - 1) + spans(size - 1))
    out[to] = words.data[source]
    bounds = place[np.concatenate([[0], np.cumsum(stay)])[words.first]]
    return out.tobytes(), bounds


def without_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with texts kept_text: the words that stay, joined by one space."""
    found = repeats(docs, length, seed)
    joined = tag(docs).join(found, at_document(), "left").select("doc_id", "text", "stretches")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = split_words(batch.column("text"))
            stay = cut_out(words, batch.column("stretches"), length)
            text, at = kept_text(words, stay)
            kept = [text[a : max(a, b - 1)] for a, b in zip(at, at[1:], strict=False)]
            n = np.diff(words.first)
            left = np.diff(np.concatenate([[0], np.cumsum(stay)])[words.first])
            out = [batch.column("doc_id"), pa.array(n), pa.array(n - left),
                   pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
            if texts:
                out.append(pa.array([k.decode() for k in kept], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts
    kinds = [docs.schema["doc_id"].dataType.simpleString(), "bigint", "bigint", "string"] + ["string"] * texts
    return map_arrow(joined, run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
