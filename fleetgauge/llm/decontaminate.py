"""Benchmark decontamination by templates: finds benchmark items in documents, also with other numbers, names or units.

1. Canonical form. Texts become tokens: numbers, units of measure and names (capitals inside a sentence) turn into typed
   placeholders that remember their value, all other words are lowered. Marks between words do not count.
2. Hash join. Every window of `window` tokens of a document is joined with the windows of the items (a shorter item is one window) on
   the hash of its template; a window that is not mostly words, and an item of less than `LEAST` tokens, on the hash of its
   values, so these are found word by word only. Where the benchmark has up to `MAX_KEYS` windows (8 bytes each) their
   hashes are sent to the tasks, which then give out only the windows that will meet; beyond that the join alone decides.
3. Slot check. Windows of one item at one offset form an alignment. Its placeholders must map one to one: equal values of the
   item to equal values of the document, different ones to different ones. Alignments that fail are dropped.
4. A document holds an item if consistent alignments cover `coverage` of its tokens; it is `verbatim` if no value changed.

Defined results: null and empty texts, and items without a token, match nothing; repeated rows are each found; equal items are
each found; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import LOWER, Words, fresh, map_arrow, mix64, pieces, powers, ship, spans, split_words, stored

WINDOW = 10
LEAST = 5
COVERAGE = 0.5
MAX_KEYS = 1 << 20
#: Units of measure, as words.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs hour hours minute minutes second seconds day days week "
         "weeks month months year years percent degree degrees dollar dollars euro euros cent cents meter meters metre metres "
         "kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres mile miles inch "
         "inches foot feet pound pounds ounce ounces").split()
WORD, NUMBER, NAME, UNIT = range(4)
_SLOT = mix64(np.arange(4, dtype=np.uint64) + np.uint64(77))
_OTHER = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_END = np.isin(np.arange(256), [ord(c) for c in ".?!\n"])
_STEP = 0xA24BAED4963EE407


@dataclass
class Tokens:
    """Canonical tokens: hash of the template, hash of the value, type, and first[d]..first[d + 1] of text d."""

    template: np.ndarray
    value: np.ndarray
    kind: np.ndarray
    first: np.ndarray

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all runs of `size` tokens inside a text, their hashes, and how many of the tokens are words."""
        n = len(self.template)
        if n < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        up, down = powers(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.template * up[:n], dtype=np.uint64)])
        plain = np.concatenate([[0], np.cumsum(self.kind == WORD)])
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero(doc[: n - size + 1] == doc[size - 1 :])
        return at, mix64((sums[at + size] - sums[at]) * down[at] + np.uint64(size * _STEP % (1 << 64))), plain[at + size] - plain[at]


def unit_hashes() -> np.ndarray:
    return np.sort(split_words(pa.array([" ".join(UNITS)])).hashes())


_units = unit_hashes()


def canonical(texts: pa.Array) -> Tokens:
    words = split_words(texts, _OTHER)
    raw, n = words.data, len(words.starts)
    if not n:
        none = np.empty(0, np.uint64)
        return Tokens(none, none, np.empty(0, np.int8), words.first)
    lowered = Words(LOWER[raw], words.bounds, words.starts, words.ends, words.first)
    value = lowered.hashes()
    head = raw[words.starts]
    ends = np.concatenate([[0], np.cumsum(_END[raw], dtype=np.int64)])
    opens = np.ones(n, bool)
    opens[1:] = ends[words.starts[1:]] > ends[words.ends[:-1]]
    opens[words.first[:-1][words.first[:-1] < n]] = True
    number = (head >= 48) & (head <= 57)
    second = raw[np.minimum(words.starts + 1, len(raw) - 1)]
    capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))
    kind = np.zeros(n, np.int8)
    kind[capital & ~opens] = NAME
    kind[_units[np.minimum(np.searchsorted(_units, value), len(_units) - 1)] == value] = UNIT
    kind[number] = NUMBER
    # Parts of one number, as in 3.5 or 10,000, are one token: the first stands for it, its value takes in the others.
    tail = np.zeros(n, bool)
    tail[1:] = number[1:] & number[:-1] & (words.starts[1:] == words.ends[:-1] + 1)
    tail[words.first[:-1][words.first[:-1] < n]] = False
    tail &= np.isin(raw[np.maximum(words.starts - 1, 0)], [ord(c) for c in ".,:/"])
    keep = np.flatnonzero(~tail)
    group = np.cumsum(~tail) - 1
    merged = value[keep].copy()
    np.add.at(merged, group[tail], mix64(value[tail] + np.flatnonzero(tail).astype(np.uint64) - keep[group[tail]].astype(np.uint64)))
    kind = kind[keep]
    template = np.where(kind == WORD, merged, _SLOT[kind])
    return Tokens(template, merged, kind, np.searchsorted(keep, words.first))


def keyed_runs(tokens: Tokens, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and keys of all runs, and which keys are of values: those of runs not mostly of words and of short ones. The others
    are of templates."""
    at, templates, plain = tokens.runs(size)
    exact = (plain * 2 <= size) | (size < LEAST)
    values = replace(tokens, template=tokens.value).runs(size)[1]
    return at, np.where(exact, mix64(values ^ np.uint64(_STEP)), templates), exact


def windows(column: str, sizes: list[int] | None, window: int, names: list[str], keys: np.ndarray | None = None):
    """Rows (key, exact, size, the batch's other columns, start, tokens of the text, places and values of the placeholders) of runs.

    Without sizes each text gives its runs of `window` tokens, or one run if it is shorter. Only runs with one of the keys, if given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, column):
            tokens = canonical(batch.column(column))
            counts = np.diff(tokens.first)
            doc = np.repeat(np.arange(len(counts)), counts)
            slots = np.concatenate([[0], np.cumsum(tokens.kind != WORD)])
            where = np.flatnonzero(tokens.kind != WORD)
            wanted = sizes if sizes is not None else sorted({min(int(c), window) for c in counts if c})
            for size in wanted:
                at, key, exact = keyed_runs(tokens, size)
                if sizes is None:
                    own = counts[doc[at]]
                    fits = (own == size) if size < window else (own >= window)
                    at, key, exact = at[fits], key[fits], exact[fits]
                if keys is not None and len(keys):
                    met = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
                    at, key, exact = at[met], key[met], exact[met]
                a, n = slots[at], slots[at + size] - slots[at]
                places = where[np.repeat(a, n) + spans(n)]
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                rest = [batch.column(c).take(pa.array(doc[at])) for c in names]
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(exact), pa.array(np.full(len(at), size, np.int32)), *rest,
                    pa.array((at - tokens.first[doc[at]]).astype(np.int32)), pa.array(counts[doc[at]].astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array((places - np.repeat(at, n)).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tokens.value[places].view(np.int64))),
                ], ["key", "exact", "size", *names, "start", "tokens", "slots", "values"])

    return run


_RUN = "start int, tokens int, slots array<int>, values array<long>"


def check(met: pa.Table) -> tuple | None:
    """First token, tokens covered, tokens of the item, placeholders and changed ones, from the windows in which a text and an item meet."""
    aligned: dict[int, dict] = defaultdict(dict)
    columns = [met.column(c).to_pylist() for c in ("exact", "start", "place", "size", "slots", "values", "own")]
    for exact, start, place, size, slots, theirs, mine in zip(*columns, strict=True):
        held = aligned[start - place]
        for k in range(place, place + size):
            held.setdefault(k, None)
        # Equal values may be a name in one text and begin a sentence in the other.
        for k, v, w in zip(slots, theirs, theirs if exact else mine, strict=True):
            held[place + k] = (v, w)
    covered, first, slots, changed = set(), None, 0, 0
    for offset, held in sorted(aligned.items(), key=lambda x: (-len(x[1]), x[0])):
        pairs = {p for p in held.values() if p}
        if len(pairs) != len({v for v, _ in pairs}) or len(pairs) != len({w for _, w in pairs}):
            continue
        new = [k for k in held if k not in covered]
        slots += sum(held[k] is not None for k in new)
        changed += sum(held[k] is not None and held[k][0] != held[k][1] for k in new)
        covered.update(held)
        at = offset + min(held)
        first = at if first is None else min(first, at)
    return None if first is None else (first, len(covered), met.column("item_tokens")[0].as_py(), slots, changed)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, max_keys: int = MAX_KEYS) -> DataFrame:
    """doc_id, item_id, first_token, covered, item_tokens, slots, changed, kind for every item found in a document."""
    doc_kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    asked = benchmark.select(F.monotonically_increasing_id().alias("item_row"), "item_id", "text")
    items = stored(map_arrow(asked, windows("text", None, window, ["item_row", "item_id"]), f"key long, exact boolean, size int, item_row long, item_id {item_kind}, {_RUN}"))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most `window` of them
    keys = None
    if items.limit(max_keys + 1).count() <= max_keys:
        keys = np.sort(items.select("key").distinct().toArrow().column("key").to_numpy().view(np.uint64))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    runs = map_arrow(rows, windows("text", sizes, window, ["row", "doc_id"], keys), f"key long, exact boolean, size int, row long, doc_id {doc_kind}, {_RUN}")
    own = items.select("key", "exact", "size", "item_row", "item_id", F.col("start").alias("place"), F.col("tokens").alias("item_tokens"), F.col("values").alias("own"))
    met = runs.join(own, ["key", "exact", "size"]).select("row", "doc_id", "item_row", "item_id", "exact", "start", "place", "size", "slots", "values", "own", "item_tokens")
    names = ["doc_id", "item_id", "first_token", "covered", "item_tokens", "slots", "changed", "kind"]
    schema = f"doc_id {doc_kind}, item_id {item_kind}, " + ", ".join(f"{n} int" for n in names[2:7]) + ", kind string"

    def judge(group: pa.Table) -> pa.Table:
        found = check(group)
        some = [found] if found and found[1] >= coverage * found[2] else []
        numbers = [pa.array([f[i] for f in some], pa.int32()) for i in range(5)]
        kind = pa.array(["reparameterised" if f[4] else "verbatim" for f in some], pa.string())
        return pa.Table.from_arrays([*(group.column(c).slice(0, len(some)) for c in ("doc_id", "item_id")), *numbers, kind], names)

    ship(docs.sparkSession)
    return met.groupBy("row", "item_row").applyInArrow(judge, schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, max_keys: int = MAX_KEYS) -> DataFrame:
    """The documents that hold no benchmark item; all columns. Equal texts hold the same, so texts are told by their digests."""
    mark = fresh(docs, "digest")[0]
    texts = docs.where(F.col("text").isNotNull()).select(F.sha2("text", 256).alias("doc_id"), "text")
    found = stored(contaminated(texts, benchmark, window, coverage, max_keys).select(F.col("doc_id").alias("_found")).distinct())
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return docs.withColumn(mark, digest).join(found, F.col(mark) == F.col("_found"), "left_anti").select(*docs.columns)
