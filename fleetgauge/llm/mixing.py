"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal size. In the ideal mix every source flows at the rate of its weight, and when a source
runs out the rates of the others are scaled up, until all has flowed. A block is released at the slot in which the ideal mix
begins it and due by the slot in which the ideal mix ends it; in each slot the earliest deadline among the released blocks goes
next. The rates always add up to one block a slot, so every deadline is met, and at any slot of the whole run a source has had
its ideal share to within less than one block.

The ideal mix has a simple form: with whole-number weights W there is a common time v at which source s with n blocks has
flowed min(n, W v), so v = i / W when block i begins, and the slot is the sum of min(n, W v) over all sources. Releases and deadlines
of all blocks follow from that in whole numbers, without walking from source to source or from period to period.

The schedule holds `max_slots` blocks at most, however large the data: blocks have `block_bytes`, or more where the table has more
than `max_slots` times that. Sources beyond the `max_sources` largest form one class, whose weight is the sum of theirs.

Defined results: a null source is a source; null texts have no bytes; a text longer than a block spans several blocks, and its
row carries the first; rows of a source are in no particular order, nulls, repeated ids and equal rows included, and each has a
place of its own; a weight given for a source that is absent is ignored; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import cut, fresh

BLOCK_BYTES = 64 << 10
MAX_SLOTS = 1 << 20
MAX_SOURCES = 10_000
REST = "rest"
PARTS_BITS = 12
#: Weights are whole multiples of 2**-40 of their sum.
WEIGHT_BITS = 40


def whole_weights(weights: list[float]) -> np.ndarray:
    """Weights as whole numbers, at least 1, that add up to about 2**WEIGHT_BITS."""
    shares = np.asarray(weights, float)
    if not (np.isfinite(shares).all() and (shares > 0).all()):
        raise ValueError("weights must be above 0")
    return np.maximum(np.rint(shares / shares.sum() * (1 << WEIGHT_BITS)), 1).astype(np.int64)


def windows(blocks: list[int], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Source, number, release and deadline of every block, source after source."""
    n, w = np.asarray(blocks, np.int64), weights
    ends = n / w
    order = np.argsort(ends, kind="stable")
    #: Blocks of the sources that have ended, and weights of the others, when so many have ended.
    ended = np.concatenate([[0], np.cumsum(n[order])])
    flowing = w.sum() - np.concatenate([[0], np.cumsum(w[order])])
    source = np.repeat(np.arange(len(n)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    def slot(i: np.ndarray, up: bool) -> np.ndarray:
        own = w[source]
        # At the very end of a source both sides of the step give the same slot.
        k = np.searchsorted(ends[order], i / own, "left")
        return ended[k] + (flowing[k] * i + (own - 1 if up else 0)) // own

    return source, number, slot(number, False), slot(number + 1, True)


def earliest_deadline(releases: np.ndarray, deadlines: np.ndarray) -> np.ndarray:
    """The slot of every block: in each slot the released block that is due first, and of these the first listed."""
    slots, ready, at = np.empty(len(releases), np.int64), [], 0
    order = np.argsort(releases, kind="stable")
    opens, dues, blocks = releases[order].tolist(), deadlines[order].tolist(), order.tolist()
    for slot in range(len(blocks)):
        while at < len(blocks) and opens[at] <= slot:
            heapq.heappush(ready, (dues[at], blocks[at]))
            at += 1
        slots[heapq.heappop(ready)[1]] = slot
    return slots


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> pd.DataFrame:
    """class, block, release, deadline and slot of every block of every class."""
    names = sorted(blocks)
    if not names:
        return pd.DataFrame({"class": [], "block": [], "release": [], "deadline": [], "slot": []})
    source, number, release, deadline = windows([blocks[s] for s in names], whole_weights([weights[s] for s in names]))
    return pd.DataFrame({
        "class": np.array(names, object)[source], "block": number, "release": release, "deadline": deadline,
        "slot": earliest_deadline(release, deadline),
    })


def tempered(sizes: dict[str, int], power: float = 0.7) -> dict[str, float]:
    """Target weights between equal (power 0) and in proportion to size (power 1)."""
    return {s: max(n, 1) ** power for s, n in sizes.items()}


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = BLOCK_BYTES, max_slots: int = MAX_SLOTS,
        max_sources: int = MAX_SOURCES) -> DataFrame:
    """doc_id, source, n_bytes, block, release, deadline, slot, place (bytes of its class before it) for every row.

    weights: by source, as text; sources without one get the smallest. Without weights they are `tempered`.
    """
    return placed(docs, weights, block_bytes, max_slots, max_sources).select(
        "doc_id", "source", "n_bytes", "block", "release", "deadline", "slot", "place")


def placed(docs: DataFrame, weights: dict[str, float] | None, block_bytes: int, max_slots: int, max_sources: int) -> DataFrame:
    """What `mix` gives, with the named source and the number of each row."""
    rows = cut(docs.select(
        "doc_id", "source", F.to_json(F.struct("source")).alias("named"), F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")))
    sizes = rows.groupBy("named").agg(F.sum("n_bytes").alias("n_bytes"))
    largest = sizes.orderBy(F.desc("n_bytes"), "named").limit(max_sources).select("named")
    turn = F.xxhash64("row")
    classed = cut(rows.join(F.broadcast(largest.withColumn("class", F.col("named"))), "named", "left")
                  .select("doc_id", "source", "n_bytes", turn.alias("turn"), F.coalesce("class", F.lit(REST)).alias("class"),
                          F.shiftright(turn, 64 - PARTS_BITS).alias("part")))
    parts = cut(classed.groupBy("class", "part").agg(F.sum("n_bytes").alias("bytes")))
    total = {r["class"]: r["bytes"] for r in parts.groupBy("class").agg(F.sum("bytes").alias("bytes")).collect()}
    given = {json.dumps({"source": s} if s is not None else {}, separators=(",", ":"), ensure_ascii=False): w for s, w in (weights or {}).items()}
    wanted = {s: given.get(s, min(given.values())) for s in total} if given else tempered(total)
    if given and REST in total:
        pooled = sizes.join(F.broadcast(largest), "named", "left_anti")
        known = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in given.items()], "named string, weight double")
        wanted[REST] = pooled.join(known, "named", "left").agg(F.sum(F.coalesce("weight", F.lit(float(min(given.values())))))).first()[0]
    # Each class has one block more than its bytes fill, at most.
    width = max(block_bytes, -(-sum(total.values()) // max(1, max_slots - len(total))))
    plan = schedule({s: n // width + 1 for s, n in total.items()}, wanted)
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("class", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("class", "part").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    at = (classed.join(offsets, ["class", "part"])
          .withColumn("place", F.col("offset") + F.coalesce(F.sum("n_bytes").over(within), F.lit(0)))
          .withColumn("block", F.expr(f"place div {width}")))
    # One row for each slot; the engine broadcasts them or joins by (class, block), each block's rows being about a block of bytes.
    laid = docs.sparkSession.createDataFrame(plan, "class string, block long, release long, deadline long, slot long")
    return at.join(laid, ["class", "block"])


def with_row_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with columns that say where each stands: number of the file and row in it, or, where they are not read from files, a
    number that grows with partition and row."""
    file, row = fresh(docs, "file_number", "row_number")
    try:
        number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
        at = docs.select(*docs.columns, F.coalesce(F.nullif(number, F.lit("")).cast("long"), F.lit(0)).alias(file), F.col("_metadata.row_index").alias(row))
        return at, [file, row]
    except AnalysisException:
        return docs.withColumn(row, F.monotonically_increasing_id()), [row]


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents, all of them, in the order of their slots. Rows of one id follow each other."""
    by, slot, place = fresh(docs, "mixed_id", "mixed_slot", "mixed_place")
    order = mix(docs, **options).groupBy(F.col("doc_id").alias(by)).agg(F.min(F.struct("slot", "place")).alias(slot))
    joined = docs.join(order, F.col("doc_id").eqNullSafe(F.col(by)))
    return joined.orderBy(f"{slot}.slot", f"{slot}.place").select(*docs.columns)
