"""Hard negatives for contrastive training, by Four-Russians scoring of integer vectors.

Components become whole numbers, floor(scale * x). For each anchor and each group of eight dimensions a table holds the sums
of all 256 subsets of the anchor's components. A candidate is stored as bit planes: one byte for each group and plane of its
components in two's complement. Its full exact score is the sum over planes of table entries looked up by those bytes,
shifted by the plane; the top plane counts negatively.

All anchors meet all rows in a grid of anchor blocks and candidate blocks, dealt out by row numbers, so that no label and
no vector, however often it occurs, makes a task larger; each cell keeps only what may still be among the first, and the
cells' lists are merged per anchor. One pass scores rows of the anchor's label, a second one the others.

Rows with a null label, a null vector, a null or non-finite component, or one that exceeds 2**24 once scaled (their products
could leave 64 bits) take no part. Missing dimensions of shorter vectors count as zero. A null id is no anchor, and comes
after all others on ties. Rows with equal ids are different rows: each is an anchor of its own, and each can be a positive or a
negative of the other. Columns other than the id, vector and label play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetgauge.llm.common import map_arrow, ship, stored

SCALE = 256
LARGEST = 1 << 24
EVERY, RELABEL, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: Bounds on a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Rows of a cell of the grid, and anchors and candidates that one numpy pass scores.
ANCHOR_BLOCK, CANDIDATE_BLOCK = 4096, 2048
ANCHOR_STEP, CANDIDATE_STEP = 512, 512

_LAST = np.iinfo(np.int64).max
#: Below any score.
_NONE = -(1 << 62) - 1


def relabelled(id_column: str = "vec_id", label: str = "label") -> Column:
    """The label, moved on by one where the id is divisible by 7."""
    return F.when(F.col(id_column) % RELABEL == 0, (F.col(label) + 1) % LABELS).otherwise(F.col(label))


def integers(vector: str, scale: int = SCALE) -> Column:
    """The vector's components as doubles, scaled and rounded down."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str, label: str, scale: int = SCALE) -> Column:
    """Label and vector are there, and every component is finite and in range."""

    def fits(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) * scale <= LARGEST, F.lit(False)) & ~F.isnan(x.cast("double"))

    return F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(F.col(vector), fits)


def planes_of(values: np.ndarray, planes: int) -> np.ndarray:
    """Bytes [row, group, plane]: bit d of a byte is that bit plane's bit of dimension d of the group."""
    rows, dims = values.shape
    wide = np.zeros((rows, -(-dims // 8) * 8), np.int64)
    wide[:, :dims] = values
    bits = (wide[:, :, None] >> np.arange(planes)) & 1
    return np.packbits(bits.reshape(rows, -1, 8, planes).astype(np.uint8), axis=2, bitorder="little")[:, :, 0, :]


def tables_of(anchors: np.ndarray, groups: int) -> np.ndarray:
    """Subset sums [group, subset, anchor] of the anchors' components, eight dimensions a group."""
    wide = np.zeros((len(anchors), groups * 8), np.int64)
    wide[:, : anchors.shape[1]] = anchors
    most = int(np.abs(wide).sum(axis=1).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    parts = wide.reshape(len(anchors), groups, 8).transpose(1, 2, 0).astype(kind)
    tables = np.zeros((groups, 256, len(anchors)), kind)
    for d in range(8):
        tables[:, 1 << d : 2 << d] = tables[:, : 1 << d] + parts[:, d, None]
    return tables


def scores_of(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products [candidate, anchor]: table entries by the candidates' bytes, added up and shifted plane by plane."""
    rows, groups, count = planes.shape
    found = np.empty((rows, tables.shape[2]), tables.dtype)
    total = np.zeros((rows, tables.shape[2]), np.int64)
    for p in reversed(range(count)):
        level = np.zeros((rows, tables.shape[2]), tables.dtype)
        for g in range(groups):
            np.take(tables[g], planes[:, g, p], axis=0, out=found, mode="clip")
            level += found
        total <<= 1
        if p == count - 1:
            total -= level
        else:
            total += level
    return total


def _vectors(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows of a matrix, zeros where they are shorter."""
    lists = column.combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
    out = np.zeros((len(lists), dims), np.int64)
    row = np.repeat(np.arange(len(lists)), np.diff(ends))
    out[row, np.arange(ends[-1]) - ends[:-1][row]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class First:
    """The first ``size`` of the (score, place) offers to each slot, higher scores and then lower places first."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.score, self.place = np.full((slots, size), _NONE), np.full((slots, size), -1)

    def bar(self) -> np.ndarray:
        """Score that a later offer must exceed, per slot."""
        return self.score[:, -1]

    def offer(self, slot: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        """Offers; all places come after those offered before."""
        order = np.lexsort((place, -score, slot))
        slot, score, place = slot[order], score[order], place[order]
        begin = np.flatnonzero(np.diff(slot, prepend=-1))
        nth = np.arange(len(slot)) - np.repeat(begin, np.diff(begin, append=len(slot)))
        slot, score, place, nth = (a[nth < self.size] for a in (slot, score, place, nth))
        own = np.unique(slot)
        both = np.full((len(own), 2 * self.size), _NONE), np.full((len(own), 2 * self.size), -1)
        both[0][:, : self.size], both[1][:, : self.size] = self.score[own], self.place[own]
        at = np.searchsorted(own, slot)
        both[0][at, self.size + nth], both[1][at, self.size + nth] = score, place
        best = np.argsort(-both[0], axis=1, kind="stable")[:, : self.size]
        self.score[own] = np.take_along_axis(both[0], best, 1)
        self.place[own] = np.take_along_axis(both[1], best, 1)

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slot, score and place of all that were kept."""
        slot, nth = np.nonzero(self.place >= 0)
        return slot, self.score[slot, nth], self.place[slot, nth]


def _in_id_order(table: pa.Table) -> pa.Table:
    """Rows by id, null ids last."""
    ids = table.column("id").fill_null(_LAST).to_numpy()
    return table.take(pa.array(np.lexsort((table.column("row").to_numpy(), table.column("id").is_null().to_numpy(), ids))))


def _unpacked(table: pa.Table, groups: int, planes: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("planes").to_pylist()), np.uint8).reshape(table.num_rows, groups, planes)


def _positives(dims: int, planes: int, size: int):
    """Per cell, the first rows of each anchor's own label."""
    groups = -(-dims // 8)

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = _in_id_order(rows)
        bytes_, vectors = _unpacked(rows, groups, planes), _vectors(anchors.column("vector"), dims)
        numbers, own = rows.column("row").to_numpy(), anchors.column("row").to_numpy()
        label, wanted = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
        best = First(len(own), size)
        by_label = np.argsort(label, kind="stable")
        labels = np.unique(wanted)
        begin, end = (np.searchsorted(label[by_label], labels, side) for side in ("left", "right"))
        for value, a, b in zip(labels, begin, end, strict=True):
            alike = np.flatnonzero(wanted == value)
            for s in range(0, len(alike), ANCHOR_STEP):
                part = alike[s : s + ANCHOR_STEP]
                tables = tables_of(vectors[part], groups)
                for c in range(a, b, CANDIDATE_STEP):
                    places = by_label[c : min(c + CANDIDATE_STEP, b)]
                    scores = scores_of(tables, bytes_[places])
                    at, slot = np.nonzero(scores > best.bar()[part])
                    other = numbers[places[at]] != own[part[slot]]
                    at, slot = at[other], slot[other]
                    best.offer(part[slot], scores[at, slot], places[at])
        slot, score, place = best.taken()
        return pa.table({"anchor": own[slot], "row": numbers[place], "score": score,
                         "id": rows.column("id").combine_chunks().take(pa.array(place, pa.int64()))})

    return run


def _negatives(dims: int, planes: int, size: int, low: int, high: int):
    """Per cell, the first rows of other labels between the bounds that each positive of each anchor sets."""
    groups = -(-dims // 8)

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = _in_id_order(rows)
        bytes_, vectors = _unpacked(rows, groups, planes), _vectors(anchors.column("vector"), dims)
        number = anchors.column("n").to_numpy()
        width = max(1, int(number.max(initial=1)))
        positives, there = _vectors(anchors.column("scores"), width), np.arange(width) < number[:, None]
        least, most = -((-low * positives) // 100), (high * positives) // 100
        least, most = np.where(there, least, 1), np.where(there, most, 0)
        label, wanted = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
        best = First(len(vectors) * width, size)
        for s in range(0, len(vectors), ANCHOR_STEP):
            part = np.arange(s, min(s + ANCHOR_STEP, len(vectors)))
            tables = tables_of(vectors[part], groups)
            for c in range(0, len(label), CANDIDATE_STEP):
                places = np.arange(c, min(c + CANDIDATE_STEP, len(label)))
                scores = scores_of(tables, bytes_[places])
                for j in range(width):
                    slots = part * width + j
                    bar = np.maximum(least[part, j], best.bar()[slots] + 1)
                    at, slot = np.nonzero((scores >= bar) & (scores <= most[part, j]))
                    other = label[places[at]] != wanted[part[slot]]
                    at, slot = at[other], slot[other]
                    best.offer(slots[slot], scores[at, slot], places[at])
        slot, score, place = best.taken()
        own = anchors.column("row").to_numpy()
        return pa.table({"anchor": own[slot // width], "nth": (slot % width).astype(np.int32), "score": score,
                         "id": rows.column("id").combine_chunks().take(pa.array(place, pa.int64()))})

    return run


def _packed(rows: DataFrame, planes: int, dims: int) -> DataFrame:
    """Rows with the bytes of their bit planes."""

    def run(batches):
        for batch in batches:
            packed = planes_of(_vectors(pa.chunked_array([batch.column("vector")]), dims), planes)
            packed = [p.tobytes() for p in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], names=[*batch.schema.names, "planes"])

    return map_arrow(rows, run, "row long, id long, label long, anchor boolean, vector array<long>, planes binary")


def _grid(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, row_blocks: int, cell, schema: str) -> DataFrame:
    """``cell`` over all pairs of an anchor block and a row block."""

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    ship(rows.sparkSession)
    left = dealt(anchors, "a", anchor_blocks, "c", row_blocks).groupBy("a", "c")
    right = dealt(rows, "c", row_blocks, "a", anchor_blocks).groupBy("a", "c")
    return left.cogroup(right).applyInArrow(cell, schema)


def _first(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The first rows of each key by score and id, numbered from 1; a key has at most ``size`` rows per cell."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= size)


def mine(
    rows: DataFrame, vector: str = "embedding", label: Column | None = None, anchors: Column | None = None, id_column: str = "vec_id",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    anchor_block: int = ANCHOR_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """For each anchor and each of its positives, the first rows of other labels that score ``low`` to ``high`` per cent of it.

    An anchor's positives are its first other rows of the same label. Scores are inner products; higher ones come first, ties by
    smaller id. Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score, positive_rank.
    """
    label = F.col("label") if label is None else label
    anchors = F.col(id_column) % EVERY == 0 if anchors is None else anchors
    named = rows.select(F.col(id_column).alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor"))
    fit = named.filter(usable("vector", "label", scale)).select(
        F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), "label", "anchor", integers("vector", scale).alias("vector")
    )
    ready = stored(fit)
    size = ready.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("vector")).alias("dims"),
        F.min(F.array_min("vector")).alias("least"), F.max(F.array_max("vector")).alias("most"),
    ).first()
    dims = max(size.dims or 0, 1)
    planes = max(int(max(size.most or 0, -1 - (size.least or 0))).bit_length() + 1, 1)
    ready = stored(_packed(ready.select("row", "id", "label", "anchor", "vector"), planes, dims))
    # New names inside the plan: both sides of the grid come from one table.
    again = ready.select(*[F.col(c).alias(f"_{c}") for c in ready.columns]).toDF(*ready.columns)
    blocks = max(1, -(-size.anchors // anchor_block)), max(1, -(-size.rows // candidate_block))
    asked = ready.filter("anchor").select("row", "label", "vector")
    candidates = again.select("row", "id", "label", "planes")
    near = _grid(asked, candidates, *blocks, _positives(dims, planes, positives), "anchor long, row long, score long, id long")
    found = stored(_first(near, ["anchor"], positives).select("anchor", "nth", "score", "id"))
    listed = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("p"))
    judged = asked.join(listed, asked["row"] == listed["anchor"]).select(
        "row", "label", "vector", F.col("p")["score"].alias("scores"), F.size("p").alias("n")
    )
    cells = _grid(judged, candidates, *blocks, _negatives(dims, planes, negatives, low, high), "anchor long, nth int, score long, id long")
    ranked = _first(cells.withColumnRenamed("nth", "positive"), ["anchor", "positive"], negatives)
    owners = ready.filter("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    chosen = found.join(owners, "anchor").select(
        "anchor", (F.col("nth") - 1).alias("positive"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return ranked.join(chosen, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"), (F.col("positive") + 1).cast("int").alias("positive_rank"),
    )
