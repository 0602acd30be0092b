"""Near-duplicates by SimHash: documents whose 64-bit fingerprints differ in few bits, found with vantage-point trees.

1. A fingerprint has a bit if it is set in over half the hashes of a text's shingles. Equal fingerprints become one row.
2. A vantage-point tree over a bounded sample of fingerprints splits the space into shards: a node holds a fingerprint and
   a radius; those within the radius go one way, the others the other way. Every fingerprint is a member of one shard. By the
   triangle inequality a pair within `bits` can only be apart if one of the two lies within `bits` of the boundary; such a
   fingerprint also visits the shard across, if that comes before its own.
3. In a shard, members and visitors look up the members with a tree of the same kind that goes down to small leaves. What is
   found is joined at once into groups, so a shard gives at most one link for each fingerprint in it, never all pairs.
4. A shard of over `DENSE` times the usual rows is a ball of fingerprints so close to each other that no vantage point tells
   them apart. It is not searched in one task: each of its fingerprints is filed under itself and under all that differ from it
   in bits / 2 bits, and two lie within `bits` exactly if they meet under one of these. A key holds 65 fingerprints at most
   (for 2 bits), and rows are 65 for each fingerprint however many the ball has.
5. The links of all shards form a graph, whose connected components are the groups.

The sample only places the boundaries: whatever it holds, every pair within `bits` is found. The number of shards follows
the number of distinct fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm.common import cut, fresh, map_arrow
from fleetgauge.llm.components import components

BITS = 2
SHINGLE = 3
SEED = 42
SHARD_ROWS = 16_384
#: A shard with more rows than so many times SHARD_ROWS is joined by shared neighbours instead (for an even number of bits).
DENSE = 2
#: Sampled fingerprints for each shard, and at most; a sample that is too small makes shards uneven, not results wrong.
SAMPLE_EACH = 64
SAMPLE_MAX = 1 << 18
SAMPLE_LEAST = 8
#: Fingerprints of a ball that one task files under their neighbours.
BALL_ROWS = 4096
LEAF = 64
#: Vantage points tried for a node.
VANTAGES = 8
#: Hashes whose bits are counted in one go.
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed number. A text of fewer words is one shingle; no words (or null) give 0."""
    words = text.encode().lower().split() if text else []  # of bytes: lowers A-Z, splits at space and U+0009 to U+000D
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = np.array([digest(join(g), SEED) for g in grams], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8").astype(np.int64)[0])


def with_fingerprints(docs: DataFrame, column: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", column])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, `{column}` bigint")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


class Tree:
    """A vantage-point tree over fingerprints. Nodes are (vantage, radius, near, far); leaves are numbered."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        self.leaf = leaf
        self.root = self._build(points, np.arange(len(points)))

    def _build(self, points: np.ndarray, own: np.ndarray):
        if len(own) > self.leaf:
            # The vantage point and radius that halve the points best: fingerprints that are all as far from one vantage
            # point can be told apart from another.
            best = (0, None, None)
            for at in np.linspace(0, len(own) - 1, VANTAGES).astype(int):
                d = distance(points[own], points[own[at]])
                radius = int(np.partition(d, len(d) // 2)[len(d) // 2])
                for r in (radius, radius - 1):
                    near = int((d <= r).sum())
                    best = max(best, (min(near, len(own) - near), at, r), key=lambda x: x[0])
                if best[0] * 5 >= len(own) * 2:
                    break
            smaller, at, r = best
            if smaller * 8 >= len(own):
                near = distance(points[own], points[own[at]]) <= r
                return points[own[at]], r, self._build(points, own[near]), self._build(points, own[~near])
        self.leaves.append(own)
        return len(self.leaves) - 1

    def places(self, queries: np.ndarray, slack: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each leaf the numbers of the queries that have, or with slack may have, points within slack in it."""
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, own = stack.pop()
            if not len(own):
                continue
            if isinstance(node, int):
                yield node, own
                continue
            vantage, radius, near, far = node
            d = distance(queries[own], vantage)
            stack += [(near, own[d <= radius + slack]), (far, own[d > radius - slack])]


def shard_tree(fps: DataFrame, shard_rows: int = SHARD_ROWS) -> Tree:
    """The tree that deals fingerprints to shards, over a sample of at most SAMPLE_MAX of them."""
    shards = 1 << max(0, math.ceil(math.log2(max(fps.count(), 1) / shard_rows)))
    size = min(SAMPLE_EACH * shards, SAMPLE_MAX) if shards > 1 else 1
    sample = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(size).toPandas()["fp"].to_numpy(np.int64)
    return Tree(sample.view(np.uint64), max(SAMPLE_LEAST, size // shards))


def linked(fps: np.ndarray, member: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the fingerprints that have others within bits among the members, and the first of the group of each."""
    group, seen = np.arange(len(fps)), np.zeros(len(fps), bool)

    def top(x: np.ndarray) -> np.ndarray:
        while not np.array_equal(up := group[x], group[up]):
            group[x] = group[up]
        return up

    homes = np.flatnonzero(member)
    tree = Tree(fps[homes], LEAF)
    for leaf, queries in tree.places(fps, bits):
        points = homes[tree.leaves[leaf]]
        step = max(1, (1 << 20) // len(points))
        for at in range(0, len(queries), step):
            q = queries[at : at + step]
            i, j = np.nonzero(distance(fps[q][:, None], fps[points][None, :]) <= bits)
            i, j = q[i], points[j]
            i, j = i[i != j], j[i != j]
            seen[i] = seen[j] = True
            a, b = top(i), top(j)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
            for x, y in pairs.T:
                x, y = int(x), int(y)
                while group[x] != x:
                    x = group[x]
                while group[y] != y:
                    y = group[y]
                group[max(x, y)] = min(x, y)
    found = np.flatnonzero(seen)
    return found, top(found)


def neighbour_links(fps: DataFrame, bits: int) -> DataFrame:
    """a, b: links among distinct fingerprints within bits, an even number, as their balls of half the bits meet."""
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    # A count of partitions of its own, as adaptive execution would put these few bytes, but many rows to come, in one task.
    parts = 1 + fps.count() // BALL_ROWS
    keys = fps.repartition(parts, "fp").select("fp", F.col("fp").alias("key"))
    for _ in range(bits // 2):
        keys = keys.select("fp", "key", F.explode(flips).alias("flip")).select("fp", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
    if bits > 2:
        keys = keys.distinct()
    met = keys.repartition(parts, "key").groupBy("key").agg(F.collect_list("fp").alias("near"))
    found = met.where(F.size("near") > 1).select(F.explode("near").alias("a"), F.array_min("near").alias("b"))
    return found.where("a <> b").distinct()


def links(fps: DataFrame, bits: int = BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """a, b: fingerprints of one group. Their connected components are those of all pairs within bits."""
    tree = shard_tree(fps, shard_rows)
    shards = max(1, len(tree.leaves))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            home = np.zeros(len(values), np.int32)
            for leaf, own in tree.places(values, 0):
                home[own] = leaf
            for leaf, own in tree.places(values, bits):
                own = own[leaf <= home[own]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), leaf, np.int32)), pa.array(values[own].view(np.int64)),
                     pa.array(home[own] == leaf)], ["shard", "fp", "member"])

    def search(shard: pa.Table) -> pa.Table:
        values = shard.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(values.view(np.int64), kind="stable")
        values = values[order]
        found, first = linked(values, shard.column("member").to_numpy(zero_copy_only=False)[order], bits)
        return pa.table({"a": values[found].view(np.int64), "b": values[first].view(np.int64)})

    dealt = cut(map_arrow(fps.select("fp"), deal, "shard int, fp bigint, member boolean"))
    sizes = dealt.groupBy("shard").count()
    limit = DENSE * shard_rows if bits % 2 == 0 else 1 << 62
    dense = F.broadcast(sizes.where(F.col("count") > limit).select("shard"))  # one row for each leaf of the tree at most
    # Shards are numbered, so each gets a task of its own; hashed, several would meet in one.
    found = dealt.join(dense, "shard", "left_anti").repartitionById(shards, "shard").groupBy("shard").applyInArrow(
        search, "a bigint, b bigint")
    if bits % 2:
        return found
    balls = cut(dealt.join(dense, "shard", "left_semi").select("fp").distinct())
    return found.unionByName(neighbour_links(balls, bits))


def groups(fingerprints: DataFrame, bits: int = BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """fp, component_id (smallest doc_id of the group), keep_fp (a fingerprint of that document), for each distinct fp.

    fingerprints: doc_id, fp. Null ids come after all others: a group has a null component_id only if it has no other id.
    """
    distinct = cut(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    labels = cut(components(links(distinct, bits, shard_rows)))
    named = cut(distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "doc_id", F.coalesce("label", "fp").alias("label")))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("fp")))
    heads = named.groupBy("label").agg(first.alias("head"))
    return named.join(heads, "label").select(
        "fp", F.col("head.doc_id").alias("component_id"), F.col("head.fp").alias("keep_fp"))


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id for every row.

    Null and empty texts have fingerprint zero and link like any other; equal rows and repeated ids share a group; an empty
    table gives an empty result; columns other than doc_id and text are ignored.
    """
    marked = cut(with_fingerprints(docs, shingle=shingle))
    return marked.join(groups(marked, bits, shard_rows), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """The documents without those that have another of their group with a smaller id; all columns. Of rows with equal id
    and fingerprint one stays."""
    fp, keep, by = fresh(docs, "fp", "keep_fp", "keep_id")
    marked = cut(with_fingerprints(docs, shingle=shingle))
    heads = groups(marked, bits).where("fp = keep_fp").select(F.col("fp").alias(keep), F.col("component_id").alias(by))
    # The fingerprint is computed a second time, next to the text: cheaper than carrying the text through the search.
    names = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], [*names, fp])

    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])
    kept = map_arrow(docs, add, schema).join(heads, F.col(fp).eqNullSafe(F.col(keep)) & F.col("doc_id").eqNullSafe(F.col(by)))
    return kept.dropDuplicates(["doc_id", fp]).select(*names)
