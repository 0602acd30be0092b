"""Shards of a byte limit by extendible hashing.

A row's key is the leading 60 bits of a hash of its id and text. A bucket of depth d holds the rows whose keys share d leading
bits. Starting from one bucket, only those over the limit split on another bit; the directory has an entry for each prefix of
as many bits as the deepest bucket, and several entries may name one bucket. A prefix longer than needed is never used, so a
row that arrives later changes only the bucket it falls into.

Rows whose common key alone exceeds the limit (a single longer text, or many equal rows) can be split by no bit: they go to
pages of that key, `key#page`, each with as many rows as fit, or one row if that is longer than the limit itself.

Defined results: null texts have no bytes; null ids are keyed as empty strings; equal rows get the same bucket or pages of the
same key; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import cut, fresh, stored

KEY_BITS = 60
LIMIT_BYTES = 1 << 20


def key() -> Column:
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")


def prefix(depth: int) -> Column:
    return F.shiftright("key", KEY_BITS - depth)


def heavy_keys(rows: DataFrame, limit: int) -> DataFrame:
    """key, n, each, per_page: keys whose rows exceed the limit; at most total bytes / limit of them."""
    return (rows.groupBy("key").agg(F.sum("n_bytes").alias("all"), F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("each"))
            .where(F.col("all") > limit)
            .select("key", "n", F.greatest(F.lit(1), F.expr(f"{limit} div each")).alias("per_page")))


def buckets(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """prefix, depth, bytes, n: the buckets that extendible hashing ends with, none deeper than `depth`."""
    cells = rows.groupBy(prefix(depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    nodes = cut(
        cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
        .groupBy("depth", F.expr(f"shiftright(cell, {depth} - depth)").alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")))
    split = nodes.where(F.col("bytes") > limit).select(
        (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.expr("prefix * 2"), F.expr("prefix * 2 + 1"))).alias("prefix"))
    made = split.unionByName(rows.sparkSession.range(1).select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix")))
    fits = (F.col("bytes") <= limit) | (F.col("depth") == depth)
    return nodes.join(made, ["depth", "prefix"]).where(fits).select("prefix", "depth", "bytes", "n")


def paged(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Rows of heavy keys with shard, depth, shard_bytes, shard_rows; rows are numbered first within parts, so that no key meets in one task."""
    parts = rows.join(heavy, "key").withColumn("part", F.expr("shiftright(row, 20)"))
    sizes = parts.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("key", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("key", "part").orderBy("row")) - 1 + F.col("offset")
    page = parts.join(offsets, ["key", "part"]).withColumn("page", F.floor(number / F.col("per_page")))
    per_page = page.groupBy("key", "page").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    name = F.concat(F.lower(F.lpad(F.hex("key"), KEY_BITS // 4, "0")), F.lit("#"), F.col("page").cast("string"))
    return page.join(per_page, ["key", "page"]).select(
        *rows.columns, name.alias("shard"), F.lit(KEY_BITS).alias("depth"), "shard_bytes", "shard_rows")


def directory(light: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The directory over rows without heavy keys: entry, shard, depth, shard_bytes, shard_rows; and the bits of an entry.

    It has 2**bits entries, bits being the depth of the deepest bucket: about log2(bytes / limit) and a few more, as keys are hashes.
    """
    total = light.agg(F.sum("n_bytes")).first()[0] or 0
    depth = max(1, math.ceil(math.log2(max(total, 1) / limit)) + 3)
    found = cut(buckets(light, depth, limit))
    while depth < KEY_BITS and not found.where(F.col("bytes") > limit).isEmpty():
        depth = min(depth + 2, KEY_BITS)
        found = cut(buckets(light, depth, limit))
    deepest = found.agg(F.max("depth")).first()[0] or 0
    shard = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    first, last = (f"shiftleft(prefix{plus}, {deepest} - depth)" for plus in ("", " + 1"))
    return found.select(
        F.explode(F.expr(f"sequence({first}, {last} - 1)")).alias("entry"),
        shard.alias("shard"), "depth", F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows")), deepest


def n_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, n_bytes, shard (its leading bits, or key#page), depth, shard_bytes, shard_rows for every row."""
    rows = cut(docs.select("doc_id", key().alias("key"), n_bytes().alias("n_bytes")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    heavy = cut(heavy_keys(rows, limit))
    light = rows.join(heavy, "key", "left_anti")
    entries, bits = directory(light, limit)
    out = ["doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows"]
    held = light.withColumn("entry", prefix(bits)).join(entries, "entry").select(*out)
    return held if heavy.isEmpty() else held.unionByName(paged(rows, heavy).select(*out))


def sharded(docs: DataFrame, limit: int = LIMIT_BYTES, order: list[str] | None = None) -> DataFrame:
    """The documents with a further column shard; no shard has more bytes than the limit, but for single longer texts.

    With ``order`` (columns) the rows of a shard are together in one partition and in that order, so that a written table has each
    shard in one stretch of one file. Rows of heavy keys are written to the shared folder first, as their pages need row numbers.
    """
    shard, mark = fresh(docs, "shard", "shard_key")
    rows = cut(docs.select(key().alias("key"), n_bytes().alias("n_bytes")))
    heavy = cut(heavy_keys(rows, limit))
    entries, bits = directory(rows.join(heavy, "key", "left_anti"), limit)
    named = entries.select(F.col("entry").alias("_entry"), F.col("shard").alias("_shard"))
    keyed, some = docs.withColumn(mark, key()), not heavy.isEmpty()
    light = keyed.join(heavy.select(F.col("key").alias("_key")), F.col(mark) == F.col("_key"), "left_anti") if some else keyed
    held = light.join(named, F.shiftright(mark, KEY_BITS - bits) == F.col("_entry")).select(*docs.columns, F.col("_shard").alias(shard))
    if some:
        own = keyed.join(heavy.select(F.col("key").alias("_key")), F.col(mark) == F.col("_key"), "left_semi")
        own = stored(own.withColumn("_row", F.monotonically_increasing_id()))
        numbered = own.select(F.col(mark).alias("key"), F.col("_row").alias("row"), n_bytes().alias("n_bytes"))
        pages = paged(numbered, heavy).select(F.col("row").alias("_number"), F.col("shard").alias("_shard"))
        held = held.unionByName(own.join(pages, F.col("_row") == F.col("_number")).select(*docs.columns, F.col("_shard").alias(shard)))
    return held if order is None else held.repartition(shard).sortWithinPartitions(shard, *order)
