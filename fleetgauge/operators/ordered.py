"""Operators in arrival order that survive a hot group.

A window over a whole group runs in one task, so a device or tenant holding a third of all rows would hold up the
job. Groups up to ``max_rows`` rows use that window. Larger ones are cut into chunks of consecutive arrival numbers;
as arrival numbers are unique, a chunk never has more than ``max_rows`` rows. What a chunk needs from the earlier
ones is carried in from per-chunk summaries (running aggregates) or from copied rows (row frames).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_GROUP_ROWS = 4_000_000
# Hot groups number at most rows / max_rows; up to this many are sent to the tasks as a broadcast table.
MAX_LISTED_GROUPS = 100_000


def split_hot(df: DataFrame, keys: list[str], seq: str, max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups with a ``_chunk`` number or None when there are none)."""
    spark = df.sparkSession
    sizes = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(seq).alias("_first"))
        .filter(F.col("_rows") > max_rows)
        .select(*keys, "_first")
    )
    listed = sizes.limit(MAX_LISTED_GROUPS + 1).collect()
    if not listed:
        return df, None
    chunk = F.floor((F.col(seq) - F.col("_first")) / F.lit(max_rows)).cast("bigint")
    if not keys:
        first = listed[0]["_first"]
        return df.limit(0), df.withColumn("_first", F.lit(first)).withColumn("_chunk", chunk).drop("_first")
    hot = sizes
    if len(listed) <= MAX_LISTED_GROUPS:
        hot = F.broadcast(spark.createDataFrame(listed, sizes.schema))
    marked = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_first")
    match = None
    for k in keys:
        equal = df[k].eqNullSafe(marked[f"_hot_{k}"])
        match = equal if match is None else match & equal
    ordinary = df.join(marked, match, "left_anti")
    chunked = df.join(marked, match, "inner").withColumn("_chunk", chunk).select(*df.columns, "_chunk")
    return ordinary, chunked


def _earlier_chunks(summary: DataFrame, keys: list[str], totals: dict[str, str]) -> DataFrame:
    """Per chunk, each total over the chunks before it."""
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        *keys, "_chunk", *[F.expr(f"{how}({name})").over(before).alias(f"_before_{name}") for name, how in totals.items()]
    )


def _with_earlier(rows: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    right = earlier.select(
        *[F.col(k).alias(f"_e_{k}") for k in [*keys, "_chunk"]],
        *[c for c in earlier.columns if c.startswith("_before_")],
    )
    match = rows["_chunk"] == right["_e__chunk"]
    for k in keys:
        match = match & rows[k].eqNullSafe(right[f"_e_{k}"])
    return rows.join(right, match, "left").drop(*[f"_e_{k}" for k in [*keys, "_chunk"]])


def running(
    df: DataFrame,
    keys: list[str],
    seq: str,
    aggregates: dict[str, tuple[str, str]],
    include_current: bool = True,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add running aggregates per group in arrival order.

    ``aggregates`` maps the new column to (``sum`` | ``count`` | ``min`` | ``max``, input column). With
    ``include_current`` false the current row is left out.
    """
    end = 0 if include_current else -1

    def window(by):
        return Window.partitionBy(*by).orderBy(seq).rowsBetween(Window.unboundedPreceding, end)

    ordinary, hot = split_hot(df, keys, seq, max_rows)
    plain = ordinary.select(
        *df.columns, *[F.expr(f"{how}({col})").over(window(keys)).alias(name) for name, (how, col) in aggregates.items()]
    )
    if hot is None:
        return plain
    summary = hot.groupBy(*keys, "_chunk").agg(
        *[F.expr(f"{how}({col})").alias(name) for name, (how, col) in aggregates.items()]
    )
    combine = {name: "sum" if how in ("sum", "count") else how for name, (how, _) in aggregates.items()}
    rows = _with_earlier(hot, _earlier_chunks(summary, keys, combine), keys)
    inside = window([*keys, "_chunk"])
    columns = []
    for name, (how, col) in aggregates.items():
        here, before = F.expr(f"{how}({col})").over(inside), F.col(f"_before_{name}")
        columns.append(_combine(how, before, here).cast(plain.schema[name].dataType).alias(name))
    return plain.unionByName(rows.select(*df.columns, *columns))


def _combine(how: str, before: Column, here: Column) -> Column:
    if how == "min":
        return F.least(before, here)
    if how == "max":
        return F.greatest(before, here)
    if how == "count":
        return F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))
    return F.coalesce(before + here, before, here)


def rolling_rows(
    df: DataFrame,
    keys: list[str],
    seq: str,
    rows: int,
    aggregates: dict[str, Column],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add aggregates over the current row and the ``rows - 1`` before it in its group.

    ``aggregates`` maps the new column to an aggregate expression. ``max_rows`` must be at least ``rows``.
    """
    if max_rows < rows:
        raise ValueError("max_rows must be at least the frame length")

    def framed(source, by, order):
        frame = Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)
        return [agg.over(frame).alias(name) for name, agg in aggregates.items()]

    ordinary, hot = split_hot(df, keys, seq, max_rows)
    plain = ordinary.select(*df.columns, *framed(ordinary, keys, seq))
    if hot is None:
        return plain
    # Number the rows of each group, then cut by that number: every block is full, and only the last rows of a
    # block are copied to the next one.
    counts = hot.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("n"))
    placed = _with_earlier(hot, _earlier_chunks(counts, keys, {"n": "sum"}), keys)
    in_chunk = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(seq))
    placed = placed.withColumn("_pos", F.coalesce(F.col("_before_n"), F.lit(0)) + in_chunk - 1)
    home = F.floor(F.col("_pos") / F.lit(max_rows)).cast("bigint")
    tail = F.pmod(F.col("_pos"), F.lit(max_rows)) > max_rows - rows
    copies = (
        placed.select(*df.columns, "_pos", home.alias("_home"))
        .withColumn(
            "_block",
            F.explode(F.when(tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
        )
    )
    wide = copies.select(*df.columns, "_home", "_block", *framed(copies, [*keys, "_block"], "_pos"))
    return plain.unionByName(wide.filter(F.col("_home") == F.col("_block")).select(*plain.columns))


def first_rows(
    df: DataFrame, keys: list[str], order: list[Column], n: int, salts: int = 1, salt_by: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group in the given order.

    Each map task keeps at most ``n`` rows per group before the shuffle (the optimizer's group limit). ``salts``
    above 1 adds a level that cuts every group into that many parts first: use it where few groups hold all rows.
    """
    out = df
    if salts > 1:
        part = F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")
        out = _limit_groups(out.withColumn("_part", part), [*keys, "_part"], order, n).drop("_part")
    return _limit_groups(out, keys, order, n)


def _limit_groups(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    if not keys:
        return df.orderBy(*order).limit(n)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
