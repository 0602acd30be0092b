"""Equi-joins of a fact table with a dimension whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
SALTS = 16


MAX_BROADCAST_BYTES = 64 << 20


def is_bounded(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether rows and bytes are within the bounds; reads at most ``max_rows + 1`` rows of the dimension."""
    texts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, t in dim.dtypes if t in ("string", "binary")]
    others = [F.coalesce(F.octet_length(F.to_json(F.struct(f"`{c}`"))), F.lit(0)) for c, t in dim.dtypes if "<" in t]
    width = F.lit(16 * len(dim.columns)).cast("bigint")
    for part in [*texts, *others]:
        width = width + part
    rows, size = dim.select(width.alias("_width")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("_width")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def join_dimension(
    df: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    salts: int | Column = SALTS,
) -> DataFrame:
    """Join on equal keys (``inner``, ``left``, ``left_semi``, ``left_anti``).

    A dimension within the bound is broadcast: no shuffle of ``df``, and a hot key costs nothing. A larger one
    is repeated ``salts`` times and joined on (keys, salt), which spreads each key of ``df`` over as many tasks. That join is
    sorted by demand: the optimizer does not count the repeats and would collect a table of few columns on the driver.
    ``salts`` may be a column of the keys, where only some of them need spreading.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if is_bounded(dim, max_broadcast_rows):
        return df.join(F.broadcast(dim), keys, how)
    salts = F.lit(salts) if isinstance(salts, int) else salts
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(df)), salts).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(repeated.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    """Columns a hash accepts: no maps and no variants, at any depth."""
    return [f.name for f in df.schema.fields
            if not any(word in f.dataType.simpleString() for word in ("map<", "variant"))]


def computed_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows, with ``columns`` evaluated once.

    The optimizer copies the expression of a column into every filter on it, and all it is made of with it; for a
    parsed document that means parsing it again for each mention. Passing through a one-row ``inline`` stops that.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns)))).select(*df.columns)
