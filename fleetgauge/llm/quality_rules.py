"""Quality rules whose thresholds come from the corpus: a mergeable quantile sketch per language and source.

Every document gets a few whole-number measures. A sketch of a measure is a table of counts per bucket, where a bucket holds
values that agree in their leading `SKETCH_BITS` bits; two sketches merge by adding counts, and a quantile read from one is at
most 1/32 too high. Sketches hold the documents that pass the base rules, so that the others do not widen the bounds. A
document is kept if no measure lies beyond the bounds of its language and source.

Quartiles of a source are blended with those of its language (merged from all its sources), and these with those of all
documents, in proportion to rows: the wider group counts as `prior_rows` documents. So every source has bounds of its own,
which the first few documents hardly move and many set.

A bound is median + width * (upper quartile - median) + slack, and likewise below. Quartiles stand firm while up to a quarter
of a source is junk; the slack keeps a source whose documents are all alike from rejecting small deviations.

Defined results: null texts are empty texts; null languages and sources are groups of their own; equal rows count as often
as they occur; an empty table gives an empty result; other columns are ignored. A source without a document that passes the
base rules has no bounds and needs none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import SPACE_RUN, cut

SKETCH_BITS = 6
WIDTH = 6
#: Documents that the wider group counts as in a blend.
PRIOR_ROWS = 100
#: Measure, slack above, slack below (None: no bound below).
MEASURES = {
    "word_length": (300, 300),
    "symbol_share": (40, None),
    "dup_line_share": (500, None),
    "repeat_share": (400, None),
    "capital_share": (150, None),
    "mark_share": (60, None),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns, the five counts of the rules, and lines, capitals and marks (exclamation, question) of each text."""
    text = F.coalesce("text", F.lit(""))
    held = docs.select(
        *keep,
        F.filter(F.split(text, SPACE_RUN), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.regexp_replace(text, "[^A-Z!?#*$%&|<>]+", "").alias("special"),
    )
    # A window is known by its hash; get() gives null beyond the end, and windows start at all but the last two words.
    grams = held.select(
        *keep,
        *[F.char_length(F.regexp_replace("special", rest, "")).cast("long").alias(name) for name, rest in (
            ("n_symbols", "[A-Z!?]+"), ("n_capitals", "[^A-Z]+"), ("n_marks", "[^!?]+"))],
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""sort_array(transform(slice(words, 1, greatest(size(words) - 2, 0)),
                  (w, i) -> named_struct('h', xxhash64(w, get(words, i + 1), get(words, i + 2)), 'i', i)))""").alias("grams"),
    )
    found = grams.withColumn("twice", F.expr("""sort_array(transform(
        filter(grams, (x, i) -> x.h <=> get(grams, i - 1).h or x.h <=> get(grams, i + 1).h), x -> x.i))"""))
    covered = F.expr("""aggregate(twice, named_struct('last', -3, 'n', 0L),
        (s, p) -> named_struct('last', p, 'n', s.n + least(3, p - s.last)), s -> s.n)""")
    return found.select(*keep, *BASE[:4], covered.alias("n_repeat_words"), "n_lines", "n_capitals", "n_marks")


def measures(base: DataFrame) -> DataFrame:
    """The measures as whole numbers: hundredths of a character, and parts in a thousand."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.expr(f"{part} * 1000 div {whole}")).otherwise(0).cast("long")

    return base.withColumns({
        "word_length": F.when(F.col("n_words") > 0, F.expr("word_chars * 100 div n_words")).otherwise(0).cast("long"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
    })


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, low, high, n: for each bucket its bounds and how many values it holds. Counts add up to merge."""
    value = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])).alias("m")
    zeros = F.expr(f"greatest(length(bin(m.value)) - {SKETCH_BITS}, 0)")
    return (
        rows.select(*keys, value).select(*keys, "m.measure", "m.value", zeros.alias("zeros"))
        .select(*keys, "measure", F.expr("shiftleft(shiftright(value, zeros), zeros)").alias("low"),
                F.expr("shiftleft(shiftright(value, zeros) + 1, zeros) - 1").alias("high"))
        .groupBy(*keys, "measure", "low", "high").agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "measure", "low", "high").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, rows, q1, q2, q3: the high ends of the buckets in which the quartiles lie."""
    group = Window.partitionBy(*keys, "measure")
    counted = sketches.withColumns({
        "upto": F.sum("n").over(group.orderBy("low").rowsBetween(Window.unboundedPreceding, 0)),
        "rows": F.sum("n").over(group),
    })
    return counted.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        *[F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("high"))).alias(f"q{q}") for q in (1, 2, 3)])


def blended(own: str, rows: str, wider: str, prior_rows: int) -> str:
    """SQL of the mean of a group's quantile and the wider group's, weighted by rows; a whole number."""
    return f"(({own} * {rows} + {wider} * {prior_rows}) div ({rows} + {prior_rows}))"


def bounds(sketches: DataFrame, width: int = WIDTH, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """lang, source, and the bound above (and below) of each measure, one row per language and source."""
    by_source = quartiles(sketches, ["lang", "source"]).alias("s")
    by_lang = quartiles(merged(sketches, ["lang"]), ["lang"]).alias("l")
    overall = quartiles(merged(sketches, []), []).alias("a")

    def level(q: str) -> Column:
        lang = blended(f"l.{q}", "l.rows", f"a.{q}", prior_rows)
        return F.expr(blended(f"s.{q}", "s.rows", lang, prior_rows)).alias(q)

    chosen = (
        by_source.join(by_lang, F.col("s.lang").eqNullSafe(F.col("l.lang")) & (F.col("s.measure") == F.col("l.measure")))
        .join(overall, F.col("s.measure") == F.col("a.measure"))
        .select("s.lang", "s.source", "s.measure", level("q1"), level("q2"), level("q3"))
    )
    out = []
    for m, (above, below) in MEASURES.items():
        mine = F.col("measure") == m
        out.append(F.max(F.when(mine, F.expr(f"q2 + {width} * (q3 - q2) + {above}"))).alias(f"{m}_max"))
        if below is not None:
            out.append(F.max(F.when(mine, F.expr(f"q2 - {width} * (q2 - q1) - {below}"))).alias(f"{m}_min"))
    return chosen.groupBy("lang", "source").agg(*out)


def quality_rules(docs: DataFrame, width: int = WIDTH, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """doc_id, lang, source, the five counts, base_failed, failed (names of the measures out of bounds) and kept."""
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = cut(measures(base_measures(docs, ["doc_id", "lang", "source"])).withColumn("base_failed", base_failed))
    limits = bounds(cut(sketch(rows.where("NOT base_failed"), ["lang", "source"])), width, prior_rows).alias("b")
    names = []
    for m, (_, below) in MEASURES.items():
        out = F.col(m) > F.col(f"{m}_max")
        names.append(F.when(out if below is None else out | (F.col(m) < F.col(f"{m}_min")), F.lit(m)))
    same = F.col("r.lang").eqNullSafe(F.col("b.lang")) & F.col("r.source").eqNullSafe(F.col("b.source"))
    return (
        rows.alias("r").join(limits, same, "left")
        .select("r.doc_id", "r.lang", "r.source", *BASE, "base_failed", F.array_compact(F.array(*names)).alias("failed"))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )
