"""One registered query for each operator, over the whole documents table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm import (decontaminate, fim, hard_negatives, language_id, line_crf, mixing, quality_rules, sharding, simhash,
                            substring, token_counts, token_store, toxicity)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(parts: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> line_crf.Model:
    docs = documents(spark, sf_dir) if docs is None else docs
    return line_crf.fit(docs, table(spark, sf_dir, "labels"), fold(3) != 1)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.new_store(spark)
    token_store.write(documents(spark, sf_dir), path, tokenizer_file("word_bpe_49k.json"))
    return token_store.read(spark, path, ids=False)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(documents(spark, sf_dir), texts=False)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = line_crf.score(documents(spark, sf_dir), quality_model(spark, sf_dir))
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    named = language_id.score(docs.select("doc_id", "text"), language_id.fit(docs, fold(3) != 1))
    return named.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous", "bits_off")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=hard_negatives.relabelled())


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(), 256).alias("restored_sha256"))


WORD = r"[^\x20\x09-\x0D]+"


def op1_sql() -> str:
    width, prior = quality_rules.WIDTH, quality_rules.PRIOR_ROWS
    names = list(quality_rules.MEASURES)
    levels = [("s", ["lang", "source", "measure"]), ("l", ["lang", "measure"]), ("a", ["measure"])]
    quartiles = ",\n".join(f"""q{t} AS (
        SELECT {", ".join(keys)}, max(total) AS total, min(high) FILTER (upto * 4 >= total) AS q1,
               min(high) FILTER (upto * 4 >= total * 2) AS q2, min(high) FILTER (upto * 4 >= total * 3) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY {", ".join(keys)} ORDER BY low) AS upto, sum(n) OVER (PARTITION BY {", ".join(keys)}) AS total
              FROM (SELECT {", ".join(keys)}, low, high, count(*) AS n FROM buckets GROUP BY ALL))
        GROUP BY {", ".join(keys)})""" for t, keys in levels)

    def level(q: str) -> str:
        lang = f"(l.{q} * l.total + a.{q} * {prior}) // (l.total + {prior})"
        return f"((s.{q} * s.total + {lang} * {prior}) // (s.total + {prior}))::BIGINT AS {q}"

    limits = " UNION ALL ".join(f"SELECT '{m}' AS measure, {above} AS above, {'NULL' if below is None else below} AS below"
                                for m, (above, below) in quality_rules.MEASURES.items())
    return f"""
    WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    d AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{WORD}')] AS lines FROM t),
    w AS (SELECT r, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM d),
    g AS (SELECT r, i, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
    f AS (SELECT r, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, w1, w2, w3) > 1 AS twice FROM g),
    c AS (SELECT r, count(*) FILTER (hit) AS n_repeat_words
          FROM (SELECT r, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM f) GROUP BY r),
    b AS (SELECT d.r, doc_id, lang, source, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
                 len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                 len(lines) AS n_lines, len(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals,
                 len(regexp_replace(text, '[^!?]+', '', 'g')) AS n_marks,
                 len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed
          FROM d LEFT JOIN c USING (r)),
    m AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length,
                 CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbol_share,
                 CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_share,
                 CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_share,
                 CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capital_share,
                 CASE WHEN word_chars > 0 THEN n_marks * 1000 // word_chars ELSE 0 END AS mark_share FROM b),
    u AS (UNPIVOT (SELECT r, base_failed, coalesce(lang, chr(0)) AS lang, coalesce(source, chr(0)) AS source, {", ".join(f"{n}::BIGINT AS {n}" for n in names)} FROM m)
          ON {", ".join(names)} INTO NAME measure VALUE v),
    z AS (SELECT *, greatest(length(bin(v)) - {quality_rules.SKETCH_BITS}, 0) AS zeros FROM u),
    buckets AS (SELECT *, (v >> zeros) << zeros AS low, (((v >> zeros) + 1) << zeros) - 1 AS high FROM z WHERE NOT base_failed),
    {quartiles},
    bounds AS (SELECT s.lang, s.source, s.measure, {level("q1")}, {level("q2")}, {level("q3")}
               FROM qs s JOIN ql l USING (lang, measure) JOIN qa a USING (measure)),
    verdict AS (SELECT u.r, bool_and(u.v <= q2 + {width} * (q3 - q2) + above AND (below IS NULL OR u.v >= q2 - {width} * (q2 - q1) - below)) AS fine
                FROM u LEFT JOIN bounds USING (lang, source, measure) JOIN ({limits}) USING (measure) GROUP BY u.r)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           base_failed, NOT base_failed AND fine AS kept
    FROM m JOIN verdict USING (r)"""


OP3_SQL = f"""
    WITH r AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
                      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS key
               FROM documents),
    nodes AS (SELECT d, key >> (60 - d) AS prefix, sum(n_bytes) AS bytes, count(*) AS n
              FROM r, range(0, 25) depths(d) GROUP BY ALL),
    fit AS (SELECT doc_id, n_bytes, key, min(d) AS depth
            FROM r, range(0, 25) depths(d) JOIN nodes USING (d)
            WHERE prefix = key >> (60 - d) AND bytes <= {sharding.LIMIT_BYTES} GROUP BY ALL)
    SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
           depth::INTEGER AS depth, bytes::BIGINT AS shard_bytes, n AS shard_rows
    FROM fit JOIN nodes ON d = depth AND prefix = key >> (60 - depth)"""

OP5_SQL = f"""
    WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    w AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
    k AS (SELECT doc_id, i, word, CASE WHEN i + {substring.LENGTH - 1} <= n THEN
                 string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {substring.LENGTH - 1} FOLLOWING) END AS run FROM w),
    e AS (SELECT *, run IS NOT NULL AND row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1 AS again FROM k),
    c AS (SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {substring.LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone FROM e),
    s AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents LEFT JOIN s USING (doc_id)"""

OP12_SQL = f"""
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS q
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
                 list_inner_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % {hard_negatives.EVERY} = 0),
    p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS nth FROM s WHERE same),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score, nth,
                 row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY s.score DESC, s.vec_id) AS rank
          FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND s.score * 100 BETWEEN {hard_negatives.LOW} * p.score AND {hard_negatives.HIGH} * p.score
          WHERE nth <= {hard_negatives.POSITIVES})
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score, nth::INTEGER AS positive_rank
    FROM n WHERE rank <= {hard_negatives.NEGATIVES}"""

OP13_SQL = """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                      sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    d AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
                 ('0x' || h[25:32])::BIGINT AS h4 FROM t),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(prefix || middle || suffix) AS restored_sha256
    FROM p"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1, "op2_benchmark_templates": op2, "op3_extendible_shards": op3, "op4_token_store": op4,
    "op5_substring_repeats": op5, "op6_line_crf": op6, "op7_pfair_mix": op7, "op8_toxic_segments": op8,
    "op9_trie_token_counts": op9, "op10_simhash_groups": op10,
    "op11_output_codes": op11, "op12_hard_negatives": op12, "op13_fill_in_middle": op13,
}
ORACLE: dict[str, str] = {"op1_quality_rules": op1_sql(), "op3_extendible_shards": OP3_SQL, "op5_substring_repeats": OP5_SQL,
                          "op12_hard_negatives": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
