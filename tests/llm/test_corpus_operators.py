"""Corpus operators against brute force, SQL or exact round trips, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fleetgauge.llm import (decontaminate, line_crf, mixing, quality_rules, queries, rans, sharding, simhash, substring,
                            token_counts, token_store, toxicity)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, FP string, shard string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, tiny and very long texts, repeated rows and ids, names that operators use themselves."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choices(words, k=20_000))
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 120))), "en", f"s{i % 3}", 1, "x", "y", "z") for i in range(60)]
    rows += [(60, None, None, None, None, None, None, None), (61, "", "en", "s0", 0, "", "", ""), (62, long, "en", None, 1, "a", "b", "c"),
             (None, "no id here at all", None, "s1", 1, "", "", ""), (None, None, None, None, None, None, None, None)]
    rows += [rows[3], rows[3], (5, "another text under the same id", "en", "s2", 1, "", "", "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def row_wise(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (41, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, "")], "item_id long, text string")
    learn = queries.fold(3) != 1
    yield quality_rules.quality_rules(docs)
    yield sharding.assign_shards(docs, 2000)
    yield mixing.mix(docs, block_bytes=500)
    yield substring.without_repeats(docs)
    yield line_crf.score(docs, line_crf.fit(docs, labels, learn, epochs=5))
    yield toxicity.score(docs, toxicity.fit(docs, labels, learn))
    yield token_counts.count_tokens(docs, queries.tokenizer_file("piece_bpe_32k.model"))
    yield simhash.near_duplicates(docs)
    path = token_store.new_store(spark)
    token_store.write(docs, path, queries.tokenizer_file("word_bpe_49k.json"), block_tokens=2000)
    yield token_store.read(spark, path)
    assert decontaminate.contaminated(docs, bench).count() == 0
    for stay in (mixing.mixed(docs), sharding.sharded(docs), decontaminate.without_contaminated(docs, bench)):
        assert stay.count() == docs.count()
        assert stay.columns[: len(docs.columns)] == docs.columns


def test_odd_rows_each_get_a_result(spark, odd):
    for got in row_wise(spark, odd):
        assert got.count() == odd.count()


def test_empty_tables(spark, empty):
    for got in row_wise(spark, empty):
        assert got.count() == 0
    assert simhash.one_of_each_group(empty).columns == empty.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_sketches_merge_and_hold_their_error(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS g", *[f"id * id AS {m}" for m in quality_rules.MEASURES])
    parts = quality_rules.merged(quality_rules.sketch(rows, ["g"]), [])
    whole = quality_rules.sketch(rows, [])
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    q2 = quality_rules.quartiles(whole, []).where("measure = 'word_length'").first().q2
    assert 2499**2 <= q2 <= 2499**2 * (1 + 1 / 32)


def test_bounds_follow_their_source_and_blend_by_rows(spark):
    def value(source, rows, at):
        return [("en", source, *([at + i % 5] * len(quality_rules.MEASURES))) for i in range(rows)]

    names = ", ".join(f"{m} long" for m in quality_rules.MEASURES)
    prose, code, tiny = value("prose", 1000, 10), value("code", 1000, 300), value("tiny", 5, 300)

    def limits(rows):
        df = spark.createDataFrame(rows, f"lang string, source string, {names}")
        return {r.source: r for r in quality_rules.bounds(quality_rules.sketch(df, ["lang", "source"])).collect()}

    got = limits(prose + code + tiny)
    above = {s: r.symbol_share_max - quality_rules.MEASURES["symbol_share"][0] for s, r in got.items()}
    assert above["code"] > 300 > above["prose"] + 200
    # Bounds move with rows, without a step: each added document counts.
    steps = [limits(8 * prose + value("few", n, 300))["few"].symbol_share_max for n in (1, 50, 100, 200, 400, 1000)]
    assert steps == sorted(steps) and len(set(steps)) == len(steps)
    assert max(b - a for a, b in zip(steps, steps[1:], strict=False)) < 150


def test_documents_that_fail_the_base_rules_set_no_bounds(spark):
    good = [(i, " ".join(f"word{(i * 7 + j) % 997}" for j in range(60)), "en", "s") for i in range(50)]
    junk = [(100 + i, "# $ % " * 40, "en", "s") for i in range(50)] + [(200, "# $", "fr", "only"), (201, None, None, None)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert len(rows) == len(good) + len(junk)
    assert all(rows[d[0]].kept for d in good) and not any(rows[d[0]].kept for d in junk)
    assert all(rows[d[0]].base_failed for d in junk)
    probe = spark.createDataFrame(good + junk + [(300, " ".join(f"w{j} #" for j in range(60)), "en", "s")], docs.schema)
    assert "symbol_share" in quality_rules.quality_rules(probe).where("doc_id = 300").first().failed


def test_shards_fit_and_split_only_when_needed(spark, odd):
    limit = 1500
    rows = sharding.assign_shards(odd, limit).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for name, own in shards.items():
        assert sum(r.n_bytes for r in own) == own[0].shard_bytes and len(own) == own[0].shard_rows
        assert own[0].shard_bytes <= limit or len(own) == 1
        if "#" not in name:  # the bucket it was split from was too large, heavy keys aside
            parent = [r for n, o in shards.items() if "#" not in n and n.startswith(name[:-1]) for r in o]
            assert not name or sum(r.n_bytes for r in parent) > limit


def test_rows_of_one_id_get_their_own_shards(spark):
    docs = spark.createDataFrame([(1, c * 900) for c in "abc"] + [(1, "d" * 900)] * 3 + [(2, "e" * 5000), (3, None)], "doc_id long, text string")
    got = sharding.sharded(docs.repartition(3), 1000).collect()
    sizes = {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + len(r.text or "")
    assert len(got) == 8 and sorted(sizes.values())[-1] == 5000 and sorted(sizes.values())[-2] <= 1000


def test_shards_keep_the_mixed_order(spark, odd, tmp_path):
    docs = odd.withColumn("text", F.substring("text", 1, 400)).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    mixing.mixed(docs, block_bytes=300).write.parquet(str(tmp_path / "mixed"))
    placed, order = mixing.with_row_order(spark.read.parquet(str(tmp_path / "mixed")))
    place = {r.doc_id: tuple(r[c] for c in order) for r in placed.collect()}
    sharding.sharded(placed, 2000, order).drop(*order).write.parquet(str(tmp_path / "shards"))
    written = spark.read.parquet(str(tmp_path / "shards")).select("doc_id", "shard_", "_metadata.file_name", "_metadata.row_index").collect()
    shards = {}
    for r in sorted(written, key=lambda r: (r.file_name, r.row_index)):
        shards.setdefault(r["shard_"], []).append(r)
    assert len(shards) > 5 and sum(map(len, shards.values())) == len(place)
    for own in shards.values():
        assert len({r.file_name for r in own}) == 1 and own[-1].row_index - own[0].row_index == len(own) - 1
        assert [place[r.doc_id] for r in own] == sorted(place[r.doc_id] for r in own)


def test_equal_rows_beyond_the_limit_go_to_pages(spark):
    rows = sharding.assign_shards(spark.createDataFrame([(1, "x" * 40)] * 50, "doc_id long, text string").repartition(5), 100).collect()
    assert len(rows) == 50 and len({r.shard for r in rows}) == 25 and all(r.shard_bytes == 80 for r in rows)


@pytest.mark.parametrize("seed", range(12))
def test_pfair_lag_over_the_whole_run(seed):
    """Against the ideal mix in fractions, slot by slot, over thousands of slots and while sources run out."""
    rng = random.Random(seed)
    count = rng.choice([1, 2, 3, 8, 30])
    names = [f"s{i:02d}" for i in range(count)]
    weights = {s: rng.choice([1.0, 0.5, 1 / 3, 1e-3, rng.random() + 1e-6, 7.25]) for s in names}
    blocks = {s: rng.randint(1, rng.choice([3, 40, 900])) for s in names}
    plan = mixing.schedule(blocks, weights)
    assert sorted(plan["slot"]) == list(range(sum(blocks.values())))
    assert ((plan["release"] <= plan["slot"]) & (plan["slot"] < plan["deadline"])).all()
    whole = dict(zip(names, map(int, mixing.whole_weights([weights[s] for s in names])), strict=True))
    ideal, had = dict.fromkeys(names, Fraction(0)), dict.fromkeys(names, 0)
    for r in plan.sort_values("slot").itertuples():
        had[r[1]] += 1
        left = Fraction(1)
        while left:
            rate = sum(whole[s] for s in names if ideal[s] < blocks[s])
            step = min([left, *((blocks[s] - ideal[s]) * rate / whole[s] for s in names if ideal[s] < blocks[s])])
            ideal = {s: ideal[s] + (step * whole[s] / rate if ideal[s] < blocks[s] else 0) for s in names}
            left -= step
        assert all(abs(had[s] - ideal[s]) < 1 for s in names)


def test_weights_hold_over_many_thousand_slots():
    weights = dict(zip("abcdefgh", [0.31, 0.23, 0.17, 0.11, 0.07, 0.05, 0.035, 0.025], strict=True))
    plan = mixing.schedule({s: int(w * 200_000) for s, w in weights.items()}, weights)
    for s, w in weights.items():
        own = np.sort(plan.loc[plan["class"] == s, "slot"].to_numpy())
        had = np.searchsorted(own, np.arange(1, len(plan) + 1))
        assert np.abs(had - w * np.arange(1, len(plan) + 1)).max() < 1.001


def test_mix_places_every_block_once(spark, odd):
    got = mixing.mix(odd, block_bytes=300).collect()
    owner = {}
    for r in got:
        assert r.release <= r.slot < r.deadline
        assert owner.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    few = mixing.mix(odd, block_bytes=1, max_slots=50).collect()
    assert len(few) == len(got) and max(r.slot for r in few) < 50
    weighted = mixing.mix(odd, weights={"s0": 0.6, "s1": 0.3, "s2": 0.1, "absent": 0.9, None: 0.2}, block_bytes=300)
    assert weighted.count() == odd.count()


def test_weights_of_pooled_sources_add_up(spark):
    docs = spark.createDataFrame([(i, "x" * 10, f"s{i % 5}") for i in range(500)], "doc_id long, text string, source string")
    got = mixing.mix(docs, {"s0": 0.5, "s1": 0.2, "s2": 0.1, "s3": 0.1, "s4": 0.1}, block_bytes=10, max_sources=2).where("slot < 50").collect()
    seen = {s: sum(r.source == s for r in got) for s in ("s0", "s1")}
    assert abs(seen["s0"] - 25) <= 1 and abs(seen["s1"] - 10) <= 1 and len(got) == 50


def test_repeated_ids_are_spread(spark):
    docs = spark.createDataFrame([(1, "x" * 10, "s")] * 2000 + [(None, "y", None)] * 500, "doc_id long, text string, source string")
    got = mixing.mix(docs.repartition(4), block_bytes=100).collect()
    assert len(got) == 2500 and len({(r.source, r.place) for r in got}) == 2500


def repeats(rows, length):
    seen, words = {}, [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for s in range(len(w) - length + 1):
            at, key = (-1 if d is None else d, s), tuple(w[s : s + length])
            seen[key] = min(seen.get(key, at), at)
    for d, w in words:
        gone = set()
        for s in range(len(w) - length + 1):
            if seen[tuple(w[s : s + length])] != (-1 if d is None else d, s):
                gone.update(range(s, s + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield (d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)


def test_repeats_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    shared = [" ".join(rng.choices(words, k=rng.randint(15, 60))) for _ in range(6)]
    rows = [(i, "\n ".join(rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices([*words, "é"], k=rng.randint(1, 40)))
                           for _ in range(rng.randint(0, 4)))) for i in range(120)]
    rows += [(3, rows[3][1]), (7, rows[9][1]), (None, rows[5][1]), (200, None), (202, "x " * 300), (203, rows[0][1])]
    got = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, repeats(rows, 20)))


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = {}
    for r in simhash.near_duplicates(odd, shard_rows=16).collect():
        got.setdefault(r.fingerprint, set()).add(r.component_id)
    fps = {plain_fingerprint(t) for _, t in rows}
    assert {f"{f:016x}" for f in fps} == set(got)
    assert got[f"{0:016x}"] == {60}


def test_links_find_every_pair_in_a_dense_cluster(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    points = [seeds, *(seeds ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) for _ in range(3))]
    points += [seeds[:1] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)) ^ (np.uint64(1) << np.uint64(b)) for b in range(6)]
    fps = np.unique(np.concatenate(points))
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    while not np.array_equal(label, new := np.array([label[row].min() for row in near])):
        label = new
    df = spark.createDataFrame(list(enumerate(fps.view(np.int64).tolist())), "doc_id long, fp long").repartition(4)
    got = {r.fp: r.component_id for r in simhash.groups(df, 2, 64).collect()}
    assert got == dict(zip(fps.view(np.int64).tolist(), label.tolist(), strict=True))


@pytest.mark.parametrize("bits", [2, 4])
def test_a_ball_is_joined_by_shared_neighbours(spark, bits):
    """Fingerprints around one point: no shard of the tree may hold them all, and groups are those of all pairs."""
    rng = np.random.default_rng(8)
    centre, one = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)
    flips = [one << np.array(rng.choice(64, rng.integers(1, 4), replace=False), np.uint64) for _ in range(700)]
    ball = np.array([centre ^ np.bitwise_or.reduce(f) for f in flips], np.uint64)
    fps = np.unique(np.concatenate([ball, rng.integers(0, 1 << 63, 200, dtype=np.uint64)]))
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    pairs = {(int(a), int(b)) for a, b in np.argwhere(near) if a > b}
    while not np.array_equal(label, new := np.array([label[row].min() for row in near])):
        label = new
    number = {f: i for i, f in enumerate(fps.view(np.int64).tolist())}
    df = spark.createDataFrame([(i, f) for f, i in number.items()], "doc_id long, fp long").repartition(4)
    close = {tuple(sorted((number[r.a], number[r.b]), reverse=True)) for r in simhash.neighbour_links(df, bits).collect()}
    assert close and close <= pairs
    got = {r.fp: r.component_id for r in simhash.groups(df, bits, 16).collect()}
    assert got == {f: int(label[i]) for f, i in number.items()}


TRAIN = "A train leaves Boston at 10 and travels 300 km in 5 hours while another train leaves Denver at 10 with Alice on board."


def held(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").repartition(2)
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench, **options).collect()}


@pytest.mark.parametrize("max_keys", [0, 1 << 20])
def test_templates_and_slots(spark, max_keys):
    texts = [f"Before. {TRAIN} After.", TRAIN.replace("Boston", "Paris").replace("10", "11").replace("300", "4,500").replace("Alice", "Eve"),
             TRAIN.replace("Boston at 10", "Boston at 12"), None, "", "nothing like that"]
    found = held(spark, texts, [TRAIN, None, "", TRAIN], max_keys=max_keys)
    assert set(found) == {(0, 0), (1, 0), (0, 3), (1, 3)}
    assert [(found[k].kind, found[k].changed > 0, found[k].covered) for k in ((0, 0), (1, 0))] == [
        ("verbatim", False, found[0, 0].item_tokens), ("reparameterised", True, found[0, 0].item_tokens)]
    assert found[0, 0].first_token == 1


def test_numbers_and_short_items_are_found_word_by_word(spark):
    items = ["Compute 12 + 30 + 45 + 18 + 7 + 99 + 3 + 4 + 5 + 6", "Define entropy", "12 13"]
    texts = [f"x {items[0]} y", "Compute 13 + 30 + 45 + 18 + 7 + 99 + 3 + 4 + 5 + 6", "please define entropy now", "define the entropy", "at 12 13 and", "at 12 14 and"]
    found = held(spark, texts, items)
    assert set(found) == {(0, 0), (2, 1), (4, 2)} and all(r.kind == "verbatim" for r in found.values())


def plain_tokens(text):
    tokens = decontaminate.canonical(pa.array([text]))
    return [("w", v) if k == decontaminate.WORD else (int(k), v) for k, v in zip(tokens.kind, tokens.value.tolist(), strict=True)]


def test_contamination_against_brute_force(spark):
    """All windows of all pairs, over texts of few words, so that many windows meet and many slot checks fail."""
    rng = random.Random(4)
    vocabulary = [*"alpha beta gamma delta epsilon zeta".split(), "7", "12", "km", "Bob", "Ann"]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 18))) for _ in range(25)]
    texts = [" ".join(rng.choices([*vocabulary, rng.choice(items), rng.choice(items).replace("7", "9").replace("Bob", "Eve")], k=rng.randint(1, 9))) for _ in range(50)]

    def key(run, size):
        slots = [t for t in run if t[0] != "w"]
        exact = 2 * (size - len(slots)) <= size or size < decontaminate.LEAST
        return (exact, tuple(t[1] for t in run) if exact else tuple(t if t[0] == "w" else t[0] for t in run))

    want = set()
    for d, doc in enumerate(map(plain_tokens, texts)):
        for i, item in enumerate(map(plain_tokens, items)):
            size, offsets = min(len(item), decontaminate.WINDOW), {}
            for p in range(len(doc) - size + 1):
                for q in range(len(item) - size + 1):
                    if key(doc[p : p + size], size) == key(item[q : q + size], size):
                        offsets.setdefault(p - q, set()).update(range(q, q + size))
            covered = set()
            for offset, places in offsets.items():
                pairs = {(item[k][1], doc[offset + k][1]) for k in places if item[k][0] != "w"}
                if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                    covered |= places
            if covered and len(covered) >= 0.5 * len(item):
                want.add((d, i))
    assert set(held(spark, texts, items)) == want and len(want) > 30


def test_documents_without_contamination(spark):
    docs = spark.createDataFrame([(1, TRAIN, "a"), (1, "clean", "b"), (None, f"x {TRAIN}", "c"), (None, None, "d"), (2, "", "e"), (3, "clean", "f"), (3, "clean", "f")],
                                 "doc_id long, text string, digest string")
    bench = spark.createDataFrame([(1, TRAIN)], "item_id long, text string")
    assert sorted(r.digest for r in decontaminate.without_contaminated(docs, bench).collect()) == ["b", "d", "e", "f", "f"]


def test_rans_round_trip_checkpoints_and_damage():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 5000, 1_100_000):
        symbols = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint16)
        coded = rans.Table.of(np.bincount(symbols, minlength=50_000))
        block = rans.encode(symbols, coded)
        assert np.array_equal(rans.decode(block, coded), symbols)
    step = rans.EVERY * rans.LANES
    assert np.array_equal(rans.decode(block, coded, 1, 2), symbols[step : 2 * step])
    with pytest.raises(ValueError):
        rans.decode(block[:500] + bytes([block[500] ^ 1]) + block[501:], coded)


def test_token_store_holds_the_library_ids(spark, odd):
    from tokenizers import Tokenizer

    file = queries.tokenizer_file("word_bpe_49k.json")
    tokenizer, path = Tokenizer.from_file(file), token_store.new_store(spark)
    extra = spark.createDataFrame([(900, "It's DON'T 3.5 <|endoftext|> ÀÉß日本 İ ﬁ ½ µ a\x1cb '''s")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(extra)
    token_store.write(docs, path, file, block_tokens=3000)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in docs.collect()))
    got, at = token_store.read(spark, path).orderBy("start").collect(), 0
    for (_, doc_id, _, text), r in zip(rows, got, strict=True):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert (r.doc_id or 0, r.start, r.ids) == (doc_id, at, ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_trie_counts_against_each_word_alone():
    vocab = token_counts.vocabulary(queries.tokenizer_file("piece_bpe_32k.model"))

    def alone(word):
        best = [(0.0, 0)]
        for d in range(1, len(word) + 1):
            ways = [(best[j][0] + vocab.scores[word[j:d]], best[j][1] - 1) for j in range(d) if word[j:d] in vocab.scores]
            if word[d - 1] not in vocab.scores:
                n = len(word[d - 1].encode())
                ways.append((best[d - 1][0] + n * vocab.unknown, best[d - 1][1] - n))
            best.append(max(ways))
        return -best[-1][1]

    words = sorted({"▁" + w for w in "the then theory theoretical 日本語 naïve x xx xxxxxxxxxxxxxxxx internationalisation \U0001f600ok".split()})
    assert vocab.counts(words) == [alone(w) for w in words]


def test_segments_against_all_intervals():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 40)
        place = sorted(rng.sample(range(n), rng.randint(1, min(n, 8))))
        gain = [rng.choice([0.3, 1.0, 2.5]) for _ in place]
        score = np.full(n, -0.25)
        score[place] = gain
        sums = np.concatenate([[0], np.cumsum(score)])
        best = max(sums[j] - sums[i] for i in range(n) for j in range(i + 1, n + 1))
        found = toxicity.maximal_segments(np.array(place), np.array(gain), 0.25)
        assert max(s for s, _, _ in found) == pytest.approx(best)
        assert all(a[2] < b[1] for a, b in zip(found, found[1:], strict=False))
        assert all(s == pytest.approx(sums[b + 1] - sums[a]) for s, a, b in found)


def test_crf_sums_against_all_labellings():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 4, 8])
    unary, pair = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    forward, backward, total = line_crf.Chains(first).sums(unary, pair)
    for d in range(3):
        a, n = first[d], first[d + 1] - first[d]
        paths = {}
        for code in range(1 << n):
            y = [code >> t & 1 for t in range(n)]
            paths[tuple(y)] = np.exp(sum(unary[a + t, y[t]] for t in range(n)) + sum(pair[y[t], y[t + 1]] for t in range(n - 1)))
        assert np.exp(total[d]) == pytest.approx(sum(paths.values()))
        for t in range(n):
            good = sum(v for y, v in paths.items() if y[t]) / sum(paths.values())
            assert np.exp(forward[a + t, 1] + backward[a + t, 1] - total[d]) == pytest.approx(good)


def mixed_lines(rng, kinds):
    """Lines of plain words (True) or of junk (False)."""
    def line(good):
        n = rng.randint(5, 12)
        return " ".join(rng.choices(["the", "river", "was", "calm", "and", "boats", "came", "home"], k=n)) + "." if good else " ".join(
            rng.choices(["$$##", "9%41", "|||", "ZZ=Q", "&&", "{}_~"], k=n))
    return "\n".join(line(k) for k in kinds)


def test_lines_of_half_junk_documents_come_out_right(spark):
    """Fitted on labels of documents that hold lines of both kinds, in unlike shares."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(240):
        bad = i % 2
        kinds = [True] * (4 if bad else 10) + [False] * (8 if bad else 2)
        if i % 3 == 0:
            rng.shuffle(kinds)
        elif i % 3 == 1:
            kinds.reverse()
        rows.append((i, mixed_lines(rng, kinds)))
        labels.append((i, 1 - bad))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = line_crf.fit(docs, marks, F.lit(True))
    plans = [[True] * 6 + [False] * 6, [False] * 6 + [True] * 6, [True] * 3 + [False] * 6 + [True] * 3]
    half = spark.createDataFrame([(i, mixed_lines(rng, k)) for i, k in enumerate(plans)], "doc_id long, text string")
    got = {(r.doc_id, r.line): r.good for r in line_crf.lines(half, model).collect()}
    right = [(got[d, t] >= 0.5) == k for d, plan in enumerate(plans) for t, k in enumerate(plan)]
    assert np.mean(right) >= 0.9
    assert max(got.values()) - min(got.values()) > 0.9
    scored = line_crf.score(docs, model).join(marks, "doc_id")
    assert scored.selectExpr("avg(cast(predicted = quality AS double))").first()[0] >= 0.95


def test_fit_looks_at_a_bounded_number_of_lines(spark):
    rows = [(i, "a\n" * (9 if i else 50)) for i in range(30)]
    chosen = spark.createDataFrame(rows * 2, "doc_id long, text string").withColumn("label", (F.col("doc_id") % 2).cast("int"))
    kept = line_crf.within_lines(chosen, 100).collect()
    assert len(kept) == 20 and len({r.doc_id for r in kept}) == 20 and 0 not in {r.doc_id for r in kept}


@pytest.mark.parametrize(("name", "label", "least"), [("op6_line_crf", "quality", 0.95), ("op8_toxic_segments", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert got.selectExpr(f"avg(cast(predicted = {label} AS double))").first()[0] >= least


def test_ids_may_be_texts(spark):
    """One model gives the same lines and passages whatever type the ids have, and can be fitted under either."""
    sf = "/root/testdata/sf0.01"
    whole = {kind: [spark.read.parquet(f"{sf}/{t}.parquet").withColumn("doc_id", F.col("doc_id").cast(kind)) for t in ("documents", "labels")]
             for kind in ("string", "long")}
    for docs, labels in whole.values():
        quality, toxic = line_crf.fit(docs, labels, F.lit(True), epochs=3), toxicity.fit(docs, labels, F.lit(True))
    found = []
    for docs, _ in whole.values():
        lines, passages = line_crf.lines(docs, quality), toxicity.passages(docs, toxic)
        assert lines.schema["doc_id"].dataType == passages.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        found.append([sorted((str(r[0]), *r[1:]) for r in df.collect()) for df in (lines, passages)])
    assert found[0] == found[1] and all(found[0])


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.good_documents(spark, docs, SF)
    scores = line_crf.score(docs, queries.quality_model(spark, SF)).where("score >= 0.5")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.collect()}
    heads = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert {r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, SF).collect()} == heads
    texts = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in docs.collect() if any(t in r.text for t in texts)}
    clean = {r.doc_id for r in corpus_pipeline.unseen_documents(spark, docs, SF).collect()}
    assert leaks and not leaks & clean and len(clean) >= docs.count() - len(leaks) - 1
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "shard"]
    assert {r.doc_id for r in out.collect()} <= clean & heads
