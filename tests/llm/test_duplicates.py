"""Near-duplicates, components, embeddings and decontamination against brute force."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import decontaminate, embedding_dedup, near_dedup
from sluice.llm.common import components


def classes(pairs, nodes):
    part = {n: n for n in nodes}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        part[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5000 + k) for k in range(1, 200)]
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    want = classes(pairs, {x for p in pairs for x in p})
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in found.collect()} == {n: c for n, c in want.items() if n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def multiset(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similar(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def near_truth(rows):
    sets = {d: multiset(t) for d, t in rows}
    where = {}
    for d, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(d)
    pairs = {(a, b) for some in where.values() if len(some) < 400 for a in some for b in some if a < b}
    return classes([p for p in pairs if similar(sets[p[0]], sets[p[1]]) >= 0.8], sets)


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = near_truth([tuple(r) for r in docs.collect()])
    found = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.op5_near_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert {d: c for d, (c, _) in found.items()} == want
    assert all(kept == (d == c) for d, (c, kept) in found.items())


def test_group_of_near_copies_and_edge_rows(spark):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(900)}" for _ in range(200)]
    rows = []
    for k in range(120):
        words = base.copy()
        words[rnd.randrange(200)] = f"new{k}"
        rows.append((k, " ".join(words)))
    rows += [(500 + k, "same text of five words or more") for k in range(50)] + [(900, None), (901, ""), (902, "  "), (903, "two words"), (904, "Two, words!"), (None, "lost id"), (905, "x" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash"))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()}
    assert all(found[k] == 0 for k in range(120)) and all(found[500 + k] == 500 for k in range(50))
    assert [found[k] for k in (900, 901, 902, 903, 904, 905, None)] == [900, 901, 902, 903, 903, 905, None]
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {0, 500, 900, 901, 902, 903, 905, None}
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def edited(rnd, base, edits):
    words = base.copy()
    for i in rnd.sample(range(len(base)), edits):
        words[i] = f"new{rnd.random()}"
    return " ".join(words)


def prefix_pairs_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    comps = spark.createDataFrame([(k, k) for k in range(len(texts))], "id long, comp long")
    found = near_dedup.prefix_pairs(comps, near_dedup.occurrences_of(near_dedup.multisets_of(rows)))
    return {(r["a"], r["b"]) for r in found.collect()}


def test_different_texts_under_one_id(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    near = b.replace("b59", "z")
    rows = [(1, a), (2, a), (2, b), (3, near)]
    for order in (rows, [rows[0], rows[2], rows[1], rows[3]], rows[::-1]):
        docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(order)], "doc_id long, text string, gone_id int").coalesce(1)
        found = near_dedup.near_duplicates(docs).collect()
        assert sorted(map(tuple, found)) == [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False)]
        kept = near_dedup.keep_one(docs)
        assert kept.columns == docs.columns and {(r["doc_id"], r["text"]) for r in kept.collect()} == {(1, a), (2, b)}
    blank = spark.createDataFrame([(1, "\t"), (2, "\t"), (3, "\u00a0"), (4, "\u00a0")], "doc_id long, text string")
    assert {tuple(r) for r in near_dedup.near_duplicates(blank).collect()} == {(k, k, True) for k in (1, 2, 3, 4)}


def test_prefix_filter_loses_no_pair_and_skips_a_common_core(spark):
    rnd = random.Random(5)
    bases = [[f"w{rnd.randrange(40)}" for _ in range(rnd.choice([6, 30, 60, 61]))] for _ in range(4)]
    texts = [edited(rnd, b, k) for b in bases for k in (0, 0, 1, 1, 1, 2, 3)] + ["a b c d e " * 10, "a b c d e " * 11, "one two"]
    sets = [multiset(t) for t in texts]
    similar_pairs = {(a, b) for b in range(len(texts)) for a in range(b) if similar(sets[a], sets[b]) >= 0.8}
    assert len(similar_pairs) > 20 and similar_pairs <= prefix_pairs_of(spark, texts)
    # A group just below the similarity, doubled: what is paired doesn't grow with the square.
    base = [f"w{k}" for k in range(60)]
    once, twice = (len(prefix_pairs_of(spark, [edited(rnd, base, 2) for _ in range(n)])) for n in (200, 400))
    assert once < 200 and twice < 400


def test_near_duplicates_with_clashing_columns(spark):
    text = "one text of at least five words"
    df = spark.createDataFrame([(1, text, 5, "x"), (2, text, 6, "y"), (3, "quite another text of some words", None, "z")], "doc_id long, text string, gone int, _dropped string")
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {1, 3}


def test_signatures_estimate_weighted_similarity():
    rnd = random.Random(1)
    base = [f"w{rnd.randrange(60)}" for _ in range(300)]
    texts = [" ".join(base)]
    for k in (2, 6, 15, 40):
        words = base.copy()
        for i in rnd.sample(range(300), k):
            words[i] = f"x{i}"
        texts.append(" ".join(words))
    texts += ["a b c d e " * 20, "a b c d e " * 25]
    owner, shingle, count = near_dedup.shingles(texts)
    sig = near_dedup.signatures(owner, shingle, count, len(texts), 4000)
    for a, b in [(0, 1), (0, 2), (0, 3), (0, 4), (5, 6)]:
        assert abs((sig[a] == sig[b]).mean() - similar(multiset(texts[a]), multiset(texts[b]))) < 0.04


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, vectors = [], rng.normal(size=(300, 16))
    for k in range(300):
        if k % 3 == 0:
            vectors[k] = vectors[k - k % 30] + rng.normal(size=16) * rng.uniform(0.02, 0.12)
    vectors[60:70] = vectors[50]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16), (405, [1.0, 2.0]), (406, [2.0, 4.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    link = unit @ unit.T >= 0.9
    want = classes([(a, b) for a, b in zip(*np.nonzero(link)) if a < b], range(300))
    found = {r["vec_id"]: r for r in embedding_dedup.link_embeddings(df).collect()}
    assert len(found) == len(rows)
    assert sum(found[k]["n_links"] != link[k].sum() - 1 for k in range(300)) == 0
    assert all(found[k]["component_id"] == want[k] and found[k]["kept"] == (want[k] == k) for k in range(300))
    assert all(found[k]["n_links"] == 0 and found[k]["component_id"] == k for k in (400, 401, 402, 403, 404))
    assert [found[k]["component_id"] for k in (405, 406, None)] == [405, 405, None]
    assert embedding_dedup.link_embeddings(df.limit(0)).count() == 0


def test_a_chain_within_one_shard_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARDS", 1)
    at = {1: 0, 3: 20, 4: 40, 2: 60, 9: 180}  # degrees: neighbours within 25.8 are linked
    rows = [(k, [float(np.cos(np.radians(a))), float(np.sin(np.radians(a)))]) for k, a in at.items()]
    found = {r["vec_id"]: r for r in embedding_dedup.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {k: r["n_links"] for k, r in found.items()} == {1: 1, 3: 2, 4: 2, 2: 1, 9: 0}
    assert {k: r["component_id"] for k, r in found.items()} == {1: 1, 3: 1, 4: 1, 2: 1, 9: 9}
    assert {k for k, r in found.items() if r["kept"]} == {1, 9}


def test_beams_widen_over_dense_groups():
    rng = np.random.default_rng(2)
    dense = rng.normal(size=32) + rng.normal(size=(400, 32)) * 0.05
    vectors = np.concatenate([dense, rng.normal(size=(200, 32))])
    graph = embedding_dedup.Graph(np.arange(600), np.ones(600, np.int64), vectors)
    q, x, _ = graph.hits(vectors, 16)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    assert len(q) >= 0.97 * (unit @ unit.T >= 0.9).sum()


def test_dense_groups_are_counted_in_bounded_memory():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=24)
    vectors = np.concatenate([centre + rng.normal(size=(2000, 24)) * 0.06, -centre + rng.normal(size=(300, 24)) * 0.3, rng.normal(size=(200, 24))])
    counts = rng.integers(1, 4, len(vectors))
    graph = embedding_dedup.Graph(np.arange(len(vectors)), counts, vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    linked, q, x = graph.answers(np.arange(1000, 2500), vectors[1000:], 32)
    want = link[1000:] @ counts
    assert np.minimum(linked, want).sum() >= 0.97 * want.sum() and (linked <= want).all()
    assert (linked[:1000] == want[:1000]).all()  # the dense group, exactly
    assert len(q) < 3 * 1500 and link[q + 1000, x].all()
    assert len(set(graph.part[:2000].tolist())) == 1


def test_audit_counts_queries_of_few_links_too():
    truth = {0: 10_000, **{k: 1 for k in range(1, 100)}}
    assert embedding_dedup.passes(truth, truth) and embedding_dedup.passes({}, {})
    assert not embedding_dedup.passes({0: 10_000}, truth)


BENCH = [(1, "A train covers 120 km in 3 hours near Lyon and then stops; how far does the train run in 7 hours at that speed?"), (2, "short one here"), (3, None)]


def test_decontamination_cases(spark):
    item = BENCH[0][1]
    cases = {
        1: ("Some prose before. " + item + " Some prose after.", True),
        2: ("Intro text. " + item.replace("120", "450").replace("3 hours", "9 hours").replace("7 hours", "11 hours").replace("Lyon", "Madrid") + " Done.", True),
        3: ("Clean prose that never holds any of the questions of the benchmark at all.", False),
        4: ("A train covers 120 km in 3 hours near Lyon.", False),
        5: (item.upper(), True), 6: (None, False), 7: ("", False), 8: ("short one here", False), 9: ("x " * 40_000 + item, True),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()] + [(1, cases[1][0])], "doc_id long, text string").withColumn("item_id", F.lit(5))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontaminate.report(docs, bench).collect()
    assert len(found) == len(cases) + 1
    assert {r["doc_id"]: r["contaminated"] for r in found} == {k: want for k, (_, want) in cases.items()}
    assert all(r["item_ids"] == ([1] if r["contaminated"] else []) for r in found)
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {k for k, (_, want) in cases.items() if not want}
    assert decontaminate.report(docs, bench.limit(0)).where("contaminated").count() == 0 and decontaminate.report(docs.limit(0), bench).count() == 0


def test_slots_must_map_one_to_one(spark):
    item = "Ann has 5 red apples in a big box and Ann eats 2 green pears while 5 more red apples fall down there"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    good, bad = item.replace("5", "8").replace("2", "3"), item.replace("5 red", "8 red", 1).replace("2", "3")
    docs = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    assert {r["doc_id"]: r["contaminated"] for r in decontaminate.report(docs, bench).collect()} == {1: True, 2: False}


def found_in(spark, item, texts):
    docs, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: r["contaminated"] for r in decontaminate.report(docs, bench).collect()}
    return [found[k] for k in range(len(texts))]


def test_items_dense_in_slots_are_found(spark):
    item = "Convert 5 km 300 m to cm"
    texts = ["Before. " + item + " and more.", "Before. Convert 8 miles 20 yards to feet now.", "Convert 8 km 8 m to cm", "Run 5 km 300 m in rain", "5 km 300 m 7 cm 2"]
    assert found_in(spark, item, texts) == [True, True, False, False, False]
    numbers = "3 14 15 92 65 35 89"
    assert found_in(spark, numbers, ["x " + numbers + " y", "2 71 82 81 84 59 45"]) == [True, False]


def test_names_at_sentence_starts_and_changed_case(spark):
    item = "Tom has 5 red apples today. Tom eats 2 of them at once. Tom then gives 1 to his friend. Tom keeps what is left."
    renamed = item.replace("Tom", "Ann").replace("5", "9").replace("2", "4").replace("1", "3")
    other = renamed.replace("Ann eats", "Bob eats").replace("Ann keeps", "Eve keeps")
    assert found_in(spark, item, [item, renamed, "Words. " + renamed + " Words.", renamed.replace(".", ""), other]) == [True, True, True, True, False]
    names = "Who met Ann near Rome with Bob near Oslo with Eve near Bonn?"
    assert found_in(spark, names, [names.lower(), names.upper(), "who left ann near rome for good"]) == [True, True, False]
    assert found_in(spark, "What is the capital of France?", ["Paris is the capital of France."]) == [False]


def test_rows_are_told_apart_by_id_and_text(spark):
    item = "Which river runs through the old town, past the mill and under the two stone bridges to the sea?"
    words = item.split()
    rows = [(None, "Clean prose, nothing of the benchmark in it."), (None, "Before. " + item), (7, " ".join(words[:10])), (7, " ".join(words[10:])), (8, item), (8, "Clean text of the same id."), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found_part", F.lit("x"))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(str, left.select("doc_id", "text").collect())) == sorted(str(r) for r in docs.select("doc_id", "text").collect() if item not in (r["text"] or ""))
    assert {(r["doc_id"], r["contaminated"]) for r in decontaminate.report(docs, bench).collect()} == {(None, False), (None, True), (7, False), (8, True), (8, False), (9, False)}


def test_items_of_four_words_must_stand_whole(spark):
    assert found_in(spark, "What is two plus", ["He asked: what is two plus, and left", "What is two", "what isn't two plus", "what. is two plus", "what is twoplus four", "WHAT IS TWO PLUS"]) == [True, False, False, True, False, True]
    assert found_in(spark, "Name the largest planet!", ["Please name the largest planet", "Name the largest red planet"]) == [True, False]
    docs, bench = spark.createDataFrame([(1, "so short one here it is"), (2, "short one")], "doc_id long, text string"), spark.createDataFrame([(1, "short one here")], "item_id long, text string")
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert [r["doc_id"] for r in decontaminate.contaminated(docs, bench, least_words=3).collect()] == [1]


def test_large_benchmarks_are_joined_by_shuffle(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    small = sorted(map(str, decontaminate.report(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 10)
    assert sorted(map(str, decontaminate.report(docs, bench).collect())) == small
    # Only what the map lets through leaves its task.
    ours = decontaminate.windows(bench, "item_id", items=True)
    wanted = spark.sparkContext.broadcast(decontaminate._wanted_of(ours, False))
    here = {r["hash"] for r in ours.select("hash").collect()}
    moved = [r["hash"] for r in decontaminate.windows(docs, "doc_id", wanted).select("hash").collect()]
    told = sum(h in here for h in moved)
    assert 0 < told <= len(moved) <= told + 200


def test_decontamination_equals_brute_force(spark):
    def plain(t):
        return " ".join(re.findall(r"\w+", t.lower()))

    sf = "/root/testdata/sf0.01"
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if any(i in plain(r["text"]) for i in items)}
    assert {r["doc_id"] for r in decontaminate.op9_decontamination(spark, sf).where("contaminated").collect()} == want
