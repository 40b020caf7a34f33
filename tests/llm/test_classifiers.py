"""Toxicity, quality, licence and page operators."""

import html
import math
import random
import time
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import html_extract, license_scan, quality, toxicity

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def toy(n=400):
    rows = []
    for k in range(n):
        bad = k % 4 == 0
        text = " ".join(f"word{(k * 7 + j) % 90}" for j in range(12)) + (" vile" if bad else "") + " the of and"
        rows.append((k, text, int(bad)))
    return rows


def test_cnn_learns_a_word():
    model = toxicity.fit(toy())
    scorer = toxicity.Scorer(model)
    scores = scorer.scores([t for _, t, _ in toy()])
    assert [int(s >= 0.5) for s in scores] == [y for _, _, y in toy()]
    # A word far inside a very long text still counts, and empty texts have a score.
    long = "word1 the " * 50_000
    assert scorer.scores([long + "vile " + long])[0] > 0.5 > scorer.scores([long])[0]
    assert len(scorer.scores([None, "", "..."])) == 3


def test_a_score_is_of_its_own_text_alone():
    model = toxicity.Cnn.fresh()
    texts = ["calm words of the day", "vile vile things", "", "x", "more calm words"]
    alone = [toxicity.Scorer(model).scores([t])[0] for t in texts]
    for k in range(len(texts)):
        turned = texts[k:] + texts[:k]
        assert list(toxicity.Scorer(model).scores(turned)) == pytest.approx(alone[k:] + alone[:k], abs=1e-6)
    # The same in training: the pools of a batch are those of its texts alone.
    seen = toxicity.np.random.default_rng(1).normal(size=(10, model.filters.shape[1])).astype("float32")
    seen[[2, 3, 4, 7, 8, 9]] = 0
    both, one = model.pool(seen, toxicity.np.array([0, 5]))[1][0], model.pool(seen[:5], toxicity.np.array([0]))[1][0]
    assert list(both) == pytest.approx(list(one), abs=1e-6)


def test_cnn_with_one_label_or_none():
    assert toxicity.Scorer(toxicity.fit([])).scores(["x"])[0] < 0.5
    assert toxicity.Scorer(toxicity.fit([(k, "a", 1) for k in range(20)])).scores(["x"])[0] > 0.5


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op2_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [r["predicted"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(clean) <= 0.02 * len(clean)


def test_quality_query(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r["doc_id"]: r["keep"] for r in quality.op4_quality(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    right = [kept[d] == bool(y) for d, y in labels.items()]
    assert sum(right) >= 0.95 * len(right)


def test_sparse_sites_are_shrunk(spark):
    docs = spark.createDataFrame([(k, "fine words here", "en", "good") for k in range(60)] + [(k, "fine words here", "en", "bad") for k in range(60, 120)] + [(999, "fine words here", "en", "new")], "doc_id long, text string, lang string, source string")
    # Evidence that depends on the text alone can't part them; give bad sites worse texts.
    docs = docs.withColumn("text", F.when(F.col("source") == "bad", F.lit("### %%% $$$")).otherwise(F.col("text")))
    model = quality.fit([([float(x) for x in r["x"]], r["y"]) for r in docs.select(F.array(*quality.text_statistics(F.col("text"))).alias("x"), (F.col("source") != "bad").cast("int").alias("y")).collect()])
    means, overall = quality.site_posteriors(docs, model)
    found = {r["path"]: r["path_mean"] for r in means.collect()}
    assert found["bad/en"] < overall < found["good/en"]
    assert abs(found["new/en"] - overall) < abs(found["good/en"] - overall) + 1e-9


def test_filters_keep_columns_and_edge_rows(spark):
    df = spark.createDataFrame([(1, None, None, None, 1), (2, "", "en", "s", 2), (None, "a", "en", "s", 3)], "doc_id long, text string, lang string, source string, path_key int")
    model = quality.fit([])
    assert quality.keep_good(df, model).columns == df.columns
    assert quality.score_quality(df, model).count() == 3 and quality.score_quality(df.limit(0), model).count() == 0
    tox = toxicity.fit([])
    assert sorted(r["path_key"] for r in toxicity.drop_toxic(df, tox).collect()) == [1, 2, 3]
    assert toxicity.score_toxicity(df.limit(0), tox).count() == 0


def plain_scan(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_licences_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = ["CC-BY cc by CC by", "General\npublic LICENSE general public license", "éall rights reserved all rights reserved", "", None, "by cc", "ALL RIGHTS reserved."]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    hits = 0
    for r in license_scan.scan_licenses(frame).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_scan(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        hits += r["n_base"] > 0
    assert hits
    assert license_scan.scan_licenses(frame.limit(0)).count() == 0


def test_licence_templates(spark):
    lines = {"Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc", "GNU General Public License, version 3.": "gpl,gpl-3.0", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
             "Released under the MIT License.": "mit", "mit license plate": "", "nothing mit here": ""}
    df = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(df).collect()} == dict(enumerate(lines.values()))


def test_pages_equal_their_articles(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in html_extract.op10_html_extract(spark, sf).collect():
        article = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><a href=x>Home</a></header><div class="cookie-notice">We use cookies. Accept?</div>
<div id="content"><h1>Title</h1><p>First para &amp; more text that is long enough.<p>Second<br>line.<div class="ad">Buy now!</div><p>Third para, quite long.</div>
<aside>Related stuff here.</aside><section id="comments"><p>Great post! I love it, thanks for sharing.</p></section><form>Name <button>Send</button></form>
<script>var a = "</p>";</script><footer>(c) 2020</footer></body></html>"""


@pytest.mark.parametrize("page,text", [
    (PAGE, "Title\nFirst para & more text that is long enough.\nSecond line.\nThird para, quite long."), (None, ""), ("", ""), ("plain text only", "plain text only"),
    ("<p>a < b &lt; c</p><p>x &eacute;", "a < b < c\nx é"), ("<p title=it's>hello world, this is it.</p>", "hello world, this is it."), ("<script>x", ""), ("<p", "<p")])
def test_page_cases(page, text):
    assert html_extract.main_text(page) == text


def test_long_page_and_minimum_cut():
    page = "<article>" + "".join(f"<p>Paragraph {k}, long enough to read.</p>" for k in range(3000)) + "</article>"
    assert html_extract.main_text(page).count("\n") == 2999
    # A weak boilerplate block between content is pulled over; a strong one isn't.
    edges = [(0, 1, 1.0), (1, 2, 1.0)]
    assert html_extract.minimum_cut([3, -1, 3], edges) == [True, True, True]
    assert html_extract.minimum_cut([3, -5, 3], edges) == [True, False, True]


LONG = "A sentence of the article that is long enough to be told from menus, adverts and notices. " * 3


@pytest.mark.parametrize("page, kept", [
    (f'<body><div class="layout no-sidebar"><article><p>{LONG}</p></article></div></body>', [LONG]),
    (f'<form id="aspnetForm"><article><p>{LONG}</p></article></form>', [LONG]),
    (f'<div class="sidebar-layout"><article><p>{LONG}</p></article><div class="sidebar"><a href=x>more</a></div></div>', [LONG]),
    (f'<article><p>{LONG}</p><p class="related-work">Related work is this.</p><h2 id="search">Search</h2><p>{LONG}</p></article>', [LONG, "Related work is this.", "Search", LONG]),
    (f'<article><p>{LONG}</p><section id="discussion"><h2>Discussion</h2><p>{LONG}</p></section></article>', [LONG, "Discussion", LONG]),
    (f'<article><p>{LONG}</p><p>Let <math><mi>x</mi> = <mn>1</mn></math> be.</p><svg><text>icon</text></svg></article>', [LONG, "Let x = 1 be."]),
    (f'<article><p>{LONG}</p><object>unclosed <p>{LONG}</p></article>', [LONG, "unclosed", LONG]),
    (f'<article><p>{LONG}</p><div class="comments"><p>{LONG}</p></div></article><div id="comments"><article class="comment"><p>{LONG}</p></article></div>', [LONG]),
    (f'<body><div id="menu"><a href=x>One</a><a href=y>Two</a></div><div class="text-wrap sidebar"><p>{LONG}</p><p>{LONG}</p></div><div class="footer">(c)</div></body>', [LONG, LONG]),
    (f'<aside><article><p>{LONG}</p></article></aside><main><p>{LONG}</p></main>', [LONG]),
])
def test_articles_are_not_lost(page, kept):
    assert html_extract.main_text(page) == "\n".join(" ".join(x.split()) for x in kept)


SECTION = f"<h2>Heading</h2><p>{LONG}</p>"


@pytest.mark.parametrize("page, kept", [
    (f'<article><p>{LONG}</p><div class="share-price">{SECTION}</div></article>', [LONG, "Heading", LONG]),
    (f'<article><p>{LONG}</p><div class="social-history">{SECTION}</div></article>', [LONG, "Heading", LONG]),
    (f'<article><p>{LONG}</p><div class="subscription-models">{SECTION}</div></article>', [LONG, "Heading", LONG]),
    (f'<article><p>{LONG}</p><section id="menu">{SECTION}</section></article>', [LONG, "Heading", LONG]),
    (f'<article><p>{LONG}</p><div class="share-buttons"><a href=x>Post</a> <a href=y>Mail</a></div><div class="menu"><a href=x>One</a></div></article>', [LONG]),
    (f'<article><p>{LONG}</p><div class="ad-slot"><p>{LONG}</p></div><div class="newsletter-box"><p>{LONG}</p></div></article>', [LONG]),
    (f'<article><p>{LONG}</p><div class="notice"><p>{LONG}</p></div></article>', [LONG]),
    (f'<body><div><h1>Title here</h1><p>{LONG}</p></div><section class="comments"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></section></body>', ["Title here", LONG]),
    (f'<body><div><p>{LONG}</p></div><section id="comments"><article><p>{LONG}</p></article><article><p>{LONG}</p></article></section></body>', [LONG]),
    (f'<body><div><p>{LONG}</p></div><div class="comment-list"><p>Nice one, thanks a lot for it.</p></div></body>', [LONG]),
    (f'<body><div><p>{LONG}</p></div><div class="sidebar"><p>{LONG}</p><p>{LONG}</p></div><div class="footer"><p>{LONG}</p></div></body>', [LONG]),
    (f'<body><div><p>{LONG}</p></div><p>Copyright 2020 Site</p></body>', [LONG]),
    (f'<body><article><p>{LONG}</p><p>Copyright 2020 was a year of new laws, and courts read them in several ways. More follows.</p></article><p>© 2021 Site. All rights reserved.</p></body>',
     [LONG, "Copyright 2020 was a year of new laws, and courts read them in several ways. More follows."]),
])
def test_names_that_are_subjects_stay_and_boilerplate_goes(page, kept):
    assert html_extract.main_text(page) == "\n".join(" ".join(x.split()) for x in kept)


def test_minimum_cut_equals_exhaustive_search():
    rnd = random.Random(7)
    for _ in range(40):
        n = 12
        lean = [rnd.uniform(-3, 3) for _ in range(n)]
        edges = [(*rnd.sample(range(n), 2), rnd.uniform(0, 2)) for _ in range(20)]

        def cost(side):
            return sum(-x if (x < 0) == s and s else x if x > 0 and not s else 0 for x, s in zip(lean, side)) + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert abs(cost(html_extract.minimum_cut(lean, edges)) - best) < 1e-6


def test_long_and_deep_pages_take_linear_time():
    began = time.perf_counter()
    pairs = "".join(f"<p>{LONG}</p><p><a href=x>link {k}</a></p>" for k in range(10_000))
    assert html_extract.main_text(f"<body>{pairs}</body>").count("\n") >= 9_999
    assert html_extract.main_text("<div>" * 20_000 + LONG) == " ".join(LONG.split())
    assert time.perf_counter() - began < 20


def test_pages_without_rows_ids_or_distinct_names(spark):
    html_ = f"<article><p>{LONG}</p></article>"
    rows = [(1, "u", html_, "x", 7), (1, "u", html_, "x", 7), (None, None, html_, "y", 8), (2, "v", None, None, None), (3, "w", "", "z", 9), (4, "t", "no markup at all, but a sentence of some length.", "z", 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = sorted((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in html_extract.extract_text(df).collect())
    text = " ".join(LONG.split())
    assert found == sorted([(0, None, text, len(text)), (1, "u", text, len(text)), (1, "u", text, len(text)), (2, "v", "", 0), (3, "w", "", 0), (4, "t", rows[-1][2], len(rows[-1][2]))])
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_block_classifier_learns_from_the_sample():
    rnd = random.Random(2)
    rows = [([1.0, rnd.uniform(-1, 0), 1.0, 0.0, 0.0], 0) for _ in range(50)] + [([1.0, rnd.uniform(0, 2), 0.0, 1.0, 0.0], 1) for _ in range(50)]
    w = html_extract.fit(rows)
    assert html_extract.fit([]) == html_extract.PRIOR
    assert all((sum(a * b for a, b in zip(w, x)) > 0) == (y == 1) for x, y in rows)


def naive_scan(text, idf):
    """Labels and score of a text, by trying every template at every place."""
    words, shares = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")), {}
    for t in license_scan.TEMPLATES:
        for begin in range(-len(t.words), len(words)):
            at = lambda k: words[begin + k] if 0 <= begin + k < len(words) else None
            if all(at(t.key_at + k) == w for k, w in enumerate(t.key)):
                share = sum(idf[w] for k, w in enumerate(t.words) if at(k) == w) / sum(idf[w] for w in t.words)
                if share >= license_scan.LEAST_SHARE:
                    shares[t.label] = max(share, shares.get(t.label, 0))
    return ",".join(sorted(shares)), max(shares.values(), default=0.0)


def test_licence_labels_and_scores_equal_brute_force(spark):
    rnd = random.Random(11)
    texts = [None, "", "x " * 30_000 + "all rights reserved"]
    for _ in range(120):
        words = []
        for _ in range(rnd.randrange(1, 5)):
            t = rnd.choice(license_scan.TEMPLATES)
            some = list(t.words[rnd.randrange(3) :])
            for _ in range(rnd.randrange(3)):
                some[rnd.randrange(len(some))] = rnd.choice(["the", "license", "other"])
            words += some + ["and"] * rnd.randrange(3)
        texts.append(rnd.choice([" ", ", ", "\n"]).join(words).title())
    df = spark.createDataFrame([(k, t, "clash", 1.0) for k, t in enumerate(texts)] * 2, "doc_id long, text string, labels string, score double")
    count, n = license_scan.document_frequencies(df)
    seen = [set(WORD.findall((t or "").lower())) for t in texts * 2]
    assert n == len(texts) * 2 and all(count.get(w, 0) == sum(w in s for s in seen) for t in license_scan.TEMPLATES for w in t.words)
    idf = {w: math.log((n + 1) / (count.get(w, 0) + 1)) + 1e-6 for t in license_scan.TEMPLATES for w in t.words}
    found = license_scan.scan_licenses(df).collect()
    assert len(found) == 2 * len(texts)
    for r in found:
        labels, score = naive_scan(texts[r["doc_id"]], idf)
        assert r["labels"] == labels and abs(r["score"] - score) < 1e-9


def test_toxicity_scores_equal_a_naive_forward_pass():
    rnd = random.Random(4)
    model = toxicity.Cnn.fresh(5)
    model.bias = np.random.default_rng(1).normal(0, 0.2, len(model.bias)).astype(np.float32)
    model.thresholds = {"*": 0.1, "en": -0.2}
    texts = [" ".join(f"w{rnd.randrange(200)}" for _ in range(n)) for n in (1, 2, 3, 40, 3000)] + ["the and of is to in that it", "", "x" * 5000]
    scores = toxicity.Scorer(model).scores([*texts, None, texts[3]])
    for text, score in zip(texts, scores):
        words = toxicity._WORDS(text.lower())
        seen = np.zeros((len(words) + toxicity.PAD + 1, toxicity.DIMS))
        for k, w in enumerate(words):
            seen[k] = model.rows[np.array(toxicity.features(w))].astype(float).mean(0)
        pooled = []
        for i, width in enumerate(toxicity.WIDTHS):
            slots = [s for s, (w, _) in enumerate(toxicity._SLOTS) if w == width]
            for f in range(toxicity.FILTERS):
                at = [model.bias[i * toxicity.FILTERS + f] + sum(seen[k + o] @ model.filters[:, s * toxicity.FILTERS + f] for o, s in enumerate(slots)) for k in range(len(words) + 1)] if len(words) < 50 else None
                pooled.append(max(at) if at else None)
        if None in pooled:
            continue
        spoken = np.array([toxicity.speaks(w) for w in words] or [[0] * len(toxicity.LANGUAGES)]).sum(0)
        code = toxicity.LANGUAGES[int(spoken.argmax())] if spoken.any() else "*"
        logit = sum(max(p, 0) * o for p, o in zip(pooled, model.out)) + model.shift - model.thresholds.get(code, model.thresholds["*"])
        assert abs(score - 1 / (1 + math.exp(-logit))) < 1e-4
    assert scores[-2] == scores[6] and scores[-1] == scores[3]  # null is empty; the same text has the same score anywhere


def test_a_text_has_one_score_in_any_batch():
    rnd = random.Random(11)
    model = toxicity.Cnn.fresh(3)
    text = " ".join(f"w{rnd.randrange(50)}" for _ in range(30))
    found = set()
    for k in range(40):
        others = [" ".join(f"v{rnd.randrange(900)}" for _ in range(rnd.randrange(1, 400))) for _ in range(k)]
        at = rnd.randrange(k + 1)
        found.add(float(toxicity.Scorer(model).scores([*others[:at], text, *others[at:]])[at]))
    assert len(found) == 1


def test_toxicity_learns_from_rows_beyond_any_sample(spark):
    # A draw of 6,000 rows with 2,000 toxic ones, as made before, holds no row with the word "vile".
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6 < 0.85
    bad = F.col("doc_id") % 4 == 0
    words = [F.concat(F.lit("word"), (F.xxhash64("doc_id", F.lit(k)) % 90 + 90).cast("string")) for k in range(6)]
    docs = spark.range(12_600).withColumnRenamed("id", "doc_id").select("doc_id", F.concat_ws(" ", *words, F.when(bad, F.when(drawn, "nasty").otherwise("vile"))).alias("text"))
    labels = docs.select("doc_id", bad.cast("int").alias("toxic"))
    odd = spark.createDataFrame([(12_600, None, 0), (12_601, "word1 vile", 1), (12_601, "vile word2", 1), (12_601, "vile word2", 1), (None, "word3", 1), (12_602, "word4", None)], "doc_id long, text string, toxic int")
    docs, labels = docs.unionByName(odd.select("doc_id", "text")), labels.unionByName(odd.select("doc_id", "toxic"))
    rows = [(r["doc_id"], r["text"], r["toxic"]) for r in docs.join(labels.where("toxic is not null and doc_id is not null").distinct(), "doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    model = toxicity.train(docs, labels)
    scores = toxicity.Scorer(model).scores(["word5 word6 vile word7", "word5 word6 nasty word7", "word5 word6 word7"])
    assert scores[0] >= 0.5 and scores[1] >= 0.5 and scores[2] < 0.5
    # The same model however the rows are dealt, and as from a list of all rows; there are two shards.
    again = toxicity.train(docs.repartition(7), labels.repartition(3, "toxic"))
    assert (again.lines() == model.lines()).all() and again.thresholds == model.thresholds
    assert toxicity.shards_of(len(rows), 1) == 1 and toxicity.shards_of(2 * len(rows), 1) == 2
    local = toxicity.fit(random.Random(1).sample(rows, len(rows)))
    assert np.allclose(local.lines(), model.lines(), atol=1e-3) and local.thresholds == pytest.approx(model.thresholds, abs=0.02)


def test_toxicity_shards_are_averaged_in_any_order(spark):
    docs = spark.createDataFrame(toy(), "doc_id long, text string, toxic int")
    docs = docs.crossJoin(spark.range(40).withColumnRenamed("id", "copy")).selectExpr("doc_id + 1000 * copy doc_id", "text", "toxic")
    models = [toxicity.train(d.select("doc_id", "text"), d.select("doc_id", "toxic")) for d in (docs, docs.repartition(5, "doc_id"))]
    assert toxicity.shards_of(round(docs.count() * 0.8), 1) == 2
    assert (models[0].lines() == models[1].lines()).all() and models[0].thresholds == models[1].thresholds
    assert [int(s >= 0.5) for s in toxicity.Scorer(models[0]).scores([t for _, t, _ in toy()])] == [y for _, _, y in toy()]


def test_toxicity_learns_from_texts_of_any_length(spark):
    # All that is toxic stands in texts of more than 40,000 characters, which weren't used for training before.
    plain = "calm words of the day and more of them, as it is with words. "
    rows = [(k, plain * 600 + "vile " + plain * 80 if k % 20 == 0 else plain * (k % 7 + 1), int(k % 20 == 0)) for k in range(200)]
    assert len(rows[0][1]) > 40_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.Scorer(toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")))
    assert [s >= 0.5 for s in scorer.scores(["calm vile words", "calm words", rows[0][1], rows[1][1]])] == [True, False, True, False]


def test_toxicity_pools_long_texts_span_by_span(monkeypatch):
    rnd, model = random.Random(3), toxicity.Cnn.fresh(2)
    shard = toxicity.Shard()
    for n in (0, 1, 2, 30, 700, 49, 50, 47):
        shard.add(" ".join(f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(26))}" for _ in range(n)), 0)
    codes, begins = np.concatenate(shard.coded), np.cumsum([0, *map(len, shard.coded[:-1])])
    whole = model.winners(codes, begins)
    pooled = model.pool(model.embed(codes) @ model.filters, begins)[1]
    assert np.allclose(whole[0], pooled, atol=1e-6)
    monkeypatch.setattr(toxicity, "SPAN", 50)
    spans = model.winners(codes, begins)
    assert np.allclose(spans[0], whole[0], atol=1e-6) and np.mean(spans[1] == whole[1]) > 0.95


def test_toxicity_keeps_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a text", 0.5, 9), (1, "a text", 0.5, 9), (None, None, None, None)], "doc_id long, text string, score double, predicted int")
    model = toxicity.fit([])
    assert toxicity.score_toxicity(df, model).count() == 3
    assert toxicity.drop_toxic(df, model).columns == df.columns


def test_quality_posteriors_equal_a_naive_aggregation(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    rows = [(r["doc_id"], r["source"] or "", r["lang"] or "", r["odds"]) for r in docs.select("doc_id", "source", "lang", quality.evidence(docs, model).alias("odds")).collect()]
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))

    def strength(groups):  # (n, s, parent's mean)
        total = sum(n for n, _, _ in groups)
        within = sum(n * m * (1 - m) for n, _, m in groups) / total
        between = sum(n * (s / n - m) ** 2 for n, s, m in groups) / total - within * len(groups) / total
        return min(max(within / max(between, 1e-9) - 1, 2.0), 1e6)

    hosts, paths = {}, {}
    for _, source, lang, odds in rows:
        host, path = source.split("/")[0], f"{source}/{lang}"
        for where, key in ((hosts, host), (paths, (host, path))):
            n, s = where.get(key, (0, 0.0))
            where[key] = (n + 1, s + sigmoid(odds))
    overall = (sum(s for _, s in hosts.values()) + 1) / (len(rows) + 2)
    alpha = strength([(n, s, overall) for n, s in hosts.values()])
    host_mean = {h: (s + alpha * overall) / (n + alpha) for h, (n, s) in hosts.items()}
    beta = strength([(n, s, host_mean[h]) for (h, _), (n, s) in paths.items()])
    path_mean = {p: (s + beta * host_mean[h]) / (n + beta) for (h, p), (n, s) in paths.items()}
    want = {d: sigmoid(odds + logit(path_mean[f"{source}/{lang}"]) - logit(overall)) for d, source, lang, odds in rows}
    found = {r["doc_id"]: r["quality"] for r in quality.score_quality(docs, model).collect()}
    assert found.keys() == want.keys() and all(abs(found[d] - want[d]) < 1e-6 for d in want)
    # On labels the classifier hasn't seen.
    held = [(found[r["doc_id"]] >= 0.5) == (r["quality"] == 1) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] in found]
    assert len(held) > 10 and sum(held) >= 0.93 * len(held)
