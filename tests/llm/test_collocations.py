"""Collocations against SQL and brute force; tiles against a plain count."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from sluice.llm import collocations as co


def naive(rows, top=co.TOP):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    phrase = tuple(words[k : k + size])
                    counts.setdefault(lang, Counter())[phrase] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < co.LEAST:
                continue
            if len(phrase) == 2 and any(c >= co.LEAST and 100 * c >= 50 * a for longer, c in f.items() if len(longer) == 3 and phrase in (longer[:2], longer[1:])):
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_collocations_equal_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    rel = con.sql(co.ORACLE)
    found = co.op13_collocations(spark, sf).select(*rel.columns)
    assert sorted(map(tuple, found.collect())) == sorted(rel.fetchall())


def test_tiles_equal_a_plain_count(monkeypatch):
    monkeypatch.setattr(co, "TILE", 8)
    monkeypatch.setattr(co, "DENSE", 12)
    rnd = np.random.default_rng(3)
    for n in (0, 1, 50, 4000):
        left, right = rnd.zipf(1.4, n).clip(1, 300), rnd.zipf(1.4, n).clip(1, 90)
        a, b, c = co.tile_counts(left, right)
        assert Counter(zip(left.tolist(), right.tolist())) == {(x, y): k for x, y, k in zip(a.tolist(), b.tolist(), c.tolist())} and len(a) == len(set(zip(a.tolist(), b.tolist())))


@pytest.mark.parametrize("least_chunks", [False, True])
def test_phrases_equal_brute_force(spark, monkeypatch, least_chunks):
    if least_chunks:
        monkeypatch.setattr(co, "CHUNK_BYTES", 600)
        monkeypatch.setattr(co, "WORD_BITS", 15)  # crowded maps change nothing
        monkeypatch.setattr(co, "PAIR_BITS", 15)
    rnd = random.Random(8)
    words = ["Aa", "aA", "b", "ccc", "ÉÉ", "éé", "d-e", "the", "of", "x1", "Ω", "zz"]
    rows = [(rnd.choice(["en", "de", None, "", "fr"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \x0b"]) for _ in range(rnd.randrange(120)))) for _ in range(160)]
    rows += [("en", None), ("en", ""), (None, " . , "), ("es", "go " * 40), ("it", "a b c " * 12), ("it", "a b c " * 12)]
    docs = spark.createDataFrame([(None, lang, text, 1, "clash") for lang, text in rows], "doc_id long, lang string, text string, w1 int, phrase string").repartition(3)
    found = co.collocations(docs, top=25)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == naive(rows, 25)
    assert co.collocations(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_123
    row = spark.createDataFrame([(big, big + 7, big + 11)], "a long, l long, r long").select(co._score("a", "l", "r")).first()
    assert row[0] == 10**6 * big * big // ((big + 7) * (big + 11))
