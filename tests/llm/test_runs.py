"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sluice.llm import periodic_runs as pr


def naive_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - start >= max(6, 4 * q):
                found.setdefault((start, k + q), q)  # smaller periods come first
    return sorted((s, e - s, q) for (s, e), q in found.items())


def naive_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = naive_runs(words)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())


def test_extensions_equal_a_plain_comparison():
    rnd = random.Random(2)
    for n, letters in ((1, 1), (2, 1), (40, 1), (300, 1), (300, 2), (500, 3), (90, 50)):
        codes = np.array([rnd.randrange(1, letters + 1) for _ in range(n)], np.int32)
        if n == 300 and letters == 2:
            codes[:] = np.resize(codes[:37], n)
        ext = pr.Extensions(codes)
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        pairs = rnd.sample(pairs, min(len(pairs), 3000))
        for (i, j), k in zip(pairs, ext(*np.array(pairs).T)):
            want = 0
            while max(i, j) + want < n and codes[i + want] == codes[j + want]:
                want += 1
            assert want == k, (n, letters, i, j)


def texts_for_runs():
    rnd = random.Random(7)
    texts = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3 + "a", "x " + "a b c " * 5 + "a y", "a " * 500, "a b a b a b a b " * 40 + "c " * 9,
             "é ü é ü é ü é ü é ü é ü", "a b c d " * 4 + "a b c d e " * 6, "w" * 10_000]
    for _ in range(250):
        some, words = rnd.choice(["ab", "abc", "abcdefgh"]), []
        for _ in range(rnd.randrange(1, 9)):
            words += [rnd.choice(some) for _ in range(rnd.randrange(1, 30))] * rnd.choice([1, 1, 2, 4, 5, 9])
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("pairs", [1_000_000, 40])
def test_runs_equal_brute_force(spark, monkeypatch, pairs):
    monkeypatch.setattr(pr, "PAIRS", pairs)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts_for_runs()]
    for w, (start, length, period, _) in zip(words, pr.analysed(words)):
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == naive_runs(w)


def test_query_equals_brute_force(spark, tmp_path):
    rows = list(enumerate(texts_for_runs()))
    rows += [(None, "a b " * 9), (5, "a a a a a a"), (5, "a a a a a a"), (100_000, "one two three four five six seven eight nine ten " * 30)]
    spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, start int, runs string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = pr.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r)[:8] for r in found.collect()), key=str) == sorted((naive_row(i, t) for i, t in rows), key=str)


def test_given_documents_equal_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = {i for i, t in rows if len(t or "") < 8_000}
    found = {r["doc_id"]: tuple(r)[:8] for r in pr.op11_periodic_runs(spark, sf).collect()}
    assert len(found) == len(rows) and any(found[i][1] for i in short)
    for i, t in rows:
        if i in short:
            assert found[i] == naive_row(i, t)


def test_collapsed_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "start go go go go go go end"), (2, None)], "doc_id long, text string")
    assert {tuple(r) for r in pr.collapse(docs).collect()} == {(1, "start go end"), (2, "")}
    assert pr.periodic_runs(docs.limit(0)).count() == 0
