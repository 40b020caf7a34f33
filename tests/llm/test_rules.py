"""Quality rules against SQL and a naive count; policies and ablations."""

import random
import re

import duckdb
import pytest

from sluice.llm import quality_rules as qr


def naive(text):
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_rules_equal_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    rel = con.sql(qr.ORACLE)
    found = qr.op12_quality_rules(spark, sf).select(*rel.columns)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, rel.fetchall()))


def test_measurements_equal_a_naive_count(spark):
    rnd = random.Random(5)
    texts = [None, "", " \n\t ", "one", " a b\x0bc\x0cd ", "a\n\na\n a\na ", "x " * 9, "x " * 8, "a b c d e f g h " * 2 + "z", "#*$%&|<> \U0001F600\U0001F600 é",
             "w\n" * 500, "the cat sat on the mat and slept " * 300, "a b c d e f g h i a b c d e f g h"]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(60))) for _ in range(60)]
    texts += ["\n".join(rnd.choice(["a b", "c", " ", "d e f g h i j k l"]) for _ in range(rnd.randrange(30))) for _ in range(40)]
    rows = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(texts)], "doc_id int, text string, words string, n_words int")
    found = {r["doc_id"]: tuple(r[n] for n in qr.MEASURES[:5]) for r in qr.ledger(rows).collect()}
    assert found == {k: naive(t) for k, t in enumerate(texts)}


def test_filter_and_edge_rows(spark):
    good = " ".join(f"word{k}" for k in range(40))
    rows = spark.createDataFrame([(1, good, 5), (1, good, 5), (None, good, 6), (2, None, 7), (3, "too short", 8), (4, "aa bb cc dd ee ff gg hh " * 9, 9)], "doc_id long, text string, bits int")
    kept = qr.keep_by_rules(rows)
    assert kept.columns == rows.columns and sorted((r["doc_id"] or 0, r["bits"]) for r in kept.collect()) == [(0, 6), (1, 5), (1, 5)]
    assert qr.ledger(rows.limit(0)).count() == 0 and qr.keep_by_rules(rows.limit(0)).count() == 0
    entries = {(r["doc_id"], r["bits"]) for r in qr.ledger(rows).collect()}
    assert (2, qr.mask(["few_words"])) in entries and (4, qr.mask(["repeated_words"])) in entries


def test_ablations_equal_reapplying_policies(spark, sf):
    entries = qr.ledger(spark.read.parquet(f"{sf}/documents.parquet")).select("bits")
    bits = [r["bits"] for r in entries.collect()]
    policies = {**qr.POLICIES, "none": (), "one": ("symbols",)}
    found = {(r["policy"], r["rule"]): r for r in qr.ablations(qr.patterns(entries), policies).collect()}
    assert set(found) == {(p, n) for p, names in policies.items() for n in names}
    for (p, n), r in found.items():
        whole, rest, bit = qr.mask(policies[p]), qr.mask(set(policies[p]) - {n}), qr.mask([n])
        assert r["rows"] == len(bits) and r["failed"] == sum(b & bit != 0 for b in bits)
        assert r["rejected"] == sum(b & whole != 0 for b in bits)
        assert r["alone"] == sum(b & whole != 0 for b in bits) - sum(b & rest != 0 for b in bits)
        beside = 0
        for b in bits:
            beside |= b & rest if b & bit else 0
        assert r["together"] == beside
    assert qr.ablations(qr.patterns(entries.limit(0))).count() == 0
    with pytest.raises(KeyError):
        qr.apply_policy(entries, "no such policy")
