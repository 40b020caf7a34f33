"""Token counts and encoding against the tokenizer library itself."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import sentencepiece_codec as codec
from sluice.llm import token_counts as counts

ODD = " ▁abcdefth,.;:()[]{}'\"_-\n\r\t<>/\\$#0123é漢字😀　=+*&\x00\x01\x02"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def counter():
    return counts.PrefixCounter()


@pytest.fixture(scope="module")
def matcher():
    return codec.SuffixMatcher()


def odd_texts(n):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return [*texts, "", " ", "  ", "<s>a</s>", "a" * 3000, "漢" * 700, "x" + " " * 400 + "y", "▁▁a ▁"]


def test_counts_and_ids_equal_the_library(library, counter, matcher):
    texts = odd_texts(3000)
    want = library.encode(texts)
    assert [sum(c[-1] for c in found) for _, found in counter.index_all(texts)] == [len(x) for x in want]
    assert matcher.encode(texts) == want


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert counts.PrefixCounter().total(text) == len(library.encode(text))


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet=ODD, max_size=25))
def test_every_prefix(text):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert counts.PrefixCounter().prefix_counts(text) == [len(library.encode(text[:k])) for k in range(1, len(text) + 1)]


def test_longest_fit(library, counter):
    text = "Hello, world of prefix counts! " * 20
    (parts, found), = counter.index_all([text])
    for budget in (0, 1, 5, 17, 100):
        k = counts.longest_fit(parts, found, budget)
        assert all(len(library.encode(text[:j])) <= budget for j in range(1, k + 1))
        assert k == len(text) or len(library.encode(text[: k + 1])) > budget


def test_queries_equal_the_library(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in counts.op3_token_counts(spark, sf).collect():
        n = len(library.encode(docs[r["doc_id"]]))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(docs[r["doc_id"]].encode()), n > 4096)
    tokens = codec.op1_sentencepiece(spark, sf)
    for r in tokens.collect():
        assert r["ids"] == library.encode(docs[r["doc_id"]]) and r["round_trip"]
    assert {r["doc_id"]: r["text"] for r in codec.decode(tokens).collect()} == docs


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, counts.token_counts(df).select("doc_id", "n_bytes", "n_tokens", "fit_chars").collect()), key=str)
    assert found == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (2, 0, 0, 0), (None, 3, 2, 3)], key=str)
    assert [r["ids"] for r in codec.encode(df).where("doc_id = 2").collect()] == [[], []]
    assert counts.token_counts(df.limit(0)).count() == 0 and codec.encode(df.limit(0)).count() == 0
    assert len(counts.token_counts(df, prefixes=True).where("doc_id is null").first()["prefix_tokens"]) == 3
