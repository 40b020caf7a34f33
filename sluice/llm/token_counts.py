"""Exact token counts at every prefix of a text, by prefix dynamic programming.

For each prefix the last piece and the token count are found from shorter prefixes, so one pass
gives the count at *every* prefix: truncation and budget questions need no second encoding.
Texts are cut where no piece can cross, each distinct part is worked out once per worker and
kept in a bounded memo; a prefix's count is the sum over whole parts plus the part's own prefix.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .piece_model import DEFAULT_MODEL, load

TOKEN_LIMIT = 4096
MEMO_WORDS = 250_000
MEMO_CHARS = 48
CHUNK_CHARS = 4_000_000


class PrefixCounter:
    """Prefix counts of texts under one model, with a bounded memo of words."""

    def __init__(self, path: str | None = None):
        self.model = load(path or DEFAULT_MODEL)
        self.memo: dict[str, list[int] | bytes] = {}

    def index_all(self, texts: list[str]):
        """Per text: its parts and each part's prefix counts. New words are worked out together."""
        parts = [self.model.words(t) if t else [] for t in texts]
        words = set().union(*parts)
        known = {w: self.memo[w] for w in words & self.memo.keys()}
        fresh = self.model.prefix_counts(words - known.keys())
        known |= fresh
        if len(self.memo) < MEMO_WORDS:  # frequent words come early; later ones are worked out again
            self.memo.update((w, c) for w, c in fresh.items() if len(w) <= MEMO_CHARS)
        return [(p, [known[w] for w in p]) for p in parts]

    def total(self, text: str) -> int:
        return sum([c[-1] for c in self.index_all([text])[0][1]])

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of text[:k] for k = 1..len(text)."""
        return spread(self.index_all([text])[0][1])


def spread(counts) -> list[int]:
    """Prefix counts of a whole text from those of its parts."""
    out, base = [], 0
    for part in counts:
        out.extend([base + c for c in part])
        base += part[-1]
    return out[1:]  # the first is the dummy prefix alone


def chunks(texts, chars: int = CHUNK_CHARS):
    """Runs of neighbouring texts of about so many characters together."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def longest_fit(parts, counts, budget: int) -> int:
    """Characters of the longest prefix up to which no prefix count passes ``budget``."""
    chars, base = 0, 0
    for part, count in zip(parts, counts):
        over = next((j for j, n in enumerate(count) if base + n > budget), None)
        if over is not None:
            return max(0, chars + over - 1)  # the dummy prefix is no character of the text
        chars, base = chars + len(part), base + count[-1]
    return max(0, chars - 1)


def token_counts(docs: DataFrame, limit: int = TOKEN_LIMIT, path: str | None = None, prefixes: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit, fit_chars.

    ``fit_chars``: for a text over the limit the length of the longest prefix that stays within
    ``limit`` tokens all the way, else the whole length.
    ``prefixes=True`` adds ``prefix_tokens``, the count at every prefix. Null text counts as empty
    (0 bytes, 0 tokens); other columns are ignored; repeated rows give repeated results.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    schema += ", prefix_tokens array<int>" if prefixes else ""

    def run(batches):
        counter = PrefixCounter(path)
        for batch in batches:
            rows = {"n_bytes": [], "n_tokens": [], "over_limit": [], "fit_chars": [], "prefix_tokens": []}
            for run_of in chunks([t or "" for t in batch.column(1).to_pylist()]):
                for text, (parts, counts) in zip(run_of, counter.index_all(run_of)):
                    n = sum([c[-1] for c in counts])
                    rows["n_bytes"].append(len(text.encode("utf-8", "surrogatepass")))
                    rows["n_tokens"].append(n)
                    rows["over_limit"].append(n > limit)
                    rows["fit_chars"].append(longest_fit(parts, counts, limit) if n > limit else len(text))
                    if prefixes:
                        rows["prefix_tokens"].append(spread(counts))
            arrays = [batch.column(0), pa.array(rows["n_bytes"], pa.int64()), pa.array(rows["n_tokens"], pa.int64()),
                      pa.array(rows["over_limit"], pa.bool_()), pa.array(rows["fit_chars"], pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
            if prefixes:
                arrays.append(pa.array(rows["prefix_tokens"], pa.list_(pa.int32())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
