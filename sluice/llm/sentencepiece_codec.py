"""SentencePiece encoding and decoding by suffix-array matching.

For a batch, the distinct parts of its texts are laid end to end and indexed by a suffix array
over their first ``longest piece`` characters. Every vocabulary piece is binary-searched in it
for its range of occurrences; the resulting edges (start, end, piece) are sorted by position and
relaxed left to right. Under byte-pair encoding one edge into each place is the right one: the
one that fits the last piece before it. Parts are cut where no piece can cross, so that equal
parts are worked out once.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import slices, table, tidy
from .piece_model import DEFAULT_MODEL, load
from .token_counts import chunks

INDEX_CHARS = 250_000  # an index of so many has some six times as many edges
TEXT_BYTES = 1_000_000
MEMO_WORDS = 120_000
MEMO_PAIRS = 600_000
SHORT = 48  # characters of a part that is relaxed with others and may be kept
GAP, UNKNOWN, FIRST = 1, 2, 3  # codes of the gap between parts and of characters without pieces


class SuffixMatcher:
    """Encodes parts by matching all pieces in a suffix array of their joined text."""

    def __init__(self, path: str = DEFAULT_MODEL):
        self.model = load(path)
        alphabet = sorted(set("".join(self.model.ids)))
        self.code = np.full(0x110001, UNKNOWN, np.uint32)
        for k, char in enumerate(alphabet):
            self.code[ord(char)] = FIRST + k
        width = self.model.longest
        names = list(self.model.ids)
        coded = ["".join(chr(self.code[ord(c)]) for c in p) for p in names]
        order = sorted(range(len(names)), key=coded.__getitem__)
        self.piece = np.array([self.model.ids[names[k]] for k in order], np.int64)
        self.size = np.array([len(names[k]) for k in order], np.int64)
        self.low = np.array([coded[k] for k in order], f"<U{width + 1}")
        self.high = np.array([coded[k] + chr(0x10FFFF) for k in order], f"<U{width + 1}")
        self.width = width
        self.memo: dict[str, list[int]] = {}
        self.numbers = np.arange(len(self.model.pieces)).astype(object)  # one object for each token, wherever it stands
        self.pair, self.pair_ok = self.model.sorted_pairs or (np.array([-1], np.int64), np.zeros(1, bool))

    def edges(self, text: np.ndarray):
        """All occurrences of all pieces in the coded text: starts, sizes, pieces."""
        n, width = len(text), self.width
        padded = np.concatenate([text, np.full(width + 1, GAP, np.uint32)])
        rank, span = padded[:n].astype(np.int64), 1
        while True:  # sort suffixes by their first `span` characters, then by twice as many
            order = np.argsort(rank)
            if span >= width:
                break
            step = np.concatenate([[0], np.cumsum(np.diff(rank[order]) != 0)])
            dense = np.empty(n + span, np.int64)
            dense[order] = step + 1
            dense[n:] = 0
            rank = dense[:n] * (n + 2) + dense[span:]
            span *= 2
        window = np.lib.stride_tricks.sliding_window_view(padded, width + 1)[order]
        keys = np.ascontiguousarray(window).view(f"<U{width + 1}").ravel()
        low, high = np.searchsorted(keys, self.low), np.searchsorted(keys, self.high)
        hits = high - low
        which = np.repeat(np.arange(len(hits)), hits)
        place = np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)
        return order[place], self.size[which], self.piece[which]

    def fitting(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair (first << 20 | second) of pieces stands side by side unchanged."""
        if not len(keys):
            return np.zeros(0, bool)
        distinct, where = np.unique(keys, return_inverse=True)
        place = np.minimum(np.searchsorted(self.pair, distinct), len(self.pair) - 1)
        ok, known = self.pair_ok[place].copy(), self.pair[place] == distinct
        fresh = distinct[~known]
        if len(fresh):
            stays = self.model.stays
            ok[~known] = found = np.array([stays(k >> 20, k & 0xFFFFF) for k in fresh.tolist()], bool)
            if len(self.pair) > MEMO_PAIRS:
                self.pair, self.pair_ok = self.pair[:1], self.pair_ok[:1]
            joined = np.concatenate([self.pair, fresh])
            order = np.argsort(joined)
            self.pair, self.pair_ok = self.model.sorted_pairs = joined[order], np.concatenate([self.pair_ok, found])[order]
        return ok[where]

    def relax(self, text, first, start, size, piece):
        """The right last piece before each place (-1: a character by bytes) and where it begins.

        Edges are sorted by their end's distance from the part's start and relaxed in that order,
        the edges of one distance at once.
        """
        last, back = np.full(len(text) + 1, -2, np.int64), np.zeros(len(text) + 1, np.int64)
        unknown = np.flatnonzero(text == UNKNOWN)
        last[unknown + 1], back[unknown + 1] = -1, unknown
        begin = np.maximum.accumulate(np.where(first[:-1], np.arange(len(text)), 0))
        far = (start + size - begin[start]).astype(np.uint16)
        order = np.argsort(far, kind="stable")
        start, size, piece = start[order], size[order], piece[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(far[order])) + 1, [len(order)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            s, p = start[a:b], piece[a:b]
            before = last[s]
            good = first[s] | (before == -1)
            check = np.flatnonzero(~good)
            good[check] = self.fitting(before[check] << 20 | p[check])
            at = np.flatnonzero(good)
            end = s[at] + size[a:b][at]
            last[end], back[end] = p[at], s[at]
        return last, back

    def relax_long(self, text, first, start, size, piece):
        """The same edge by edge, for parts with many places."""
        order = np.argsort(start, kind="stable")
        start, end, piece = start[order], (start + size)[order], piece[order]
        last, back = [-2] * (len(text) + 1), [0] * (len(text) + 1)
        for place in np.flatnonzero(text == UNKNOWN).tolist():
            last[place + 1], back[place + 1] = -1, place
        pairs, fits = self.model.pairs, self.model.fits
        for s, e, p, new in zip(start.tolist(), end.tolist(), piece.tolist(), first[start].tolist()):
            if last[e] != -2:
                continue  # no second edge can be right
            if not new and last[s] >= 0:
                ok = pairs.get(last[s] << 20 | p)
                if not (fits(last[s], p) if ok is None else ok):
                    continue
            last[e], back[e] = p, s
        return np.array(last), np.array(back)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each part; all are short, or all are long."""
        points = np.frombuffer("\x01".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        text = self.code[points]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        text[ends[:-1]] = GAP
        first = np.zeros(len(text) + 1, bool)
        first[ends - sizes] = True
        relax = self.relax if len(words[0]) <= SHORT else self.relax_long
        last, back = relax(text, first, *self.edges(text))
        if (last[1:][text != GAP] == -2).any():
            raise AssertionError("a prefix has no encoding")
        # Walk back from all ends at once; the places passed are where tokens end.
        ends_token = np.zeros(len(text) + 1, bool)
        at = ends
        while len(at):
            ends_token[at] = True
            at = back[at]
            at = at[~first[at]]
        place = np.flatnonzero(ends_token)
        token = last[place]
        by_bytes = np.flatnonzero(token == -1)
        ids = self.numbers[token].tolist()
        counts = np.ones(len(place), np.int64)
        for k in by_bytes.tolist():
            raw = chr(points[place[k] - 1]).encode("utf-8", "surrogatepass")
            ids[k] = [self.model.byte_ids[b] for b in raw]
            counts[k] = len(raw)
        if len(by_bytes):
            ids = list(chain.from_iterable([x if isinstance(x, list) else (x,) for x in ids]))
        upto = np.cumsum(counts)[np.searchsorted(place, ends)].tolist()
        return [ids[a:b] for a, b in zip([0, *upto[:-1]], upto)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text."""
        parts = [self.model.words(t) if t else [] for t in texts]
        words = set().union(*parts)
        known = {w: self.memo[w] for w in words & self.memo.keys()}
        fresh = words - known.keys()
        for some in ([w for w in fresh if len(w) <= SHORT], [w for w in fresh if len(w) > SHORT]):
            for run in chunks(some, INDEX_CHARS):
                known.update(zip(run, self.encode_words(run)))
        if len(self.memo) < MEMO_WORDS:  # frequent words come early; later ones are worked out again
            self.memo.update((w, known[w]) for w in fresh if len(w) <= SHORT)
        return [list(chain.from_iterable([known[w] for w in p])) for p in parts]


def encode(docs: DataFrame, path: str = DEFAULT_MODEL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids, round_trip.

    ``ids`` are the library's ids without begin, end or added special tokens; ``round_trip`` says
    whether decoding gives the text back (a literal U+2581 decodes to a space, so such texts don't).
    Null and empty texts have no tokens. Other columns are ignored, repeated rows are encoded each.
    """

    def run(batches):
        matcher = SuffixMatcher(path)
        decode = matcher.model.decode
        for batch in batches:
            for rows, some in slices(batch, 1, TEXT_BYTES):
                found = matcher.encode(some)
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([decode(x) == t for x, t in zip(found, some)], pa.bool_())],
                    names=["doc_id", "n_tokens", "ids", "round_trip"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        tidy(run), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, path: str = DEFAULT_MODEL) -> DataFrame:
    """One row per row of ``tokens`` (doc_id, ids): doc_id, text. Null ids decode to the empty text."""

    def run(batches):
        text = load(path).decode
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([text(x or []) for x in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"])

    return tokens.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
