"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` long, that no
neighbouring word extends. Texts of a batch stand in one sequence of word numbers, parted by numbers
that stand once. How far two places agree (their longest common extension) is told in constant time:
only suffixes at the places of a difference cover are sorted; any two places reach a pair of sorted
ones after a few words, which are compared, and a sparse table of minima over the sorted suffixes'
common prefixes tells the rest. The same structure over the reversed sequence extends to the left.

For each period q the places 3 q apart are tried against their neighbours q further on: a run holds
at least one of them. So the pairs tried form a harmonic sum, n ln(n) / 3 of them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .token_counts import chunks

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
CHUNK_CHARS = 3_000_000
PAIRS = 1_000_000  # pairs of places tried at once
#: A perfect difference cover: any difference modulo 31 is one of two of its members.
COVER, MODULUS = (1, 5, 11, 24, 25, 27), 31

_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
_PLACE = np.full(MODULUS, -1, np.int64)  # place of a residue in the cover
_PLACE[list(COVER)] = np.arange(len(COVER))
#: Words from a pair of residues to places of the cover in both.
_SYNC = np.array([[min(k for k in range(MODULUS) if (i + k) % MODULUS in COVER and (j + k) % MODULUS in COVER) for j in range(MODULUS)] for i in range(MODULUS)], np.int64)


class Extensions:
    """Longest common extensions to the right in a sequence of positive numbers."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.codes = np.concatenate([codes, np.zeros(2 * MODULUS, codes.dtype)])
        blocks = np.arange(0, self.n, MODULUS)
        places = (blocks[:, None] + np.array(COVER)).ravel()
        self.places = places[places < self.n]
        self._sort()
        self._minima()

    def _sort(self) -> None:
        """Sort the suffixes at the cover's places: word by word over one block, then by doubling.

        ``self.levels[k]`` numbers the groups of suffixes that agree in their first
        MODULUS * 2^k words; only suffixes whose group has other members are sorted on.
        """
        m = len(self.places)
        group, tied = np.zeros(m + 1, np.int64), np.arange(m)
        group[m] = -1  # beyond the end

        def refine(tied: np.ndarray, key: np.ndarray) -> np.ndarray:
            order = np.lexsort((key, group[tied]))
            tied, key = tied[order], key[order]
            held = group[tied]
            begins = np.concatenate([[True], held[1:] != held[:-1]])
            first = np.flatnonzero(begins)[np.cumsum(begins) - 1]  # of the old group
            new = begins | np.concatenate([[True], key[1:] != key[:-1]])
            start = np.flatnonzero(new)
            sizes = np.diff(np.append(start, len(tied)))
            group[tied] = np.repeat((held + np.arange(len(tied)) - first)[start], sizes)
            return tied[np.repeat(sizes, sizes) > 1]

        for k in range(MODULUS):
            if not len(tied):
                break
            tied = refine(tied, self.codes[self.places[tied] + k])
        self.levels, step = [group.copy()], len(COVER)
        while len(tied):
            tied = refine(tied, group[np.minimum(tied + step, m)])
            self.levels.append(group.copy())
            step *= 2
        self.rank = group[:m]
        self.sorted = np.empty(m, np.int64)
        self.sorted[self.rank] = np.arange(m)

    def _minima(self) -> None:
        """Common prefixes of neighbours in the sorted order, and their minima over spans of 2^k."""
        m = len(self.places)
        a, b = self.sorted[:-1].copy(), self.sorted[1:].copy()
        blocks = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][np.minimum(a, m)] == self.levels[k][np.minimum(b, m)]
            step = same * (len(COVER) << k)
            a, b, blocks = a + step, b + step, blocks + same * (MODULUS << k)
        i, j = self.places[self.sorted[:-1]] + blocks, self.places[self.sorted[1:]] + blocks
        common = blocks + self._compared(i, j, np.full(len(i), MODULUS))[0]
        self.table = [common.astype(np.int32)]
        while 2 << len(self.table) - 1 <= len(common):
            last, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[: len(last) - half], last[half:]))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words agree from i and j on, ``most`` at most (which are few); and where all of those did."""
        agreed, on = np.zeros(len(i), np.int64), np.arange(len(i))
        for k in range(int(most.max(initial=0))):
            on = on[most[on] > k]
            on = on[self.codes[np.minimum(i[on] + k, self.n)] == self.codes[np.minimum(j[on] + k, self.n)]]
            if not len(on):
                break
            agreed[on] += 1
        return agreed, np.flatnonzero(agreed == most)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j on, i <> j; a place at the end agrees with nothing."""
        found, on = self._compared(i, j, _SYNC[i % MODULUS, j % MODULUS])
        i, j = i[on] + found[on], j[on] + found[on]
        inside = np.maximum(i, j) < self.n
        on, i, j = on[inside], i[inside], j[inside]
        at = [self.rank[x // MODULUS * len(COVER) + _PLACE[x % MODULUS]] for x in (i, j)]
        low, high = np.minimum(*at), np.maximum(*at)
        level = np.zeros(len(low), np.int64)
        span = high - low
        for k in range(1, len(self.table)):
            level += span >= 1 << k
        rest = np.zeros(len(low), np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            row = self.table[k]
            rest[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << k)])
        found[on] += rest
        return found


def runs_of(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of texts (``begins``, ``sizes``) in one sequence, by start, then period.

    Between texts there must stand numbers that stand once.
    """
    long = sizes >= LEAST_LENGTH
    begins, sizes = begins[long], sizes[long]
    none = np.zeros(0, np.int64)
    if not len(sizes):
        return none, none, none
    right, left, n = Extensions(codes), Extensions(codes[::-1].copy()), len(codes)
    most = np.maximum(sizes // LEAST_EXPONENT, 1)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    grid = (LEAST_EXPONENT - 1) * period
    many = -(-(sizes[text] - period) // grid)
    found = []
    cuts = np.flatnonzero(np.diff(np.cumsum(many) // PAIRS)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(many)]):
        for q, x in _grid(begins[text[a:b]], period[a:b], grid[a:b], many[a:b]):
            same = codes[x] == codes[x + q]
            x, q = x[same], q[same]
            before = left(n - x, n - x - q)
            start, end = x - before, x + q + right(x, x + q)
            run = end - start >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q)
            found.append(np.stack([start[run], end[run], q[run]]))
    start, end, q = np.concatenate(found, 1)
    # A stretch is found for multiples of its period too.
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(end) != 0)]) if len(start) else np.zeros(0, bool)
    start, end, q = start[first], end[first], q[first]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def _grid(begin: np.ndarray, period: np.ndarray, grid: np.ndarray, many: np.ndarray):
    """(periods, places) to try, about ``PAIRS`` at once."""
    ends = np.cumsum(many)
    for a in range(0, int(ends[-1]) if len(ends) else 0, 2 * PAIRS):
        flat = np.arange(a, min(a + 2 * PAIRS, int(ends[-1])))
        row = np.searchsorted(ends, flat, side="right")
        yield period[row], begin[row] + (flat - (ends - many)[row]) * grid[row]


def analysed(texts: list[list[str]]):
    """For each text's words: (start, length, period) arrays of its runs, and the words that stay.

    Of a run its first period stays; a word goes if any run has it beyond that.
    """
    known: dict[str, int] = {}
    flat: list[int] = []
    sizes = np.array([len(words) for words in texts], np.int64)
    number = known.setdefault
    for words in texts:
        flat.extend([number(w, len(known) + 1) for w in words])
        flat.append(0)
    codes = np.array(flat, np.int32)
    parts = np.flatnonzero(codes == 0)
    codes[parts] = len(known) + 1 + np.arange(len(parts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    start, length, period = runs_of(codes, begins, sizes)
    change = np.zeros(len(codes) + 1, np.int32)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    gone = np.cumsum(change) > 0
    cuts = np.searchsorted(start, np.append(begins, len(codes)))
    for k, words in enumerate(texts):
        a, b, at = cuts[k], cuts[k + 1], int(begins[k])
        kept = words if a == b else [w for w, out in zip(words, gone[at : at + len(words)].tolist()) if not out]
        yield start[a:b] - at, length[a:b], period[a:b], kept


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed`` has the words that stay, joined by one space. ``rewrite`` changes a document's
    words first. Null and blank texts have no words and no runs; null ids stay null; repeated rows
    give repeated results; other columns are ignored; an empty table gives no rows.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, done = batch.column(0).to_pylist(), 0
            for some in chunks([t or "" for t in batch.column(1).to_pylist()], CHUNK_CHARS):
                words = [_WORDS(t) for t in some]
                if rewrite:
                    words = [rewrite(i, w) for i, w in zip(ids[done : done + len(some)], words)]
                found = list(analysed(words))
                flat = [np.concatenate([f[k] for f in found]) for k in range(3)]
                ends = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], fields=list(run_type)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(some)), pa.array([len(w) for w in words], pa.int64()), runs, pa.array([" ".join(f[3]) for f in found], pa.string())],
                                                 names=["doc_id", "n_words", "runs", "collapsed"])
                done += len(some)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def collapse(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of each row with its repetitions collapsed; edge cases as in ``periodic_runs``."""
    return periodic_runs(docs).select("doc_id", F.col("collapsed").alias("text"))


def with_planted_tail(doc_id: int | None, words: list[str]) -> list[str]:
    """A document's words; of about every tenth, by its id, the words from some place on are periodic. A null id plants nothing."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    once = words[a : a + p]
    return words[:a] + (once * (-(-(n - a) // p)))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), with_planted_tail)
    # Exponents are compared by products; of equal ones the first counts.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256", "n_words")
