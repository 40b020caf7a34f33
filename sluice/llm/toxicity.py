"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word is the mean of hashed rows for itself and for its first letters; filters of several widths
run over the words of the whole text and are max-pooled; a linear layer gives the logit. All
labelled rows train it, with their whole texts: Spark deals them into shards, each shard's task
makes its steps from the same start, and the mean of what the shards moved is the model. Thresholds
are calibrated by language on the scores of all these rows; the language is told from the text's own
function words, never from a column.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, release, slices, table, tidy
from .labelled import held_out, known_labels
from .token_counts import chunks

SHARD_ROWS, SHARD_CHARS = 12_000, 40_000_000  # of a shard, about, at most; more rows make more shards
UNIT = 1 << 30  # what shards move is summed in whole numbers of 1 / UNIT: the order doesn't matter
GRID = 1000  # thresholds are told apart by 1 / GRID
BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
PREFIXES = (3, 4, 5)
PAD = max(WIDTHS) - 1
EPOCHS, LEAST_STEPS, BATCH, RATE = 2, 300, 64, 0.02
SPAN = 60_000  # words scored at once
MEMO_WORDS = 120_000  # words whose projections a worker keeps

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on are with as be this by from or".split(),
    "de": "der die und das ist nicht ein eine zu den mit sich von für auf dem auch werden".split(),
    "fr": "le la les de des et un une du que est pour dans qui par sur avec au".split(),
    "es": "el la los de que y en un las por con una para del se no su al".split(),
}

_WORD = re.compile(r"[^\W\d_]+")
_WORDS = _WORD.findall
_SLOTS = [(k, o) for k in WIDTHS for o in range(k)]


@lru_cache(maxsize=1 << 16)
def _start_row(n: int, start: str) -> int:
    return zlib.crc32(f"{n}:{start}".encode("utf-8", "surrogatepass")) % BUCKETS


def features(word: str) -> list[int]:
    """Hashed rows of a word: itself and its first letters."""
    return [zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS] + [_start_row(n, word[:n]) for n in PREFIXES]


def packed(word: str) -> int:
    """A word's hashed rows in one number, 16 bits each."""
    a, b, c, d = features(word)
    return a | b << 16 | c << 32 | d << 48


NO_WORD = (1 << 64) - 1  # padding: no word's number, as BUCKETS is below 1 << 16
_BITS = np.arange(0, 16 * (1 + len(PREFIXES)), 16, dtype=np.uint64)


def unpacked(codes: np.ndarray) -> np.ndarray:
    return ((codes[:, None] >> _BITS) & np.uint64(0xFFFF)).astype(np.int64)


LANGUAGES = sorted(FUNCTION_WORDS)


def speaks(word: str) -> list[int]:
    """Which languages count the word among their function words."""
    return [int(word in FUNCTION_WORDS[code]) for code in LANGUAGES]


_SPOKEN = {w: sum(1 << k for k, hit in enumerate(speaks(w)) if hit) for some in FUNCTION_WORDS.values() for w in some}


@dataclass
class Cnn:
    rows: np.ndarray  # BUCKETS x DIMS
    filters: np.ndarray  # DIMS x (slots * FILTERS)
    bias: np.ndarray  # widths * FILTERS
    out: np.ndarray
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 7) -> Cnn:
        rng = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        return Cnn(rng.normal(0, 0.1, (BUCKETS, DIMS)).astype(np.float32),
                   rng.normal(0, 0.3, (DIMS, len(_SLOTS) * FILTERS)).astype(np.float32),
                   np.zeros(n, np.float32), rng.normal(0, 0.3, n).astype(np.float32))

    def project(self, rows: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each of its places.

        Summed column by column in doubles: a matrix product's last bits depend on a row's place in its batch.
        """
        words = sum(self.rows[rows[:, k]].astype(np.float64) for k in range(rows.shape[1])) / rows.shape[1]
        total = np.zeros((len(rows), self.filters.shape[1]))
        for d in range(DIMS):
            total += words[:, d : d + 1] * self.filters[d].astype(np.float64)
        return total

    def values(self, seen: np.ndarray) -> list[np.ndarray]:
        """Filter values at each word, from the words' projections."""
        values = []
        for k, width in enumerate(WIDTHS):
            total = np.tile(self.bias[k * FILTERS : (k + 1) * FILTERS], (len(seen), 1))
            for slot, (w, o) in enumerate(_SLOTS):
                if w == width:
                    total[: len(seen) - o] += seen[o:, slot * FILTERS : (slot + 1) * FILTERS]
            values.append(total)
        return values

    def pool(self, seen: np.ndarray, begins: np.ndarray):
        """Filter values at each word and their largest of each text.

        A text ends in PAD + 1 pads; windows that start at the last PAD of them would reach the next text.
        """
        values = self.values(seen)
        beyond = (np.append(begins[1:], len(seen))[:, None] - np.arange(1, PAD + 1)).ravel()
        for v in values:
            v[beyond] = -np.inf
        return values, np.concatenate([np.maximum.reduceat(v, begins) for v in values], 1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        """Logit of each pooled row; summed filter by filter in doubles, as in ``project``."""
        total = np.full(len(pooled), float(self.shift))
        for k in range(pooled.shape[1]):
            total += np.maximum(pooled[:, k], 0).astype(np.float64) * float(self.out[k])
        return total

    def winners(self, codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest filter values of each text and where their windows start; ``SPAN`` words at a time, however long a text is."""
        ends = np.append(begins[1:], len(codes))
        tops = np.full((len(begins), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        places = np.zeros(tops.shape, np.int64)
        for a in range(0, len(codes), SPAN):
            b = min(a + SPAN, len(codes))
            values = self.values((lambda used, local: (self.embed(used) @ self.filters)[local])(*np.unique(codes[a : b + PAD], return_inverse=True)))
            for i in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(begins, b, "left"))):
                # The windows that start at a text's last PAD pads reach the next text.
                x, y = max(begins[i], a) - a, min(ends[i] - PAD, b) - a
                if x >= y:
                    continue
                best = np.concatenate([v[x:y].argmax(0) + x for v in values])
                top = np.concatenate([v[p, np.arange(FILTERS)] for v, p in zip(values, best.reshape(len(WIDTHS), FILTERS))])
                new = top > tops[i]
                tops[i, new], places[i, new] = top[new], best[new] + a
        return tops, places

    def embed(self, codes: np.ndarray) -> np.ndarray:
        """Mean row of each word; padding is zero."""
        there = codes != NO_WORD
        words = np.zeros((len(codes), DIMS), np.float32)
        rows = unpacked(codes[there])
        words[there] = sum(self.rows[rows[:, k]] for k in range(rows.shape[1])) / np.float32(rows.shape[1])
        return words

    def step(self, codes, begins, labels, weights, past: dict) -> None:
        """One Adagrad step on a batch; only the windows that won the pooling carry gradients."""
        pooled, places = self.winners(codes, begins)
        off = (1 / (1 + np.exp(-np.clip(self.logits(pooled), -30, 30))) - labels) * weights / len(labels)
        back = (np.outer(off, self.out) * (pooled > 0)).astype(np.float32)
        wide = {w: slice(k * FILTERS, (k + 1) * FILTERS) for k, w in enumerate(WIDTHS)}
        at = np.stack([codes[places[:, wide[w]] + o] for w, o in _SLOTS])
        won, local = np.unique(at, return_inverse=True)
        local = local.reshape(at.shape)
        flat = np.zeros((len(won), len(_SLOTS), FILTERS), np.float32)
        for slot, (w, _) in enumerate(_SLOTS):
            np.add.at(flat[:, slot], (local[slot], np.arange(FILTERS)), back[:, wide[w]])
        flat = flat.reshape(len(won), -1)
        words = self.embed(won)
        moved = np.flatnonzero(flat.any(1) & (won != NO_WORD))
        n = 1 + len(PREFIXES)
        touched, where = np.unique(unpacked(won[moved]).ravel(), return_inverse=True)
        sparse = np.zeros((len(touched), DIMS), np.float32)
        np.add.at(sparse, where.reshape(-1, n), (flat[moved] @ self.filters.T / n)[:, None, :])
        for name, grad in (("filters", words.T @ flat), ("bias", back.sum(0)), ("out", np.maximum(pooled, 0).T @ off)):
            past[name] = past.get(name, 1e-6) + grad**2
            setattr(self, name, (getattr(self, name) - RATE * grad / np.sqrt(past[name])).astype(np.float32))
        past["shift"] = past.get("shift", 1e-6) + off.sum() ** 2
        self.shift -= float(RATE * off.sum() / np.sqrt(past["shift"]))
        seen = past.setdefault("rows", np.full((BUCKETS, DIMS), 1e-6, np.float32))
        seen[touched] += sparse**2
        self.rows[touched] -= RATE * 2 * sparse / np.sqrt(seen[touched])

    def lines(self) -> np.ndarray:
        """All that is learnt, as lines of DIMS numbers: the word rows, then the rest."""
        rest = np.concatenate([self.filters.ravel(), self.bias, self.out, [self.shift]]).astype(np.float64)
        return np.concatenate([self.rows.astype(np.float64), np.pad(rest, (0, -len(rest) % DIMS)).reshape(-1, DIMS)])

    @staticmethod
    def of_lines(lines: np.ndarray) -> Cnn:
        n, rest = len(WIDTHS) * FILTERS, lines[BUCKETS:].ravel()
        cuts = np.cumsum([DIMS * len(_SLOTS) * FILTERS, n, n])
        filters, bias, out, shift = np.split(rest[: cuts[-1] + 1].astype(np.float32), cuts)
        return Cnn(lines[:BUCKETS].astype(np.float32), filters.reshape(DIMS, -1), bias, out, float(shift[0]), {"*": 0.0})


class Scorer:
    """Scores whole texts; projections of frequent words are kept up to a bound."""

    def __init__(self, model: Cnn):
        self.model = model
        self.codes: dict[str, int] = {"": 0}
        self.wide = len(_SLOTS) * FILTERS
        # Per word: its projection, then the languages it speaks for. Row 0 is padding.
        self.table = np.zeros((MEMO_WORDS + 1024, self.wide + len(LANGUAGES)), np.float32)
        self.limits = np.array([model.thresholds.get(c, model.thresholds.get("*", 0.0)) for c in [*LANGUAGES, "*"]])

    def describe(self, words: list[str]) -> np.ndarray:
        rows = unpacked(np.fromiter(map(packed, words), np.uint64, len(words)))
        spoken = np.fromiter((_SPOKEN.get(w, 0) for w in words), np.int64, len(words))
        return np.concatenate([self.model.project(rows), spoken[:, None] >> np.arange(len(LANGUAGES)) & 1], 1)

    def logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each text and the place of its language in ``LANGUAGES`` (the last: unknown)."""
        codes, begins, fresh, get = [], [], {}, self.codes.get
        first = len(self.codes)
        for words in texts:
            begins.append(len(codes))
            for w in words:
                code = get(w)
                if code is None:
                    code = fresh.get(w)
                    if code is None:
                        code = fresh[w] = first + len(fresh)
                codes.append(code)
            codes.extend([0] * (PAD + 1))
        need = first + len(fresh)
        if need > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((need - len(self.table) + 1024, self.table.shape[1]), np.float32)])
        self.table[first:need] = self.describe(list(fresh))
        if first < MEMO_WORDS:
            self.codes.update((w, c) for w, c in fresh.items() if c < MEMO_WORDS)
        begins = np.array(begins, np.int64)
        codes = np.array(codes, np.int64)
        tops, spoken = [], []
        # A very long text is taken in spans that overlap by the padding; its maxima are joined.
        owner = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(codes))))
        beyond = np.zeros(len(codes), bool)
        beyond[(np.append(begins[1:], len(codes))[:, None] - np.arange(1, PAD + 1)).ravel()] = True
        for a in range(0, len(codes), SPAN):
            part = self.table[codes[a : a + SPAN + PAD]]
            mine = owner[a : a + SPAN]
            cuts = np.flatnonzero(np.diff(mine, prepend=-1))
            values = self.model.values(part[:, : self.wide])
            for v in values:
                v[: len(mine)][beyond[a : a + SPAN]] = -np.inf
            tops.append((mine[cuts], np.concatenate([np.maximum.reduceat(v[: len(mine)], cuts) for v in values], 1)))
            spoken.append(np.add.reduceat(part[: len(mine), self.wide :], cuts))
        pooled = np.full((len(begins), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        heard = np.zeros((len(begins), len(LANGUAGES)))
        for (who, top), said in zip(tops, spoken):
            pooled[who] = np.maximum(pooled[who], top)
            heard[who] += said
        return self.model.logits(pooled), np.where(heard.any(1), heard.argmax(1), len(LANGUAGES))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each whole text: its language's threshold is 0.5."""
        out = []
        for logits, spoken in self.heard(texts):
            out.extend(1 / (1 + math.exp(-x)) for x in np.clip(logits - self.limits[spoken], -30, 30).tolist())
        return np.array(out, np.float64)

    def heard(self, texts: list[str | None]):
        """Logits and languages of whole texts, a run of them at a time."""
        for run in chunks([t or "" for t in texts], SPAN * 5):
            yield self.logits([_WORDS(t.lower()) for t in run])


def best_threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """Logit that parts the labels with the highest F1; the middle of the gap it falls into.

    With ``counts``, a place stands for so many rows and ``labels`` says how many of them are 1.
    """
    order = np.argsort(-logits, kind="stable")
    ranked, hit = logits[order], labels[order]
    there = np.arange(1, len(hit) + 1) if counts is None else np.cumsum(counts[order])
    f1 = 2 * np.cumsum(hit) / (there + hit.sum())
    k = int(np.argmax(f1))
    return float((ranked[k] + ranked[k + 1]) / 2) if k + 1 < len(ranked) else float(ranked[k] - 1)


def constant(rows: int, ones: int) -> Cnn | None:
    """The model of rows that are too few, or all have one label."""
    if rows >= 8 and 0 < ones < rows:
        return None
    model = Cnn.fresh()
    model.thresholds = {"*": 0.0}
    model.shift = 3.0 if rows and ones == rows else -3.0
    model.out[:] = 0
    return model


def shards_of(rows: int, chars: int) -> int:
    """So many shards that none has many more rows or characters than a shard may have."""
    return max(1, -(-rows // SHARD_ROWS), -(-chars // SHARD_CHARS))


class Shard:
    """Labelled texts of a shard as numbers of their words, and what training on them moves."""

    def __init__(self):
        self.coded, self.labels, self.memo = [], [], {}

    def code(self, word: str) -> int:
        found = self.memo.get(word)
        if found is None:
            found = packed(word)
            if len(self.memo) < MEMO_WORDS:
                self.memo[word] = found
        return found

    def add(self, text: str, label: int) -> None:
        lowered = text.lower()
        # The words of a very long text aren't in memory at once, only their numbers.
        words = _WORDS(lowered) if len(lowered) < 1 << 20 else (m[0] for m in _WORD.finditer(lowered))
        codes = np.fromiter(map(self.code, words), np.uint64)
        self.coded.append(np.append(codes, np.full(PAD + 1, NO_WORD, np.uint64)))
        self.labels.append(label)

    def moves(self, weight: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the lines that training moves, and by how many units."""
        self.memo.clear()
        model = Cnn.fresh(seed)
        before = model.lines()
        labels = np.array(self.labels, np.float32)
        weights = np.where(labels == 1, weight, 1).astype(np.float32)
        rng, past = np.random.default_rng(seed), {}
        for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(labels)))):
            for part in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // BATCH)):
                some = [self.coded[i] for i in part]
                model.step(np.concatenate(some), np.cumsum([0, *map(len, some[:-1])]), labels[part], weights[part], past)
        units = np.rint((model.lines() - before) * UNIT).astype(np.int64)
        moved = np.flatnonzero(units.any(1) | (np.arange(len(units)) >= BUCKETS))
        return moved, units[moved]


def averaged(sums: np.ndarray, counts: np.ndarray, seed: int) -> Cnn:
    """The start and the mean of what was moved, line by line over the shards that moved it."""
    return Cnn.of_lines(Cnn.fresh(seed).lines() + sums / (np.maximum(counts, 1)[:, None] * float(UNIT)))


def places(logits: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(logits, -30, 30) * GRID).astype(np.int32)


def calibrate(model: Cnn, seen: np.ndarray) -> Cnn:
    """Thresholds from (language, place, rows, rows with label 1): all rows, counted."""
    for k, code in [*enumerate(LANGUAGES), (None, "*")]:
        mine = seen[seen[:, 0] == k] if k is not None else seen
        where, inverse = np.unique(mine[:, 1], return_inverse=True)
        counts, ones = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
        np.add.at(counts, inverse, mine[:, 2])
        np.add.at(ones, inverse, mine[:, 3])
        if counts.sum() >= 30 and 5 <= ones.sum() < counts.sum():
            model.thresholds[code] = best_threshold((where + 0.5) / GRID, ones, counts)
    return model


def fit(rows: list[tuple[int, str, int]], seed: int = 7) -> Cnn:
    """What ``train`` gives for labelled rows (doc_id, text, label), on a list of them."""
    rows = [(zlib.crc32(f"{i}\n{t or ''}".encode("utf-8", "surrogatepass")), i, (t or "").encode("utf-8", "surrogatepass"), t or "", y) for i, t, y in rows]
    ones = sum(r[4] for r in rows)
    if (model := constant(len(rows), ones)) is not None:
        return model
    n, weight = shards_of(len(rows), sum(len(r[3]) for r in rows)), math.sqrt((len(rows) - ones) / ones)
    dealt: dict[int, Shard] = {}
    for place, _, _, text, label in sorted(rows):
        dealt.setdefault(place % n, Shard()).add(text, label)
    sums, counts = nothing()
    for shard in dealt.values():
        moved, units = shard.moves(weight, seed)
        sums[moved] += units
        counts[moved] += 1
    model, seen, labels = averaged(sums, counts, seed), Counter(), iter([r[4] for r in rows])
    for logits, spoken in Scorer(model).heard([r[3] for r in rows]):
        for k, p in zip(spoken.tolist(), places(logits).tolist()):
            seen[k, p, next(labels)] += 1
    return calibrate(model, np.array([(k, p, c, c * y) for (k, p, y), c in seen.items()], np.int64))


def nothing() -> tuple[np.ndarray, np.ndarray]:
    """For each line of a model: no units, moved by no shard."""
    shape = Cnn.fresh().lines().shape
    return np.zeros(shape, np.int64), np.zeros(shape[0], np.int64)


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = 400_000) -> DataFrame:
    """All rows to learn from, with whole texts (null: empty): text, doc_id, label, characters and a hash of id and text.

    Up to ``most`` labels are sent to every task, so that ``docs`` isn't shuffled; more are joined by shuffle.
    """
    known = known_labels(labels, "toxic")
    known = F.broadcast(known) if known.count() <= most else known
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    found = texts.join(known, "doc_id")
    return found.select("text", "doc_id", "label", F.length("text").alias("chars"), F.crc32(F.concat_ws("\n", F.col("doc_id").cast("string"), "text")).alias("place"))


def learn(batches, weight: float, seed: int):
    """What each shard moves, line by line; its rows (text, label, shard) stand together."""

    def told(shard: Shard):
        moved, units = shard.moves(weight, seed)
        return pa.RecordBatch.from_arrays([pa.array(moved.astype(np.int32)), *(pa.array(units[:, d].copy()) for d in range(DIMS))], names=["line", *(f"d{d}" for d in range(DIMS))])

    at, shard = None, None
    for batch in batches:
        for rows, texts in slices(batch, 0, SPAN * 5):
            for text, label, k in zip(texts, rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                if k != at:
                    if shard is not None:
                        yield told(shard)
                    at, shard = k, Shard()
                shard.add(text, label)
    if shard is not None:
        yield told(shard)


def hear(batches, model: Cnn):
    """Language, place on the grid and label of each row (text, label)."""
    scorer = Scorer(model)
    for batch in batches:
        for rows, texts in slices(batch, 0, SPAN * 5):
            at = 0
            for logits, spoken in scorer.heard(texts):
                yield pa.RecordBatch.from_arrays([pa.array(spoken.astype(np.int32)), pa.array(places(logits)), rows.column(1).slice(at, len(logits))], names=["spoken", "at", "label"])
                at += len(logits)


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Cnn:
    """The model of all labelled rows; what reaches the driver is of the model's size, however many there are."""
    rows = cut(labelled_rows(docs, labels))
    there = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"), F.sum("chars").alias("chars")).first()
    if (model := constant(there["n"], there["ones"] or 0)) is None:
        n, weight = shards_of(there["n"], there["chars"]), math.sqrt((there["n"] - there["ones"]) / there["ones"])
        dealt = rows.select("text", "label", (F.col("place") % n).cast("int").alias("shard"), "place", "doc_id").repartitionById(n, "shard")
        dealt = dealt.sortWithinPartitions("shard", "place", "doc_id", "text").select("text", "label", "shard")
        moved = dealt.mapInArrow(tidy(partial(learn, weight=weight, seed=seed)), "line int, " + ", ".join(f"d{d} long" for d in range(DIMS)))
        moved = moved.groupBy("line").agg(F.count(F.lit(1)).alias("shards"), *(F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS))).toArrow()
        sums, counts = nothing()
        lines = moved.column("line").to_numpy()
        counts[lines] = moved.column("shards").to_numpy()
        sums[lines] = np.stack([moved.column(f"d{d}").to_numpy() for d in range(DIMS)], 1)
        model = averaged(sums, counts, seed)
        seen = rows.select("text", "label").mapInArrow(tidy(partial(hear, model=model)), "spoken int, at int, label int")
        seen = seen.groupBy("spoken", "at").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).toArrow()
        calibrate(model, np.stack([seen.column(c).to_numpy() for c in ("spoken", "at", "n", "ones")], 1).astype(np.int64))
    release(rows)
    return model


def score_toxicity(docs: DataFrame, model: Cnn) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (score >= 0.5).

    Null is empty, null ids stay null; repeated rows give repeated results; other columns are
    ignored; an empty table gives no rows.
    """

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for rows, texts in slices(batch, 1, SPAN * 5):
                score = scorer.scores(texts)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "score", "predicted"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tidy(run), "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Cnn) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns; edge cases as in ``score_toxicity``."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for rows, texts in slices(batch, at, SPAN * 5):
                yield rows.filter(pa.array(scorer.scores(texts) < 0.5))

    return docs.mapInArrow(tidy(run), docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
