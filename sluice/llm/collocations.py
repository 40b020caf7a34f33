"""Collocations: phrases of two and three words that stand together more often than apart.

Texts are read once: a task gathers them by language into chunks of bounded size, whose words become
numbers by frequency (0 parts pieces), and writes each chunk as its numbers and its words. Pairs of
neighbours are counted in tiles of the plane of word numbers: tiles that hold many are counted by
direct address (``bincount``), the others as sorted coordinates. The pairs that may be frequent
are then numbered by frequency in turn and counted against the word that follows, by the same tiles.
A chunk's counts are summed by ordinary aggregation, so no phrase, language or tile meets in one task.

Which words and pairs may be frequent is told by bitmaps of fixed size; what they let through
wrongly is counted too and left out by its sum, so all counts are exact.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, release, table

LEAST = 10  # occurrences of a candidate
LONGEST = 3  # words of a candidate
TOP = 2_000  # candidates of a language that are returned
COVERED = 50  # percent of a phrase's occurrences inside a longer one from which it is left out
SALTS = 64  # parts of a language that are ranked apart at first
CHUNK_BYTES = 4_000_000  # bytes of text that are counted at once
TILE = 1 << 9  # a tile has TILE x TILE places
DENSE = TILE * TILE // 16  # entries from which a tile is counted by direct address
WORD_BITS, PAIR_BITS = 24, 27  # bits of the bitmaps, as powers of two
_SECTOR = 1 << 15  # bits of one row of Spark's bitmap aggregate

_TOKENS = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]").findall
_BORDERS = frozenset(b".,;:!?\x0a\x0b\x0c\x0d")
#: Odd multipliers of word hashes by place.
_FACTORS = (0x2545F491, 0x1B873593, 0x165667B1)


class _Numbers(dict):
    """Word -> number in order of appearance; 0 for what parts pieces."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, token: bytes) -> int:
        if token[0] in _BORDERS:
            number = 0
        else:
            self.words.append(token)
            number = len(self.words)
        self[token] = number
        return number


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers of all texts in a row (parted by 0), the words by number (from 1), and their counts; frequent words first."""
    known = _Numbers()
    tokens = _TOKENS(b"\n".join(texts).lower())  # of bytes: A-Z alone
    codes = np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
    counts = np.bincount(codes, minlength=len(known.words) + 1)[1:]
    order = np.argsort(-counts, kind="stable")
    rank = np.zeros(len(order) + 1, np.int32)
    rank[order + 1] = np.arange(1, len(order) + 1)
    return rank[codes], [known.words[k] for k in order.tolist()], counts[order]


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers and how often each stands, by tiles of the plane."""
    if not len(left):
        return (np.zeros(0, np.int64),) * 3
    left, right = left.astype(np.int64), right.astype(np.int64)
    wide = int(right.max()) // TILE + 1
    tile = left // TILE * wide + right // TILE
    place = left % TILE * TILE + right % TILE
    order = np.argsort(tile, kind="stable")
    tile, place = tile[order], place[order]
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(tile) != 0]))
    ends = np.append(cuts[1:], len(tile))
    found = []
    dense = ends - cuts >= DENSE
    for a, b in zip(cuts[dense].tolist(), ends[dense].tolist()):
        counts = np.bincount(place[a:b], minlength=TILE * TILE)
        there = np.flatnonzero(counts)
        found.append((np.full(len(there), tile[a]), there, counts[there]))
    # All sparse tiles together: their coordinates in order.
    loose = ~np.repeat(dense, ends - cuts)
    if loose.any():
        keys = np.sort(tile[loose] * (TILE * TILE) + place[loose])
        first = np.flatnonzero(np.concatenate([[True], np.diff(keys) != 0]))
        found.append((keys[first] // (TILE * TILE), keys[first] % (TILE * TILE), np.diff(np.append(first, len(keys)))))
    tile, place, count = (np.concatenate(x) for x in zip(*found))
    return tile // wide * TILE + place // TILE, tile % wide * TILE + place % TILE, count


def _in(whole: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    """Which words, or pairs of words, by the words' checksums, a bitmap has; their places equal ``_slot``."""
    mixed = sum((h % (1 << 31)) * f for h, f in zip(hashes, _FACTORS))
    slots = (mixed >> 17) % (8 * len(whole))
    return (whole[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0


def _slot(columns: list[str], bits: int) -> Column:
    mixed = sum((F.crc32(F.col(c).cast("binary")) % (1 << 31) * F.lit(f) for c, f in zip(columns, _FACTORS)), F.lit(0))
    return F.shiftright(mixed.cast("long"), 17) % F.lit(1 << bits)


def bitmap(rows: DataFrame, columns: list[str], bits: int) -> np.ndarray:
    """Which places of a bitmap the rows take; 2^bits bits whatever the number of rows."""
    slots = rows.select((_slot(columns, bits) + 1).alias("slot"))
    sectors = slots.groupBy(F.expr("bitmap_bucket_number(slot)").alias("sector")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for sector, packed in sectors.collect():  # at most 2^bits / _SECTOR rows of 4 KB
        at = (sector - 1) * (_SECTOR // 8)
        whole[at : at + len(packed)] = np.frombuffer(packed, np.uint8)
    return whole


def chunked(docs: DataFrame) -> DataFrame:
    """Texts as chunks of bounded size: lang, codes (32-bit numbers), words (by number, from 1), counts."""

    def written(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        codes, words, counts = numbered(texts)
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([codes.tobytes()], pa.binary()), pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
                                           pa.array([counts.tolist()], pa.list_(pa.int64()))], names=["lang", "codes", "words", "counts"])

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 64
                if size[lang] >= CHUNK_BYTES:
                    yield written(lang, held.pop(lang))
                    del size[lang]
            if sum(size.values()) >= 2 * CHUNK_BYTES:  # many languages
                for lang in sorted(held):
                    yield written(lang, held.pop(lang))
                size.clear()
        for lang in sorted(held):
            yield written(lang, held.pop(lang))

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, codes binary, words array<string>, counts array<long>")


def _neighbours(codes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Places whose word and next word may both be frequent."""
    good = frequent[codes]
    return np.flatnonzero(good[:-1] & good[1:])


def _frequent(words: list[bytes], words_map: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Checksums of the words by number, and which numbers may be frequent (0 never is)."""
    sums = np.array([0, *map(zlib.crc32, words)], np.int64)
    good = _in(words_map, [sums])
    good[0] = False
    return sums, good


def phrase_counts(chunks: DataFrame, size: int, words_map, pairs_map=None) -> DataFrame:
    """Counts of a chunk's phrases of two or three words that may be frequent: lang, w1, w2 (, w3), c; summed over chunks.

    The maps are broadcast variables.
    """
    names = [f"w{k}" for k in range(1, size + 1)]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):  # one chunk at a time: a batch may hold many
                lang, codes, words = (batch.column(k)[row].as_py() for k in range(3))
                codes = np.frombuffer(codes, np.int32)
                if len(codes) < size:
                    continue
                sums, good = _frequent([w.encode() for w in words], words_map.value)
                at = _neighbours(codes, good)
                if size == 3:
                    inside = _in(pairs_map.value, [sums[codes[at]], sums[codes[at + 1]]])
                    at = at[inside]
                    pair = np.zeros(len(codes), bool)
                    pair[at] = True
                    at = at[pair[at + 1]]
                    # The pairs in turn are numbered by frequency.
                    a, b, c = tile_counts(codes[at], codes[at + 1])
                    order = np.argsort(-c, kind="stable")
                    a, b = a[order], b[order]
                    keys = a * len(sums) + b
                    by_key = np.argsort(keys)
                    mine = by_key[np.searchsorted(keys, codes[at].astype(np.int64) * len(sums) + codes[at + 1], sorter=by_key)]
                    p, last, c = tile_counts(mine, codes[at + 2])
                    columns = [a[p], b[p], last]
                else:
                    a, b, c = tile_counts(codes[at], codes[at + 1])
                    columns = [a, b]
                dictionary = pa.array(["", *words], pa.string())
                for k in range(0, len(c), 100_000):
                    part = slice(k, k + 100_000)
                    n = len(c[part])
                    phrase = pc.binary_join_element_wise(*[dictionary.take(pa.array(x[part])) for x in columns], " ")
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), phrase, pa.array(c[part], pa.int64())], names=["lang", "phrase", "c"])

    found = chunks.select("lang", "codes", "words").mapInArrow(run, "lang string, phrase string, c long")
    # A chunk has counted its phrases already: dealt out at once, they need no table of a task's own. A phrase has one row a chunk.
    found = found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("c").alias("a")).where(F.col("a") >= LEAST)
    words_ = F.split("phrase", " ")
    return found.select("lang", *[F.get(words_, k).alias(n) for k, n in enumerate(names)], "a")


def _score(a: str, low: str, rest: str) -> Column:
    """floor(1000000 a a / (l r)) exactly: by 38 decimal digits, for counts below 10^15."""
    return F.expr(f"(cast({a} as decimal(16,0)) * cast({a} as decimal(15,0)) * cast(1000000 as decimal(7,0))) div (cast({low} as decimal(16,0)) * cast({rest} as decimal(16,0)))")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends; null texts are empty, a null
    lang is ``und``; ids aren't read, repeated rows count each, other columns are ignored; an empty
    table gives no rows. A candidate stands ``LEAST`` times at least. Its score is of its weakest
    cut (ties: the first). Those mostly inside a longer candidate are left out.
    """
    spark = docs.sparkSession
    chunks = cut(chunked(docs))
    counted = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    words = cut(counted)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= LEAST).select("lang", "word", "f")
    words_map = spark.sparkContext.broadcast(bitmap(frequent, ["word"], WORD_BITS))
    pairs = cut(phrase_counts(chunks, 2, words_map))
    pairs_map = spark.sparkContext.broadcast(bitmap(pairs, ["w1", "w2"], PAIR_BITS))
    triples = cut(phrase_counts(chunks, 3, words_map, pairs_map))
    release(chunks)

    def of(frame: DataFrame, word: str, name: str) -> DataFrame:
        return frame.join(frequent.select("lang", F.col("word").alias(word), F.col("f").alias(name)), ["lang", word])

    def pair(frame: DataFrame, first: str, second: str, name: str) -> DataFrame:
        return frame.join(pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name)), ["lang", first, second])

    inner = triples.where(F.col("a") >= LEAST).select("lang", "a", F.explode(F.array(F.struct(F.col("w1").alias("w1"), F.col("w2").alias("w2")), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    longest = inner.groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer"))
    alone = pairs.join(longest, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a")))
    two = of(of(alone, "w1", "l"), "w2", "r").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = pair(pair(of(of(triples, "w1", "l1"), "w3", "r2"), "w2", "w3", "r1"), "w1", "w2", "l2")
    cut1, cut2 = _score("a", "l1", "r1"), _score("a", "l2", "r2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l1", "r1", "l2", "r2", cut1.alias("s1"), cut2.alias("s2"))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language's candidates are ranked in parts first, so that one task gets SALTS x top of them at most.
    parted = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    result = cut(ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))
    for done in (words, pairs, triples):
        release(done)
    return result


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
with pieces as (
  select row_number() over () as piece, lang, regexp_extract_all(p, '[^\x20\x09]+') as w
  from (select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
        from documents)),
words as (select lang, piece, w, unnest(range(1, len(w) + 1)) as i from pieces),
singles as (select lang, w[i] as w1, count(*) as f from words group by all),
totals as (select lang, cast(sum(f) as bigint) as n from singles group by lang),
pairs as (select lang, w[i] as w1, w[i + 1] as w2, count(*) as a from words where i + 1 <= len(w) group by all having count(*) >= 10),
triples as (select lang, w[i] as w1, w[i + 1] as w2, w[i + 2] as w3, count(*) as a from words where i + 2 <= len(w) group by all having count(*) >= 10),
longest as (select lang, w1, w2, max(a) as longer from (select lang, w1, w2, a from triples union all select lang, w2, w3, a from triples) group by all),
two as (
  select p.lang, p.w1 || ' ' || p.w2 as phrase, p.a, x.f as l, y.f as r,
         cast((1000000::hugeint * p.a * p.a) // (x.f::hugeint * y.f) as bigint) as score
  from pairs p join singles x on x.lang = p.lang and x.w1 = p.w1 join singles y on y.lang = p.lang and y.w1 = p.w2
  left join longest g on g.lang = p.lang and g.w1 = p.w1 and g.w2 = p.w2
  where longer is null or 100 * longer < 50 * p.a),
cuts as (
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 as phrase, t.a, x.f as l1, b.a as r1, c.a as l2, y.f as r2,
         cast((1000000::hugeint * t.a * t.a) // (x.f::hugeint * b.a) as bigint) as s1,
         cast((1000000::hugeint * t.a * t.a) // (c.a::hugeint * y.f) as bigint) as s2
  from triples t join singles x on x.lang = t.lang and x.w1 = t.w1 join singles y on y.lang = t.lang and y.w1 = t.w3
  join pairs b on b.lang = t.lang and b.w1 = t.w2 and b.w2 = t.w3 join pairs c on c.lang = t.lang and c.w1 = t.w1 and c.w2 = t.w2),
three as (
  select lang, phrase, a, case when s1 <= s2 then l1 else l2 end as l, case when s1 <= s2 then r1 else r2 end as r, least(s1, s2) as score from cuts),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from (select * from two union all select * from three))
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
