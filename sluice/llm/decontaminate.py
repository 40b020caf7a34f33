"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question with other parameters has
the same template. Windows of template words are hashed and joined with the benchmark's; along
each alignment of a document with an item the slot values must map one to one. A document is
contaminated if windows of consistent alignments cover enough of an item, or hold a long run.
Windows with few literal words count too, where all slots agree or the words are equal. Whether a
capitalised word is a name is told in three ways, and each is compared by itself.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_name, slices, table, tidy, without

WINDOW = 5  # template words
LONG_WINDOW = 13  # one such window is enough
LEAST_WORDS = 4  # words of an item that is looked for at least; one under WINDOW words must stand whole, word by word
LEAST_COVER = 0.8  # share of an item's windows otherwise
BROADCAST_WINDOWS = 1_000_000  # benchmark windows up to which they are sent to every task
MAP_BITS = 27  # bits, as a power of two, of the map of hashes that is sent instead of more windows
CHUNK_CHARS = 1_000_000

# Unit words.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ton tons ounce ounces "
    "ml l liter liters litre litres gallon gallons ms s sec min h hr second seconds minute minutes "
    "hour hours day days week weeks month months year years percent dollar dollars euro euros cent "
    "cents usd eur degree degrees kmh mph".split())

# Function words that start sentences and aren't names.
COMMON = frozenset(
    "a an the this that these those he she it we you they i his her its our your their there here what which who whom "
    "whose when where why how if is are was were do does did has have had can could should would not no and or but so "
    "then for from in on at by to of with as after before while during each every all some how find "
    "der die das ein eine und ist wie was wer wo im in le la les un une des et est que qui el los las una y es".split())

_TOKENS = re.compile(r"\d(?:[\d.,]*\d)?|[^\W\d_]+|[.!?:\n]").findall
_LITERAL, _TITLE, _END, _NUMBER, _UNIT, _BORDER = range(6)
_SLOT = {_NUMBER: "<number>", _UNIT: "<unit>", _TITLE: "<name>"}
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = [np.ones(0, np.uint64), np.ones(0, np.uint64)]
_EXACT, _WEAK, _STRONG, _WHOLE = range(4)


def _hash(word: str) -> int:
    raw = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) << 32 | zlib.crc32(raw + b"#")


class _Codes(dict):
    """Token -> code; what a token is stands in lists by code. Code 0 parts texts."""

    def __init__(self):
        super().__init__()
        self.kind, self.hash, self.common = [_BORDER], [_hash("\0")], [False]

    def __missing__(self, token: str) -> int:
        first, rest = token[0], token[1:]
        if first.isdigit():
            kind = _NUMBER
        elif token in ".!?:\n":
            kind = _END
        elif token.lower() in UNITS:
            kind = _UNIT
        else:
            kind = _TITLE if first.isupper() and rest and rest == rest.lower() else _LITERAL
        code = self[token] = len(self.kind)
        self.kind.append(kind)
        self.hash.append(_hash(token.lower()))
        self.common.append(token.lower() in COMMON)
        return code


def canonical(texts: list[str]):
    """Template words of all texts in a row, once for each form, and the words.

    A form has text number, hash, hash of the word itself, kind, and the word's place. In the first
    a capitalised word is a name unless a sentence starts with it, in the second unless it is a
    function word, and in the third no word is (so case and punctuation don't matter).
    Neighbouring names are one slot.
    """
    codes, owner, words = _Codes(), [], []
    flat = []
    for text in texts:
        tokens = _TOKENS(text)
        words.extend(tokens)
        words.append("")
        flat.extend([codes[t] for t in tokens])
        flat.append(0)
        owner.append(len(tokens) + 1)
    flat = np.array(flat, np.int64)
    owner = np.repeat(np.arange(len(texts)), owner)
    told = np.array(codes.kind)[flat]
    plain = np.array(codes.hash, np.uint64)[flat]
    title = told == _TITLE
    starts = np.isin(np.concatenate([[_BORDER], told[:-1]]), (_END, _BORDER))
    forms = []
    for literal in (starts, np.array(codes.common)[flat], True):
        kind = np.where(title & literal, _LITERAL, told)
        value = plain.copy()
        for slot, name in _SLOT.items():
            value[kind == slot] = _hash(name)
        name = kind == _TITLE
        more = name & np.concatenate([[False], name[:-1]])
        keep = np.flatnonzero((kind != _END) & ~more)
        forms.append((owner[keep], value[keep], plain[keep], kind[keep], keep))
    return forms, words


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, n at least."""
    if len(_POWERS[0]) < n:
        for k, factor in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
            steps = np.full(2 * n, factor, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def _sums(value: np.ndarray) -> np.ndarray:
    """Sums of the words' hashes, weighted by their place, up to each word."""
    mixed = (value ^ (value >> np.uint64(29))) * _powers(len(value) + 1)[0][: len(value)]
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])


def window_hashes(value: np.ndarray, plain: np.ndarray, kind: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window starting at each template word, and how it is compared (-1: it is none).

    A window lies within one text. With more literal words than slots it is ``_STRONG``. With fewer
    it is ``_WEAK``, but ``_EXACT``, by its words instead of its template, if it is long or all slots.
    """
    n = len(value) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    back = _powers(len(value) + 1)[1]
    counts = [np.concatenate([[0], np.cumsum(kind == k)]) for k in (_LITERAL, _BORDER)]
    literal, border = (c[size:] - c[:n] for c in counts)
    few = 1 if size == WINDOW else size
    mode = np.where(2 * literal > size, _STRONG, np.where(literal >= few, _WEAK, _EXACT))
    mode[border > 0] = -1
    sums = _sums(value)
    hashes = (sums[size:] - sums[:n]) * back[:n]
    exact = np.flatnonzero(mode == _EXACT)
    if len(exact):
        sums = _sums(plain)
        hashes[exact] = (sums[exact + size] - sums[exact]) * back[exact]
    return hashes, mode


def _whole_items(owner: np.ndarray, plain: np.ndarray, kind: np.ndarray, size: int, items: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of runs of ``size`` words within one text; of ``items`` only those that are all of it.

    ``owner``, ``plain`` and ``kind`` are of the form whose words are all literal.
    """
    words = np.flatnonzero(kind != _BORDER)
    owner, plain = owner[words], plain[words]
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = owner[:n] == owner[size - 1 :]
    if items:
        many = np.bincount(owner)
        inside &= many[owner[:n]] == size
    sums = _sums(plain)
    hashes = (sums[size:] - sums[:n]) * _powers(len(plain) + 1)[1][:n]
    found = np.flatnonzero(inside)
    return words[found], hashes[found]


def windows(table_: DataFrame, key: str, wanted=None, items: bool = False, least_words: int = LEAST_WORDS) -> DataFrame:
    """Windows of each text: key, part (told by the text), form, mode, size, at, hash, template, slots.

    ``wanted`` tells which hashes count (``_Wanted``, as a broadcast variable), if not all. Runs of
    ``least_words`` up to WINDOW - 1 words are windows too: those that are a whole text of
    ``items``, and any of other texts.
    """

    def run(batches):
        for batch in batches:
            for rows, some in slices(batch, 2, CHUNK_CHARS):
                keys, parts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                forms, words = canonical(some)
                out = {n: [] for n in ("key", "part", "form", "mode", "size", "at", "hash", "template", "slots")}

                def add(form, size, i, mode, hash_, owner, begins, kinds, where):
                    exact = mode in (_EXACT, _WHOLE)
                    text = [words[k].lower() for k in where]
                    out["key"].append(keys[owner])
                    out["part"].append(parts[owner])
                    out["form"].append(form)
                    out["mode"].append(int(mode))
                    out["size"].append(size)
                    out["at"].append(int(i - begins))
                    out["hash"].append(int(hash_.astype(np.int64)))
                    out["template"].append(" ".join(text if exact else [_SLOT.get(k, w) for k, w in zip(kinds, text)]))
                    out["slots"].append([] if exact else [w for k, w in zip(kinds, text) if k in _SLOT])

                for form, (owner, value, plain, kind, where) in enumerate(forms):
                    begins = np.searchsorted(owner, np.arange(len(some)))
                    for size in (WINDOW, LONG_WINDOW):
                        hashes, mode = window_hashes(value, plain, kind, size)
                        found = np.flatnonzero(mode >= 0)
                        if wanted is not None:
                            found = found[wanted.value.has(hashes[found])]
                        for i in found.tolist():
                            add(form, size, i, mode[i], hashes[i], owner[i], begins[owner[i]], kind[i : i + size].tolist(), where[i : i + size].tolist())
                owner, value, plain, kind, where = forms[-1]
                begins = np.searchsorted(owner, np.arange(len(some)))
                for size in range(least_words, WINDOW):
                    found, hashes = _whole_items(owner, plain, kind, size, items)
                    hashes ^= np.uint64(size)  # apart from those of windows
                    if wanted is not None:
                        good = wanted.value.has(hashes)
                        found, hashes = found[good], hashes[good]
                    for i, hash_ in zip(found.tolist(), hashes):
                        add(len(forms) - 1, size, i, _WHOLE, hash_, owner[i], begins[owner[i]], [], where[i : i + size].tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["key"], pa.int64()), pa.array(out["part"], pa.int64()), pa.array(out["form"], pa.int32()), pa.array(out["mode"], pa.int32()), pa.array(out["size"], pa.int32()),
                     pa.array(out["at"], pa.int64()), pa.array(out["hash"], pa.int64()), pa.array(out["template"], pa.string()), pa.array(out["slots"], pa.list_(pa.string()))],
                    names=list(out))

    text = F.col("text").cast("string")
    return table_.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("part"), text.alias("text")).mapInArrow(
        tidy(run), "key long, part long, form int, mode int, size int, at long, hash long, template string, slots array<string>")


class _Wanted:
    """Which hashes count: sorted ones, or a map of some of their bits that lets few others through."""

    def __init__(self, hashes: np.ndarray | None = None, bits: np.ndarray | None = None):
        self.hashes, self.bits = hashes, bits
        if hashes is not None:
            self.bits = np.zeros(1 << 20, bool)
            self.bits[hashes >> np.uint64(44)] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.hashes is None:
            slot = (hashes & np.uint64((8 * len(self.bits)) - 1)).astype(np.int64)
            return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
        if not len(self.hashes):
            return np.zeros(len(hashes), bool)
        good = self.bits[hashes >> np.uint64(44)]
        some = hashes[good]
        good[good] = self.hashes[np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)] == some
        return good


def _wanted_of(ours: DataFrame, small: bool) -> _Wanted:
    if small:  # bounded: at most BROADCAST_WINDOWS numbers
        return _Wanted(np.sort(np.array([r[0] for r in ours.select("hash").distinct().collect()], np.int64).astype(np.uint64)))
    slots = ours.select((F.col("hash").bitwiseAND(F.lit((1 << MAP_BITS) - 1)) + 1).alias("slot"))
    sectors = slots.groupBy(F.expr("bitmap_bucket_number(slot)").alias("sector")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    bits = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    for sector, packed in sectors.collect():  # at most 4,096 rows of 4 KB, whatever the benchmark's size
        bits[(sector - 1) * 4096 : sector * 4096] = np.frombuffer(packed, np.uint8)
    return _Wanted(bits=bits)


def _one_to_one(pairs):
    values = F.array_distinct(pairs)
    return (F.size(values) == F.size(F.array_distinct(F.transform(values, lambda p: p["item_slots"])))) & (
        F.size(values) == F.size(F.array_distinct(F.transform(values, lambda p: p["slots"]))))


def contaminated(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Texts that hold benchmark items: doc_id, part (told by the text), item_ids (sorted), cover (largest share of an item).

    A document is a doc_id, null or not, and a text: different texts under one doc_id are apart.
    Null texts hold nothing; repeated rows and items count once. The share is of an item's windows
    with more literal words than slots, or of all its windows, whichever is larger. Items of under
    five words must stand whole, word by word; those of under ``least_words`` are never found.
    """
    ours = cut(windows(benchmark.where("item_id is not null"), "item_id", items=True, least_words=least_words)
               .select(F.col("key").alias("item_id"), "form", "mode", "size", F.col("at").alias("item_at"), "hash", "template", F.col("slots").alias("item_slots")).distinct())
    small = ours.count() <= BROADCAST_WINDOWS
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted_of(ours, small))
    theirs = windows(docs.select("doc_id", "text"), "doc_id", wanted, least_words=least_words).withColumnRenamed("key", "doc_id")
    pairs = theirs.join(F.broadcast(ours) if small else ours, ["hash", "form", "mode", "size", "template"])
    strong, both = F.col("mode") == _STRONG, F.arrays_zip("item_slots", "slots")
    aligned = pairs.groupBy("doc_id", "part", "item_id", "form", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct("mode", "size", "item_at")).alias("found"),
        F.flatten(F.collect_set(F.when(strong, both))).alias("strong_slots"), F.flatten(F.collect_set(both)).alias("slots"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("mode").isin(_EXACT, _WHOLE), F.split("template", " "))))).alias("words"))
    # Templates of a single literal word say too little.
    telling = F.size(F.filter("words", lambda w: ~w.startswith("<"))) >= 2
    aligned = aligned.select("doc_id", "part", "item_id", "form", "found", _one_to_one(F.col("strong_slots")).alias("strong_fits"), (_one_to_one(F.col("slots")) & telling).alias("fits"))
    whole, mode = F.col("w.size") == WINDOW, F.col("w.mode")
    counted = aligned.select("doc_id", "part", "item_id", "form", "strong_fits", "fits", F.explode("found").alias("w"))
    counted = counted.where(F.when(mode == _STRONG, F.col("strong_fits")).when(mode == _WEAK, F.col("fits")).otherwise(True))
    counted = counted.withColumn("whole_item", mode == _WHOLE)
    totals = ours.where((F.col("size") == WINDOW) | (F.col("mode") == _WHOLE)).groupBy("item_id", "form").agg(
        F.countDistinct("item_at").alias("total"), F.countDistinct(F.when(strong, F.col("item_at"))).alias("strong_total"))
    hit = counted.groupBy("doc_id", "part", "item_id", "form").agg(
        F.countDistinct(F.when(whole, F.col("w.item_at"))).alias("n"), F.countDistinct(F.when(whole & (mode == _STRONG), F.col("w.item_at"))).alias("strong_n"),
        F.max("w.size").alias("longest"), F.max("whole_item").alias("whole_item"))
    hit = hit.join(F.broadcast(totals) if small else totals, ["item_id", "form"])
    hit = hit.withColumn("cover", F.greatest(F.col("n") / F.col("total"), F.coalesce(F.col("strong_n") / F.nullif("strong_total", F.lit(0)), F.lit(0.0))))
    hit = hit.withColumn("cover", F.when(F.col("whole_item"), 1.0).otherwise(F.col("cover")))
    hit = hit.where((F.col("cover") >= LEAST_COVER) | (F.col("longest") == LONG_WINDOW))
    return hit.groupBy("doc_id", "part").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("cover").alias("cover"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text isn't contaminated, with all their columns, whatever their names.

    Rows are told apart by doc_id and text, so a clean text stays whatever else has its doc_id, a
    null one too; rows with a null or empty text are clean; repeated rows stay repeated or go
    together; an empty table stays empty, and an empty benchmark leaves all rows.
    """
    name, part = fresh_name(docs, "found_id"), fresh_name(docs, "found_part")
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias(name), F.col("part").alias(part))
    return without(docs, found, [docs["doc_id"].cast("long").eqNullSafe(F.col(name)), F.xxhash64(docs["text"].cast("string")) == F.col(part)])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, item_ids (empty if clean), cover."""
    found = contaminated(docs, benchmark).withColumnsRenamed({"doc_id": "found_id", "part": "found_part"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("part"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("part") == F.col("found_part")), "left")
    return joined.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                         F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("cover", F.lit(0.0)).alias("cover"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, one row each: doc_id, contaminated (true), items (comma-joined), cover."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    # Different texts under one doc_id are reported together.
    whole = found.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.max("cover").alias("cover"))
    return whole.select("doc_id", F.lit(True).alias("contaminated"), F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ",").alias("items"), "cover")
