"""Near-duplicate documents by BagMinHash over multisets of word shingles.

Equal texts are collapsed first. Each distinct text is a multiset of five-word shingles. A
shingle's count is cut into dyadic blocks of levels (1, 2, 3-4, 5-8, ...); each block carries its
own Poisson process, whose points fall on signature components and levels; points above the count
are thinned out. A component's least point is equal for two texts with exactly their weighted
Jaccard similarity as probability. Signatures are banded; pairs that share a band are verified by
exact multiset overlap.

Within a bucket texts are first held against one pivot, the text that meets most others in its
buckets (mostly the original of a group of copies). Texts of buckets that still hold several
components are then paired by an exact prefix filter: a text's shingle occurrences are ordered by
rarity, and two texts of sizes n and m can only reach the similarity if they share one of their
``n - ceil(0.8 / 1.8 * (n + m)) + 1`` rarest. So texts that share no more than a common core never
pair, no link between components is lost, and a large group of copies never gives all its pairs.
With 70 bands of 9 a pair of similarity 0.8 shares no band with probability of about 2e-4, one of
0.85 with less than 1e-6.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, cut, fresh_name, release, slices, table, tidy, without

SHINGLE = 5
SIMILARITY = 0.8
COMPONENTS, ROWS, DEALS = 315, 9, 2
BANDS = DEALS * COMPONENTS // ROWS  # the signature's components are dealt into bands of 9 twice
BROADCAST_IDS = 400_000  # rows up to which a list of texts is sent to every executor
CHUNK_CHARS = 2_000_000
MEMO_TEXTS = 3_000  # sketches a worker keeps
MEMO_WORDS = 200_000  # hashes of words a worker keeps
POINTS = 1 << 16  # points worked out at once

_WORDS = re.compile(r"\w+").findall
_M = COMPONENTS
_rng = np.random.default_rng(1)
_PLACES = _rng.integers(0, 2**63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)  # a word's weight by its place in a shingle
_DEALT = np.concatenate([_rng.permutation(COMPONENTS) for _ in range(DEALS)]).reshape(BANDS, ROWS)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_known = _Hashes()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash, count; sorted by both.

    A text of fewer than five words has one shingle, all its words; one without words has none.
    """
    if len(_known) > MEMO_WORDS:
        _known.clear()
    words = [_WORDS(t.lower()) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    # Four more places, so that every word begins a window; those that leave their text aren't taken.
    flat = np.zeros(int(sizes.sum()) + SHINGLE - 1, np.uint64)
    flat[: len(flat) - SHINGLE + 1] = np.fromiter(map(_known.__getitem__, chain.from_iterable(words)), np.uint64, len(flat) - SHINGLE + 1)
    begin = np.cumsum(sizes) - sizes
    many = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    cuts = np.concatenate([[0], np.cumsum(many)])
    owner = np.repeat(np.arange(len(texts)), many)
    with np.errstate(over="ignore"):
        window = sum(flat[k : len(flat) - SHINGLE + 1 + k] * _PLACES[k] for k in range(SHINGLE))
        total = window[np.arange(len(owner)) + (begin - cuts[:-1])[owner]]
        for k in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):
            total[cuts[k]] = (flat[begin[k] : begin[k] + sizes[k]] * _PLACES[: sizes[k]]).sum() + sizes[k].astype(np.uint64)
    total = _mix(total)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        total[a:b].sort()
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(total) != 0)])) if len(owner) else np.zeros(0, np.int64)
    return owner[new], total[new], np.diff(np.append(new, len(owner)))


def signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, m: int = _M) -> np.ndarray:
    """BagMinHash signature of each text, ``texts`` x ``m``; rows of texts without shingles are infinite.

    ``owner`` is in order. Texts are worked out in groups of about ``POINTS`` points; of each process
    as many points are drawn at once as a text of so many processes is likely to need.
    """
    sig = np.full((texts, m), np.inf)
    # Blocks of levels of each shingle: [0, 1), [1, 2), [2, 4), [4, 8), ...
    blocks = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    of = np.repeat(np.arange(len(owner)), blocks)
    block = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    with np.errstate(over="ignore"):
        seed = _mix(shingle[of] + block.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    doc, level = owner[of], count[of]
    have = np.bincount(doc, minlength=texts)
    drawn = 2 ** np.ceil(np.log2(np.maximum(1, m * (math.log(m) + 1) / np.maximum(have, 1)))).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(have)])
    for k in np.unique(drawn[have > 0]).tolist():
        mine = np.flatnonzero((drawn == k) & (have > 0))
        for some in np.split(mine, np.flatnonzero(np.diff(np.cumsum(have[mine] * k) // POINTS)) + 1):
            at = np.concatenate([np.arange(first[t], first[t + 1]) for t in some.tolist()])
            sig[some] = _drawn(np.repeat(np.arange(len(some)), have[some]), seed[at], low[at], level[at], len(some), m, k)
    return sig


def _drawn(doc, seed, low, level, texts: int, m: int, k: int) -> np.ndarray:
    """Signatures of one group of texts; ``k`` points of each process at first."""
    sig = np.full(texts * m, np.inf)
    x, rate, step = np.zeros(len(doc)), np.maximum(low, 1), 0
    while len(doc):
        with np.errstate(over="ignore"):
            z = _mix(seed[:, None] + np.arange(step + 1, step + k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            gap = np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / -rate[:, None]
            z = _mix(z ^ np.uint64(0xA5A5A5A55A5A5A5A))
            place = (((z & np.uint64(0xFFFFFFFF)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        gap[:, 0] += x
        points = np.cumsum(gap, axis=1)
        held = low[:, None] + ((z >> np.uint64(32)).astype(np.float64) * 2.0**-32 * rate[:, None]).astype(np.int64) < level[:, None]
        np.minimum.at(sig, (place + (doc * m)[:, None])[held], points[held])
        most = sig.reshape(texts, m).max(1)
        x = points[:, -1]
        on = x < most[doc]
        doc, seed, x, rate, low, level = doc[on], seed[on], x[on], rate[on], low[on], level[on]
        step, k = step + k, max(1, k // 4, 2048 // max(1, len(doc)))  # few that are left: more at once
    return sig.reshape(texts, m)


def pack(shingle: np.ndarray, count: np.ndarray) -> bytes:
    """A multiset as bytes: its size, distinct shingles in order, and counts if any is over 1."""
    head = np.array([len(shingle)], np.uint64).tobytes() + shingle.tobytes()
    return head + (count.astype(np.uint32).tobytes() if (count > 1).any() else b"")


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(packed, np.uint64, 1)[0])
    rest = np.frombuffer(packed, np.uint32, offset=8 + 8 * n)
    return np.frombuffer(packed, np.uint64, n, 8), rest if len(rest) else np.ones(n, np.uint32)


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    (a, m), (b, n) = unpack(a), unpack(b)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    union = int(m.sum()) + int(n.sum()) - both
    return both / union if union else 0.0


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("~"), text).alias("h2")]


def sketch(rows: DataFrame) -> DataFrame:
    """Of each row (doc_id, text, h1, h2): id, h1, h2, n (shingles), bands (hash of each band).

    Of texts that a worker meets again only the first is worked out, up to a bound.
    """

    def run(batches):
        memo: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            for part, some in slices(batch, 1, CHUNK_CHARS):
                mine = list(zip(part.column(2).to_pylist(), part.column(3).to_pylist()))
                fresh = {k: t for k, t in zip(mine, some) if k not in memo}
                found = dict(zip(fresh, bands_of(list(fresh.values())))) if fresh else {}
                rows_ = [found.get(k) or memo[k] for k in mine]
                if len(memo) > MEMO_TEXTS:
                    memo = {}
                memo.update(found)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate([r[1] for r in rows_])))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in (0, 2, 3)), pa.array([r[0] for r in rows_], pa.int64()), lists],
                    names=["id", "h1", "h2", "n", "bands"])
        _known.clear()  # the worker serves other stages too

    return rows.select("doc_id", "text", "h1", "h2").mapInArrow(tidy(run), "id long, h1 long, h2 long, n long, bands array<long>")


def bands_of(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """Number of shingles and band hashes of each text."""
    owner, shingle, count = shingles(texts)
    sig = signatures(owner, shingle, count, len(texts))
    bits = sig.view(np.uint64)[:, _DEALT]
    band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(texts), BANDS)).copy()  # one hash for all bands: each begins with its number
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    n = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
    return list(zip(n.tolist(), band.view(np.int64)))


def multisets_of(rows: DataFrame) -> DataFrame:
    """The packed multiset of each row (id, text)."""

    def run(batches):
        for batch in batches:
            for part, some in slices(batch, 1, CHUNK_CHARS):
                owner, shingle, count = shingles(some)
                cuts = np.searchsorted(owner, np.arange(len(some) + 1))
                packed = [pack(shingle[a:b], count[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])
        _known.clear()

    return rows.select("id", "text").mapInArrow(tidy(run), "id long, packed binary")


def occurrences_of(multisets: DataFrame) -> DataFrame:
    """Of each row (id, packed): id, n (size), token; a token is one occurrence of a shingle, so a multiset becomes a set."""

    def run(batches):
        for batch in batches:
            lists = []
            for packed in batch.column(1).to_pylist():
                shingle, count = unpack(packed)
                ordinal = np.arange(int(count.sum())) - np.repeat(np.cumsum(count, dtype=np.int64) - count, count)
                with np.errstate(over="ignore"):
                    lists.append(_mix(np.repeat(shingle, count) + ordinal.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                             names=["id", "n", "tokens"])

    return multisets.select("id", "packed").mapInArrow(tidy(run), "id long, n long, tokens array<long>").select("id", "n", F.explode("tokens").alias("token"))


def verified(pairs: DataFrame, multisets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough. ``a`` repeats, so its multiset joins last and isn't shuffled pair by pair."""

    def run(batches):
        for batch in batches:
            good = [overlap(x.as_py(), y.as_py()) >= SIMILARITY for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = multisets.select(F.col("id").alias("a"), F.col("packed").alias("pa"))
    right = multisets.select(F.col("id").alias("b"), F.col("packed").alias("pb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "pa", "pb").mapInArrow(tidy(run), "a long, b long")


def _parts(rows: DataFrame, key: str) -> DataFrame:
    """Each ``key`` that holds several components, and main, the largest of them; by aggregation alone."""
    parts = rows.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("c"))
    whole = parts.groupBy(key).agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("parts"))
    return whole.where("parts > 1").select(key, "main")


def shared_buckets(sketches: DataFrame) -> DataFrame:
    """Members (key, id, n, c) of buckets of several texts; c is the bucket's size."""
    rows = sketches.select("id", "n", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return rows.join(sizes.hint("shuffle_hash"), "key")  # the smaller half of what a task reads; no sort


def prefix_pairs(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components, of all of ``rows`` (id, comp), that can reach the similarity, by the prefix filter.

    ``tokens``: id, n, token of all of ``rows``.
    """
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = tokens.join(counts, "token")
    # Tokens that only one text has come first; they match nothing, so only their number counts.
    order = Window.partitionBy("id").orderBy("df", "token")
    place = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("id")) + F.row_number().over(order)
    ratio = F.lit((1 + SIMILARITY) / SIMILARITY)
    most = F.floor((F.col("n") - place + 1) * ratio + 1e-9) - F.col("n")
    prefix = common.select("id", "n", "token", most.alias("most")).where(F.col("most") >= F.lit(SIMILARITY) * F.col("n"))
    prefix = cut(prefix.join(rows, "id"))
    left = prefix.join(_parts(prefix, "token"), "token").where("comp <> main")
    left = left.select("token", F.col("id").alias("a"), "n", F.col("most").alias("amost"), F.col("comp").alias("acomp"))
    right = prefix.select("token", F.col("id").alias("b"), F.col("n").alias("m"), F.col("most").alias("bmost"), F.col("comp").alias("bcomp"))
    fits = (F.col("acomp") != F.col("bcomp")) & (F.col("amost") >= F.col("m")) & (F.col("bmost") >= F.col("n"))
    pairs = left.join(right, "token").where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = cut(pairs)
    release(prefix)
    return pairs


def links(sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Components (node, component) of the texts that are linked.

    ``sketches``: id, h1, h2, n, bands of distinct texts; ``texts``: h1, h2, text of at least those.
    """
    shared = cut(shared_buckets(sketches))
    met = shared.groupBy("id").agg(F.sum("c").alias("met"))
    members = cut(shared.join(met, "id").select("key", "id", "n", "met"))
    release(shared)
    ids = cut(sketches.select("id", "h1", "h2").join(members.select("id").distinct(), "id", "left_semi"))
    few = ids.count() <= BROADCAST_IDS
    named = texts.join(F.broadcast(ids) if few else ids, ["h1", "h2"])
    multisets = cut(multisets_of(named).dropDuplicates(["id"]))
    release(ids)

    most = F.max(F.struct("met", F.xxhash64("id").alias("o"), F.col("id").alias("p"), F.col("n").alias("m")))
    pivots = members.groupBy("key").agg(most.alias("top")).select("key", "top.p", "top.m")
    enough = F.least("n", "m") >= F.lit(SIMILARITY) * F.greatest("n", "m")
    tried = members.join(pivots, "key").where((F.col("id") != F.col("p")) & enough)
    tried = cut(tried.select(F.col("p").alias("a"), F.col("id").alias("b")).distinct())
    edges = cut(verified(tried, multisets))
    comps = components(edges)
    rows = cut(members.join(comps, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("comp")))

    # Texts of buckets that still hold several components: by the prefix filter.
    apart = cut(rows.join(_parts(rows, "key"), "key", "left_semi").select("id", "comp").distinct())
    release(rows)
    wanted = apart.select("id")
    kept = multisets.join(F.broadcast(wanted) if few else wanted, "id", "left_semi")
    tokens = cut(occurrences_of(kept))
    third = prefix_pairs(apart, tokens)
    more = cut(verified(third, multisets))
    found = cut(components(edges.unionByName(more)))
    for done in (members, multisets, tried, edges, apart, tokens, third, more):
        release(done)
    return found


def _classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, h1, h2 (the text's key), class_id, kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"(?U)\S"), F.lit(False))
    keyed = rows.select("doc_id", usable.alias("usable"), "text", *_text_key(F.col("text")))
    distinct = sketch(keyed.where("usable")).groupBy("h1", "h2").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    # A text is a node by a number of its own, which stands once it is written: different texts may share a doc_id.
    distinct = cut(distinct.withColumn("id", F.monotonically_increasing_id()))
    texts = keyed.where("usable").select("h1", "h2", "text")
    comps = links(distinct.where("n > 0").select("id", "h1", "h2", "n", "bands"), texts)
    nodes = distinct.select("h1", "h2", "id", "least").join(comps, F.col("id") == F.col("node"), "left")
    nodes = cut(nodes.select("h1", "h2", "least", F.coalesce("component", "id").alias("comp")))
    release(distinct)
    release(comps)
    named = nodes.groupBy("comp").agg(F.min("least").alias("class_id"))
    final = nodes.join(named, "comp").select("h1", "h2", "class_id")
    joined = keyed.where("usable").select("doc_id", "h1", "h2").join(final, ["h1", "h2"])
    alone = keyed.where("not usable").select("doc_id", "h1", "h2", F.col("doc_id").alias("class_id"))
    both = joined.select("doc_id", "h1", "h2", "class_id").unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id (smallest doc_id), kept.

    Texts are of one class if they are equal or linked by similarities of at least 0.8. Null and
    blank texts (white space alone) are each a class of their own, so are rows with a null doc_id
    (class_id null, kept). Repeated rows are of one class and are all kept or all dropped. Different
    texts under one doc_id are different documents: each has the class of its own text, and of a
    class the rows under its smallest doc_id are kept. An empty table gives no rows; other columns
    are ignored.
    """
    return _classes(docs).select("doc_id", "class_id", "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their class, with all their columns; edge cases as in ``near_duplicates``.

    Rows are told apart by doc_id and text, so a class keeps a text even where its doc_id has other texts that go.
    """
    gone = [fresh_name(docs, n) for n in ("gone_id", "gone_h1", "gone_h2")]
    dropped = _classes(docs).where("not kept").select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "h1", "h2"), gone)]).distinct()
    same = [a == F.col(n) for a, n in zip((docs["doc_id"].cast("long"), *_text_key(docs["text"].cast("string"))), gone)]
    return without(docs, dropped, same, BROADCAST_IDS)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
