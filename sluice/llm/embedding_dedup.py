"""Embedding near-duplicates with hierarchical navigable small-world graphs per shard.

Equal vectors are collapsed first. Distinct vectors are dealt to shards by hash and each shard
builds its own layered graph. Every vector is then searched in every shard, in blocks; where hits
fill a query's beam the beam is widened for that query, and where a dense neighbourhood fills that
too, the query is held against the whole shard by blocked matrix products. Candidates are verified
by the cosine in double precision. A sample of queries that have links is checked against brute
force over all vectors, and all beams are widened until that recall audit passes.

A query gives one count a shard and one link to each of the shard's own components that it hits,
never all its pairs. Each node of a shard gives one link to its component's root besides, so the
links have the same connected components as all pairs together.
"""

from __future__ import annotations

import pickle
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, release, table

COSINE = 0.9
SHARDS, SHARD_ROWS = 12, 20_000  # shards at least, and distinct vectors of a shard about at most
BLOCK = 1024  # queries searched at once
GROUP = 8192  # queries that one copy of a shard's graph is sent to
DEGREE, MOST_DEGREE, BUILD_BEAM, BEAM = 12, 32, 32, 32
MOST_BEAM = 4  # times the beam up to which it is widened for one query
DENSE = 128  # queries held against a whole shard at once
DRAWN, AUDIT, RECALL, WIDENINGS = 2_000, 300, 0.97, 4  # queries tried by brute force; those with links are audited, up to AUDIT
LEAST_LINKS = 100  # true links below which the audit says little and a warning is given


def search(vectors, links, entry, queries, beam: int):
    """Beam search of many queries at once in one layer: ids and cosines, best first (-1: none).

    ``links`` has each node's neighbours, padded with -1; ``entry`` one start a query.
    """
    n, q = len(vectors), len(queries)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # padding
    ids = np.full((q, beam), n, np.int64)
    near = np.full((q, beam), -2.0, np.float32)
    todo = np.zeros((q, beam), bool)
    ids[:, 0], near[:, 0], todo[:, 0] = entry, np.einsum("qd,qd->q", vectors[entry], queries), True
    seen[np.arange(q), entry] = True
    live = np.arange(q)
    while len(live):
        pick = np.where(todo[live], near[live], -3).argmax(1)
        node = ids[live, pick]
        todo[live, pick] = False
        some = links[node]
        some = np.where(some < 0, n, some)
        some = np.where(seen[live[:, None], some], n, some)
        seen[live[:, None], some] = True
        cosine = np.einsum("qkd,qd->qk", vectors[np.minimum(some, n - 1)], queries[live])
        cosine[some == n] = -2
        all_near = np.concatenate([near[live], cosine], 1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(np.concatenate([ids[live], some], 1), order, 1)
        todo[live] = np.take_along_axis(np.concatenate([todo[live], some < n], 1), order, 1)
        near[live] = np.take_along_axis(all_near, order, 1)
        live = live[todo[live].any(1)]
    return np.where(near > -1.5, ids, -1), near


def diverse(vectors, node, ids, near, most: int):
    """Of each node's candidates (best first) up to ``most`` that lie nearer to it than to each other; then the best others."""
    rows, width = ids.shape
    to = vectors[np.maximum(ids, 0)]
    between = np.einsum("rad,rbd->rab", to, to)
    valid = (ids >= 0) & (ids != node[:, None])
    chosen = np.zeros((rows, width), bool)
    for k in range(width):
        rival = np.where(chosen, between[:, k], -2).max(1)
        chosen[:, k] = valid[:, k] & (near[:, k] > rival) & (chosen.sum(1) < most)
    rank = np.where(chosen, 0, 1) + np.where(valid, 0, 2)
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    picked = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
    if picked.shape[1] < most:
        picked = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)
    return picked


def build_layer(vectors) -> np.ndarray:
    """Neighbours of each node; nodes join in order, in batches that double."""
    n = len(vectors)
    links = np.full((n, MOST_DEGREE), -1, np.int64)
    done = 1
    while done < n:
        new = np.arange(done, min(n, done + max(1, min(done, BLOCK))))
        ids, near = search(vectors[:done], links[:done], np.zeros(len(new), np.int64), vectors[new], BUILD_BEAM)
        own = vectors[new] @ vectors[new].T
        np.fill_diagonal(own, -2)
        top = np.argsort(-own, axis=1, kind="stable")[:, :BUILD_BEAM]
        ids = np.concatenate([ids, new[top]], 1)
        near = np.concatenate([near, np.take_along_axis(own, top, 1)], 1)
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        links[new, :DEGREE] = diverse(vectors, new, np.where(near > -1.5, ids, -1), near, DEGREE)
        # Neighbours link back; where a node gets too many, the diverse ones stay.
        ends = pd.DataFrame({"a": links[new, :DEGREE].ravel(), "b": np.repeat(new, DEGREE)}).query("a >= 0")
        for a, some in ends.groupby("a")["b"]:
            have = links[a][links[a] >= 0]
            have = np.union1d(have, some.to_numpy())
            have = have[have != a]
            if len(have) > MOST_DEGREE:
                cosine = vectors[have] @ vectors[a]
                best = np.argsort(-cosine, kind="stable")[: 4 * MOST_DEGREE]
                have = diverse(vectors, np.array([a]), have[best][None], cosine[best][None], MOST_DEGREE)[0]
                have = have[have >= 0]
            links[a, : len(have)], links[a, len(have) :] = have, -1
        done = new[-1] + 1
    return links


class Graph:
    """A shard's layered graph, its vectors' ids and numbers of equal vectors, and its components."""

    def __init__(self, ids, counts, vectors):
        self.ids, self.counts = ids, counts
        self.raw = vectors
        self.norm = np.sqrt(np.einsum("nd,nd->n", vectors, vectors))
        self.unit = (vectors / self.norm[:, None]).astype(np.float32)
        rng = np.random.default_rng(len(ids))
        level = (-np.log(rng.random(len(ids))) / np.log(DEGREE)).astype(int)
        level[0] = level.max()
        self.members = [np.flatnonzero(level >= k) for k in range(level.max() + 1)]
        self.layers = [build_layer(self.unit[m]) for m in self.members]
        # Components of the shard's own links: hits of one component are one link.
        self.part = np.arange(len(ids))
        for lo in range(0, len(ids), BLOCK):
            rows, nodes, _, dense = self.block_hits(vectors[lo : lo + BLOCK], BEAM)
            apart = self.part[rows + lo] != self.part[nodes]
            for a, b in zip((rows + lo)[apart].tolist(), nodes[apart]):
                self.merge(a, b)
            for some, mask in self.held_against(vectors[lo : lo + BLOCK], dense):
                for a, hit in zip((some + lo).tolist(), mask):
                    self.merge(a, np.flatnonzero(hit))

    def merge(self, a: int, others) -> None:
        """Join the components of a node and others."""
        parts = self.part[others]
        if (parts != self.part[a]).any():
            parts = np.union1d(parts, self.part[a])
            self.part[np.isin(self.part, parts)] = parts[0]

    def __getstate__(self):
        """What is sent out: single precision where that is exact, and nothing that can be worked out again."""
        raw = self.raw.astype(np.float32)
        return {"ids": self.ids, "counts": self.counts, "raw": raw if (raw == self.raw).all() else self.raw, "members": [m.astype(np.int32) for m in self.members],
                "layers": [k.astype(np.int32) for k in self.layers], "part": self.part.astype(np.int32)}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.raw = self.raw.astype(np.float64)
        self.norm = np.sqrt(np.einsum("nd,nd->n", self.raw, self.raw))
        self.unit = (self.raw / self.norm[:, None]).astype(np.float32)

    def block_hits(self, queries, beam: int):
        """Pairs (query, node, cosine) of at least ``COSINE``, and the queries whose hits fill even the widest beam."""
        norm = np.sqrt(np.einsum("nd,nd->n", queries, queries))
        unit = (queries / norm[:, None]).astype(np.float32)
        entry = np.zeros(len(queries), np.int64)
        for k in range(len(self.layers) - 1, 0, -1):
            found = search(self.unit[self.members[k]], self.layers[k], entry, unit, 4)[0][:, 0]
            entry = np.searchsorted(self.members[k - 1], self.members[k][found])
        open_, out, most = np.arange(len(queries)), [], MOST_BEAM * beam
        while len(open_) and beam <= most:
            ids, near = search(self.unit, self.layers[0], entry[open_], unit[open_], beam)
            full = near[:, -1] >= COSINE - 1e-3
            row, col = np.nonzero((near >= COSINE - 1e-3) & (ids >= 0) & ~full[:, None])
            q, x = open_[row], ids[row, col]
            cosine = np.einsum("nd,nd->n", queries[q], self.raw[x]) / (norm[q] * self.norm[x])
            good = cosine >= COSINE
            out.append((q[good], x[good], cosine[good]))
            open_, beam = open_[full], 2 * beam
        return (*(np.concatenate(c) for c in zip(*out)), open_)

    def hits(self, queries, beam: int):
        """All pairs (query, node, cosine) of few queries."""
        q, x, cosine, dense = self.block_hits(queries, beam)
        more = [(some[row], col) for some, mask in self.held_against(queries, dense) for row, col in [np.nonzero(mask)]]
        q, x = (np.concatenate([head, *(m[k] for m in more)]) for k, head in enumerate((q, x)))
        return q, x, np.einsum("nd,nd->n", queries[q], self.raw[x]) / (np.linalg.norm(queries[q], axis=1) * self.norm[x])

    def held_against(self, queries, which):
        """Runs of the queries ``which`` with a mask of the nodes of the whole shard that they link with."""
        for lo in range(0, len(which), DENSE):
            some = which[lo : lo + DENSE]
            asked = queries[some]
            cosine = (asked @ self.raw.T) / np.outer(np.sqrt(np.einsum("nd,nd->n", asked, asked)), self.norm)
            yield some, cosine >= COSINE

    def answers(self, ids, queries, beam: int):
        """Of a block of queries: linked vectors of each (itself left out), and (query, node) once for each of the shard's components it hits."""
        linked, ends = np.zeros(len(ids), np.int64), []
        q, x, _, dense = self.block_hits(queries, beam)
        other = self.ids[x] != ids[q]
        q, x = q[other], x[other]
        np.add.at(linked, q, self.counts[x])
        order = np.lexsort((x, self.part[x], q))
        q, x = q[order], x[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(q) != 0) | (np.diff(self.part[x]) != 0)])) if len(q) else np.zeros(0, np.int64)
        ends.append((q[new], x[new]))
        by_part = np.argsort(self.part, kind="stable")
        cuts = np.flatnonzero(np.diff(self.part[by_part], prepend=-1))
        for some, mask in self.held_against(queries, dense):
            mask &= self.ids[None] != ids[some][:, None]
            linked[some] = mask @ self.counts
            first = np.minimum.reduceat(np.where(mask[:, by_part], by_part[None], len(self.ids)), cuts, axis=1)
            row, col = np.nonzero(first < len(self.ids))
            ends.append((some[row], first[row, col]))
        return linked, np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


def _array(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def _build(key, rows):
    rows = rows.sort_values("id")
    graph = Graph(rows["id"].to_numpy(), rows["count"].to_numpy(), _array(rows["vector"]))
    return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [pickle.dumps(graph)]})


def _query(beam: int):
    def run(key, graphs, queries):
        none = pd.DataFrame({"id": [], "linked": [], "other": []}).astype("int64")
        if graphs.empty or (queries.empty and key[2]):
            return none
        graph = pickle.loads(graphs["graph"].iloc[0])
        # Once a shard: what holds its own components together.
        tree = none if key[2] else pd.DataFrame({"id": graph.ids, "linked": 0, "other": graph.ids[graph.part]}).query("id != other")
        if queries.empty:
            return tree
        ids, vectors, out = queries["id"].to_numpy(), _array(queries["vector"]), [tree]
        for lo in range(0, len(ids), BLOCK):
            mine = ids[lo : lo + BLOCK]
            linked, q, x = graph.answers(mine, vectors[lo : lo + BLOCK], beam)
            some = linked > 0
            out += [pd.DataFrame({"id": mine[some], "linked": linked[some], "other": mine[some]}), pd.DataFrame({"id": mine[q], "linked": 0, "other": graph.ids[x]})]
        return pd.concat([none, *(x for x in out if x is not None)])

    return run


def passes(seen: dict[int, int], truth: dict[int, int]) -> bool:
    """Whether audited queries found enough of their links: all links together, and a query's own on average."""
    found = {k: min(seen.get(k, 0), n) for k, n in truth.items()}
    return not truth or (sum(found.values()) >= RECALL * sum(truth.values()) and sum(found[k] / n for k, n in truth.items()) >= RECALL * len(truth))


def link_distinct(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of distinct vectors (id, count, vector): (id, linked) and the links (a, b) that join components."""
    dims = {r["dim"]: r["n"] for r in distinct.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not dims:
        return distinct.select("id", F.lit(0).cast("long").alias("linked")), distinct.select(F.col("id").alias("a"), F.col("id").alias("b"))
    shards = max(SHARDS, -(-max(dims.values()) // SHARD_ROWS))
    blocks = max(1, -(-max(dims.values()) // GROUP))
    placed = distinct.withColumn("dim", F.size("vector"))
    graphs = cut(placed.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
                 .groupBy("dim", "shard").applyInPandas(_build, "dim int, shard int, graph binary"))
    tasks = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = placed.select("id", "vector", "dim", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
                            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    sample = (placed.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(DRAWN).select("id", "vector", "dim").collect())  # DRAWN rows at most

    def brute(batches):
        groups = {d: (np.array([r["id"] for r in sample if r["dim"] == d]), np.array([r["vector"] for r in sample if r["dim"] == d], np.float64)) for d in {r["dim"] for r in sample}}
        for rows in batches:
            for d, whole in rows.groupby(rows["vector"].str.len()):
                if d not in groups:
                    continue
                ids, asked = groups[d]
                lengths, hits = np.linalg.norm(asked, axis=1), np.zeros(len(ids), np.int64)
                for lo in range(0, len(whole), BLOCK):
                    some = whole.iloc[lo : lo + BLOCK]
                    v = _array(some["vector"])
                    cosine = (asked @ v.T) / np.outer(lengths, np.linalg.norm(v, axis=1))
                    hit = (cosine >= COSINE) & (ids[:, None] != some["id"].to_numpy()[None])
                    hits += hit @ some["count"].to_numpy()
                yield pd.DataFrame({"id": ids[hits > 0], "linked": hits[hits > 0]})

    truth = distinct.select("id", "count", "vector").mapInPandas(brute, "id long, linked long").groupBy("id").agg(F.sum("linked").alias("truth"))
    truth = {r["id"]: r["truth"] for r in truth.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(AUDIT).collect()}  # queries that have links
    if sum(truth.values()) < LEAST_LINKS:
        warnings.warn(f"recall is audited on {sum(truth.values())} links only: {len(sample)} vectors have no more", stacklevel=2)
    beam = BEAM
    for _ in range(WIDENINGS):
        found = cut(tasks.groupBy("dim", "shard", "block").cogroup(queries.groupBy("dim", "shard", "block"))
                    .applyInPandas(_query(beam), "id long, linked long, other long"))
        seen = {r["id"]: r["linked"] for r in found.where(F.col("id").isin(list(truth))).groupBy("id").agg(F.sum("linked").alias("linked")).collect()}
        if passes(seen, truth):
            break
        release(found)
        beam *= 4
    else:
        raise RuntimeError(f"recall stays below {RECALL} with beams of {beam // 4}")
    release(graphs)
    return found.groupBy("id").agg(F.sum("linked").alias("linked")), found.where("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b"))


def link_embeddings(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    nor do rows with a null vec_id (component_id null, kept); vectors of different length never
    link. Equal vectors link with each other. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fine = F.coalesce(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    # 0.0 and -0.0 are one value
    keyed = rows.withColumn("fine", fine).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    keyed = keyed.select("vec_id", "vector", "fine", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit("~"), "vector").alias("h2"))
    distinct = cut(keyed.where("fine").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("count"), F.any_value("vector").alias("vector")))
    linked, links = link_distinct(distinct.select("id", "count", "vector"))
    comps = components(links)
    classes = (distinct.select("h1", "h2", "id", "count").join(linked, "id", "left").join(comps, F.col("id") == F.col("node"), "left")
               .select("h1", "h2", (F.coalesce("linked", F.lit(0)) + F.col("count") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    classes = cut(classes)
    joined = keyed.where("fine").select("vec_id", "h1", "h2").join(classes, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(table(spark, sf_dir, "embeddings"))
