"""Quality by hierarchical empirical Bayes over documents, paths and hosts.

A logistic model over text statistics gives each document's own evidence. Grouped aggregation
over all documents gives each host's and each path's mean; a site with few documents is shrunk
towards its host, a host towards the global mean, with prior strengths estimated by the method of
moments. A document's odds are its own, moved by how its path's odds differ from the global ones.
The host is ``source`` up to its first slash, the path is the whole source and the language.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_name, release, table
from .labelled import chosen_labels

SAMPLE_ROWS = 20_000  # labelled rows the document classifier is fitted on at most
BROADCAST_PATHS = 100_000  # paths up to which their posteriors are sent to every executor
SALTS = 32
ROUNDS, RATE, RIDGE = 800, 1.0, 1e-4

_SYMBOLS = "#%$*&^~<>{}=_\\"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"
_DIGITS = "0123456789"


def text_statistics(text: Column) -> list[Column]:
    """What the document classifier sees; all computed in the JVM from the whole text.

    The text is gone over twice: once for its marks (a short string, on which single kinds are then
    counted) and once for its words.
    """
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))
    kinds = _SYMBOLS + "|!" + _CAPITALS + _DIGITS
    marks = F.regexp_replace(text, "[^" + re.sub(r"([\\^\]\[&-])", r"\\\1", kinds) + "]++", "")
    inside = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.split(inside, r"\s+")
    blank = (F.length(inside) == 0).cast("int")  # has one word, the empty one
    n = F.greatest(F.size(words) - blank, F.lit(1))

    def share(of: str) -> Column:
        return (F.length(marks) - F.length(F.translate(marks, of, ""))) / chars

    symbols, bars, shouts = share(_SYMBOLS), share("|"), share("!")
    distinct = (F.size(F.array_distinct(words)) - blank) / n
    return [symbols, bars, shouts, share(_CAPITALS), share(_DIGITS), distinct, n / chars, F.log(n.cast("double")),
            (symbols > 0.05).cast("double"), (bars > 0.02).cast("double"), (shouts > 0.05).cast("double"),
            (distinct < 0.5).cast("double"), (n < 5).cast("double")]


def fit(rows: list[tuple[list[float], int]]) -> tuple[list[float], float]:
    """Weights on raw statistics and the intercept of a ridge logistic regression."""
    y = np.array([r[1] for r in rows], float)
    if len(rows) < 8 or y.min() == y.max():
        return [0.0] * len(text_statistics(F.lit(""))), 3.0 if not len(rows) or y.max() == 1 else -3.0
    x = np.array([r[0] for r in rows], float)
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z, w, b = (x - mean) / spread, np.zeros(x.shape[1]), math.log(y.mean() / (1 - y.mean()))
    for _ in range(ROUNDS):
        off = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - y
        w -= RATE * (z.T @ off / len(y) + RIDGE * w)
        b -= RATE * off.mean()
    # Where nearly all have one label, a statistic that never varied says nothing.
    w = np.where(spread > 1e-8, w, 0)
    return (w / spread).tolist(), float(b - (w * mean / spread).sum())


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[float], float]:
    chosen = chosen_labels(labels, "quality", SAMPLE_ROWS, 0.7)
    seen = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    # The side that is sent out has about SAMPLE_ROWS ids at most; only statistics reach the driver.
    rows = seen.join(F.broadcast(chosen), "doc_id").select("doc_id", F.array(*text_statistics(F.col("text"))).alias("x"), "label")
    # Of a doc_id that repeats one row counts, whatever their order.
    rows = rows.groupBy("doc_id").agg(F.min("x").alias("x"), F.min("label").alias("label")).collect()
    return fit(sorted((list(r["x"]), r["label"]) for r in rows))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def evidence(docs: DataFrame, model: tuple[list[float], float]) -> Column:
    """The document classifier's log odds, between -12 and 12."""
    total = F.lit(model[1])
    for weight, statistic in zip(model[0], text_statistics(docs["text"])):
        total = total + F.lit(weight) * statistic
    return F.least(F.greatest(total, F.lit(-12.0)), F.lit(12.0))


def site(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of each row; null counts as empty."""
    source = F.coalesce(docs["source"].cast("string"), F.lit(""))
    return F.substring_index(source, "/", 1), F.concat(source, F.lit("/"), F.coalesce(docs["lang"].cast("string"), F.lit("")))


def _strength(groups: DataFrame, parent: Column, n: str, s: str) -> Column:
    """Prior strength by the method of moments: how little groups differ from their parent's mean."""
    total = F.sum(n)
    within = F.sum(F.col(n) * parent * (1 - parent)) / total
    between = F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - parent, 2)) / total - within * F.count(F.lit(1)) / total
    return F.least(F.greatest(within / F.greatest(between, F.lit(1e-9)) - 1, F.lit(2.0)), F.lit(1e6))


def path_means(scored: DataFrame, host: str, path: str, odds: str) -> tuple[DataFrame, float]:
    """Per path the shrunken mean of what ``scored`` has of its documents' evidence, and the global mean."""
    paths = cut(scored.select(F.col(host).alias("host"), F.col(path).alias("path"), (1 / (1 + F.exp(-F.col(odds)))).alias("p"))
                .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = (whole["s"] + 1) / (whole["n"] + 2) if whole["n"] else 0.5
    alpha = hosts.select(_strength(hosts, F.lit(mean), "hn", "hs")).first()[0] or 2.0
    hosts = hosts.select("host", ((F.col("hs") + alpha * mean) / (F.col("hn") + alpha)).alias("host_mean"))
    joined = paths.join(hosts, "host")
    beta = joined.select(_strength(joined, F.col("host_mean"), "n", "s")).first()[0] or 2.0
    means = cut(joined.select("path", ((F.col("s") + beta * F.col("host_mean")) / (F.col("n") + beta)).alias("path_mean")))
    release(paths)
    return means, mean


def site_posteriors(docs: DataFrame, model: tuple[list[float], float]) -> tuple[DataFrame, float]:
    """Per path of ``docs`` the shrunken mean, and the global mean."""
    host, path = site(docs)
    return path_means(docs.select(host.alias("host"), path.alias("path"), evidence(docs, model).alias("odds")), "host", "path", "odds")


def with_quality(docs: DataFrame, model: tuple[list[float], float], name: str) -> DataFrame:
    """``docs`` with the posterior probability of good quality as column ``name``.

    The columns of ``docs`` are written once with each row's evidence, so that texts are gone over
    once; what is returned reads that table.
    """
    host, path, odds, key, mean, salt = (fresh_name(docs, c) for c in ("site_host", "site_path", "own_evidence", "path_key", "path_mean", "salt"))
    places = site(docs)
    scored = cut(docs.withColumns({host: places[0], path: places[1], odds: evidence(docs, model)}))
    return posterior(scored, host, path, odds, key, mean, salt, name)


def posterior(scored: DataFrame, host: str, path: str, odds: str, key: str, mean: str, salt: str, name: str) -> DataFrame:
    """``scored`` with its odds moved by how its path's odds differ from the global ones, as ``name``; without the helpers."""
    means, overall = path_means(scored, host, path, odds)
    means = means.select(F.col("path").alias(key), F.col("path_mean").alias(mean))
    if means.count() <= BROADCAST_PATHS:
        joined = scored.join(F.broadcast(means), F.col(path) == F.col(key))
    else:  # a hot path's rows are dealt over sub-keys
        spread = scored.withColumn(salt, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        means = means.withColumn(f"{salt}_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = spread.join(means, (F.col(path) == F.col(key)) & (F.col(salt) == F.col(f"{salt}_"))).drop(salt, f"{salt}_")
    shift = _logit(F.col(mean)) - _logit(F.lit(overall))
    return joined.withColumn(name, 1 / (1 + F.exp(-(F.col(odds) + shift)))).drop(host, path, odds, key, mean)


def score_quality(docs: DataFrame, model: tuple[list[float], float]) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): doc_id, quality (0 to 1), keep.

    Null texts count as empty, null sources and languages as an empty name. Repeated rows count as
    often as they stand there, null ids stay null; other columns are ignored. An empty table gives
    no rows.
    """
    host, path = site(docs)
    scored = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"), path.alias("path"), evidence(docs, model).alias("odds")))
    scored = posterior(scored, "host", "path", "odds", "path_key", "path_mean", "salt", "quality")
    return scored.select("doc_id", "quality", (F.col("quality") >= 0.5).alias("keep"))


def keep_good(docs: DataFrame, model: tuple[list[float], float]) -> DataFrame:
    """The rows of ``docs`` with a posterior of at least one half, with all their columns; edge cases as in ``score_quality``."""
    name = fresh_name(docs, "quality_score")
    return with_quality(docs, model, name).where(F.col(name) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
