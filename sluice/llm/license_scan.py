"""Licence scans with a positional index of licence templates and rare-token look-ups.

Document frequencies of the licence words are counted over all documents. Each template's words
are posted with their places, the key phrase's word of highest IDF first. A file's own licence
words of highest IDF are looked up; the postings of a template's key words are intersected by
relative position, rarest first, which leaves the places where the mandatory key phrase stands in
full; there the other words are held against the file by relative position.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(k for k in range(len(self.words) - n + 1) if self.words[k : k + n] == self.key)


def _template(label: str, text: str, key: str, base: bool = False) -> Template:
    return Template(label, tuple(text.split()), tuple(key.split()), base)


# Base phrases with their labels, then the templates this operator adds.
TEMPLATES = [
    _template("cc-by", "cc by", "cc by", True),
    _template("gpl", "general public license", "general public license", True),
    _template("reserved", "all rights reserved", "all rights reserved", True),
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    _template("mit", "released under the mit license", "mit license"),
    _template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    _template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    _template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    _template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    _template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    _template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    _template("lgpl", "gnu lesser general public license", "lesser general public license"),
    _template("agpl", "gnu affero general public license", "affero general public license"),
    _template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    _template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
              "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
              "and or sell copies of the software and to permit persons to whom the software is furnished to do so", "sublicense and or sell copies of the software"),
    _template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
              "copyright notice and this permission notice appear in all copies", "for any purpose with or without fee is hereby granted"),
    _template("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
              "without specific prior written permission", "endorse or promote products derived from this software"),
    _template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain "
              "a copy of the license at", "you may not use this file except in compliance with the license"),
    _template("proprietary", "all rights reserved unauthorized copying is strictly prohibited", "unauthorized copying"),
]

#: Least IDF-weighted share of a template's words that must stand in their places.
LEAST_SHARE = 0.4

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[0x30:0x3A] = _WORD_BYTE[0x61:0x7B] = _WORD_BYTE[0x80:] = True


def _finder(words) -> re.Pattern:
    """Whole words among those given, in lower-cased UTF-8."""
    any_of = b"|".join(re.escape(w.encode()) for w in sorted(words, key=lambda w: (-len(w), w)))
    return re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + any_of + rb")(?![0-9a-z\x80-\xff])")


def word_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which the words of lower-cased UTF-8 begin."""
    inside = _WORD_BYTE[raw]
    inside[1:] &= ~_WORD_BYTE[raw[:-1]]
    return np.flatnonzero(inside)


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[str, int], int]:
    """Of each template word over all documents, and the number of documents."""
    finder = _finder({w for t in templates for w in t.words})

    def run(batches):
        for batch in batches:
            seen: dict[str, int] = {"": batch.num_rows}
            for text in batch.column(0).to_pylist():
                for word in set(finder.findall(text.encode("utf-8", "surrogatepass").lower())) if text else ():
                    word = word.decode()
                    seen[word] = seen.get(word, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}  # one row per template word at most
    return found, found.pop("", 0)


class Scanner:
    """Finds the templates' places in texts."""

    def __init__(self, idf: dict[str, float], templates=TEMPLATES):
        self.idf = {w.encode(): x for w, x in idf.items()}
        self.words = {t: [(w.encode(), k) for k, w in enumerate(t.words)] for t in templates}
        self.keys = {t: sorted(self.words[t][t.key_at : t.key_at + len(t.key)], key=lambda p: -self.idf[p[0]]) for t in templates}
        self.under: dict[bytes, list[Template]] = {}  # a file without a template's rarest key word can't hold it
        for t in templates:
            self.under.setdefault(self.keys[t][0][0], []).append(t)
        self.rare = _finder([w.decode() for w in self.under])
        self.finders: dict[frozenset, re.Pattern] = {}

    def places(self, raw: bytes, starts: np.ndarray, rare: frozenset) -> dict[bytes, np.ndarray]:
        """Word numbers of each word of the templates that are posted under the words ``rare``."""
        if rare not in self.finders:
            self.finders[rare] = _finder({w.decode() for r in rare for t in self.under[r] for w, _ in self.words[t]})
        offsets: dict[bytes, list[int]] = {}
        for m in self.finders[rare].finditer(raw):
            offsets.setdefault(m.group(), []).append(m.start())
        return {w: np.searchsorted(starts, o) for w, o in offsets.items()}

    def begins(self, template: Template, places: dict[bytes, np.ndarray]) -> np.ndarray:
        """Where the template would begin so that its whole key phrase stands in its place."""
        found = None
        for word, at in self.keys[template]:
            if word not in places:
                return np.zeros(0, np.int64)
            found = places[word] - at if found is None else np.intersect1d(found, places[word] - at, assume_unique=True)
            if not len(found):
                break
        return found

    def scan(self, text: str | None):
        """n_words, starts of the base phrases, their labels, share of the best place by label."""
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        if not raw:
            return 0, [], set(), {}
        starts = word_starts(np.frombuffer(raw, np.uint8))
        mine = frozenset(self.rare.findall(raw))
        bases, base, shares = [], set(), {}
        places = self.places(raw, starts, mine) if mine else {}
        for rare in sorted(mine, key=lambda w: (-self.idf[w], w)):
            for template in self.under[rare]:
                begins = self.begins(template, places)
                if not len(begins):
                    continue
                total = sum(self.idf[w] for w, _ in self.words[template])
                share = sum(self.idf[w] * np.isin(begins + k, places.get(w, ())) for w, k in self.words[template]) / total
                good = share >= LEAST_SHARE
                if good.any():
                    shares[template.label] = max(float(share.max()), shares.get(template.label, 0.0))
                    if template.base:
                        bases += begins[good].tolist()
                        base.add(template.label)
        return len(starts), bases, base, shares


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with its licence finds.

    doc_id, n_words, n_base (all places of base phrases), first_word and last_word (smallest and
    largest start, else null), base_labels, labels (base ones and the templates'; distinct, sorted,
    comma-joined, empty if none), score (share of the best-matched template, 0 if none).
    Null text counts as empty; null ids stay null; other columns are ignored; repeated rows give
    repeated results; an empty table gives no rows.
    """
    df, n = document_frequencies(docs, templates)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1e-6 for t in templates for w in t.words}

    def run(batches):
        scanner = Scanner(idf, templates)
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([len(f[1]) for f in found], pa.int64()),
                 pa.array([min(f[1], default=None) for f in found], pa.int64()), pa.array([max(f[1], default=None) for f in found], pa.int64()),
                 pa.array([",".join(sorted(f[2])) for f in found]), pa.array([",".join(sorted(f[3])) for f in found]),
                 pa.array([min(1.0, max(f[3].values(), default=0.0)) for f in found], pa.float64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
