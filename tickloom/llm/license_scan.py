"""Licence notices in texts, paragraph by paragraph.

A paragraph is a run of lines between blank ones. Each of its lines, the paragraph as a whole and the lines over which a
template's words are wrapped are texts to classify. A multinomial logistic regression over sparse word n-grams (one to
three words) gives each a licence family or the class of unknown ones; it is trained on notices built from templates and
on lines of the corpus that share no run of three words with any of them. A family's probability is calibrated by logistic
regression on rows that training leaves out, other forms of the same templates among them, so that it is too high for
wordings that no template has; one below ``CERTAIN`` is unknown. A prediction is confirmed by comparing
the text with the family's templates: a large enough share of a template's runs of three words must stand in it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tickloom.llm.text import only, slices

UNKNOWN = "unknown"
#: Up to so many paragraphs of the corpus, those with the smallest hashes, are examples of unknown ones.
NEGATIVES = 3_000
#: Longer paragraphs are no examples, so that what the driver takes up is bounded. They are scanned like all others.
EXAMPLE = 2_000
CERTAIN, CONFIRMED = 0.5, 0.6
# Sentences by which licences are named or that their texts begin with.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "This software is distributed under the 3-clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
    "proprietary": (
        "All rights reserved. No part of this work may be reproduced without prior written permission.",
        "This document is proprietary and confidential.",
    ),
    "all-rights-reserved": ("All rights reserved.",),
}
#: Reserves rights and grants none, so that it is no licence family: it is reported apart from those.
RESERVED = "all-rights-reserved"
FAMILIES = (UNKNOWN, *sorted(TEMPLATES))
_WORD = re.compile(r"[^\W_]+")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams(words: list[str]) -> list[str]:
    """All runs of one to three words."""
    return [*words, *map(" ".join, zip(words, words[1:])), *map(" ".join, zip(words, words[1:], words[2:]))]


def _threes(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def examples(unknown: list[str]) -> list[tuple[int, int, list[str]]]:
    """(class, part, words): notices as they stand, cut, with words missing and amid other words, and unknown paragraphs."""
    out = []
    other = [words_of(p) for p in unknown if len(words_of(p)) > 3] or [["this", "is", "some", "other", "text"]]
    for label, family in enumerate(FAMILIES[1:], 1):
        for t, template in enumerate(TEMPLATES[family]):
            words = words_of(template)
            forms = [words] * 3 + [words[k:] for k in (1, 2) if len(words) > 6] + [words[:-k] for k in (1, 2) if len(words) > 6]
            forms += [words[:k] + words[k + 1 :] for k in range(0, len(words), 4) if len(words) > 8]
            for k in range(6):
                around = other[(label * 131 + t * 17 + k) % len(other)]
                forms.append(around[: 2 * k] + words + around[2 * k : 4 * k])
            out += [(label, i % 4, f) for i, f in enumerate(forms)]
    return out + [(0, i % 4, words) for i, words in enumerate(map(words_of, unknown)) if words]


class Model:
    """Weights by n-gram, one per class, the classes' intercepts and the calibration of the chosen one."""

    def __init__(self, weights: dict[str, np.ndarray], intercepts: np.ndarray, slope: float, shift: float):
        self.weights, self.intercepts, self.slope, self.shift = weights, intercepts, slope, shift
        self.templates = {f: [_threes(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}
        self.having: dict[tuple[str, ...], list[tuple[str, int]]] = {}
        for f, ts in self.templates.items():
            for k, t in enumerate(ts):
                for three in t:
                    self.having.setdefault(three, []).append((f, k))

    def margins(self, words: list[str]) -> np.ndarray:
        return self.intercepts + self.sums(words)

    def sums(self, words: list[str]) -> np.ndarray:
        """The weights of all runs of one to three words."""
        total, get = np.zeros(len(self.intercepts)), self.weights.get
        known = [w if w in self.weights else "" for w in words]
        for i, a in enumerate(known):
            if a:
                total += get(a)
                if i + 1 < len(known) and known[i + 1]:
                    if (w := get(f"{a} {known[i + 1]}")) is not None:
                        total += w
                    if i + 2 < len(known) and known[i + 2] and (w := get(f"{a} {known[i + 1]} {known[i + 2]}")) is not None:
                        total += w
        return total

    def across(self, words: list[str], of: list[int]) -> np.ndarray:
        """The weights of the runs of words that lie in several lines."""
        total = np.zeros(len(self.intercepts))
        for i in range(len(words) - 1):
            for k in (2, 3):
                if i + k <= len(words) and of[i] != of[i + k - 1]:
                    run = words[i : i + k]
                    if all(w in self.weights for w in run) and (w := self.weights.get(" ".join(run))) is not None:
                        total += w
        return total

    def predict(self, paragraph: str) -> tuple[str, float, float]:
        words = words_of(paragraph)
        return self.decide(self.sums(words), words)

    def decide(self, sums: np.ndarray, words: list[str]) -> tuple[str, float, float]:
        """Family, calibrated probability and the best share of one of its templates; unknown ones have share 0."""
        margins = self.intercepts + sums
        best = int(margins.argmax())
        if best == 0:
            return UNKNOWN, 0.0, 0.0
        lead = margins[best] - np.delete(margins, best).max()
        p = 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * lead + self.shift))))
        if p < CERTAIN:
            return UNKNOWN, p, 0.0
        here = _threes(words)
        return FAMILIES[best], p, max(len(here & t) / len(t) for t in self.templates[FAMILIES[best]])


def _logistic(x: list[float], y: list[int]) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a weak pull to (1, 0)."""
    a, b = 1.0, 0.0
    xs, ys = np.array(x), np.array(y, float)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * xs + b, -50, 50)))
        g = np.array([((p - ys) * xs).sum() + 0.1 * (a - 1), (p - ys).sum() + 0.1 * b])
        w = p * (1 - p)
        h = np.array([[(w * xs * xs).sum() + 0.1, (w * xs).sum()], [(w * xs).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = max(a - step[0], 1e-3), b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def train(docs: DataFrame, negatives: int = NEGATIVES) -> Model:
    """Fit on the templates' notices and on ``negatives`` paragraphs of ``docs``, which has ``text`` without nulls."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where((F.trim("line") != "") & (F.length("line") <= EXAMPLE))
    # Those with small hashes: about twice as many as are wanted, so that only these are compared, sorted and sent.
    different = lines.agg(F.approx_count_distinct("line")).first()[0]
    bound = int(-(1 << 63) + min(1.0, 2 * negatives / max(1, different)) * ((1 << 64) - 1))
    few = lines.where(F.xxhash64("line") <= F.lit(min(bound, (1 << 63) - 1))).distinct()
    drawn = [r["line"] for r in few.orderBy(F.xxhash64("line"), "line").limit(negatives).collect()]
    known = set().union(*(_threes(words_of(t)) for ts in TEMPLATES.values() for t in ts))
    rows = examples([p for p in drawn if not _threes(words_of(p)) & known])
    number: dict[str, int] = {}
    for label, part, words in rows:
        if part and (label or len(number) < 50_000):
            for g in grams(words) if label else words:
                number.setdefault(g, len(number))
    size = len(number)

    def vector(words: list[str]) -> SparseVector:
        counts: dict[int, float] = {}
        for g in grams(words):
            if (k := number.get(g)) is not None:
                counts[k] = counts.get(k, 0.0) + 1.0
        return SparseVector(size, counts)

    schema = StructType([StructField("label", DoubleType()), StructField("part", IntegerType()), StructField("features", VectorUDT())])
    data = spark.createDataFrame([(float(label), part, vector(words)) for label, part, words in rows], schema)
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, standardization=False).fit(data.where("part > 0"))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), np.array(fitted.interceptVector)
    model = Model({g: matrix[:, k] for g, k in number.items()}, intercepts, 1.0, 0.0)
    lead, right = [], []
    for label, part, words in rows:
        if part == 0:
            margins = model.margins(words)
            best = int(margins.argmax())
            if best:
                lead.append(float(margins[best] - np.delete(margins, best).max()))
                right.append(int(best == label))
    if lead:
        model.slope, model.shift = _logistic(lead, right)
    return model


def windows(model: Model, words: list[str], of: list[int]) -> list[tuple[str, int, int]]:
    """(family, first line, last line) of where enough of a template's runs of three words stand close together in more than
    one line; ``of`` has the words' lines."""
    hits: dict[tuple[str, int], list[tuple[int, tuple[str, ...]]]] = {}
    for at, three in enumerate(zip(words, words[1:], words[2:])):
        if three in model.having:
            for key in model.having[three]:
                hits.setdefault(key, []).append((at, three))
    found = set()
    for (family, k), places in hits.items():
        size = len(model.templates[family][k])
        left = right = 0
        inside: Counter[tuple[str, ...]] = Counter()
        while right < len(places):
            inside[places[right][1]] += 1
            while places[right][0] - places[left][0] > 2 * size or inside[places[left][1]] > 1:
                inside[places[left][1]] -= 1
                left += 1
            if sum(map(bool, inside.values())) / size >= CONFIRMED:
                while right + 1 < len(places) and not inside[places[right + 1][1]] and places[right + 1][0] - places[left][0] <= 2 * size:
                    right += 1
                    inside[places[right][1]] += 1
                first, last = of[places[left][0]], of[places[right][0] + 2]
                if first < last:
                    found.add((family, first, last))
                left = right + 1
                inside.clear()
            right += 1
    return sorted(found)


def notices(model: Model, lines: list[str]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Confirmed and unconfirmed (family, first line, last line) of one paragraph; confirmed ones of a family do not overlap."""
    found, doubtful = [], []
    split = [words_of(line) for line in lines]
    sums = [model.sums(words) for words in split]
    for i, words in enumerate(split):
        family, _, share = model.decide(sums[i], words)
        if family != UNKNOWN:
            (found if share >= CONFIRMED else doubtful).append((family, i, i))
    if len(lines) > 1:
        words, of = [w for line in split for w in line], [i for i, line in enumerate(split) for _ in line]
        wide = []
        for family, a, b in windows(model, words, of):
            named, _, share = model.predict("\n".join(lines[a : b + 1]))
            if named == family and share >= CONFIRMED:
                wide.append((family, a, b))
        family, _, share = model.decide(sum(sums) + model.across(words, of), words)
        if family != UNKNOWN and not any(f == family for f, _, _ in found + wide):
            if share >= CONFIRMED:
                wide.append((family, 0, len(lines) - 1))
            elif not any(f == family for f, _, _ in doubtful):
                doubtful.append((family, 0, len(lines) - 1))
        for family, a, b in wide:
            for other in [x for x in found if x[0] == family and x[1] <= b and x[2] >= a]:
                found.remove(other)
                a, b = min(a, other[1]), max(b, other[2])
            found.append((family, a, b))
        doubtful = [x for x in doubtful if not any(a <= x[1] and x[2] <= b for _, a, b in found)]
    return tuple(sorted(x, key=lambda n: (n[1], n[2], n[0])) for x in (found, doubtful))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", negatives: int = NEGATIVES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_paragraphs, n_licensed, families, spans, unconfirmed, reserved``.

    ``n_licensed`` counts the paragraphs with a confirmed family. ``families`` are the confirmed ones, sorted and
    comma-joined; ``spans`` has family:start:end of the lines that confirm them, in code points, end exclusive; ``unconfirmed`` lists predictions that no template confirms in the same way, and
    ``reserved`` the confirmed notices that all rights are reserved, which name no licence and count in none of the others.
    A null or empty text has no paragraphs; identifiers may be null or repeated; an empty table gives an empty one, and the model
    then rests on the templates alone; other columns are not looked at.
    """
    rows = only(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(train(rows, negatives))
    names = ["doc_id", "n_paragraphs", "n_licensed", "families", "spans", "unconfirmed", "reserved"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                at, n, licensed, found, doubtful, reserved = 0, 0, 0, [], [], []
                starts, lines = [], []
                for line in [*text.split("\n"), ""]:
                    if line.strip():
                        starts.append(at), lines.append(line)
                    elif lines:
                        sure, unsure = ([(f, starts[a], starts[b] + len(lines[b])) for f, a, b in x] for x in notices(model, lines))
                        n += 1
                        licensed += any(f != RESERVED for f, _, _ in sure)
                        for x in sure:
                            (reserved if x[0] == RESERVED else found).append(x)
                        doubtful += unsure
                        starts, lines = [], []
                    at += len(line) + 1
                joined = [",".join(f"{f}:{a}:{b}" for f, a, b in x) for x in (found, doubtful, reserved)]
                out.append((n, licensed, ",".join(sorted({f for f, _, _ in found})), *joined))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in zip(*out))], names=names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_paragraphs long, n_licensed long, families string, spans string, unconfirmed string, reserved string")
