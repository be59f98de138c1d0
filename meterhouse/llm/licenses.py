"""Licence scan: a trained paragraph classifier, confirmed against templates.

Paragraphs are the lines of a text, its words lower-cased runs of letters and digits. A multinomial
logistic regression on sparse word n-grams gives each paragraph a licence family or "unknown". It is
trained on the templates below and parts of them, on sentences that merely sound like licences, and on at
most ``SAMPLE`` paragraphs of the corpus itself that resemble no template. Only n-grams that are themselves
common in the latter two are no features; those of common words that do not stand together elsewhere are.
The level of "unknown" is calibrated on sentences held back from the training, so that at most one in
``FALSE_ALARMS`` of them is taken for a licence. A prediction counts only when a
template of the predicted family shares at least ``CONFIRM`` of the smaller one's word pairs.

Training sees bounded text on the driver. Scanning is DataFrame expressions in the row: the weights and
templates are literals, bounded by the templates, and nothing is shuffled. Every feature has a trigger: its
rarest word or, where all its words are common, its rarest word pair. A paragraph without a trigger holds
no feature and can only be unknown, so it is passed over.

A null or empty text has no paragraphs. Null ids, repeated rows and further columns of ``docs`` pass
through ``scan``. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhouse.llm.tables import documents

SAMPLE = 3_000  # paragraphs
SAMPLE_TEXTS = 500
LONGEST = 20_000  # characters of a sampled text
ORDERS = (1, 2, 3)
COMMON = 3  # unlicensed sentences with an n-gram that make it common
FALSE_ALARMS = 1_000
CUTOFF = 0.5
CONFIRM = 0.5
UNKNOWN = "unknown"
WORD = r"[a-z0-9]+"

# Phrases by which licences are stated.
TEMPLATES = {
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright (c) by the author. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form or by "
        "any means without the prior written permission of the publisher.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL.",
        "You should have received a copy of the GNU Lesser General Public License along with this "
        "library.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
}

# Sentences with the words of licences that state none.
SOUNDS_ALIKE = [
    "Her driving licence was renewed last year.",
    "The licence fee rose again, and the public paid it.",
    "Copyright law is a branch of civil law.",
    "He was licensed to sell wine in the city.",
    "The general public was not admitted to the work.",
    "All rights of way across the field are reserved for walkers.",
    "The Apache helicopter is a version of an older design.",
    "She studied physics at MIT before she moved to the coast.",
    "The film was released under another title in France.",
    "Free software is a matter of liberty, the speaker said.",
    "A table is reserved for the author and all guests.",
    "The creative commons of the town is its market square.",
    "The agreement is subject to the terms of the contract.",
    "Permission to land was granted at noon.",
    "Version 3 of the plan was published in spring.",
    "The source of the river lies in the hills.",
    "The gnu is a large African antelope.",
    "The form was filled in without modification.",
    "The foundation was laid by the mayor.",
    "International attribution of the attack took years.",
    "Members have the right to vote, all others do not.",
    "The conditions of sale are printed on the back of the ticket.",
    "The software was sold with a warranty of two years.",
    "They distributed leaflets under the bridge.",
]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def ngrams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in ORDERS for i in range(len(words) - n + 1)}


def pairs_of(words: list[str]) -> set[str]:
    return {" ".join(p) for p in zip(words, words[1:])}


def parts_of(words: list[str]) -> list[list[str]]:
    """A template and, of a long one, its halves, as they stand in texts with short lines."""
    if len(words) < 16:
        return [words]
    return [words, words[: len(words) // 2], words[len(words) // 2 :]]


def resembles_template(words: list[str]) -> bool:
    mine = pairs_of(words)
    for phrases in TEMPLATES.values():
        for phrase in phrases:
            theirs = pairs_of(words_of(phrase))
            smaller = min(len(mine), len(theirs))
            if smaller and len(mine & theirs) >= CONFIRM * smaller:
                return True
    return False


def unlicensed(docs: DataFrame) -> list[list[str]]:
    """Words of paragraphs of the corpus that resemble no template, in an order of their own."""
    text = F.coalesce("text", F.lit(""))
    few = (
        docs.select(text.alias("text"))
        .where(F.length("text") <= LONGEST)
        .orderBy(F.xxhash64("text"), "text")
        .limit(SAMPLE_TEXTS)
    )
    rows = few.select(F.explode(F.split("text", "\n")).alias("p")).distinct()
    rows = rows.orderBy(F.xxhash64("p"), "p").limit(SAMPLE).collect()
    found = [words_of(r.p) for r in rows]
    return [w for w in found if w and not resembles_template(w)]


class Model:
    """Weights of the features for each family and for unknown, calibrated."""

    def __init__(self, plain: list[list[str]]):
        self.families = sorted(TEMPLATES)
        alike = [words_of(s) for s in SOUNDS_ALIKE]
        trained, held = alike[::2] + plain[::2], alike[1::2] + plain[1::2]
        rows = [
            (part, k)
            for k, family in enumerate(self.families)
            for phrase in TEMPLATES[family]
            for part in parts_of(words_of(phrase))
        ]
        licensed = {g for words, _ in rows for g in ngrams_of(words)}
        common = Counter(g for words in plain + alike for g in ngrams_of(words) & licensed)
        usual = Counter(w for words in plain + alike for w in set(words))
        self.features = sorted(g for g in licensed if common[g] < COMMON)
        triggers = set()
        for g in self.features:
            rarest = min(g.split(), key=lambda w: (usual[w], w))
            if usual[rarest] >= COMMON:  # then ``g`` is two words or more
                rarest = min(pairs_of(g.split()), key=lambda p: (common[p], p))
            triggers.add(rarest)
        self.triggers = sorted(t for t in triggers if " " not in t)
        self.trigger_pairs = sorted(
            t for t in triggers if " " in t and not set(self.triggers) & set(t.split())
        )
        self.number = {g: i for i, g in enumerate(self.features)}
        rows += [(words, len(self.families)) for words in trained]
        k = np.array([k for _, k in rows])
        x = np.array([[*self.vector(words), k] for words, k in rows])
        x, count = np.unique(x, axis=0, return_counts=True)  # most sentences have no feature
        x, k = x[:, :-1], x[:, -1].astype(int)
        classes = len(self.families) + 1
        y = np.eye(classes)[k]
        weight = count / np.bincount(k, count, classes)[k] / classes  # all classes weigh the same
        self.weights, self.bias = np.zeros((x.shape[1], classes)), np.zeros(classes)
        for _ in range(400):
            error = (self.softmax(x) - y) * weight[:, None]
            self.weights -= 2 * (x.T @ error + 1e-4 * self.weights)
            self.bias -= 2 * error.sum(axis=0)
        self.calibrate(np.array([self.vector(w) for w in held]))

    def vector(self, words: list[str]) -> np.ndarray:
        found = np.zeros(len(self.number))
        for g in ngrams_of(words):
            if g in self.number:
                found[self.number[g]] = 1
        return found

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def softmax(self, x: np.ndarray) -> np.ndarray:
        z = self.logits(x)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def calibrate(self, held: np.ndarray) -> None:
        """Raises the level of unknown until so few of the sentences held back seem licensed."""
        z = self.logits(held)
        excess = np.sort(np.log(np.exp(z[:, :-1]).sum(axis=1)) - z[:, -1])[::-1]
        allowed = len(held) // FALSE_ALARMS
        self.bias[-1] += max(0.0, float(excess[allowed]) + 1e-6)


def literal(values: list[str]) -> Column:
    """The values as one array, which the optimizer turns into a constant."""
    return F.split(F.lit("\t".join(values)), "\t")


def numbers_text(values: np.ndarray) -> str:
    return " ".join(repr(float(v)) for v in values)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def ngrams(words: Column, orders: tuple[int, ...]) -> Column:
    """Distinct word n-grams."""

    def of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
        return F.coalesce(joined, F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(n) for n in orders]))


def scan(docs: DataFrame, model: Model, text: str = "text", out: str = "licenses") -> DataFrame:
    """Adds ``out``: (paragraph, family, score) of each paragraph that states a licence."""
    known = literal(model.features)
    weights = F.map_from_arrays(known, literal([numbers_text(row) for row in model.weights]))
    bias = F.split(F.lit(numbers_text(model.bias)), " ").cast("array<double>")
    names = literal([*model.families, UNKNOWN])
    # of each family: the word pairs of its templates
    templates = literal(
        [";".join(",".join(sorted(pairs_of(words_of(p)))) for p in TEMPLATES[f]) for f in model.families]
        + ["-"]
    )

    def predicted(words: Column) -> Column:
        """Class number and probability of the likeliest class."""
        logits = F.aggregate(
            F.array_intersect(ngrams(words, ORDERS), known),
            bias,
            lambda total, g: F.zip_with(
                total,
                F.split(F.element_at(weights, g), " ").cast("array<double>"),
                lambda a, b: a + b,
            ),
        )
        return bound(
            logits,
            lambda z: F.struct(
                (F.array_position(z, F.array_max(z)) - 1).cast("int").alias("k"),
                (
                    F.lit(1.0)
                    / F.aggregate(
                        z, F.lit(0.0), lambda total, v: total + F.exp(v - F.array_max(z))
                    )
                ).alias("score"),
            ),
        )

    def confirmed(words: Column, k: Column) -> Column:
        return bound(
            ngrams(words, (2,)),
            lambda mine: F.exists(
                F.transform(
                    F.split(F.element_at(templates, k + 1), ";"), lambda pairs: F.split(pairs, ",")
                ),
                lambda theirs: F.size(F.array_intersect(mine, theirs))
                >= F.greatest(
                    F.lit(1.0), F.least(F.size(mine), F.size(theirs)) * F.lit(CONFIRM)
                ),
            ),
        )

    def judged(p: Column) -> Column:
        return bound(
            predicted(p["words"]),
            lambda best: F.struct(
                p["paragraph"].alias("paragraph"),
                F.element_at(names, best["k"] + 1).alias("family"),
                F.when(confirmed(p["words"], best["k"]), best["score"])
                .otherwise(0.0)
                .alias("score"),
            ),
        )

    paragraphs = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
        lambda p, i: F.struct(
            i.alias("paragraph"),
            F.regexp_extract_all(F.lower(p), F.lit(WORD), F.lit(0)).alias("words"),
        ),
    )
    starts = sorted({pair.split()[0] for pair in model.trigger_pairs})

    def triggered(words: Column) -> Column:
        after = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
        pairs = F.zip_with(words, after, lambda a, b: F.concat(a, F.lit(" "), b))
        by_pair = F.arrays_overlap(words, literal(starts)) & F.arrays_overlap(
            F.filter(pairs, lambda p: p.isNotNull()), literal(model.trigger_pairs)
        )
        return F.arrays_overlap(words, literal(model.triggers)) | by_pair

    some = F.filter(paragraphs, lambda p: triggered(p["words"]))
    licensed = F.filter(
        F.transform(some, judged), lambda x: (x["family"] != UNKNOWN) & (x["score"] >= CUTOFF)
    )
    return docs.withColumn(out, licensed)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that every document states."""
    docs = documents(spark, folder)
    found = scan(docs, Model(unlicensed(docs)))
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["score"], x["family"])))
    parts = F.transform("licenses", lambda x: F.concat_ws(":", x["paragraph"], x["family"]))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.col("licenses.family"))), ",").alias("families"),
        F.array_join(parts, ",").alias("paragraphs"),
        best["family"].alias("best_family"),
        F.round(best["score"], 6).alias("best_score"),
    )
