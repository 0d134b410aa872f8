"""Licence families in documents: a trained paragraph classifier, confirmed by templates.

Paragraphs are lines; a long one is looked at in overlapping stretches. Word uni- and bigrams,
hashed to buckets, go through a sparse logistic regression with one class per family and one for
everything else. It is trained on damaged copies of the templates, set among words of the corpus,
against paragraphs of the corpus and legal phrases that name no family; a temperature fitted on
further copies calibrates it, and a family counts only above a probability. What it predicts is
then compared with the family's templates: enough of one must really be there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import binary_parts, slices, table, text_or_empty
from forgelake.llm.decontamination import CLASSES
from forgelake.llm.hashing import words_of
from forgelake.llm.linear import FollowTheLeader, Settings, softmax, temperature

BITS = 15
STRETCH_WORDS, STRIDE_WORDS = 48, 24
#: Probability from which a family is predicted, and share of a template that confirms it.
LEAST_SCORE = 0.5
LEAST_OVERLAP = 0.6
#: Paragraphs of the corpus that stand for everything else in training.
SAMPLE_PARAGRAPHS = 3000
LONGEST_SAMPLED = 4000
COPIES = 60
SLICE_BYTES = 1 << 20

#: Usual notices of each family.
TEMPLATES = {
    "AGPL": ["licensed under the GNU Affero General Public License version 3",
             "GNU Affero General Public License as published by the Free Software Foundation"],
    "Apache": ["Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License",
               "SPDX-License-Identifier: Apache-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Use of this source code is governed by a BSD-style license", "licensed under the BSD 3-Clause License"],
    "CC-BY": ["licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "CC-BY-NC": ["licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
                 "Licensed under CC BY-NC 4.0"],
    "CC-BY-SA": ["licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
                 "Licensed under CC BY-SA 4.0"],
    "CC0": ["released into the public domain under CC0 1.0 Universal", "CC0 1.0 Public Domain Dedication"],
    "EPL": ["made available under the terms of the Eclipse Public License 2.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3",
            "under the terms of the GNU General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "ISC": ["Permission to use, copy, modify, and or distribute this software for any purpose with or without fee",
            "Released under the ISC License"],
    "LGPL": ["under the terms of the GNU Lesser General Public License", "licensed under the LGPL version 2.1"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "SPDX-License-Identifier: MIT"],
    "MPL": ["subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"],
}
#: Legal wording without a family.
OTHER = [
    "All rights reserved", "This license may be changed without notice", "Please read the license agreement carefully",
    "The driver must hold a valid license", "Permission is required to reproduce this work",
    "Distributed without any warranty of any kind", "The general public is welcome", "Version 2.0 was released in May",
    "This software is provided by the vendor under a commercial agreement", "Attribution of the painting is disputed",
    "The foundation published the terms of use", "This work was released under the name of its author",
]
FAMILIES = sorted(TEMPLATES)
CLASSES_OUT = [*FAMILIES, "unknown"]

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def grams(hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words, buckets of pairs, and whether the pair lies within one paragraph."""
    shift = np.uint64(64 - BITS)
    after = np.r_[hashes[1:], np.zeros(min(len(hashes), 1), np.uint64)]
    pair = (hashes * np.uint64(0x9E3779B97F4A7C15) + after) * np.uint64(0xD6E8FEB86659FD93)
    inside = np.r_[of[1:] == of[:-1], np.zeros(min(len(of), 1), bool)]
    return (hashes >> shift).astype(np.int64), (pair >> shift).astype(np.int64), inside


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """One paragraph: its buckets, each with the weight that makes the length count little."""
    data = np.frombuffer(text.encode(), np.uint8)
    of, _, _, hashes = words_of(data, np.array([0, len(data)]), CLASSES)
    one, two, inside = grams(hashes, of)
    index, times = np.unique(np.r_[one, two[inside]], return_counts=True)
    return index, times / np.sqrt(max(len(one), 1))


def examples(corpus: list[str], seed: int = 11) -> list[tuple[str, int]]:
    """Damaged templates with their family, and everything else."""
    draw = np.random.default_rng(seed)
    filler = [w for p in corpus for w in p.split()[:20]] or ["and"]
    out = [(p, len(FAMILIES)) for p in corpus]

    def around(words: list[str]) -> str:
        kept = [w for w in words if draw.random() > 0.06]
        if draw.random() < 0.5:
            kept = [str(w) for w in draw.choice(filler, draw.integers(0, 12))] + kept
        if draw.random() < 0.5:
            kept += [str(w) for w in draw.choice(filler, draw.integers(0, 12))]
        return " ".join(kept)

    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            out += [(around(template.split()), k) for _ in range(COPIES)]
    for phrase in OTHER:
        out += [(around(phrase.split()), len(FAMILIES)) for _ in range(COPIES // 4)]
    order = draw.permutation(len(out))
    return [out[i] for i in order]


def trained(corpus: list[str]) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, intercepts, temperature. ``corpus`` are paragraphs without a template in them."""
    rows = [(*vector(text), label) for text, label in examples(corpus)]
    model = FollowTheLeader(len(CLASSES_OUT), 1 << BITS, Settings(alpha=0.3, l1=0.02, l2=0.02, epochs=3))
    w = model.fit([r for i, r in enumerate(rows) if i % 5]).weights()
    rest = [r for i, r in enumerate(rows) if i % 5 == 0]
    logits = np.array([v @ w[x] + w[-1] for x, v, _ in rest])
    return w[:-1].astype(np.float32), w[-1], temperature(logits, np.array([y for _, _, y in rest]))


def pairs_of(text: str) -> set[tuple[str, ...]]:
    words = WORD.findall(text.translate(LOWER))
    return {tuple(words[i : i + 2]) for i in range(max(len(words) - 1, 1))}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEMPLATE_PAIRS = {family: [pairs_of(t) for t in texts] for family, texts in TEMPLATES.items()}


def overlap(text: str, family: str) -> float:
    """The largest share of a template's word pairs that the text has."""
    have = pairs_of(text)
    return max(len(want & have) / len(want) for want in TEMPLATE_PAIRS[family])


def confirmed(text: str, likely: dict[str, float]) -> dict[str, float]:
    """Of the families that a paragraph may name, those that its words bear out.

    The likeliest needs a good share of one of its templates. A further one needs this too and, of a
    template, all that sets it apart from the templates of those before: notices have much in common.
    """
    have, found, before = pairs_of(text), {}, set()
    for n, (family, p) in enumerate(sorted(likely.items(), key=lambda x: (-x[1], x[0]))):
        good = [want for want in TEMPLATE_PAIRS[family] if len(want & have) >= LEAST_OVERLAP * len(want)]
        if n:
            good = [want for want in good if want - before and want - before <= have]
        if good:
            found[family] = p
        if good or not n:
            before = before.union(*TEMPLATE_PAIRS[family])
    return found


def named(text: str) -> bool:
    return any(overlap(text, family) >= LEAST_OVERLAP for family in FAMILIES)


def corpus_sample(docs: DataFrame, rows: int) -> list[str]:
    """About that many paragraphs of the corpus, one of a document, without licence notices."""
    draw = F.xxhash64(F.col("doc_id"), F.lit("licence sample"))
    filled = docs.filter(F.length("text") > 0)
    n = filled.count()
    chosen = filled.filter(F.pmod(draw, F.lit(1_000_000)) / 1_000_000 < min(1.0, rows / max(n, 1)))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(line).between(1, LONGEST_SAMPLED))
    line = F.element_at(lines, (F.pmod(F.shiftright(draw, 20), F.greatest(F.size(lines), F.lit(1))) + 1).cast("int"))
    picked = chosen.filter(F.size(lines) > 0).select(line.alias("line"), draw.alias("at"))
    return [r.line for r in picked.orderBy("at", "line").collect() if not named(r.line)]


def scanned(docs: DataFrame, sample_paragraphs: int = SAMPLE_PARAGRAPHS) -> DataFrame:
    """doc_id, n_paragraphs, n_license, licenses, score per row.

    ``n_license`` counts the paragraphs with a confirmed family, ``licenses`` joins the families
    by commas in ascending order, ``score`` is the best probability against the unknown class, 0
    without any. A paragraph may name several families. NULL and
    empty texts have no paragraphs. Repeated rows each get their result; only doc_id and text
    are used. An empty table is scanned by a classifier trained without a corpus.
    """
    weights, bias, t = trained(corpus_sample(docs, sample_paragraphs))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1), SLICE_BYTES):
                yield scan_slice(batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first))

    def scan_slice(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        offsets, data = binary_parts(texts)
        offsets = offsets.astype(np.int64)
        breaks = np.flatnonzero(data[offsets[0] : offsets[-1]] == ord("\n")) + offsets[0] + 1
        bounds = np.unique(np.r_[offsets, breaks])
        of, starts, ends, hashes = words_of(data, bounds, CLASSES)
        n = len(texts)
        found: list[dict[str, float]] = [{} for _ in range(n)]
        n_paragraphs, n_license = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(of):
            paragraphs, begin = np.unique(of, return_index=True)
            doc = np.searchsorted(offsets, bounds[paragraphs], "right") - 1
            n_paragraphs = np.bincount(doc, minlength=n)
            for k, likely in predicted(hashes, of, np.r_[begin, len(of)]):
                a, b = begin[k], (np.r_[begin, len(of)])[k + 1]
                text = data[starts[a] : ends[b - 1]].tobytes().decode("utf-8", "replace")
                families = confirmed(text, likely)
                n_license[doc[k]] += bool(families)
                best = found[doc[k]]
                for family, p in families.items():
                    best[family] = max(best.get(family, 0.0), p)
        return pa.RecordBatch.from_arrays(
            [
                ids, pa.array(n_paragraphs.astype(np.int64)), pa.array(n_license),
                pa.array([",".join(sorted(x)) for x in found], pa.string()),
                pa.array([max(x.values(), default=0.0) for x in found], pa.float64()),
            ],
            names=["doc_id", "n_paragraphs", "n_license", "licenses", "score"],
        )

    def predicted(hashes: np.ndarray, of: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, dict[str, float]]]:
        """Paragraphs with the families that are likelier than none in one of their stretches.

        Each family is held against the unknown class alone: a notice that names two would else
        leave neither with half of the probability.
        """
        one, two, inside = grams(hashes, of)
        part = weights[one].astype(np.float64)
        pair = weights[two]
        pair[~inside] = 0
        sums = np.vstack([np.zeros((1, len(CLASSES_OUT))), np.cumsum(part + pair, axis=0)])
        size = np.diff(begin)
        pieces = np.maximum(-(-(size - STRETCH_WORDS) // STRIDE_WORDS), 0) + 1
        owner = np.repeat(np.arange(len(size)), pieces)
        first = begin[owner] + STRIDE_WORDS * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        last = np.minimum(first + STRETCH_WORDS, begin[owner + 1])
        p = softmax(((sums[last] - sums[first]) / np.sqrt(last - first)[:, None] + bias) / t)
        score = p[:, :-1] / (p[:, :-1] + p[:, -1:])
        done: dict[int, dict[str, float]] = {}
        for i, family in zip(*np.nonzero(score >= LEAST_SCORE)):
            likely = done.setdefault(int(owner[i]), {})
            likely[FAMILIES[family]] = max(likely.get(FAMILIES[family], 0.0), float(score[i, family]))
        yield from sorted(done.items())

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_paragraphs long, n_license long, licenses string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
