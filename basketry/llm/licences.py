"""Licence notices by a paragraph classifier with an unknown class.

Paragraphs (lines) become sparse bags of hashed words and word pairs. A
multinomial logistic regression, trained on variations of the templates below
and on paragraphs of the corpus itself as the unknown class, names a licence
family. Its probabilities are calibrated by a temperature on variations that it
has not seen, and a prediction stands only if a template of the family, word
pair by word pair, is largely found in the paragraph.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from basketry.llm.common import SEED, python_tasks, texts_of

SLOTS = 1 << 14
#: What trains the unknown class: documents of the corpus, paragraphs of these, and
#: a paragraph's characters, at the most. Variations that are made of each template.
UNKNOWN_DOCS, UNKNOWN_LINES, LINE_CHARS, VARIATIONS = 300, 4000, 2000, 40
#: Least calibrated probability, and least share of a template's word pairs.
LEAST_PROBABILITY, LEAST_SHARE = 0.5, 0.6

# Wordings of licence notices, by family.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Released under the GNU Affero General Public License.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "No part of this work may be reproduced without permission.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "creative-commons": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain.",
        "Released into the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
        "SPDX-License-Identifier: Unlicense",
    ),
}
FAMILIES = (*TEMPLATES, "unknown")
_MARKS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _MARKS, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(_MARKS)
)


def _words(text: str) -> np.ndarray:
    from basketry.llm.neardup import word_hashes

    return word_hashes(text, _FOLD)


def _pairs(words: np.ndarray) -> np.ndarray:
    from basketry.llm.neardup import _mix

    return np.unique(_mix(words[:-1] * np.uint64(3) + words[1:]))


def slots(words: np.ndarray) -> np.ndarray:
    """The sparse features of a paragraph: slots of its words and pairs."""
    both = np.concatenate((words, _pairs(words)))
    return np.unique((both >> np.uint64(7)) % np.uint64(SLOTS)).astype(np.int64)


def variations(template: str, random: np.random.Generator, n: int) -> list[str]:
    """The template, and versions of it with words left out, changed or added."""
    words = template.split()
    out = [template, template.upper(), template.rstrip(".")]
    while len(out) < n:
        drop = random.random(len(words)) < 0.08 if len(words) > 3 else np.zeros(len(words), bool)
        kept = [w for w, d in zip(words, drop) if not d]
        kept = [str(random.integers(1, 6)) if w[0].isdigit() else w for w in kept]
        ahead = [f"x{random.integers(0, 999)}" for _ in range(random.integers(0, 4))]
        behind = [f"y{random.integers(0, 999)}" for _ in range(random.integers(0, 4))]
        out.append(" ".join((*ahead, *kept, *behind)))
    return out


@dataclass
class LicenceModel:
    weights: np.ndarray  # slots x families
    intercept: np.ndarray
    temperature: float
    templates: list[tuple[int, np.ndarray]]  # family and word pairs
    known_pairs: np.ndarray

    def probabilities(self, words: np.ndarray) -> np.ndarray:
        logits = (self.intercept + self.weights[slots(words)].sum(0)) / self.temperature
        weighed = np.exp(logits - logits.max())
        return weighed / weighed.sum()

    def read(self, paragraph: str) -> tuple[str, float, float] | None:
        """Family, probability and share of the template, if one is confirmed."""
        words = _words(paragraph)
        if not len(words):
            return None
        found = self.probabilities(words)
        best = int(found.argmax())
        if FAMILIES[best] == "unknown" or found[best] < LEAST_PROBABILITY:
            return None
        own = _pairs(words)
        share = max(
            (np.isin(t, own).mean() for family, t in self.templates if family == best and len(t)),
            default=0.0,
        )
        return (FAMILIES[best], float(found[best]), float(share)) if share >= LEAST_SHARE else None

    def may_hold(self, text: str) -> bool:
        """Whether any template could be confirmed: a text without their pairs is clear."""
        words = _words(text)
        return len(words) > 1 and bool(np.isin(_pairs(words), self.known_pairs).any())


def fit(docs: DataFrame) -> LicenceModel:
    """A model from the templates and a bounded sample of the corpus.

    The sample gives the unknown class its paragraphs: ``UNKNOWN_LINES`` by hash, of
    no more than ``LINE_CHARS`` characters, from ``UNKNOWN_DOCS`` texts by hash; those
    that share word pairs with a template are left out. From an empty table, texts
    of made-up words stand in.
    """
    spark = docs.sparkSession
    random = np.random.default_rng(SEED)
    templates = [(i, _pairs(_words(t))) for i, f in enumerate(TEMPLATES) for t in TEMPLATES[f]]
    known = np.unique(np.concatenate([t for _, t in templates]))
    taken = texts_of(docs).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(UNKNOWN_DOCS)
    found = taken.select(F.explode(F.split("text", "\n")).alias("line")).where(
        (F.trim("line") != "") & (F.char_length("line") <= LINE_CHARS)
    )
    chosen = found.orderBy(F.xxhash64(F.lit(SEED), "line"), "line").limit(UNKNOWN_LINES)
    lines = [r.line for r in chosen.collect()]
    lines += [" ".join(f"z{x}" for x in random.integers(0, 5000, 12)) for _ in range(200)]
    examples, held = [], []
    for i, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            made = [(i, slots(_words(v))) for v in variations(template, random, VARIATIONS)]
            examples += made[: VARIATIONS * 4 // 5]
            held += made[VARIATIONS * 4 // 5 :]
    unknown = [w for w in map(_words, lines) if len(w) and not np.isin(_pairs(w), known).any()]
    unknown = [(len(TEMPLATES), slots(w)) for w in unknown]
    cut = len(unknown) * 4 // 5
    examples, held = examples + unknown[:cut], held + unknown[cut:]
    schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    rows = [(float(i), SparseVector(SLOTS, s, np.ones(len(s)))) for i, s in examples]
    fitted = LogisticRegression(
        family="multinomial", regParam=1e-3, maxIter=40, standardization=False
    ).fit(spark.createDataFrame(rows, schema))
    weights, intercept = fitted.coefficientMatrix.toArray().T, fitted.interceptVector.toArray()
    logits = np.array([intercept + weights[s].sum(0) for _, s in held])
    truth = np.array([i for i, _ in held])

    def loss(t: float) -> float:
        z = logits / t
        top = z.max(1)
        return float((np.log(np.exp(z - top[:, None]).sum(1)) + top - z[np.arange(len(z)), truth]).mean())

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    return LicenceModel(weights, intercept, temperature, templates, known)


def scan(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """A row per licence notice: doc_id, paragraph, family, probability, share.

    ``paragraph`` numbers the text's lines from 0. A null or empty text has
    none; rows that repeat are scanned each; null keys stay null. Other columns
    are left out. Whole texts are read; a text that shares no word pair with
    any template is cleared at once, as no template could be confirmed in it.
    """
    python_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS x families numbers

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in frames:
            rows = []
            for key, text in zip(frame["doc_id"], frame["text"]):
                if known.may_hold(text):
                    for number, line in enumerate(text.split("\n")):
                        found = known.read(line)
                        if found:
                            rows.append((None if pd.isna(key) else int(key), number, *found))
            out = pd.DataFrame(rows, columns=["doc_id", "paragraph", "family", "probability", "share"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return texts_of(docs).mapInPandas(
        read, "doc_id long, paragraph int, family string, probability double, share double"
    )
