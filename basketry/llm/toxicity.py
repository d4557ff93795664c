"""Toxicity scores: boosted trees over dense text features, calibrated.

The lexicon is learned: openings of words that are frequent in toxic and rare
in other labelled documents. Features are its densities, how near the second
person is to its words, capitals, punctuation and obfuscation rates. Boosted
trees make a margin of them and isotonic regression, fitted on labelled rows
that the trees have not seen, makes the margin a probability.
"""

from __future__ import annotations

import functools
import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import SEED, in_folds, python_tasks
from basketry.session import materialize

#: Labelled rows of each class that the model is fitted on, at the most.
TOXIC_ROWS, OTHER_ROWS = 3000, 6000
#: Lengths of the word openings, and how many the lexicon holds at the most.
OPENINGS, LEXICON = (4, 5, 6), 500
FOLDS = 5  # fold 0 is held out, fold 1 calibrates, the others fit

# Words of the second person in the corpus' languages.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes "
    "vous votre vos tú ti tu tus usted ustedes vosotros vuestro".split()
)

_LEET = str.maketrans("0134578@$!", "oieastbasi")
_MIXED = re.compile(r"[^\W\d_][\d@$*!+]+[^\W\d_]\w*")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_SPACED = re.compile(r"(?:\b[^\W\d_][ .\-_]){3,}")
_LETTERS = re.compile(r"[\W_]+")


@functools.cache
def _capitals() -> np.ndarray:
    """Which code points are capitals, in any script."""
    return np.array([chr(i).isupper() for i in range(sys.maxunicode + 1)])


def openings(words: list[str]) -> set[str]:
    return {w[:n] for w in set(words) for n in OPENINGS if len(w) >= n}


def features(text: str, lexicon: dict[str, float], starts: frozenset[str]) -> list[float]:
    """Dense features of a whole text; ``starts`` are the lexicon's shortest openings."""
    words = text.lower().split()
    n = len(words)
    shortest = min(OPENINGS)

    def weight(word: str) -> float:
        return max((lexicon.get(word[:k], 0.0) for k in OPENINGS), default=0.0)

    at = [i for i, w in enumerate(words) if w[:shortest] in starts]
    hits = [(i, x) for i in at if (x := weight(words[i])) > 0]
    hidden = 0
    for found in _MIXED.findall(text):
        plain = _LETTERS.sub("", found.lower().translate(_LEET))
        hidden += weight(plain) > 0
    for word in words:
        if not word[0].isalnum() and len(word) > 4:
            hidden += weight(_LETTERS.sub("", word)) > 0
    places = [i for i, _ in hits]
    second = [i for i, w in enumerate(words) if w.strip(".,;:!?") in SECOND_PERSON]
    near = 0
    if places and second:
        other = np.array(second)
        gaps = np.abs(other[np.clip(np.searchsorted(other, places), 0, len(other) - 1)] - places)
        back = np.abs(other[np.clip(np.searchsorted(other, places) - 1, 0, len(other) - 1)] - places)
        near = int((np.minimum(gaps, back) <= 5).sum())
    dense = 0
    if places:
        spots = np.array(places)
        dense = int((np.searchsorted(spots, spots + 30) - np.arange(len(spots))).max())
    chars, per_word = max(1, len(text)), max(1, n)
    capitals = int(_capitals()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].sum())
    marks = sum(text.count(c) for c in ".,;:!?*#%&$@")
    return [
        math.log1p(n),
        float(len(hits)),
        1000.0 * len(hits) / per_word,
        max((x for _, x in hits), default=0.0),
        sum(x for _, x in hits),
        float(dense),
        float(near),
        1000.0 * len(second) / per_word,
        capitals / chars,
        marks / chars,
        (text.count("!") + text.count("?")) / chars,
        1000.0 * len(_MIXED.findall(text)) / per_word,
        1000.0 * len(_STRETCHED.findall(text)) / chars,
        1000.0 * len(_SPACED.findall(text)) / chars,
        float(hidden),
    ]


@dataclass
class ToxicityModel:
    """A fitted model; ``constant`` stands in where the labels are of one class."""

    lexicon: dict[str, float]
    trees: object = None
    curve: object = None
    constant: float | None = None


def _features_udf(lexicon: dict[str, float]):
    @F.pandas_udf("array<double>")
    def dense(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        starts = frozenset(w[: min(OPENINGS)] for w in lexicon)
        for series in texts:
            yield pd.Series([features(t or "", lexicon, starts) for t in series])

    return dense


def _learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Openings of words by log odds, counted once for each group of copies.

    Copies mostly agree in a MinHash sample, which stands for their group.
    """

    def spell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from basketry.llm.neardup import samples, shingles

        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            sets = [shingles(t) for t in texts]
            yield pd.DataFrame(
                {
                    "kind": [int(samples(s)[0]) if len(s) else -1 for s in sets],
                    "toxic": frame["toxic"],
                    "openings": [sorted(openings(t.lower().split())) for t in texts],
                }
            )

    spelled = materialize(
        rows.select("text", "toxic").mapInPandas(
            spell, "kind long, toxic int, openings array<string>"
        )
    )
    kinds = dict(
        tuple(r) for r in spelled.groupBy("toxic").agg(F.countDistinct("kind")).collect()
    )
    toxic, other = kinds.get(1, 0), kinds.get(0, 0)
    counts = (
        spelled.select("kind", "toxic", F.explode("openings").alias("opening"))
        .distinct()
        .groupBy("opening")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    )
    odds = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log(
        (F.col("c") + 0.5) / F.lit(other + 1.0)
    )
    least = max(3, round(0.004 * toxic))
    best = (
        counts.where(F.col("t") >= least)
        .withColumn("odds", odds)
        .where("odds > 2")
        .orderBy(F.desc(F.col("odds") * F.sqrt("t")), "opening")
        .limit(LEXICON)
        .collect()
    )
    return {r.opening: r.odds for r in best}


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model from labelled documents outside fold 0.

    Uses at most ``TOXIC_ROWS`` and ``OTHER_ROWS`` labelled ids, the first by
    hash, so that the ids that are broadcast to find their texts are bounded.
    All labels are counted; each row weighs as many as it stands for, so a score
    of 0.5 means the same however many labels there are.
    Labels other than 0 and 1, null ids and ids without a document are left
    out; an id with both labels counts as toxic. Labels of one class, or none,
    give a constant.
    """
    python_tasks(docs.sparkSession)
    usable = (
        labels.where(F.col("toxic").isin(0, 1) & in_folds(F.col("doc_id"), range(1, FOLDS), FOLDS))
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    by_hash = usable.orderBy(F.xxhash64(F.lit(SEED), "id"), "id")
    chosen = by_hash.where("toxic = 1").limit(TOXIC_ROWS).union(
        by_hash.where("toxic = 0").limit(OTHER_ROWS)
    )
    stands_for = F.when(
        F.col("toxic") == 1, F.lit(max(1.0, totals.get(1, 0) / TOXIC_ROWS))
    ).otherwise(F.lit(max(1.0, totals.get(0, 0) / OTHER_ROWS)))
    chosen = materialize(chosen.withColumn("weight", stands_for))
    rows = materialize(
        docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")
        .withColumn("calibrates", in_folds(F.col("id"), [1], FOLDS))
    )
    counted = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not counted.get(0) or not counted.get(1):
        return ToxicityModel({}, constant=1.0 if counted.get(1) else 0.0)
    lexicon = _learn_lexicon(rows.where("NOT calibrates"))
    dense = _features_udf(lexicon)
    ready = materialize(
        rows.select(
            F.col("toxic").cast("double").alias("label"),
            "calibrates",
            "weight",
            dense("text").alias("values"),
        )
    ).select("label", "calibrates", "weight", array_to_vector("values").alias("features"))
    kinds = {(r.calibrates, r.label) for r in ready.select("calibrates", "label").distinct().collect()}
    fits = ready.where("NOT calibrates") if len({k for k in kinds if not k[0]}) == 2 else ready
    held = ready.where("calibrates") if len({k for k in kinds if k[0]}) == 2 else ready
    boosted = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=SEED, weightCol="weight")
    trees = boosted.fit(fits.coalesce(4))
    margins = trees.transform(held).select(
        "label", "weight", vector_to_array("rawPrediction")[1].alias("margin")
    )
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight").fit(margins)
    return ToxicityModel(lexicon, trees, curve)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with toxic_score, from 0 to 1, of every whole text.

    A null text is scored as an empty one. Only the text is looked at. An empty
    table stays empty.
    """
    if model.constant is not None:
        return docs.withColumn("toxic_score", F.lit(model.constant))
    python_tasks(docs.sparkSession)
    names = ["features", "rawPrediction", "probability", "prediction", "_margin", "_score"]
    kept = [F.col(f"`{c}`") for c in docs.columns]
    boxed = docs.select(F.struct(*kept).alias("_row"), F.col("text").cast("string").alias("_text"))
    dense = boxed.withColumn("features", array_to_vector(_features_udf(model.lexicon)("_text")))
    raw = model.trees.transform(dense.drop("_text"))
    margin = raw.withColumn("_margin", vector_to_array("rawPrediction")[1]).drop(*names[:4])
    curve = model.curve.copy({model.curve.featuresCol: "_margin", model.curve.predictionCol: "_score"})
    scored = curve.transform(margin)
    probability = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("_score", F.lit(0.0))))
    return scored.select("_row.*", probability.alias("toxic_score"))
