"""Quality by importance resampling: n-gram models of target and raw text.

Words, word pairs and triples of letter classes are hashed into a fixed number
of slots. Two generative models, one of target and one of raw text, give each
slot a probability; a document's importance is the ratio of its probabilities
under both. Documents are drawn without replacement in proportion to it: the k
largest of log importance plus Gumbel noise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.common import SEED, kth_largest, python_tasks
from basketry.session import materialize

SLOTS = 1 << 16
#: Labelled rows of each kind that the models are fitted on, at the most.
MODEL_ROWS = 5000
_U = np.uint64


def _classes() -> np.ndarray:
    """The letter class of each byte: small, capital, digit, beyond ASCII, or itself."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[128:] = ord("a")
    return table


_CLASS = _classes()


def slots(text: str) -> np.ndarray:
    """The slot of every n-gram of a text, repeats included."""
    from basketry.llm.neardup import _mix, word_hashes

    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = _CLASS[data].astype(_U)
    triples = kinds[:-2] | (kinds[1:-1] << _U(8)) | (kinds[2:] << _U(16))
    words = word_hashes(text)
    pairs = _mix(words[:-1] * _U(3) + words[1:])
    pairs[words[:-1] == words[1:]] = _U(1)  # a word repeated
    whole = np.concatenate((_mix(triples + _U(1 << 32)), _mix(words), _mix(pairs)))
    return (whole % _U(SLOTS)).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, alpha: float = 1.0) -> tuple[np.ndarray, float]:
    """The log ratio of each slot, target over raw, and the log prior odds.

    Target text is labelled 1; raw text, which nobody has selected, is labelled
    0. At most ``MODEL_ROWS`` ids of each, the first by hash, are looked up, so
    the broadcast ids are bounded; the prior odds count all labels. Null ids and
    other labels are left out. Without either kind, all ratios and the odds are
    0, and everything is kept.
    """
    python_tasks(docs.sparkSession)
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    totals = {r.quality: r["count"] for r in usable.groupBy("quality").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return np.zeros(SLOTS), 0.0
    by_hash = usable.orderBy(F.xxhash64(F.lit(SEED), "id"), "id")
    chosen = by_hash.where("quality = 1").limit(MODEL_ROWS).union(
        by_hash.where("quality = 0").limit(MODEL_ROWS)
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")
    ).join(F.broadcast(materialize(chosen)), "id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, SLOTS))
        for frame in frames:
            for quality, text in zip(frame["quality"], frame["text"]):
                sums[quality] += np.bincount(slots(text or ""), minlength=SLOTS)
        for quality in (0, 1):
            found = np.flatnonzero(sums[quality])
            yield pd.DataFrame({"quality": quality, "slot": found, "n": sums[quality][found]})

    counted = (
        rows.select("quality", "text")
        .mapInPandas(count, "quality int, slot int, n double")
        .groupBy("quality", "slot")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most two numbers a slot
    )
    sums = np.full((2, SLOTS), alpha)
    sums[counted["quality"], counted["slot"]] += counted["n"]
    ratio = np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())
    return ratio, float(np.log(totals[1] / totals[0]))


def _gumbel(*keys: Column | str) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *keys), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 53))))


def select(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with log_importance, quality_key and selected.

    ``log_importance`` is the log ratio of the whole text under both models
    plus the prior odds. The number k of documents to draw is how many have
    more importance than 0, that is, are likelier target than raw text. Rows
    tied with the k-th are all selected. Noise is by doc_id and text, so reruns
    agree and rows that repeat share their fate. A null text is empty and has
    the prior odds. An empty table stays empty. Columns of these names are
    replaced; no others matter. Writes two numbers a row, from which the k-th key
    is found; the rows are scored again for the result, so no text is written.
    """
    docs = docs.drop("log_importance", "quality_key", "selected")
    ratio, prior = fit(docs, labels)
    python_tasks(docs.sparkSession)
    ratios = docs.sparkSession.sparkContext.broadcast(ratio)  # of SLOTS numbers

    @F.pandas_udf("double")
    def importance(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = ratios.value
        for series in texts:
            yield pd.Series([float(table[slots(t or "")].sum()) for t in series], dtype=float)

    scored = docs.withColumn(
        "log_importance", importance(F.col("text").cast("string")) + F.lit(prior)
    ).withColumn("quality_key", F.col("log_importance") + _gumbel("doc_id", "text"))
    keyed = materialize(scored.select("log_importance", "quality_key"))
    k = keyed.where("log_importance >= 0").count()
    least = kth_largest(keyed, "quality_key", k) if k else float("inf")
    return scored.withColumn("selected", F.col("quality_key") >= F.lit(least))
