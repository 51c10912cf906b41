"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features per text: densities of a fixed insult lexicon and of a learnt one, lexicon words near a
second-person word, capitals, punctuation and disguise rates ("1d1ot").

The learnt lexicon holds words and word stems (first 4, 5, 6 bytes) that occur far more often in
toxic training texts. It is cross-fitted: the trees see each training row with a lexicon counted on
the other half of the rows, so a word cannot vouch for the row it was taken from. A tenth part of
the rows, not seen by the trees, calibrates. Labels come from a bounded sample
(`labelled.TRAINING_ROWS`) outside the held-out fold.

Defined cases: a null or empty text has zero features and gets the score the trees give them;
without any usable label every score is 0.5; repeated rows are scored alike; a null id is not held
out; empty tables give an empty result; extra columns are not inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm import labelled
from shelfline.llm.boosted import Isotonic, Trees, isotonic, train
from shelfline.llm.textbuf import blocks
from shelfline.llm.textstats import distinct_terms, toxicity_features

LIMIT = 0.5
CALIBRATION_FOLDS = (8, 9)
# A lexicon word occurs in this many times more of the toxic texts than of the others, and in this share of the toxic ones.
TIMES_MORE = 20.0
LEAST_SHARE = 0.01
LEAST_TEXTS = 4


def term_hashes(text: Column) -> Column:
    """The distinct words and stems of each text, as hashes."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def found(texts: pa.Array) -> pa.Array:
        sizes, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for block in blocks(texts):
            rows, hashes = distinct_terms(block)
            sizes.append(np.bincount(rows, minlength=block.rows))
            keys.append(hashes)
        borders = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(borders), pa.array(np.concatenate(keys).view(np.int64)))

    return found(text)


def lexicons(sample: DataFrame) -> list[np.ndarray]:
    """Sorted term hashes learnt from even folds, from odd folds, and from all.

    All terms of the sample are counted in Spark; only those that pass come back. A term that passes stands in
    `LEAST_SHARE` of the toxic texts, so their number is bounded by the terms of a text over that share.
    """
    texts = sample.groupBy("fold").agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")).collect()
    of = lambda part, column: sum(r[column] for r in texts if part is None or r["fold"] % 2 == part)
    counts = (
        sample.select("y", F.pmod("fold", F.lit(2)).alias("half"), F.explode(term_hashes(F.col("text"))).alias("term"))
        .groupBy("term").agg(*[F.sum(F.when((F.col("half") == h) & (F.col("y") == y), 1).otherwise(0)).alias(f"c{h}{y}") for h in (0, 1) for y in (0, 1)])
        .where(F.col("c01") + F.col("c11") >= LEAST_TEXTS)
    )
    passes = []
    for part in (0, 1, None):
        hits, clean = (F.col(f"c{part}{y}") if part is not None else F.col(f"c0{y}") + F.col(f"c1{y}") for y in (1, 0))
        toxic, other = of(part, "toxic") or 0, of(part, "n") - (of(part, "toxic") or 0)
        least = max(LEAST_TEXTS / (2 if part is not None else 1), LEAST_SHARE * toxic)
        passes.append((hits >= least) & (hits / F.lit(float(max(toxic, 1))) > TIMES_MORE * (clean + 0.5) / F.lit(float(max(other, 1)))))
    rows = counts.select("term", *[p.alias(f"p{i}") for i, p in enumerate(passes)]).where("p0 or p1 or p2").collect()
    return [np.sort(np.array([r["term"] for r in rows if r[f"p{i}"]], np.int64).view(np.uint64)) for i in range(3)]


@dataclass(frozen=True)
class Model:
    trees: Trees
    calibrate: Isotonic
    lexicon: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.calibrate(self.trees.probability(x)), 0, 1)


def _features(text: Column, lexicon: np.ndarray) -> Column:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def features(texts: pa.Array) -> pa.Array:
        parts = [toxicity_features(block, lexicon) for block in blocks(texts)]
        if not parts:
            return pa.array([], pa.list_(pa.float64()))
        x = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))

    return features(text)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = labelled.TRAINING_ROWS) -> Model:
    """Term counts and about `rows` short feature rows at most come to the driver, both bounded by parameters."""
    sample = labelled.training_texts(docs, labels, "toxic", id_col, text_col, rows)
    even, odd, whole = lexicons(sample)
    found = [
        r for part, lexicon in ((0, odd), (1, even))
        for r in sample.where(F.pmod("fold", F.lit(2)) == part).select("_id", "_th", "fold", "y", _features(F.col("text"), lexicon).alias("x")).collect()
    ]
    if not found:
        return Model(train(np.zeros((0, 1)), np.zeros(0)), isotonic(np.zeros(0), np.zeros(0)), whole)
    found.sort(key=lambda r: (r["_id"], r["_th"]))
    x, y = np.array([r["x"] for r in found]), np.array([r["y"] for r in found])
    aside = np.isin([r["fold"] for r in found], CALIBRATION_FOLDS)
    trees = train(x[~aside], y[~aside])
    return Model(trees, isotonic(trees.probability(x[aside]), y[aside]), whole)


def score(model: Model, text: Column) -> Column:
    @F.arrow_udf(T.DoubleType())
    def probability(texts: pa.Array) -> pa.Array:
        parts = [model.probability(toxicity_features(block, model.lexicon)) for block in blocks(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return probability(text)


def decide(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), labelled.held_out(F.col(id_col)).alias("held_out"), score(model, F.col(text_col)).alias("score")
    ).withColumn("predicted", (F.col("score") >= limit).cast("int"))
