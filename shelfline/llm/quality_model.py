"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are trained on a bounded sample of labelled rows (`labelled.TRAINING_ROWS`) outside the
held-out fold; the statistics come from the whole text only, never from id, language, source or
labels. Every document is then scored batch by batch with the flattened trees.

Defined cases: a null or empty text has zero statistics and gets the score the trees give them; without
any usable label every score is 0.5; repeated rows are scored alike; a null id is not held out;
empty tables give an empty result; extra columns are not inputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm import labelled
from shelfline.llm.boosted import Trees, train
from shelfline.llm.textbuf import blocks
from shelfline.llm.textstats import quality_features

LIMIT = 0.3


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(texts: pa.Array) -> pa.Array:
    parts = [quality_features(block) for block in blocks(texts)]
    if not parts:
        return pa.array([], pa.list_(pa.float64()))
    x = np.concatenate(parts)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = labelled.TRAINING_ROWS) -> Trees:
    """About `rows` short rows at most of statistics come to the driver."""
    sample = labelled.training_texts(docs, labels, "quality", id_col, text_col, rows)
    found = sample.select("_id", "_th", "y", statistics("text").alias("x")).orderBy("_id", "_th").collect()
    if not found:
        return train(np.zeros((0, 1)), np.zeros(0))
    return train(np.array([r.x for r in found]), np.array([r.y for r in found]))


def score(model: Trees, text: Column) -> Column:
    """Probability of label 1 for a text column."""

    @F.arrow_udf(T.DoubleType())
    def probability(texts: pa.Array) -> pa.Array:
        parts = [model.probability(quality_features(block)) for block in blocks(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return probability(text)


def decide(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), labelled.held_out(F.col(id_col)).alias("held_out"), score(model, F.col(text_col)).alias("score")
    ).withColumn("predicted", (F.col("score") >= limit).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """The documents the classifier does not reject, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score(model, F.col(text_col)) >= limit)
