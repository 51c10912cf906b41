"""Training rows: a bounded sample of labelled documents, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import bounded_sample, cut_lineage, whole_text

# Labelled rows a model may learn from, about: those with a small id hash.
TRAINING_ROWS = 16_000
HELD_OUT_FOLDS = 5


def held_out(id_col: Column) -> Column:
    """True for ids that no model learns from: crc32 of the id as text is divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(False))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAINING_ROWS
) -> DataFrame:
    """(fold, y, text) of about `rows` labelled documents at most outside the held-out fold, written once.

    Null labels and ids are left out; of several labels of one id the largest counts. Rows that repeat both id
    and text are one row. Label ids are sampled first, then the (id, text) rows they bring, so an id of many
    texts is bounded as well; both samples are broadcast, their size is bounded by `rows`.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_label_id")).agg(F.max(label).cast("double").alias("y"))
    )
    sample = cut_lineage(bounded_sample(known, rows, "_label_id"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.xxhash64(whole_text(text_col)).alias("_th"))
    brought = cut_lineage(
        texts.join(F.broadcast(sample), F.col("_id") == F.col("_label_id")).select("_label_id", "_th", "y").distinct())
    wanted = cut_lineage(bounded_sample(brought, rows, "_label_id", "_th"))
    return cut_lineage(
        texts.join(F.broadcast(wanted), (F.col("_id") == F.col("_label_id")) & (texts["_th"] == wanted["_th"]))
        .select(F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(10)).cast("int").alias("fold"), "y", "text", "_id", texts["_th"])
        .dropDuplicates(["_id", "_th"])
    )
