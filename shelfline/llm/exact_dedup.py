"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

Two texts are equal when they are identical after all white space is deleted; SHA-256 of the
normalised text stands for it. A Misra-Gries summary (the frequent-items sketch behind
`approx_top_k`, which keeps a bounded number of counters and merges per task) proposes the
digests with a large share of the rows. Their winners and sizes are then counted exactly and
broadcast (at most `1 / share` rows, whatever the input), so rows of a hot group are settled
where they are read. All other digests are shuffled; each has less than about `share` of the rows.

Of equal texts the row with the most code points in its original text stays, then the smallest
id. Defined cases: a null text is empty, and empty texts are one group; a null id comes last;
rows that repeat the survivor's id and length are that survivor (`decide` marks all of them,
`deduplicate` leaves one); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import WHITE, boxed, cut_lineage, id_order, unboxed, whole_text

SHARE = 1 / 2000
COUNTERS = 16384


def digest(text_col: str = "text"):
    bare = F.regexp_replace(whole_text(text_col), f"{WHITE}+", "")
    return F.sha2(bare.cast("binary"), 256)


def _best():
    """The row that stays: longest, then smallest id with null last."""
    return F.min(F.struct((-F.col("n")).alias("less"), id_order().alias("id")))


def heavy_winners(slim: DataFrame, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """(sha, best, group_size) of the digests that hold more than `share` of the rows, exact.

    The summary only proposes; a digest it misses is settled by the shuffle instead.
    """
    most = int(1 / share)
    summary = slim.agg(F.expr(f"approx_top_k(sha, {most}, {counters})").alias("top"), F.count(F.lit(1)).alias("rows"))
    proposed = (
        summary.select(F.explode("top").alias("top"), "rows")
        .where(F.col("top.count") > F.greatest(F.lit(1), F.col("rows") * F.lit(share)))
        .select(F.col("top.item").alias("sha"))
    )
    # at most 1 / share digests
    hot = slim.join(F.broadcast(proposed), "sha", "left_semi")
    return cut_lineage(hot.groupBy("sha").agg(_best().alias("best"), F.count(F.lit(1)).alias("group_size")))


def slim_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.char_length(whole_text(text_col)).alias("n"), digest(text_col).alias("sha")
    ))


def decide(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, counters: int = COUNTERS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = slim_rows(docs, id_col, text_col)
    winners = F.broadcast(heavy_winners(slim, share, counters))
    hot = slim.join(winners, "sha")
    cold = slim.join(winners, "sha", "left_anti")
    # summed where the rows lie and joined back, so a digest just below the share is split like any skewed join key
    rest = cold.join(cold.groupBy("sha").agg(_best().alias("best"), F.count(F.lit(1)).alias("group_size")), "sha")
    columns = ["sha", "doc_id", "n", "best", "group_size"]
    keep_id = F.col("best.id.doc_id")
    return hot.select(*columns).unionByName(rest.select(*columns)).select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("n") == -F.col("best.less"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, counters: int = COUNTERS
) -> DataFrame:
    """The documents that stay, with all their columns, one row per distinct text.

    Hot copies are dropped where they are read; what is left is shuffled by digest once.
    """
    slim = slim_rows(docs, id_col, text_col)
    winners = heavy_winners(slim, share, counters)
    hot = winners.select(F.col("sha").alias("_hot"), F.col("best").alias("_best"))
    text = f"_row.`{text_col}`"
    own = boxed(docs).select("_row", F.col(f"_row.`{id_col}`").alias("_id"), digest(text).alias("_sha"), F.char_length(whole_text(text)).alias("_n"))
    first = F.col("_id").eqNullSafe(F.col("_best.id.doc_id")) & (F.col("_n") == -F.col("_best.less"))
    unsettled = (
        own.join(F.broadcast(hot), F.col("_sha") == F.col("_hot"), "left")
        .where(F.col("_hot").isNull() | first)
        .drop("_hot", "_best")
    )
    rank = Window.partitionBy("_sha").orderBy(F.desc("_n"), F.col("_id").asc_nulls_last())
    return unboxed(unsettled.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1"))
