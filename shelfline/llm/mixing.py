"""Mixing sources to target weights by entropy balancing.

Of all document rates, those closest to one copy each (least relative entropy) that meet every
source's word target and never exceed the copy limit have the form min(limit, exp(lambda * size)):
the convex dual has one multiplier per source. Newton iterations solve it on a table with one row
per (source, size) and its count, so an iteration is one aggregate over far fewer rows than documents;
a bracket catches steps that leave it. Multipliers stay in a table, one row per source.

Rates become whole copies by carrying the rounding error in words from long documents to short
ones, inside slices of about `SLICE_ROWS` documents of one source dealt by an id hash. A slice ends with
an error of about its shortest document, so a source misses its target by little however large it
is, and no source, hot or not, is ever held in one task.

Sources are taken in code point order, null last, with weights 5, 2, 1 repeating. Their targets share
all words; a target stops at `limit` times its source's words, and the excess goes to the others.

Defined cases: null and empty texts have size 0 and are taken 0 times; a null source is a source; rows
that repeat id, source and size are decided once and all get that many copies; a source without words
has target 0; an empty table gives an empty result; extra columns are kept by `mix`, not read by `decide`.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import WORD, boxed, cut_lineage, unboxed, whole_text

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3
SLICE_ROWS = 2000
# Newton stops when every source is this close to its target; far below one document.
CLOSE = 1e-7
MOST_ROUNDS = 100


def source_key(column: str) -> Column:
    """A text that sorts like the source in code point order with null last."""
    return F.when(F.col(column).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(column)))


def _size_columns(id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [
        F.col(id_col).alias("doc_id"), source_key(source_col).alias("_source"),
        F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("bigint").alias("size"),
    ]


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(*_size_columns(id_col, text_col, source_col))


def targets(per_source: DataFrame, weights: Sequence[float], limit: int) -> DataFrame:
    """Adds `target`. The windows hold one row per source.

    Sources are walked by the level at which they reach their limit; one is full when its share
    of what the fuller ones leave is at least its limit.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("_source")
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    walk = Window.partitionBy(F.lit(0)).orderBy(F.col("_most") / F.col("_weight"), "_source")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    return (
        per_source.withColumn("_weight", weight)
        .withColumn("_most", F.col("source_size").cast("double") * limit)
        .withColumn("_left", F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("_most").over(before), zero))
        .withColumn("_rest", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), zero))
        .withColumn("_full", F.col("_most") * F.col("_rest") <= F.col("_weight") * F.col("_left"))
        # the walk ends at the first source that is not full; what it finds there is everyone's level
        .withColumn("_full", F.min("_full").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_level", F.min(F.when(~F.col("_full"), F.struct(F.col("_most") / F.col("_weight"), F.col("_source"), (F.col("_left") / F.col("_rest")).alias("level")))).over(everything)["level"])
        .withColumn("target", F.when(F.col("_full"), F.col("_most")).otherwise(F.col("_weight") * F.col("_level")))
        .drop("_weight", "_most", "_left", "_rest", "_level")
    )


def rate(limit: int) -> Column:
    return F.when(F.col("_full"), F.lit(float(limit))).otherwise(F.least(F.lit(float(limit)), F.exp(F.col("_lambda") * F.col("size"))))


def solve(counts: DataFrame, sources: DataFrame, limit: int) -> DataFrame:
    """Adds `_lambda` to the sources: Newton on the logarithm of the words taken."""
    ratio = F.log(F.nullif(F.col("target"), F.lit(0.0)) / F.nullif(F.col("source_size"), F.lit(0)))
    state = cut_lineage(
        sources.withColumn("_settled", F.col("_full") | (F.col("source_size") == 0))
        .withColumn("_lambda", F.lit(0.0))
        .withColumn("_lo", F.when(ratio < 0, ratio / F.col("_shortest")).otherwise(F.lit(0.0)))
        .withColumn("_hi", F.when(ratio > 0, F.log(F.lit(float(limit))) / F.col("_shortest")).otherwise(F.lit(0.0)))
    )
    words = F.col("_n") * F.col("size") * rate(limit)
    bends = F.when(rate(limit) < limit, words * F.col("size")).otherwise(F.lit(0.0))
    # summed as decimals, so the result is the same in whatever order the rows come
    exact = lambda terms: F.sum(terms.cast("decimal(38,10)")).cast("double")
    for _ in range(MOST_ROUNDS):
        sums = (
            counts.join(state.where("not _settled").select("_source", "_lambda", "_full"), "_source")
            .groupBy("_source").agg(exact(words).alias("_g"), exact(bends).alias("_h"))
        )
        above = F.col("_g") > F.col("target")
        newton = F.col("_lambda") - F.log(F.col("_g") / F.nullif(F.col("target"), F.lit(0.0))) * F.col("_g") / F.nullif(F.col("_h"), F.lit(0.0))
        inside = F.coalesce((newton > F.col("_lo")) & (newton < F.col("_hi")), F.lit(False))
        moved = F.col("_g").isNotNull() & ~F.col("_close")
        state = cut_lineage(
            state.join(sums, "_source", "left")
            .withColumn("_close", F.coalesce(F.abs(F.col("_g") - F.col("target")) <= F.col("target") * CLOSE, F.lit(False)))
            .withColumn("_hi", F.when(moved & above, F.col("_lambda")).otherwise(F.col("_hi")))
            .withColumn("_lo", F.when(moved & ~above, F.col("_lambda")).otherwise(F.col("_lo")))
            .withColumn("_lambda", F.when(moved, F.when(inside, newton).otherwise((F.col("_lo") + F.col("_hi")) / 2)).otherwise(F.col("_lambda")))
            .withColumn("_settled", F.col("_settled") | F.col("_close"))
            .drop("_g", "_h", "_close")
        )
        if state.where("not _settled").isEmpty():
            break
    return state.drop("_lo", "_hi", "_settled")


def _round_slice(limit: int):
    def rounded(rows: pa.Table) -> pa.Table:
        """Longest first; each rate goes to a whole number beside it, and the error in words is carried on."""
        order = rows.sort_by([("size", "descending"), ("doc_id", "ascending")])
        carry, copies = 0.0, []
        for size, times, wanted in zip(order["size"].to_pylist(), order["_m"].to_pylist(), order["_rate"].to_pylist()):
            words = size * times
            below = min(int(wanted), limit)
            taken = min(limit, below + (wanted > below and wanted - below + carry / words >= 0.5))
            carry += (wanted - taken) * words
            copies.append(taken)
        return order.select(["doc_id", "_source", "size"]).append_column("copies", pa.array(copies, pa.int32()))

    return rounded


def plan(slim: DataFrame, weights: Sequence[float], limit: int) -> tuple[DataFrame, DataFrame]:
    """(sources with target and multiplier; distinct (doc_id, _source, size) with copies)."""
    counts = cut_lineage(slim.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("_n")))
    per_source = counts.groupBy("_source").agg(
        F.sum(F.col("size") * F.col("_n")).alias("source_size"), F.sum("_n").alias("_rows"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("_shortest"),
    )
    sources = solve(counts.where("size > 0"), targets(per_source, weights, limit), limit)
    dealt = (
        slim.where("size > 0").join(sources.select("_source", "_lambda", "_full", "_rows"), "_source")
        .withColumn("_slice", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.ceil(F.col("_rows") / SLICE_ROWS)))
        .groupBy("_source", "_slice", "doc_id", "size", rate(limit).alias("_rate")).agg(F.count(F.lit(1)).alias("_m"))
    )
    kind = dict(slim.dtypes)["doc_id"]
    copies = dealt.groupBy("_source", "_slice").applyInArrow(
        _round_slice(limit), f"doc_id {kind}, _source string, size bigint, copies int")
    return sources, cut_lineage(copies)


def _with_copies(rows: DataFrame, copies: DataFrame, how: str) -> DataFrame:
    """rows(doc_id, _source, size, ...) with their copies; the ids meet null-safe."""
    own = copies.withColumnsRenamed({"doc_id": "_c_id", "_source": "_c_source", "size": "_c_size"})
    same = rows["doc_id"].eqNullSafe(own["_c_id"]) & (rows["_source"] == own["_c_source"]) & (rows["size"] == own["_c_size"])
    return rows.join(own, same, how).drop("_c_id", "_c_source", "_c_size").fillna(0, ["copies"])


def decide(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, copies, rate."""
    slim = cut_lineage(sizes(docs, id_col, text_col, source_col))
    sources, copies = plan(slim, weights, limit)
    rows = _with_copies(slim, copies, "left")
    return rows.join(sources.select("_source", "source_size", "target", "_lambda", "_full"), "_source").select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "copies",
        F.when(F.col("size") > 0, rate(limit)).otherwise(F.lit(0.0)).alias("rate"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, limit: int = LIMIT,
) -> DataFrame:
    """The documents of the mix, each repeated as often as it is taken, with all their columns."""
    slim = cut_lineage(sizes(docs, id_col, text_col, source_col))
    _, copies = plan(slim, weights, limit)
    row = lambda column: f"_row.`{column}`"
    rows = boxed(docs).select("_row", *_size_columns(row(id_col), row(text_col), row(source_col)))
    taken = _with_copies(rows, copies.where("copies > 0"), "inner")
    return unboxed(taken.select("_row", F.explode(F.sequence(F.lit(1), "copies"))))
