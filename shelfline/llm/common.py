"""What the operators share: reading tables, words, row keys, bounded samples.

Conventions of every operator in this package
* `doc_id` names a document. Rows that repeat both id and text are one document and get the
  same answer; rows that repeat the id with another text are told apart by a hash of the text.
* A null id is an id like any other; it sorts after all others. A null text is an empty text.
* Only the columns an operator names are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.plans.ordered import cut_lineage

# White space and words, as byte ranges every engine reads alike.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once per row, as no optimizer rule writes a lambda's argument out.

    A column used in the lambdas of another is computed anew per element once projections are merged,
    for example when a filter is pushed through them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def id_order(column: str = "doc_id") -> Column:
    """Smallest id first, null last, as one comparable value."""
    return F.struct(F.col(column).isNull(), F.col(column))


def boxed(docs: DataFrame) -> DataFrame:
    """The documents as one struct column `_row`, so columns an operator adds meet no column of theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def unboxed(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About `rows` rows (all, where there are no more), the same in every run: those with a small key hash.

    Each task picks its own, so nothing is gathered to choose them.
    """
    buckets = 1 << 40
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(buckets)) < F.lit(buckets * rows // total))


__all__ = ["WHITE", "WORD", "bound", "bounded_sample", "boxed", "cut_lineage", "id_order", "table", "unboxed", "whole_text", "words"]
