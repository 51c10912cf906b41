"""Keyword reduction: from raw traffic to the keywords worth labelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.text import STOP_PHRASES
from shelfline.operators.filters import above_group_statistic, in_list, without_stop_phrases
from shelfline.operators.windows import top_distinct_per_group
from shelfline.plans.ordered import settled


def reduce_keywords(
    df: DataFrame,
    keyword: str = "keywords",
    category: str = "product_type",
    value: str = "impressions",
    allowed: Sequence[str] | None = None,
    statistic: str = "p75",
    phrases: Sequence[str] = STOP_PHRASES,
    literal: bool = False,
    k: int = 120,
    per_file: str | None = None,
) -> DataFrame:
    """Allowed categories, values at or above a statistic of their category, distinct rows, no
    commercial phrases, the k largest per category.

    `per_file` names a file column (see `read_folder`): statistic and cut are then
    taken per file, so a category keeps up to k rows of every file. The allow-list
    comes first; the statistics are per category, so the result is the same.
    """
    keys = [category, per_file] if per_file else [category]
    kept = settled(in_list(df, category, allowed) if allowed else df)
    high = above_group_statistic(kept, keys, value, statistic)
    clean = without_stop_phrases(high, keyword, phrases, literal)
    others = [c for c in df.columns if c not in {*keys, value, keyword}]
    order = [F.col(keyword).asc(), *[F.col(c).asc() for c in others]]
    return top_distinct_per_group(clean, keys, value, order, k, spread=kept).drop("rank")
