"""Encodings, scaling, the classifier and its evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators import boosting
from shelfline.operators.aggregates import with_group_total
from shelfline.operators.boosting import BoostedTrees
from shelfline.plans.ordered import cut_lineage


def fit_target_encoding(
    train: DataFrame, category: str, target: str, min_rows: float = 20.0, smoothing: float = 10.0
) -> DataFrame:
    """Category → smoothed target mean; the row with a null category holds the prior.

    The category mean is blended with the overall mean by
    1 / (1 + exp(−(n − min_rows) / smoothing)). The train rows are summed once
    per category and that table is written down; the prior comes from it too.
    """
    sums = cut_lineage(
        train.groupBy(category).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n")).where(F.col("_n") > 0)
    )
    prior = sums.agg(F.sum("_sum") / F.sum("_n")).scalar()
    trust = 1 / (1 + F.exp(-(F.col("_n") - min_rows) / smoothing))
    known = sums.where(F.col(category).isNotNull()).withColumn("_prior", prior)
    encoded = known.select(
        category, (F.col("_prior") * (1 - trust) + F.col("_sum") / F.col("_n") * trust).alias("encoded")
    )
    unknown = sums.agg((F.sum("_sum") / F.sum("_n")).alias("encoded"))
    return encoded.unionByName(unknown.withColumn(category, F.lit(None).cast(train.schema[category].dataType)))


def target_encode(train: DataFrame, test: DataFrame, category: str, target: str, **fit) -> DataFrame:
    """Encode the test rows with what was learnt on the train rows; unseen → prior."""
    learnt = cut_lineage(fit_target_encoding(train, category, target, **fit))
    prior = learnt.where(F.col(category).isNull()).agg(F.max("encoded")).scalar()
    joined = test.join(learnt, category, "left").withColumn("_prior", prior)
    return joined.withColumn("encoded", F.coalesce("encoded", "_prior")).drop("_prior")


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per given value: the values become the schema. A null or other value has 0 in all.

    `indicator_rows` gives the same facts in long form, for any number of values.
    """
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values}
    return df.withColumns(flags)


def indicator_rows(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, feature, 1.0) per row with a value: the sparse form of the one-hot table."""
    feature = F.concat(F.lit(f"{column}_"), F.col(column).cast("string"))
    return df.where(F.col(column).isNotNull()).select(*keys, feature.alias("feature"), F.lit(1.0).alias("value"))


def min_max_scale(df: DataFrame, column: str, keys: Sequence[str] = (), out: str = "scaled") -> DataFrame:
    """(x − min) / (max − min) over the table or per group; 0 where all values are equal."""
    if keys:
        ranged = with_group_total(df, keys, _lo=F.min(column), _hi=F.max(column))
    else:
        ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
        ranged = df.withColumn("_ends", ends).withColumns({"_lo": F.col("_ends.lo"), "_hi": F.col("_ends.hi")}).drop("_ends")
    width = F.col("_hi") - F.col("_lo")
    return ranged.withColumn(
        out, F.when(width == 0, F.lit(0.0)).otherwise((F.col(column) - F.col("_lo")) / width)
    ).drop("_lo", "_hi")


def train_classifier(train: DataFrame, features: Sequence[str], label: str, seed: int = 1729, rounds: int = 50, **options) -> BoostedTrees:
    """Boosted trees for a binary label: depth 5, step 0.2, 50 rounds, 70 % subsample, a child weight
    (sum of hessians) of 6 or more, and a loss reduction of 4 or more per split. See `operators.boosting`.
    """
    return boosting.train(train, features, label, seed, rounds, **options)


def score(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Every row with its probability `p`; missing features go the way they went in training."""
    return boosting.score(model, df)


def tree_nodes(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """One row per node of the model's trees."""
    return boosting.nodes(model, df.sparkSession)


def feature_importance(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Importance of each feature: its share of the loss saved by all splits."""
    return df.sparkSession.createDataFrame(boosting.importance(model), "feature string, importance double")


def predicted_class(p: Column) -> Column:
    """Rounded probability; one half rounds to the even 0."""
    return F.bround(p, 0).cast("int")


def classification_report(df: DataFrame, observed: str, p: str) -> DataFrame:
    """Confusion counts, overall rate, rates per predicted class (column) and per observed
    class (row), in one pass."""
    guess = predicted_class(F.col(p))
    seen = F.col(observed)
    cells = df.agg(
        F.count_if((seen == 0) & (guess == 0)).alias("tn"),
        F.count_if((seen == 0) & (guess == 1)).alias("fp"),
        F.count_if((seen == 1) & (guess == 0)).alias("fn"),
        F.count_if((seen == 1) & (guess == 1)).alias("tp"),
    )

    def rate(a: str, b: str) -> Column:
        return F.try_divide(F.col(a) * 100.0, F.col(a) + F.col(b))

    return cells.select(
        "tn", "fp", "fn", "tp",
        F.try_divide((F.col("tp") + F.col("tn")) * 100.0, F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("overall"),
        rate("tn", "fn").alias("column_0_right"), rate("tp", "fp").alias("column_1_right"),
        rate("tn", "fp").alias("row_0_right"), rate("tp", "fn").alias("row_1_right"),
    )
