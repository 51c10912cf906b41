"""The first distinct rows of a group, against a plain count of all of them."""

import random

from pyspark.sql import functions as F

from shelfline.operators import windows
from shelfline.operators.keywords import reduce_keywords

KW = "keywords string, product_type string, stream string, impressions double"


def by_hand(data, k):
    groups = {}
    for w, g, s, v in set(data):
        if g is not None:
            groups.setdefault(g, []).append((v is None, -(v or 0), w, s))
    return sorted(((w, g, i + 1) for g, found in groups.items() for i, (*_, w, _) in enumerate(sorted(found)[:k])), key=repr)


def test_only_the_head_is_made_distinct_and_the_result_is_the_same(spark, rows, monkeypatch):
    rng = random.Random(4)
    word = lambda: f"k{rng.randint(0, 30)}"
    data = [(word(), "wide", "s", float(rng.randint(0, 10**6))) for _ in range(20_000)]
    data += [(word(), "repeats", rng.choice("ab"), float(min(rng.randint(0, 5000), 4900))) for _ in range(3000)]
    data += [("same", "one", "s", 7.0)] * 2000 + [(word(), "small", "s", float(i % 7)) for i in range(60)]
    data += [("x", None, "s", 1.0)] * 3 + [("n", "small", "s", None), ("m", "empty", "s", None), ("m", "empty", "s", None)]
    written, real = [], windows.cut_lineage

    def counting(df):
        out = real(df)
        written.append((out.columns, out.where("product_type = 'wide'").count()))
        return out

    monkeypatch.setattr(windows, "cut_lineage", counting)
    df = spark.createDataFrame(data, KW).repartition(5)
    out = windows.top_distinct_per_group(df, ["product_type"], "impressions", [F.asc("keywords"), F.asc("stream")], 40)
    assert rows(out, "keywords", "product_type", "rank") == by_hand(data, 40)
    assert set(written[1][0]) == set(df.columns) and 40 <= written[1][1] < 600 and written[2][1] == 1


def test_reduction_makes_no_distinct_table_of_a_long_category(spark, monkeypatch):
    """Of 40,000 different rows above the statistic, few meet to be made distinct."""
    written, real = [], windows.cut_lineage

    def counting(df):
        out = real(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(windows, "cut_lineage", counting)
    df = spark.range(160_000).select(
        F.concat(F.lit("w"), "id").alias("keywords"), F.lit("X").alias("product_type"), F.lit("s").alias("stream"), F.col("id").cast("double").alias("impressions"))
    out = reduce_keywords(df, phrases=["sale"], k=50)
    assert sorted(r.keywords for r in out.collect()) == sorted(f"w{i}" for i in range(160_000 - 50, 160_000))
    assert written[0] == written[2] == 1 and written[1] < 3200
