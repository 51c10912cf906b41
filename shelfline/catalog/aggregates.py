"""Aggregations."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.operators import aggregates as A
from shelfline.operators.windows import pareto_head
from shelfline.plans.ordered import cut_lineage, running_sum
from shelfline.views import (
    ATTR, DOCS_LEFT, KW, SCORED, documents_with_labels, keyword_traffic,
    labelled_keywords, scored_labels,
)


def _rounded(df, names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query(
    "agg_count_by_two",
    """SELECT p_name AS keywords, p_type AS product_type, count(l_orderkey) AS item_count
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def _(t):
    # counted per part first: only one row per part meets the part table
    hits = t.lineitem.groupBy("l_partkey").agg(F.count("l_orderkey").alias("_n"))
    named = hits.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return (
        named.groupBy(F.col("p_name").alias("keywords"), F.col("p_type").alias("product_type"))
        .agg(F.sum("_n").alias("item_count"))
        .orderBy(F.desc("item_count"), "keywords", "product_type")
    )


@query("agg_mean", f"WITH {KW} SELECT product_type, round(avg(impressions), 6) AS mean_impressions FROM kw GROUP BY 1")
def _(t):
    return keyword_traffic(t).groupBy("product_type").agg(F.round(F.avg("impressions"), 6).alias("mean_impressions"))


DESCRIBE_SQL = """count(impressions) AS n, round(avg(impressions), 6) AS mean,
    round(coalesce(stddev_samp(impressions), min(impressions)), 6) AS std, min(impressions) AS min,
    round(quantile_cont(impressions, 0.25), 6) AS p25, round(quantile_cont(impressions, 0.5), 6) AS p50,
    round(quantile_cont(impressions, 0.75), 6) AS p75, max(impressions) AS max"""


@query("agg_describe", f"WITH {KW} SELECT product_type, {DESCRIBE_SQL} FROM kw GROUP BY 1")
def _(t):
    stats = A.describe(cut_lineage(keyword_traffic(t)), ["product_type"], "impressions")
    return _rounded(stats, ["mean", "std", "p25", "p50", "p75"]).orderBy(F.desc("n"), "product_type")


@query(
    "agg_describe_rows",
    """SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 3) AS mean,
              min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
              round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
              round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, max(l_extendedprice) AS max
       FROM lineitem GROUP BY 1""",
)
def _(t):
    cols = ["n", "mean", "min", "p25", "p50", "p75", "max"]
    stats = A.describe(t.lineitem, ["l_returnflag"], "l_extendedprice", cols)
    return _rounded(_rounded(stats, ["mean"], 3), ["p25", "p50", "p75"], 4)


@query("agg_describe_global", f"WITH {KW} SELECT {DESCRIBE_SQL} FROM kw WHERE product_type = 'PROMO'")
def _(t):
    kept = keyword_traffic(t).where("product_type = 'PROMO'")
    return _rounded(A.describe(cut_lineage(kept), [], "impressions"), ["mean", "std", "p25", "p50", "p75"])


@query(
    "agg_distinct_count",
    f"""WITH {ATTR} SELECT product_type, stream, attributes, count(DISTINCT keywords) AS key_count
        FROM attr GROUP BY 1, 2, 3""",
)
def _(t):
    return labelled_keywords(t).groupBy("product_type", "stream", "attributes").agg(
        F.countDistinct("keywords").alias("key_count")
    )


@query(
    "agg_max",
    f"""WITH {KW}, r AS (SELECT product_type, stream, sum(impressions) OVER (PARTITION BY product_type, stream
          ORDER BY impressions DESC, keywords ROWS UNBOUNDED PRECEDING) AS cum_impr FROM kw)
        SELECT product_type, stream, max(cum_impr) AS max_impr FROM r GROUP BY 1, 2""",
)
def _(t):
    order = [F.desc("impressions"), F.asc("keywords")]
    running = running_sum(keyword_traffic(t), ["product_type", "stream"], order, "impressions", "cum_impr")
    return running.groupBy("product_type", "stream").agg(F.max("cum_impr").alias("max_impr"))


@query(
    "agg_multi_list_max",
    f"""WITH {ATTR}, s AS (SELECT product_type, attributes, stream, max(impressions) AS best FROM attr GROUP BY 1, 2, 3)
        SELECT product_type, attributes, string_agg(stream, ', ' ORDER BY stream) AS streams, max(best) AS best
        FROM s GROUP BY 1, 2""",
)
def _(t):
    per_stream = labelled_keywords(t).groupBy("product_type", "attributes", "stream").agg(
        F.max("impressions").alias("best")
    )
    return per_stream.groupBy("product_type", "attributes").agg(
        F.array_join(F.array_sort(F.collect_set("stream")), ", ").alias("streams"), F.max("best").alias("best")
    )


@query("agg_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return A.value_counts(t.events, "event_type").orderBy(F.desc("n"), "event_type")


@query("agg_having", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 30")
def _(t):
    return A.value_counts(t.lineitem, "l_partkey").where("n > 30")


@query(
    "agg_string_join",
    """SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS texts FROM
       (SELECT DISTINCT r_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey) GROUP BY 1""",
)
def _(t):
    served = t.customer.select("c_nationkey").distinct().join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    named = served.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return A.join_texts(named, ["r_name"], "n_name")


@query(
    "agg_crosstab",
    f"""WITH {SCORED} SELECT observed, count(*) FILTER (WHERE p < 0.5) AS predicted_0,
        count(*) FILTER (WHERE p >= 0.5) AS predicted_1 FROM scored GROUP BY 1""",
)
def _(t):
    predicted = scored_labels(t).withColumn("predicted", (F.col("p") >= 0.5).cast("int"))
    table = predicted.groupBy("observed").pivot("predicted", [0, 1]).count().na.fill(0)
    return table.select("observed", F.col("0").alias("predicted_0"), F.col("1").alias("predicted_1"))


@query("agg_distinct_rows", "SELECT DISTINCT p_name, p_type, p_brand FROM part")
def _(t):
    return t.part.select("p_name", "p_type", "p_brand").dropDuplicates()


@query("agg_distinct_column", "SELECT DISTINCT p_type FROM part")
def _(t):
    return t.part.select("p_type").distinct()


@query(
    "agg_unique_over_columns",
    f"""WITH {DOCS_LEFT} SELECT DISTINCT value FROM (
          SELECT lang AS value FROM docs_left UNION ALL SELECT source FROM docs_left
          UNION ALL SELECT CAST(quality AS VARCHAR) FROM docs_left) WHERE value IS NOT NULL""",
)
def _(t):
    texts = documents_with_labels(t).select("lang", "source", F.col("quality").cast("string").alias("quality"))
    return A.distinct_over_columns(texts, ["lang", "source", "quality"])


@query(
    "agg_nonnull_per_row",
    f"""WITH {DOCS_LEFT}, n AS (SELECT lang, CAST(source IS NOT NULL AS INTEGER) + CAST(quality IS NOT NULL AS INTEGER)
                 + CAST(toxic IS NOT NULL AS INTEGER) AS filled FROM docs_left)
        SELECT lang, max(filled) AS most_filled, min(filled) AS least_filled, CAST(sum(filled) AS BIGINT) AS cells
        FROM n GROUP BY 1""",
)
def _(t):
    filled = documents_with_labels(t).select("lang", A.nonnull_in_row(["source", "quality", "toxic"]).alias("filled"))
    return filled.groupBy("lang").agg(
        F.max("filled").alias("most_filled"), F.min("filled").alias("least_filled"), F.sum("filled").alias("cells")
    )


@query(
    "agg_by_strategy",
    """WITH c AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY 1, 2),
            m AS (SELECT event_type, min(value) AS mode FROM c
                  WHERE n = (SELECT max(n) FROM c AS d WHERE d.event_type = c.event_type) GROUP BY 1)
       SELECT event_type, round(avg(value), 6) AS average, min(value) AS min, max(value) AS max,
              round(sum(value), 2) AS sum, arg_min(value, ts) AS first,
              round(quantile_cont(value, 0.5), 6) AS median, any_value(mode) AS mode
       FROM events JOIN m USING (event_type) GROUP BY 1""",
)
def _(t):
    out = A.by_strategies(t.events, ["event_type"], "value", "ts")
    return _rounded(_rounded(out, ["average", "median"]), ["sum"], 2)


@query(
    "agg_single_value_check",
    """SELECT p_name, CASE WHEN count(DISTINCT p_brand) = 1 THEN min(p_brand) END AS p_brand,
              count(DISTINCT p_brand) = 1 AS is_single FROM part GROUP BY 1
       UNION ALL
       SELECT CAST(n_nationkey AS VARCHAR), CASE WHEN count(DISTINCT n_name) = 1 THEN min(n_name) END,
              count(DISTINCT n_name) = 1 FROM nation GROUP BY n_nationkey""",
)
def _(t):
    brands = A.single_value(t.part, ["p_name"], "p_brand")
    names = A.single_value(t.nation, ["n_nationkey"], "n_name")
    return brands.union(names.select(F.col("n_nationkey").cast("string"), "n_name", "is_single"))


@query(
    "agg_rank_bucket_share",
    f"""WITH {KW}, r AS (
          SELECT *, sum(impressions) OVER (PARTITION BY product_type, stream ORDER BY impressions DESC, keywords
                    ROWS UNBOUNDED PRECEDING) AS cum,
                 sum(impressions) OVER (PARTITION BY product_type, stream) AS total FROM kw)
        SELECT product_type, stream, count(*) AS kept_rows, round(sum(impressions) / any_value(total), 6) AS kept_share
        FROM r WHERE cum / total <= 0.4 GROUP BY 1, 2""",
)
def _(t):
    head = pareto_head(keyword_traffic(t), ["product_type", "stream"], "impressions", ["keywords"])
    return head.groupBy("product_type", "stream").agg(
        F.count(F.lit(1)).alias("kept_rows"),
        F.round(F.sum("impressions") / F.max("total_value"), 6).alias("kept_share"),
    )
