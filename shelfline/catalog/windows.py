"""Window queries and the flagship ranking."""

from pyspark.sql import functions as F

from shelfline.catalog.columns import OTHER_WEIGHT, STREAM_WEIGHTS, WEIGHT_SQL
from shelfline.catalog.registry import query
from shelfline.operators import windows as W
from shelfline.operators.aggregates import with_group_total
from shelfline.operators.filters import without_stop_phrases
from shelfline.operators.joins import join_renamed, lookup_with_default
from shelfline.operators.keywords import reduce_keywords
from shelfline.plans.ordered import cut_lineage, running_sum
from shelfline.sources.files import read_folder
from shelfline.views import ATTR, KW, WEIGHTS, attribute_weights, keyword_traffic, labelled_keywords

GROUP = ["product_type", "stream"]
FLAGSHIP_PHRASES = ("new ring", "hot rod", "old")


@query(
    "topn_per_group",
    f"""WITH {KW} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_type
          ORDER BY impressions DESC, keywords, stream) AS rank FROM kw) WHERE rank <= 120""",
)
def _(t):
    order = [F.desc("impressions"), F.asc("keywords"), F.asc("stream")]
    return W.top_per_group(keyword_traffic(t), ["product_type"], order, 120).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@query(
    "topn_per_two_keys",
    f"""WITH {ATTR}, c AS (SELECT product_type, stream, attributes, count(DISTINCT keywords) AS key_count
                           FROM attr GROUP BY 1, 2, 3)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_type, stream
          ORDER BY key_count DESC, attributes) AS rank FROM c) WHERE rank <= 11""",
)
def _(t):
    counts = labelled_keywords(t).groupBy(*GROUP, "attributes").agg(F.countDistinct("keywords").alias("key_count"))
    return W.top_per_group(counts, GROUP, [F.desc("key_count"), F.asc("attributes")], 11).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@query(
    "running_sum",
    f"""WITH {KW} SELECT *, sum(impressions) OVER (PARTITION BY product_type, stream
          ORDER BY impressions DESC, keywords ROWS UNBOUNDED PRECEDING) AS cum_impr FROM kw""",
)
def _(t):
    order = [F.desc("impressions"), F.asc("keywords")]
    return running_sum(keyword_traffic(t), GROUP, order, "impressions", "cum_impr")


@query(
    "running_weight",
    f"""WITH {ATTR}, s AS (SELECT DISTINCT product_type, attributes, stream FROM attr),
             w AS (SELECT *, {WEIGHT_SQL} AS weight FROM s)
        SELECT product_type, attributes, stream, weight, round(sum(weight) OVER (PARTITION BY product_type, attributes
          ORDER BY stream ROWS UNBOUNDED PRECEDING), 6) AS cum_weight FROM w""",
)
def _(t):
    rows = labelled_keywords(t).select("product_type", "attributes", "stream").distinct()
    out = W.running_weight(rows, ["product_type", "attributes"], "stream", STREAM_WEIGHTS, OTHER_WEIGHT)
    return out.withColumn("cum_weight", F.round("cum_weight", 6))


PARETO_SQL = """r AS (
  SELECT *, sum(impressions) OVER (PARTITION BY product_type, stream ORDER BY impressions DESC, keywords
                                   ROWS UNBOUNDED PRECEDING) AS running_value,
         sum(impressions) OVER (PARTITION BY product_type, stream) AS total_value FROM {kw}),
head AS (SELECT * FROM r WHERE running_value / total_value <= 0.4)"""


@query("pareto_head", f"WITH {KW}, {PARETO_SQL.format(kw='kw')} SELECT * FROM head")
def _(t):
    return W.pareto_head(keyword_traffic(t), GROUP, "impressions", ["keywords"])


@query(
    "group_total_broadcast",
    f"""WITH {KW} SELECT *, round(avg(impressions) OVER (PARTITION BY product_type), 6) AS mean_impr,
               sum(impressions) OVER (PARTITION BY product_type) AS total_impr FROM kw""",
)
def _(t):
    return with_group_total(
        keyword_traffic(t), ["product_type"],
        mean_impr=F.round(F.avg("impressions"), 6), total_impr=F.sum("impressions"),
    )


@query(
    "attribute_ranking",
    rf"""WITH {KW}, clean AS (SELECT * FROM kw
             WHERE NOT regexp_matches(keywords, '(?i)\b(?:new ring|hot rod|old)\b')),
         {PARETO_SQL.format(kw='clean')},
         a AS (SELECT keywords, product_type, stream, unnest(string_split(keywords, ' ')) AS attributes FROM head),
         c AS (SELECT product_type, stream, attributes, count(DISTINCT keywords) AS key_count FROM a GROUP BY 1, 2, 3),
         b AS (SELECT *, row_number() OVER (PARTITION BY product_type, stream ORDER BY key_count DESC, attributes) AS rk
               FROM c)
       SELECT product_type, attributes, string_agg(stream, ', ' ORDER BY stream) AS streams,
              round(sum({WEIGHT_SQL}), 6) AS cum_weight
       FROM b WHERE rk <= 11 GROUP BY 1, 2""",
)
def attribute_ranking(t):
    """Keywords without stop phrases, the 40 % head of each channel, attributes ranked across channels."""
    clean = without_stop_phrases(keyword_traffic(t), "keywords", FLAGSHIP_PHRASES)
    head = W.pareto_head(clean, GROUP, "impressions", ["keywords"])
    labelled = head.withColumn("attributes", F.explode(F.split("keywords", " ")))
    ranked = W.ranked_attributes(
        labelled, "keywords", "product_type", "stream", "attributes", STREAM_WEIGHTS, OTHER_WEIGHT
    )
    return ranked.orderBy(F.desc("cum_weight"), "product_type", "attributes")


@query(
    "keyword_reduction",
    rf"""WITH {KW}, stat AS (SELECT product_type, quantile_cont(impressions, 0.5) AS p50 FROM kw GROUP BY 1),
        high AS (SELECT kw.* FROM kw JOIN stat USING (product_type)
                 WHERE impressions >= p50 AND product_type IN ('ECONOMY', 'PROMO', 'SMALL')
                   AND NOT regexp_matches(keywords, '(?i)\b(?:new ring|hot rod|old)\b'))
        SELECT keywords, product_type, stream, impressions FROM (SELECT *, row_number() OVER (PARTITION BY product_type
          ORDER BY impressions DESC, keywords, stream) AS rk FROM high) WHERE rk <= 40""",
)
def _(t):
    return reduce_keywords(
        cut_lineage(keyword_traffic(t)), allowed=["ECONOMY", "PROMO", "SMALL"], statistic="p50", phrases=FLAGSHIP_PHRASES, k=40
    )


@query(
    "keyword_reduction_per_file",
    """WITH x AS (SELECT o_orderpriority AS keywords, o_orderstatus AS product_type, o_totalprice AS impressions, 'orders.parquet' AS file_name FROM orders
                  UNION ALL SELECT l_linestatus, l_returnflag, l_extendedprice, 'lineitem.parquet' FROM lineitem),
            s AS (SELECT product_type, file_name, quantile_cont(impressions, 0.75) AS p75 FROM x GROUP BY 1, 2),
            h AS (SELECT DISTINCT x.* FROM x JOIN s USING (product_type, file_name) WHERE impressions >= p75)
       SELECT keywords, product_type, impressions, file_name FROM (SELECT *, row_number() OVER (PARTITION BY product_type, file_name
         ORDER BY impressions DESC, keywords) AS rk FROM h) WHERE rk <= 120""",
)
def _(t):
    columns = ("o_orderpriority string, o_orderstatus string, o_totalprice double, "
               "l_linestatus string, l_returnflag string, l_extendedprice double")
    both = read_folder(t.spark, t.folder, "{lineitem,orders}.parquet", schema=columns)
    rows = both.select(
        F.coalesce("o_orderpriority", "l_linestatus").alias("keywords"),
        F.coalesce("o_orderstatus", "l_returnflag").alias("product_type"),
        F.coalesce("o_totalprice", "l_extendedprice").alias("impressions"),
        "file_name",
    )
    return reduce_keywords(rows, phrases=FLAGSHIP_PHRASES, per_file="file_name")


@query(
    "attribute_ranking_enriched",
    f"""WITH {ATTR}, {WEIGHTS}, {PARETO_SQL.format(kw='kw')},
         a AS (SELECT keywords, product_type, stream, unnest(string_split(keywords, ' ')) AS attributes FROM head),
         c AS (SELECT product_type, stream, attributes, count(DISTINCT keywords) AS key_count FROM a GROUP BY 1, 2, 3),
         b AS (SELECT *, row_number() OVER (PARTITION BY product_type, stream ORDER BY key_count DESC, attributes) AS rk FROM c),
         m AS (SELECT product_type, attributes, string_agg(stream, ', ' ORDER BY stream) AS streams,
                      round(sum({WEIGHT_SQL}), 6) AS cum_weight FROM b WHERE rk <= 11 GROUP BY 1, 2),
         look AS (SELECT product_type, sa_name AS attributes,
                         coalesce(CASE WHEN completeness_weight > 0.5 THEN 'complete' END, 'other') AS grade FROM weights)
       SELECT m.*, completeness_weight, grade FROM m
       LEFT JOIN weights w ON m.product_type = w.product_type AND m.attributes = w.sa_name
       LEFT JOIN look l ON m.product_type = l.product_type AND m.attributes = l.attributes""",
)
def _(t):
    head = W.pareto_head(keyword_traffic(t), GROUP, "impressions", ["keywords"])
    labelled = head.withColumn("attributes", F.explode(F.split("keywords", " ")))
    ranked = W.ranked_attributes(
        labelled, "keywords", "product_type", "stream", "attributes", STREAM_WEIGHTS, OTHER_WEIGHT
    )
    weights = attribute_weights(t)
    weighted = join_renamed(ranked, weights, {"product_type": "product_type", "attributes": "sa_name"})
    grade = F.when(F.col("completeness_weight") > 0.5, "complete")
    lookup = weights.select("product_type", F.col("sa_name").alias("attributes"), grade.alias("grade"))
    return lookup_with_default(weighted, lookup, ["product_type", "attributes"], "other")
