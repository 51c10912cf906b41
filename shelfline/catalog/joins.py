"""Joins."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.functions.text import first_answer
from shelfline.operators import joins as J
from shelfline.operators.aggregates import with_group_total
from shelfline.operators.timeseries import shift_season
from shelfline.plans.ordered import cut_lineage, running_sum
from shelfline.views import (
    ATTR, KW, LLM_OUT, SERIES, TAXO, WEIGHTS, attribute_weights, keyword_traffic, label_words, labelled_keywords,
    model_replies, taxonomy, weekly_series,
)


@query(
    "join_group_stat_back",
    f"""WITH {KW}, s AS (SELECT product_type, min(impressions) AS min_impr, max(impressions) AS max_impr FROM kw GROUP BY 1)
        SELECT kw.*, min_impr, max_impr FROM kw LEFT JOIN s USING (product_type)""",
)
def _(t):
    return with_group_total(
        keyword_traffic(t), ["product_type"], min_impr=F.min("impressions"), max_impr=F.max("impressions")
    )


@query(
    "join_group_total_back",
    f"""WITH {KW}, s AS (SELECT product_type, stream, sum(impressions) AS total_impr FROM kw GROUP BY 1, 2)
        SELECT kw.*, total_impr FROM kw LEFT JOIN s USING (product_type, stream)""",
)
def _(t):
    return with_group_total(keyword_traffic(t), ["product_type", "stream"], total_impr=F.sum("impressions"))


@query(
    "join_three_keys_left",
    f"""WITH {ATTR}, c AS (SELECT keywords, product_type, stream, sum(impressions) OVER (PARTITION BY product_type, stream
            ORDER BY impressions DESC, keywords ROWS UNBOUNDED PRECEDING) AS cum_impr FROM kw)
        SELECT a.keywords, a.product_type, a.stream, a.attributes, a.impressions, cum_impr FROM attr a
        LEFT JOIN c ON a.keywords = c.keywords AND a.product_type = c.product_type AND a.stream = c.stream""",
)
def _(t):
    keys = ["keywords", "product_type", "stream"]
    order = [F.desc("impressions"), F.asc("keywords")]
    traffic = cut_lineage(keyword_traffic(t))
    running = running_sum(traffic, ["product_type", "stream"], order, "impressions", "cum_impr")
    return J.join_null_safe(label_words(traffic), running.select(*keys, "cum_impr"), keys)


@query(
    "join_different_key_names",
    f"""WITH {ATTR}, {WEIGHTS} SELECT a.keywords, a.product_type, a.stream, a.impressions, a.attributes, completeness_weight
        FROM attr a LEFT JOIN weights w ON a.product_type = w.product_type AND a.attributes = w.sa_name""",
)
def _(t):
    on = {"product_type": "product_type", "attributes": "sa_name"}
    return J.join_renamed(labelled_keywords(t), attribute_weights(t), on)


@query(
    "join_lookup_with_default",
    f"""WITH {ATTR}, {WEIGHTS}, look AS (SELECT product_type, sa_name AS attributes,
              coalesce(CASE WHEN completeness_weight > 0.5 THEN 'complete' END, 'other') AS grade FROM weights)
        SELECT DISTINCT a.product_type, a.attributes, grade FROM attr a
        LEFT JOIN look l ON a.product_type = l.product_type AND a.attributes = l.attributes""",
)
def _(t):
    grade = F.when(F.col("completeness_weight") > 0.5, "complete")
    lookup = attribute_weights(t).select("product_type", F.col("sa_name").alias("attributes"), grade.alias("grade"))
    pairs = labelled_keywords(t).select("product_type", "attributes").distinct()
    return J.lookup_with_default(pairs, lookup, ["product_type", "attributes"], "other")


@query(
    "join_inner_two_keys",
    f"""WITH {KW}, r AS (SELECT p_name AS keywords, p_type AS product_type, count(*) AS parts FROM part GROUP BY 1, 2)
        SELECT kw.*, parts FROM kw JOIN r USING (keywords, product_type)""",
)
def _(t):
    parts = t.part.groupBy(F.col("p_name").alias("keywords"), F.col("p_type").alias("product_type")).agg(
        F.count(F.lit(1)).alias("parts"))
    return keyword_traffic(t).join(parts, ["keywords", "product_type"])


@query(
    "semi_join",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return J.in_other(rows, t.customer.where("c_mktsegment = 'BUILDING'"), "o_custkey", "c_custkey")


@query(
    "semi_join_frequent",
    """SELECT p_partkey, p_name FROM part
       WHERE p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 30)""",
)
def _(t):
    return J.in_frequent(t.part.select("p_partkey", "p_name"), t.lineitem, "p_partkey", "l_partkey", 30)


@query(
    "join_prefix_theta",
    f"""WITH {TAXO}, p AS (SELECT replace(replace(path, '[World, ', ''), ']', '') AS path, node_key, is_leaf FROM taxo),
             roots AS (SELECT DISTINCT unnest([path, substr(path, 1, 2), substr(path, 1, length(path) - 3)]) AS root FROM p WHERE NOT is_leaf)
        SELECT root, path, node_key FROM roots JOIN p ON starts_with(path, root) WHERE is_leaf""",
)
def _(t):
    nodes = taxonomy(t).withColumn("path", F.regexp_replace("path", r"\[World, |\]", ""))
    # whole inner paths, and roots that end inside an element
    heads = F.array("path", F.left("path", F.lit(2)), F.left("path", F.char_length("path") - 3))
    roots = nodes.where(~F.col("is_leaf")).select(F.explode(heads).alias("root")).distinct()
    return J.leaves_under(roots, nodes.where("is_leaf").select("path", "node_key"), "root", "path")


@query(
    "join_prediction_to_key",
    f"""WITH {LLM_OUT}, cat AS (SELECT id, CASE WHEN contains(output, '<category>')
               THEN regexp_extract(output, '<category><item>([a-z0-9]+)', 1) END AS category FROM llm_out),
             nodes AS (SELECT DISTINCT source AS path, upper(md5(source)) AS node_key FROM documents)
        SELECT id, category, node_key FROM cat LEFT JOIN nodes ON category = path""",
)
def _(t):
    # a reply with two tags names the category in the first of them that holds an answer; one without an answer finds no node
    predicted = model_replies(t).select("id", first_answer(F.col("output"), "category").alias("category"))
    nodes = t.documents.select(F.col("source").alias("path")).distinct()
    return J.join_renamed(predicted, nodes.withColumn("node_key", F.upper(F.md5("path"))), {"category": "path"})


@query(
    "join_forecast_to_actuals",
    f"""WITH {SERIES}, f AS (SELECT item, CAST(week + INTERVAL 364 DAY AS DATE) AS week, y AS yhat FROM series)
        SELECT item, strftime(f.week, '%Y-%m-%d') AS week, yhat, y FROM f LEFT JOIN series s USING (item, week)""",
)
def _(t):
    series = weekly_series(t)
    joined = shift_season(series, "item", "week", "y").join(series, ["item", "week"], "left")
    return joined.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@query(
    "join_per_group_option_list",
    """WITH o AS (SELECT p_type, string_agg(p_brand, chr(10) ORDER BY p_brand) AS options
                  FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY 1)
       SELECT p_partkey, p_type, options FROM part LEFT JOIN o USING (p_type)""",
)
def _(t):
    rows = t.part.select("p_partkey", "p_type")
    return J.with_group_options(rows, t.part, ["p_type"], "p_brand")


@query(
    "join_normalised_key",
    """WITH l AS (SELECT doc_id, CASE lang WHEN 'en' THEN upper(source) WHEN 'de' THEN replace(source, 'src', 'SRC-')
                        WHEN 'fr' THEN replace(source, 'src', 'src ') ELSE replace(source, 'src', 's_r_c') END AS label
                  FROM documents),
            r AS (SELECT min(source) AS source, replace(source, '_', '') AS k FROM documents GROUP BY k)
       SELECT doc_id, label, source FROM l LEFT JOIN r
       ON regexp_replace(lower(label), '[ _-]', '', 'g') = k""",
)
def _(t):
    label = (
        F.when(F.col("lang") == "en", F.upper("source"))
        .when(F.col("lang") == "de", F.replace("source", F.lit("src"), F.lit("SRC-")))
        .when(F.col("lang") == "fr", F.replace("source", F.lit("src"), F.lit("src ")))
        .otherwise(F.replace("source", F.lit("src"), F.lit("s_r_c")))
    )
    noisy = t.documents.select("doc_id", label.alias("label"))
    return J.join_normalised(noisy, t.documents.select("source"), "label", "source")


@query(
    "cross_sample",
    """WITH l AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS l FROM customer),
            r AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS r FROM supplier),
            n AS (SELECT (SELECT count(*) FROM customer) AS nl, (SELECT count(*) FROM supplier) AS nr),
            d AS (SELECT CAST('0x' || substr(sha256(CAST(i AS VARCHAR) || '#11'), 1, 15) AS BIGINT) % (nl * nr) AS pick, i, nr
                  FROM n, (SELECT unnest(range(664)) AS i)),
            f AS (SELECT pick, nr FROM (SELECT pick, nr, min(i) AS i FROM d GROUP BY 1, 2) ORDER BY i LIMIT 300)
       SELECT c_custkey, s_suppkey FROM f JOIN l ON l.l = pick // nr JOIN r ON r.r = pick % nr""",
)
def _(t):
    sides = [(t.customer.select("c_custkey"), [F.asc("c_custkey")]), (t.supplier.select("s_suppkey"), [F.asc("s_suppkey")])]
    return J.sample_combinations(sides, 300, seed=11)
