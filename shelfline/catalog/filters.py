"""Filters and predicates."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.operators import filters as K
from shelfline.plans.ordered import cut_lineage
from shelfline.views import (
    DOCS_LEFT, ITEMS, KW, TAXO, documents_with_labels, items_to_classify, keyword_traffic,
    taxonomy,
)

PHRASES = ("new ring", "hot", "red rod", "Plate")
CATEGORIES = ("ECONOMY", "PROMO", "STANDARD")


@query("filter_allowlist", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'STANDARD')")
def _(t):
    return K.in_list(t.part.select("p_partkey", "p_name", "p_type"), "p_type", CATEGORIES)


@query(
    "filter_threshold",
    f"""WITH {KW}, stat AS (SELECT product_type, quantile_cont(impressions, 0.75) AS p75 FROM kw GROUP BY 1)
        SELECT kw.* FROM kw JOIN stat USING (product_type) WHERE impressions >= p75""",
)
def _(t):
    return K.above_group_statistic(cut_lineage(keyword_traffic(t)), ["product_type"], "impressions", "p75")


@query(
    "filter_stop_phrases",
    r"""SELECT p_partkey, p_name FROM part
        WHERE NOT regexp_matches(coalesce(p_name, ''), '(?i)\b(?:new ring|hot|red rod|Plate)\b')""",
)
def _(t):
    return K.without_stop_phrases(t.part.select("p_partkey", "p_name"), "p_name", PHRASES)


@query(
    "filter_stop_phrases_literal",
    r"""SELECT doc_id FROM documents
        WHERE NOT regexp_matches(coalesce(text, ''), ' (?:the|des|que|und) ')""",
)
def _(t):
    docs = t.documents.select("doc_id", "text")
    return K.without_stop_phrases(docs, "text", ("the", "des", "que", "und"), literal=True).select("doc_id")


@query(
    "filter_sentinels",
    """WITH s AS (SELECT doc_id, unnest(string_split(CASE WHEN lang = 'en' THEN source || ', NA' ELSE 'NA,[],' || lang END, ','))
                         AS attributes FROM documents)
       SELECT doc_id, trim(attributes) AS attributes FROM s
       WHERE trim(attributes) NOT IN ('NA', '[]', 'NONE OF THE ABOVE')""",
)
def _(t):
    reply = F.when(F.col("lang") == "en", F.concat("source", F.lit(", NA"))).otherwise(
        F.concat(F.lit("NA,[],"), "lang")
    )
    exploded = t.documents.select("doc_id", F.explode(F.split(reply, ",")).alias("attributes"))
    return K.without_sentinels(exploded, "attributes")


@query("filter_not_null", f"WITH {ITEMS} SELECT item, title, description FROM items WHERE trim(description) <> ''")
def _(t):
    return K.with_value(items_to_classify(t).select("item", "title", "description"), "description")


@query("filter_contains", rf"WITH {TAXO} SELECT path, node_key FROM taxo WHERE regexp_matches(path, '\[World, A')")
def _(t):
    return taxonomy(t).where(F.col("path").rlike(r"\[World, A")).select("path", "node_key")


@query(
    "filter_prefix_and_flag",
    f"""WITH {TAXO} SELECT path, node_key FROM taxo
        WHERE (starts_with(path, '[World, ASIA') OR starts_with(path, '[World, EU')) AND is_leaf""",
)
def _(t):
    wanted = K.starts_with_any("path", ["[World, ASIA", "[World, EU"])
    return taxonomy(t).where(wanted & F.col("is_leaf")).select("path", "node_key")


@query(
    "filter_calendar",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders
       WHERE year(o_orderdate) IN (1996, 1998) AND month(o_orderdate) IN (1, 2, 3, 4)""",
)
def _(t):
    kept = t.orders.where(K.in_calendar("o_orderdate", years=[1996, 1998], months=[1, 2, 3, 4]))
    return kept.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))


@query(
    "filter_row_range",
    """SELECT * FROM (SELECT o_orderkey, o_totalprice,
              row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_id FROM orders)
       WHERE row_id >= 400""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return K.row_range(rows, [F.asc("o_totalprice"), F.asc("o_orderkey")], 400)


@query(
    "filter_share_band",
    f"""WITH {KW}, r AS (
          SELECT *, sum(impressions) OVER (PARTITION BY product_type, stream ORDER BY impressions DESC, keywords
                    ROWS UNBOUNDED PRECEDING) AS running_value,
                 sum(impressions) OVER (PARTITION BY product_type, stream) AS total_value FROM kw)
        SELECT * FROM r WHERE (running_value - impressions) / total_value < 0.4""",
)
def _(t):
    order = [F.desc("impressions"), F.asc("keywords")]
    return K.share_band(
        keyword_traffic(t), ["product_type", "stream"], order, "impressions", 0.4, include_crossing=True
    )


@query(
    "filter_min_group_size",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 30)""",
)
def _(t):
    return K.min_group_size(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_partkey"], 30)


@query(
    "filter_values_keep_remove",
    """SELECT p_partkey,
              array_to_string(list_filter(string_split(p_name, ' '), lambda x: x IN ('red', 'ring', 'rod')), ' ') AS kept,
              array_to_string(list_filter(string_split(p_name, ' '), lambda x: x NOT IN ('red', 'ring', 'rod')), ' ') AS removed
       FROM part""",
)
def _(t):
    words, values = F.split("p_name", " "), ["red", "ring", "rod"]
    return t.part.select(
        "p_partkey",
        F.array_join(K.keep_items(words, values), " ").alias("kept"),
        F.array_join(K.remove_items(words, values), " ").alias("removed"),
    )


@query(
    "row_null_predicates",
    f"""WITH {DOCS_LEFT}, n AS (
          SELECT doc_id, CAST(lang IS NULL AS INTEGER) + CAST(quality IS NULL AS INTEGER)
                         + CAST(toxic IS NULL AS INTEGER) AS n_null FROM docs_left)
        SELECT doc_id, n_null, n_null > 0 AS any_null, n_null = 3 AS all_null, n_null >= 2 AS two_null FROM n""",
)
def _(t):
    counted = documents_with_labels(t).select("doc_id", K.null_count(["lang", "quality", "toxic"]).alias("n_null"))
    return counted.select(
        "doc_id", "n_null", (F.col("n_null") > 0).alias("any_null"),
        (F.col("n_null") == 3).alias("all_null"), (F.col("n_null") >= 2).alias("two_null"),
    )


@query(
    "rows_equal_across_columns",
    f"""WITH {DOCS_LEFT} SELECT doc_id, quality, toxic FROM docs_left WHERE quality IS NOT DISTINCT FROM toxic""",
)
def _(t):
    pairs = documents_with_labels(t).select("doc_id", "quality", "toxic")
    return pairs.where(K.equal_across(["quality", "toxic"]))
