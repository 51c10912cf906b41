"""Projections and column-level work."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.functions.text import render_template
from shelfline.operators import columns as C
from shelfline.views import DOCS_LEFT, ITEMS, KW, documents_with_labels, items_to_classify, keyword_traffic

# Weight of each channel in the combined ranking; any other channel weighs 0.4.
STREAM_WEIGHTS = {"1-URGENT": 0.2, "2-HIGH": 0.2, "3-MEDIUM": 0.2}
OTHER_WEIGHT = 0.4
WEIGHT_SQL = "CAST(CASE WHEN stream IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 0.2 ELSE 0.4 END AS DOUBLE)"


@query("project_columns", "SELECT p_partkey, p_name, p_type FROM part")
def _(t):
    return t.part.select("p_partkey", "p_name", "p_type")


@query(
    "rename_columns",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
              c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
)
def _(t):
    by_name = t.customer.withColumnsRenamed({"c_custkey": "customer_id"})
    return C.by_position(by_name, ["customer_id", "customer_name", "nation_id", "balance", "segment"])


@query("drop_columns", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    doubled = t.supplier.withColumn("s_name.1", F.col("s_name")).withColumn("s_nationkey.1", F.col("s_nationkey"))
    return C.drop_suffixed(doubled, ".1")


@query(
    "reorder_columns_partial",
    """SELECT o_orderpriority, o_totalprice, o_orderkey, o_custkey, o_orderstatus,
              strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""",
)
def _(t):
    dated = t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return C.first_columns(dated, ["o_orderpriority", "o_totalprice"])


@query(
    "slice_columns_by_position",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
       FROM lineitem""",
)
def _(t):
    return C.column_slice(t.lineitem, 0, 8)


@query("select_columns_by_pattern", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def _(t):
    return C.columns_matching(t.lineitem, r"l_\w+key", anchored=True)


@query(
    "stamp_literals",
    f"WITH {KW} SELECT keywords, product_type, impressions, 'Customer_Search' AS channel, '2024-01-31' AS run_date FROM kw",
)
def _(t):
    kw = keyword_traffic(t).select("keywords", "product_type", "impressions")
    return C.stamp(kw, channel="Customer_Search", run_date="2024-01-31")


@query(
    "select_with_missing_policy",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(NULL AS VARCHAR) AS p_colour,
              p_retailprice FROM part""",
)
def _(t):
    wanted = {"p_partkey": "string", "p_name": "string", "p_colour": "string", "p_retailprice": "double"}
    return C.select_wanted(t.part, wanted, missing="null")


@query(
    "template_column",
    """SELECT p_partkey, '<att>' || p_type || ', ' || p_brand || '</att>' || chr(10) || '<inp>' || p_name || '</inp>'
              AS prompt FROM part""",
)
def _(t):
    template = "<att>{category}, {brand}</att>\n<inp>{title}</inp>"
    prompt = render_template(template, category="p_type", brand="p_brand", title="p_name")
    return t.part.select("p_partkey", prompt.alias("prompt"))


@query("weight_case", f"WITH {KW} SELECT keywords, product_type, stream, {WEIGHT_SQL} AS weight FROM kw")
def _(t):
    return keyword_traffic(t).select(
        "keywords", "product_type", "stream",
        C.stream_weight(F.col("stream"), STREAM_WEIGHTS, OTHER_WEIGHT).alias("weight"),
    )


@query("coalesce_columns", f"WITH {ITEMS} SELECT item, coalesce(description, fallback) AS description FROM items")
def _(t):
    return items_to_classify(t).select("item", F.coalesce("description", "fallback").alias("description"))


@query(
    "fill_nulls",
    f"""WITH {ITEMS} SELECT item, title, coalesce(description, 'missing') AS description, fallback FROM items""",
)
def _(t):
    return C.fill_nulls(items_to_classify(t), "missing")


@query(
    "cast_all_to_string",
    f"""WITH {DOCS_LEFT} SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source,
        CAST(n_chars AS VARCHAR) AS n_chars, CAST(quality AS VARCHAR) AS quality,
        CAST(toxic AS VARCHAR) AS toxic FROM docs_left""",
)
def _(t):
    return C.all_strings(documents_with_labels(t))


@query(
    "reset_row_ids",
    """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_id, o_orderkey, o_totalprice
       FROM orders WHERE o_orderstatus = 'F'""",
)
def _(t):
    kept = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    return C.row_ids(kept, [F.desc("o_totalprice"), F.asc("o_orderkey")])
