"""Sorts, limits, set operations, samples and splits."""

import math

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.operators import sampling as R
from shelfline.operators import sets as S
from shelfline.operators.filters import in_calendar
from shelfline.plans.ordered import cut_lineage
from shelfline.views import DOCS_LEFT, KW, documents_with_labels, keyword_traffic


@query(
    "sort_multi_key",
    f"""WITH {DOCS_LEFT} SELECT doc_id, lang, quality, row_number() OVER (
          ORDER BY quality DESC NULLS LAST, lang DESC NULLS LAST, doc_id DESC NULLS LAST) - 1 AS position
        FROM docs_left""",
)
def _(t):
    rows = documents_with_labels(t).select("doc_id", "lang", "quality")
    order = S.order_nulls_last(["quality", "lang", "doc_id"], descending=True)
    return S.with_sorted_position(rows, order)


@query(
    "topk_bottomk",
    """WITH p AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders),
            largest AS (SELECT * FROM p ORDER BY o_totalprice DESC, o_orderkey LIMIT 25),
            smallest AS (SELECT * FROM p ORDER BY o_totalprice, o_orderkey LIMIT 25)
       SELECT *, CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS INTEGER) AS place, 'largest' AS side FROM largest
       UNION ALL SELECT *, CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS INTEGER), 'smallest' FROM smallest""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return S.top_and_bottom(rows, "o_totalprice", ["o_orderkey"], 25, position=[F.asc("o_orderkey")], ascending=True)


@query("limit_first", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 10")
def _(t):
    return t.part.select("p_partkey", "p_name").orderBy("p_partkey").limit(10)


@query(
    "union_all",
    f"""WITH {KW} SELECT keywords, product_type, stream, impressions FROM kw WHERE stream <= '2-HIGH'
        UNION ALL SELECT keywords, product_type, NULL, impressions FROM kw WHERE stream > '2-HIGH'""",
)
def _(t):
    kw = keyword_traffic(t)
    return S.append(kw.where("stream <= '2-HIGH'"), kw.where("stream > '2-HIGH'").drop("stream"))


@query(
    "union_distinct_master",
    f"WITH {KW} SELECT keywords, product_type, stream, impressions FROM kw",
)
def _(t):
    kw = keyword_traffic(t)
    return S.merge_distinct(kw.where("stream <= '3-MEDIUM'"), kw.where("stream >= '2-HIGH'"))


@query("intersect_values", "SELECT o_custkey AS value FROM orders INTERSECT SELECT c_custkey FROM customer")
def _(t):
    return S.common_values(t.orders, "o_custkey", t.customer, "c_custkey")


@query(
    "is_subset",
    """WITH o AS (SELECT count(DISTINCT c_custkey) AS n_outside FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
       SELECT n_outside = 0 AS is_subset, n_outside, 'customers with orders' AS claim FROM o
       UNION ALL SELECT count(*) = 0, count(DISTINCT o_custkey), 'orders of customers' FROM orders
                 WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def _(t):
    with_orders = S.containment(t.customer, "c_custkey", t.orders, "o_custkey")
    known = S.containment(t.orders, "o_custkey", t.customer, "c_custkey")
    return S.append(
        with_orders.withColumn("claim", F.lit("customers with orders")), known.withColumn("claim", F.lit("orders of customers")))


@query(
    "columns_side_by_side",
    """SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_quantity, l_extendedprice, l_discount, l_tax
       FROM lineitem""",
)
def _(t):
    return t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )


SHA = "sha256(CAST({key} AS VARCHAR) || '#{seed}')"


@query(
    "sample_exact",
    f"""SELECT o_orderkey, o_totalprice FROM orders ORDER BY {SHA.format(key='o_orderkey', seed=7)}
        LIMIT (SELECT CAST(ceil(count(*) * 0.1) AS BIGINT) FROM orders)""",
)
def _(t):
    return R.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 7, fraction=0.1)


SHARE52 = "CAST('0x' || substr({sha}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"
POISSON = [sum(math.exp(-1.5) * 1.5**i / math.factorial(i) for i in range(k + 1)) for k in range(18)]


@query(
    "sample_with_replacement",
    f"""WITH u AS (SELECT o_orderkey, {SHARE52.format(sha=SHA.format(key='o_orderkey', seed=7))} AS u FROM orders),
             d AS (SELECT o_orderkey, {' + '.join(f'CAST(u > {c!r} AS INTEGER)' for c in POISSON)} AS n FROM u)
        SELECT o_orderkey, CAST(unnest(generate_series(1, n)) AS INTEGER) AS draw FROM d""",
)
def _(t):
    return R.sample_with_replacement(t.orders.select("o_orderkey"), ["o_orderkey"], 7, fraction=1.5)


@query(
    "sample_n_with_replacement",
    """WITH p AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
            d AS (SELECT i AS draw, CAST('0x' || substr(sha256(CAST(i AS VARCHAR) || '#5'), 1, 15) AS BIGINT)
                         % (SELECT count(*) FROM orders) AS pos FROM (SELECT unnest(range(1, 2001)) AS i))
       SELECT o_orderkey, o_totalprice, draw FROM d JOIN p USING (pos)""",
)
def _(t):
    return R.sample_with_replacement(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5, n=2000)


@query(
    "bernoulli_flag",
    f"SELECT o_orderkey, {SHARE52.format(sha=SHA.format(key='o_orderkey', seed=3))} <= 0.25 AS chosen FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", R.chosen_with_probability(["o_orderkey"], 3, 0.25).alias("chosen"))


@query(
    "shuffle_rows",
    f"SELECT p_partkey, p_name FROM part ORDER BY {SHA.format(key='p_partkey', seed=5)}",
)
def _(t):
    return R.shuffled(t.part.select("p_partkey", "p_name"), ["p_partkey"], 5)


@query(
    "split_train_test",
    f"""WITH h AS (SELECT d.doc_id, quality, n_chars, row_number() OVER (ORDER BY {SHA.format(key='d.doc_id', seed=1729)})
                   AS rn, count(*) OVER () AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
        SELECT doc_id, quality, n_chars, CASE WHEN rn <= floor(round(n * 0.7, 9)) THEN 'train' ELSE 'test' END AS part
        FROM h""",
)
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select("doc_id", "quality", "n_chars")
    return R.train_test(cut_lineage(rows), ["doc_id"], 1729)


@query(
    "split_by_time",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN year(l_shipdate) IN (1998, 1999) THEN 'train' ELSE 'test' END AS part
       FROM lineitem WHERE year(l_shipdate) IN (1998, 1999)
          OR (year(l_shipdate) = 2000 AND month(l_shipdate) IN (1, 2, 3, 4))""",
)
def _(t):
    train = in_calendar("l_shipdate", years=[1998, 1999])
    test = in_calendar("l_shipdate", years=[2000], months=[1, 2, 3, 4])
    return t.lineitem.where(train | test).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(train, "train").otherwise("test").alias("part")
    )


@query(
    "pick_any",
    f"""SELECT c_nationkey, arg_min(c_custkey, {SHA.format(key='c_custkey', seed=9)}) AS picked FROM customer GROUP BY 1""",
)
def _(t):
    return R.any_value_per_group(t.customer, ["c_nationkey"], "c_custkey", 9)
