"""The given tables and the views the queries share, each with its SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def keyword_traffic(t: Tables) -> DataFrame:
    """kw: impressions per (keywords, product_type, stream).

    Quantities are summed per (part, channel) before the part names are joined,
    so the second shuffle carries the reduced rows only.
    """
    per_part = (
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
        .join(
            t.orders.select("o_orderkey", "o_orderpriority"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .groupBy("l_partkey", "o_orderpriority")
        .agg(F.sum("l_quantity").alias("impressions"))
    )
    return (
        per_part.join(
            t.part.select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey")
        )
        .groupBy(
            F.col("p_name").alias("keywords"),
            F.col("p_type").alias("product_type"),
            F.col("o_orderpriority").alias("stream"),
        )
        .agg(F.sum("impressions").alias("impressions"))
    )


KW = """kw AS (
  SELECT p_name AS keywords, p_type AS product_type, o_orderpriority AS stream,
         sum(l_quantity) AS impressions
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""


def label_words(traffic: DataFrame) -> DataFrame:
    """One row per keyword row and word of the keyword."""
    return traffic.withColumn("attributes", F.explode(F.split("keywords", " ")))


def labelled_keywords(t: Tables) -> DataFrame:
    """attr: the keyword traffic with one attribute per row."""
    return label_words(keyword_traffic(t))


ATTR = (
    KW
    + """, attr AS (
  SELECT keywords, product_type, stream, impressions,
         unnest(string_split(keywords, ' ')) AS attributes FROM kw)"""
)


def attribute_weights(t: Tables) -> DataFrame:
    """weights: known (category, attribute) pairs; words sold only rarely in a category have none."""
    return (
        t.part.select(F.col("p_type").alias("product_type"), F.explode(F.split("p_name", " ")).alias("sa_name"),
                      "p_size")
        .groupBy("product_type", "sa_name")
        .agg(F.avg("p_size").alias("_avg"))
        .where(F.col("_avg") >= 25)
        .select("product_type", "sa_name", (F.floor("_avg") / 50.0).alias("completeness_weight"))
    )


WEIGHTS = """weights AS (
  SELECT product_type, sa_name, floor(avg(p_size)) / 50.0 AS completeness_weight
  FROM (SELECT p_type AS product_type, unnest(string_split(p_name, ' ')) AS sa_name, p_size FROM part)
  GROUP BY 1, 2 HAVING avg(p_size) >= 25)"""


def weekly_series(t: Tables, item: str = "p_type") -> DataFrame:
    """series: quantity per (item, week)."""
    return (
        t.lineitem.select("l_partkey", "l_quantity", "l_shipdate")
        .join(t.part.select("p_partkey", F.expr(item).alias("item")), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("item", F.to_date(F.date_trunc("week", "l_shipdate")).alias("week"))
        .agg(F.sum("l_quantity").alias("y"))
    )


def series_sql(name: str = "series", item: str = "p_type") -> str:
    return f"""{name} AS (
  SELECT {item} AS item, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, sum(l_quantity) AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


SERIES = series_sql()
# brand and type together: many weeks without a sale, so the gaps are real ones
FINE_ITEM = "concat(p_brand, '/', p_type)"


def daily_series(t: Tables) -> DataFrame:
    """series_day: value per (event type, day)."""
    return t.events.groupBy(
        F.col("event_type").alias("item"), F.to_date("ts").alias("day")
    ).agg(F.round(F.sum("value"), 2).alias("y"))


SERIES_DAY = """series_day AS (
  SELECT event_type AS item, CAST(ts AS DATE) AS day, round(sum(value), 2) AS y
  FROM events GROUP BY 1, 2)"""


def taxonomy(t: Tables) -> DataFrame:
    """taxo: bracketed path text, node key and leaf flag for every node below the world."""
    leaves = (
        t.customer.select("c_nationkey", "c_mktsegment")
        .distinct()
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "c_mktsegment")
    )
    levels = F.array(
        F.struct(F.concat_ws(", ", F.lit("World"), "r_name").alias("p"), F.lit(False).alias("leaf")),
        F.struct(F.concat_ws(", ", F.lit("World"), "r_name", "n_name").alias("p"), F.lit(False).alias("leaf")),
        F.struct(
            F.concat_ws(", ", F.lit("World"), "r_name", "n_name", "c_mktsegment").alias("p"),
            F.lit(True).alias("leaf"),
        ),
    )
    return (
        leaves.select(F.explode(levels).alias("n"))
        .select(F.concat(F.lit("["), "n.p", F.lit("]")).alias("path"), F.col("n.leaf").alias("is_leaf"))
        .distinct()
        .select("path", F.upper(F.md5("path")).alias("node_key"), "is_leaf")
    )


TAXO = """leafs AS (
  SELECT DISTINCT r_name, n_name, c_mktsegment FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
nodes AS (
  SELECT '[World, ' || r_name || ']' AS path, false AS is_leaf FROM leafs
  UNION SELECT '[World, ' || r_name || ', ' || n_name || ']', false FROM leafs
  UNION SELECT '[World, ' || r_name || ', ' || n_name || ', ' || c_mktsegment || ']', true FROM leafs),
taxo AS (SELECT path, upper(md5(path)) AS node_key, is_leaf FROM nodes)"""


def items_to_classify(t: Tables) -> DataFrame:
    """items: documents as catalog items; the description is missing where no label exists."""
    return t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left").select(
        F.col("doc_id").alias("item"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        F.when(F.col("quality").isNotNull(), F.col("text")).alias("description"),
        F.concat(F.lit("no text, "), F.col("n_chars").cast("string"), F.lit(" characters")).alias("fallback"),
    )


ITEMS = """items AS (
  SELECT d.doc_id AS item, lang || ' ' || source AS title,
         CASE WHEN quality IS NOT NULL THEN text END AS description,
         'no text, ' || CAST(n_chars AS VARCHAR) || ' characters' AS fallback
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def model_replies(t: Tables) -> DataFrame:
    """llm_out: reply text per document, well-formed for English and malformed in a
    different way for each other language (tag left open, tag missing, tag twice)."""
    head = F.concat(F.lit("<thinking>written in "), "lang", F.lit(" &amp; taken from "), "source", F.lit("</thinking>\n"))
    item = F.concat(F.lit("<category><item>"), "source", F.lit("</item>"))
    tail = F.lit("</category>\n<confidence>high</confidence>")
    body = (
        F.when(F.col("lang") == "fr", F.concat(head, item))
        .when(F.col("lang") == "de", F.concat(head, F.lit("<confidence>low</confidence>")))
        .when(F.col("lang") == "es", F.concat(head, item, F.lit("</category>\n<category><item>NA</item>"), tail))
        .otherwise(F.concat(head, item, tail))
    )
    return t.documents.select(F.col("doc_id").alias("id"), body.alias("output"))


LLM_OUT = """llm_out AS (
  SELECT doc_id AS id,
    '<thinking>written in ' || lang || ' &amp; taken from ' || source || '</thinking>' || chr(10) ||
    CASE lang
      WHEN 'fr' THEN '<category><item>' || source || '</item>'
      WHEN 'de' THEN '<confidence>low</confidence>'
      WHEN 'es' THEN '<category><item>' || source || '</item></category>' || chr(10) ||
                     '<category><item>NA</item></category>' || chr(10) || '<confidence>high</confidence>'
      ELSE '<category><item>' || source || '</item></category>' || chr(10) || '<confidence>high</confidence>'
    END AS output
  FROM documents)"""


def scored_labels(t: Tables) -> DataFrame:
    """scored: observed class and a score between 0 and 1 that grows with the text length."""
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id",
        F.col("quality").alias("observed"),
        (F.col("n_chars") / (F.col("n_chars") + 600.0)).alias("p"),
    )


SCORED = """scored AS (
  SELECT l.doc_id, quality AS observed, n_chars / (n_chars + 600.0) AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def documents_with_labels(t: Tables) -> DataFrame:
    """docs_left: documents left-joined to their labels, so both label columns hold nulls."""
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


DOCS_LEFT = """docs_left AS (
  SELECT d.doc_id, lang, source, n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
