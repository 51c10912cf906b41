"""Scans and sinks; written tables go to the shared scratch folder and are read back."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.operators import sets
from shelfline.session import scratch_path
from shelfline.sources import files, sinks
from shelfline.views import KW, SERIES, keyword_traffic, weekly_series

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("scan_parquet", "SELECT * FROM customer")
def _(t):
    return t.customer


@query(
    "scan_parquet_many_with_provenance",
    """SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows, count(l_orderkey) AS lines, 0::BIGINT AS orders FROM lineitem
       UNION ALL SELECT 'orders.parquet', count(*), 0, count(o_orderkey) FROM orders""",
)
def _(t):
    both = files.read_folder(t.spark, t.folder, "{lineitem,orders}.parquet", schema="l_orderkey bigint, o_orderkey bigint")
    return both.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("l_orderkey").alias("lines"), F.count("o_orderkey").alias("orders")
    )


@query(
    "scan_glob_cached",
    """SELECT 'flag' AS kind, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2
       UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem GROUP BY 2""",
)
def _(t):
    lines = files.read_reused(t.spark, f"{t.folder}/line*.parquet", "l_returnflag", "l_linestatus")

    def counts(kind, column):
        return lines.groupBy(F.lit(kind).alias("kind"), F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))

    return sets.append(counts("flag", "l_returnflag"), counts("status", "l_linestatus"))


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = scratch_path(t.spark, "customer.csv")
    indexed = t.customer.select(F.col("c_custkey").alias("row"), "*")
    sinks.write_delimited(indexed, path)
    return files.read_delimited(t.spark, path, "row bigint, " + CUSTOMER, drop=("row",))


@query("scan_tsv", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def _(t):
    path = scratch_path(t.spark, "part.tsv")
    sinks.write_delimited(t.part.select("p_partkey", "p_name", "p_brand", "p_size"), path, sep="\t")
    return files.read_delimited(t.spark, path, "p_partkey bigint, p_name string, p_brand string, p_size int", sep="\t")


@query(
    "parse_csv_payload",
    """SELECT s_suppkey, 'name' AS field, s_name AS label, CAST(s_nationkey AS DOUBLE) AS amount FROM supplier
       UNION ALL SELECT s_suppkey, 'balance', 'USD', s_acctbal FROM supplier""",
)
def _(t):
    payload = F.concat(
        F.lit("field,label,amount\nname,"), "s_name", F.lit(","), F.col("s_nationkey").cast("string"),
        F.lit("\nbalance,USD,"), F.col("s_acctbal").cast("string"), F.lit("\n"),
    )
    replies = t.supplier.select("s_suppkey", payload.alias("payload"))
    return files.rows_from_csv_text(replies, "payload", "field string, label string, amount double", header=True)


@query("scan_whole_text", "SELECT sha256(html) AS digest, count(*) AS n FROM pages GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "pages")
    sinks.write_documents(t.pages.select("html"), path, per_file=100)
    pages = files.whole_texts(t.spark, path, separator=sinks.RECORD_MARK)
    return pages.groupBy(F.sha2("text", 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"))


@query("scan_json_docs", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    path = scratch_path(t.spark, "suppliers")
    nested = t.supplier.select("s_suppkey", F.struct("s_name", "s_nationkey").alias("who"), "s_acctbal")
    sinks.write_documents(nested, path, kind="json", per_file=100)
    schema = "s_suppkey bigint, who struct<s_name: string, s_nationkey: int>, s_acctbal double"
    return files.json_documents(t.spark, path, schema, "*.txt").select("s_suppkey", "who.*", "s_acctbal")


@query("scan_sub_prefixes", "SELECT event_id, user_id, event_type AS stream, event_type AS folder FROM events")
def _(t):
    path = scratch_path(t.spark, "events")
    sinks.write_by_channel(t.events.select("event_id", "user_id", F.col("event_type").alias("stream")), path, "stream")
    rows = t.spark.read.parquet(path)
    return rows.select("event_id", "user_id", "stream", files.channel_from_path().alias("folder"))


@query("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def _(t):
    return files.preview(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), [F.asc("o_orderkey")], 20)


@query("sink_parquet", f"WITH {KW} SELECT * FROM kw")
def _(t):
    path = scratch_path(t.spark, "kw")
    sinks.write_parquet(keyword_traffic(t), path)
    return t.spark.read.parquet(path)


@query(
    "sink_replace_in_place",
    f"WITH {KW} SELECT keywords, product_type, sum(impressions) AS impressions, count(*) AS streams FROM kw GROUP BY 1, 2",
)
def _(t):
    path = scratch_path(t.spark, "kw")
    sinks.write_parquet(keyword_traffic(t), path)
    reduced = t.spark.read.parquet(path).groupBy("keywords", "product_type").agg(
        F.sum("impressions").alias("impressions"), F.count(F.lit(1)).alias("streams")
    )
    sinks.replace_in_place(reduced, path)
    return t.spark.read.parquet(path)


@query("sink_csv", "SELECT doc_id, text, source FROM documents")
def _(t):
    path = scratch_path(t.spark, "documents.csv")
    sinks.write_delimited(t.documents.select("doc_id", "text", "source"), path)
    return files.read_delimited(t.spark, path, "doc_id bigint, text string, source string", line_ends_in_cells=True)


@query(
    "sink_training_csv",
    """SELECT CAST(l_returnflag = 'R' AS INTEGER) AS returned, l_quantity, l_extendedprice, l_discount FROM lineitem""",
)
def _(t):
    path = scratch_path(t.spark, "train.csv")
    is_back = F.col("l_returnflag") == "R"
    rows = t.lineitem.select(
        "l_quantity", "l_extendedprice", "l_discount",
        is_back.cast("int").alias("returned"), (~is_back).cast("int").alias("kept"),
    )
    order = sinks.write_training_rows(rows, path, "returned", drop=["kept"])
    schema = ", ".join(f"{c} {'int' if c == 'returned' else 'double'}" for c in order)
    return t.spark.read.schema(schema).csv(path)


@query(
    "sink_as_strings",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier",
)
def _(t):
    path = scratch_path(t.spark, "supplier")
    sinks.write_as_strings(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), path)
    return t.spark.read.parquet(path)


@query(
    "sink_partitioned_by_channel",
    "SELECT event_id, user_id, value, '2024-01-31' AS run_date, event_type AS stream FROM events",
)
def _(t):
    path = scratch_path(t.spark, "by_channel")
    rows = t.events.select(
        "event_id", "user_id", "value", F.lit("2024-01-31").alias("run_date"), F.col("event_type").alias("stream")
    )
    # the channels land in two runs; the second one leaves the first one's folders alone
    sinks.write_by_channel(rows.where("stream in ('view', 'click')"), path, "stream")
    sinks.write_by_channel(rows.where("stream not in ('view', 'click')"), path, "stream")
    return t.spark.read.parquet(path)


@query(
    "sink_whole_series_shards",
    f"WITH {SERIES} SELECT item, count(*) AS weeks, sum(y) AS total, 1::BIGINT AS n_files FROM series GROUP BY 1",
)
def _(t):
    path = scratch_path(t.spark, "series")
    sinks.write_whole_series(weekly_series(t), path, "item", [F.asc("week")], shards=4)
    rows = t.spark.read.parquet(path).select("item", "y", F.col("_metadata.file_name").alias("f"))
    return rows.groupBy("item").agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("y").alias("total"), F.countDistinct("f").alias("n_files")
    )


@query("sink_progress_per_group", f"WITH {KW} SELECT upper(keywords) AS keywords, stream, impressions, product_type FROM kw")
def _(t):
    path = scratch_path(t.spark, "progress")
    kw = keyword_traffic(t)
    # an earlier run got two categories done; the full run works on the others only
    upper = lambda rows: rows.withColumn("keywords", F.upper("keywords"))
    sinks.write_by_group(kw.where("product_type in ('PROMO', 'SMALL')"), path, "product_type", upper, rounds=1)
    sinks.write_by_group(kw, path, "product_type", upper, rounds=3)
    return t.spark.read.parquet(path)
