"""The master table fed by a stream of landed files."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.session import scratch_path
from shelfline.streaming.master import grow_master, read_master


@query(
    "master_incremental",
    """SELECT event_id, CASE WHEN event_id % 7 > 0 THEN user_id END AS user_id, event_type, CASE WHEN event_id % 5 > 0 THEN value END AS value
       FROM events""",
)
def _(t):
    # some keys hold nulls, and come twice
    some = lambda column, by: F.when(F.col("event_id") % by > 0, F.col(column)).alias(column)
    rows = t.events.select("event_id", some("user_id", 7), "event_type", some("value", 5))
    landing, master, progress = (scratch_path(t.spark, n) for n in ("landing", "master", "progress"))
    # two deliveries that overlap in the clicks
    deliveries = [F.col("event_type").isin("click", "view"), F.col("event_type") != "view"]
    for i, wanted in enumerate(deliveries):
        rows.where(wanted).write.mode("errorifexists").parquet(f"{landing}/delivery-{i}")
        run = grow_master(t.spark, landing, rows.schema, master, progress, keys=rows.columns, files_per_batch=8)
        run.awaitTermination()
    return read_master(t.spark, master, rows.schema)
