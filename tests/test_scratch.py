"""Written rows live as long as something reads them."""

import gc
import os
import time

from pyspark.sql import functions as F

from shelfline import session
from shelfline.plans.ordered import cut_lineage
from shelfline.session import shared_dir, sweep


def folders(spark):
    return {f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith("scratch-")}


def collected(spark):
    """What is left after both garbage collectors had their turn."""
    for _ in range(20):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if sweep(spark):
            break
        time.sleep(0.2)
    return folders(spark)


def test_rows_stay_while_a_frame_made_from_them_lives(spark):
    collected(spark)
    before = folders(spark)
    written = cut_lineage(spark.range(1000).withColumn("k", F.col("id") % 7))
    (mine,) = folders(spark) - before
    grouped = written.groupBy("k").count().join(written.where("id < 10"), "k")
    del written
    assert mine in collected(spark) and grouped.count() == 10
    cached = grouped.cache()
    assert cached.count() == 10
    del grouped
    assert mine in collected(spark) and cached.agg(F.sum("count")).first()[0] > 0
    cached.unpersist()
    del cached
    assert mine not in collected(spark)


def test_a_query_outside_a_scope_leaves_nothing_behind(spark, folder):
    from shelfline.catalog import runnable

    collected(spark)
    before = folders(spark)
    result = runnable()["pareto_head"](spark, folder)
    n = result.count()
    assert n and folders(spark) - before
    del result
    for _ in range(10):
        if not collected(spark) - before:
            break
    assert not folders(spark) - before
    assert all(app == spark.sparkContext.applicationId for app, _, _ in session._written)


def test_shuffle_files_go_when_the_rows_are_written(spark):
    before = spark.conf.get(session.CLEANUP, None)
    cut_lineage(spark.range(100).repartition(4, "id"))
    assert spark.conf.get(session.CLEANUP, None) == before
