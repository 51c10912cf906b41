"""The incremental master equals the batch merge, also after a replay."""

from pyspark.sql import functions as F

from shelfline.operators.sets import merge_distinct
from shelfline.session import scratch_path
from shelfline.streaming import master as M
from shelfline.streaming.master import grow_master, merge_batch, read_master


def test_incremental_equals_batch(spark, tables, rows):
    events = tables.events.select("event_id", "user_id", "event_type")
    parts = [events.where("event_id < 60"), events.where("event_id between 30 and 90"), events.where("event_id < 60")]
    landing, master, progress = (scratch_path(spark, n) for n in ("landing", "master", "progress"))
    for i, part in enumerate(parts):
        part.write.parquet(f"{landing}/{i}")
        grow_master(spark, landing, events.schema, master, progress, events.columns, files_per_batch=1).awaitTermination()
    assert rows(read_master(spark, master)) == rows(merge_distinct(*parts))


def test_a_replayed_batch_writes_the_same_rows(spark, rows):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    master = scratch_path(spark, "master")
    merge_batch(df.where("id < 5"), 0, master, ["id"], df.schema)
    merge_batch(df.where("id < 8"), 1, master, ["id"], df.schema)
    merge_batch(df.where("id < 8"), 1, master, ["id"], df.schema)
    merge_batch(df, 2, master, ["id"], df.schema)
    assert rows(read_master(spark, master)) == rows(df)


def small_batches(spark, n, per=3):
    df = spark.range(n * per).withColumn("v", F.col("id") * 2)
    return df, [df.where(F.col("id").between(i * per, i * per + per - 1)) for i in range(n)]


def test_a_batch_reads_the_buckets_of_its_keys_only(spark):
    df = spark.range(4000).withColumn("v", F.col("id") * 2)
    master = scratch_path(spark, "master")
    merge_batch(df.where("id < 3000"), 0, master, ["id"], df.schema)
    assert len({f[0] for f in M.live_folders(spark, master)}) == M.BUCKETS
    read = []
    seen, real = M.read_folders, M.read_folders
    try:
        M.read_folders = lambda *a: read.append(seen(*a)) or read[-1]
        merge_batch(df.where("id in (5, 3500)"), 1, master, ["id"], df.schema)
    finally:
        M.read_folders = real
    buckets = {f.split("bucket=")[1].split("/")[0] for r in read for f in r.inputFiles()}
    assert 1 <= len(buckets) <= 2 and len({f for r in read for f in r.inputFiles()}) <= 2 * 8
    assert read_master(spark, master).count() == 3001


def test_many_small_batches_stay_few_folders_and_lose_nothing(spark, rows):
    df, batches = small_batches(spark, 20)
    master = scratch_path(spark, "master")
    for i, batch in enumerate(batches):
        # every batch comes with rows of the one before it
        again = batch if i == 0 else batch.unionByName(batches[i - 1])
        merge_batch(again, i, master, ["id"], df.schema, buckets=2, fan=3)
        if i % 7 == 3:
            merge_batch(again, i, master, ["id"], df.schema, buckets=2, fan=3)  # replayed
    assert rows(read_master(spark, master)) == rows(df)
    live = M.live_folders(spark, master)
    assert max(f[1] for f in live) >= 2
    for bucket in (0, 1):
        assert sum(f[0] == bucket for f in live) <= 3 * 3
        # merged folders are removed, at the latest one merge later
        assert sum(f[0] == bucket for f in M._folders(spark, master)) <= 3 * 3 + 2 * 3


def test_a_merge_that_stops_before_its_clean_up_changes_nothing(spark, rows):
    df, batches = small_batches(spark, 5)
    master = scratch_path(spark, "master")
    for i, batch in enumerate(batches[:4]):
        merge_batch(batch, i, master, ["id"], df.schema, buckets=2, fan=100)
    before = M._folders(spark, master)
    M.merge_levels(spark, master, df.schema, [0, 1], 4, fan=2)
    assert set(before) < set(M._folders(spark, master)) and all(f[1] > 0 for f in M.live_folders(spark, master))
    assert rows(read_master(spark, master)) == rows(df.where("id < 12"))
    merge_batch(batches[4].unionByName(batches[0]), 4, master, ["id"], df.schema, buckets=2, fan=2)
    assert rows(read_master(spark, master)) == rows(df)


def test_nulls_and_empty_batches(spark, rows):
    df = spark.createDataFrame([(None, "a"), (1, None), (None, None), (1, None)], "k int, s string")
    master = scratch_path(spark, "master")
    merge_batch(df.where("false"), 0, master, ["k", "s"], df.schema)
    assert read_master(spark, master, df.schema).count() == 0
    merge_batch(df, 1, master, ["k", "s"], df.schema)
    merge_batch(df, 2, master, ["k", "s"], df.schema)
    assert rows(read_master(spark, master)) == rows(df.distinct())
