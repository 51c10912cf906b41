"""Large ranks, resumed writes and series files."""

import os
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelfline.operators import enrich, windows
from shelfline.session import scratch_path, scratch_scope, shared_dir
from shelfline.sources import files, sinks

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_large_k_gives_the_same_rows_as_a_small_one(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), (F.col("id") * 37 % 3001).alias("v"))
    out = windows.top_per_group(df, ["g"], [F.desc("v")], 1200, sliced=True)
    assert out.groupBy("g").agg(F.count("*").alias("n"), F.max("rank").alias("r")).where("n != 1200 or r != 1200").count() == 0
    narrow = windows.top_per_group(df, ["g"], [F.desc("v")], 5)
    assert sorted(narrow.select("g", "v", "rank").collect()) == sorted(out.where("rank <= 5").select("g", "v", "rank").collect())


def test_finished_groups_are_not_written_again(spark, rows):
    path = scratch_path(spark, "groups")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "g string, v int")
    sinks.write_by_group(first, path, "g", rounds=3)
    sinks.write_by_group(spark.createDataFrame([("a", 99), ("c", 3)], "g string, v int"), path, "g", rounds=2)
    assert rows(spark.read.parquet(path), "g", "v") == [("a", 1), ("b", 2), ("c", 3)]


def test_each_row_is_worked_on_once_whatever_the_rounds(spark, tmp_path):
    path = scratch_path(spark, "called")
    df = spark.range(40).select((F.col("id") % 5).cast("string").alias("g"), F.concat(F.lit("p"), "id").alias("prompt"))
    client = logged(str(tmp_path))
    work = lambda part: enrich.batch_infer(part, "prompt", client, wait=0.0, jitter=0.0)
    # most of the rounds are empty, also the first
    sinks.write_by_group(df.where("g < '3'"), path, "g", work, rounds=16)
    assert len(os.listdir(tmp_path)) == 24 and spark.read.parquet(path).count() == 24
    sinks.write_by_group(df, path, "g", work, rounds=4)
    sinks.write_by_group(df, path, "g", work, rounds=1)
    assert len(os.listdir(tmp_path)) == 40 and spark.read.parquet(path).count() == 40


def logged(path):
    def factory():
        def call(prompt):
            with open(os.path.join(path, uuid.uuid4().hex), "w") as f:
                f.write(prompt)
            return prompt

        return call

    return factory


def test_scratch_tables_go_with_their_scope(spark):
    from shelfline.plans.ordered import running_sum

    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    with scratch_scope(spark):
        assert running_sum(df, ["g"], [F.asc("v")], "v", "cum").count() == 100
        assert len(os.listdir(root)) > len(before)
    assert set(os.listdir(root)) == before


def test_csv_without_line_ends_in_cells_is_read_by_many_tasks(spark):
    path = scratch_path(spark, "big")
    sinks.write_delimited(spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s")).coalesce(1), path)
    split = files.read_delimited(spark, path, "id bigint, s string")
    whole = files.read_delimited(spark, path, "id bigint, s string", line_ends_in_cells=True)
    assert split.rdd.getNumPartitions() > 1 == whole.rdd.getNumPartitions() and split.count() == whole.count() == 200_000


def test_null_keys_in_the_sliced_and_the_plain_rank(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "g string, v int")
    for sliced in (False, True):
        assert rows(windows.top_per_group(df, ["g"], [F.asc("v")], 5, sliced=sliced), "g", "v", "rank") == [("a", 1, 1), ("a", 3, 2)]


def test_each_series_lies_in_one_file_in_order(spark):
    path = scratch_path(spark, "series")
    df = spark.range(400).select((F.col("id") % 9).alias("item"), (400 - F.col("id")).alias("t"))
    sinks.write_whole_series(df, path, "item", [F.asc("t")], shards=3)
    back = spark.read.parquet(path).select("item", "t", F.col("_metadata.file_name").alias("f"))
    assert back.groupBy("item").agg(F.countDistinct("f").alias("n")).where("n != 1").count() == 0
    assert back.count() == 400


def test_channels_written_later_leave_the_others_alone(spark, rows):
    path = scratch_path(spark, "channels")
    sinks.write_by_channel(spark.createDataFrame([(1, "a"), (2, "b")], "v int, c string"), path, "c")
    sinks.write_by_channel(spark.createDataFrame([(3, "b")], "v int, c string"), path, "c")
    assert rows(spark.read.parquet(path), "v", "c") == [(1, "a"), (3, "b")]


def test_training_rows_have_no_header_and_the_label_first(spark):
    path = scratch_path(spark, "train")
    df = spark.createDataFrame([(0.5, 1, 0)], "x double, yes int, no int")
    assert sinks.write_training_rows(df, path, "yes", drop=["no"]) == ["yes", "x"]
    assert [r[0] for r in spark.read.text(path).collect()] == ["1,0.5"]
