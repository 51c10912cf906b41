"""Whole documents to files and back."""

import os

from pyspark.sql import functions as F

from shelfline.session import scratch_path
from shelfline.sources import files, sinks


def sizes(path):
    folder = path.removeprefix("file:")
    return [os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.startswith("part-")]


def test_equal_documents_part_and_files_follow_bytes(spark):
    text = "x" * 1000
    df = spark.range(400).select(F.when(F.col("id") % 4 > 0, F.lit(text)).otherwise(F.concat(F.lit("own\n\n"), "id")).alias("text"))
    path = scratch_path(spark, "docs")
    sinks.write_documents(df, path, bytes_per_file=50_000)
    assert len(sizes(path)) == 7 and max(sizes(path)) < 70_000
    back = files.whole_texts(spark, path, separator=sinks.RECORD_MARK)
    assert sorted(r.text for r in back.collect()) == sorted(r.text for r in df.collect())
    sinks.write_documents(df, path, per_file=100)
    assert len(sizes(path)) == 4


def test_no_row_holds_more_than_one_document(spark):
    plan = []
    df = spark.range(50).select(F.repeat(F.lit("a"), 100).alias("text"))
    path = scratch_path(spark, "docs")
    sinks.write_documents(df, path)
    # the writer puts one record per document into the file
    plan = spark.read.option("lineSep", sinks.RECORD_MARK).text(path)
    assert plan.count() == 50 and plan.agg(F.max(F.length("value"))).first()[0] == 100


def test_json_documents_come_back_nested(spark):
    df = spark.createDataFrame([(1, {"a": 1}, "x\n\"y\""), (2, None, None), (2, None, None)], "id int, m map<string,int>, s string")
    for n in (1, 2, 100):
        path = scratch_path(spark, "json")
        sinks.write_documents(df, path, kind="json", per_file=n)
        back = files.json_documents(spark, path, "id int, m map<string,int>, s string", "*.txt")
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_null_empty_and_no_documents(spark):
    path = scratch_path(spark, "docs")
    sinks.write_documents(spark.createDataFrame([(None,), ("",), ("a",)], "text string"), path)
    assert sorted(r.text for r in files.whole_texts(spark, path, separator=sinks.RECORD_MARK).collect()) == ["", "", "a"]
    for kind in ("text", "json"):
        path = scratch_path(spark, "none")
        sinks.write_documents(spark.createDataFrame([], "text string"), path, kind=kind)
        back = files.whole_texts(spark, path, separator=sinks.RECORD_MARK) if kind == "text" else files.json_documents(spark, path, "text string", "*.txt")
        assert back.count() == 0
