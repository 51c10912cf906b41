"""Results of the native text operators stay cheap when a caller filters them: arrays are built once, not per element."""

import time

from pyspark.sql import functions as F

from shelfline.llm import line_dedup, quality_rules


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def seconds(df):
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def test_a_filter_computes_nothing_per_element(documents):
    for operator, condition, marks in (
        (quality_rules.judge, "kept", ("sort_array", "array_distinct")), (line_dedup.decide, "removed_lines > 0", ("md5",))):
        plain, filtered = operator(documents), operator(documents).where(condition)
        for mark in marks:  # in the filter and the output a few times, never per element
            assert plan(filtered).count(mark) <= 3 * plan(plain).count(mark), (mark, operator)
        seconds(plain)
        assert seconds(filtered) < 2 * seconds(plain) + 2, operator


def test_the_sample_of_the_cascade_is_not_read_by_one_task(spark):
    docs = spark.range(0, 4000, 1, 6).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c "), "id").alias("text"))
    rules = quality_rules.default_rules(F.col("text"))
    spark.sparkContext.setJobGroup("sample scan", "")
    try:
        quality_rules.estimate(docs, rules, ["doc_id", "text"], rows=40)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("sample scan") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # counting the rows and writing the sample
    assert sum(s is not None and s.numTasks == 6 for s in stages) >= 2
