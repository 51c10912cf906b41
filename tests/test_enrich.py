"""The bulk model call with stub clients."""

import os
import sys
import threading
import time
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelfline.catalog.stub_clients import attribute_tagger
from shelfline.operators import enrich
from shelfline.operators.classify import classify_root_then_leaf

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_WAIT = {"wait": 0.0, "jitter": 0.0}


def logged(path):
    """A client that leaves one file per call and reports how many ran at once."""

    def factory():
        lock, running = threading.Lock(), [0]

        def call(prompt):
            with lock:
                running[0] += 1
                now = running[0]
            time.sleep(0.01)
            with open(os.path.join(path, f"{now}-{uuid.uuid4().hex}"), "w") as f:
                f.write(prompt)
            with lock:
                running[0] -= 1
            return prompt[::-1]

        return call

    return factory


def flaky_echo():
    """Fails (length mod 5) times for a prompt before it answers in upper case."""
    failed: dict[str, int] = {}

    def call(prompt):
        if failed.get(prompt, 0) < len(prompt) % 5:
            failed[prompt] = failed.get(prompt, 0) + 1
            raise ConnectionError("busy")
        return prompt.upper()

    return call


@pytest.fixture
def prompts(spark):
    return spark.range(60).select("id", F.concat(F.lit("text "), (F.col("id") % 7).cast("string")).alias("prompt"))


def test_replies_stay_with_their_rows(prompts):
    out = enrich.batch_infer(prompts, "prompt", attribute_echo, max_workers=5, **NO_WAIT)
    assert out.where(F.col("generated_text") != F.upper("prompt")).count() == 0
    assert out.count() == 60 and out.where("attempts != 1 or error is not null or time_taken_sec < 0").count() == 0


def attribute_echo():
    return lambda prompt: prompt.upper()


def test_distinct_prompts_are_sent_once_and_concurrency_is_capped(prompts, tmp_path):
    out = enrich.infer_distinct(prompts, "prompt", logged(str(tmp_path)), max_workers=3, partitions=2, **NO_WAIT)
    assert out.count() == 60 and out.where(F.col("generated_text") != F.reverse("prompt")).count() == 0
    calls = os.listdir(tmp_path)
    assert len(calls) == 7
    assert max(int(c.split("-")[0]) for c in calls) <= 3


def test_failures_become_a_status(spark):
    df = spark.createDataFrame([("x" * n,) for n in range(5, 10)], "prompt string")
    got = {r.prompt: r for r in enrich.batch_infer(df, "prompt", flaky_echo, retries=2, **NO_WAIT).collect()}
    assert [got["x" * n].attempts for n in range(5, 10)] == [1, 2, 3, 3, 3]
    assert got["x" * 7].generated_text == "X" * 7 and got["x" * 7].error is None
    assert got["x" * 9].generated_text is None and got["x" * 9].error == "ConnectionError: busy"


def test_sleep_only_between_attempts():
    def down(_):
        raise OSError("down")

    began = time.perf_counter()
    text, seconds, attempts, error = enrich.call_with_retry(down, "p", retries=2, wait=0.1, jitter=0.0)
    assert (text, attempts, error) == (None, 3, "OSError: down")
    assert 0.2 <= time.perf_counter() - began < 0.3 and seconds >= 0.2


def test_rate_limit(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("prompt"))
    began = time.perf_counter()
    enrich.batch_infer(df, "prompt", attribute_echo, partitions=1, calls_per_second=40.0, **NO_WAIT).count()
    # count() would drop the column, so force it
    enrich.batch_infer(df, "prompt", attribute_echo, partitions=1, calls_per_second=40.0, **NO_WAIT).collect()
    assert time.perf_counter() - began >= 39 / 40
    with pytest.raises(ValueError):
        enrich.batch_infer(df, "prompt", attribute_echo, calls_per_second=1.0)


def test_every_attempt_is_paced():
    def down(_):
        raise OSError("down")

    began = time.perf_counter()
    enrich.call_with_retry(down, "p", retries=9, wait=0.0, jitter=0.0, pace=enrich.Pace(50.0))
    assert time.perf_counter() - began >= 9 / 50


def test_equal_prompts_are_dealt_out_evenly(spark):
    df = spark.range(400).select("id", F.lit("same").alias("prompt"))
    out = enrich.batch_infer(df, "prompt", attribute_echo, partitions=4, **NO_WAIT).withColumn("task", F.spark_partition_id())
    assert all(95 <= r["count"] <= 105 for r in out.groupBy("task").count().collect())


def test_a_null_prompt_is_not_sent_and_says_so(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "id int, prompt string")
    for name, out in (
        ("all", enrich.batch_infer(df, "prompt", logged(str(tmp_path)), **NO_WAIT)),
        ("once", enrich.infer_distinct(df, "prompt", logged(str(tmp_path)), **NO_WAIT)),
    ):
        got = {r.id: (r.generated_text, r.attempts, r.error) for r in out.collect()}
        assert got == {1: ("a", 1, None), 2: (None, 0, "no prompt"), 3: ("a", 1, None)}, name


def test_a_slow_call_does_not_hold_up_the_next_batch(spark):
    """20 batches of one row with one slow call each: two batches are in flight."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        df = spark.range(20).coalesce(1).select(F.col("id").cast("string").alias("prompt"))
        began = time.perf_counter()
        assert len(enrich.batch_infer(df, "prompt", slow_echo, **NO_WAIT).collect()) == 20
        assert time.perf_counter() - began < 0.9 * 20 * 0.2
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def slow_echo():
    return lambda prompt: time.sleep(0.2) or prompt


def test_inputs_are_asked_once_with_the_options_of_their_category(spark, tmp_path):
    rows_ = spark.createDataFrame([(i, "c1" if i % 3 else "c2", f"t{i % 2}") for i in range(12)], "id int, cat string, title string")
    options = spark.createDataFrame([("c1", "x"), ("c1", "y")], "cat string, o string")
    out = enrich.infer_inputs(rows_, ["cat", "title"], "{options}|{title}", logged(str(tmp_path)), options, ["cat"], "o", partitions=2, **NO_WAIT)
    got = {(r.cat, r.title): r.generated_text for r in out.collect()}
    assert got == {("c1", t): f"x\ny|{t}"[::-1] for t in ("t0", "t1")} | {("c2", t): f"|{t}"[::-1] for t in ("t0", "t1")}
    assert out.count() == 12 and len(os.listdir(tmp_path)) == 4


def test_tagger_stub():
    call = attribute_tagger()
    assert call("<att>red\nring\nrod</att>\n<inp>red ring</inp>") == "<res>red, ring</res>"
    assert call("<att></att>\n<inp>red ring</inp>") == "<res>NA</res>"


def test_two_stage_classification_restricts_leaves_to_the_root(spark):
    nodes = spark.createDataFrame(
        [("[W, A]", "a", False), ("[W, A, x]", "ax", True), ("[W, B]", "b", False), ("[W, B, y]", "by", True), ("[W, B, z]", "bz", True)],
        "path string, node_key string, is_leaf boolean",
    )
    items = spark.createDataFrame(
        [(1, "take A", "<p>one</p>"), (2, "take B", None), (3, "none", "x"), (4, "take A", "<p>one</p>")],
        "item int, title string, description string",
    )
    got = {r["item"]: r for r in classify_root_then_leaf(items, nodes, by_name, root_prefix="W, ", **NO_WAIT).collect()}
    assert (got[1].root_category, got[1].category, got[1].node_key) == ("A", "A, x", "ax")
    assert (got[2].category, got[2].node_key) == ("B, z", "bz")
    assert got[3].category is None and got[3].node_key is None
    assert got[4].node_key == "ax" and len(got) == 4


def by_name():
    import re

    def call(prompt):
        options = re.findall("<item>(.*?)</item>", prompt)
        wanted = re.search("<title>take (.)</title>", prompt)
        fits = [o for o in options if wanted and o.startswith(wanted.group(1))]
        assert "<p>" not in prompt
        return f"<category><item>{fits[-1] if fits else 'NONE OF THE ABOVE'}</item></category>"

    return call


PACED = '''
import sys, time
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from shelfline.operators import enrich
from shelfline.session import build_session

spark = build_session("paced", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {shared!r}}})
assert enrich.task_slots(spark) == 2
df = spark.range(60).select(F.col("id").cast("string").alias("prompt"))

def clock():
    return lambda prompt: str(time.time())

rows = enrich.batch_infer(df, "prompt", clock, partitions=20, calls_per_second=20.0, wait=0.0, jitter=0.0).collect()
print("STARTS", *sorted(float(r.generated_text) for r in rows))
'''


def test_a_rate_holds_for_the_job_with_more_partitions_than_slots(tmp_path):
    import subprocess

    code = PACED.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), shared=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120).stdout
    starts = [float(x) for x in next(line for line in out.splitlines() if line.startswith("STARTS")).split()[1:]]
    assert len(starts) == 60
    # never above the rate, over any second; and not far below it: a twentieth each would take 60 s
    assert all(sum(a <= x < a + 1 for x in starts) <= 20 + 3 for a in starts)
    assert starts[-1] - starts[0] < 2 * 60 / 20 + 4


def test_a_slow_call_leaves_no_thread_idle(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        df = spark.range(40).coalesce(1).select(F.col("id").cast("string").alias("prompt"))

        def slow_first():
            def call(prompt):
                time.sleep(1.5 if prompt == "0" else 0.05)
                return str(time.time())

            return call

        rows = {int(r.prompt): float(r.generated_text) for r in enrich.batch_infer(df, "prompt", slow_first, max_workers=4, **NO_WAIT).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # all others are answered while the first one, alone in its batch with another, still runs
    assert len(rows) == 40 and max(v for k, v in rows.items() if k) < rows[0]


def test_python_holds_small_pieces_of_a_batch():
    import pyarrow as pa

    short = pa.RecordBatch.from_arrays([pa.array([f"p{i}" for i in range(1201)])], ["prompt"])
    long = pa.RecordBatch.from_arrays([pa.array(["x" * (1 << 18)] * 11 + ["y" * (1 << 22)])], ["prompt"])
    cut = list(enrich.pieces(iter([short, long])))
    assert [b.num_rows for b in cut[:3]] == [500, 500, 201] and max(b.num_rows for b in cut[3:]) < 4
    assert pa.Table.from_batches(cut).column(0).to_pylist() == short.column(0).to_pylist() + long.column(0).to_pylist()


def test_prompts_need_not_come_back(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, prompt string")
    out = enrich.batch_infer(df, "prompt", lambda: str.upper, keep_prompt=False, partitions=2)
    assert "prompt" not in out.columns
    assert rows(out, "k", "generated_text", "attempts", "error") == [(1, "A", 1, None), (2, None, 0, "no prompt"), (3, "C", 1, None)]
