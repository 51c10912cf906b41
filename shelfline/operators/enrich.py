"""Bulk enrichment of a table through a text model.

The model sits behind a client factory: a picklable function without arguments
that returns a callable (prompt → text). One client and one thread pool live
per task; the number of partitions times the pool size caps the calls in
flight. A failed call becomes a status, never a failed job. Calls are made at
least once: a lost task calls again for its own rows, so replies are written
down before anything downstream reads them twice.
"""

from __future__ import annotations

import random
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.text import SENTINELS, fingerprint, render_template, tag_text
from shelfline.operators.joins import with_group_options
from shelfline.plans.ordered import cut_lineage

ClientFactory = Callable[[], Callable[[str], str]]


def build_prompts(
    df: DataFrame, template: str, options: DataFrame | None = None, keys: Sequence[str] = (), option: str = "",
    out: str = "prompt", **columns: str | Column,
) -> DataFrame:
    """Fill the template per row; `{options}` holds the distinct options of the row's category."""
    if options is not None:
        df = with_group_options(df, options, keys, option)
        columns = {"options": "options", **columns}
    prompted = df.withColumn(out, render_template(template, **columns))
    return prompted.drop("options") if options is not None else prompted


class Pace:
    """At most `rate` starts per second within one task, over all its threads.

    The first start waits as well, so tasks that follow each other in a slot keep the gap between them.
    """

    def __init__(self, rate: float | None):
        self.gap = 1.0 / rate if rate else 0.0
        self.next = time.monotonic() + self.gap
        self.lock = threading.Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            at = max(self.next, now)
            self.next = at + self.gap
        time.sleep(at - now)


def task_slots(spark: SparkSession) -> int | None:
    """How many tasks the application can run at once at most; None where its settings do not bound that."""
    conf = spark.sparkContext.getConf()
    cpus = int(conf.get("spark.task.cpus", "1"))
    local = re.fullmatch(r"local\[(\d+)(?:,\d+)?\]", spark.sparkContext.master)
    if local:
        return max(int(local[1]) // cpus, 1)
    cores = conf.get("spark.executor.cores", None)
    dynamic = conf.get("spark.dynamicAllocation.enabled", "false") == "true"
    executors = conf.get("spark.dynamicAllocation.maxExecutors" if dynamic else "spark.executor.instances", None)
    if cores and executors:
        return max(int(cores) // cpus, 1) * int(executors)
    most = conf.get("spark.cores.max", None)
    return max(int(most) // cpus, 1) if most else None


# Rows held per thread while an early call of theirs has not answered.
HELD = 200


# Rows, and bytes unless one row has more, that are in the hands of Python at a time, whatever the size of Spark's batches.
PIECE_ROWS, PIECE_BYTES = 500, 1 << 20


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(min(PIECE_ROWS, batch.num_rows * PIECE_BYTES // max(batch.nbytes, 1)), 1)
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# The status of a row without a prompt, which is not sent.
NO_PROMPT = "no prompt"


def call_with_retry(
    client: Callable[[str], str], prompt: str | None, retries: int, wait: float, jitter: float, pace: Pace | None = None
) -> tuple:
    """(text, seconds, attempts, error); every attempt is paced, and it sleeps only between attempts."""
    if prompt is None:
        return None, 0.0, 0, NO_PROMPT
    began, error = time.perf_counter(), None
    for attempt in range(1, retries + 2):
        if pace:
            pace.wait()
        try:
            return client(prompt), time.perf_counter() - began, attempt, None
        except Exception as failure:  # noqa: BLE001 - every failure of a remote call ends up in the status
            error = f"{type(failure).__name__}: {failure}"
            if attempt <= retries:
                time.sleep(random.uniform(wait * (1 - jitter), wait * (1 + jitter)))
    return None, time.perf_counter() - began, retries + 1, error


def batch_infer(
    df: DataFrame,
    prompt: str,
    client_factory: ClientFactory,
    max_workers: int = 10,
    retries: int = 5,
    wait: float = 10.0,
    jitter: float = 0.5,
    partitions: int | None = None,
    calls_per_second: float | None = None,
    spread: bool = True,
    slots: int | None = None,
    keep_prompt: bool = True,
) -> DataFrame:
    """Add generated_text, time_taken_sec, attempts and error to every row.

    `partitions` caps the concurrency and deals the rows out evenly, equal prompts too; `spread=False` says
    that the rows lie in so many partitions already. `calls_per_second` holds for the job: it is shared by the tasks that
    can run at once, which are the partitions or, where fewer, the task `slots` of the application (found
    from its settings when not given). Rows are read on while threads are free, so neither a slow call nor small
    batches leave them idle; up to `HELD` answered rows per thread wait for a slow call before them. A null prompt is not sent.
    Without `keep_prompt` the prompts are not sent back. Python holds small pieces of a batch, so its memory does not follow the input.
    """
    if calls_per_second is not None and partitions is None:
        raise ValueError("a call rate needs a fixed number of partitions")
    dealt = df.repartition(partitions) if partitions and spread else df
    at_once = min(partitions, slots or task_slots(df.sparkSession) or partitions) if calls_per_second else None
    rate = calls_per_second / at_once if calls_per_second else None

    kept = [c for c in dealt.columns if keep_prompt or c != prompt]
    replied = pa.schema([("generated_text", pa.string()), ("time_taken_sec", pa.float64()), ("attempts", pa.int32()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        call = partial(call_with_retry, client, retries=retries, wait=wait, jitter=jitter, pace=Pace(rate))

        def answered(batch: pa.RecordBatch, calls: list) -> pa.RecordBatch:
            values = zip(*[c.result() for c in calls])
            replies = [pa.array(v, f.type) for v, f in zip(values, replied)]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *replies], [*kept, *replied.names])

        changed, unanswered = threading.Condition(), [0]

        def submitted(pool: ThreadPoolExecutor, batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list, list[int]]:
            left = [batch.num_rows]

            def over(_):
                with changed:
                    left[0] -= 1
                    unanswered[0] -= 1
                    changed.notify()

            with changed:
                unanswered[0] += batch.num_rows
            calls = [pool.submit(call, text.as_py()) for text in batch.column(prompt)]
            for c in calls:
                c.add_done_callback(over)
            return batch, calls, left

        with ThreadPoolExecutor(max_workers=max_workers) as pool:
            ahead: deque = deque()
            for batch in pieces(batches):
                ahead.append(submitted(pool, batch))
                while ahead:
                    left = ahead[0][2]
                    with changed:
                        changed.wait_for(lambda: left[0] == 0 or unanswered[0] < max_workers)
                    held = sum(len(calls) for _, calls, _ in ahead)
                    if left[0] and (len(ahead) == 1 or held <= HELD * max_workers):
                        break  # a thread is free: read on
                    yield answered(*ahead.popleft()[:2])
            while ahead:
                yield answered(*ahead.popleft()[:2])

    added = "generated_text string, time_taken_sec double, attempts int, error string"
    fields = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in kept)
    return dealt.mapInArrow(run, f"{fields}, {added}")


def infer_distinct(df: DataFrame, prompt: str, client_factory: ClientFactory, **options) -> DataFrame:
    """Send every distinct prompt once and join the replies back to all rows.

    Repeats are removed before the call, so a prompt shared by a third of the
    table costs one call. Rows and replies meet on the SHA-256 of the prompt;
    the prompt text itself is not shuffled again. The replies are written down
    first, so nothing downstream calls the model a second time. A row without a prompt says so in its status.
    """
    keyed = df.withColumn("_digest", F.sha2(prompt, 256))
    distinct = keyed.where(F.col(prompt).isNotNull()).groupBy("_digest").agg(F.any_value(prompt).alias("_prompt"))
    replies = cut_lineage(batch_infer(distinct, "_prompt", client_factory, keep_prompt=False, **options))
    unsent = F.col(prompt).isNull()
    return keyed.join(replies, "_digest", "left").drop("_digest").withColumns({
        "attempts": F.when(unsent, 0).otherwise(F.col("attempts")),
        "error": F.when(unsent, NO_PROMPT).otherwise(F.col("error")),
    })


def infer_inputs(
    df: DataFrame, inputs: Sequence[str], template: str, client_factory: ClientFactory, options: DataFrame | None = None,
    keys: Sequence[str] = (), option: str = "", partitions: int | None = None, columns: Mapping[str, str | Column] | None = None, **call,
) -> DataFrame:
    """Ask once per distinct combination of the input columns and join the replies back to all rows.

    The prompt is a template over the inputs and, with `options`, over the option list of the row's
    category. Only the inputs are made distinct and dealt out; the lists meet them afterwards and the
    prompt is rendered inside the calling stage, so no option list and no prompt is shuffled per row.
    """
    keyed = df.withColumn("_digest", fingerprint(inputs))
    asked = keyed.select("_digest", *inputs).dropDuplicates(["_digest"])
    dealt = asked.repartition(partitions) if partitions else asked
    fields = dict(columns or {name: name for name in inputs})
    if options is not None:
        dealt = with_group_options(dealt, options, keys, option)
        fields = {"options": "options", **fields}
    prompted = dealt.select("_digest", render_template(template, **fields).alias("_prompt"))
    called = batch_infer(prompted, "_prompt", client_factory, partitions=partitions, spread=False, keep_prompt=False, **call)
    return keyed.join(cut_lineage(called), "_digest", "left").drop("_digest")


def parse_reply(reply: str, tags: Mapping[str, str], sentinels: Sequence[str] = SENTINELS) -> dict[str, Column]:
    """One column per tag; an empty text or a no-answer is null."""
    out = {}
    for name, tag in tags.items():
        text = F.trim(tag_text(F.col(reply), tag))
        out[name] = F.when((text != "") & ~text.isin(*sentinels), text)
    return out


def explode_labels(df: DataFrame, labels: str, out: str, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """A comma list of labels to one row per label, no-answers removed."""
    value = F.trim(F.col(out))
    return (
        df.withColumn(out, F.explode(F.split(labels, ",")))
        .withColumn(out, value)
        .where((F.col(out) != "") & ~F.col(out).isin(*sentinels))
    )


def request_body(
    model: str, prompt: str, max_tokens: int, temperature: float | None = None, top_k: int | None = None,
    top_p: float | None = None, system: str | None = None, stop: Sequence[str] | None = None,
    chat_marker: str = "chat",
) -> Column:
    """Request text per row in the format of its model: a message list for chat models, a
    plain prompt for the others. Every parameter that is given is passed on."""
    given = {"temperature": temperature, "top_k": top_k, "top_p": top_p}
    extra = [F.lit(v).alias(k) for k, v in given.items() if v is not None]
    if stop is not None:
        extra.append(F.array(*[F.lit(s) for s in stop]).alias("stop_sequences"))
    message = F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content"))
    chat = [F.lit(max_tokens).alias("max_tokens"), F.array(message).alias("messages")]
    if system is not None:
        chat.append(F.lit(system).alias("system"))
    plain = [F.col(prompt).alias("prompt"), F.lit(max_tokens).alias("max_tokens_to_sample")]
    return F.when(
        F.contains(F.col(model), F.lit(chat_marker)), F.to_json(F.struct(*chat, *extra))
    ).otherwise(F.to_json(F.struct(*plain, *extra)))
