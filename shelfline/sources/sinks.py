"""Writers. Each is a distributed write; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.columns import all_strings
from shelfline.plans.ordered import cut_lineage
from shelfline.session import scratch_path


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(
        header="true", sep=sep, quote='"', escape='"', nullValue="\\N"
    ).csv(path)


def write_training_rows(df: DataFrame, path: str, label: str, drop: Sequence[str] = ()) -> list[str]:
    """No header, label first, complement labels dropped; returns the column order."""
    columns = [label, *[c for c in df.columns if c != label and c not in set(drop)]]
    df.select(*columns).write.mode("overwrite").csv(path)
    return columns


def write_as_strings(df: DataFrame, path: str) -> None:
    write_parquet(all_strings(df), path)


def replace_in_place(df: DataFrame, path: str) -> str:
    """Replace the table a frame was read from; returns where the new rows are staged.

    They are written completely to the shared scratch folder first, so nothing is read from the path while
    it is overwritten, and a write that breaks off can be repeated from there.
    """
    staged = scratch_path(df.sparkSession, "staged")
    write_parquet(df, staged)
    write_parquet(df.sparkSession.read.schema(df.schema).parquet(staged), path)
    return staged


def write_by_channel(df: DataFrame, path: str, channel: str) -> None:
    """One sub-folder per channel; only the channels present in the frame are replaced.

    The rebalance hint gathers each channel into files of the advisory size and
    splits a channel that is larger, so a hot one is written by many tasks.
    """
    (
        df.hint("rebalance", channel)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(channel)
        .parquet(path)
    )


def write_whole_series(df: DataFrame, path: str, item: str, order: Sequence[Column], shards: int) -> None:
    """Every series complete and ordered in one file; a series has one row per period."""
    df.repartition(shards, item).sortWithinPartitions(item, *order).write.mode("overwrite").parquet(path)


def write_by_group(
    df: DataFrame, path: str, group: str, work: Callable[[DataFrame], DataFrame] | None = None, rounds: int = 4
) -> None:
    """Work on groups in rounds and write each round's rows; a restart skips the groups recorded as done.

    `work` is the costly step, say a model call. The input is filtered by round and by the recorded groups
    before it, so it sees every row once, however many rounds there are, and none of a finished group. A
    round that broke off is worked on again whole (its folders are replaced). A group is done when its
    round is written, also if `work` left no row of it. Rounds are hash ranges of the group key. Null groups
    are a group. The input itself is read once.
    """
    spark = df.sparkSession
    done_path = f"{path.rstrip('/')}-done"
    recorded = T.StructType([T.StructField(group, df.schema[group].dataType)])
    # an empty record makes the folder readable from the start
    spark.createDataFrame([], recorded).write.mode("append").parquet(done_path)
    rows = cut_lineage(df) if rounds > 1 else df
    for i in range(rounds):
        done = cut_lineage(spark.read.schema(recorded).parquet(done_path).distinct())
        mine = rows.where(F.pmod(F.xxhash64(group), F.lit(rounds)) == i)
        part = mine.join(done.withColumnRenamed(group, "_done"), F.col(group).eqNullSafe(F.col("_done")), "left_anti")
        groups = cut_lineage(part.select(group).distinct())
        made = work(part) if work else part
        made.hint("rebalance", group).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(group).parquet(path)
        groups.write.mode("append").parquet(done_path)


# Between the documents of one text file.
RECORD_MARK = "\u001e"


def write_documents(df: DataFrame, path: str, kind: str = "text", per_file: int = 10_000, bytes_per_file: int = 128 << 20) -> None:
    """Whole documents in a bounded number of files: about `per_file` documents and `bytes_per_file` at most in each.

    `text`: the only text column, every document followed by `RECORD_MARK`; `json`: an array of the rows as
    documents. One pass counts rows and bytes; rows are then dealt out in turn, so equal documents part, and every
    task writes its file row by row. No row ever holds more than one document.
    """
    name = df.columns[0]
    body = F.col(f"`{name}`").cast("string") if kind == "text" else F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    # a null text is an empty document
    rows = df.select(F.coalesce(body, F.lit("")).alias("value"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("value").cast("bigint")), F.lit(0))).first()
    dealt = rows.repartition(max(1, -(-n // per_file), -(-size // bytes_per_file)))
    if kind == "text":
        dealt.write.mode("overwrite").option("lineSep", RECORD_MARK).text(path)
    else:
        dealt.mapInArrow(_as_array, "value string").write.mode("overwrite").text(path)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one JSON array over all documents of a task."""
    before = "["
    for batch in batches:
        if batch.num_rows:
            marks = pa.array([before] + [","] * (batch.num_rows - 1))
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0).cast(pa.string()), "")], ["value"])
            before = ","
    yield pa.RecordBatch.from_pydict({"value": ["[]" if before == "[" else "]"]})
