"""A master table that takes only unseen rows from files as they land.

The master lies in buckets of the key's hash: `bucket=b/level=l/batch_id=n`. A batch is compared with the buckets of its
own keys only, and its fresh rows become one folder of level 0 in each of them. When a bucket has `FAN` folders of a
level, they are written again as one folder of the next level, named after the latest batch in it; a row is
rewritten once per level, and a bucket has few folders however many batches there were.

A folder counts unless a higher level reaches as far: so a merge takes effect with the one rename that puts its folder in
place, and what it replaced is removed at the bucket's next merge, when no reader is in it any more.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.plans.ordered import cut_lineage
from shelfline.session import stored

BUCKET, LEVEL, BATCH = "bucket", "level", "batch_id"
BUCKETS = 64
FAN = 8
PLACE = re.compile(rf"{BUCKET}=(\d+)/{LEVEL}=(\d+)/{BATCH}=(\d+)$")


def in_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is (semi) or is not (anti) in the other table; nulls are equal."""
    named = other.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(named, condition, how)


def _folders(spark: SparkSession, master: str, buckets: Iterable[int] | None = None) -> list[tuple[int, int, int]]:
    """(bucket, level, batch) of every folder of some buckets; only these buckets are listed."""
    names = "*" if buckets is None else "{" + ",".join(str(b) for b in sorted(buckets)) + "}"
    path, store = stored(spark, f"{master.rstrip('/')}/{BUCKET}={names}/{LEVEL}=*/{BATCH}=*")
    return [tuple(map(int, PLACE.search(str(f.getPath())).groups())) for f in store.globStatus(path) or []]


def live_folders(spark: SparkSession, master: str, buckets: Iterable[int] | None = None, before: int | None = None) -> list[tuple[int, int, int]]:
    """The folders that count, of batches before `before`: those that no higher level of their bucket reaches."""
    found = [f for f in _folders(spark, master, buckets) if before is None or f[2] < before]
    reach: dict[int, list[tuple[int, int]]] = {}
    for bucket, level, batch in found:
        reach.setdefault(bucket, []).append((level, batch))
    return sorted(
        f for f in found if not any(level > f[1] and batch >= f[2] for level, batch in reach[f[0]]))


def read_folders(spark: SparkSession, master: str, folders: Sequence[tuple[int, int, int]], schema: T.StructType) -> DataFrame:
    paths = [f"{master.rstrip('/')}/{BUCKET}={b}/{LEVEL}={level}/{BATCH}={n}" for b, level, n in folders]
    placed = T.StructType([*schema.fields, *[T.StructField(c, T.LongType()) for c in (BUCKET, LEVEL, BATCH)]])
    if not paths:
        return spark.createDataFrame([], placed)
    return spark.read.option("basePath", master).schema(placed).parquet(*paths)


def _write(rows: DataFrame, master: str) -> None:
    """Into the folders named by the rows, each replaced as a whole; a hot bucket is written by several tasks."""
    rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, LEVEL, BATCH).parquet(master)


def merge_batch(
    batch: DataFrame, batch_id: int, master: str, keys: Sequence[str], schema: T.StructType, buckets: int = BUCKETS, fan: int = FAN
) -> None:
    """Write the rows of one micro-batch whose key is not in the master yet.

    The master itself is the memory of what was seen, so no stream state grows with it. A batch that is
    replayed after a failure compares with the earlier batches only and writes the same rows to the same
    folders again. `buckets` must stay the same for a master.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias(BUCKET)
    # written down first, so its buckets and its size are known
    fresh = cut_lineage(batch.select(*schema.names).dropDuplicates(list(keys)).select("*", bucket))
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most `buckets`
    if not touched:
        return
    merge_levels(spark, master, schema, touched, batch_id, fan)
    earlier = read_folders(spark, master, live_folders(spark, master, touched, before=batch_id), schema).select(*keys)
    # a null key part meets a null one, else a redelivered row would be stored twice; a small batch
    # is sent to the buckets' files, which are then filtered in place
    seen = in_keys(earlier, fresh, keys).distinct()
    _write(in_keys(fresh, seen, keys, "left_anti").withColumns({LEVEL: F.lit(0), BATCH: F.lit(batch_id)}), master)


def merge_levels(spark: SparkSession, master: str, schema: T.StructType, buckets: Iterable[int], before: int, fan: int = FAN) -> None:
    """Rewrite levels that have `fan` folders or more, of batches before `before`, as one folder of the next level.

    A batch can only be replayed before the next one begins, so what is merged never changes again.
    """
    while True:
        live = live_folders(spark, master, buckets, before)
        full: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for folder in live:
            full.setdefault(folder[:2], []).append(folder)
        full = {place: folders for place, folders in full.items() if len(folders) >= fan}
        if not full:
            return
        _sweep(spark, master, {b for b, _ in full}, live, before)
        # one level at a time: the lowest holds the latest batches
        lowest = min(level for _, level in full)
        merged = [f for (_, level), folders in full.items() if level == lowest for f in folders]
        rows = read_folders(spark, master, merged, schema)
        ends = spark.createDataFrame([(b, max(f[2] for f in full[b, lowest])) for b, level in full if level == lowest], f"{BUCKET} long, _last long")
        named = rows.drop(LEVEL, BATCH).join(F.broadcast(ends), BUCKET)  # at most one row per bucket
        _write(named.select(*schema.names, BUCKET, F.lit(lowest + 1).alias(LEVEL), F.col("_last").alias(BATCH)), master)


def _sweep(spark: SparkSession, master: str, buckets: set[int], live: Sequence[tuple[int, int, int]], before: int) -> None:
    """Remove what earlier merges of these buckets replaced."""
    keep = set(live)
    for folder in _folders(spark, master, buckets):
        if folder[2] < before and folder not in keep:
            path, store = stored(spark, f"{master.rstrip('/')}/{BUCKET}={folder[0]}/{LEVEL}={folder[1]}/{BATCH}={folder[2]}")
            store.delete(path, True)


def grow_master(
    spark: SparkSession, landing: str, schema: T.StructType, master: str, progress: str, keys: Sequence[str],
    files_per_batch: int | None = None, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start the query over all files landed so far; it ends when they are merged."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, master, keys, schema, buckets)

    return (
        reader.parquet(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def read_master(spark: SparkSession, master: str, schema: T.StructType | None = None) -> DataFrame:
    folders = live_folders(spark, master)
    if schema is None:
        if not folders:
            raise ValueError(f"{master} has no rows yet: give the schema")
        b, level, n = folders[0]
        schema = spark.read.parquet(f"{master.rstrip('/')}/{BUCKET}={b}/{LEVEL}={level}/{BATCH}={n}").schema
    return read_folders(spark, master, folders, schema).drop(BUCKET, LEVEL, BATCH)
