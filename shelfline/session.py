"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even when that costs one more shuffle behind the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Model calls cost money: never run the same task twice on purpose.
    "spark.speculation": "false",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "shelfline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session, whose executors are this machine, may go without the setting; it gets
    a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="shelfline-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


_scope: ContextVar[tuple[str, str] | None] = ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are dropped at the end, failed or not.

    They are tables of a database of their own whose folder lies in the shared one. Results must
    be written or collected before the scope ends.
    """
    name = f"scratch_{uuid.uuid4().hex}"
    folder = f"{shared_dir(spark).rstrip('/')}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    before = _scope.set((name, folder))
    try:
        yield
    finally:
        _scope.reset(before)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def scratch_table() -> str | None:
    """A fresh table name in the current scope, if there is one."""
    scope = _scope.get()
    return f"{scope[0]}.t_{uuid.uuid4().hex}" if scope else None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for written files; never reused, so nothing is overwritten. Its folder goes with the scope, or with the application."""
    scope = _scope.get()
    if scope:
        return f"{scope[1]}/scratch-{uuid.uuid4().hex}/{name}"
    folder = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    path, store = stored(spark, folder)
    store.mkdirs(path)
    store.deleteOnExit(path)
    return f"{folder}/{name}"


def stored(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# Written rows that no scope drops: (weak reference to the relation that reads them, their folder), by application.
_written: list[tuple[str, object, str]] = []


def tie_to_result(df: DataFrame, path: str) -> DataFrame:
    """Rows read back from `path`: the files go once no frame, plan or cached result reads them any more.

    All frames made from this one share its relation; when the JVM has let go of that, the next call removes the files.
    """
    spark = df.sparkSession
    relation = df._jdf.queryExecution().analyzed().relation().location()
    reference = spark.sparkContext._jvm.java.lang.ref.WeakReference(relation)
    _written.append((spark.sparkContext.applicationId, reference, path.rsplit("/", 1)[0]))
    return df


def sweep(spark: SparkSession) -> int:
    """Remove written rows that nothing can read any more; the number of folders removed."""
    mine, gone = spark.sparkContext.applicationId, 0
    for entry in list(_written):
        if entry[0] != mine:  # went with its application
            _written.remove(entry)
        elif entry[1].get() is None:
            path, store = stored(spark, entry[2])
            store.delete(path, True)
            _written.remove(entry)
            gone += 1
    return gone


@contextlib.contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are removed when each write is done: what was written is read from then on."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
