"""Tables that cut lineage. They lie in the folder that spark.checkpoint.dir names, which all executors share, so a
lost executor loses none of them; they go when the driver's JVM ends, or earlier by drop()."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no folder and all of it runs on this machine, as in tests.
OWN_FOLDER = "file:///tmp/checkpoints/storyloom"


_scope: contextvars.ContextVar[list | None] = contextvars.ContextVar("scratch scope", default=None)


@contextlib.contextmanager
def scope(spark: SparkSession):
    """Tables saved within go at its end, but for those given to the function that it yields; these pass to the scope around
    it. What is returned from a scope must read kept tables only."""
    outer, mine, kept = _scope.get(), [], []
    token = _scope.set(mine)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.scratch_path)
        return df

    try:
        yield keep
    finally:
        _scope.reset(token)
        drop(spark, *(p for p in mine if p not in kept))
        if outer is not None:
            outer += [p for p in mine if p in kept]


def root(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = OWN_FOLDER
    return folder.rstrip("/") + f"/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Lets Arrow batches hold a few MB rather than 64, unless the session says otherwise: a batch is in memory a few times
    over, in the JVM and in each Python worker beside it. Holds for the session."""
    key, usual = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key) == usual:
        spark.conf.set(key, size)


def drop(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p, fs = _hadoop(spark, path)
        fs.delete(p, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that nothing refers to any more; else they stay until the driver
    happens to collect its garbage. To be called after a large step whose result is written."""
    gc.collect()
    spark._jvm.System.gc()


def save(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The frame, written and read again."""
    path = new_path(spark, name)
    df.write.parquet(path)
    if (mine := _scope.get()) is not None:
        mine.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())
