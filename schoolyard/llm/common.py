"""Helpers that the corpus operators share: inputs, checkpoints, free column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Words are runs of characters other than the six ASCII white-space characters.
SPACES = " \t\n\x0b\x0c\r"
#: Tasks of a core that write what `gathered` gathers.
TASKS_OF_CORE = 2
#: Whether Spark deletes the shuffle files of a query when it has ended.
_FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`, which all executors share.

    Only where none is set (tests, a laptop) a temporary folder is taken, which local mode
    shares with itself.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="schoolyard-checkpoints-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder; a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def gathered(df: DataFrame) -> DataFrame:
    """`durable`, for what a shuffle has dealt out: written by a few tasks of each core at most.

    Each task writes a file and its checksum, and for either Hadoop's local file system starts a
    `chmod`; without adaptive coalescing that is two for each shuffle partition, round after round.
    """
    return durable(df.coalesce(TASKS_OF_CORE * df.sparkSession.sparkContext.defaultParallelism))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder as Parquet and read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Deletes what `stored` has written for frames that are not read again."""
    for df in frames:
        jvm = df.sparkSession._jvm
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when the query that wrote them has ended, not when the driver has
    collected its garbage: for steps whose results are `stored`."""
    before = spark.conf.get(_FREES_SHUFFLES, "false")
    spark.conf.set(_FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREES_SHUFFLES, before)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, lengthened until no column of the frame has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
