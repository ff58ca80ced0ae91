"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Runtime settings every plan relies on. Shuffle width and memory stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Batches to Python are bounded by bytes: rows may hold whole texts. What comes back is bounded where it is made (``llm/common.py``), not by
    # maxBytesPerOutputBatch: where a batch above that limit follows a smaller one, Spark 4.1 closes it after the first part, and the task fails.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # A column vector of the parquet reader holds this many whole texts on the heap.
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}

PACKED = "zstd"  # of stored state, and of scratch data in the jobs on it
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BLOCKS: ContextVar[tuple[dict[str, DataFrame | None], ...]] = ContextVar("blocks", default=())  # of this thread: path -> stored frame


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "kinfold", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a folder of this machine; on a cluster the executors could
    not see it, so the setting is required there.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kinfold-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors, and gives the next
    plan column pruning and size statistics. Inside a ``temporary`` block it is removed with the block."""
    path, blocks = scratch(df.sparkSession, label), _BLOCKS.get()
    if not blocks:
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    blocks[-1][path] = None  # named before it is written: a write that fails is removed too
    df.write.option("compression", PACKED).parquet(path)
    blocks[-1][path] = frame = df.sparkSession.read.schema(df.schema).parquet(path)
    return frame


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What ``materialize`` stores inside the block is removed when it ends, and shuffle files when the query that wrote them does.

    A frame that leaves the block must read none of that. The block is given a function for the stored frames it hands on: they are left to the
    block around, or stay where there is none.
    """
    mine, around, before = {}, _BLOCKS.get(), spark.conf.get(_CLEANUP, "false")

    def keep(frame: DataFrame) -> DataFrame:
        path = next(p for p, held in mine.items() if held is frame)
        del mine[path]
        if around:
            around[-1][path] = frame
        return frame

    token = _BLOCKS.set((*around, mine))
    spark.conf.set(_CLEANUP, "true")
    try:
        yield keep
    finally:
        spark.conf.set(_CLEANUP, before)
        _BLOCKS.reset(token)
        for path in mine:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once, for several actions that must see the same rows; the rows are removed afterwards.

    A cached frame is computed anew where an executor is lost, and then may differ: a call can fail the first time and pass the second.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def spread(frame: DataFrame, key: str) -> DataFrame:
    """``frame`` over all cores when it comes from fewer files than there are cores. Meant for plans
    that do much work per row; an input of many files is left as it is, so nothing large is shuffled."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores, key) if 0 < len(frame.inputFiles()) < cores else frame


def unfold(frame: DataFrame, rows: Column | str, key: str, *columns: str | Column) -> DataFrame:
    """``columns`` of ``frame`` beside each struct of the array ``rows``, whose field ``key`` is never null.

    For a plain ``inline`` Spark first filters for arrays that are not empty, and moves that filter below what ``rows`` is made from: there the
    whole expression runs again, parsing included, once for each place that refers to it. An outer one has no such filter.
    """
    return frame.select(*columns, F.inline_outer(rows)).filter(F.col(key).isNotNull())


def in_parallel(spark: SparkSession, *actions) -> None:
    """Run independent Spark actions side by side, so that the last tasks of one overlap with the next.
    The first failure is raised after all have ended."""
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    for job in running:
        job.result()


def read_if_exists(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet at ``path``; an empty frame when the folder does not exist yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
