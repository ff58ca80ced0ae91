"""Dead-letter work: selection, the repeatable sweep, and the bounded re-drive."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.operators.errors import REPROCESSABLE
from kinfold.operators.outcomes import good_rows
from kinfold.schemas import ERROR_COLUMNS, INPUT, struct
from kinfold.session import read_if_exists, stored

DEAD_LETTER = struct(
    "dataSource string, recordId string, payload string, category string, errorCode string, "
    "message string, attempts int, failedAt timestamp, source string"
)
_FINISHED = struct("file string, run bigint")
_STATE = struct("run bigint, generation int, due bigint, failing bigint")


def reprocessable(dead_letter: DataFrame) -> DataFrame:
    """Rows worth another try, in input shape."""
    return dead_letter.filter(F.col("category").isin(REPROCESSABLE)).select(*INPUT.names)


def write_dead_letter(errors: DataFrame, path: str, mode: str = "append") -> None:
    shaped = errors.select(*[
        (F.col(f.name) if f.name in errors.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in DEAD_LETTER
    ])
    shaped.write.mode(mode).parquet(path)


def sweep(spark: SparkSession, dead_letter: str, re_feed: str, ledger: str, max_age: str = "7d") -> int:
    """Re-emit the reprocessable rows of every dead-letter file not swept before; returns their number.

    A file stream that ends when it has read what was there at its start. Its checkpoint ``ledger`` has Spark's own log of the files read, so swept files are
    not opened again, and files that arrive during the sweep wait for the next one. Each sweep writes its own `sweep=N` folder as a whole; one that broke off
    is repeated with the same files and replaces its output. Folders below ``dead_letter`` are read too. A file that appears with a time more than ``max_age`` before that of
    the newest file swept is taken for an old one and left: writers give new files the present time.
    """
    emitted = []

    def on_batch(rows: DataFrame, number: int) -> None:
        target = f"{re_feed}/sweep={number}"
        reprocessable(rows).write.mode("overwrite").parquet(target)
        emitted.append(spark.read.schema(INPUT).parquet(target).count())

    source = spark.readStream.schema(DEAD_LETTER).option("recursiveFileLookup", "true").option("maxFileAge", max_age)
    try:
        letters = source.parquet(dead_letter)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    writer = letters.writeStream.foreachBatch(on_batch).option("checkpointLocation", ledger)
    writer.trigger(availableNow=True).start().awaitTermination()
    return sum(emitted)


@dataclass(frozen=True)
class Redrive:
    rounds: int
    re_fed: int
    quarantined: int
    drained: bool


def converge(
    spark: SparkSession,
    dead_letter: str,
    work: str,
    quarantine: str,
    redrive: Callable[[DataFrame], DataFrame],
    max_rounds: int = 3,
    on_success: Callable[[DataFrame], None] | None = None,
) -> Redrive:
    """Drive the reprocessable letters of files no earlier call has finished, until none is left, a generation makes no progress,
    or ``max_rounds`` generations were driven; then all that the last generation failed goes to ``quarantine``.

    Nothing is recorded before its outcomes are stored: a generation is written to the state table after its failures, and the letters' files to the ledger after the last
    generation. A call that follows a crash takes up the first generation without a state row, so ``on_success`` sees each success at least once.
    """
    if max_rounds <= 0:
        raise ValueError("max_rounds must be positive")
    ledger, state = f"{work}/finished", f"{work}/state"
    run = read_if_exists(spark, ledger, _FINISHED).agg(F.coalesce(F.max("run") + 1, F.lit(0))).first()[0]
    base = f"{work}/run={run}"
    # One row per generation of this call: at most max_rounds.
    stored = read_if_exists(spark, state, _STATE).filter(F.col("run") == run).collect()
    counts = {row["generation"]: (row["due"], row["failing"]) for row in stored}
    if 0 not in counts:
        if read_if_exists(spark, dead_letter, DEAD_LETTER).isEmpty():
            return Redrive(1, 0, 0, True)
        named = spark.read.schema(DEAD_LETTER).parquet(dead_letter).withColumn("file", F.col("_metadata.file_path"))
        finished = read_if_exists(spark, ledger, _FINISHED).select("file").distinct()
        fresh = named.filter(F.col("category").isin(REPROCESSABLE)).join(finished, "file", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{base}/due-0")
        if spark.read.schema(DEAD_LETTER).parquet(f"{base}/due-0").isEmpty():
            return Redrive(1, 0, 0, True)
    for generation in range(max_rounds):
        if generation not in counts:
            counts[generation] = _drive(spark, base, generation, redrive, on_success)
            spark.createDataFrame([(run, generation, *counts[generation])], _STATE).write.mode("append").parquet(state)
        due, failing = counts[generation]
        if failing == 0 or failing >= due:
            break
    last = max(counts)
    held = 0
    if counts[last][1]:
        rest = spark.read.schema(DEAD_LETTER).parquet(f"{base}/due-{last + 1}")
        rest.write.mode("overwrite").parquet(f"{quarantine}/run={run}")
        held = rest.count()
    files = spark.read.parquet(f"{base}/due-0").select("file").distinct()
    files.withColumn("run", F.lit(run).cast("bigint")).write.mode("append").parquet(ledger)
    return Redrive(last + 1, sum(due for due, _ in counts.values()), held, held == 0)


def _drive(spark: SparkSession, base: str, generation: int, redrive, on_success) -> tuple[int, int]:
    """Drive one generation and store what fails as the next; returns how many were due and how many are due again."""
    due = reprocessable(spark.read.schema(DEAD_LETTER).parquet(f"{base}/due-{generation}"))
    with stored(redrive(due), "redriven") as outcomes:
        failed = outcomes.filter(F.col("kind") == "ERROR").select(*ERROR_COLUMNS)
        stamped = failed.withColumns({"failedAt": F.current_timestamp(), "source": F.lit(f"redrive-{generation}")})
        write_dead_letter(stamped, f"{base}/due-{generation + 1}", "overwrite")
        if on_success:
            on_success(good_rows(outcomes))
    again = reprocessable(spark.read.schema(DEAD_LETTER).parquet(f"{base}/due-{generation + 1}"))
    return due.count(), again.count()
