"""Incremental runs: files that arrive are processed once and their results appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexiloom.sources.committed import CommittedTable


def file_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Arriving files as a stream; ``files_per_trigger`` bounds what one micro-batch takes."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def append_stream(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Stateless job with a checkpointed parquet sink: every input file counts once, also after a restart."""
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output)
    )


def chunk_stream(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand every micro-batch, with its number, to ``handle``: the bounded chunks of a large input."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_PARTIAL = "num_scores long, total double, min_score double, max_score double, rows long"
STREAM = "stream"  # name of the run that micro-batches commit under
EPOCHS = 10  # micro-batches between compactions


def _folded(partials: DataFrame) -> DataFrame:
    """Partial statistics of a file merge into one row; it does not matter how the rows were split."""
    return partials.groupBy("file").agg(
        F.sum("num_scores").alias("num_scores"),
        F.sum("total").alias("total"),
        F.min("min_score").alias("min_score"),
        F.max("max_score").alias("max_score"),
        F.sum("rows").alias("rows"),
    )


def score_stats_stream(
    stream: DataFrame,
    output: str,
    checkpoint: str,
    file: str = "source_file",
    score: str = "comet_score",
    epochs: int = EPOCHS,
) -> StreamingQuery:
    """Running quality statistics per file, without state in the stream.

    Each micro-batch commits the partial statistics of its own rows; one that is repeated after a failure finds its
    commit and adds nothing.  Every ``epochs`` micro-batches the partials fold into a base table by one commit, so that the
    table holds a bounded number of folders however long the stream runs.  ``latest_stats`` merges what is there.
    """
    table = CommittedTable(stream.sparkSession, output)
    done: dict[str, int] = {}  # last commit and number of folders, read once for a run: nobody else commits to it

    def write(rows: DataFrame, epoch: int) -> None:
        if not done:
            done.update(last=table.last(STREAM), folders=len(table.folders()))
        if epoch <= done["last"]:
            return
        partial = rows.groupBy(F.col(file).alias("file")).agg(
            F.count(score).alias("num_scores"),
            F.sum(score).alias("total"),
            F.min(score).alias("min_score"),
            F.max(score).alias("max_score"),
            F.count("*").alias("rows"),
        )
        table.append(partial, STREAM, epoch)
        done.update(last=epoch, folders=done["folders"] + 1)
        if done["folders"] > epochs:
            table.compact(_folded, STREAM)
            done["folders"] = 1

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_stats(spark: SparkSession, output: str) -> DataFrame:
    """Statistics per file over everything committed; files without a score are left out."""
    partials = CommittedTable(spark, output).read()
    if partials is None:
        partials = spark.createDataFrame([], f"file string, {_PARTIAL}")
    merged = _folded(partials).filter(F.col("num_scores") > 0)
    return merged.select(
        "file", "num_scores", (F.col("total") / F.col("num_scores")).alias("average_score"), "min_score", "max_score"
    )


def dedup_stream(
    stream: DataFrame, output: str, checkpoint: str, key: str = "_original_index", event_time: str | None = None,
    lateness: str = "1 day",
) -> StreamingQuery:
    """Pass every key once, across batches and restarts.

    With an event time, keys are forgotten ``lateness`` after the watermark, which bounds the state by what arrives in
    that time.  Without one the state holds every key seen.
    """
    if event_time is None:
        unique = stream.dropDuplicates([key])
    else:
        unique = stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])
    return append_stream(unique, lambda df: df, output, checkpoint)
