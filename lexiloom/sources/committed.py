"""A table that grows by commits, and jobs that save their work batch by batch.

A table is a folder of batches and a folder of commit records.  A batch is written under a fresh name and counts only
once a record that names it exists; a record is one file, put in place by the rename that ends a write job.  A
reader takes the folders that records name, so what a lost run left half-written is never read.  A record may also
name folders it replaces, which makes compaction one commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.session import remove, scratch_path, table_exists

BATCHES = 8
RECORD = "folder string, run string, batch long, replaces array<string>"


class CommittedTable:
    """Batches of rows below ``path``; ``read`` gives the rows of committed ones."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def records(self) -> DataFrame | None:
        """Commit records, or None where the table has none.  One row per commit."""
        folder = f"{self.path}/commits"
        if not table_exists(self.spark, folder, "json", RECORD):
            return None
        return self.spark.read.schema(RECORD).option("recursiveFileLookup", True).json(folder)

    def folders(self, run: str | None = None) -> list[str]:
        """Names of committed folders that no later commit replaces; as many as batches, not rows."""
        records = self.records()
        if records is None:
            return []
        found = records.collect()
        gone = {f for r in found for f in r["replaces"] or ()}
        return sorted({r["folder"] for r in found if run in (None, r["run"])} - gone)

    def stage(self, rows: DataFrame, run: str, batch: int) -> str:
        """Write a batch; it does not count before ``commit``."""
        folder = f"{run}-{batch}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.path}/batches/{folder}")
        return folder

    def commit(self, folder: str, run: str, batch: int, replaces: list[str] | None = None) -> None:
        record = self.spark.createDataFrame([(folder, run, batch, replaces or [])], RECORD)
        record.coalesce(1).write.mode("errorifexists").json(f"{self.path}/commits/{folder}")

    def append(self, rows: DataFrame, run: str, batch: int) -> None:
        self.commit(self.stage(rows, run, batch), run, batch)

    def read(self, run: str | None = None) -> DataFrame | None:
        """Rows of all commits, or of one run's; None where there are none."""
        folders = self.folders(run)
        return self.spark.read.parquet(*[f"{self.path}/batches/{f}" for f in folders]) if folders else None

    def last(self, run: str) -> int:
        """Largest batch number that a run has committed, -1 before the first."""
        records = self.records()
        found = None if records is None else records.filter(F.col("run") == run).agg(F.max("batch")).first()[0]
        return -1 if found is None else found

    def compact(self, fold: Callable[[DataFrame], DataFrame] = lambda df: df, run: str = "compact") -> None:
        """One folder for all there are, their rows passed through ``fold``; readers see all or nothing of the change.

        The new folder stands for the last batch of ``run``.  What the compaction before this one replaced is deleted,
        with its records; what this one replaces stays until the next, for readers that hold its folders.
        """
        records = self.records()
        folders = self.folders()
        if records is None or len(folders) < 2:
            return
        stale = sorted({f for r in records.select("replaces").collect() for f in r["replaces"] or ()})
        rows = self.spark.read.parquet(*[f"{self.path}/batches/{f}" for f in folders])
        batch = max(self.last(run), 0)
        self.commit(self.stage(fold(rows), run, batch), run, batch, folders)
        for folder in stale:
            remove(self.spark, f"{self.path}/batches/{folder}")
            remove(self.spark, f"{self.path}/commits/{folder}")


def append_as_completed(
    rows: DataFrame, table: CommittedTable, transform: Callable[[DataFrame], DataFrame], key: str, batches: int = BATCHES
) -> str:
    """Transform ``rows`` in batches by key, committing each as it is done; the name of the run.

    The rows are dealt to batch folders once, so a batch reads its own rows only.  A run that dies loses the batch it
    was in: take what the table holds out of ``rows`` (``pending_rows``) and run again.
    """
    run, spark = uuid.uuid4().hex[:12], rows.sparkSession
    dealt = scratch_path(spark, "dealt")
    numbered = rows.withColumn("_batch", F.pmod(F.xxhash64(key), F.lit(batches)).cast("int"))
    numbered.hint("rebalance", "_batch").write.partitionBy("_batch").parquet(dealt)
    stored = spark.read.schema(numbered.schema).parquet(dealt)
    for batch in range(batches):
        table.append(transform(stored.filter(F.col("_batch") == batch).drop("_batch")), run, batch)
    return run
