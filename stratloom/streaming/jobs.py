"""Folders of job files as streams: queue pick-up and an idempotent merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import jobs as j
from ..operators import tools


def stream_jobs(spark: SparkSession, folder: str, status: str = "queued", schema: str = schemas.JOB_STATUS) -> DataFrame:
    """Jobs with a given status from a folder of status files, as they arrive."""
    return spark.readStream.schema(schema).json(folder).filter(F.col("status") == status)


def run(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Drive a stream through ``batch``: once over what is there, or every interval."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_once(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    run(stream, batch, checkpoint).awaitTermination()


class MergeSink:
    """Append accepted proposals to the master table and then to the ledger.

    The ledger is written last. A batch that stopped in between runs again, and its rows that already
    reached the master drop out by their (job_id, i), so repeated and restarted batches add nothing twice.
    """

    def __init__(self, spark: SparkSession, master: str, ledger: str, to_rows: Callable[[DataFrame], DataFrame]):
        self.spark, self.master, self.ledger, self.to_rows = spark, master, ledger, to_rows

    def _ledger(self) -> DataFrame:
        try:
            return self.spark.read.parquet(self.ledger)
        except AnalysisException:
            return self.spark.createDataFrame([], "job_id string, i int")

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        master = self.spark.read.parquet(self.master)
        new = tools.materialise(j.idempotent_merge(batch, self._ledger(), master))
        rows = self.to_rows(new)
        rows.select([F.col(c).cast(master.schema[c].dataType).alias(c) for c in master.columns]).write.mode("append").parquet(self.master)
        # the ledger takes the whole batch: rows already in the master are done as well
        # those without coordinates stay out of it
        done = batch.filter("lat is not null and lon is not null").select("job_id", "i").distinct().join(self._ledger(), ["job_id", "i"], "left_anti")
        done.write.mode("append").parquet(self.ledger)


class StatusSink:
    """Keep one row per job: each batch is folded into the stored rows, version by version.

    Every column is stored with the time of its value, so an update that comes late, after a newer one of
    another column, still counts.
    """

    def __init__(self, spark: SparkSession, root: str, order: str = "updated"):
        self.spark, self.root, self.order = spark, root, order

    def _stored(self, before: int | None = None) -> DataFrame | None:
        """Rows of the newest version older than ``before``."""
        try:
            versions = self.spark.read.parquet(self.root)
        except AnalysisException:
            return None
        if before is not None:
            versions = versions.filter(F.col("version") < before)
        top = versions.agg(F.max("version")).first()[0]
        return None if top is None else versions.filter(F.col("version") == top).drop("version")

    def current(self, before: int | None = None) -> DataFrame | None:
        rows = self._stored(before)
        return rows if rows is None else rows.drop(*[c for c in rows.columns if c.startswith(_AT)])

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        cols = [c for c in batch.columns if c not in ("job_id", self.order)]
        fresh = batch.select("job_id", self.order, *cols, *[F.when(F.col(c).isNotNull(), F.col(self.order)).alias(_AT + c) for c in cols])
        prev = self._stored(epoch)
        log = fresh if prev is None else prev.select(fresh.columns).unionByName(fresh)
        last = log.groupBy("job_id").agg(F.max(self.order).alias(self.order), *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(_AT + c).alias("at"), F.col(c).alias("v")))).alias(c) for c in cols])
        # a repeated batch overwrites its own version and never reads it
        last.select("job_id", self.order, *[F.col(c)["v"].alias(c) for c in cols], *[F.col(c)["at"].alias(_AT + c) for c in cols]) \
            .write.mode("overwrite").parquet(f"{self.root}/version={epoch}")


_AT = "_at_"  # prefix of the columns that hold times
