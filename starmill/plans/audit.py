"""Load audit: an append-only run log and the questions asked of it.

A run writes a start row and, on ending, a row with its outcome. Both carry the start time, and
only the second an end time, so a run in progress has no duration.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from starmill.functions import labels
from starmill.functions.scalars import seconds_between, sql_literal
from starmill.operators.incremental import last_watermark
from starmill.schemas import RUN_LOG
from starmill.sources.store import Store


def _latest_by() -> Column:
    return F.struct("started_at", F.col("ended_at").isNotNull(), "ended_at", "batch_id")


def _marked_by() -> Column:
    return F.when(F.col("watermark").isNotNull(), F.col("started_at"))


def current_state(log: DataFrame) -> DataFrame:
    """One row per process: its latest run, with the newest watermark any of its runs stored."""
    latest = F.max_by(
        F.struct("batch_id", "state", "started_at", "ended_at", "rows_affected", "message"), _latest_by())
    stored = F.max_by("watermark", _marked_by())
    return (log.groupBy("process").agg(latest.alias("_run"), stored.alias("watermark"))
            .select("process", "_run.*", "watermark"))


def folded(log: DataFrame) -> DataFrame:
    """The rows of a log that answer every question about its state: of each process the latest run and the
    run that stored the newest watermark. Folding twice, or a log with repeated rows, gives the same."""
    row = F.struct(*[f.name for f in RUN_LOG.fields])
    kept = F.array(F.max_by(row, _latest_by()), F.max_by(row, _marked_by()))
    return (log.groupBy("process").agg(kept.alias("_kept")).select(F.explode("_kept").alias("_row"))
            .where("_row IS NOT NULL").select("_row.*").distinct())


def monitor(log: DataFrame) -> DataFrame:
    """Latest run of each process with its duration, newest first."""
    return (current_state(log)
            .select("process", "state", "started_at", "ended_at",
                    seconds_between("started_at", "ended_at").alias("seconds"),
                    "watermark", "rows_affected", "message")
            .orderBy(F.col("started_at").desc(), "process"))


def watermark_drift(log: DataFrame) -> DataFrame:
    """How far each process's watermark lies behind the newest one."""
    marks = current_state(log).select("process", "watermark")
    newest = log.agg(F.max("watermark")).scalar()
    return marks.withColumn("seconds_behind", seconds_between(F.col("watermark"), newest))


class RunLog:
    """The run log of a store.

    Every run appends its rows. ``compact`` folds ended runs into one state table, so that reading costs the
    number of processes and of runs since then; the folded rows are kept in an archive.
    """

    TABLE, STATE, ARCHIVE = "etl/run_log", "etl/run_state", "etl/run_archive"

    def __init__(self, store: Store):
        self.store = store

    def read(self) -> DataFrame:
        """What tells the state of all processes: the folded state and all rows since."""
        return self.store.read(self.STATE, RUN_LOG).unionByName(self.store.read(self.TABLE, RUN_LOG))

    def history(self) -> DataFrame:
        """Every row ever logged."""
        return self.store.read(self.ARCHIVE, RUN_LOG).unionByName(self.store.read(self.TABLE, RUN_LOG)).distinct()

    def compact(self) -> None:
        """Fold the runs that have ended; those still open stay as they are.

        Interrupted at any point, the rows are in the state, among the single rows, or in both, which
        reads the same.
        """
        ended = [p.removesuffix("-end") for p in self.store.parts(self.TABLE) if p.endswith("-end")]
        closed = [f"{run}-{phase}" for run in ended for phase in ("start", "end")]
        if not closed:
            return
        rows = self.store.read(self.TABLE, RUN_LOG, parts=closed)
        version = max(self.store.versions(self.STATE), default=0) + 1
        self.store.append(self.ARCHIVE, rows.coalesce(1), str(version))
        state = self.store.read(self.STATE, RUN_LOG).unionByName(rows)
        self.store.write(self.STATE, folded(state).coalesce(1), version=version)
        for part in closed:
            self.store.drop_part(self.TABLE, part)
        self.store.prune(self.STATE)

    def last_watermark(self, process: str) -> datetime:
        return last_watermark(self.read(), process)

    def start(self, process: str, batch_id: str, at: datetime) -> None:
        self._append(process, batch_id, labels.RUNNING, at, None)

    def success(self, process: str, batch_id: str, started: datetime, ended: datetime,
                rows: int, watermark: datetime | None = None) -> None:
        self._append(process, batch_id, labels.OK, started, ended, watermark, rows)

    def failure(self, process: str, batch_id: str, started: datetime, ended: datetime,
                message: str) -> None:
        self._append(process, batch_id, labels.ERROR, started, ended, None, None, message)

    def _append(self, process, batch_id, state, started, ended, watermark=None, rows=None,
                message=None) -> None:
        values = (process, batch_id, state, started, ended, watermark, rows, message)
        row = self.store.spark.range(1, numPartitions=1).selectExpr(*[
            f"CAST({sql_literal(v)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f, v in zip(RUN_LOG.fields, values)])
        phase = "start" if ended is None else "end"
        self.store.append(self.TABLE, row, f"{process}-{batch_id}-{phase}")
