"""Suggestion store and run state on plain Parquet folders.

Every run writes its rows under its own ``run_id`` (repeating a run replaces
them) and then claims the next version of a small log. Readers follow the newest
version, so a run that dies half-way changes nothing they see. A version is claimed
by a rename that fails where the version exists: of two publishers one wins, and the
other goes by what the winner left. That takes a file system that renames in one
step, as HDFS and local disks do; a plain object store does not.
"""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SUGGESTION_COLUMNS

_LOG = "run_id string, mode string, active array<string>, version bigint"
_STATE = "run_id string, mode string, finished_at timestamp_ntz"


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False, and the folder is gone, where ``target`` exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(new.getParent())
    files = hadoop.FileContext.getFileContext(
        old.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        files.rename(old, new, spark._sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        files.delete(old, True)
        return False
    return True


class SuggestionStore:
    """Current suggestions and their history under one base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.current_path = f"{base}/suggestions"
        self.history_path = f"{base}/suggestions_history"
        self.log_path = f"{base}/publish_log"
        self.claims_path = f"{base}/publish_claims"

    def _newest(self) -> tuple[int, list[str]]:
        log = _read(self.spark, self.log_path, _LOG)
        row = None if log is None else log.orderBy(F.desc("version")).first()
        return (0, []) if row is None else (row["version"], list(row["active"]))

    def _rows_of(self, path: str, run_ids: list[str]) -> DataFrame | None:
        """Run folders are named, so nothing but the wanted ones is listed or read."""
        if not run_ids:
            return None
        return self.spark.read.option("basePath", path).parquet(
            *[f"{path}/run_id={r}" for r in run_ids]
        )

    def current(self) -> DataFrame | None:
        return self._rows_of(self.current_path, self._newest()[1])

    def history(self) -> DataFrame | None:
        """Archived rows of completed full runs."""
        log = _read(self.spark, self.log_path, _LOG)
        if log is None:
            return None
        archived = _read(self.spark, self.history_path)
        if archived is None:
            return None
        done = log.filter(F.col("mode") == "full").select("run_id").distinct()
        return archived.join(done, "run_id", "left_semi")

    def _commit(self, version: int, run_id: str, mode: str, active: list[str]) -> bool:
        """Whether this run got the version; False where another publisher has it."""
        claim = f"{self.claims_path}/{uuid.uuid4().hex}"
        row = self.spark.createDataFrame([(run_id, mode, active, version)], _LOG).drop("version")
        row.coalesce(1).write.parquet(claim)
        return _renamed(self.spark, claim, f"{self.log_path}/version={version}")

    def publish(
        self, records: DataFrame, run_id: str, mode: str, created: dt.datetime
    ) -> None:
        """'partial' adds the records; 'full' archives the current ones and replaces them.

        Where another publisher was faster, this one starts again from what that one left.
        """
        if mode not in ("full", "partial"):
            raise ValueError(f"unknown mode {mode!r}")
        version, active = self._newest()
        if run_id in active:
            return
        rows = records.select(*SUGGESTION_COLUMNS).withColumn(
            "create_date", F.lit(created).cast("timestamp_ntz")
        )
        rows.write.mode("overwrite").parquet(f"{self.current_path}/run_id={run_id}")
        while True:
            if mode == "full":
                self._archive(active, run_id)
            kept = active if mode == "partial" else []
            if self._commit(version + 1, run_id, mode, [*kept, run_id]):
                return
            version, active = self._newest()
            if run_id in active:  # the same run, published twice at once
                return

    def _archive(self, active: list[str], run_id: str) -> None:
        old = self._rows_of(self.current_path, active)
        if old is not None:
            old.drop("run_id").withColumnRenamed("create_date", "original_create_date").write.mode(
                "overwrite"
            ).parquet(f"{self.history_path}/run_id={run_id}")


class RunState:
    """Log of finished runs."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.path = f"{base}/run_state"

    def runs_since_full(self) -> DataFrame | None:
        """run_id and finished_at of the last full run and of the runs after it; None without a log."""
        state = _read(self.spark, self.path, _STATE)
        if state is None:
            return None
        last = self.last_full_run()
        kept = state if last is None else state.filter(F.col("finished_at") >= F.lit(last))
        return kept.groupBy("run_id").agg(F.min("finished_at").alias("finished_at"))

    def current_runs(self) -> list[str]:
        """The last full run and the partial runs after it, in order."""
        runs = self.runs_since_full()
        if runs is None:
            return []
        # One row per run since the last full one.
        return [r["run_id"] for r in runs.orderBy("finished_at", "run_id").collect()]

    def finished(self, run_id: str, mode: str, at: dt.datetime) -> None:
        self.record(self.spark.createDataFrame([(run_id, mode, at)], _STATE).coalesce(1))

    def record(self, runs: DataFrame) -> None:
        """Log finished runs: run_id, mode, finished_at."""
        runs.select("run_id", "mode", "finished_at").write.mode("append").parquet(self.path)

    def last_full_run(self) -> dt.datetime | None:
        state = _read(self.spark, self.path, _STATE)
        if state is None:
            return None
        return state.filter(F.col("mode") == "full").agg(F.max("finished_at")).first()[0]

    def require_last_full_run(self) -> dt.datetime:
        last = self.last_full_run()
        if last is None:
            raise LookupError("no full run on record: new products cannot be told apart")
        return last
