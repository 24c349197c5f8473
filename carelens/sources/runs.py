"""Runs: results are staged in a folder of their own and published as a whole, or not at all.

    out_dir/runs/<run>/<zone>/<table>    what a run writes, seen by nobody until it is published
    out_dir/manifest/                    one file per ended run: its status and, if published, its tables

Appending that one file is what publishes a run. A run that fails, or dies at any point, leaves what was published before
as it was: its tables are neither replaced nor mixed with newer ones, and a run may read them while it writes its own.
"""

from __future__ import annotations

import time
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from carelens.sources import sinks

RUNS, MANIFEST = "runs", "manifest"
COMPLETED, ABORTED, FAILED = "completed", "aborted", "failed"
#: One row per table of a run; a run without tables is one row without a table. Paths are relative to out_dir.
SCHEMA = "number long, run string, status string, stopped_at string, error string, started double, ended double, zone string, name string, path string, rows long"
ERROR_LENGTH = 2000


def manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """All ended runs with their tables; nothing where no run has ended."""
    try:
        return spark.read.schema(SCHEMA).parquet(f"{out_dir}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def _last(spark: SparkSession, out_dir: str) -> list:
    """The manifest rows of the last published run: as many as it has tables."""
    rows = manifest(spark, out_dir).where(F.col("status") != FAILED)
    newest = rows.select("number", "run").orderBy(F.desc("number"), F.desc("run")).first()
    return [] if newest is None else rows.where(F.col("run") == newest["run"]).collect()


def published(spark: SparkSession, out_dir: str, zone: str | None = None) -> dict[str, str]:
    """Where the tables of the last published run lie, by name; of one zone only, if given."""
    return {r["name"]: f"{out_dir}/{r['path']}" for r in _last(spark, out_dir) if r["name"] and zone in (None, r["zone"])}


def read_published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A table of the last published run."""
    found = published(spark, out_dir)
    if name not in found:
        raise KeyError(f"{name} is not among the published tables {sorted(found)}")
    return spark.read.parquet(found[name])


class Run:
    """Results of one run. As a context it publishes them at its end, and on an exception leaves a note of the failure.

    Tables are written one after the other and may be read back by the run that writes them (`path`).
    """

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir, self.id = spark, out_dir, uuid.uuid4().hex
        self.status, self.stopped_at = COMPLETED, None
        self.started = time.time()
        self.dir = f"{RUNS}/{self.id}"
        self.tables: dict[str, str] = {}  # name to zone
        self.ended = False

    def path(self, name: str) -> str:
        return f"{self.out_dir}/{self.dir}/{self.tables[name]}/{name}"

    def _write(self, df: DataFrame, zone: str, name: str) -> str:
        if self.ended:
            raise ValueError(f"run {self.id} has ended")
        if name in self.tables:
            raise ValueError(f"run {self.id} has written {name} already")
        self.tables[name] = zone
        df.write.mode("errorifexists").parquet(self.path(name))
        return self.path(name)

    def write_rows(self, df: DataFrame, name: str) -> str:
        """Stage a table with identifiers."""
        return self._write(df, sinks.ROW_ZONE, name)

    def write_work(self, df: DataFrame, name: str) -> str:
        """Stage a working table, which is not published."""
        return self._write(df, sinks.WORK_ZONE, name)

    def write_aggregate(self, df: DataFrame, name: str) -> str:
        """Stage a table without identifiers; one that has some is refused."""
        return self._write(sinks.refuse_identifiers(df), sinks.AGGREGATE_ZONE, name)

    def _end(self, rows: list[tuple]) -> None:
        last = manifest(self.spark, self.out_dir).agg(F.max("number").alias("n")).first()["n"]
        head = ((last or 0) + 1, self.id, self.status, self.stopped_at)
        out = self.spark.createDataFrame([(*head, r[0], self.started, time.time(), *r[1:]) for r in rows], SCHEMA)
        out.coalesce(1).write.mode("append").parquet(f"{self.out_dir}/{MANIFEST}")
        self.ended = True

    def publish(self) -> dict[str, str]:
        """Make the staged tables the published ones: where they lie, by name. A table that can't be read back fails."""
        kept = {n: z for n, z in self.tables.items() if z != sinks.WORK_ZONE}
        rows = [(None, z, n, f"{self.dir}/{z}/{n}", self.spark.read.parquet(self.path(n)).count()) for n, z in kept.items()]
        self._end(rows or [(None, None, None, None, None)])
        return {n: self.path(n) for n in kept}

    def fail(self, error: BaseException) -> None:
        """Note that the run failed; nothing of it is published."""
        self.status = FAILED
        self._end([(f"{type(error).__name__}: {error}"[:ERROR_LENGTH], None, None, None, None)])

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if error is None:
            if not self.ended:
                self.publish()
        elif not self.ended:
            try:
                self.fail(error)
            except Exception as second:  # the first error is the one to tell
                error.add_note(f"and the failure could not be noted: {second}")


def prune(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Remove the folders of failed runs and of all but the last `keep` published ones; their ids.

    Runs that have not ended, or were killed, are not in the manifest and stay. The manifest keeps its rows.
    """
    if keep < 1:
        raise ValueError("the last published run must stay")
    ended = manifest(spark, out_dir).select("run", "number", "status").distinct()
    stay = ended.where(F.col("status") != FAILED).orderBy(F.desc("number"), F.desc("run")).limit(keep).select("run")
    gone = [r["run"] for r in ended.join(stay, "run", "left_anti").select("run").collect()]
    jvm = spark._jvm
    removed = []
    for run in gone:
        path = jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{RUNS}/{run}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            removed.append(run)
    return sorted(removed)
