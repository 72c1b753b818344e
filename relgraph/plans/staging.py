"""Lineage cuts for multi-step operators.

A step that several later steps read, or a round of a fixpoint, is written as a
Parquet table below the cluster's shared checkpoint folder and read back.
Compared with recomputing it, the plan stays small, a lost executor costs only
its own tasks, and the files carry sizes, so Spark chooses between broadcast
and shuffle joins from facts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder all executors share; "
            "multi-step operators keep their intermediate key sets there"
        )
    folder = tempfile.mkdtemp(prefix="relgraph-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Frames of more rows are not broadcast in rounds, so what a round sends to the driver does not grow with the tables.
BROADCAST_ROWS = 20_000


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a side of a join that goes through the driver, as a broadcast, only if it has few rows."""
    return df.hint("shuffle_merge") if rows > BROADCAST_ROWS else df


_scopes: list[list[Staging]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Delete, at the end of the block, what operators called inside have written for themselves.

    Their results read these tables, so write the results inside the block::

        with scratch():
            cascade_delete(tables, spec, roots).deleted.write.parquet(path)
    """
    made: list[Staging] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for staging in made:
            staging.remove()


class Staging:
    """Writes intermediate tables of one operator call below one folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark)}/relgraph-{uuid.uuid4().hex}"
        self._count = 0
        self._written: dict[tuple[str, str], list[int]] = {}
        self._paths: dict[str, list[str]] = {}
        for made in _scopes:
            made.append(self)

    def remove(self) -> None:
        """Delete what this call has written; frames that still read it fail afterwards."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(self.folder)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def drop(self, *labels: str) -> None:
        """Delete the tables of these labels: steps that later ones, written since, have taken the place of."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        system = hadoop.Path(self.folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for label in labels:
            for path in self._paths.pop(label, []):
                system.delete(hadoop.Path(path), True)

    def keep(self, df: DataFrame, label: str = "step") -> tuple[DataFrame, int]:
        """Write ``df`` and return (frame over the written table, row count).

        The count is observed during the write, so testing for an empty round
        needs no further job.  A re-run task may count twice: use it only to
        tell zero from non-zero.
        """
        kept, rows, _ = self.keep_counting(df, F.lit(False), label)
        return kept, rows

    def keep_counting(self, df: DataFrame, condition: Column, label: str = "step") -> tuple[DataFrame, int, int]:
        """Like :meth:`keep`, with the number of rows that meet a condition."""
        self._count += 1
        path = f"{self.folder}/{self._count:04d}-{label}"
        self._paths.setdefault(label, []).append(path)
        seen = Observation()
        counted = df.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.count_if(condition), F.lit(0)).alias("met")
        )
        counted.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), int(seen.get["rows"]), int(seen.get["met"])

    def append_keys(self, step: int, sets: Mapping[str, DataFrame], label: str = "keys") -> dict[str, int]:
        """Add one step to several named key sets of one type, in one job.

        The sets share a table that is partitioned by step and name.  What was
        written is noted, so reading a set, or its last steps, opens exactly
        its folders and lists no others.  Returns the rows added per name.
        """
        names = sorted(sets)
        column = sets[names[0]].columns[0]
        seen = Observation()
        parts = [sets[n].select(column, F.lit(n).alias("_set")) for n in names]
        counts = [F.count_if(F.col("_set") == n).alias(f"n{i}") for i, n in enumerate(names)]
        union = reduce(DataFrame.unionByName, parts).observe(seen, *counts)
        union.write.partitionBy("_set").parquet(f"{self.folder}/{label}/_step={step}")
        counts = {n: int(seen.get[f"n{i}"] or 0) for i, n in enumerate(names)}
        for name, n in counts.items():
            if n:
                self._written.setdefault((label, name), []).append(step)
        return counts

    def key_paths(self, name: str, label: str = "keys", after: int = 0) -> list[str]:
        """Folders of one key set, of the steps after ``after``."""
        return [f"{self.folder}/{label}/_step={s}/_set={name}" for s in self._written.get((label, name), []) if s > after]

    def keys(self, name: str, column: str, key_type: DataType, label: str = "keys", after: int = 0) -> DataFrame:
        """One key set of :meth:`append_keys`, from the steps after ``after``."""
        schema = StructType([StructField(column, key_type)])
        paths = self.key_paths(name, label, after)
        if not paths:
            return self.spark.range(0).select(F.col("id").cast(key_type).alias(column))
        return self.spark.read.schema(schema).parquet(*paths)
