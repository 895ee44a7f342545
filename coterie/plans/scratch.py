"""Steps of a multi-step job, written as Parquet to the cluster's shared folder.

Loops cut their lineage here. A written step outlives lost executors, carries file sizes
that the optimiser can use, and can be removed as soon as nothing reads it any more.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .limits import limit


# Folders made for local sessions that name none, by application.
_temporary: dict[str, str] = {}


@dataclass(frozen=True)
class Saved:
    """A step: how to read it, how many rows it has at most, and the metrics asked for."""

    df: DataFrame
    rows: int
    path: str = ""
    metrics: dict = field(default_factory=dict)

    def select(self, *columns: str) -> "Saved":
        """The same rows under other columns, given as SQL expressions."""
        return Saved(self.df.selectExpr(*columns), self.rows, self.path)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _temporary:
        _temporary[context.applicationId] = tempfile.mkdtemp(prefix="coterie-")
        atexit.register(shutil.rmtree, _temporary[context.applicationId], ignore_errors=True)
    return _temporary[context.applicationId]


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of all files in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def clear_results(spark: SparkSession) -> None:
    """Remove every result that this application has written; their DataFrames can no longer be read."""
    for root in [r for r, owner in Scratch.with_results.items() if owner == spark.sparkContext.applicationId]:
        remove(spark, root)
        del Scratch.with_results[root]


def release(result: DataFrame) -> None:
    """Remove what backs one result of an operator; it and what was derived from it can no longer be read."""
    root = getattr(result, "_coterie_result", None)
    if root in Scratch.with_results:
        remove(result.sparkSession, root)
        del Scratch.with_results[root]


class Scratch:
    """Owns the steps of one operator call; used as a context manager.

    On leaving the block every step is removed except those saved with ``keep=True``, which
    back the DataFrame handed to the caller.
    """

    # Folders of results and the applications that wrote them.
    with_results: dict[str, str] = {}

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/coterie-{uuid.uuid4().hex}"
        self._count = 0
        self._cached: list[DataFrame] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        for df in self._cached:
            df.unpersist()
        remove(self.spark, f"{self.root}/steps")

    def folder(self, keep: bool = False) -> str:
        """A new folder for a step, or for several steps read back as one table."""
        self._count += 1
        if keep:
            self.with_results[self.root] = self.spark.sparkContext.applicationId
        return f"{self.root}/{'kept' if keep else 'steps'}/{self._count:05d}"

    def save(
        self,
        df: DataFrame,
        keep: bool = False,
        path: str | None = None,
        **metrics: Column,
    ) -> Saved:
        """Write ``df`` once and read it back; the row count comes from the same job."""
        path = path or self.folder(keep)
        seen = Observation()
        counted = df.observe(
            seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]
        )
        counted.write.parquet(path, compression="zstd")
        found = seen.get
        read = self.read(path, df.schema)
        if keep:
            read._coterie_result = self.root
        return Saved(read, found.pop("rows"), path, found)

    def settle(self, df: DataFrame, at_most: int) -> Saved:
        """Leave a table that is known to be small as a plan, which is cheap to run again; write others."""
        if at_most <= limit(self.spark, "broadcastRows"):
            return Saved(df, at_most)
        return self.save(df)

    def read(self, path: str, schema) -> DataFrame:
        """A saved folder under a known schema, so no job is spent on inferring it."""
        return self.spark.read.schema(schema).parquet(path)

    def cache(self, df: DataFrame) -> DataFrame:
        df = df.persist()
        self._cached.append(df)
        return df
