"""Tables between the steps of a job: written to the shared folder and reread, which cuts lineage and survives lost executors."""

from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

FALLBACK = "/tmp/shelfweave-checkpoints"
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def reachable(spark: SparkSession) -> None:
    """Python workers of a session that was started elsewhere find this package where the driver has it."""
    here, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [here, env.get("PYTHONPATH", "")]))


def bounded_batches(spark: SparkSession) -> None:
    """Batches to Python workers end at ``BATCH_BYTES``, unless the session says otherwise.

    Their default end is 10,000 rows, which for whole texts is tens of MB, held outside the heap by the executor on the way there and back
    and again by each worker.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


class Scratch:
    """A folder of its own for one run of an operator, below ``spark.checkpoint.dir``.

    Only where the session names no such folder (local tests) is ``FALLBACK`` used. The folder goes when the session's JVM ends;
    ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or FALLBACK
        self.folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.latest: dict[str, str] = {}
        self._fs().deleteOnExit(self._path(self.folder))
        reachable(spark)
        bounded_batches(spark)

    def _path(self, at: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(at)

    def _fs(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` to a folder of its own and returns the written rows."""
        self.latest[name] = at = f"{self.folder}/{name}-{len(self.latest)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(at)
        # Spark removes the shuffle files of finished plans when the driver collects its garbage, which on a large heap is late.
        gc.collect()
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self, name: str) -> None:
        """Removes the latest table of that name."""
        self._fs().delete(self._path(self.latest[name]), True)
