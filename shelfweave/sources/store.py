"""Versioned document store and snapshot tables on any Hadoop file system.

Layout: ``documents/version=V/batch=B/elastic_type=T/elastic_id_shop=S/elastic_id_lang=L/*.parquet`` and
``<table>/snapshot=N/*.parquet``; the status and the marks of the change feed are keyed logs (``Ledger``). Nothing is overwritten while it is
read: a batch or snapshot is a new folder that counts once its ``_SUCCESS`` marker exists, so a replayed batch replaces only itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweave.sources.ledger import Ledger

TARGET = ["elastic_type", "elastic_id_shop", "elastic_id_lang"]
DOC_KEY = ["id", *TARGET]
STATUS_SCHEMA = "id_entity long, index string, id_shop int, id_lang int, date_upd date, error string"
STATUS_KEY = ["id_entity", "index", "id_shop", "id_lang"]
MARKS_SCHEMA = "id_entity long, entity string, op string, ts timestamp_ntz, change_id long"
MARKS_KEY = ["id_entity", "entity"]


def judged(docs: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Documents with the text of the first failed check as ``error``, NULL where all hold."""
    errors = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(text)) for text, holds in checks.items()]
    return docs.withColumn("error", F.coalesce(*errors, F.lit(None).cast("string")))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        #: Outcome of every document, and the last change heard of every entity.
        self.status = Ledger(spark, self.root, "status", STATUS_SCHEMA, STATUS_KEY)
        self.marks = Ledger(spark, self.root, "marks", MARKS_SCHEMA, MARKS_KEY)
        self._ledgers = {"status": self.status, "marks": self.marks}

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    # --- snapshots -------------------------------------------------------------------------------

    def snapshots(self, table: str) -> list[int]:
        """Committed snapshot numbers, oldest first; of a keyed log those of its deltas."""
        if table in self._ledgers:
            return self._ledgers[table].numbers()
        fs, found = self._fs(), []
        for status in fs.globStatus(self._path(table, "snapshot=*")) or []:
            if fs.exists(self._path(table, status.getPath().getName(), "_SUCCESS")):
                found.append(int(status.getPath().getName().split("=")[1]))
        return sorted(found)

    def read(self, table: str, before: int | None = None) -> DataFrame | None:
        """The newest committed snapshot, or the newest with a number below ``before``; of a keyed log its rows."""
        if table in self._ledgers:
            log = self._ledgers[table]
            return log.read(before) if log.numbers() or log.numbers("base") else None
        numbers = [n for n in self.snapshots(table) if before is None or n < before]
        return self.spark.read.parquet(f"{self.root}/{table}/snapshot={numbers[-1]}") if numbers else None

    def write(self, table: str, frame: DataFrame, number: int | None = None) -> int:
        """A new snapshot; the given number when a replay has to replace its own."""
        if number is None:
            number = (self.snapshots(table) or [0])[-1] + 1
        frame.write.mode("overwrite").parquet(f"{self.root}/{table}/snapshot={number}")
        return number

    def claim(self, stream: str, batch: int | str) -> int:
        """The number under which a stream's batch is stored: its own when replayed, otherwise above all numbers used so far.

        The claim is a folder made before anything is written, so a batch that broke off finds its number again.
        """
        fs, own = self._fs(), f"batch={batch}"
        used = [0]
        for status in fs.globStatus(self._path("streams", "stream=*", "batch=*", "number=*")) or []:
            at, number = status.getPath(), int(status.getPath().getName().split("=")[1])
            if at.getParent().getName() == own and at.getParent().getParent().getName() == f"stream={stream}":
                return number
            used.append(number)
        for table in ("*/snapshot=*", "documents/version=*/batch=*", "*/buckets=*/part=delta/number=*"):
            used += [int(s.getPath().getName().split("=")[1]) for s in fs.globStatus(self._path(*table.split("/"))) or []]
        fs.mkdirs(self._path("streams", f"stream={stream}", own, f"number={max(used) + 1}"))
        return max(used) + 1

    # --- documents -------------------------------------------------------------------------------

    def write_documents(self, docs: DataFrame, version: int, batch: int, max_records: int = 5_000_000) -> None:
        """Writes judged documents of one batch.

        The rebalance step sizes files by measured bytes and splits a target that holds a large
        share of the rows, so neither many tiny nor a few huge files arise.
        """
        full = docs if "error" in docs.columns else docs.withColumn("error", F.lit(None).cast("string"))
        full = full if "deleted" in full.columns else full.withColumn("deleted", F.lit(False))
        full.hint("rebalance", *TARGET).write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy(*TARGET).parquet(
            f"{self.root}/documents/version={version}/batch={batch}"
        )

    def outcome(self, version: int, batch: int) -> DataFrame | None:
        """What became of a written batch: status key, date and error. Reads only those columns."""
        folder = f"documents/version={version}/batch={batch}"
        if not self._fs().globStatus(self._path(folder, "elastic_type=*")):
            return None
        rows = self.spark.read.parquet(f"{self.root}/{folder}").filter(~F.col("deleted"))
        return rows.select(
            F.col("id").alias("id_entity"), F.col("elastic_type").alias("index"), F.col("elastic_id_shop").alias("id_shop"),
            F.col("elastic_id_lang").alias("id_lang"), F.col("updated_at").alias("date_upd"), "error",
        )

    def documents(self, version: int | None = None, entity: str | None = None) -> DataFrame:
        """The current documents: of each key the accepted row of its newest batch, unless that deletes it.

        Types whose fields of one name differ in kind are read one ``entity`` at a time.
        """
        reader = self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.root}/documents")
        log = reader.parquet(f"{self.root}/documents" + (f"/version=*/batch=*/elastic_type={entity}" if entity else "")).filter(F.col("error").isNull())
        if version is not None:
            log = log.filter(F.col("version") == version)
        keys = ["version", *DOC_KEY]
        newest = log.groupBy(*keys).agg(F.max("batch").alias("batch"))
        return log.join(newest, [*keys, "batch"], "left_semi").filter(~F.col("deleted")).drop("error", "deleted", "batch")

    def erase(self, plan: DataFrame) -> int:
        """Deletes the planned targets (id_shop, id_lang, version); one row per target, so a short list."""
        fs, gone = self._fs(), 0
        for row in plan.select("id_shop", "id_lang", "version").distinct().toLocalIterator():
            pattern = self._path(
                "documents", f"version={row.version}", "batch=*", "elastic_type=*", f"elastic_id_shop={row.id_shop}", f"elastic_id_lang={row.id_lang}"
            )
            for status in fs.globStatus(pattern) or []:
                gone += bool(fs.delete(status.getPath(), True))
        return gone
