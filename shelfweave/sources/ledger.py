"""A keyed table as a log of hash-partitioned deltas on any Hadoop file system, merged on read and compacted bucket by bucket.

Layout: ``<table>/buckets=B/part=delta/number=N/bucket=K/*.parquet``, and ``part=base`` for what compaction made of deltas and older bases. A
folder of a number counts once its ``_SUCCESS`` marker exists. Every row carries the number that wrote it, so the row of the highest number
wins in whatever order deltas arrive or are compacted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweave.operators.relational import literal_rows

BUCKETS = 64


class Ledger:
    """One keyed table; rows fall into buckets by a hash of the first key column."""

    def __init__(self, spark: SparkSession, root: str, name: str, schema: str, key: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.schema, self.key = spark, schema, list(key)
        self.root = f"{root.rstrip('/')}/{name}"
        self._asked = buckets
        names = T._parse_datatype_string(schema).fieldNames()
        self.payload = [c for c in names if c not in self.key]

    # --- folders ---------------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    @property
    def buckets(self) -> int:
        """The number of buckets the table was made with."""
        found = self._fs().globStatus(self._path("buckets=*")) or []
        return int(found[0].getPath().getName().split("=")[1]) if found else self._asked

    @property
    def folder(self) -> str:
        return f"{self.root}/buckets={self.buckets}"

    def numbers(self, part: str = "delta") -> list[int]:
        """Committed numbers of deltas (or bases), lowest first."""
        found = self._fs().globStatus(self._path("buckets=*", f"part={part}", "number=*", "_SUCCESS")) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key[0]).cast("long")), F.lit(self.buckets)).cast("int")

    # --- rows ------------------------------------------------------------------------------------

    def append(self, rows: DataFrame, number: int, gone: DataFrame | None = None) -> None:
        """Writes the rows of one number: one row a key, in its full new state; keys of ``gone`` are deleted.

        A replay of the number replaces its own delta. Only the folders of the buckets that have rows come into being.
        """
        full = rows.select(*self.key, *self.payload, F.lit(False).alias("_gone"))
        if gone is not None:
            full = full.unionByName(gone.select(*self.key, F.lit(True).alias("_gone")), allowMissingColumns=True)
        full = full.withColumns({"_number": F.lit(number).cast("long"), "bucket": self._bucket()})
        full.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/part=delta/number={number}")

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets that keys fall into: at most ``buckets`` numbers."""
        return [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]

    def log(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """All committed rows, with who wrote them: numbers below ``before``, of the given buckets only."""
        bases, deltas = self.numbers("base"), self.numbers()
        if before is not None:
            deltas = [n for n in deltas if n < before]
        fields = self.schema + ", _gone boolean, _number long, part string, number long, bucket int"
        if not bases and not deltas:
            return literal_rows(self.spark, [], fields)
        log = self.spark.read.schema(fields).option("basePath", self.folder).parquet(*(f"{self.folder}/part={p}" for p, n in (("base", bases), ("delta", deltas)) if n))
        # These are partition columns: folders of other numbers and buckets are never listed as input.
        log = log.filter(((F.col("part") == "base") & F.col("number").isin(bases)) | ((F.col("part") == "delta") & F.col("number").isin(deltas)))
        if buckets is not None:
            log = log.filter(F.col("bucket").isin(list(buckets)))
        return log if before is None else log.filter(F.col("_number") < before)

    def _latest(self, log: DataFrame) -> DataFrame:
        newest = log.groupBy(*self.key).agg(F.max_by(F.struct(*self.payload, "_gone", "_number"), "_number").alias("_row"))
        return newest.select(*self.key, "_row.*")

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The current rows. With ``keys`` (some key columns, the first among them) only theirs, out of their buckets alone."""
        log = self.log(before, None if keys is None else self.touched(keys))
        if keys is not None:
            on = [c for c in self.key if c in keys.columns]
            log = log.join(keys.select(*on).distinct(), on, "left_semi")
        return self._latest(log).filter(~F.col("_gone")).select(*self.key, *self.payload)

    # --- upkeep ----------------------------------------------------------------------------------

    def compact(self, below: int, least: int = 8) -> list[int]:
        """Merges the deltas with numbers under ``below`` of every bucket that has ``least`` of them; returns those buckets.

        Other buckets are not read. ``below`` is the batch about to run: a replay of it still finds what it saw. Merged rows keep the numbers
        that wrote them and deletions stay marked, so a delta that arrives late finds its place. Folders that were merged go last.
        """
        fs, numbers = self._fs(), [n for n in self.numbers() if n < below]
        folders: dict[int, list] = {}
        for part, known in (("delta", numbers), ("base", self.numbers("base"))):
            for n in known:
                for s in fs.globStatus(self._path(f"buckets={self.buckets}", f"part={part}", f"number={n}", "bucket=*")) or []:
                    folders.setdefault(int(s.getPath().getName().split("=")[1]), []).append((part, s.getPath()))
        due = sorted(b for b, some in folders.items() if sum(part == "delta" for part, _ in some) >= least)
        if not due:
            return []
        number = max([*self.numbers("base"), 0]) + 1
        merged = self._latest(self.log(below, due)).withColumn("bucket", self._bucket())
        merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/part=base/number={number}")
        for b in due:
            for _, path in folders[b]:
                fs.delete(path, True)
        return due
