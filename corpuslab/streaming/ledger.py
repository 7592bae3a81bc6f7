"""What a stream has finished: row ranges and whole files, by bucket of the file name, compacted.

New entries go to ``log/batch_id=/step=`` partitions, which a replayed step replaces. Now and then the log is merged into
the next version of the base, ``base/version=<last batch>/bucket=``, one file per bucket. The current version is the
highest one that carries Spark's success mark, which is written last, so readers see the old or the new version and
nothing between. Log partitions up to that version are ignored, then removed, and so are older versions but one. The
number of files is bounded by the buckets and the batches between two compactions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "file STRING, first_pos BIGINT, step BIGINT, comments BIGINT, whole BOOLEAN, last BIGINT, batch_id BIGINT"


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system, whatever store it is in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, store = _folder(spark, path)
    return store.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    hadoop, store = _folder(spark, path)
    store.delete(hadoop, True)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the ``name=<number>`` folders below ``path``."""
    hadoop, store = _folder(spark, path)
    if not store.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in store.listStatus(hadoop)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))


def replace_part(df: DataFrame, path: str, *keys: str) -> None:
    """Writes ``df``; partitions that it has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


@dataclass(frozen=True)
class Ledger:
    """Entries of one stream below ``path``; compacted once ``compact_after`` batches lie in the log."""

    path: str
    buckets: int = 64
    compact_after: int = 32

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("file"), F.lit(self.buckets)).cast("int")

    def version(self, spark: SparkSession) -> int | None:
        """Last batch in the current base."""
        done = [n for n in numbered(spark, f"{self.path}/base", "version") if exists(spark, f"{self.path}/base/version={n}/_SUCCESS")]
        return max(done, default=None)

    def _log(self, spark: SparkSession, after: int | None) -> DataFrame:
        if not exists(spark, f"{self.path}/log"):
            return spark.createDataFrame([], ENTRY)
        rows = spark.read.schema(ENTRY).parquet(f"{self.path}/log")
        return rows if after is None else rows.filter(F.col("batch_id") > after)

    def _base(self, spark: SparkSession, version: int | None) -> DataFrame:
        if version is None:
            return spark.createDataFrame([], f"{ENTRY}, bucket INT")
        return spark.read.schema(f"{ENTRY}, bucket INT").parquet(f"{self.path}/base/version={version}")

    def entries(self, spark: SparkSession) -> DataFrame:
        """All entries: ranges of files in work, and one row with ``whole`` per finished file."""
        version = self.version(spark)
        return self._base(spark, version).drop("bucket").unionByName(self._log(spark, version))

    def lookup(self, files: DataFrame) -> DataFrame:
        """Entries of the given files (``file``); only their buckets of the base are read."""
        spark = files.sparkSession
        wanted = files.select("file").distinct()
        version = self.version(spark)
        hit = [r[0] for r in wanted.select(self.bucket().alias("b")).distinct().collect()]  # at most ``buckets`` numbers
        base = self._base(spark, version).filter(F.col("bucket").isin(hit)).drop("bucket")
        return base.unionByName(self._log(spark, version)).join(wanted, "file", "left_semi")

    def append(self, entries: DataFrame, batch_id: int, step: int, last: int | None = None) -> None:
        """Marks row ranges (``whole`` false; the steps from ``step`` to ``last``) or files as done; the same batch and
        step again replaces its rows."""
        rows = entries.select(
            "file", "first_pos", F.lit(step).cast("bigint").alias("step"), "comments", "whole", F.lit(last).cast("bigint").alias("last"),
            F.lit(batch_id).cast("bigint").alias("batch_id"))
        replace_part(rows.coalesce(1), f"{self.path}/log", "batch_id", "step")  # one narrow row per file of a batch

    def compact(self, spark: SparkSession, batch_id: int) -> bool:
        """Merges the log up to ``batch_id`` into a new base if it is due; all of these batches must be complete."""
        before = self.version(spark)
        logged = [n for n in numbered(spark, f"{self.path}/log", "batch_id") if before is None or n > before]
        if len(logged) < self.compact_after:
            return False
        rows = self.entries(spark).filter(F.col("batch_id") <= batch_id)
        finished = rows.filter("whole").groupBy("file", "first_pos").agg(
            F.min_by(F.struct("step", "comments", "whole", "batch_id"), "batch_id").alias("_e"))
        merged = finished.select("file", "first_pos", "_e.*").withColumn("bucket", self.bucket())
        merged.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/version={batch_id}")
        self.clean(spark)
        return True

    def clean(self, spark: SparkSession) -> None:
        """Removes log partitions that the current base holds, and all versions before the last but one."""
        current = self.version(spark)
        if current is None:
            return
        for n in numbered(spark, f"{self.path}/log", "batch_id"):
            if n <= current:
                remove(spark, f"{self.path}/log/batch_id={n}")
        older = [n for n in numbered(spark, f"{self.path}/base", "version") if n < current]
        for n in older[:-1]:
            remove(spark, f"{self.path}/base/version={n}")
