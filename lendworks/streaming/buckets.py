"""A keyed table kept as versions of hash buckets: a load reads and rewrites only the buckets it touches.

A version is a folder that holds the buckets it rewrote; of every other bucket the newest older version's folder is
still the current one. A version counts once its write has committed, and is never changed afterwards, so readers of
an older version go on and a failed write is simply repeated. Folder names tell all there is to know: no log is kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BUCKETS = 256
_DONE = "_SUCCESS"


class BucketedTable:
    """Rows dealt by ``key`` into ``buckets`` folders a version, ``partition_by`` columns below them.

    The number of buckets belongs to the table: opening it with another one is an error. A bucket must not become
    empty by a rewrite, which holds where rows are changed but never deleted.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = BUCKETS, partition_by: Sequence[str] = ()
    ):
        self.spark, self.schema, self.key, self.buckets, self.partition_by = spark, schema, key, buckets, tuple(partition_by)
        self.path = f"{path}/of={buckets}"
        others = [n for n in self._names(path, "of=") if n != f"of={buckets}"]
        if others:
            raise ValueError(f"{path} is dealt into {others[0].removeprefix('of=')} buckets, not {buckets}")

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str, prefix: str) -> list[str]:
        folder, fs = self._folder(path)
        if not fs.exists(folder):
            return []
        return sorted(n for s in fs.listStatus(folder) if (n := s.getPath().getName()).startswith(prefix))

    def versions(self) -> dict[int, tuple[str, str]]:
        """Number to folder name and tag of every version written to the end."""
        found = {}
        for name in self._names(self.path, "version="):
            folder, fs = self._folder(f"{self.path}/{name}/{_DONE}")
            if fs.exists(folder):
                number, tag = name.removeprefix("version=").split("-", 1)
                found[int(number)] = name, tag
        return found

    def last(self) -> tuple[int, str]:
        """Number and tag of the newest version; 0 before any."""
        versions = self.versions()
        number = max(versions, default=0)
        return number, versions[number][1] if number else ""

    def layout(self, number: int | None = None) -> dict[int, int]:
        """Bucket to the version that holds it, as of version ``number`` or the newest one."""
        versions = self.versions()
        found: dict[int, int] = {}
        for n in sorted(versions):
            if number is None or n <= number:
                found |= {int(b.removeprefix("bucket=")): n for b in self._names(f"{self.path}/{versions[n][0]}", "bucket=")}
        return found

    def bucket(self, column: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if column is None else column), F.lit(self.buckets)).cast("int")

    def buckets_of(self, df: DataFrame, column: str | None = None) -> set[int]:
        """Buckets that the rows' keys fall into; at most all there are."""
        found = df.select(self.bucket(None if column is None else F.col(column)).alias("b")).distinct().collect()
        return {r["b"] for r in found}

    def read(self, buckets: Iterable[int] | None = None, number: int | None = None) -> DataFrame:
        """Rows of a version, of all buckets or some; none before any version."""
        versions, layout = self.versions(), self.layout(number)
        chosen = sorted(layout if buckets is None else set(buckets) & set(layout))
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{versions[layout[b]][0]}/bucket={b}" for b in chosen]
        # The schema tells the types of the columns that folder names hold.
        stored = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        return stored.select(*self.schema.fieldNames())

    def changed_since(self, number: int, until: int | None = None) -> set[int]:
        """Buckets rewritten after version ``number``, up to version ``until``."""
        return {b for b, n in self.layout(until).items() if n > number}

    def write(self, df: DataFrame, number: int, tag: str) -> None:
        """Write a version's buckets; large ones are split among tasks, small ones share a task."""
        dealt = df.select(*self.schema.fieldNames(), self.bucket().alias("bucket")).hint("rebalance", "bucket")
        target = f"{self.path}/version={number:06d}-{tag}"
        dealt.write.mode("overwrite").partitionBy("bucket", *self.partition_by).parquet(target)

    def expire(self, keep: int = 2, needed: Iterable[int] = ()) -> list[str]:
        """Delete buckets that none of the last ``keep`` versions, nor those ``needed``, still shows."""
        versions = self.versions()
        kept = {*sorted(versions)[-max(keep, 1) :], *(n for n in needed if n in versions)}
        shown = {(n, b) for number in kept for b, n in self.layout(number).items()}
        dropped = []
        for n, (name, _) in versions.items():
            for bucket in self._names(f"{self.path}/{name}", "bucket="):
                if (n, int(bucket.removeprefix("bucket="))) not in shown:
                    folder, fs = self._folder(f"{self.path}/{name}/{bucket}")
                    fs.delete(folder, True)
                    dropped.append(f"{name}/{bucket}")
        return dropped
