"""A table with partial updates by key, as a log of changes that is merged now and then.

An update is a folder of Parquet files of its own, divided by buckets of the key. What the table consists of stands in a manifest:
the folders that count, in order, and the versions in each. A new manifest is a new file, so a reader sees the table before an update or after it, and
what a broken attempt leaves behind is in no manifest and never read. If more than ``most`` folders count, they are
merged into one, which holds the newest value of every column.

A version that the table has already is replaced as long as its folder stands alone, and left out once it is merged. One driver writes at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MOST, BUCKETS = 8, 16


class VersionedTable:
    """``path``: a folder in any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str, key: str, most: int = MOST, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.most, self.buckets = spark, path.rstrip("/"), key, most, buckets
        jvm = spark.sparkContext._jvm
        self._of = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        self._fs = self._of("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        if not self._fs.exists(self._of("manifest")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._of("manifest"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def folders(self) -> list[dict]:
        """(name, versions, merged, schema) of the folders that count."""
        numbers = self._manifests()
        if not numbers:
            return []
        return self._read_manifest(numbers[-1])

    def _read_manifest(self, number: int) -> list[dict]:
        return json.loads(self.spark.read.option("wholetext", True).text(f"{self.path}/manifest/{number}.json").first()[0])

    def _commit(self, folders: list[dict]) -> None:
        number = (self._manifests() or [0])[-1] + 1
        part, final = self._of(f"manifest/{number}.part"), self._of(f"manifest/{number}.json")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        if not self._fs.rename(part, final):
            raise RuntimeError(f"{final} is there already: two writers at a time")
        self._clean()

    def _clean(self) -> None:
        """Deletes what neither this manifest nor the one before it names, which a reader may still have."""
        numbers = self._manifests()
        for n in numbers[:-2]:
            self._fs.delete(self._of(f"manifest/{n}.json"), False)
        named = {f["name"] for n in numbers[-2:] for f in self._read_manifest(n)}
        for status in self._fs.listStatus(self._of("")):
            name = status.getPath().getName()
            if name.startswith("d-") and name not in named:
                self._fs.delete(status.getPath(), True)

    def _write(self, rows: DataFrame) -> str:
        name = f"d-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")
        rows.withColumn("_bucket", bucket).repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        return name

    def update(self, rows: DataFrame, version: int) -> None:
        """New rows, and new values of columns of old ones; null means unchanged. Of several rows of a key in one update each column takes its largest value."""
        folders = self.folders()
        if any(version in f["versions"] for f in folders if f["merged"]):
            return
        per = rows.groupBy(self.key).agg(*(F.max(c).alias(c) for c in rows.columns if c != self.key)).withColumn("_version", F.lit(version).cast("long"))
        added = {"name": self._write(per), "versions": [version], "merged": False, "schema": per.schema.json()}
        self._commit([f for f in folders if f["versions"] != [version]] + [added])
        if len(folders) + 1 > self.most:
            self.merge()

    def _rows(self, folders: list[dict]) -> DataFrame | None:
        out = None
        for f in folders:
            part = self.spark.read.schema(StructType.fromJson(json.loads(f["schema"]))).parquet(f"{self.path}/{f['name']}").drop("_bucket")
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def _newest(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c not in (self.key, "_version")]
        return rows.groupBy(self.key).agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_version"))).alias(c) for c in columns), F.max("_version").alias("_version"))

    def merge(self) -> None:
        """All folders into one. Reads as before, whether this ends or not."""
        folders = self.folders()
        if len(folders) < 2:
            return
        newest = self._newest(self._rows(folders))
        name = self._write(newest)
        self._commit([{"name": name, "versions": sorted(v for f in folders for v in f["versions"]), "merged": True, "schema": newest.schema.json()}])

    def read(self) -> DataFrame | None:
        """The newest value of every column of every key; None before the first update."""
        rows = self._rows(self.folders())
        return None if rows is None else self._newest(rows).drop("_version")
