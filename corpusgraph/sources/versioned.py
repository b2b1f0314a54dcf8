"""A table of one row per key that is changed batch by batch and read without its history.

Rows lie in buckets by key. A batch rewrites the buckets it touches into a new
version's folder; a manifest then names, for every bucket, the version that
holds it, and is put in place by one rename, so a reader sees all of a batch
or nothing of it. A manifest also remembers the last batch of every source: one
that is tried again after it was published changes nothing, and one that was
lost half way is written anew. One writer at a time, as a streaming query is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "_bucket"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def create(self, schema: T.StructType, keys: Sequence[str], buckets: int) -> VersionedTable:
        """An empty table, unless there is one; `buckets` is for good and bounds the manifest."""
        if self.manifest() is None:
            self._publish({"version": 0, "batches": {}, "keys": list(keys), "buckets": buckets, "schema": schema.jsonValue(), "at": {}, "notes": {}})
        return self

    def manifest(self) -> dict | None:
        """The newest manifest."""
        folder = self._path(f"{self.root}/manifest")
        if not self._store.exists(folder):
            return None
        names = [s.getPath().getName() for s in self._store.listStatus(folder)]
        numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))
        if not numbers:
            return None
        stream = self._store.open(self._path(f"{self.root}/manifest/{numbers[-1]}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        aside = self._path(f"{self.root}/manifest/.{uuid.uuid4().hex}")
        stream = self._store.create(aside, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        place = self._path(f"{self.root}/manifest/{manifest['version']}.json")
        if self._store.exists(place) or not self._store.rename(aside, place):
            raise RuntimeError(f"another writer has published version {manifest['version']} of {self.root}")

    def _rows(self, manifest: dict, buckets: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.root}/data/{manifest['at'][b]}/{_BUCKET}={b}" for b in buckets if b in manifest["at"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """The current rows; files of older versions are not looked at."""
        manifest = self.manifest()
        if manifest is None:
            raise ValueError(f"{self.root} is no table")
        return self._rows(manifest, sorted(manifest["at"], key=int))

    def apply(self, delta: DataFrame, batch: int, combine: Callable[[DataFrame, DataFrame], DataFrame], source: str = "", notes: dict | None = None) -> bool:
        """Replace the rows of the buckets that `delta` touches by combine(rows, delta); False if the source's batch was applied before.

        `combine` gets whole buckets and returns one row per key. Batches of a source have rising numbers.
        """
        old = self.manifest()
        if batch <= old["batches"].get(source, -1):
            return False
        schema = T.StructType.fromJson(old["schema"])
        bucket = F.pmod(F.xxhash64(*old["keys"]), F.lit(old["buckets"])).alias(_BUCKET)
        # At most as many numbers as there are buckets.
        touched = [str(r[0]) for r in delta.select(bucket).distinct().collect()]
        # A batch that failed half way may have left files: its folder is named anew.
        name = f"{old['version'] + 1}-{uuid.uuid4().hex[:8]}"
        if touched:
            made = combine(self._rows(old, touched), delta).select(*schema.names)
            made.withColumn(_BUCKET, bucket).repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.root}/data/{name}")
        at, batches = {**old["at"], **dict.fromkeys(touched, name)}, {**old["batches"], source: batch}
        self._publish({**old, "version": old["version"] + 1, "batches": batches, "at": at, "notes": {**old["notes"], **(notes or {})}})
        return True

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._store.listStatus(path)] if self._store.exists(path) else []

    def vacuum(self) -> int:
        """Delete the buckets and manifests that the newest manifest does not need; returns how many buckets went."""
        manifest, gone = self.manifest(), 0
        needed = {f"{version}/{_BUCKET}={b}" for b, version in manifest["at"].items()}
        for version in self._names(f"{self.root}/data"):
            buckets = [n for n in self._names(f"{self.root}/data/{version}") if n.startswith(f"{_BUCKET}=")]
            old = [b for b in buckets if f"{version}/{b}" not in needed]
            for name in old if len(old) < len(buckets) else [""]:
                self._store.delete(self._path(f"{self.root}/data/{version}/{name}".rstrip("/")), True)
            gone += len(old)
        for name in self._names(f"{self.root}/manifest"):
            if name != f"{manifest['version']}.json":
                self._store.delete(self._path(f"{self.root}/manifest/{name}"), True)
        return gone
