"""Incrementally kept tables: rows in buckets of their key, and a manifest that says which folder holds each bucket.

An upsert reads and rewrites the buckets that hold a touched key, into folders of their own, and then publishes a new manifest. A
reader follows the newest manifest and so sees all of an upsert or nothing of it; a failed write leaves the manifest, and with it the table, as it
was. Nothing is ever written over, so executors may be lost and tasks retried at any time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingmill.operators.cleaning import first_per_key
from ratingmill.session import stage
from ratingmill.sources.sinks import upsert

_BUCKET = "_bucket"


class ManifestConflict(RuntimeError):
    """Another writer has published the version that this one was going to."""


class BucketTable:
    """A table in ``folder``. The number of buckets is fixed when it is created and bounds the size of a manifest."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- manifests ---------------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("manifests").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        files, folder = self._files(), self._path("manifests")
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> dict:
        """keys, number of buckets, schema, and the folder of every bucket that has rows."""
        if version is None:
            version = self.versions()[-1]
        stream = self._files().open(self._path(f"manifests/{version}.json"))
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def _publish(self, manifest: dict, version: int) -> None:
        files, target = self._files(), self._path(f"manifests/{version}.json")
        draft = self._path(f"manifests/_{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise ManifestConflict(f"version {version} of {self.folder} exists")

    # --- data --------------------------------------------------------------------------------

    def _bucket_of(self, keys: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, keys: Sequence[str], buckets: int) -> dict[str, str]:
        """The folders of the buckets that ``rows`` fill."""
        name = f"data/{uuid.uuid4().hex}"
        bucket = self._bucket_of(keys, buckets).alias(_BUCKET)
        # One file a bucket as long as a task is not overfull; a bucket of many rows becomes several files.
        spread = rows.select("*", bucket).repartition(F.col(_BUCKET))
        spread.write.partitionBy(_BUCKET).parquet(f"{self.folder}/{name}")
        found = [f.getPath().getName() for f in self._files().listStatus(self._path(name)) if f.isDirectory()]
        return {n.removeprefix(f"{_BUCKET}="): f"{name}/{n}" for n in found if n.startswith(f"{_BUCKET}=")}

    def create(self, rows: DataFrame, keys: Sequence[str], buckets: int = 64) -> None:
        """The first version, one row per key (the greatest by all other columns)."""
        rows = first_per_key(rows, keys)
        folders = self._write(rows, keys, buckets)
        self._publish({"keys": list(keys), "buckets": buckets, "schema": rows.schema.json(), "folders": folders}, 1)

    def _read(self, manifest: dict, only: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        chosen = manifest["folders"] if only is None else {str(b): manifest["folders"][str(b)] for b in only if str(b) in manifest["folders"]}
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{p}" for p in chosen.values()])

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one whose data have not been removed."""
        return self._read(self.manifest(version))

    def upsert(self, updates: DataFrame, order: Sequence[Column | str] = ()) -> list[int]:
        """Replace rows of known keys and add the others; of updates that share a key the first by ``order`` counts.

        Returns the buckets written. Columns and types must be those of the table.
        """
        version = self.versions()[-1]
        manifest = self.manifest(version)
        keys, buckets = manifest["keys"], manifest["buckets"]
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        if [(f.name, f.dataType) for f in updates.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"columns {updates.schema.simpleString()} are not those of the table, {schema.simpleString()}")
        updates = stage(updates, "updates")
        # At most one number per bucket.
        touched = sorted(r[0] for r in updates.select(self._bucket_of(keys, buckets)).distinct().collect())
        if not touched:
            return []
        merged = upsert(self._read(manifest, touched), updates, keys, order).select(*schema.names)
        folders = manifest["folders"] | self._write(merged, keys, buckets)
        self._publish(manifest | {"folders": folders}, version + 1)
        return touched

    def add_missing(self, rows: DataFrame) -> list[int]:
        """Add the rows whose key the table does not hold; only their buckets are read and written."""
        manifest = self.manifest()
        keys, buckets = manifest["keys"], manifest["buckets"]
        wanted = sorted(r[0] for r in rows.select(self._bucket_of(keys, buckets)).distinct().collect())
        known = self._read(manifest, wanted).select(*keys)
        return self.upsert(rows.join(known, list(keys), "left_anti").select(*rows.columns))
