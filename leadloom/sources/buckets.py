"""A table of keyed rows that changes by small batches: hash buckets, copy on write, a manifest for each version.

    <path>/data/v<version>-<id>/bucket=<b>/*.parquet    rows whose keys hash to b, as a writer of that version wrote them
    <path>/manifests/v<version>.json                    for each bucket the folder that holds it; fields, keys, last batches

An upsert reads and writes only the buckets that its keys hash to, beside the files of earlier versions, and then publishes
the manifest by one rename, which fails if another writer has published that version. Readers take one manifest, so they see one
version whole; a writer that dies leaves files that no manifest names, which ``vacuum`` deletes.

Scale: a batch costs its own rows and those of its buckets, so choose buckets of some 100 MB; one shuffle brings batch rows and
stored rows of a bucket together. The driver holds the manifest, a number for each bucket. There is no row for a key twice, so
a bucket is as even as the hash, whatever a batch repeats: repeats are reduced before the shuffle.

Edge cases: null keys are kept as keys; an empty batch publishes nothing; a batch must have the store's columns (in any order,
others are an error); equal orders within a batch are decided by the other fields, null being least.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


class Conflict(RuntimeError):
    """Another writer has published this version; the batch is to be applied again."""


@dataclass
class Manifest:
    version: int
    keys: list[str]
    order: str
    buckets: int
    schema: str
    #: bucket -> the folder of its files; a bucket without rows is missing
    held: dict[str, str] = field(default_factory=dict)
    #: stream -> its last applied batch
    batches: dict[str, int] = field(default_factory=dict)


class BucketStore:
    """A store at ``path`` (any file system of Spark with atomic renames), made by ``create`` and found again by ``open``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: str, buckets: int = 64) -> BucketStore:
        """An empty store of rows of ``schema``; ``order`` decides between rows of one key."""
        store = cls(spark, path)
        if store.versions():
            raise ValueError(f"there is a store at {path}")
        store._publish(Manifest(0, keys, order, buckets, schema.json()))
        return store

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BucketStore:
        store = cls(spark, path)
        if not store.versions():
            raise ValueError(f"there is no store at {path}")
        return store

    def versions(self) -> list[int]:
        """Published versions, ascending."""
        folder = self._path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.versions()[-1] if version is None else version
        stream = self._fs.open(self._path(f"{self.path}/manifests/v{version}.json"))
        try:
            return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def _publish(self, new: Manifest) -> None:
        self._fs.mkdirs(self._path(f"{self.path}/manifests"))
        draft, target = self._path(f"{self.path}/manifests/.draft-{uuid.uuid4().hex}"), self._path(f"{self.path}/manifests/v{new.version}.json")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(new.__dict__).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise Conflict(f"version {new.version} of {self.path} is there already")

    def _bucket(self, m: Manifest) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in m.keys]), F.lit(m.buckets)).cast("int")

    def _read(self, m: Manifest, buckets: list[int] | None = None) -> DataFrame:
        held = m.held if buckets is None else {str(b): m.held[str(b)] for b in buckets if str(b) in m.held}
        schema = T.StructType.fromJson(json.loads(m.schema))
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{folder}/bucket={b}" for b, folder in sorted(held.items())])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest if None)."""
        return self._read(self.manifest(version))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The newest rows of some keys; only the buckets of these keys are read."""
        m = self.manifest()
        asked = keys.select(*m.keys).distinct()
        buckets = [r[0] for r in asked.select(self._bucket(m)).distinct().collect()]
        same = [F.col(f"s.`{k}`").eqNullSafe(F.col(f"k.`{k}`")) for k in m.keys]
        return self._read(m, buckets).alias("s").join(asked.alias("k"), same, "left_semi")

    def upsert(self, batch: DataFrame, *, keep: list[str] = (), delete: Column | None = None, stream: str | None = None, number: int = -1) -> list[int]:
        """Publish the next version: a key's row with the greatest order wins, of equal ones the batch's; the buckets that were written.

        ``keep`` columns stay as first stored unless they were null; keys whose winning row fulfils ``delete`` leave the store. With
        ``stream`` and ``number`` a batch that has been applied before is passed over, so a stream's batches count exactly once.
        """
        m = self.manifest()
        if stream is not None and number <= m.batches.get(stream, -1):
            return []
        names = T.StructType.fromJson(json.loads(m.schema)).fieldNames()
        if sorted(batch.columns) != sorted(names):
            raise ValueError(f"the store has {names}, the batch {batch.columns}")
        rest = [c for c in names if c not in (*m.keys, m.order)]
        latest = lambda df: df.groupBy(*m.keys).agg(F.max(F.struct(m.order, *rest)).alias("new"))
        new = latest(batch).withColumn("__bucket", self._bucket(m))
        touched = sorted(r[0] for r in new.select("__bucket").distinct().collect())  # a number for each bucket at most
        if not touched:
            return []
        old = self._read(m, touched).select(*m.keys, F.struct(m.order, *rest).alias("old"))
        old = old.withColumn("__bucket", self._bucket(m))
        both = new.withColumn("old", F.lit(None).cast(old.schema["old"].dataType)).unionByName(old.withColumn("new", F.lit(None).cast(new.schema["new"].dataType)))
        one = both.repartition(len(touched), "__bucket").groupBy("__bucket", *m.keys).agg(F.max("new").alias("new"), F.max("old").alias("old"))
        wins = F.col("old").isNull() | (F.col("new").isNotNull() & (F.struct(f"new.{m.order}") >= F.struct(f"old.{m.order}")))
        pick = lambda c: F.when(wins, F.col(f"new.`{c}`")).otherwise(F.col(f"old.`{c}`"))
        kept = lambda c: F.coalesce(F.col(f"old.`{c}`"), F.col(f"new.`{c}`"))
        rows = one.select("__bucket", *[F.col(f"`{c}`") if c in m.keys else (kept(c) if c in keep else pick(c)).alias(c) for c in names])
        if delete is not None:
            rows = rows.where(~F.coalesce(delete, F.lit(False)))
        version = m.version + 1
        folder = f"v{version}-{uuid.uuid4().hex[:12]}"
        rows.withColumnRenamed("__bucket", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        written = {s.getPath().getName()[len("bucket="):] for s in self._fs.listStatus(self._path(f"{self.path}/data/{folder}")) if s.isDirectory()}
        held = {b: f for b, f in m.held.items() if int(b) not in touched} | {b: folder for b in written}
        batches = m.batches | ({stream: number} if stream is not None else {})
        self._publish(Manifest(version, m.keys, m.order, m.buckets, m.schema, held, batches))
        return touched

    def vacuum(self, versions: int = 2) -> list[str]:
        """Delete what only older versions than the last ``versions`` name, and what none does; the data folders that went.

        Not to be run beside a writer, whose files no manifest names yet.
        """
        known = self.versions()
        live = {v for k in known[-versions:] for v in self.manifest(k).held.values()}
        for k in known[:-versions]:
            self._fs.delete(self._path(f"{self.path}/manifests/v{k}.json"), False)
        folder, gone = self._path(f"{self.path}/data"), []
        for s in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            if (name := s.getPath().getName()) not in live:
                self._fs.delete(s.getPath(), True)
                gone.append(name)
        return sorted(gone)

    def fold(self, changes: DataFrame, checkpoint: str, stream: str, *, keep: list[str] = (), retry: Column | None = None, delete: Column | None = None,
             mode: str = "append") -> DataFrame:
        """Fold what is there and not yet done of a stream into the store, each batch once; the newest version.

        Records for which ``retry`` holds (an error that will be tried again) are not stored. Streams of ``stateful`` need the
        output mode update.
        """
        def each(batch: DataFrame, number: int) -> None:
            rows = batch if retry is None else batch.where(~F.coalesce(retry, F.lit(False)))
            self.upsert(rows, keep=keep, delete=delete, stream=stream, number=number)

        changes.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return self.read()
