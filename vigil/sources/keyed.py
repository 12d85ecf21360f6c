"""Keyed tables that take changes: merge on read.

A change writes only its own rows, dealt into buckets by a hash of the key, and
a new version of the list of live folders (the manifest). Readers take the
newest row of every key; a bucket that lies in one folder is read as it is.
``compact`` rewrites only buckets that lie in several folders. A change is there
when its manifest version is complete, so a failed job leaves nothing that
readers see, and one that is repeated under the same name is applied once.

Layout under ``root``: ``data/<change>/bucket=<n>/*.parquet``, ``manifest/v=<number>``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.sources import files as FS

MANIFEST = T.StructType([
    T.StructField("folder", T.StringType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("seq", T.LongType()), T.StructField("batch", T.StringType()), T.StructField("note", T.LongType())])


@dataclass(frozen=True)
class KeyedTable:
    """A table of ``schema`` rows, one per non-null value of ``key``."""

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str
    buckets: int = 64

    # --- manifest: a row per live (folder, bucket), and one per batch applied ---

    def _manifest(self) -> list[T.Row]:
        return FS.read_latest(self.spark, f"{self.root}/manifest", MANIFEST).collect()

    def _commit(self, rows: list[tuple]) -> None:
        # one file: a manifest has as many rows as live bucket folders and batches
        FS.write_version(self.spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{self.root}/manifest")

    def batches(self) -> set[str]:
        """Names of the changes applied so far."""
        return {r.batch for r in self._manifest() if r.batch is not None}

    def seq(self) -> int:
        return max((r.seq for r in self._manifest()), default=0)

    def note(self, default: int = 0) -> int:
        """The number that the newest change with one left."""
        noted = [(r.seq, r.note) for r in self._manifest() if r.note is not None]
        return max(noted)[1] if noted else default

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets in which the keys lie: at most as many rows as buckets."""
        return sorted(r.b for r in keys.filter(F.col(self.key).isNotNull()).select(self.bucket().alias("b")).distinct().collect())

    # --- reading ---

    def _load(self, live: Iterable[tuple[str, int]]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("__seq", T.LongType()), T.StructField("__gone", T.BooleanType())])
        paths = [f"{self.root}/data/{folder}/bucket={bucket}" for folder, bucket in sorted(live)]
        return self.spark.read.schema(stored).parquet(*paths) if paths else self.spark.createDataFrame([], stored)

    def _newest(self, rows: DataFrame) -> DataFrame:
        names = self.schema.names
        return (rows.groupBy(F.col(self.key).alias("__key")).agg(F.max_by(F.struct(*names, "__gone"), "__seq").alias("__r"))
                .filter(~F.col("__r.__gone")).select(*[F.col(f"__r.{c}").alias(c) for c in names]))

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The newest row of every key (of the given buckets only)."""
        wanted = None if buckets is None else set(buckets)
        by_bucket: dict[int, list[str]] = {}
        for r in self._manifest():
            if r.folder is not None and (wanted is None or r.bucket in wanted):
                by_bucket.setdefault(r.bucket, []).append(r.folder)
        single = [(f[0], b) for b, f in by_bucket.items() if len(f) == 1]
        several = [(f, b) for b, fs in by_bucket.items() if len(fs) > 1 for f in fs]
        plain = self._load(single).filter(~F.col("__gone")).select(*self.schema.names)
        return plain.unionByName(self._newest(self._load(several))) if several else plain

    # --- changes ---

    def _write(self, rows: DataFrame, folder: str) -> list[int]:
        path = f"{self.root}/data/{folder}"
        (rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
             .write.option("compression", "gzip").partitionBy("bucket").parquet(path))
        p, fs = FS._fs(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket="))

    def change(self, rows: DataFrame, batch: str | None = None, gone: DataFrame | None = None,
               note: int | None = None) -> bool:
        """Put rows (one per key; rows without a key are left out) in the place
        of what the keys hold, and take out the keys of ``gone``. Writes these
        rows alone. False, and nothing done, if ``batch`` was applied before."""
        before = self._manifest()
        if batch is not None and any(r.batch == batch for r in before):
            return False
        seq = max((r.seq for r in before), default=0) + 1
        new = FS.conform(rows, self.schema).withColumns({"__seq": F.lit(seq).cast("long"), "__gone": F.lit(False)})
        if gone is not None:
            keys = FS.conform(gone.select(self.key), self.schema)
            new = new.unionByName(keys.withColumns({"__seq": F.lit(seq).cast("long"), "__gone": F.lit(True)}))
        folder = f"c{seq:012d}-{uuid.uuid4().hex[:8]}"
        written = self._write(new.filter(F.col(self.key).isNotNull()), folder)
        self._commit([tuple(r) for r in before] + [(folder, b, seq, None, None) for b in written]
                     + [(None, None, seq, batch, note)])
        return True

    def compact(self, least: int = 2) -> list[int]:
        """Rewrite the buckets that lie in ``least`` folders or more into one;
        returns them. Other buckets are neither read nor written."""
        before = self._manifest()
        folders: dict[int, list[T.Row]] = {}
        for r in before:
            if r.folder is not None:
                folders.setdefault(r.bucket, []).append(r)
        full = sorted(b for b, rs in folders.items() if len(rs) >= max(least, 2))
        if not full:
            return []
        seq = max(r.seq for r in before)
        merged = self._newest(self._load([(r.folder, b) for b in full for r in folders[b]])).withColumns(
            {"__seq": F.lit(seq).cast("long"), "__gone": F.lit(False)})
        folder = f"m{seq:012d}-{uuid.uuid4().hex[:8]}"
        written = self._write(merged, folder)
        self._commit([tuple(r) for r in before if r.folder is None or r.bucket not in full]
                     + [(folder, b, seq, None, None) for b in written])
        return full

    def vacuum(self, keep: int = 1) -> int:
        """Delete manifest versions but the newest ``keep``, and the data that
        none of those names. Not while a reader of an older version runs."""
        versions = FS.list_versions(self.spark, f"{self.root}/manifest")
        kept = versions[-keep:]
        live = {f"{r.folder}/bucket={r.bucket}" for v in kept
                for r in self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{v}").collect() if r.folder}
        dropped = 0
        p, fs = FS._fs(self.spark, f"{self.root}/data")
        for folder in (fs.listStatus(p) if fs.exists(p) else []):
            parts = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("bucket=")]
            dead = [x for x in parts if f"{folder.getPath().getName()}/{x.getName()}" not in live]
            for x in [folder.getPath()] if len(dead) == len(parts) else dead:
                dropped += bool(fs.delete(x, True))
        for v in versions[:-keep]:
            fs.delete(FS.jvm_path(self.spark, f"{self.root}/manifest/{v}"), True)
        return dropped
