"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from vigil.session import ensure_checkpoint_dir

#: the shuffle files of what is written are removed when it is written: the table replaces them
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: tables with one file a bucket are known to be sorted
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextlib.contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the plans that are made inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _fresh(spark: SparkSession) -> tuple[str, str]:
    name = f"vigil_{uuid.uuid4().hex}"
    return name, f"{ensure_checkpoint_dir(spark)}/{name}"


def fresh_path(spark: SparkSession) -> str:
    """A new folder of the shared folder, not made yet."""
    return _fresh(spark)[1]


def stored(df: DataFrame, *, in_order: bool = False) -> DataFrame:
    """Write once as Parquet under ``spark.checkpoint.dir`` and read back:
    cuts lineage, survives lost executors, and later reads are pruned. With
    ``in_order``, bucketed tables read on the way need no sort by the columns
    that they were sorted by."""
    spark = df.sparkSession
    _, path = _fresh(spark)
    with _set(spark, _CLEANUP, "true"), _set(spark, _ORDERED, str(in_order).lower()):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, *keys: str, order: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """``stored``, bucketed by the keys and sorted by them and ``order``: later
    joins and aggregates on the keys leave these rows where they lie."""
    spark = df.sparkSession
    name, path = _fresh(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _set(spark, _CLEANUP, "true"):
        options = {"path": path} | ({"compression": compression} if compression else {})
        (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order)
           .options(**options).saveAsTable(name))
    return spark.table(name)


def release(table: DataFrame) -> None:
    """Remove a ``stored_by`` table, entry and files, when everything derived
    from it has been stored."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        spark.sql(f"DROP TABLE IF EXISTS {folder.getName()}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
