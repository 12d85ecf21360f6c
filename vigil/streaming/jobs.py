"""Structured Streaming versions of the "process what has no result yet"
polling loops.

* ``stream_transcripts``: new transcript files -> assembled documents. A
  file is one document and the file source never splits a file across
  micro-batches, so assembling inside ``foreachBatch`` is exact.
* ``stream_listing_dedup``: listing rows de-duplicated by video_id against the
  stored listing, however old. ``stream_listing_dedup_within`` keeps the seen
  ids as state, bounded by a watermark: it never reads the listing, but drops
  rows older than the watermark, which the batch ``append_new_listing`` never
  does, so it is a choice of the caller's.
* ``stream_index_upsert``: each batch of incoming index rows is upserted
  into the newest index version and a new version is written.

Every sink write is keyed by ``batch_id`` (overwrite of that batch's
folder), so a batch replayed after a failure rewrites the same output.
Triggers are ``availableNow`` (drain what is there, then stop); a service
would use ``processingTime`` with the same code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.timefn import instant
from vigil.operators.catalog import assemble_text
from vigil.operators.index import index_changed, index_rows, index_table, upsert_delta, upsert_index
from vigil.schemas import LIBRARY_INDEX, SUFFIX_TRANSCRIPT
from vigil.sources import files as FS


def _source(spark, source_dir: str, schema: T.StructType, glob: str,
            max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(source_dir)


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_transcripts(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                       schema: T.StructType, glob: str = f"*{SUFFIX_TRANSCRIPT}",
                       key: str | None = None, order: str = "start", text: str = "text",
                       prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Assemble each new transcript file into one document row. ``key``
    names the document column; None takes it from the file name."""
    src = _source(spark, source_dir, schema, glob)
    if key is None:
        src = src.withColumn("video_id", F.replace(F.col("_metadata.file_name"),
                                                   F.lit(SUFFIX_TRANSCRIPT), F.lit("")))
        key = "video_id"
    if prepare is not None:
        src = prepare(src)

    def batch(df: DataFrame, batch_id: int) -> None:
        FS.write_table(assemble_text(df, key, order, text), f"{out_dir}/batch={batch_id}")

    _run(src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint))


def stream_listing_dedup(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                         schema: T.StructType, glob: str,
                         prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append listing rows whose video_id is not stored yet; of a batch's rows
    with one id the first by its other columns. Seen ids are those of the
    stored listing, so no state grows in memory. A batch has a folder of its
    own, and a replayed batch looks at the others only."""
    src = _source(spark, source_dir, schema, glob)
    if prepare is not None:
        src = prepare(src)

    def batch(df: DataFrame, batch_id: int) -> None:
        rest = [c for c in df.columns if c != "video_id"]
        new = (df.groupBy("video_id").agg(F.min(F.struct(*rest)).alias("_r"))
                 .select("video_id", *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns))
        if FS.path_exists(spark, out_dir):
            stored = spark.read.parquet(out_dir).filter(F.col("batch") != batch_id)
            new = new.join(stored.select("video_id"), "video_id", "left_anti").select(*df.columns)
        FS.write_table(new, f"{out_dir}/batch={batch_id}")

    _run(src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint))


def stream_listing_dedup_within(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                                schema: T.StructType, glob: str, delay: str = "1 day",
                                event_time: str = "published_at",
                                prepare: Callable[[DataFrame], DataFrame] | None = None,
                                max_files: int | None = None) -> None:
    """Append each listing row whose video_id was not seen within ``delay`` of
    event time. The seen ids are the operator's state (kept in the
    checkpoint, over restarts) and are forgotten once the watermark has passed
    them; rows older than the watermark, or without an event time, are
    dropped as late. The file sink commits each batch once."""
    src = _source(spark, source_dir, schema, glob, max_files)
    if prepare is not None:
        src = prepare(src)
    timed = src.withColumn("_event_time", instant(event_time)).withWatermark("_event_time", delay)
    once = timed.filter(F.col("_event_time").isNotNull()).dropDuplicatesWithinWatermark(["video_id"]).drop("_event_time")
    _run(once.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
         .outputMode("append"))


def stream_index_delta(spark: SparkSession, source_dir: str, store_root: str, checkpoint: str,
                       schema: T.StructType, glob: str, to_incoming: Callable[[DataFrame], DataFrame],
                       buckets: int = 64, max_files: int | None = None) -> None:
    """``stream_index_upsert`` onto the keyed index: a batch reads the buckets
    of its paths and writes the rows that it changes. Replaying it changes
    nothing."""
    src = _source(spark, source_dir, schema, glob, max_files)
    table = index_table(spark, store_root, buckets)
    _run(src.writeStream.foreachBatch(lambda df, i: upsert_delta(table, to_incoming(df), f"stream-{i}") and None)
            .option("checkpointLocation", checkpoint))


def upsert_batch(spark: SparkSession, store_root: str, incoming: DataFrame, batch_id: int) -> None:
    """One batch of ``stream_index_upsert``. The actions are decided once and
    stored; a replayed batch reads them again, and writes the index version
    that carries its id only if that is missing."""
    record, tag = f"{store_root}/upserts/batch={batch_id}", f"batch{batch_id}"
    if not FS.path_exists(spark, f"{record}/_SUCCESS"):
        FS.write_table(upsert_index(FS.read_index(spark, store_root), incoming), record)
    up = spark.read.parquet(record)
    done = [v for v in FS.list_versions(spark, f"{store_root}/library_index") if v.endswith(f"-{tag}")]
    if not done and index_changed(up):
        FS.write_version(index_rows(up), f"{store_root}/library_index", tag)


def stream_index_upsert(spark: SparkSession, source_dir: str, store_root: str, checkpoint: str,
                        schema: T.StructType, glob: str,
                        to_incoming: Callable[[DataFrame], DataFrame]) -> None:
    """Upsert each batch of incoming index rows into the newest index
    version; write a new version when anything changed and keep the batch's
    actions under ``upserts/batch=<id>``. Replaying a batch changes nothing."""
    src = _source(spark, source_dir, schema, glob)
    _run(src.writeStream.foreachBatch(lambda df, i: upsert_batch(spark, store_root, to_incoming(df), i))
            .option("checkpointLocation", checkpoint))


# --- runs over the driver's tables (used by the query registry) -------------

def _table_schema(spark, d: str, name: str) -> T.StructType:
    return spark.read.parquet(f"{d}/{name}.parquet").schema


def _table_files(spark, d: str, name: str) -> tuple[str, str]:
    """(folder, pattern of file names) of a table, which is one Parquet file or
    a folder of them."""
    path = f"{d}/{name}.parquet"
    return (path, "*") if FS.is_folder(spark, path) else (d, f"{name}.parquet")


def run_stream_transcripts(spark: SparkSession, d: str) -> DataFrame:
    out, ck = FS.scratch_dir(spark, "stream_docs"), FS.scratch_dir(spark, "stream_docs_ck")

    def prepare(df):
        return df.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("start"), "text")
    source, glob = _table_files(spark, d, "conversations")
    stream_transcripts(spark, source, out, ck, _table_schema(spark, d, "conversations"),
                       glob=glob, key="video_id", prepare=prepare)
    return spark.read.parquet(out).drop("batch")


def run_stream_listing_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The listing arrives in two batches that share a third of their ids."""
    from vigil.plans.standins import listing
    src, out, ck = (FS.scratch_dir(spark, f"stream_listing_{x}") for x in ("in", "out", "ck"))
    rows = listing(spark, d)
    for k in (0, 1):
        part = rows.filter(F.col("video_id") % 3 != k)
        part = part.unionByName(part.filter("video_id % 5 = 0").withColumn("title", F.upper("title")))
        FS.write_table(part, src, mode="append")
        stream_listing_dedup(spark, src, out, ck, part.schema, glob="*.parquet")
    return spark.read.parquet(out).drop("batch")


def run_stream_index_upsert(spark: SparkSession, d: str) -> DataFrame:
    from vigil.plans import standins as SI
    root, ck = FS.scratch_dir(spark, "stream_store"), FS.scratch_dir(spark, "stream_store_ck")
    labels = SI.table(spark, d, "labels")
    current = SI.library_index(spark, d).join(
        labels.select(F.col("doc_id").alias("source_id")), "source_id", "left_semi")
    FS.write_version(FS.conform(current, LIBRARY_INDEX), f"{root}/library_index")
    li = SI.library_index(spark, d)

    def to_incoming(docs: DataFrame) -> DataFrame:
        ids = docs.select(F.col("doc_id").alias("source_id"))
        lb = labels.select(F.col("doc_id").alias("source_id"), "toxic")
        inc = li.join(ids, "source_id", "left_semi").join(lb, "source_id", "left")
        inc = (inc.withColumn("rec_mod_dtm", F.when(F.col("toxic") == 1, "2024-03-01 00:00:00")
                              .otherwise(F.col("rec_mod_dtm")))
                  .withColumn("summary", F.lit("v2")).drop("toxic"))
        return FS.conform(inc, LIBRARY_INDEX).drop("lib_key")
    source, glob = _table_files(spark, d, "documents")
    stream_index_upsert(spark, source, root, ck, _table_schema(spark, d, "documents"),
                        glob=glob, to_incoming=to_incoming)
    return spark.read.parquet(f"{root}/upserts").drop("batch")


def run_stream_listing_dedup_within(spark: SparkSession, d: str) -> DataFrame:
    """The listing arrives in two runs that share a third of their rows; the
    delay covers the whole month, so nothing is late."""
    from vigil.plans.standins import listing
    src, out, ck = (FS.scratch_dir(spark, f"stream_within_{x}") for x in ("in", "out", "ck"))
    rows = listing(spark, d)
    for k in (0, 1):
        part = rows.filter(F.col("video_id") % 3 != k)
        FS.write_table(part, src, mode="append")
        stream_listing_dedup_within(spark, src, out, ck, part.schema, glob="*.parquet", delay="40 days")
    return spark.read.parquet(out)


def run_stream_index_delta(spark: SparkSession, d: str) -> DataFrame:
    """As ``run_stream_index_upsert``, onto the keyed index; the index as it then reads."""
    from vigil.operators.index import load_index
    from vigil.plans.registry import _upsert_inputs
    root, src, ck = (FS.scratch_dir(spark, f"stream_delta_{x}") for x in ("store", "in", "ck"))
    current, incoming = _upsert_inputs(spark, d)
    load_index(index_table(spark, root), current)
    incoming = FS.conform(incoming, LIBRARY_INDEX).drop("lib_key")
    FS.write_table(incoming, src)
    stream_index_delta(spark, src, root, ck, incoming.schema, "*.parquet", lambda df: df)
    return index_table(spark, root).read()
