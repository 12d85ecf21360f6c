"""Library-index maintenance: upsert with change detection, dense surrogate
keys, folder refresh, entity/topic index compilation, store set-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.schemas import CLASSIFICATION_COLUMNS, INDEX_TRACKED_COLUMNS, INVENTORY, LIBRARY_INDEX, STORED_CLASSIFICATION
from vigil.session import ensure_checkpoint_dir
from vigil.sources.files import merged
from vigil.sources.keyed import KeyedTable

INDEX_COLUMNS = [f.name for f in LIBRARY_INDEX.fields]
VALUE_COLUMNS = [c for c in INDEX_COLUMNS if c not in ("lib_key", "path")]


def assign_dense_keys(df: DataFrame, order_col: str, start: int,
                      key_col: str = "lib_key", partitions: int | None = None) -> DataFrame:
    """key = start + 1, 2, ... in ``order_col`` order, without a global
    single-partition window: range-partition, checkpoint (reliable, so the
    partition ids stay fixed if an executor is lost), count rows per
    partition, turn the counts into offsets (one row per partition, so the
    broadcast is bounded by the partition count), number rows inside each
    partition."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, F.col(order_col))
                .withColumn("_pid", F.spark_partition_id())
                .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy("_pid").orderBy(F.col(order_col))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(key_col, (F.lit(start) + F.col("_off")
                                        + F.row_number().over(inner)).cast("long"))
                  .drop("_pid", "_off"))


def upsert_index(current: DataFrame, incoming: DataFrame,
                 tracked: list[str] = INDEX_TRACKED_COLUMNS, max_key: int | None = None) -> DataFrame:
    """Merge incoming index rows into the current index by ``path``.

    action = 'insert' (no current row; new lib_key = max key + rank by path),
    'update' (a tracked column differs, null-safe; incoming values, current
    lib_key), or 'keep' (no incoming row, or only untracked columns such as
    summary differ; current row unchanged). Of several incoming rows for one
    path the newest counts (rec_mod_dtm, then the other values). No row is
    ever deleted. New paths are found and numbered on keys alone. ``max_key``
    (if known) spares a pass over the current keys."""
    order = ["rec_mod_dtm", *[c for c in VALUE_COLUMNS if c != "rec_mod_dtm"]]
    inc = incoming.groupBy("path").agg(F.max(F.struct(*order)).alias("_i"))
    cur = current.select("path", F.col("lib_key").alias("_ck"),
                         F.struct(*VALUE_COLUMNS).alias("_c"))
    same = None
    for t in tracked:
        e = F.col(f"_c.{t}").eqNullSafe(F.col(f"_i.{t}"))
        same = e if same is None else same & e
    action = F.when(F.col("_i").isNull() | same, "keep").otherwise("update")
    picked = [F.when(F.col("action") == "keep", F.col(f"_c.{c}")).otherwise(F.col(f"_i.{c}")).alias(c)
              for c in VALUE_COLUMNS]
    old = (cur.join(merged(inc), "path", "left").withColumn("action", action)
              .select(F.col("_ck").alias("lib_key"), "path", "action", *picked))
    if max_key is None:
        max_key = current.agg(F.max("lib_key")).first()[0] or 0
    fresh = incoming.select("path").distinct().join(merged(current.select("path")), "path", "left_anti")
    new = (inc.join(merged(assign_dense_keys(fresh, "path", max_key)), "path")
              .select("lib_key", "path", F.lit("insert").alias("action"),
                      *[F.col(f"_i.{c}").alias(c) for c in VALUE_COLUMNS]))
    return old.select(*INDEX_COLUMNS, "action").unionByName(new.select(*INDEX_COLUMNS, "action"))


def index_changed(upserted: DataFrame) -> bool:
    """True when any row is inserted or updated (a bounded probe)."""
    return upserted.filter(F.col("action") != "keep").limit(1).count() > 0


def index_rows(upserted: DataFrame) -> DataFrame:
    return upserted.select(*INDEX_COLUMNS)


def refresh_index(spark: SparkSession, root: str, write: bool = True) -> DataFrame:
    """Scan the listing folder (doc type 3) and the transcript folder (doc
    type 2), attach stored classifications, upsert into the index; write a
    new index version only when something changed."""
    from vigil.sources import files as src

    inv = src.document_inventory(spark, root)
    clf = src.read_classifications(spark, f"{root}/classifications")
    incoming = (inv.join(merged(clf.withColumnRenamed("video_id", "source_id")), "source_id", "left")
                   .withColumn("sentiment", F.coalesce(F.col("sentiment"), F.lit(False))))
    current = src.read_index(spark, root)
    # the result is written once; the probe, the new version and the caller read it
    path = src.scratch_dir(spark, "upsert")
    src.write_table(upsert_index(current, incoming), path)
    up = spark.read.parquet(path)
    if write and index_changed(up):
        src.write_version(index_rows(up), f"{root}/library_index")
    return up


# --- merge on read -----------------------------------------------------------

def index_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """The library index as a keyed table, by path."""
    return KeyedTable(spark, f"{root}/library_index_keyed", LIBRARY_INDEX, "path", buckets)


def load_index(table: KeyedTable, rows: DataFrame, batch: str = "load") -> bool:
    """Put whole index rows into a new table."""
    high = rows.agg(F.max("lib_key")).first()[0] or 0
    return table.change(rows, batch=batch, note=high)


def upsert_delta(table: KeyedTable, incoming: DataFrame, batch: str,
                 tracked: list[str] = INDEX_TRACKED_COLUMNS) -> DataFrame:
    """``upsert_index`` of one batch, written as a delta: only the buckets of
    the incoming paths are read, and only inserted and updated rows are
    written. Returns the batch's rows of those buckets with their action
    ('keep' rows too). The actions are decided once and kept under
    ``actions/batch=<batch>``; the same batch again changes nothing."""
    from vigil.sources import files as src
    spark = table.spark
    record = f"{table.root}/actions/batch={batch}"
    if not src.path_exists(spark, f"{record}/_SUCCESS"):
        current = table.read(table.buckets_of(incoming))
        actions = upsert_index(current, incoming, tracked, max_key=table.note())
        src.write_table(actions.withColumn("high", F.lit(table.note()).cast("long")), record)
    done = spark.read.parquet(record)
    if batch not in table.batches():
        high = done.agg(F.greatest(F.max("high"), F.max("lib_key"))).first()[0]
        table.change(index_rows(done.filter(F.col("action") != "keep")), batch=batch, note=high or table.note())
    return done.drop("high")


# --- incremental refresh -------------------------------------------------------

def inventory_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """Files seen by the last refresh: path, modification time, length."""
    return KeyedTable(spark, f"{root}/inventory_keyed", INVENTORY, "path", buckets)


def classification_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """What the classification files hold, by document."""
    return KeyedTable(spark, f"{root}/classifications_keyed", STORED_CLASSIFICATION, "source_id", buckets)


def inventory_changes(current: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new or changed files, files that are gone) against the last snapshot;
    a file is unchanged if path, modification time and length are."""
    same = ["path", "modified", "length"]
    return (current.join(merged(known.select(*same)), same, "left_anti"),
            known.join(merged(current.select("path")), "path", "left_anti"))


def refresh_incremental(spark: SparkSession, root: str, buckets: int = 64) -> DataFrame:
    """``refresh_index`` at the cost of what changed: the folders are listed
    (file metadata only) and compared with the inventory of the last
    refresh; only changed classification files are read, only their
    documents and changed listing and transcript files go to the index, and
    only those rows are written. Returns the upsert's rows with their action
    (no rows if no file changed).

    The difference is decided once per refresh and stored, so a refresh that
    failed half-way goes on with the same files; later changes are the next
    refresh's. As in a full refresh, index rows of removed files stay, and a
    document whose classification file is gone loses its labels."""
    from vigil.sources import files as src
    inventory, labels = inventory_table(spark, root, buckets), classification_table(spark, root, buckets)
    index = index_table(spark, root, buckets)
    batch = f"refresh-{inventory.seq() + 1}"
    record = f"{root}/refresh/{batch}"
    if not src.path_exists(spark, f"{record}/gone/_SUCCESS"):
        changed, gone = inventory_changes(src.store_inventory(spark, root), inventory.read())
        src.write_table(changed, f"{record}/changed")
        src.write_table(gone, f"{record}/gone")
    changed = spark.read.schema(INVENTORY).parquet(f"{record}/changed")
    gone = spark.read.schema(INVENTORY).parquet(f"{record}/gone")
    is_label = F.col("doc_type_id").isNull()

    # classification files: those modified before the oldest change aren't opened
    oldest = changed.filter(is_label).agg(F.min(F.unix_micros("modified"))).first()[0]
    lost = gone.filter(is_label).select("source_id").distinct()
    if oldest is not None:
        rows = src.read_classifications(spark, f"{root}/classifications", modified_since=oldest, paths=changed.select("path"))
        labels.change(rows.withColumnRenamed("video_id", "source_id"), batch=batch, gone=lost.join(merged(rows.select(
            F.col("video_id").alias("source_id"))), "source_id", "left_anti"))
    elif not lost.isEmpty():
        labels.change(spark.createDataFrame([], STORED_CLASSIFICATION), batch=batch, gone=lost)

    relabelled = changed.unionByName(gone).filter(is_label).select("source_id").distinct()
    listed = (inventory.read().join(merged(gone.select("path")), "path", "left_anti")
              .join(merged(changed.select("path")), "path", "left_anti"))
    docs = changed.filter(~is_label)
    if oldest is not None or not lost.isEmpty():
        docs = docs.unionByName(listed.filter(~is_label).join(merged(relabelled), "source_id", "left_semi"))
    up = None
    if not docs.isEmpty():
        stored = labels.read(labels.buckets_of(docs)).select("source_id", *CLASSIFICATION_COLUMNS)
        incoming = (docs.withColumn("rec_mod_dtm", src.format_rec_mod_dtm(F.col("modified"))).drop("modified", "length")
                    .join(merged(stored), "source_id", "left").withColumn("sentiment", F.coalesce(F.col("sentiment"), F.lit(False))))
        up = upsert_delta(index, src.conform(incoming, LIBRARY_INDEX).drop("lib_key"), batch)
    if changed.isEmpty() and gone.isEmpty():
        src.remove(spark, record)       # the next refresh has this one's number
    else:
        inventory.change(changed, batch=batch, gone=gone)
    if up is None:
        up = index.read().limit(0).withColumn("action", F.lit("keep"))
    return up


def compile_entity_index(spark: SparkSession, entities_folder: str) -> DataFrame:
    """All per-document entity rows with source_id from the file name."""
    from vigil.sources import files as src
    return src.read_entities(spark, entities_folder)


def compile_topic_index(spark: SparkSession, topics_folder: str) -> DataFrame:
    """All per-document topic rows (the files carry source_id)."""
    from vigil.sources import files as src
    return src.read_topics(spark, topics_folder)
