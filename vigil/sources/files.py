"""Readers and writers.

Legacy layout: one small Parquet file per document whose name carries the
key (``<id>_transcript.parquet``). One multi-file scan reads a whole folder;
the key comes from ``_metadata.file_name``. Explicit schemas make schema
drift a by-name problem: a missing column reads as null, an old column
name is coalesced into the new one, stray pandas index columns are never
read. After import, tables should be compacted (many documents per file).
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schemas as S
from vigil.functions.text import strip_suffix
from vigil.functions.timefn import format_rec_mod_dtm

NULL_TEXTS = ["None", ""]


# --- CSV dimensions --------------------------------------------------------

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order, cast to its types (missing -> null)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType)
                       .alias(f.name) for f in schema.fields])


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    """Channel dimension CSV (UTF-8, header)."""
    return spark.read.schema(S.CHANNELS).option("header", True).option("encoding", "UTF-8").csv(path)


def read_dim_emotions(spark: SparkSession, path: str) -> DataFrame:
    """Emotion dimension CSV; a UTF-8 BOM before the header is stripped."""
    return spark.read.schema(S.DIM_EMOTIONS).option("header", True).csv(path)


# --- legacy per-document Parquet ----------------------------------------------

def read_keyed(spark: SparkSession, folder: str, suffix: str, schema: T.StructType,
               key: str, modified_since=None, paths: DataFrame | None = None) -> DataFrame:
    """All ``*<suffix>`` files of ``folder`` with ``key`` from the file name;
    with ``modified_since`` (microseconds since 1970) and ``paths`` those among
    ``paths``, none of which is older: older files are left out by their
    metadata, unopened."""
    df = (spark.read.schema(schema).option("pathGlobFilter", f"*{suffix}")
               .option("recursiveFileLookup", False).parquet(folder))
    if modified_since is not None:
        df = df.filter(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(modified_since)))
    if paths is not None:
        df = (df.withColumns({"_path": F.col("_metadata.file_path"), "_name": F.col("_metadata.file_name")})
                .join(merged(paths.select(F.col("path").alias("_path"))), "_path", "left_semi"))
        return df.withColumn(key, strip_suffix(F.col("_name"), suffix)).drop("_path", "_name")
    return df.withColumn(key, strip_suffix(F.col("_metadata.file_name"), suffix))


#: characters that a URI's path holds as they are (beyond letters outside ASCII)
_IN_URI = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-!.~'()*:@&=+$,;")


def _uri_name(name: str) -> str:
    """A file name as ``_metadata.file_name`` spells it (Java's URI quoting)."""
    if _IN_URI.issuperset(name):
        return name
    import unicodedata
    from urllib.parse import quote

    def plain(c):
        return c in _IN_URI or (c >= "\xa0" and unicodedata.category(c) not in ("Zs", "Zl", "Zp"))
    return "".join(c if plain(c) else quote(c, safe="") for c in name)


def _folder_files(uri: str, suffix: str):
    """(name, milliseconds of its last change, length) of a folder's files
    ``*<suffix>``, one after another, as Spark's reader would take them: no
    hidden and no empty ones, none of folders below."""
    from pyarrow import fs as pafs
    filesystem, root = _arrow_fs(uri)

    def found():
        if isinstance(filesystem, pafs.LocalFileSystem):
            import os
            with os.scandir(root) as entries:
                for e in entries:
                    try:
                        at = e.stat() if e.is_file() and e.name.endswith(suffix) else None
                    except FileNotFoundError:       # gone since its name was read
                        continue
                    yield e.name, e.is_file(), at and at.st_mtime_ns, at and at.st_size
        else:
            for e in filesystem.get_file_info(pafs.FileSelector(root)):
                yield e.base_name, e.is_file, e.mtime_ns, e.size
    for name, is_file, changed, length in found():
        if name.startswith(".") or (name.startswith("_") and "=" not in name):
            continue
        if not is_file and "=" in name:
            raise ValueError(f"{uri}/{name}: files of documents lie in one folder, not in partitions")
        if is_file and name.endswith(suffix) and length:
            yield name, changed // 1_000_000, length


_FILES = "path string, uri string, name string, modificationTime timestamp, length long"


def _spark_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", False).load(folder)
            .select("path", F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_name").alias("name"),
                    "modificationTime", "length", "content"))


def _arrow_lists(spark: SparkSession, folder: str) -> bool:
    import pyarrow as pa
    try:
        return is_folder(spark, folder) and _arrow_fs(qualified(spark, folder)) is not None
    except (OSError, pa.ArrowInvalid):      # a scheme that Arrow doesn't know here
        return False


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, uri, name, modificationTime, length) of the files ``*<suffix>`` of
    a folder as they are now; uri and name are spelt as in ``_metadata``, path
    as in a ``binaryFile`` scan. Spark's readers hold every file of a folder on
    the driver. Here a task streams the folder's entries (a listing is one
    stream in any file system) into a table, and the driver sees that table
    only. A file system that Arrow doesn't know, and a path that is no folder,
    are listed by Spark."""
    if not _arrow_lists(spark, folder):
        return _spark_files(spark, folder, suffix).drop("content")
    root = qualified(spark, folder).rstrip("/")
    base = str(jvm_path(spark, root).toUri().toString()).rstrip("/")

    def entries(batches, most=20_000):
        import pyarrow as pa
        fields = ["path", "uri", "name", "changed", "length"]
        for _ in batches:
            rows = []
            for name, changed, length in _folder_files(root, suffix):
                spelt = _uri_name(name)
                rows.append((f"{root}/{name}", f"{base}/{spelt}", spelt, changed, length))
                if len(rows) == most:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], fields)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], fields)
    found = spark.range(0, 1, 1, 1).mapInArrow(entries, "path string, uri string, name string, changed long, length long")
    table = scratch_dir(spark, "files")
    write_scratch(found.select("path", "uri", "name", F.timestamp_millis("changed").alias("modificationTime"), "length"), table)
    return spark.read.schema(_FILES).parquet(table)


def merged(rows: DataFrame) -> DataFrame:
    """Rows of files, or of the index, as the other side of a join. They grow
    with the store, and a long path takes hundreds of bytes in memory but about
    ten in a compressed file, by whose size Spark would choose to send
    them to every task through the driver. So such joins are merged."""
    return rows.hint("merge")


def read_documents(spark: SparkSession, folder: str, suffix: str, schema: T.StructType,
                   key: str | None = None, modified_since=None, paths: DataFrame | None = None) -> DataFrame:
    """``read_keyed`` for files of one document each (``key`` None: the files
    carry it). To open a file costs Spark's Parquet reader many times what its
    few rows do, it gives a task 32 files at most, and it holds every file on
    the driver. So the folder is listed by ``list_files``, and the bytes are
    read as they lie, by a fixed number of tasks, and decoded by Arrow in
    batches of files. A file is one value there (2 GB at most); listings,
    which hold a whole channel, are read by ``read_keyed``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    root = qualified(spark, folder).rstrip("/")
    named = _arrow_lists(spark, folder)
    files = list_files(spark, folder, suffix) if named else _spark_files(spark, folder, suffix)
    if modified_since is not None:
        files = files.filter(F.col("modificationTime") >= F.timestamp_micros(F.lit(modified_since)))
    if paths is not None:
        files = files.join(merged(paths.select(F.col("path").alias("uri"))), "uri", "left_semi")
    df = files.select(F.col("uri").alias("_path"), F.col("name").alias("_name"), F.col("path" if named else "content").alias("_file"))
    df = df.repartition(tasks, "_path") if named else df.coalesce(tasks)
    names = T.StructType([T.StructField(c, T.StringType()) for c in ("_path", "_name")])
    out = T.StructType(names.fields + schema.fields)
    want = to_arrow_schema(schema)
    declared = to_arrow_schema(out)

    def decode(batches, most=20_000):
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq

        def column(table, field, path):
            at = [i for i, c in enumerate(table.schema.names) if c.lower() == field.name.lower()]
            if not at:
                return pa.chunked_array([pa.nulls(table.num_rows, field.type)])
            found = table.column(at[0])
            if pa.types.is_dictionary(found.type):
                found = found.cast(found.type.value_type)
            is_text = [pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_binary(t) for t in (found.type, field.type)]
            if is_text[0] != is_text[1] and not pa.types.is_null(found.type):
                raise ValueError(f"{path}: {field.name} is {found.type}, not {field.type}")
            return found.cast(field.type)

        def rows_of(own, tables):
            at = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
            whole = pa.concat_tables(tables).combine_chunks()
            files = [pa.array(x, pa.string()).take(pa.array(at)) for x in zip(*own)]
            return pa.Table.from_arrays([*files, *whole.columns], schema=declared).to_batches(most)
        own, tables, rows = [], [], 0
        filesystem, at = _arrow_fs(root) if named else (None, None)

        def content(file):
            if not named:
                return file.as_buffer()
            with filesystem.open_input_file(at + file.as_py()[len(root):]) as f:
                return f.read_buffer()
        for batch in batches:
            for path, name, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                table = pq.ParquetFile(pa.BufferReader(content(file))).read(use_threads=False)
                if not table.num_rows:
                    continue
                if not table.schema.equals(want):
                    table = pa.Table.from_arrays([column(table, f, path) for f in want], schema=want)
                own.append((path, name))
                tables.append(table)
                rows += table.num_rows
                if rows >= most:
                    yield from rows_of(own, tables)
                    own, tables, rows = [], [], 0
        if tables:
            yield from rows_of(own, tables)

    df = df.mapInArrow(decode, out)
    if key is not None:
        df = df.withColumn(key, strip_suffix(F.col("_name"), suffix))
    return df.drop("_path", "_name")


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Caption segments (video_id, start, duration, text); legacy files name
    the text column ``transcript``."""
    schema = T.StructType(S.TRANSCRIPT_SEGMENT.fields + [T.StructField("transcript", T.StringType())])
    df = read_documents(spark, folder, S.SUFFIX_TRANSCRIPT, schema, "video_id")
    return df.select("video_id", "start", "duration",
                     F.coalesce(F.col("text"), F.col("transcript")).alias("text"))


def read_channel_search(spark: SparkSession, folder: str) -> DataFrame:
    """Channel listings; channel_id from the file name."""
    schema = T.StructType([f for f in S.CHANNEL_SEARCH.fields if f.name != "channel_id"])
    df = read_keyed(spark, folder, S.SUFFIX_SEARCH, schema, "channel_id")
    return df.select("video_id", "title", "published_at", "channel_id", "code")


def normalize_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The text 'None' and '' become NULL (one missing-value convention)."""
    for c in columns:
        df = df.withColumn(c, F.when(~F.col(c).isin(*NULL_TEXTS), F.col(c)))
    return df


def read_classifications(spark: SparkSession, folder: str, modified_since=None,
                         paths: DataFrame | None = None) -> DataFrame:
    """Per-document classification records; missing columns read as null.
    ``modified_since`` and ``paths`` as in ``read_keyed``."""
    df = read_documents(spark, folder, S.SUFFIX_CLASSIFICATION, S.CLASSIFICATION, "video_id", modified_since, paths)
    text_cols = [c for c in S.CLASSIFICATION_COLUMNS if c != "sentiment"]
    return normalize_missing(df, text_cols).select("video_id", *S.CLASSIFICATION_COLUMNS)


def read_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Per-document entity rows; the stray pandas index column is not read."""
    return read_documents(spark, folder, S.SUFFIX_ENTITIES, S.ENTITIES, "source_id").select(
        "entity_type", "value", "source_id")


def read_topics(spark: SparkSession, folder: str) -> DataFrame:
    return read_documents(spark, folder, S.SUFFIX_TOPICS, S.TOPICS).select("topic", "source_id")


def read_skip_list(spark: SparkSession, path: str) -> DataFrame:
    """Skip list with a declared string id (an empty legacy file types it
    double, which a schema merge would reject)."""
    return spark.read.schema(S.SKIP_LIST).parquet(path).select("video_id").distinct()


# --- file inventory --------------------------------------------------------

def file_inventory(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, source_id, rec_mod_dtm, length) of the files in a folder; only
    file metadata is read (the content column is pruned)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
               .load(folder).select("path", "modificationTime", "length"))
    return _inventory(df, suffix)


def _inventory(files: DataFrame, suffix: str) -> DataFrame:
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return files.select("path", strip_suffix(name, suffix).alias("source_id"),
                        format_rec_mod_dtm(F.col("modificationTime")).alias("rec_mod_dtm"),
                        "length")


def document_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``file_inventory`` of a folder with a file for every document: listed by
    a task (``list_files``), not on the driver."""
    return _inventory(list_files(spark, folder, suffix), suffix)


def document_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Index candidates: listing files (type 3) and transcripts (type 2)."""
    def part(sub, suffix, doc_type):
        return (document_files(spark, f"{root}/{sub}", suffix)
                .withColumn("doc_type_id", F.lit(S.DOC_TYPES[doc_type]))
                .withColumn("source_system_id", F.lit(S.SOURCE_SYSTEMS["youtube"])))
    out = None
    for sub, suffix, dt in [("channels", S.SUFFIX_SEARCH, "youtube channel search"),
                            ("transcripts", S.SUFFIX_TRANSCRIPT, "transcript")]:
        if path_exists(spark, f"{root}/{sub}"):
            p = part(sub, suffix, dt)
            out = p if out is None else out.unionByName(p)
    if out is None:
        out = spark.createDataFrame([], "path string, source_id string, rec_mod_dtm string, "
                                        "length long, doc_type_id int, source_system_id int")
    return out.drop("length")


def store_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, source_id, modified, length, doc_type_id, source_system_id) of
    the listing, transcript and classification files of a store, from file
    metadata alone; classification files have no document type."""
    out = spark.createDataFrame([], S.INVENTORY)
    for sub, suffix, kind in [("channels", S.SUFFIX_SEARCH, "youtube channel search"),
                              ("transcripts", S.SUFFIX_TRANSCRIPT, "transcript"), ("classifications", S.SUFFIX_CLASSIFICATION, None)]:
        if path_exists(spark, f"{root}/{sub}"):
            seen = list_files(spark, f"{root}/{sub}", suffix).select(F.col("uri").alias("path"), "modificationTime", "length")
            name = F.element_at(F.split(F.col("path"), "/"), -1)
            out = out.unionByName(seen.select(
                "path", strip_suffix(name, suffix).alias("source_id"), F.col("modificationTime").alias("modified"), "length",
                F.lit(S.DOC_TYPES[kind] if kind else None).cast("int").alias("doc_type_id"),
                F.lit(S.SOURCE_SYSTEMS["youtube"]).alias("source_system_id")))
    return out


# --- search pages (nested JSON) ---------------------------------------------

def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search responses (JSON lines) -> one row per item; pages with
    no items keep one row of nulls (explode_outer); nextPageToken optional."""
    return _page_items(spark.read.schema(S.SEARCH_PAGE).json(path))


def _page_items(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("kind").alias("page_kind"), F.col("etag").alias("page_etag"),
                        "regionCode", "nextPageToken",
                        F.explode_outer("items").alias("item")).select(
        "page_kind", "page_etag", "regionCode", "nextPageToken", "item.*")


def read_search_pages_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(items, rejects): ``read_search_pages`` of the lines that hold a search
    response, and (file, line) of those that don't parse or are no object of
    the declared types, as text. Empty lines are neither."""
    schema = T.StructType([*S.SEARCH_PAGE.fields, T.StructField("_line", T.StringType())])
    parsed = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").json(path)
              .withColumn("_file", F.col("_metadata.file_name")))
    # parsed once with all columns: a reader of fewer columns would look at fewer fields of a line
    table = scratch_dir(spark, "search_pages")
    write_scratch(parsed, table)
    pages = spark.read.parquet(table)
    return (_page_items(pages.filter(F.col("_line").isNull())),
            pages.filter(F.col("_line").isNotNull()).select(F.col("_file").alias("file"), F.col("_line").alias("line")))


# --- writers ----------------------------------------------------------------

def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """gzip Parquet (dictionary encoding is the Parquet writer's default)."""
    df.write.mode(mode).option("compression", "gzip").parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, as_it_lies: bool = False) -> DataFrame:
    """Write a table bucketed by ``key`` under ``path`` and read it: joins and
    aggregates on the key leave its rows where they lie. Its catalog entry is
    named after the path, so that writing the path again replaces it
    (``drop_bucketed`` takes the entry out). A hot key's rows are written by
    several tasks, into several files of its bucket. ``as_it_lies``: the rows
    are in such buckets already (a join of two such tables), nothing is moved."""
    spark = df.sparkSession
    name = _bucketed_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, path)
    ((df if as_it_lies else df.hint("rebalance", key)).write.format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return spark.table(name)


def _bucketed_name(path: str) -> str:
    return f"vigil_{hashlib.sha256(path.encode()).hexdigest()[:20]}"


def drop_bucketed(spark: SparkSession, path: str) -> None:
    """Take a bucketed table's entry out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(path)}")


def write_scratch(df: DataFrame, path: str, codec: str = "lz4") -> None:
    """An intermediate table: read again at once, so a light codec."""
    df.write.option("compression", codec).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if it isn't there."""
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True))


def list_versions(spark: SparkSession, root: str) -> list[str]:
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("v=") and
                  fs.exists(jvm_path(spark, f"{root}/{n}/_SUCCESS")))


def jvm_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def next_version(spark: SparkSession, root: str) -> str:
    """Folder name above every version before it, whatever the driver's clock says."""
    last = max([int(v[2:17]) for v in list_versions(spark, root)], default=0)
    return f"v={max(int(time.time() * 1000), last + 1):015d}"


def write_version(df: DataFrame, root: str, tag: str = "") -> str:
    """Write a table that is also an input as a new version folder; readers
    take the newest complete one. Overwriting a path that the same plan
    reads would delete the input before it is read."""
    target = f"{root}/{next_version(df.sparkSession, root)}{'-' + tag if tag else ''}"
    write_table(df, target, mode="errorifexists")
    return target


def read_latest(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    versions = list_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{versions[-1]}")


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """Newest version of the library index (empty with schema if none)."""
    return read_latest(spark, f"{root}/library_index", S.LIBRARY_INDEX)


def init_store(spark: SparkSession, root: str) -> None:
    """Empty library index and skip list with their schemas."""
    if not list_versions(spark, f"{root}/library_index"):
        write_version(spark.createDataFrame([], S.LIBRARY_INDEX), f"{root}/library_index")
    if not path_exists(spark, f"{root}/transcript_skip"):
        write_table(spark.createDataFrame([], S.SKIP_LIST), f"{root}/transcript_skip")


def append_skip_list(spark: SparkSession, ids: DataFrame, root: str) -> None:
    """Append ids that could not be fetched."""
    write_table(ids.select(F.col("video_id").cast("string")), f"{root}/transcript_skip",
                mode="append")


# --- legacy per-document writer -------------------------------------------------

def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Spark gives it: one without
    a scheme belongs to the cluster's default file system, not to a machine."""
    p, fs = _fs(spark, path)
    return str(fs.makeQualified(p).toString())


def _arrow_fs(uri: str):
    """File system and path of a qualified folder, inside a task."""
    from pyarrow import fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_per_document(df: DataFrame, key: str, folder: str, suffix: str) -> int:
    """Write the legacy layout: one gzip Parquet file ``<key><suffix>`` per
    key value, without the key column. Rows are hash-partitioned and sorted
    by key; each task streams its keys in order into one open writer at a
    time, so no document's rows are gathered in memory. A file costs the same
    however few bytes it holds, so the number of tasks is fixed: adaptive
    execution would merge small rows into a single task. A file gets its name
    when it is complete, so a retried task leaves no half file. A null key is
    an error. The folder is resolved as Spark resolves it, so tasks write where
    Spark reads. Workers need this package (``--py-files``). Returns rows written."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    folder = qualified(spark, folder)

    cols = [c for c in df.columns if c != key]
    arrow_schema = to_arrow_schema(df.select(*cols).schema)

    def writer(batches):
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        filesystem, root = _arrow_fs(folder)
        filesystem.create_dir(root, recursive=True)
        cur, w, n = None, None, 0

        def done():
            w.close()
            filesystem.move(f"{root}/{tmp}", f"{root}/{cur}{suffix}")
            return pa.RecordBatch.from_pydict({"key": [cur], "rows": [n]}, pa.schema({"key": pa.string(), "rows": pa.int64()}))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(batch.schema.names.index(key))
            if keys.null_count:
                raise ValueError(f"null {key}: such rows have no file to go to")
            changes = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1
            starts = [0, *changes.tolist()]
            rows = pa.Table.from_batches([batch]).select(cols).cast(arrow_schema)
            for at, end in zip(starts, [*starts[1:], len(keys)]):
                k = str(keys[at].as_py())
                if k != cur:
                    if w is not None:
                        yield done()
                    cur, n = k, 0
                    tmp = f"_{uuid.uuid4().hex}.tmp"
                    w = pq.ParquetWriter(f"{root}/{tmp}", arrow_schema,
                                         filesystem=filesystem, compression="gzip")
                w.write_table(rows.slice(at, end - at))
                n += end - at
        if w is not None:
            yield done()

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = (df.repartition(tasks, key).sortWithinPartitions(key)
             .mapInArrow(writer, "key string, rows long"))
    return out.agg(F.sum("rows")).first()[0] or 0


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the reliable checkpoint directory (shared
    storage on a cluster) for intermediate tables."""
    import uuid

    from vigil.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/vigil-scratch/{name}-{uuid.uuid4().hex}"


def compact_legacy_store(spark: SparkSession, root: str, out_root: str,
                         files_per_table: int | None = None) -> dict[str, str]:
    """Import a legacy store (one small file per document) into compact
    tables holding many documents per file: transcripts (segments),
    classifications, entities and topics, keyed by document; listings
    partitioned by channel. Each table is written as a new version folder;
    returns table -> written path. Later jobs read these tables instead of
    opening thousands of tiny files."""
    n = files_per_table or spark.sparkContext.defaultParallelism
    readers = {
        "transcripts": (lambda: read_transcripts(spark, f"{root}/transcripts"), "video_id"),
        "classifications": (lambda: read_classifications(spark, f"{root}/classifications"),
                            "video_id"),
        "entities": (lambda: read_entities(spark, f"{root}/entities"), "source_id"),
        "topics": (lambda: read_topics(spark, f"{root}/topics"), "source_id"),
    }
    written = {}
    for name, (read, key) in readers.items():
        if path_exists(spark, f"{root}/{name}"):
            written[name] = write_version(read().repartition(n, key), f"{out_root}/{name}")
    if path_exists(spark, f"{root}/channels"):
        target = f"{out_root}/channel_search/{next_version(spark, f'{out_root}/channel_search')}"
        # a channel may own a third of the listing: its rows are spread, by video
        (read_channel_search(spark, f"{root}/channels").repartition(n, F.xxhash64("video_id")).write
            .mode("errorifexists").option("compression", "gzip").partitionBy("channel_id")
            .parquet(target))
        written["channel_search"] = target
    return written
