"""Token-id files: every id in the fewest bits that hold the vocabulary.

A file ("shard") holds whole documents and reads on its own::

    magic  8 bytes "VTOKENS1"
    head   7 little-endian unsigned 64-bit numbers: bits of an id, ids of a block,
           part, ids of the part before this file, ids, documents, blocks
    docs   doc_id (signed 64 bits), end (unsigned 64 bits: ids of the file up to
           and with the document), null flag (1 byte) of every document, as three columns
    seek   blocks + 1 unsigned 64-bit offsets of the blocks in the file
    data   the blocks: ids one after the other, lowest bit first, each block
           padded to a whole byte
    end    one line feed

Parts follow one another in ascending doc_id order, and the files of a part do
so by their "ids before". Any run of ids is unpacked by numpy from the blocks that hold it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm.bpe import default_tokenizer_path, encoder
from vigil.llm.storage import fresh_path, stored

MAGIC = b"VTOKENS1"
HEAD = 7


def id_bits(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary of that many ids."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids, bits: int) -> bytes:
    """Ids (numpy, unsigned) in ``bits`` bits each, lowest bit first."""
    import numpy as np
    n = len(ids)
    lanes = np.zeros((-(-n // 8), 8), np.uint64)
    lanes.reshape(-1)[:n] = ids
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):                      # 8 ids fill exactly ``bits`` bytes
        at = lane * bits
        for byte in range(at // 8, (at + bits - 1) // 8 + 1):
            shift = at - 8 * byte
            part = lanes[:, lane] << np.uint64(shift) if shift >= 0 else lanes[:, lane] >> np.uint64(-shift)
            out[:, byte] |= part.astype(np.uint8)
    return out.tobytes()[:(n * bits + 7) // 8]


def unpack_bits(data, n: int, bits: int):
    """The first n ids of ``pack_bits`` output, as numpy unsigned 32-bit."""
    import numpy as np
    rows = -(-n // 8)
    padded = np.zeros(rows * bits, np.uint8)
    raw = np.frombuffer(data, np.uint8)[:rows * bits]
    padded[:len(raw)] = raw
    cells = padded.reshape(rows, bits)
    out = np.empty((rows, 8), np.uint32)
    for lane in range(8):
        at = lane * bits
        value = np.zeros(rows, np.uint64)
        for byte in range(at // 8, (at + bits - 1) // 8 + 1):
            shift = at - 8 * byte
            part = cells[:, byte].astype(np.uint64)
            value |= part >> np.uint64(shift) if shift >= 0 else part << np.uint64(-shift)
        out[:, lane] = (value & np.uint64((1 << bits) - 1)).astype(np.uint32)
    return out.reshape(-1)[:n]


class ShardWriter:
    """Collects whole documents and gives the bytes of a file."""

    def __init__(self, part: int, bits: int, block: int):
        self.part, self.bits, self.block = part, bits, block
        self.before = 0
        self._start()

    def _start(self) -> None:
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        self.ids: list[bytes] = []
        self.n = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.n += len(ids) // 4
        self.doc_ids.append(doc_id)
        self.ends.append(self.n)
        self.ids.append(ids)

    def finish(self) -> bytes:
        """Bytes of the file; the writer then starts the part's next one."""
        import numpy as np
        ids = np.frombuffer(b"".join(self.ids), "<u4")
        blocks = [pack_bits(ids[a:a + self.block], self.bits) for a in range(0, self.n, self.block)]
        docs = (np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + np.array(self.ends, "<u8").tobytes()
                + np.array([d is None for d in self.doc_ids], np.uint8).tobytes())
        head = np.array([self.bits, self.block, self.part, self.before, self.n, len(self.ends), len(blocks)], "<u8")
        at = len(MAGIC) + 8 * HEAD + len(docs) + 8 * (len(blocks) + 1)
        seek = at + np.cumsum([0, *map(len, blocks)])
        out = b"".join([MAGIC, head.tobytes(), docs, seek.astype("<u8").tobytes(), *blocks, b"\n"])
        self.before += self.n
        self._start()
        return out


class Shard:
    """Random access to a file's bytes (bytes, or a memory map)."""

    def __init__(self, data):
        import numpy as np
        self.data = memoryview(data)
        if bytes(self.data[:len(MAGIC)]) != MAGIC:
            raise ValueError("not a token-id file")
        at = len(MAGIC)

        def take(kind: str, n: int):
            nonlocal at
            got = np.frombuffer(self.data, kind, n, at)
            at += got.nbytes
            return got
        self.bits, self.block, self.part, self.before, self.n, self.n_docs, blocks = map(int, take("<u8", HEAD))
        self.doc_ids, self.ends, self.null = take("<i8", self.n_docs), take("<u8", self.n_docs), take("u1", self.n_docs)
        self.seek = take("<u8", blocks + 1)

    def ids(self, start: int, stop: int):
        """Ids start..stop of the file; only their blocks are unpacked."""
        import numpy as np
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        got = [unpack_bits(self.data[int(self.seek[b]):int(self.seek[b + 1])],
                           min(self.block, self.n - b * self.block), self.bits) for b in range(first, last + 1)]
        return np.concatenate(got)[start - first * self.block:stop - first * self.block]

    def bounds(self, k: int) -> tuple[int, int]:
        """Place of the k-th document's ids in the file."""
        return (int(self.ends[k - 1]) if k else 0), int(self.ends[k])

    def document(self, k: int):
        return self.ids(*self.bounds(k))


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = 2,
                 ids_per_file: int = 4_000_000, block: int = 65_536) -> None:
    """Encode every document of ``docs`` (doc_id, text, ...), append ``end_id``
    and write the files under ``path`` in ascending doc_id order.

    Texts are dealt by ranges of doc_id and sorted there (Spark spills), then
    encoded and packed in the task that writes them. Rows of one doc_id are
    ordered by a hash of their text and may lie in several parts, so a hot
    doc_id doesn't meet in one task. A null text counts as empty; a null
    doc_id comes first; repeated rows are documents like any other; an empty
    table gives no file. A file closes with the document that brings it to
    ``ids_per_file`` ids, so a long document only makes its own file long.
    Files go through Spark's own text sink (a file is one record, and the
    sink's line feed its end mark), and so through its file system and commit.
    """
    vocabulary = tokenizer or default_tokenizer_path()

    def files(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        enc = encoder(vocabulary)
        size = enc.tokenizer.get_vocab_size(with_added_tokens=True)
        writer = ShardWriter(TaskContext.get().partitionId(), id_bits(max(size, end_id + 1)), block)
        end = end_id.to_bytes(4, "little")

        def file():
            return pa.RecordBatch.from_arrays([pa.array([writer.finish()], pa.binary())], ["file"])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                doc_ids, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                for doc_id, ids in zip(doc_ids, enc.encode(texts), strict=True):
                    writer.add(doc_id, ids + end)
                    if writer.n >= ids_per_file:
                        yield file()
        if writer.ends:
            yield file()

    # the partition where a row lies splits the equal rows of a hot doc_id
    order = ["doc_id", "__h", "__p"]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumns({"__h": F.xxhash64("text"), "__p": F.spark_partition_id()}))
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(files, "file binary").select(F.col("file").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(path))


ROWS = "doc_id long, part long, at long, n_tokens long, ids_crc32 long"


def read_documents(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, part, at (ids of the part before the document), n_tokens,
    ids_crc32 (and ids, as little-endian unsigned 32-bit) of every document."""
    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_buffer())
                starts = np.concatenate([np.zeros(1, np.int64), shard.ends[:-1].astype(np.int64)])
                for a in range(0, shard.n_docs, 1000):
                    b = min(a + 1000, shard.n_docs)
                    ids = shard.ids(int(starts[a]), int(shard.ends[b - 1])).astype("<u4").tobytes()
                    base = int(starts[a])
                    own = [ids[4 * (s - base):4 * (e - base)]
                           for s, e in zip(starts[a:b].tolist(), shard.ends[a:b].tolist(), strict=True)]
                    cols = [pa.array(shard.doc_ids[a:b], pa.int64(), mask=shard.null[a:b].astype(bool)),
                            pa.array(np.full(b - a, shard.part)), pa.array(starts[a:b] + shard.before),
                            pa.array(shard.ends[a:b].astype(np.int64) - starts[a:b]),
                            pa.array([zlib.crc32(x) for x in own], pa.int64())]
                    names = ["doc_id", "part", "at", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array(own, pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(decode, ROWS + (", ids binary" if with_ids else ""))


def with_starts(rows: DataFrame) -> DataFrame:
    """``read_documents`` rows with start: ids of all documents before. The
    parts' totals are one row per part, so their running sum and its
    broadcast are bounded by the number of parts."""
    totals = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return (rows.join(F.broadcast(bases), "part")
            .withColumn("start", F.col("base") + F.col("at")).drop("base", "part", "at"))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the files of ``docs`` to a new folder under ``spark.checkpoint.dir``
    and return doc_id, start, n_tokens, ids_crc32 as read back from them."""
    spark = docs.sparkSession
    path = fresh_path(spark)
    write_tokens(docs, path, **options)
    return with_starts(stored(read_documents(spark, path))).select("doc_id", "start", "n_tokens", "ids_crc32")
