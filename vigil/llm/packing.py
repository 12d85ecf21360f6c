"""Sum-of-squares packing of documents into fixed-length token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from vigil.llm.bpe import default_tokenizer_path, encoder
from vigil.llm.storage import stored

PIECES_SCHEMA = ("doc_id long, piece int, start long, length long, "
                 "ids_crc32 long, ids binary")
PACKED_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                 "sequence_id long, offset long")


def token_pieces(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = 2048,
                 end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``, cut into pieces of
    ``capacity`` only when longer (the first piece is then the short one).

    Null and empty texts are one piece holding ``end_id`` alone. Repeated rows
    and repeated or null doc_ids are documents like any other.
    """
    path = tokenizer or default_tokenizer_path()

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        enc = encoder(path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            cols: list[list] = [[] for _ in range(6)]
            for doc_id, ids in zip(ids_of, enc.encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                first = total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)] if total > capacity else [0, total]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    own = ids[4 * a:4 * b]
                    row = (doc_id, piece, a, b - a, zlib.crc32(own), own if with_ids else None)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                       pa.int64(), pa.binary()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES_SCHEMA)


def sum_of_squares(lengths, capacity: int) -> tuple[list[int], list[int]]:
    """Place items in the given order, each where the sum over residual gaps of
    (open bins with that gap) squared becomes smallest; ties go to the fullest
    bin. Returns each item's bin and offset. Time O(items * capacity), in numpy;
    memory O(items).
    """
    import numpy as np
    count = np.zeros(capacity + 1, dtype=np.int64)      # open bins by fill; 0 and capacity stay 0
    where: list[list[int]] = [[] for _ in range(capacity + 1)]
    never = np.iinfo(np.int64).max
    bins, offsets, made = [], [], 0
    for s in lengths:
        s = int(s)
        # change of the sum: a bin leaves gap class f and enters class f + s;
        # a full bin is closed and leaves the sum
        to = 2 * count[s:capacity + 1] + 1
        to[-1] = 0
        cost = np.where(count[:capacity - s + 1] > 0, to - 2 * count[:capacity - s + 1] + 1, never)
        cost[0] = to[0]                                  # a new bin
        fill = int(len(cost) - 1 - cost[::-1].argmin())
        if fill:
            b = where[fill].pop()
            count[fill] -= 1
        else:
            b, made = made, made + 1
        bins.append(b)
        offsets.append(fill)
        if fill + s < capacity:
            count[fill + s] += 1
            where[fill + s].append(b)
    return bins, offsets


def pack_rounds(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sum-of-squares packing; the part-filled bins are then taken apart and
    their items packed anew in the same way, as long as that saves bins."""
    bins, offsets = sum_of_squares(lengths, capacity)
    while True:
        fill: dict[int, int] = {}
        for b, s in zip(bins, lengths, strict=True):
            fill[b] = fill.get(b, 0) + s
        again = [i for i, b in enumerate(bins) if fill[b] < capacity]
        part = len({bins[i] for i in again})
        new, at = sum_of_squares([lengths[i] for i in again], capacity)
        if part <= max(new, default=-1) + 1:
            return bins, offsets
        base = max(bins) + 1
        for i, b, o in zip(again, new, at, strict=True):
            bins[i], offsets[i] = base + b, o


def pack(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0,
         pieces_per_shard: int = 30_000) -> DataFrame:
    """Pack every document of ``docs`` (doc_id, text, ...) into sequences.

    Documents are tokenized where they lie, and their pieces written once, so
    that a recomputed task deals and packs the same rows alike; only piece
    lengths are shuffled. Shards of about ``pieces_per_shard`` pieces are
    packed independently, so no task grows with the corpus. The pieces of
    part-filled sequences are then dealt to shards of that size anew, as long
    as that leaves fewer shards and saves sequences, so what is left over does
    not grow with their number. Rows are dealt by a number of their own, not
    by a key that may be hot. Within a shard longer pieces go first, ties by
    doc_id, piece, checksum and that number. An empty table gives no rows;
    other columns of ``docs`` are ignored.
    """
    pieces = token_pieces(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id).drop("ids")
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()))
    done: list[DataFrame] = []
    for level in range(64):
        n = pieces.count()
        shards = max(1, -(-n // pieces_per_shard))
        packed = _packed(pieces, shards, level, capacity)
        if shards == 1:
            done.append(packed)
            break
        packed = stored(packed)
        part = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill")).where(F.col("fill") < capacity).select("sequence_id")
        open_ = stored(packed.join(part, "sequence_id", "left_semi"))
        if -(-open_.count() // pieces_per_shard) >= shards:
            done.append(packed)
            break
        done.append(packed.join(part, "sequence_id", "left_anti"))
        pieces = open_.drop("sequence_id", "offset")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("row")


def _packed(pieces: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    """Pieces with sequence_id and offset, packed shard by shard."""
    def place(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32", "row"],
                              ascending=[False, True, True, True, True], kind="stable")
        bins, offsets = pack_rounds(pdf["length"].tolist(), capacity)
        shard = int(pdf["shard"].iloc[0])
        pdf = pdf.drop(columns="shard")
        pdf["sequence_id"] = [(level << 57) + (shard << 32) + b for b in bins]
        pdf["offset"] = offsets
        return pdf

    shard = F.pmod(F.xxhash64(F.lit(level), "row"), F.lit(shards)).cast("int")
    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(
        place, PACKED_SCHEMA.replace("ids_crc32 long,", "ids_crc32 long, row long,"))
