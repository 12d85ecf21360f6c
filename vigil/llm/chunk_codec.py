"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the bytes cuts every text where its own content says, so
a passage yields the same chunks in whichever document it stands. A chunk that
occurs more than once is encoded once, by the text that owns its first
occurrence, and its ids travel to the others. At every join of a chunk the
pre-tokens around it are encoded anew, and the ids on both sides must agree
with what the chunks hold; then the rest of the chunk's ids stands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.bpe import Encoder, default_tokenizer_path, encoder

WINDOW = 16
KEY = ["h1", "h2"]
CHUNK = ["c1", "c2"]


def cut_points(text: str, bits: int = 10, least: int = 256) -> list[int]:
    """Character offsets of the chunk ends before the end of the text: where
    the hash of the last 16 bytes has ``bits`` zeros, ``least`` bytes apart."""
    import numpy as np
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    if n < WINDOW + least:
        return []
    words = np.ndarray(shape=(n - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0xD6E8FEB86659FD93)
    ends = np.flatnonzero(h >> np.uint64(64 - bits) == 0) + WINDOW
    cuts, last = [], 0
    for e in ends.tolist():
        if e - last >= least:
            while e < n and data[e] & 0xC0 == 0x80:
                e += 1
            if e < n:
                cuts.append(e)
                last = e
    if len(text) != n and cuts:
        starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        cuts = starts[np.array(cuts) - 1].tolist()
    return cuts


def _seam(text: str, p: int) -> tuple[int, int]:
    """The least range around offset p that begins and ends where a pre-token
    must begin (a space after a non-space); empty if p itself is such a place."""
    if text[p] in " \n" and not text[p - 1].isspace():
        return p, p
    q = text.rfind(" ", 0, p)
    while q > 0 and text[q - 1].isspace():
        q = text.rfind(" ", 0, q)
    r = text.find(" ", p + 1)
    while r > 0 and text[r - 1].isspace():
        r = text.find(" ", r + 1)
    return max(q, 0), r if r > 0 else len(text)


def assemble(enc: Encoder, text: str, shared: list[tuple[int, int, bytes]]) -> bytes:
    """Ids of the text from the ids of some of its chunks (offset, length,
    ids): everything else is encoded here, and the joins are repaired."""
    if not shared:
        return enc.encode([text])[0]
    pieces: list[tuple[int, int, bytes | None]] = []
    at = 0
    for pos, length, ids in sorted(shared):
        if pos > at:
            pieces.append((at, pos, None))
        pieces.append((pos, pos + length, ids))
        at = pos + length
    if at < len(text):
        pieces.append((at, len(text), None))
    seams: list[list[int]] = []
    for _, end, _ in pieces[:-1]:
        q, r = _seam(text, end)
        if q < r:
            if seams and q <= seams[-1][1]:
                seams[-1][1] = max(r, seams[-1][1])
            else:
                seams.append([q, r])
    # what remains of each piece between the repaired ranges
    parts: list[tuple[int, int, bytes | None, int, int]] = [(q, r, None, q, r) for q, r in seams]
    k = 0
    for a, b, ids in pieces:
        while k < len(seams) and seams[k][1] <= a:
            k += 1
        lo = seams[k][1] if k < len(seams) and seams[k][0] <= a else a
        j = k
        while j < len(seams) and seams[j][1] < b:
            j += 1
        hi = seams[j][0] if j < len(seams) and seams[j][0] < b else b
        if lo < hi:
            parts.append((lo, hi, ids, a, b))
    parts.sort(key=lambda x: x[0])
    ask: list[str] = []
    for lo, hi, ids, a, b in parts:
        ask += [text[lo:hi]] if ids is None else [text[a:lo], text[hi:b]]
    got = iter(enc.encode(ask))
    out = []
    for _, _, ids, _, _ in parts:
        if ids is None:
            out.append(next(got))
            continue
        head, tail = next(got), next(got)
        if not (ids.startswith(head) and ids.endswith(tail)):  # no agreement: nothing of it is taken over
            return enc.encode([text])[0]
        out.append(ids[len(head):len(ids) - len(tail)])
    return b"".join(out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text's content."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def encode_texts(texts: DataFrame, *, tokenizer: str | None = None, bits: int = 10) -> DataFrame:
    """``texts``: h1, h2, text, one row per key. Returns h1, h2, ids (binary,
    little-endian unsigned 32-bit), decoded (string)."""
    path = tokenizer or default_tokenizer_path()

    def chunks(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        enc = encoder(path)
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for h1, h2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if enc.has_special(text):
                    continue
                a = 0
                for b in [*cut_points(text, bits), len(text)]:
                    c = xxhash.xxh3_128_intdigest(text[a:b].encode("utf-8", "surrogatepass"))
                    for col, v in zip(cols, (h1, h2, a, b - a, _signed(c >> 64), _signed(c & (1 << 64) - 1)), strict=True):
                        col.append(v)
                    a = b
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["h1", "h2", "pos", "len", "c1", "c2"])

    def encode_owned(batches: Iterator) -> Iterator:
        import pyarrow as pa
        enc = encoder(path)
        for batch in batches:
            c1, c2, slices = [], [], []
            for text, owned in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for o in owned:
                    c1.append(o["c1"])
                    c2.append(o["c2"])
                    slices.append(text[o["pos"]:o["pos"] + o["len"]])
            yield pa.RecordBatch.from_arrays([pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                                              pa.array(enc.encode(slices), pa.binary())], ["c1", "c2", "ids"])

    def join_up(batches: Iterator) -> Iterator:
        import pyarrow as pa
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                h1, h2, texts, shared = (c.to_pylist() for c in part.columns)
                alone = [i for i, s in enumerate(shared) if not s]
                ids: list[bytes] = [b""] * len(texts)
                for i, x in zip(alone, enc.encode([texts[i] for i in alone]), strict=True):
                    ids[i] = x
                for i, s in enumerate(shared):
                    if s:
                        ids[i] = assemble(enc, texts[i], [(x["pos"], x["len"], x["ids"]) for x in s])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([enc.decode(x) for x in ids], pa.string())], ["h1", "h2", "ids", "decoded"])

    pieces = texts.select(*KEY, "text").mapInArrow(chunks, "h1 long, h2 long, pos long, len long, c1 long, c2 long")
    repeated = (pieces.groupBy(*CHUNK)
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "pos", "len")).alias("first"))
                .where("n > 1"))
    owned = (repeated.select("first.*", *CHUNK).groupBy(*KEY)
             .agg(F.collect_list(F.struct("pos", "len", *CHUNK)).alias("owned")))
    encoded = (texts.join(owned, KEY).select("text", "owned")
               .mapInArrow(encode_owned, "c1 long, c2 long, ids binary"))
    shared = (pieces.join(encoded, CHUNK).groupBy(*KEY)
              .agg(F.collect_list(F.struct("pos", "len", "ids")).alias("shared")))
    return (texts.join(shared, KEY, "left").select(*KEY, "text", "shared")
            .mapInArrow(join_up, "h1 long, h2 long, ids binary, decoded string"))


def encode_documents(docs: DataFrame, *, tokenizer: str | None = None, bits: int = 10) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document.

    A null text counts as empty; repeated rows and repeated or null doc_ids
    give a row each. Equal texts are encoded once and share the result by
    content, so neither a hot doc_id nor a text copied into a third of the
    rows meets in one task. Other columns are ignored.
    """
    path = tokenizer or default_tokenizer_path()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = rows.select(*text_key(F.col("text")), "text").repartition(*KEY).dropDuplicates(KEY)
    coded = encode_texts(texts, tokenizer=path, bits=bits)

    digests = coded.select(
        *KEY, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
    # the third key gives the join exchanges of its own, so that Spark can split the rows of a much-copied text
    tie = F.xxhash64("h1").alias("h3")
    return (rows.select("doc_id", *text_key(F.col("text"))).select("*", tie)
            .join(digests.select("*", tie), [*KEY, "h3"])
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
