"""Phrase collocations counted over a prefix-free parse of the corpus.

Every text is cut into chunks at content triggers (a hash of the 16 bytes before
a word's end), so a passage yields the same chunks wherever it stands, and
consecutive chunks overlap by ``most - 1`` words. The distinct chunks of a
language with their frequencies are the dictionary; phrases are counted inside
its chunks only, weighted by frequency. A phrase belongs to the chunk in which
it starts before the overlap, so each occurrence counts once.

Words are counted first, then pairs of frequent words, then longer phrases of
frequent pairs. What is frequent is known to the tasks as a bitmap of fixed
size (``filter_bits``): what it lets through wrongly is counted and then
dropped, so it bears on the cost and never on the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.storage import stored

WINDOW = 16
_LOWER = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))
_BREAK = re.compile(rb" *\n[ \n]*")
_SPACES = re.compile(rb"  +")


def normal(text: bytes) -> bytes:
    """Lower-cased words with one space between them and one line feed between pieces."""
    return _SPACES.sub(b" ", _BREAK.sub(b"\n", text.translate(_LOWER))).strip(b" \n")


def parse(data: bytes, overlap: int = 3, bits: int = 5, least: int = 12, longest: int = 4096) -> list[tuple[bytes, bool]]:
    """Chunks of a normal text, each with a flag on the last: a chunk ends with
    a word at whose end the hash of the last 16 bytes has ``bits`` zeros,
    ``least`` words or more after the chunk before (or ``longest`` words after
    it), and the next one starts with the last ``overlap`` words of it."""
    import numpy as np
    if not data:
        return []
    if len(data) <= WINDOW:
        return [(data, True)]
    raw = np.frombuffer(data, np.uint8)
    gaps = np.flatnonzero((raw == 32) | (raw == 10))
    at = gaps[gaps >= WINDOW] - WINDOW
    words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = words[at] * np.uint64(0x9E3779B97F4A7C15)
    h ^= words[at + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0xD6E8FEB86659FD93)
    hits = np.flatnonzero(h >> np.uint64(64 - bits) == 0) + (len(gaps) - len(at))
    out, start, last = [], 0, -1
    for hit in [*hits.tolist(), len(gaps)]:          # a word ends at gaps[its number]
        while hit - last > longest:
            last += longest
            out.append((data[start:int(gaps[last])], False))
            start = int(gaps[last - overlap]) + 1
        if hit - last >= least and hit < len(gaps):
            out.append((data[start:int(gaps[hit])], False))
            last = hit
            start = int(gaps[hit - overlap]) + 1
    out.append((data[start:], True))
    return out


class Words:
    """The words of an array of normal texts, laid out for numpy: where they
    start and end in ``data``, which text they are of, whether the next word
    stands in the same piece, and two 64-bit hashes of each, by language."""

    #: words beyond so many bytes are hashed one by one
    LONG = 1 << 16

    def __init__(self, texts, langs: list[str]):
        import numpy as np
        import xxhash
        n = len(texts)
        _, ends, data = texts.buffers()
        at = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
        self.data = data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if n else np.empty(0, np.uint8)
        at -= at[0] if n else 0
        gap = (data == 32) | (data == 10)
        gaps = np.flatnonzero(gap)
        self.starts = starts = np.sort(np.concatenate([at[:-1], gaps + 1]))
        self.ends = ends = np.sort(np.concatenate([gaps, at[1:]]))
        self.first = np.searchsorted(starts, at[:-1])
        self.count = np.diff(np.append(self.first, len(starts)))
        self.text = np.repeat(np.arange(n), self.count)
        self.linked = np.zeros(len(starts), bool)
        self.linked[:-1] = data[ends[:-1]] == 32
        self.length = ends - starts

        names = sorted(set(langs))
        seed = {x: np.uint64(xxhash.xxh64_intdigest(x)) for x in names}
        seeds = np.array([seed[x] for x in langs], np.uint64)[self.text]
        place = (np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))).clip(max=self.LONG)
        self.h1, self.h2 = (self._hashed(place, gap, seeds, base) for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
        for w in np.flatnonzero(self.length > self.LONG).tolist():
            word = data[starts[w]:ends[w]].tobytes()
            self.h1[w], self.h2[w] = (xxhash.xxh64_intdigest(word, int(seeds[w]) ^ k) for k in (0, 1))

    def _hashed(self, place, gap, seeds, base: int):
        import numpy as np
        if not len(self.starts):
            return np.empty(0, np.uint64)
        powers = np.cumprod(np.full(int(place.max()) + 2, base, np.uint64))
        value = powers[place] * (self.data.astype(np.uint64) + np.uint64(1))
        value[gap] = 0
        return _mixed(np.add.reduceat(value, self.starts) + seeds + self.length.astype(np.uint64))


def _mixed(h):
    """splitmix64 finaliser."""
    import numpy as np
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _joined(h, n: int):
    """Hashes of the phrases of n words by their first word."""
    import numpy as np
    out = h
    for k in range(1, n):
        out = _mixed(out[:len(h) - k] * np.uint64(0xD6E8FEB86659FD93) + h[k:])
    return out


def _chain(steps, n: int):
    """Places from which n steps in a row are true."""
    out = steps
    for k in range(1, n):
        out = out[:len(steps) - k] & steps[k:]
    return out


def _known(bitmap: bytes, h):
    import numpy as np
    at = h & np.uint64(8 * len(bitmap) - 1)
    bits = np.frombuffer(bitmap, np.uint8)[(at >> np.uint64(3)).astype(np.int64)]
    return (bits >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrase_counts(words: Words, lasts, freqs, orders: tuple[int, ...], bitmap: bytes | None, overlap: int = 3) -> Iterator:
    """(text of the first occurrence, start, end, count) arrays of the phrases
    that belong to the chunks, order by order; orders above the first need
    their one-word (order 2) or two-word parts (above) in the bitmap. Equal
    phrases may come more than once."""
    import numpy as np
    n = len(words.starts)
    own = words.count - np.where(lasts, 0, overlap)
    mine = np.arange(n) - np.repeat(words.first, words.count) < np.repeat(own, words.count)
    weights = freqs[words.text]
    if orders[0] == 2:
        ok = _known(bitmap, words.h1)
        pairs = (words.linked & ok)[:n - 1] & ok[1:] if n > 1 else np.zeros(0, bool)
    elif orders[0] > 2:
        pairs = words.linked[:max(n - 1, 0)] & _known(bitmap, _joined(words.h1, 2)) if n > 1 else np.zeros(0, bool)
    for order in orders:
        size = max(n - order + 1, 0)
        mask = mine[:size] & _chain(pairs, order - 1)[:size] if order > 1 else mine
        at = np.flatnonzero(mask)
        if not len(at):
            continue
        k1, k2 = _joined(words.h1, order)[at], _joined(words.h2, order)[at]
        by = np.argsort(k1)
        at, k1, k2 = at[by], k1[by], k2[by]
        new = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        head = at[new]
        yield words.text[head], words.starts[head], words.ends[head + order - 1], np.add.reduceat(weights[at], new)


def _slices(data, starts, ends):
    """Arrow strings of data[start:end]."""
    import numpy as np
    import pyarrow as pa
    length = ends - starts
    to = np.concatenate([[0], np.cumsum(length)])
    source = np.arange(to[-1]) + np.repeat(starts - to[:-1], length)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data[source])])


def _in_parts(batch, column: int, most: int = 1 << 22) -> Iterator:
    """Slices of a batch with some ``most`` bytes in a binary column, or one row."""
    import numpy as np
    import pyarrow.compute as pc
    size = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def dictionary(docs: DataFrame, *, most: int = 4) -> DataFrame:
    """lang, chunk, last, freq: the distinct chunks of every language's texts."""
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                seen: Counter = Counter()
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    seen.update([(lang, c, last) for c, last in parse(normal(text), most - 1)])
                langs, chunks, lasts = zip(*seen, strict=True) if seen else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(chunks, pa.binary()), pa.array(lasts, pa.bool_()),
                     pa.array(seen.values(), pa.int64())], ["lang", "chunk", "last", "freq"])

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return (texts.mapInArrow(cut, "lang string, chunk binary, last boolean, freq long")
            .groupBy("lang", "chunk", "last").agg(F.sum("freq").alias("freq")))


def _counted(chunks: DataFrame, orders: tuple[int, ...], bitmap, overlap: int) -> DataFrame:
    """lang, phrase, f of the phrases of the given orders; the number of words
    stands with the empty phrase."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        names = ["lang", "phrase", "f"]
        for batch in batches:
            for part in _in_parts(batch, 1):
                langs = part.column(0)
                words = Words(part.column(1).cast(pa.binary()), langs.to_pylist())
                lasts, freqs = (part.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
                for text, starts, ends, f in phrase_counts(words, lasts, freqs, orders, bitmap and bitmap.value, overlap):
                    yield pa.RecordBatch.from_arrays([langs.take(pa.array(text)), _slices(words.data, starts, ends), pa.array(f)], names)
                if 1 in orders:
                    own = (words.count - np.where(lasts, 0, overlap)) * freqs
                    yield pa.RecordBatch.from_arrays([langs, pa.repeat(pa.scalar(""), len(langs)), pa.array(own)], names)

    return (chunks.mapInArrow(count, "lang string, phrase string, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def _bitmap(frequent: DataFrame, words: int, bits: int) -> bytes:
    """2**bits bits, one set by each phrase: at most 2**(bits - 6) rows of 64
    bits reach the driver, whatever the number of phrases."""
    def places(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for part in _in_parts(batch, 1):
                h = Words(part.column(1).cast(pa.binary()), part.column(0).to_pylist()).h1
                at = _joined(h, words)[::words] & ((1 << bits) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype("i8"))], ["at"])

    import numpy as np
    places_of = frequent.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(places, "at long")
    rows = (places_of.groupBy(F.shiftright("at", 6).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), "<i8")
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.tobytes()


def frequent_phrases(docs: DataFrame, *, least: int = 30, most: int = 4,
                     filter_bits: int = 26) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of 1 to ``most`` words that
    occur ``least`` times or more within a piece, and (lang, n): all words."""
    spark = docs.sparkSession
    chunks = stored(dictionary(docs, most=most))
    enough = F.col("f") >= least
    size = F.size(F.split("phrase", " ", -1))

    def counted(orders: tuple[int, ...], bitmap=None) -> DataFrame:
        try:
            return stored(_counted(chunks, orders, bitmap, most - 1).where(enough | (F.col("phrase") == "")))
        finally:
            if bitmap is not None:
                bitmap.unpersist()

    def frequent(found: DataFrame, words: int):
        return spark.sparkContext.broadcast(_bitmap(found.where(f"phrase <> '' AND f >= {least}"), words, filter_bits))
    orders = [counted((1,))]
    if most > 1:
        orders.append(counted((2,), frequent(orders[0], 1)))
    if most > 2:
        orders.append(counted(tuple(range(3, most + 1)), frequent(orders[1], 2)))
    totals = orders[0].where("phrase = ''").select("lang", F.col("f").alias("n")).where("n > 0")
    phrases = reduce(DataFrame.unionByName, orders).where(enough & (F.col("phrase") != ""))
    return phrases.select("lang", size.alias("words"), "phrase", "f"), totals


def _part(words: str, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def collocations(docs: DataFrame, *, least: int = 30, most: int = 4, top: int = 2000,
                 covered: tuple[int, int] = (80, 100), scale: int = 2_000_000, filter_bits: int = 26) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts are split at ``. , ; : ! ?`` and line ends into
    pieces, and those at spaces and tabs into words; phrases don't cross
    pieces. Candidates have 2 to ``most`` words and occur a >= ``least`` times.
    Cut in two, with counts l and r of the parts, a candidate scores
    floor(scale * a / (l + r)), by its lowest-scoring cut (the first of equal
    ones). A candidate inside a longer one that occurs at least
    covered[0] / covered[1] as often is dropped. Ranks are by score, then a,
    descending, then phrase by its UTF-8 bytes.

    A null lang counts as ``und`` and a null text as empty; equal texts and
    repeated rows count each time; a text without words, like an empty table,
    gives no phrase. Other columns are ignored. Chunk counts are aggregated
    before they are shuffled, and no task holds a language.
    """
    phrases, totals = frequent_phrases(docs, least=least, most=most, filter_bits=filter_bits)
    candidates = phrases.where("words > 1").withColumn("w", F.split("phrase", " ", -1))
    counts = phrases.select("lang", "phrase", "f")

    cuts = (candidates.select("lang", "phrase", F.col("f").alias("a"), "w",
                              F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _part("w", F.lit(1), F.col("k")).alias("first"),
                    _part("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("rest")))
    scored = (cuts.join(counts.toDF("lang", "first", "l"), ["lang", "first"])
              .join(counts.toDF("lang", "rest", "r"), ["lang", "rest"])
              .withColumn("score", F.expr(f"(CAST({scale} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(19, 0)))"
                                          " div (CAST(l AS DECIMAL(20, 0)) + r)"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c"))
              .select("lang", "phrase", "c.*"))

    def inside(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: _part("w", i, F.lit(n)))
    shorter = [F.when(F.size("w") > n, inside(n)).otherwise(F.array().cast("array<string>"))
               for n in range(2, most)]
    wider = (candidates.where("words > 2").select("lang", "f", F.explode(F.flatten(F.array(*shorter))).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("f").alias("wider")))
    kept = (scored.join(wider, ["lang", "phrase"], "left")
            .where(f"wider IS NULL OR CAST(wider AS DECIMAL(19, 0)) * {covered[1]} < CAST(a AS DECIMAL(19, 0)) * {covered[0]}"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return (ranked.join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
