"""Near-duplicate documents: exact n-gram Jaccard join on parity sketches.

The hashes of a document's word n-grams are dealt into m groups, and each group
keeps the parity (XOR) of its hashes: the sketch. An n-gram that only one of two
documents has changes one group, so the number of differing groups never
exceeds the symmetric difference, which the Jaccard threshold bounds for a
band of set sizes. With m larger than that bound, two linked documents must
agree in a group (pigeonhole), which is an equi-join. What meets is compared
by the Hamming distance of one-bit parity sketches, which bounds the symmetric
difference in the same way, then by the sets themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from vigil.llm.components import components
from vigil.llm.storage import stored, stored_by

LEAST_BITS = 1024


@dataclass(frozen=True)
class Jaccard:
    """Link if ``over * union <= under * intersection`` of ``words``-word
    shingles, e.g. 85 and 100."""

    words: int = 4
    over: int = 85
    under: int = 100

    def difference(self, sizes: int) -> int:
        """Most elements that two linked sets of so many elements in all differ by."""
        return (self.under - self.over) * sizes // (self.under + self.over)

    def bands(self, largest: int) -> list[int]:
        """Least sizes of the bands: a set's links lie in its band and the next ones."""
        out = [1]
        while out[-1] <= largest:
            out.append(out[-1] * self.under // self.over + 1)
        return out

    def groups(self, band_end: int) -> tuple[int, int]:
        """Groups of a sketch for sets below ``band_end`` elements, and how many
        of them may be empty before an empty group has to count as agreement."""
        d = self.difference(2 * (band_end - 1))
        if not d:
            return 0, 0
        spare = d // 25 + 2
        return d + 1 + spare, spare


def _mix(x):
    """splitmix64 finaliser."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES: dict = {}


def _byte_table():
    import numpy as np
    if "bytes" not in _TABLES:
        b = np.arange(256, dtype=np.uint64)
        b = np.where((b >= 65) & (b <= 90), b + np.uint64(32), b)      # A-Z read as a-z
        _TABLES["bytes"] = _mix(b + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        b = np.arange(256)
        _TABLES["space"] = (b == 32) | ((b >= 9) & (b <= 13))
        _TABLES["powers"] = np.ones(1, np.uint64)
    return _TABLES["bytes"], _TABLES["space"]


def _powers(n: int):
    import numpy as np
    if len(_TABLES["powers"]) < n:
        step = np.full(max(n, 64), 0xD1342543DE82EF95, dtype=np.uint64)
        step[0] = 1
        _TABLES["powers"] = np.multiply.accumulate(step)
    return _TABLES["powers"]


def shingle_sets(texts: list[str | None], words: int) -> list:
    """Per text the sorted distinct 64-bit hashes of its word shingles."""
    import numpy as np
    table, space = _byte_table()
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    arr = np.frombuffer(b" ".join(data) + b" ", dtype=np.uint8)
    blank = space[arr]
    # a joining space stands at every end, so no word runs over it
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    none = np.zeros(0, np.uint64)
    if not len(starts):
        return [none for _ in texts]
    stops = np.flatnonzero(blank & np.append(False, ~blank[:-1]))
    value = table[arr]
    value[blank] = 0
    place = np.arange(len(arr)) - np.repeat(starts, np.diff(np.append(starts, len(arr)))) if starts[0] == 0 else \
        np.concatenate([np.zeros(starts[0], np.int64),
                        np.arange(starts[0], len(arr)) - np.repeat(starts, np.diff(np.append(starts, len(arr))))])
    place[blank] = 0
    value *= _powers(int((stops - starts).max()))[place]
    word = _mix(np.add.reduceat(value, starts) + (stops - starts).astype(np.uint64))
    first = np.searchsorted(starts, np.append(0, ends))
    factors = [np.uint64(f) for f in (2 * _mix(np.arange(1, words + 1, dtype=np.uint64)) + np.uint64(1))]
    if len(word) >= words:
        n = len(word) - words + 1
        run = sum((word[k:k + n] * f for k, f in enumerate(factors)), start=np.zeros(n, np.uint64))
        run = _mix(run)
    out = []
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= words:
            out.append(np.unique(run[a:b - words + 1]))
        elif b > a:
            part = (word[a:b] * np.array(factors[:b - a])).sum(dtype=np.uint64, keepdims=True)
            out.append(_mix(part + np.array([b - a], np.uint64)))
        else:
            out.append(none)
    return out


def set_key(own) -> tuple[int, int]:
    """128 bits that stand for the whole set."""
    import numpy as np
    a = np.bitwise_xor.reduce(_mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    b = np.add.reduce(_mix(own + np.uint64(0x1234567)))
    k1 = _mix(np.array([a ^ (b << np.uint64(1))], np.uint64))[0]
    return int(k1.astype(np.int64)), int(b.astype(np.int64))


def sketch_parts(own, rule: Jaccard, bands: list[int]):
    """Keys of the sketch parts of one set, for its own band and the next."""
    import numpy as np
    band = int(np.searchsorted(bands, len(own), side="right"))   # bands[band - 1] <= size < bands[band]
    out = []
    mixed = None
    for slot in (band, band + 1):
        m, spare = rule.groups(bands[slot])
        if not m:
            continue
        if mixed is None:
            mixed = _mix(own + np.uint64(0x632BE59BD9B4E019))
        group = ((mixed >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        order = np.argsort(group, kind="stable")
        group = group[order]
        at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        parity = np.bitwise_xor.reduceat(own[order], at)
        held = group[at]
        if m - len(held) > spare:      # more empty groups than certain agreements: they must count too
            parity = np.append(parity, np.zeros(m - len(held), np.uint64))
            held = np.append(held, np.setdiff1d(np.arange(m, dtype=np.uint64), held))
        out.append(_mix(parity + _mix(held + np.uint64(slot << 32))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def bit_sketch(own) -> bytes:
    """One parity bit for each of 2^k classes of the set's hashes, 2^k at least
    twice the set's size."""
    import numpy as np
    bits = max(LEAST_BITS, 1 << (2 * len(own) - 1).bit_length())
    parity = np.bincount((own >> np.uint64(8)) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _sketch_rows(sketches: list[bytes]):
    """As rows of 64-bit words, folded to the shortest of them."""
    import numpy as np
    width = min(map(len, sketches)) // 8
    out = np.empty((len(sketches), width), dtype=np.uint64)
    for i, b in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, width), axis=0)
    return out


def near_pairs(size, sketches: list[bytes], ties: list, split: int, rule: Jaccard, sets: list | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of places whose sizes and sketches allow a
    link and, with ``sets``, whose sets are linked: among all rows or, if
    ``split``, between the first ``split`` rows and the others. Rows of one tie
    count as connected already."""
    import numpy as np
    first: dict = {}
    label = np.array([first.setdefault(t, i) for i, t in enumerate(ties)])
    words = _sketch_rows(sketches)
    n = len(label)
    out = []
    for i in range(split or n):
        js = np.arange(split or i + 1, n)
        js = js[label[js] != label[i]]
        if not len(js):
            continue
        small, large = np.minimum(size[js], size[i]), np.maximum(size[js], size[i])
        most = (rule.under - rule.over) * (size[js] + size[i]) // (rule.under + rule.over)
        js, most = (x[rule.over * large <= rule.under * small] for x in (js, most))
        differ = np.bitwise_count(words[js] ^ words[i]).sum(axis=1, dtype=np.int64)
        for j in js[differ <= most].tolist():
            if label[i] != label[j] and (sets is None or is_link(sets[i], sets[j], rule)):
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def with_near_partner(size, sketches: list[bytes], ties: list, split: int, rule: Jaccard) -> list[int]:
    """Places that have a near partner (as above) of another tie."""
    import numpy as np
    first: dict = {}
    label = np.array([first.setdefault(t, i) for i, t in enumerate(ties)])
    words = _sketch_rows(sketches)
    has = np.zeros(len(label), dtype=bool)
    for i in range(split or len(label)):
        js = np.arange(split or i + 1, len(label))
        js = js[label[js] != label[i]]
        small, large = np.minimum(size[js], size[i]), np.maximum(size[js], size[i])
        most = (rule.under - rule.over) * (size[js] + size[i]) // (rule.under + rule.over)
        js, most = (x[rule.over * large <= rule.under * small] for x in (js, most))
        js = js[np.bitwise_count(words[js] ^ words[i]).sum(axis=1, dtype=np.int64) <= most]
        has[js] = True
        has[i] |= len(js) > 0
    return np.flatnonzero(has).tolist()


def is_link(a, b, rule: Jaccard) -> bool:
    import numpy as np
    common = len(np.intersect1d(a, b, assume_unique=True))
    return rule.under * common >= rule.over * (len(a) + len(b) - common)


def _group_stream(batches: Iterator, keys: int) -> Iterator:
    """Rows of consecutive batches, sorted by their first ``keys`` columns, as
    (key, rows); a group may reach over batches."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != now:
                if rows:
                    yield now, rows
                now, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield now, rows


def components_of(docs: DataFrame, rule: Jaccard, *, block: int = 512) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Null, empty and blank texts have no shingles and link with nothing: their
    component is their own doc_id. Rows with equal sets are one class; a
    repeated or null doc_id is handled by content, and a component's id is the
    least doc_id that is not null. Other columns are ignored; no rows give no rows.

    Sets are compared by their sketches in blocks of ``block``: first in their
    largest bucket only, then, if not connected, in all. Each time a spanning
    forest of the near pairs is verified. Sets that then still come near an
    unconnected one are compared as they are. No group's pairs are ever listed,
    and only sets that come near one another are shuffled.
    """
    rows, _ = _classified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rule, block)
    return rows.select("doc_id", F.col("__n").alias("n_shingles"), F.col("__id").alias("component_id"))


def keep_one(docs: DataFrame, rule: Jaccard, *, block: int = 512) -> DataFrame:
    """All columns of ``docs``, one row of each component: the one with the
    least doc_id (null last), ties by content. Rows without shingles all stay."""
    rows, texts = _classified(docs, rule, block)
    first = Window.partitionBy("__root").orderBy(F.col("doc_id").asc_nulls_last(), "__h1", "__h2")
    linked = rows.where("__root IS NOT NULL").withColumn("__k", F.row_number().over(first)).where("__k = 1").drop("__k")
    kept = linked.unionByName(rows.where("__root IS NULL"))
    return (kept.join(texts, ["__h1", "__h2"])
            .withColumn("text", F.when(~F.col("__null"), F.col("__text"))).select(*docs.columns))


def _classified(docs: DataFrame, rule: Jaccard, block: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` without text, but with __h1, __h2 (the text's key),
    __null (it is null), __n shingles, __root (of the component; null without
    shingles) and __id (its least doc_id); and the distinct texts by key."""
    full = docs.withColumns({"__null": F.col("text").isNull(), "__text": F.coalesce("text", F.lit(""))})
    full = full.withColumns({"__h1": F.xxhash64("__text"), "__h2": F.xxhash64(F.lit(7), "__text")})
    # every distinct text once, bucketed by its key: texts are shuffled here and nowhere else
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = stored_by(full.select("__h1", "__h2", "__text").repartition(buckets, "__h1", "__h2")
                         .dropDuplicates(["__h1", "__h2"]), "__h1", "__h2")
    texts = distinct.toDF("h1", "h2", "text")

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = shingle_sets(part.column(2).to_pylist(), rule.words)
                keys = [set_key(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())],
                    ["h1", "h2", "n", "c", "c2"])

    def parts(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        bands = rule.bands(1000)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [s for s in shingle_sets(batch.column(2).slice(at, 64).to_pylist(), rule.words) if len(s)]
                if not sets:
                    continue
                if max(map(len, sets)) * 3 > bands[-1]:
                    bands = rule.bands(3 * max(map(len, sets)))
                got = [sketch_parts(s, rule, bands) for s in sets]
                c = np.repeat(np.array([set_key(s)[0] for s in sets]), [len(g) for g in got])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).astype(np.int64)), pa.array(c)], ["part", "c"])

    light = stored(texts.mapInArrow(measure, "h1 long, h2 long, n long, c long, c2 long"))
    # what the joins below would each filter out is left out here, so that all read one exchange
    part = texts.mapInArrow(parts, "part long, c long").where("part IS NOT NULL AND c IS NOT NULL").repartition("part")
    shared = part.groupBy("part").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("part")
    members = stored(part.join(shared, "part").distinct())
    # buckets with the same members are one bucket
    low = F.col("c").bitwiseAND(F.lit(0xFFFFFFFF))
    buckets_of = members.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("c", 32)).alias("hi"),
                                             F.sum(low).alias("lo"))
    once = buckets_of.groupBy("n", "hi", "lo").agg(F.min("part").alias("part")).select("part", "n")
    members = stored(members.join(once, "part"))

    def of_classes(classes: DataFrame, work: Callable, out: str) -> DataFrame:
        """``work`` on (c, text) of one text per class; c is 64 bits of the
        set's key, so a class is told from another by c2 as well."""
        wanted = (classes.select("c").distinct().join(light, "c")
                  .groupBy("c", "c2").agg(F.min(F.struct("h1", "h2")).alias("h")).select("c", "h.*"))
        return stored(texts.join(wanted, ["h1", "h2"]).select("c", "text").mapInArrow(work, out))

    def per_set(make: Callable, name: str) -> Callable:
        def work(batches: Iterator) -> Iterator:
            import pyarrow as pa
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    piece = batch.slice(at, 64)
                    sets = shingle_sets(piece.column(1).to_pylist(), rule.words)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0), pa.array([len(x) for x in sets], pa.int64()),
                         pa.array([make(x) for x in sets], pa.binary())], ["c", "size", name])
        return work

    sketches = of_classes(members, per_set(bit_sketch, "sketch"), "c long, size long, sketch binary")

    def groups(batches: Iterator) -> Iterator:
        """Rows (part, x, y, side, c, tie, size, data) by group: side 0 and 1 are
        compared with one another, or side 0 within itself where there is no
        side 1. Gives key, rows, and where side 1 begins."""
        for key, rows in _group_stream(batches, 3):
            rows.sort(key=lambda r: r[:2])
            split = sum(r[0] == 0 for r in rows)
            if split:
                yield key, rows, split if split < len(rows) else 0

    def edges_of(pairs: Iterator) -> Iterator:
        import pyarrow as pa
        out: list[tuple[int, int]] = []
        for rows, got in pairs:
            out += [(min(rows[i][1], rows[j][1]), max(rows[i][1], rows[j][1])) for i, j in got]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["u", "v"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["u", "v"])

    def near(batches: Iterator) -> Iterator:
        import numpy as np
        yield from edges_of((rows, near_pairs(np.array([r[3] for r in rows]), [r[4] for r in rows], [r[2] for r in rows], split, rule))
                            for _, rows, split in groups(batches))

    def exact(batches: Iterator) -> Iterator:
        import numpy as np

        def pairs():
            for _, rows, split in groups(batches):
                sets = [np.frombuffer(r[4], np.uint64) for r in rows]
                yield rows, near_pairs(np.array([r[3] for r in rows]), [bit_sketch(x) for x in sets], [r[2] for r in rows], split, rule, sets)
        yield from edges_of(pairs())

    def mark(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for key, rows, split in groups(batches):
            own = [rows[i] for i in with_near_partner(np.array([r[3] for r in rows]), [r[4] for r in rows], [r[2] for r in rows], split, rule)]
            cols = [*([k] * len(own) for k in key), *([r[k] for r in own] for k in (0, 1, 2))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                ["part", "x", "y", "side", "c", "tie"])

    def run(rows: DataFrame, data: DataFrame, work: Callable, out: str) -> DataFrame:
        """``work`` on the groups of rows (part, x, y, side, c, tie), with the data of their sets."""
        return stored(rows.join(data.toDF("c", "size", "data"), "c").select("part", "x", "y", "side", "c", "tie", "size", "data")
                      .repartition("part", "x", "y").sortWithinPartitions("part", "x", "y").mapInArrow(work, out).distinct())

    def check(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            u, v, a, b = (c.to_pylist() for c in batch.columns)
            keep = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                if is_link(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), rule):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in keep], pa.int64()) for c in (u, v)], ["u", "v"])

    def sets_of(classes: DataFrame) -> DataFrame:
        return of_classes(classes, per_set(lambda x: x.tobytes(), "elements"), "c long, size long, elements binary")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are linked."""
        sets = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("c")))
        a, b = (sets.select(F.col("c").alias(c), F.col("elements").alias(e)) for c, e in (("u", "a"), ("v", "b")))
        return stored(pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(check, "u long, v long"))

    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    dealt = members.select("part", "n", "c", blocks.alias("blocks"),
                           F.pmod(F.xxhash64("c", "part"), blocks).cast("int").alias("x"))
    none = F.lit(0)
    # first round: every set in its largest bucket only, compared within blocks
    largest = Window.partitionBy("c").orderBy(F.desc("n"), "part")
    home = dealt.withColumn("k", F.row_number().over(largest)).where("k = 1")
    edges = linked(run(home.select("part", "x", none.alias("y"), none.alias("side"), "c", F.col("c").alias("tie")),
                       sketches, near, "u long, v long"))

    def unconnected(roots: DataFrame) -> DataFrame:
        """For buckets that still hold several components: the sets outside the
        bucket's main one meet every block of it; within the main one there is
        nothing to find."""
        many = dealt.join(roots.withColumnRenamed("u", "c"), "c", "left").select(
            "part", "blocks", "x", "c", F.coalesce("root", "c").alias("tie"))
        sizes = many.groupBy("part", "tie").agg(F.count(F.lit(1)).alias("n"))
        main = sizes.groupBy("part").agg(F.max(F.struct("n", "tie")).alias("m"), F.sum("n").alias("n")).where("m.n < n")
        many = many.join(main.select("part", F.col("m.tie").alias("main"),
                                     F.ceil((F.col("n") - F.col("m.n")) / F.lit(block)).cast("int").alias("chunks")), "part")
        left_over = many.where("tie <> main").select(
            "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"),
            F.pmod(F.xxhash64("c"), "chunks").cast("int").alias("y"), F.lit(0).alias("side"), "c", "tie")
        return left_over.union(many.select(
            "part", "x", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("y"), F.lit(1).alias("side"), "c", "tie"))

    # second round: a forest again, now in all buckets
    edges = stored(edges.union(linked(run(unconnected(stored(components(edges))), sketches, near, "u long, v long"))))
    # last round: what still comes near something unconnected is compared by its set
    rest = run(unconnected(stored(components(edges))), sketches, mark,
               "part long, x int, y int, side int, c long, tie long")
    roots = components(edges.union(run(rest, sets_of(rest.select("c")), exact, "u long, v long")))

    tie = F.xxhash64("__h1").alias("__h3")   # exchanges of its own: a much-copied text's rows can be split
    known = light.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("n").alias("__n"),
                         F.col("c").alias("__c")).select("*", tie)
    own = full.drop("text", "__text").select("*", tie).join(known, ["__h1", "__h2", "__h3"])
    least = (own.where("__c IS NOT NULL").groupBy("__c").agg(F.min("doc_id").alias("__least"))
             .join(roots.select(F.col("u").alias("__c"), F.col("root").alias("__root")), "__c", "left")
             .select("__c", F.coalesce("__root", "__c").alias("__root"), "__least"))
    named = least.select("__c", "__root").join(least.groupBy("__root").agg(F.min("__least").alias("__id")), "__root")
    rows = own.join(named, "__c", "left").withColumn(
        "__id", F.when(F.col("__root").isNull(), F.col("doc_id")).otherwise(F.col("__id")))
    return rows, distinct
