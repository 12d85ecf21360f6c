"""Approximate nearest neighbours by cross-polytope hashing with multiprobe.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform)
turns a unit vector; its bucket is the nearest signed axis, of two rotations
per table. A query probes the bucket pairs whose axes lie nearest to it.
Whatever shares a probed bucket is ranked by its exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.storage import stored

KEY = ["v1", "v2"]


def hadamard(x):
    """Walsh-Hadamard transform of every row (length a power of two), scaled
    to keep lengths."""
    import numpy as np
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def axes(unit, table: int, part: int, seed: int):
    """[rows, 2 d]: nearness of every row to every signed axis."""
    import numpy as np
    signs = np.random.default_rng([seed, table, part]).choice([-1.0, 1.0], (3, unit.shape[1]))
    for s in signs:
        unit = hadamard(unit * s)
    return np.concatenate([unit, -unit], axis=1)


def nearest_pairs(first, second, probes: int):
    """Per row the ``probes`` best (axis of first, axis of second) by the sum
    of their nearness."""
    import numpy as np
    side = min(first.shape[1], max(2, int(np.ceil(np.sqrt(probes))) + 2))
    a = np.argsort(-first, axis=1, kind="stable")[:, :side]
    b = np.argsort(-second, axis=1, kind="stable")[:, :side]
    total = (np.take_along_axis(first, a, 1)[:, :, None] + np.take_along_axis(second, b, 1)[:, None, :]).reshape(len(a), -1)
    best = np.argsort(-total, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(a, best // side, 1), np.take_along_axis(b, best % side, 1)


def cosines(a, b):
    """Cosine of row i of a and row i of b, in double precision; the same for
    the same two rows wherever they stand."""
    import numpy as np
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _rows(column):
    import numpy as np
    return np.vstack([np.frombuffer(b, dtype="<f8") for b in column])


def _units(vectors):
    import numpy as np
    d = vectors.shape[1]
    size = 1 << max(1, (d - 1).bit_length())
    x = np.pad(vectors, ((0, 0), (0, size - d)))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def classes_of(vectors: DataFrame, is_query: Column, keep: int) -> tuple[DataFrame, DataFrame]:
    """Equal vectors are one class: its key, vector and ``keep`` smallest ids;
    and the queries with their class. Vectors that are null, zero, or hold a
    null or non-finite component, and rows without vec_id, take no part; a
    shorter vector is filled up with zeros."""
    x = F.col("embedding")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(good)
            .where(F.exists(x, lambda c: c != 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: c.cast("double")).alias("x"))
            .select(F.xxhash64("x").alias("v1"), F.xxhash64(F.lit(7), "x").alias("v2"), "vec_id", "x"))
    asked = rows.where(is_query).select(*KEY, "vec_id").distinct()
    first = Window.partitionBy(*KEY).orderBy("vec_id")
    reps = (rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep)
            .groupBy(*KEY).agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.max("x").alias("x")))
    classes = reps.join(asked.select(*KEY).distinct().withColumn("asks", F.lit(True)), KEY, "left")
    return classes.withColumn("asks", F.coalesce("asks", F.lit(False))), asked


def _completed(found: DataFrame, classes: DataFrame, k: int, rows: int = 16384, asking: int = 1024) -> DataFrame:
    """``found`` with an exact search for the queries whose buckets hold too
    few ids: that set of queries, in blocks, against the blocks of all classes."""
    ids = classes.select(*KEY, F.size("ids").alias("ids"))
    enough = (found.join(ids, KEY).groupBy("q1", "q2").agg(F.sum("ids").alias("n")).where(F.col("n") > k)
              .select(F.col("q1").alias("v1"), F.col("q2").alias("v2")))
    lacking = stored(classes.where("asks").join(enough, KEY, "left_anti").select(*KEY, "x"))
    queries = lacking.count()
    if not queries:
        return found
    shards, blocks = -(-classes.count() // rows), -(-queries // asking)
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = lacking.select(*KEY, "x", deal(1, blocks).alias("block"), every(shards).alias("shard"))
    right = classes.select(*KEY, "x", F.col("ids")[0].alias("first"), deal(2, shards).alias("shard"), every(blocks).alias("block"))

    def meet(left, right):
        import numpy as np
        import pandas as pd
        out = []
        if len(left) and len(right):
            width = max(map(len, [*left["x"], *right["x"]]))
            q, x = (np.array([np.pad(np.asarray(v, float), (0, width - len(v))) for v in side["x"]]) for side in (left, right))
            for a in (q, x):                    # squares must stay finite
                scale = np.abs(a).max(axis=1, keepdims=True)
                a[:] = np.where((scale > 1e100) | (scale < 1e-100), a / scale, a)
            first, key, asks = right["first"].to_numpy(), right[KEY].to_numpy(), left[KEY].to_numpy()
            for i in range(len(q)):
                score = cosines(np.broadcast_to(q[i], x.shape), x)
                for j in np.lexsort((first, -score))[:k + 1]:
                    out.append((*asks[i], *key[j], score[j], first[j]))
        return pd.DataFrame(out, columns=["q1", "q2", "v1", "v2", "score", "first"]).astype(
            {"q1": "int64", "q2": "int64", "v1": "int64", "v2": "int64", "score": "float64", "first": "int64"})

    exact = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
             .applyInPandas(meet, "q1 long, q2 long, v1 long, v2 long, score double, first long"))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "first")
    exact = exact.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    done = found.join(lacking.select(F.col("v1").alias("q1"), F.col("v2").alias("q2")), ["q1", "q2"], "left_anti")
    return done.unionByName(exact)


def search(vectors: DataFrame, is_query: Column, *, k: int = 5, tables: int = 20, probes: int = 400,
           seed: int = 1, block: int = 8192) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine). Repeated rows count
    once; no valid vectors or no queries give no rows.

    A bucket's rows are split into blocks by their hash, and so are the
    queries that probe it, by measured counts; every block of queries meets
    every block of rows, so no task grows with a hot bucket. Queries whose
    buckets hold fewer than ``k`` other ids are searched for exactly, so each
    has ``k`` rows wherever there are ``k`` candidates.
    """
    classes, asked = classes_of(vectors, is_query, k + 1)
    classes = stored(classes.repartition(*KEY))
    width = classes.agg(F.max(F.size("x")).alias("d")).first()["d"] or 1

    def hashed(asking: bool, sizes: dict | None):
        """(table, axis) of the rows; with sizes also blocks, other axis and vector."""
        def run(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    part = batch.slice(at, 2048)
                    v1, v2 = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    x = np.zeros((part.num_rows, width))
                    for i, row in enumerate(part.column(2).to_pylist()):
                        x[i, :len(row)] = row
                    scale = np.abs(x).max(axis=1, keepdims=True)
                    x = np.where((scale > 1e100) | (scale < 1e-100), x / scale, x)  # squares must stay finite
                    first = part.column(3).to_numpy(zero_copy_only=False)
                    unit = _units(x)
                    for table in range(tables):
                        a, b = (axes(unit, table, p, seed) for p in (0, 1))
                        if asking:
                            pa_, pb = nearest_pairs(a, b, probes)
                            mark = np.zeros((len(x), a.shape[1], b.shape[1]), dtype=bool)
                            mark[np.arange(len(x))[:, None], pa_, pb] = True
                            row, axis = np.nonzero(mark.any(axis=2))
                            other = [m.tobytes() for m in np.packbits(mark[row, axis], axis=1)]
                        else:
                            row, axis = np.arange(len(x)), a.argmax(axis=1)
                            other = [int(o).to_bytes(4, "little") for o in b.argmax(axis=1)]
                        if sizes is None:
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), table), pa.int32()),
                                                              pa.array(axis, pa.int32())], ["t", "axis"])
                            continue
                        cut = np.array([sizes.get((table, int(c)), (0, 0)) for c in axis]).reshape(-1, 2)
                        cut = -(-cut // block)                   # blocks of rows, of queries
                        mine, theirs = (cut[:, 1], cut[:, 0]) if asking else (cut[:, 0], cut[:, 1])
                        times = theirs                           # none, if nobody is there
                        own = (v1[row].astype(np.uint64) >> np.uint64(20)) % np.maximum(mine, 1).astype(np.uint64)
                        again = np.repeat(np.arange(len(row)), times)
                        met = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                        own = own.astype(np.int64)[again]
                        rb, qb = (met, own) if asking else (own, met)
                        r = row[again]
                        raw = [x[i].tobytes() for i in range(len(x))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(r), table), pa.int32()), pa.array(axis[again], pa.int32()),
                             pa.array(rb, pa.int32()), pa.array(qb, pa.int32()), pa.array(v1[r]), pa.array(v2[r]),
                             pa.array(first[r], pa.int64()), pa.array([other[i] for i in again], pa.binary()),
                             pa.array([raw[i] for i in r], pa.binary())],
                            ["t", "axis", "rb", "qb", "v1", "v2", "first", "other", "x"])
        source = classes.where("asks") if asking else classes
        return source.select("v1", "v2", "x", F.col("ids")[0].alias("first")).mapInArrow(
            run, "t int, axis int" if sizes is None else
            "t int, axis int, rb int, qb int, v1 long, v2 long, first long, other binary, x binary")

    # tables x axes counts, however many rows there are
    count = lambda df, name: df.groupBy("t", "axis").agg(F.count(F.lit(1)).alias(name))
    sizes = {(r["t"], r["axis"]): (r["n"], r["q"]) for r in
             count(hashed(False, None), "n").join(count(hashed(True, None), "q"), ["t", "axis"]).collect()}

    def meet(asking, rows):
        import numpy as np
        import pandas as pd
        out = []
        if len(asking) and len(rows):
            x, q = _rows(rows["x"]), _rows(asking["x"])
            unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            at = np.array([int.from_bytes(b, "little") for b in rows["other"]])
            key = rows[["v1", "v2"]].to_numpy()
            first = rows["first"].to_numpy()
            mask = np.unpackbits(np.vstack([np.frombuffer(m, np.uint8) for m in asking["other"]]), axis=1).astype(bool)
            asks = asking[["v1", "v2"]].to_numpy()
            for a in range(0, len(q), 256):
                near = q[a:a + 256] @ unit.T
                near[~mask[a:a + 256][:, at]] = -np.inf
                near /= np.sqrt((q[a:a + 256] ** 2).sum(axis=1, keepdims=True))
                for i, s in enumerate(near):
                    if len(s) > k + 1:
                        least = np.partition(s, -(k + 1))[-(k + 1)]
                        c = np.flatnonzero((s >= least - 1e-9) & (s > -np.inf))
                    else:
                        c = np.flatnonzero(s > -np.inf)
                    exact = cosines(np.broadcast_to(q[a + i], (len(c), q.shape[1])), x[c])
                    top = np.lexsort((first[c], -exact))[:k + 1]
                    out += [(*asks[a + i], *key[c[j]], exact[j], first[c[j]]) for j in top]
        return pd.DataFrame(out, columns=["q1", "q2", "v1", "v2", "score", "first"]).astype(
            {"q1": "int64", "q2": "int64", "v1": "int64", "v2": "int64", "score": "float64", "first": "int64"})

    by = ["t", "axis", "rb", "qb"]
    found = (hashed(True, sizes).groupBy(*by).cogroup(hashed(False, sizes).groupBy(*by))
             .applyInPandas(meet, "q1 long, q2 long, v1 long, v2 long, score double, first long")
             .dropDuplicates(["q1", "q2", "v1", "v2"]))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "first")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    found = _completed(stored(found), classes, k)
    near = (found.join(classes.select(*KEY, "ids"), KEY)
            .select("q1", "q2", "score", F.explode("ids").alias("vec_id")))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    near = (near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
            .groupBy("q1", "q2").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")))
    own = asked.select(F.col("v1").alias("q1"), F.col("v2").alias("q2"), F.col("vec_id").alias("query_id"))
    return (own.join(near, ["q1", "q2"])
            .select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
            .select("query_id", F.posexplode("near").alias("rank", "x"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"))
