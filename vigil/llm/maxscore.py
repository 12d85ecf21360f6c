"""Exact top-k by inner product with MaxScore, over shards merged at the end.

A vector's components are its terms: posting list i holds the components i of
all rows of a shard. A query bounds what every term can add (from the shard's
least and greatest component), sorts the terms by that, and splits them: the
non-essential terms together can't lift a row over the current k-th score.
Essential postings are traversed; the other terms are probed only for rows
that can still compete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RESULT = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """vec_id, terms (array of long): floor(factor * x). Rows whose vec_id or
    vector is null, or that hold a null or non-finite component, take no part;
    a row repeated exactly counts once."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(F.lit(float(factor)) * c.cast("double")).cast("long")).alias("terms"))
            .distinct())


def matrix(columns):
    """Rows of lists as a matrix; a row's missing terms are 0."""
    import numpy as np
    rows = [np.asarray(r, dtype=np.int64) for r in columns]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def top_k(ids, postings, query_id: int, query, k: int, block: int = 2048) -> list[tuple[int, int]]:
    """The k best (score, id) of one shard for one query, without the query's
    own id; ties to the smaller id. ``postings``: [rows, terms]."""
    import numpy as np
    n, terms = postings.shape
    a, b = query * postings.min(axis=0), query * postings.max(axis=0)
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.argsort(low - high, kind="stable")
    low, high = low[order], high[order]
    ahead = np.append(np.cumsum(high[::-1])[::-1], 0)        # most that terms j.. can add
    floor = np.append(0, np.cumsum(low))                     # least that terms ..j add
    best_score, best_id = np.zeros(0, query.dtype), np.zeros(0, np.int64)
    least = None
    for at in range(0, n, block):
        rows = np.arange(at, min(n, at + block))
        if least is None:
            essential, limit = terms, None
        else:
            limit = least
            # the longest tail of terms that can't reach the limit on its own
            essential = int(np.flatnonzero(floor + ahead < limit)[0]) if (floor + ahead < limit).any() else terms
        if essential == 0:
            continue
        own = order[:essential]
        part = postings[at:at + block][:, own] @ query[own]
        if limit is not None:
            keep = part + ahead[essential] >= limit
            rows, part = rows[keep], part[keep]
            for j in range(essential, terms, 8):
                if not len(rows):
                    break
                own = order[j:j + 8]
                part = part + postings[rows[:, None], own] @ query[own]
                keep = part + ahead[min(j + 8, terms)] >= limit
                rows, part = rows[keep], part[keep]
        keep = ids[rows] != query_id
        best_score = np.concatenate([best_score, part[keep]])
        best_id = np.concatenate([best_id, ids[rows[keep]]])
        first = np.lexsort((best_id, -best_score))
        first = first[np.sort(np.unique(best_id[first], return_index=True)[1])[:k]]  # an id counts with its best score
        best_score, best_id = best_score[first], best_id[first]
        least = best_score[-1] if len(best_score) == k else None
    return [(int(s), int(i)) for s, i in zip(best_score, best_id, strict=True)]


def search(vectors: DataFrame, is_query: Column, *, k: int = 5, shard_rows: int = 16384,
           query_rows: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. ``vectors``: vec_id, terms.

    Candidates lie in shards and queries in blocks of bounded size, dealt by a
    hash of vec_id; every block meets every shard once. No candidates, or no
    queries: no rows. Scores must fit 64 bits.
    """
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = -(-total["n"] // shard_rows) or 1, -(-total["q"] // query_rows) or 1
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = vectors.select("vec_id", "terms", deal(1, shards).alias("shard"), every(blocks).alias("block"))
    asked = vectors.where(is_query).select("vec_id", "terms", deal(2, blocks).alias("block"), every(shards).alias("shard"))

    def meet(asked, rows):
        import numpy as np
        import pandas as pd
        out = []
        if len(asked) and len(rows):
            rows = rows.sort_values("vec_id", kind="stable")
            ids, p, q = rows["vec_id"].to_numpy(), matrix(rows["terms"]), matrix(asked["terms"])
            terms = max(p.shape[1], q.shape[1])
            p, q = (np.pad(x, ((0, 0), (0, terms - x.shape[1]))) for x in (p, q))
            if float(np.abs(p).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(terms, 1) < 2.0 ** 52:
                p, q = p.astype(float), q.astype(float)  # whole numbers below 2^53: sums stay exact
            for query_id, x in zip(asked["vec_id"].tolist(), q, strict=True):
                out += [(query_id, i, s) for s, i in top_k(ids, p, query_id, x, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = (asked.groupBy("shard", "block").cogroup(rows.groupBy("shard", "block"))
             .applyInPandas(meet, RESULT))
    # the same vec_id may stand on several different vectors: a pair counts with its best score
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
