"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are measured on the line and on its
two neighbours; transition weights tie consecutive lines. Forward-backward
gives each line's probability of being good, and a document's score is their
mean weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.storage import stored

#: what is measured on one line; neighbours add the same again
LINE_FEATURES = 17
_SYMBOLS = "*&%$#@~^=+<>{}[]\\/_"
_PLAIN = str.maketrans("", "", ".,;:?!'\"()-’")


def line_features(lines: list[str]) -> list[list[float]]:
    from collections import Counter
    from math import log1p
    copies = Counter(lines)
    out = []
    for line in lines:
        words = line.split()
        n, chars = len(words), len(line)
        if not n:
            out.append([1.0] + [0.0] * (LINE_FEATURES - 1))
            continue
        bare = line.translate(_PLAIN).split()
        m = len(bare) or 1
        symbols = sum(map(line.count, _SYMBOLS))
        last = words[-1][-1]
        out.append([
            0.0,
            log1p(chars),
            log1p(n),
            sum(map(str.isupper, bare)) / m,
            sum(map(str.islower, bare)) / m,
            sum(map(str.istitle, bare)) / m,
            sum(map(str.isalpha, bare)) / m,
            sum(map(str.isdigit, bare)) / m,
            len(set(bare)) / m,
            log1p(m) - log1p(len(set(bare))),
            chars / n / 10,
            min(symbols / n, 4.0),
            min(line.count("|") / n, 2.0),
            min(line.count("!") / n, 2.0),
            min((line.count(",") + line.count(".")) / n, 2.0),
            float(last in ".?!…\"'»"),
            log1p(copies[line] - 1),
        ])
    return out


def with_neighbours(own):
    """[lines, features] of one document -> own, previous and next line's."""
    import numpy as np
    none = np.zeros((1, own.shape[1]))
    edge = np.zeros((len(own), 2))
    edge[0, 0] = edge[-1, 1] = 1.0
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), edge])


def lines_of(text: str | None, most: int | None = None) -> list[str]:
    lines = (text or "").split("\n")
    return lines if most is None else lines[:most]


@dataclass
class Model:
    mean: Any
    scale: Any
    weights: Any         # of the good state against the bad one
    bias: float
    transitions: Any     # [from, to], 0 bad, 1 good

    def emissions(self, x):
        return (x - self.mean) / self.scale @ self.weights + self.bias


def marginals(emissions: list, transitions):
    """Probability of the good state for every line of every document, by
    forward-backward over all documents side by side. Returns a padded array
    [documents, lines], the pair sums [documents, 2, 2] and log-normalisers."""
    import numpy as np
    sizes = np.array([len(e) for e in emissions])
    d, t = len(sizes), int(sizes.max())
    s = np.zeros((d, t, 2))
    for i, e in enumerate(emissions):
        s[i, :len(e), 1] = e
    live = np.arange(t)[None, :] < sizes[:, None]
    ahead, behind = np.zeros((d, t, 2)), np.zeros((d, t, 2))
    ahead[:, 0] = s[:, 0]
    for k in range(1, t):
        a = ahead[:, k - 1, :, None] + transitions
        new = np.logaddexp(a[:, 0], a[:, 1]) + s[:, k]
        ahead[:, k] = np.where(live[:, k, None], new, ahead[:, k - 1])
    log_z = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    pairs = np.zeros((d, 2, 2))
    for k in range(t - 2, -1, -1):
        b = transitions + (s[:, k + 1] + behind[:, k + 1])[:, None, :]
        on = live[:, k + 1]
        behind[:, k] = np.where(on[:, None], np.logaddexp(b[:, :, 0], b[:, :, 1]), 0.0)
        pairs += np.where(on[:, None, None], np.exp(ahead[:, k, :, None] + b - log_z[:, None, None]), 0.0)
    good = np.where(live, np.exp(ahead[:, :, 1] + behind[:, :, 1] - log_z[:, None]), 0.0)
    return good, pairs, log_z


def train(features: list, labels: list[int], rounds: int = 150, rate: float = 0.1, l2: float = 0.003) -> Model:
    """Maximum likelihood by Adam; a document's label is that of its lines."""
    import numpy as np
    x = [with_neighbours(np.asarray(f, dtype=float)) for f in features]
    flat = np.vstack(x)
    mean, scale = flat.mean(axis=0), flat.std(axis=0) + 1e-6
    flat = (flat - mean) / scale
    sizes = np.array([len(e) for e in x])
    starts = np.cumsum(sizes) - sizes
    y = np.asarray(labels, dtype=float)
    doc = np.repeat(np.arange(len(x)), sizes)
    share = 1.0 / sizes
    # documents of like lengths are padded to one another, so a long one costs its own length
    like = [np.flatnonzero((sizes > 1 << k >> 1) & (sizes <= 1 << k)) for k in range(int(sizes.max()).bit_length() + 1)]
    like = [g for g in like if len(g)]
    w = np.zeros(flat.shape[1] + 5)
    m, v = np.zeros_like(w), np.zeros_like(w)
    same = np.zeros((len(x), 2, 2))
    same[np.arange(len(x)), y.astype(int), y.astype(int)] = sizes - 1
    p, pairs = np.zeros(len(flat)), np.zeros((len(x), 2, 2))
    for r in range(1, rounds + 1):
        trans = w[-4:].reshape(2, 2)
        e = flat @ w[:-5] + w[-5]
        for g in like:
            good, own, _ = marginals([e[starts[i]:starts[i] + sizes[i]] for i in g], trans)
            pairs[g] = own
            for i, one in zip(g, good, strict=True):
                p[starts[i]:starts[i] + sizes[i]] = one[:sizes[i]]
        off = (y[doc] - p) * share[doc]
        g = np.concatenate([flat.T @ off, [off.sum()],
                            ((same - pairs) * share[:, None, None]).sum(axis=0).ravel()]) / len(x) - l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-8)
    return Model(mean, scale, w[:-5], float(w[-5]), w[-4:].reshape(2, 2).copy())


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, most_documents: int = 3000, most_lines: int = 200_000) -> Model | None:
    """Fit on whole texts of a bounded sample of the labelled documents that
    aren't held out: the ``most_documents`` with the smallest hash of doc_id,
    leaving out those that would bring the sample above ``most_lines`` lines.
    None if there is no such document. A doc_id labelled twice counts with its
    smaller label; one standing on several rows counts once."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents))

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            rows = [[x for f in line_features(lines_of(t)) for x in f] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))],
                                             ["doc_id", "quality", "features"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")
            .mapInArrow(measure, "doc_id long, quality int, features array<double>")
            .groupBy("doc_id").agg(F.min(F.struct("quality", "features")).alias("x")).select("doc_id", "x.*"))
    rows = stored(rows)
    used, chosen = 0, []
    for r in rows.select("doc_id", F.size("features").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if used + r["n"] // LINE_FEATURES <= most_lines:
            used += r["n"] // LINE_FEATURES
            chosen.append(r["doc_id"])
    if not chosen:
        return None
    rows = rows.where(F.col("doc_id").isin(chosen)).orderBy("doc_id").select("quality", "features").collect()
    import numpy as np
    return train([np.reshape(r["features"], (-1, LINE_FEATURES)) for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, model: Model | None, *, threshold: float = 0.7) -> DataFrame:
    """All columns of ``docs`` (which has ``text``) plus score and predicted.

    Null and empty texts are scored as one empty line. Without a model every
    score is 0.5. Rows are scored alone, whatever their length; columns named
    score or predicted are replaced.
    """
    rows = docs.drop("score", "predicted")
    names = rows.columns
    at = names.index("text")
    schema = rows.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            scores: list[float] = [0.5] * batch.num_rows
            for a in range(0, batch.num_rows if model else 0, 512):
                texts = batch.column(at).slice(a, 512).to_pylist()
                lines = [lines_of(t) for t in texts]
                order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
                x = [np.asarray(line_features(one)) for one in lines]
                e = [model.emissions(with_neighbours(f)) for f in x]
                for k in range(0, len(order), 64):
                    own = order[k:k + 64]
                    good, _, _ = marginals([e[i] for i in own], model.transitions)
                    for i, p in zip(own, good, strict=True):
                        weight = np.array([len(line) for line in lines[i]], dtype=float)
                        if not weight.any():
                            weight += 1.0
                        scores[a + i] = float(np.clip(p[:len(weight)] @ weight / weight.sum(), 0.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())], [*names, "score", "predicted"])

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels, **sample)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(rows, model).drop("text")
