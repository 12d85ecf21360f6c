"""Language identification with segmentation-marginalised unigrams.

Every language has probabilities over the pieces of one fixed public
vocabulary. The probability of a word is the sum over all its segmentations
into pieces (forward algorithm); words are independent, so a text's
log-likelihood is the sum over its words. Probabilities are fitted by
expectation-maximisation from equal piece probabilities: forward-backward
gives the expected use of every piece over all segmentations of all training
words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

SPACE = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
MARK_BITS = 18


def default_vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces of the vocabulary that consist of letters (and the word start),
    lower-cased, whatever their length; id ``len`` is any other single
    character, so that every word can be segmented."""

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        names = {sp.id_to_piece(i).lower() for i in range(sp.vocab_size())}
        self.names = sorted(p for p in names if p.lstrip(SPACE).isalpha() and SPACE not in p[1:])
        self.size = len(self.names) + 1
        self.longest = max(map(len, self.names), default=1)
        self.tables = []
        for n in range(1, self.longest + 1):
            own = [(p, i) for i, p in enumerate(self.names) if len(p) == n]
            codes = self._codes([p for p, _ in own], n)
            keys = self._keys(codes, n)[:, 0] if own else np.zeros(0, np.uint64)
            order = np.argsort(keys)
            self.tables.append((keys[order], np.array([i for _, i in own], dtype=np.int64)[order]))

    @cached_property
    def marks(self) -> list:
        """By length: which top bits of a key any piece has."""
        import numpy as np
        out = [np.zeros(1 << MARK_BITS, dtype=bool) for _ in self.tables]
        for marks, (keys, _) in zip(out, self.tables, strict=True):
            marks[keys >> np.uint64(64 - MARK_BITS)] = True
        return out

    @staticmethod
    def _codes(words: list[str], n: int):
        """Code points of words of one length n."""
        import numpy as np
        text = "".join(words).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(text, dtype="<u4").astype(np.uint64).reshape(len(words), n)

    @staticmethod
    def _keys(codes, n: int):
        """64-bit keys of all substrings of length n of each row of codes."""
        import numpy as np
        key = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
        for k in range(n):
            key = Pieces._longer(key, codes, k)
        return key

    @staticmethod
    def _longer(key, codes, k: int):
        """Keys of the substrings of length k + 1 from those of length k."""
        import numpy as np
        key = (key[:, :-1] ^ codes[:, k:]) * np.uint64(0x9E3779B97F4A7C15)
        return key ^ (key >> np.uint64(29))

    def lookup(self, words: list[str]) -> list:
        """For words of one length n: per piece length, ids [word, start], -1
        where no piece; single characters always have one."""
        import numpy as np
        n = len(words[0])
        codes = self._codes(words, n)
        out = []
        want = self._keys(codes, 0)
        for size in range(1, min(self.longest, n) + 1):
            keys, ids = self.tables[size - 1]
            want = self._longer(want, codes, size - 1)
            found = np.full(want.shape, -1)
            if len(keys):  # few substrings are pieces: most end at the marks
                at = np.nonzero(self.marks[size - 1][want >> np.uint64(64 - MARK_BITS)])
                own = want[at]
                near = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                found[at] = np.where(keys[near] == own, ids[near], -1)
            out.append(np.where(found < 0, self.size - 1, found) if size == 1 else found)
        return out


def _forward(found: list, prob):
    """Logs of the forward sums over all segmentations, [word, place, model].
    prob: [pieces + 1, models], the last row 0."""
    import numpy as np
    m, n = found[0].shape
    logs = np.zeros((m, n + 1, prob.shape[1]))
    for j in range(1, n + 1):
        total = prob[found[0][:, j - 1]]
        for size in range(2, min(len(found), j) + 1):
            ids = found[size - 1][:, j - size]
            at = np.flatnonzero(ids >= 0)  # few words have a long piece here
            if len(at):
                total[at] += prob[ids[at]] * np.exp(logs[at, j - size] - logs[at, j - 1])
        logs[:, j] = logs[:, j - 1] + np.log(total)
    return logs


def _by_length(words: list[str], most: int = 200_000) -> Iterator[list[int]]:
    """Positions of the words, grouped by length, at most so many characters at once."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    a = 0
    while a < len(order):
        n = len(words[order[a]])
        b = a
        while b < len(order) and len(words[order[b]]) == n and (b - a) * n < most:
            b += 1
        yield order[a:b]
        a = b


def word_scores(pieces: Pieces, words: list[str], prob):
    """Log-probabilities [word, model], all segmentations summed."""
    import numpy as np
    out = np.zeros((len(words), prob.shape[1]))
    for own in _by_length(words):
        found = pieces.lookup([words[i] for i in own])
        out[own] = _forward(found, prob)[:, -1]
    return out


def expected_pieces(pieces: Pieces, words: list[str], counts, prob):
    """Expected uses of every piece [models, pieces] over all segmentations
    of the words; counts [word, model], prob [pieces + 1, 1 or models]."""
    import numpy as np
    models = counts.shape[1]
    out = np.zeros((models, pieces.size + 1))
    for own in _by_length(words):
        batch = [words[i] for i in own]
        found = pieces.lookup(batch)
        n = len(batch[0])
        ahead = _forward(found, prob)
        # the backward sums are the forward sums of the reversed lattice
        back = [f[:, ::-1] for f in found]
        behind = _forward(back, prob)[:, ::-1]
        whole = ahead[:, -1]
        weight = counts[own]
        for size, ids in enumerate(found, 1):
            for start in range(n - size + 1):
                at = np.flatnonzero(ids[:, start] >= 0)
                if not len(at):
                    continue
                own_ids = ids[at, start]
                p = prob[own_ids]
                with np.errstate(divide="ignore"):
                    share = np.exp(ahead[at, start] + np.log(p) + behind[at, start + size] - whole[at])
                for model in range(models):
                    np.add.at(out[model], own_ids, weight[at, model] * share[:, model if share.shape[1] > 1 else 0])
    return out[:, :pieces.size]


def words_of(text: str | None) -> dict[str, int]:
    """Lower-cased runs of letters of the whole text, with the word start."""
    counts: dict[str, int] = {}
    get = counts.get
    if text:
        for raw, n in Counter(text.lower().split()).items():
            if raw.isalpha():
                w = SPACE + raw
                counts[w] = get(w, 0) + n
            else:
                for run in _LETTERS.findall(raw):
                    for w in (run,) if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split():
                        w = SPACE + w
                        counts[w] = get(w, 0) + n
    return counts


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def fit(train: DataFrame, *, vocabulary: str | None = None, rounds: int = 1, smoothing: float = 0.1,
        flush_words: int = 150_000):
    """Fit on every row of ``train`` (text, lang; null lang ignored). Returns
    (languages, prior, prob [pieces + 1, languages], vocabulary path).

    Every partition sums the expected uses of its own words; the sums, at most
    pieces x languages numbers, are added by Spark and then collected.
    """
    import numpy as np
    path = vocabulary or default_vocabulary_path()
    rows = train.select("text", "lang").where("lang IS NOT NULL")
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(seen)
    index = {x: i for i, x in enumerate(langs)}
    pieces = pieces_of(path)
    prior = np.array([seen[x] for x in langs], dtype=float)
    prior /= max(prior.sum(), 1.0)
    prob = np.append(np.full((pieces.size, 1), 1.0 / pieces.size), [[0.0]], axis=0)
    if not langs:
        return langs, prior, prob, path

    for _ in range(rounds):
        def expect(batches: Iterator, prob=prob) -> Iterator:
            import pyarrow as pa
            own = pieces_of(path)
            total = np.zeros((len(langs), own.size))
            words: dict[str, Counter] = {}
            size = 0

            def flush():
                nonlocal size
                names = sorted(set().union(*words.values()))
                if names:
                    place = {w: i for i, w in enumerate(names)}
                    counts = np.zeros((len(names), len(langs)))
                    for x, own_words in words.items():
                        at = np.fromiter(map(place.__getitem__, own_words), dtype=np.int64, count=len(own_words))
                        counts[at, index[x]] = np.fromiter(own_words.values(), dtype=float, count=len(own_words))
                    np.add(total, expected_pieces(own, names, counts, prob), out=total)
                words.clear()
                size = 0

            for batch in batches:
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    into = words.setdefault(lang, Counter())
                    before = len(into)
                    into.update(words_of(text))
                    size += len(into) - before
                    if size > flush_words:
                        flush()
            flush()
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int64()), pa.array(at[1], pa.int64()),
                                              pa.array(total[at], pa.float64())], ["lang", "piece", "uses"])

        uses = (rows.mapInArrow(expect, "lang long, piece long, uses double")
                .groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect())
        counts = np.full((pieces.size, len(langs)), smoothing)
        for r in sorted(uses):
            counts[r["piece"], r["lang"]] += r["uses"]
        prob = np.append(counts / counts.sum(axis=0), np.zeros((1, len(langs))), axis=0)
    return langs, prior, prob, path


def predict(docs: DataFrame, model, *, keep: list[str], most_words: int = 150_000) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred and score, the posterior of
    the prediction. Ties go to the language first in order of its name. A text
    that is null or has no letter gets ``und`` and 0.0, as does every text if
    the model has seen no language."""
    langs, prior, prob, path = model
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((langs, prior, prob))  # pieces x languages numbers
    rows = docs.select(*keep, "text")
    schema = rows.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        langs, prior, prob = shared.value
        pieces = pieces_of(path)
        known: dict[str, int] = {}
        table = np.zeros((most_words, len(langs)))
        start = np.log(np.maximum(prior, 1e-300)) if langs else None
        for batch in batches:
            preds, scores = [], []
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = [words_of(t) for t in part.column(part.num_columns - 1).to_pylist()]
                names = list(set().union(*counts)) if langs else []
                fresh = [w for w in names if w not in known]
                if len(known) + len(fresh) > most_words:
                    known.clear()
                    fresh = names
                new = word_scores(pieces, fresh, prob) if fresh else None
                if new is not None and len(fresh) > most_words:  # one batch beyond the memo: a table of its own
                    local, where = new, {w: i for i, w in enumerate(fresh)}
                else:
                    if new is not None:
                        base = len(known)
                        table[base:base + len(fresh)] = new
                        known.update((w, base + i) for i, w in enumerate(fresh))
                    local, where = table, known
                for c in counts:
                    if not c or not langs:
                        preds.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    rows_at = np.fromiter(map(where.__getitem__, c), dtype=np.int64, count=len(c))
                    log_p = np.fromiter(c.values(), dtype=float, count=len(c)) @ local[rows_at] + start
                    best = int(log_p.argmax())
                    preds.append(langs[best])
                    scores.append(float(1.0 / np.exp(log_p - log_p[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(score, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame, *, vocabulary: str | None = None) -> DataFrame:
    """Fit on the rows that aren't held out and have a lang, predict all."""
    rows = docs.withColumn("held_out", held_out())
    model = fit(rows.where("NOT held_out"), vocabulary=vocabulary)
    return predict(rows, model, keep=["doc_id", "held_out"])
