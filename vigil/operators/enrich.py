"""Enrichment: deterministic built-in scorers and the pluggable ``enrich``
dataflow (pick unenriched documents -> score -> store by id).

The reference asks a remote LLM / spaCy per document. Here the dataflow is
a Spark job and the default scorers are Catalyst-only (explode, join,
aggregate, rank), so results are reproducible and testable without network.
They are stand-ins for the models, not equal to them. A user's own model
plugs in through ``enrich(..., scorer=fn, schema=...)`` (``mapInPandas``:
the model is loaded once per Python worker and fed Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.text import chunk_text, sentences, words
from vigil.operators.catalog import missing_enrichments
from vigil.operators.joins import top_k
from vigil.schemas import CHUNK_TOKEN_LIMIT, DIM_EMOTION_ROWS

SCORE_DIGITS = 6
#: least letters of a topic word; lexicons are matched on all words
TOPIC_MIN_LETTERS = 4


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _keyed(docs: DataFrame, ks: list[str]) -> DataFrame:
    """Rows with non-null keys. Stating the non-null conditions that the
    joins downstream would otherwise infer keeps every consumer's subtree
    identical, so Spark reuses one exchange instead of re-tokenising the
    text for each consumer."""
    cond = None
    for k in ks:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return docs.filter(cond)


def _texts(docs: DataFrame, ks: list[str], text: str) -> DataFrame:
    """(keys.., texts): a row per key with all its texts. Texts are left where
    they lie if no key repeats (a look at the keys alone); otherwise those of
    a key are brought together."""
    docs = _keyed(docs, ks).select(*ks, F.col(text).alias("_t"))
    if docs.groupBy(*ks).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return docs.select(*ks, F.array("_t").alias("texts"))
    return docs.groupBy(*ks).agg(F.collect_list("_t").alias("texts"))


def _count_words(places: bool):
    """Rows (keys.., [[[word, ..] per sentence] per text]) -> (keys.., term, tf
    and, with ``places``, at: the sentence number of every occurrence). Counted
    batch by batch in numpy: nothing is sorted or kept beyond a batch."""
    def count(batches):
        import numpy as np
        import pyarrow as pa

        def inner(lists):   # the parent of every element, and the elements
            return lists.value_parent_indices().to_numpy(), lists.flatten()
        for batch in batches:
            row, texts = inner(batch.column(batch.num_columns - 1))
            if not len(texts):
                continue
            first, sentences = inner(texts)
            if not len(sentences):
                continue
            sentence, words = inner(sentences)
            if not len(words):
                continue
            spos = np.arange(len(sentences)) - np.searchsorted(first, first)
            row = row[first][sentence]
            coded = words.dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            # term by term: the rows of a term lie together, and shuffle as few bytes
            group = code * batch.num_rows + row
            order = np.argsort(group, kind="stable")
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            head = order[starts]
            ends = np.append(starts[1:], len(order))
            out = [c.take(pa.array(row[head])) for c in batch.columns[:-1]]
            out += [coded.dictionary.take(pa.array(code[head])), pa.array(ends - starts, pa.int64())]
            names = [*batch.schema.names[:-1], "term", "tf"]
            if places:
                out.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()),
                                                    pa.array(spos[sentence][order], pa.int32())))
                names.append("at")
            yield pa.RecordBatch.from_arrays(out, names)
    return count


def _counted(rows: DataFrame, ks: list[str], places: bool) -> DataFrame:
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in ks)
    return rows.mapInArrow(_count_words(places), f"{kinds}, term string, tf long" + (", at array<int>" if places else ""))


def term_frequencies(docs: DataFrame, key="video_id", text: str = "text",
                     min_letters: int = 1) -> DataFrame:
    """(keys.., term, tf) over the whole text, counted where the text lies."""
    ks = _keys(key)
    found = F.transform("texts", lambda t: F.array(F.coalesce(words(t, min_letters), F.array().cast("array<string>"))))
    return _counted(_texts(docs, ks, text).select(*ks, found.alias("w")), ks, False)


def _statistics(tf: DataFrame, docs: DataFrame, ks: list[str]) -> DataFrame:
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = docs.select(*ks).distinct().agg(F.count(F.lit(1)).alias("df"))
    return n.select(F.lit(None).cast("string").alias("term"), "df").unionByName(df)


def term_statistics(docs: DataFrame, key="video_id", text: str = "text",
                    min_letters: int = TOPIC_MIN_LETTERS) -> DataFrame:
    """(term, df): in how many documents every term stands; the row with a
    null term holds the number of documents. A table to be stored."""
    ks = _keys(key)
    return _statistics(term_frequencies(docs, ks, text, min_letters), docs, ks)


def corpus_statistics(docs: DataFrame, key="video_id", text: str = "text") -> DataFrame:
    """``term_statistics`` as a table: its readers (the number of documents,
    the frequencies) don't tokenise the corpus again."""
    from vigil.sources.files import scratch_dir, write_scratch
    path = scratch_dir(docs.sparkSession, "corpus_statistics")
    write_scratch(term_statistics(docs, key, text), path)
    return docs.sparkSession.read.parquet(path)


def merge_statistics(stored: DataFrame, added: DataFrame) -> DataFrame:
    """Statistics of both sets of documents (which share none)."""
    return stored.unionByName(added).groupBy("term").agg(F.sum("df").cast("long").alias("df"))


def statistics_table(spark, root: str, buckets: int = 64):
    """Stored document frequencies (term, df) as a keyed table, whose note is
    the number of documents and whose batches are the ledger of what it holds."""
    from vigil.schemas import TERM_STATISTICS
    from vigil.sources.keyed import KeyedTable
    return KeyedTable(spark, f"{root}/term_statistics", TERM_STATISTICS, "term", buckets)


def add_statistics(table, docs: DataFrame, batch: str, key="video_id", text: str = "text",
                   min_letters: int = TOPIC_MIN_LETTERS) -> bool:
    """Add the documents of a batch to stored statistics: only their texts are
    tokenised, and only rows of terms that they hold are written. A batch that
    the ledger names adds nothing (False). Batches share no document."""
    from vigil.sources.files import scratch_dir, write_scratch
    if batch in table.batches():
        return False
    spark = table.spark
    path = scratch_dir(spark, "batch_statistics")
    write_scratch(term_statistics(docs, key, text, min_letters), path)
    added = spark.read.parquet(path)
    n = added.filter(F.col("term").isNull()).agg(F.sum("df")).first()[0] or 0
    terms = added.filter(F.col("term").isNotNull())
    before = table.read().withColumnRenamed("df", "_before")
    new = terms.join(before, "term", "left").select("term", (F.col("df") + F.coalesce("_before", F.lit(0))).alias("df"))
    return table.change(new, batch=batch, note=table.note() + n)


def stored_statistics(table) -> DataFrame:
    """``term_statistics`` of all batches added so far."""
    n = table.spark.createDataFrame([(None, table.note())], table.schema)
    return n.unionByName(table.read())


def tfidf_from_tf(tf: DataFrame, statistics: DataFrame) -> DataFrame:
    """Add df and score = round(tf * ln(N / df), 6) to (keys.., term, tf).
    Terms that the statistics don't hold get no row: they must cover the
    documents. The number of documents is the one number collected."""
    n = statistics.filter(F.col("term").isNull()).agg(F.sum("df")).first()[0] or 0
    score = F.round(F.col("tf") * F.log(F.lit(float(n)) / F.col("df")), SCORE_DIGITS)
    return tf.join(statistics.filter(F.col("term").isNotNull()), "term").withColumn("score", score)


def tfidf(docs: DataFrame, key="video_id", text: str = "text",
          statistics: DataFrame | None = None, min_letters: int = TOPIC_MIN_LETTERS) -> DataFrame:
    """(keys.., term, tf, df, score) over whole texts. ``statistics`` are
    those of the corpus; without them ``docs`` is the corpus."""
    ks = _keys(key)
    tf = term_frequencies(docs, ks, text, min_letters)
    return tfidf_from_tf(tf, _statistics(tf, docs, ks) if statistics is None else statistics)


def topic_list(docs: DataFrame, key="video_id", text: str = "text", k: int = 3,
               statistics: DataFrame | None = None) -> DataFrame:
    """Top-k TF-IDF terms per document as (keys.., topic, rank); ties by term."""
    scored = tfidf(docs, key, text, statistics)
    best = top_k(scored, _keys(key), [F.col("score").desc(), F.col("term")], k)
    return best.select(*_keys(key), F.col("term").alias("topic"), "rank")


def main_topic(docs: DataFrame, key="video_id", text: str = "text",
               statistics: DataFrame | None = None) -> DataFrame:
    """The top TF-IDF term per document (null for a text without words)."""
    ks = _keys(key)
    top = topic_list(docs, ks, text, 1, statistics).select(*ks, F.col("topic").alias("main_topic"))
    return docs.select(*ks).join(top, ks, "left")


def _lexicon_scores(tf, ks, lexicon, label_col):
    """Summed ``tf * weight`` per document (and label) from a tf table."""
    hits = tf.join(lexicon, "term")
    grp = ks + ([label_col] if label_col else [])
    return hits.groupBy(*grp).agg(
        F.round(F.sum(F.col("tf") * F.col("weight")), SCORE_DIGITS).alias("score"))


def emotion_from_tf(doc_keys: DataFrame, tf: DataFrame, lexicon: DataFrame, ks: list[str],
                    out: str = "emotion") -> DataFrame:
    scores = _lexicon_scores(tf, ks, lexicon, "label")
    best = scores.groupBy(*ks).agg(F.min(F.struct((-F.col("score")).alias("s"),
                                                  F.col("label").alias("l"))).alias("_b"))
    return doc_keys.join(best.select(*ks, F.col("_b.l").alias(out)), ks, "left")


def sentiment_from_tf(doc_keys: DataFrame, tf: DataFrame, lexicon: DataFrame,
                      ks: list[str]) -> DataFrame:
    scores = _lexicon_scores(tf, ks, lexicon.select("term", "weight"), None)
    return doc_keys.join(scores.select(*ks, (F.col("score") > 0).alias("sentiment")), ks, "left")


def classify_emotion(docs: DataFrame, lexicon: DataFrame, key="video_id", text: str = "text",
                     out: str = "emotion") -> DataFrame:
    """Lexicon arg-max: lexicon ``(term, label, weight)``; per document the
    label with the highest summed ``tf * weight`` (ties: smallest label);
    null when no lexicon term occurs."""
    ks = _keys(key)
    return emotion_from_tf(docs.select(*ks), term_frequencies(docs, ks, text), lexicon, ks, out)


def classify_sentiment(docs: DataFrame, lexicon: DataFrame, key="video_id",
                       text: str = "text") -> DataFrame:
    """Signed lexicon ``(term, weight)``: sentiment = summed score > 0;
    null when no lexicon term occurs."""
    ks = _keys(key)
    return sentiment_from_tf(docs.select(*ks), term_frequencies(docs, ks, text), lexicon, ks)


def term_places(docs: DataFrame, ks: list[str], text: str) -> DataFrame:
    """(keys.., term, tf, at) with ``at`` the sentence number of every occurrence,
    from one tokenisation: words never cross a sentence boundary. Counted
    where the text lies."""
    found = F.transform("texts", lambda t: F.transform(
        F.coalesce(sentences(t), F.array().cast("array<string>")), lambda x: words(x)))
    return _counted(_texts(docs, ks, text).select(*ks, found.alias("w")), ks, True)


def scored_places(places: DataFrame, statistics: DataFrame, min_letters: int = TOPIC_MIN_LETTERS) -> DataFrame:
    """``term_places`` with the TF-IDF score of topic words that the statistics
    hold (null for others); score as in ``tfidf_from_tf``. Shorter words have
    no score and need no places, so theirs aren't shuffled."""
    n = statistics.filter(F.col("term").isNull()).agg(F.sum("df")).first()[0] or 0
    known = statistics.filter(F.col("term").isNotNull() & (F.length("term") >= min_letters))
    at = F.when(F.length("term") >= min_letters, F.col("at"))
    return places.withColumn("at", at).join(known, "term", "left").withColumn(
        "score", F.round(F.col("tf") * F.log(F.lit(float(n)) / F.col("df")), SCORE_DIGITS)).drop("df")


def summary_from(docs: DataFrame, scored: DataFrame, ks: list[str], text: str, n: int) -> DataFrame:
    """Top-n sentences by mean TF-IDF of their topic words, in order, from
    ``scored_places``. The positions are chosen first; the sentences are cut
    from the text last."""
    ss = (scored.filter(F.col("score").isNotNull()).select(*ks, "score", F.explode("at").alias("spos"))
                .groupBy(*ks, "spos").agg(F.round(F.avg("score"), SCORE_DIGITS).alias("sscore")))
    best = top_k(ss, ks, [F.col("sscore").desc(), F.col("spos")], n)
    chosen = best.groupBy(*ks).agg(F.sort_array(F.collect_list("spos")).alias("_at"))
    cut = F.array_join(F.transform("_at", lambda i: F.get(F.col("_all"), i)), " ")
    return (docs.select(*ks, text).join(chosen, ks, "left")
                .select(*ks, "_at", F.when(F.col("_at").isNotNull(), sentences(F.col(text))).alias("_all"))
                .select(*ks, F.when(F.col("_at").isNotNull(), cut).alias("summary")))


def summarize(docs: DataFrame, key="video_id", text: str = "text", n: int = 2,
              statistics: DataFrame | None = None) -> DataFrame:
    """Extractive summary: sentences scored by the mean TF-IDF of their topic
    words (rounded), the top ``n`` (ties: earlier first) joined in reading
    order. ``statistics`` as in ``tfidf``."""
    ks = _keys(key)
    if statistics is None:
        statistics = corpus_statistics(docs, ks, text)
    places = term_places(docs, ks, text)
    return summary_from(docs, scored_places(places, statistics), ks, text, n)


def dim_emotions(spark) -> DataFrame:
    return spark.createDataFrame(DIM_EMOTION_ROWS, "emotion string, primary int, emotion_id int")


def validate_labels(labels: DataFrame, dim: DataFrame, key: str = "video_id") -> DataFrame:
    """Attach emotion ids: primary_emotion against primary=1 rows, secondary
    against primary=0 rows; ``valid`` is false when a present label is not
    in its closed set (those rows form the reject table)."""
    d = dim
    p = d.filter("primary = 1").select(F.col("emotion").alias("primary_emotion"),
                                       F.col("emotion_id").alias("primary_emotion_id"))
    s = d.filter("primary = 0").select(F.col("emotion").alias("secondary_emotion"),
                                       F.col("emotion_id").alias("secondary_emotion_id"))
    out = labels.join(p, "primary_emotion", "left").join(s, "secondary_emotion", "left")
    ok_p = F.col("primary_emotion").isNull() | F.col("primary_emotion_id").isNotNull()
    ok_s = F.col("secondary_emotion").isNull() | F.col("secondary_emotion_id").isNotNull()
    return out.withColumn("valid", ok_p & ok_s)


def rejected_labels(labels: DataFrame, dim: DataFrame, key: str = "video_id") -> DataFrame:
    return validate_labels(labels, dim, key).filter(~F.col("valid"))


def merge_chunk_labels(chunks: DataFrame, key: str = "video_id",
                       chunk: str = "chunk_id") -> DataFrame:
    """Combine per-chunk results into one record per document: text labels
    joined with ',' in chunk order; main topics distinct, sorted, joined with
    ' and '; sentiment by majority (tie -> first chunk's). Null chunk labels
    are skipped; a label null in every chunk stays null."""
    def ordered(c):
        pairs = F.collect_list(F.when(F.col(c).isNotNull(),
                                      F.struct(F.col(chunk).alias("k"), F.col(c).alias("v"))))
        joined = F.array_join(F.transform(F.array_sort(pairs), lambda x: x["v"]), ",")
        return F.when(F.size(pairs) > 0, joined).alias(c)

    pos = F.sum(F.when(F.col("sentiment"), 1).otherwise(0))
    neg = F.sum(F.when(~F.col("sentiment"), 1).otherwise(0))
    first = F.min_by(F.col("sentiment"), F.col(chunk))
    sentiment = F.when(pos > neg, True).when(neg > pos, False).otherwise(first)
    return chunks.groupBy(key).agg(
        ordered("summary"), ordered("summary_reasoning"), sentiment.alias("sentiment"),
        ordered("primary_emotion"), ordered("secondary_emotion"),
        F.when(F.count("main_topic") > 0,
               F.array_join(F.array_sort(F.collect_set("main_topic")), " and "))
         .alias("main_topic"),
        F.count(F.lit(1)).alias("chunks"))


def chunks_of(docs: DataFrame, key: str = "video_id", text: str = "text",
              limit: int = CHUNK_TOKEN_LIMIT) -> DataFrame:
    """(key, chunk_id, text) rows; long texts spread over tasks."""
    return docs.select(key, F.posexplode(chunk_text(F.col(text), limit)).alias("chunk_id", text))


def overall_classification(docs: DataFrame, emotion_lexicon: DataFrame,
                           secondary_lexicon: DataFrame, sentiment_lexicon: DataFrame,
                           key: str = "video_id", text: str = "text",
                           limit: int = CHUNK_TOKEN_LIMIT, summary_sentences: int = 2,
                           statistics: DataFrame | None = None) -> DataFrame:
    """Chunk -> score every chunk (summary, sentiment, two emotions, main
    topic) -> merge to one record per document.

    The chunks are written once as a Parquet table in the shared folder and
    tokenised once; a chunk's terms, with their places, scores and lexicon
    entries, are then dealt by chunk once, and the scorers are aggregates over
    those rows where they lie. ``statistics`` are those of the corpus (by
    document); without them ``docs`` is the corpus."""
    from vigil.sources.files import scratch_dir, write_scratch
    spark = docs.sparkSession
    if statistics is None:
        statistics = corpus_statistics(docs, key, text)
    path = scratch_dir(spark, "chunks")
    write_scratch(chunks_of(docs, key, text, limit), path, "zstd")
    ch = spark.read.parquet(path)
    ks = [key, "chunk_id"]
    # one row per chunk and term with everything that the scorers need, dealt by chunk
    marks = _lexicon_marks({"primary": emotion_lexicon, "secondary": secondary_lexicon,
                            "sentiment": sentiment_lexicon.withColumn("label", F.lit("sentiment"))})
    scored = scored_places(term_places(ch, ks, text), statistics).join(marks, "term", "left")
    path = scratch_dir(spark, "scored_terms")
    write_scratch(scored.filter(F.col("score").isNotNull() | F.col("marks").isNotNull()).repartition(*ks), path, "zstd")
    scored = spark.read.parquet(path)

    best = F.min(F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("s"), F.col("term").alias("t"))))
    topic = scored.groupBy(*ks).agg(best.alias("_t")).select(*ks, F.col("_t.t").alias("main_topic"))
    sums = (scored.filter(F.col("marks").isNotNull()).select(*ks, "tf", F.explode("marks").alias("m"))
            .groupBy(*ks, "m.lexicon", "m.label").agg(F.round(F.sum(F.col("tf") * F.col("m.weight")), SCORE_DIGITS).alias("score")))

    def strongest(lexicon):
        return F.min(F.when(F.col("lexicon") == lexicon, F.struct((-F.col("score")).alias("s"), F.col("label").alias("l"))))
    labels = (sums.groupBy(*ks).agg(strongest("primary").alias("_p"), strongest("secondary").alias("_q"), strongest("sentiment").alias("_s"))
              .select(*ks, F.col("_p.l").alias("primary_emotion"), F.col("_q.l").alias("secondary_emotion"),
                      (F.col("_s.s") < 0).alias("sentiment")))
    parts = (summary_from(ch, scored, ks, text, summary_sentences)
             .join(labels, ks, "left").join(topic, ks, "left")
             .withColumn("summary_reasoning", F.lit(None).cast("string")))
    return merge_chunk_labels(parts, key, "chunk_id")


def _lexicon_marks(lexicons: dict[str, DataFrame]) -> DataFrame:
    """(term, marks): the (lexicon, label, weight) entries of every term; as
    many rows as the lexicons have terms."""
    rows = None
    for name, lexicon in lexicons.items():
        part = lexicon.select("term", F.struct(F.lit(name).alias("lexicon"), "label", "weight").alias("m"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("term").agg(F.collect_list("m").alias("marks"))


def enrich(docs: DataFrame, key: str, scorer: Callable, schema=None,
           store: DataFrame | None = None) -> DataFrame:
    """Get-or-compute: documents with no stored result (``left_anti`` on
    ``key``) are scored. ``scorer`` is either a DataFrame -> DataFrame
    function (built-in Catalyst scorers) or, with ``schema``, a
    ``mapInPandas`` function over Arrow batches (a user's own model)."""
    todo = docs if store is None else missing_enrichments(docs, store, key)
    if schema is not None:
        return todo.mapInPandas(scorer, schema)
    return scorer(todo)


def enrich_checked(docs: DataFrame, key: str, scorer: Callable, columns: dict[str, str],
                   labels: dict[str, list[str]] | None = None, text: str = "text",
                   store: DataFrame | None = None, batch: int = 64) -> DataFrame:
    """A user's model under a checked contract: key, the declared ``columns``
    (name -> Spark type) and ``error`` for every document without a stored
    result.

    ``scorer`` gets a list of texts and returns as many dicts. If a call
    fails, its texts are tried one by one, so an exception costs one row and
    not the job. A row has an ``error`` (and nulls) if the scorer failed on it,
    if a column is missing or not declared, or if a value isn't one of its
    column's ``labels``; null is always allowed. Keep rows without an error
    (``split_errors``); the others stay unstored and are tried again next time."""
    todo = docs if store is None else missing_enrichments(docs, store, key)
    declared, closed = list(columns), {c: frozenset(v) for c, v in (labels or {}).items()}
    schema = T.StructType([todo.schema[key], *T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in columns.items())).fields,
                           T.StructField("error", T.StringType())])

    def checked(result) -> tuple[dict, str | None]:
        if not isinstance(result, dict) or set(result) != set(declared):
            got = sorted(result) if isinstance(result, dict) else type(result).__name__
            return {}, f"columns {got}, declared {sorted(declared)}"
        for c, allowed in closed.items():
            if result[c] is not None and result[c] not in allowed:
                return {}, f"{c} {result[c]!r} is not one of its labels"
        return result, None

    def one(text: str) -> tuple[dict, str | None]:
        try:
            return checked(scorer([text])[0])
        except Exception as ex:  # noqa: BLE001 - a model may raise anything; the row says what
            return {}, f"{type(ex).__name__}: {ex}"

    def some(texts: list[str]) -> list[tuple[dict, str | None]]:
        try:
            results = list(scorer(texts))
            if len(results) == len(texts):
                return [checked(r) for r in results]
        except Exception:  # noqa: BLE001 - tried again one by one
            pass
        return [one(t) for t in texts]

    def score(batches):
        import pyarrow as pa
        fields = to_arrow_schema(schema)
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                results = some(part.column(1).to_pylist())
                cols = [part.column(0)]
                for c in declared:
                    values = []
                    for i, (row, _) in enumerate(results):
                        try:
                            values.append(pa.scalar(row.get(c), fields.field(c).type).as_py())
                        except (pa.ArrowInvalid, pa.ArrowTypeError) as ex:
                            values.append(None)
                            results[i] = ({}, f"{c}: {ex}")
                    cols.append(pa.array(values, fields.field(c).type))
                # a value of another type clears its whole row
                bad = pa.array([e is not None for _, e in results])
                cols = [cols[0], *(pa.compute.if_else(bad, pa.scalar(None, x.type), x) for x in cols[1:]),
                        pa.array([e for _, e in results], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, schema=fields)

    from pyspark.sql.pandas.types import to_arrow_schema
    return todo.select(key, F.coalesce(text, F.lit("")).alias(text)).mapInArrow(score, schema)


def split_errors(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to store, failed rows) of ``enrich_checked``, scored once."""
    from vigil.sources.files import scratch_dir, write_scratch
    path = scratch_dir(scored.sparkSession, "scored")
    write_scratch(scored, path)
    rows = scored.sparkSession.read.parquet(path)
    return rows.filter(F.col("error").isNull()).drop("error"), rows.filter(F.col("error").isNotNull())
