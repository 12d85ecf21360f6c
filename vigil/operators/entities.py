"""Entity operators: extraction stand-in, de-duplication, short-form
removal and "which documents mention X" searches.

Entity rows are ``(source_id, entity_type, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.catalog import join_channels, video_channel
from vigil.schemas import ENTITY_TYPES

# FIXED VALUES of the deterministic extractor (our own rules, not a model):
# a number-like span (optionally with currency prefix, % or ordinal suffix)
# or a clock time; and a run of capitalised words separated by single spaces,
# of any length. The repeated groups are possessive (*+): what follows them
# can always match, so they find the same spans, and Java loops over them;
# a plain * recurses once a repetition and overflows the stack on long runs.
NUMBER_SPAN = r"\d{1,2}:\d{2}|[$€£]?\d+(?:[.,]\d+)*+(?:%|st|nd|rd|th)?"
PROPER_SPAN = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*+"
WORD = r"[\p{L}\p{N}]+"
YEAR = r"^(19|20)\d\d$"
TIME = r"^\d{1,2}:\d{2}$"


def number_type(v):
    """Type of a number-like span."""
    return (F.when(v.rlike(TIME), "TIME")
             .when(v.rlike(r"^[$€£]"), "MONEY")
             .when(v.endswith("%"), "PERCENT")
             .when(v.rlike(r"(st|nd|rd|th)$"), "ORDINAL")
             .when(v.rlike(YEAR), "DATE")
             .otherwise("CARDINAL"))


def extract_entities(docs: DataFrame, key: str = "video_id", text: str = "text",
                     gazetteer: DataFrame | None = None,
                     proper_noun_type: str | None = None) -> DataFrame:
    """Pattern entities from the whole text, one row per occurrence with its
    position in reading order: number-like spans typed by shape; capitalised
    runs typed by a gazetteer ``(term, entity_type)`` (case-insensitive) or by
    ``proper_noun_type``; untyped runs are dropped."""
    found = docs.select(F.col(key).alias("source_id"), F.posexplode(
        F.regexp_extract_all(F.col(text), F.lit(f"{NUMBER_SPAN}|{PROPER_SPAN}"), 0)).alias("pos", "value"))
    found = found.withColumn("pos", F.col("pos").cast("long"))
    run = F.col("value").rlike(r"^\p{Lu}")
    proper = F.lit(proper_noun_type).cast("string")
    if gazetteer is not None:
        g = gazetteer.select(F.lower("term").alias("_t"), F.col("entity_type").alias("_gt"))
        found = found.withColumn("_t", F.when(run, F.lower("value"))).join(g, "_t", "left")
        proper = F.coalesce(F.col("_gt"), proper)
    typed = found.withColumn("entity_type", F.when(run, proper).otherwise(number_type(F.col("value"))))
    return typed.filter(F.col("entity_type").isNotNull()).select("source_id", "entity_type", "value", "pos")


#: terms up to which a gazetteer's automaton is sent to the tasks
AUTOMATON_TERMS = 1_000_000


def gazetteer_entities(docs: DataFrame, gazetteer: DataFrame, key: str = "video_id",
                       text: str = "text", longest: bool = False,
                       automaton_terms: int = AUTOMATON_TERMS) -> DataFrame:
    """Every run of words that spells a term of ``gazetteer`` (term,
    entity_type), in any case, with its word position: (source_id,
    entity_type, value, pos). Terms are words separated by single spaces.
    Overlapping terms are all found; with ``longest``, from left to right the
    longest term at each place and none inside it. A null text gives none.

    The terms become one automaton (a trie with failure links) that reads a
    text once, whatever their number and lengths, and only hits leave the
    task. It is sent to the tasks if the gazetteer has at most
    ``automaton_terms`` terms; beyond that, word runs are joined with it."""
    g = gazetteer.filter(F.col("term").isNotNull()).select(F.lower("term").alias("_t"), "entity_type").distinct()
    terms = [r["_t"] for r in g.select("_t").distinct().limit(automaton_terms + 1).collect()]
    if len(terms) > automaton_terms:
        found = _term_runs(docs, g, key, text)
    else:
        found = _automaton_hits(docs, terms, key, text)
    if longest:
        found = _leftmost_longest(found)
    return found.withColumn("_t", F.lower("value")).join(g, "_t").select("source_id", "entity_type", "value", "pos")


def _words(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("source_id"), F.regexp_extract_all(F.col(text), F.lit(WORD), 0).alias("_w")).filter(F.size("_w") > 0)


def _term_runs(docs: DataFrame, g: DataFrame, key: str, text: str) -> DataFrame:
    """(source_id, value, pos) by joining the word runs of the lengths that
    terms have: a word yields one row per length."""
    lengths = [r["n"] for r in g.select(F.size(F.split("_t", " ")).alias("n")).distinct().collect()]

    def run(i, n):
        return F.when(i + n <= F.size("_w"), F.array_join(F.slice("_w", i + 1, F.lit(n)), " "))
    grams = F.transform("_w", lambda w, i: F.array(*[run(i, n) for n in sorted(lengths)]))
    found = (_words(docs, key, text).select("source_id", F.posexplode(grams).alias("pos", "_g"))
             .select("source_id", F.col("pos").cast("long").alias("pos"), F.explode("_g").alias("value"))
             .filter(F.col("value").isNotNull()))
    return found.join(g.select("_t").distinct(), F.lower("value") == F.col("_t"), "left_semi").select("source_id", "value", "pos")


def _automaton_hits(docs: DataFrame, terms: list[str], key: str, text: str) -> DataFrame:
    """(source_id, value, pos) by one pass over each text's words."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(terms)
    texts = _words(docs, key, text).withColumn("_low", F.lower(F.array_join("_w", " ")))
    schema = T.StructType([T.StructField("source_id", texts.schema["source_id"].dataType),
                           T.StructField("value", T.StringType()), T.StructField("pos", T.LongType())])

    def find(batches):
        import bisect
        import re

        import ahocorasick
        import pyarrow as pa
        machine = ahocorasick.Automaton()
        for t in known.value:
            machine.add_word(f" {t} ", t.count(" ") + 1)
        if known.value:
            machine.make_automaton()
        for batch in batches:
            rows, values, places = [], [], []
            ids, words, lows = batch.columns
            for i, (ws, low) in enumerate(zip(words.to_pylist(), lows.to_pylist(), strict=True)):
                line, starts = f" {low} ", None
                for end, n in machine.iter(line) if known.value else ():
                    if starts is None:
                        starts = [m.start() for m in re.finditer(" ", line)]
                    last = bisect.bisect_left(starts, end)       # words before the hit's closing space
                    rows.append(i)
                    values.append(" ".join(ws[last - n:last]))
                    places.append(last - n)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(values, pa.string()),
                                              pa.array(places, pa.int64())], ["source_id", "value", "pos"])

    return texts.select("source_id", "_w", "_low").mapInArrow(find, schema)


def _leftmost_longest(found: DataFrame) -> DataFrame:
    """Of overlapping hits the one that begins first, of those the longest;
    what remains overlaps none of the chosen. Only places are gathered by
    document, at most one for each of its words."""
    n = F.size(F.split("value", " "))
    at = found.groupBy("source_id", "pos").agg(F.max(n).cast("long").alias("_n"))
    spans = at.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("pos", "_n"))).alias("_s"))

    def choose(batches):
        import pyarrow as pa
        for batch in batches:
            rows, cols = [], ([], [])
            for i, places in enumerate(batch.column(1).to_pylist()):
                end = 0
                for x in places:
                    if x["pos"] >= end:
                        end = x["pos"] + x["_n"]
                        rows.append(i)
                        cols[0].append(x["pos"])
                        cols[1].append(x["_n"])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["source_id", "pos", "_n"])
    schema = T.StructType([found.schema["source_id"], T.StructField("pos", T.LongType()), T.StructField("_n", T.LongType())])
    kept = spans.mapInArrow(choose, schema).alias("k")
    hit = found.withColumn("_n", n).alias("h")
    same = F.expr("h.source_id <=> k.source_id AND h.pos = k.pos AND h._n = k._n")
    return hit.join(kept, same, "left_semi").select("source_id", "value", "pos")


def unique_entities(ents: DataFrame) -> DataFrame:
    """Distinct (source_id, entity_type, value); with a ``pos`` column the
    first occurrence position is kept (first seen first)."""
    keys = ["source_id", "entity_type", "value"]
    if "pos" in ents.columns:
        return ents.groupBy(*keys).agg(F.min("pos").cast("long").alias("pos"))
    return ents.select(*keys).distinct()


#: letters of the opening by which a position and a shorter value meet, letters
#: that a position carries along, and letters of a block of a long value
OPENING, TAIL, BLOCK = 3, 64, 1024
_DOC = ["source_id", "entity_type"]


def _positions(e: DataFrame) -> DataFrame:
    """(source_id, entity_type, .., _at, _tail): every position of every value
    with the ``TAIL`` letters from there on (at the first position without the
    value's last letter, so that no value holds itself). Long values are cut
    into blocks first, since finding a letter costs its distance from the start."""
    n = F.length("value")
    others = [c for c in e.columns if c != "value"]
    parts = (e.filter(n > 0).select(*others, "value", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).alias("_b"))
             .select(*others, "_b", n.alias("_n"), F.substring("value", F.col("_b") * BLOCK + 1, F.lit(BLOCK + TAIL - 1)).alias("_part")))
    at = F.explode(F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.col("_n") - F.col("_b") * BLOCK)))
    spots = parts.select(*others, "_b", "_n", "_part", at.alias("_i"))
    letters = F.when((F.col("_b") == 0) & (F.col("_i") == 1), F.least(F.lit(TAIL), F.col("_n") - 1)).otherwise(TAIL)
    return spots.select(*others, (F.col("_b") * BLOCK + F.col("_i")).alias("_at"),
                        F.substring("_part", F.col("_i"), letters).alias("_tail"))


def _contained_short(e: DataFrame) -> DataFrame:
    """(source_id, entity_type, value) of the strings of at most ``TAIL`` letters
    that stand inside a longer value of the same document and type: positions
    meet the openings of shorter values, and only where one stands there, its
    lengths are cut out. Values with the same opening and length are one
    opening, so the rows follow the letters and not the pairs of values."""
    n = F.length("value")
    small = e.filter(n <= TAIL)
    openings = small.select(*_DOC, F.substring("value", 1, OPENING).alias("_g"), n.alias("_m")).distinct()
    widths = small.groupBy(*_DOC).agg(F.collect_set(F.least(n, F.lit(OPENING))).alias("_qs"))
    spots = _positions(e.join(widths, _DOC)).select(*_DOC, "_at", "_tail", F.explode("_qs").alias("_q"))
    grams = (spots.filter((F.length("_tail") >= F.col("_q")) & ((F.col("_q") > 0) | (F.col("_at") == 1)))
             .select(*_DOC, F.substring("_tail", F.lit(1), F.col("_q")).alias("_g"), "_tail"))
    return (grams.join(openings, [*_DOC, "_g"]).filter(F.col("_m") <= F.length("_tail"))
            .select(*_DOC, F.substring("_tail", F.lit(1), F.col("_m")).alias("value")).distinct())


def _contained_long(e: DataFrame) -> DataFrame:
    """(source_id, entity_type, _m, _h1, _h2) of the strings of more than
    ``TAIL`` letters that stand inside a longer value of the same document and
    type, as length and 128 bits of hash. The values meet by their first
    ``TAIL`` letters; a value's text is fetched where they do."""
    key = [F.xxhash64("value").alias("_h1"), F.xxhash64(F.lit(7), "value").alias("_h2")]
    big = e.filter(F.length("value") > TAIL).select(*_DOC, "value", *key)
    openings = big.select(*_DOC, F.xxhash64(F.substring("value", 1, TAIL)).alias("_g"), F.length("value").alias("_m")).distinct()
    spots = (_positions(big).filter(F.length("_tail") == TAIL)
             .select(*_DOC, "_h1", "_h2", "_at", F.xxhash64("_tail").alias("_g")))
    hits = spots.join(openings, [*_DOC, "_g"]).select(*_DOC, "_h1", "_h2", "_at", "_m").distinct()
    piece = F.substring("value", F.col("_at"), F.col("_m"))
    inside = (F.col("_m") < F.length("value")) & (F.col("_at") + F.col("_m") - 1 <= F.length("value"))
    return (big.join(hits, [*_DOC, "_h1", "_h2"]).filter(inside)
            .select(*_DOC, "_m", F.xxhash64(piece).alias("_h1"), F.xxhash64(F.lit(7), piece).alias("_h2")).distinct())


def cleaned_entities(ents: DataFrame) -> DataFrame:
    """Remove short forms: a value that is a substring of another (longer)
    value of the same type in the same document is dropped; types outside
    the 18 and null values are dropped.

    A position of a longer value meets a shorter one only where its opening
    stands, by an equi join on document, type and opening, so no pair of values
    is compared and no task receives a whole document. The distinct values
    feed several readers and are written once to the shared folder when the
    DataFrame is built.
    """
    from vigil.sources.files import scratch_dir, write_scratch
    spark = ents.sparkSession
    keys = [*_DOC, "value"]
    e = ents.filter(F.col("value").isNotNull() & F.col("entity_type").isin(*ENTITY_TYPES)).select(*keys).distinct()
    path = scratch_dir(spark, "entity_values")
    write_scratch(e, path)
    e = spark.read.schema(e.schema).parquet(path)
    short = e.filter(F.length("value") <= TAIL).join(_contained_short(e), keys, "left_anti")
    own = e.filter(F.length("value") > TAIL).withColumns(
        {"_m": F.length("value"), "_h1": F.xxhash64("value"), "_h2": F.xxhash64(F.lit(7), "value")})
    long = own.join(_contained_long(e), [*_DOC, "_m", "_h1", "_h2"], "left_anti")
    return short.select(*keys).unionByName(long.select(*keys))


def entity_type_filter(ents: DataFrame, entity_type: str = "any") -> DataFrame:
    if entity_type != "any":
        return ents.filter(F.col("entity_type") == F.lit(entity_type))
    return ents


def videos_containing_entity(entity_index: DataFrame, entity_name: str,
                             entity_type: str = "any") -> DataFrame:
    """Ids whose entity values equal the name case-insensitively; each once."""
    e = entity_type_filter(entity_index, entity_type)
    return (e.filter(F.lower(F.col("value")) == F.lit(entity_name.lower()))
             .select("source_id").distinct())


def _matcher(pattern: str, mode: str):
    v = F.lower(F.col("value"))
    if mode == "regex":
        # (?iu) instead of lower-casing the pattern (lower-casing breaks \S etc.)
        return F.col("value").rlike("(?iu)" + pattern)
    if mode == "substring":
        return v.contains(pattern.lower())
    raise ValueError(f"unknown mode {mode!r}")


def with_channel_info(rows: DataFrame, listing: DataFrame, channels: DataFrame,
                      key: str = "source_id") -> DataFrame:
    """Attach channel_id ('' when the document is in no listing) and the
    channel columns (null for an unknown channel) to index rows."""
    wanted = listing.join(rows.select(F.col(key).alias("video_id")).distinct(), "video_id", "left_semi")
    vc = video_channel(wanted).select(F.col("video_id").alias(key),
                                      F.col("channel_id").alias("_ch"))
    out = (rows.join(vc, key, "left")
               .withColumn("channel_id", F.coalesce(F.col("_ch").cast("string"), F.lit("")))
               .drop("_ch"))
    return join_channels(out, channels, "left")


def collect_data_containing_entity(entity_index: DataFrame, library_index: DataFrame,
                                   listing: DataFrame, channels: DataFrame, entity: str,
                                   mode: str = "regex") -> DataFrame:
    """Index rows of documents whose entity values match ``entity``, with
    their channel columns and an ``entity`` column (lower-cased)."""
    ids = (entity_index.filter(_matcher(entity, mode)).select("source_id").distinct())
    rows = library_index.join(ids, "source_id", "left_semi")
    return (with_channel_info(rows, listing, channels)
            .withColumn("entity", F.lit(entity.lower())))


def match_patterns(rows: DataFrame, patterns: list[str], mode: str = "regex",
                   keep: list[str] | None = None) -> DataFrame:
    """(keep.., pattern_pos) for every pattern of the list that matches a
    row's ``value``. Each pattern is a literal (compiled once per task), all
    are tested in one pass over the rows, and no nested-loop join is planned."""
    hits = F.array(*[F.when(_matcher(p, mode), F.lit(i)) for i, p in enumerate(patterns)])
    return rows.select(*(keep or ["value"]),
                       F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("pattern_pos"))


def collect_multi_entity_data(entity_index: DataFrame, library_index: DataFrame,
                              listing: DataFrame, channels: DataFrame,
                              entities_list: list[str], mode: str = "regex") -> DataFrame:
    """``collect_data_containing_entity`` for a list in one job: one row per
    (list position, document); a repeated entity repeats its rows; an empty
    list gives an empty result."""
    if not entities_list:
        vals = entity_index.select("value", "source_id").limit(0)
        hits = vals.select("source_id", F.lit(None).cast("int").alias("pattern_pos"))
    else:
        hits = match_patterns(entity_index.select("value", "source_id"), entities_list, mode,
                              keep=["source_id"]).distinct()
    return collect_hits(hits, library_index, listing, channels, entities_list)


def collect_hits(hits: DataFrame, library_index: DataFrame, listing: DataFrame, channels: DataFrame,
                 entities_list: list[str]) -> DataFrame:
    """Index rows of (pattern_pos, source_id) hits with their channel columns
    and the list's entity."""
    spark = hits.sparkSession
    pats = spark.createDataFrame([(i, e.lower()) for i, e in enumerate(entities_list)],
                                 "pattern_pos int, entity string")
    rows = library_index.join(hits, "source_id", "inner")
    # the pattern list is the caller's in-memory list: its size is known
    return (with_channel_info(rows, listing, channels)
            .join(F.broadcast(pats), "pattern_pos", "inner").drop("pattern_pos"))
