"""Corpus-wide removal of near-duplicate lines, in SQL functions only.

An exact set-similarity join over the lines' word sets: words are ordered by
rarity, two lines with Jaccard similarity of 0.8 or more must share a word
among the first fifth of their words (prefix filter), at places that leave
enough words to share (positional filter), and be of similar size (length
filter). What passes is sifted by more parities of the words, and what is left
verified on the words themselves. A line goes if an earlier line of the corpus
is similar to it.

Postings are written once, bucketed by word, and not paired with themselves at
once: every line first meets the earliest lines of each posting (its leaders),
which a window over the posting hands to it. Only lines that no leader comes
near to, or whose leaders fail verification, meet the whole posting. A group
of near copies therefore costs about its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.storage import release, stored, stored_by

BUCKETS = 1 << 18
PAGE = 512
LINE_BITS = 27
SIGNS = 8
_H = ["__h1", "__h2"]


def _words(line) -> Column:
    """The words of a line; a newline ends the line, other blanks separate words."""
    line = F.col(line)
    rare = [F.contains(line, F.lit(c)) for c in "\t\r\f\x0b"]
    return F.split(F.when(rare[0] | rare[1] | rare[2] | rare[3], F.translate(line, "\t\r\f\x0b", "    ")).otherwise(line), " ")


def _word_set(line) -> Column:
    return F.array_remove(F.array_distinct(_words(line)), "")


def _rarity(texts: DataFrame) -> DataFrame:
    """One row, of one character per bucket of word hashes: how often its words occur in
    all texts, on a logarithmic scale with two steps to the power of two. At
    most ``BUCKETS`` characters, whatever the corpus, put together in pages of
    ``PAGE``; words that share a bucket are ordered as if equally rare."""
    words = (texts.select(F.explode(F.split("__text", "\n")).alias("__line"))
             .select(F.explode(_words("__line")).alias("w")).where("w <> ''"))
    counts = words.groupBy(F.expr(f"cast(xxhash64(w) & {BUCKETS - 1} AS int)").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    level = F.expr("char(32 + least(63, cast(floor(2 * log2(n)) AS int)))")
    pages = stored(counts.groupBy(F.expr(f"bucket DIV {PAGE}").cast("long").alias("page"))
                   .agg(F.map_from_entries(F.collect_list(F.struct(F.col("bucket") % PAGE, level))).alias("m"))
                   .select("page", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PAGE - 1)),
                                                            lambda i: F.coalesce(F.element_at("m", i), F.lit(" "))), "").alias("s")))
    every = texts.sparkSession.range(BUCKETS // PAGE).withColumnRenamed("id", "page").join(pages, "page", "left")
    in_order = F.array_sort(F.collect_list(F.struct("page", F.coalesce("s", F.lit(" " * PAGE)).alias("s"))))   # BUCKETS / PAGE rows
    return every.agg(F.array_join(in_order["s"], "").cast("binary").alias("levels"))


def _prefixes(lines: DataFrame, rarity: DataFrame, num: int, den: int) -> DataFrame:
    """tok (31 bits of the word's hash), pos, n (words of the line), at (place
    in the line's rarity order), b (64 parities of its words) for every prefix
    word of every line. Words that share a tok only cost a comparison."""
    hashes = F.array_distinct(F.array_remove(F.transform(_words("__line"), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))
    level = lambda h: F.ascii(F.substr(F.col("__levels"), h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int") + 1, F.lit(1)).cast("string"))
    rank = F.sort_array(F.transform("__hashes", lambda h: F.shiftleft(level(h).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))))
    parity = F.aggregate("__hashes", F.lit(0).cast("long"), lambda s, h: s.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))))
    # A subquery's value stands in no plan's description, as a literal of that size would, many times. The optimizer
    # puts it where it is used; explode keeps the hashes below it, or every row would carry the value.
    return (lines.select("__pos", F.explode(F.array(hashes)).alias("__hashes")).withColumn("__levels", rarity.scalar())
            .select("__pos", F.size("__hashes").alias("n"), rank.alias("__ranks"), parity.alias("b"))
            .select(F.col("__pos").alias("pos"), "n", "b",
                    F.posexplode(F.slice("__ranks", F.lit(1), F.expr(f"n - ({num} * n + {den - 1}) DIV {den} + 1"))).alias("at", "rank"))
            .select(F.expr("cast(rank & 2147483647L AS int)").alias("tok"), "pos", "n", "at", "b"))


def _near(a, b, num: int, den: int) -> Column:
    """Length, positional and parity filter for two entries of a posting."""
    total = a["n"] + b["n"]
    need = F.floor((total * num + (num + den - 1)) / F.lit(num + den))   # least overlap of similar lines
    return ((F.least(a["n"], b["n"]) * den >= F.greatest(a["n"], b["n"]) * num)
            & (F.least(a["n"] - a["at"], b["n"] - b["at"]) >= need)
            & (F.bit_count(a["b"].bitwiseXOR(b["b"])) <= total - need * 2))


def _numbered(texts: DataFrame) -> DataFrame:
    """Dense numbers in the order of __d (least doc_id; nulls last), then the
    text's key, without a single-task window."""
    order = [F.col("__d").asc_nulls_last(), "__h1", "__h2"]
    dealt = stored(texts.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))
    counts = dealt.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))      # one row per partition
    before = counts.select("__p", (F.sum("__c").over(Window.orderBy("__p")) - F.col("__c")).alias("__b"))
    within = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return dealt.join(F.broadcast(before), "__p").select(*_H, "__d", (F.col("__b") + within - 1).alias("__t"))


def dedup_lines(docs: DataFrame, *, similarity: tuple[int, int] = (4, 5), leaders: int = 4) -> DataFrame:
    """All columns of ``docs`` with the remaining lines in ``text``, and
    n_lines, n_removed (long; lines that hold a word).

    Lines are ordered by doc_id (null last), then text, then place. A line
    without words stays and counts for nothing, unless no other line stays:
    then the text becomes empty. Lines with equal word sets are similar
    whatever their length. A null text stays null. Rows that repeat both
    doc_id and text are one document and come out alike; the same text under
    a later doc_id loses every line. Columns named n_lines or n_removed are
    replaced. No rows give no rows.
    """
    num, den = similarity
    rows = docs.drop("n_lines", "n_removed").withColumns(
        {"__h1": F.xxhash64("text"), "__h2": F.xxhash64(F.lit(7), "text")})
    some = rows.where("text IS NOT NULL")
    # every distinct text once, bucketed by its key: texts are shuffled here and nowhere else
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = stored_by(some.select(*_H, F.col("text").alias("__text")).repartition(buckets, *_H).dropDuplicates(_H), *_H, compression="zstd")
    numbers = stored(_numbered(some.groupBy(*_H).agg(F.min("doc_id").alias("__d"))))
    rarity = _rarity(texts)
    parts = F.split("__text", "\n")
    position = (F.shiftleft("__t", LINE_BITS) + F.col("__i")).alias("__pos")

    lines = (texts.join(numbers, _H).select("__t", F.posexplode(parts).alias("__i", "__line"))
             .where(F.col("__line").rlike("[^ \\t\\r\\f\\x0B]"))
             .select(position, F.xxhash64("__line").alias("k1"), F.xxhash64(F.lit(7), "__line").alias("k2")))
    lines = stored(lines)
    # equal lines: all but the first go; only the first ones are joined
    firsts = lines.groupBy("k1", "k2").agg(F.min("__pos").alias("__pos"), F.count(F.lit(1)).alias("c"))

    def fetch(positions: DataFrame) -> DataFrame:
        """__pos, __line of the given positions; texts stay where they lie."""
        wanted = (positions.select(F.shiftright("__pos", LINE_BITS).alias("__t"),
                                   F.col("__pos").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int").alias("__i"))
                  .groupBy("__t").agg(F.collect_list("__i").alias("__own")).join(numbers, "__t").select(*_H, "__t", "__own"))
        return (texts.join(wanted, _H).select("__t", "__own", parts.alias("__parts"))
                .select("__t", F.explode(F.transform("__own", lambda i: F.struct(
                    i.alias("__i"), F.get("__parts", i).alias("__line")))).alias("x"))
                .select("__t", "x.*").select(position, "__line"))

    posting = stored_by(_prefixes(fetch(firsts), rarity, num, den), "tok", order=("pos",), compression="zstd")
    columns = ["pos", "n", "at", "b"]
    entry = F.struct(*columns)
    whole = Window.partitionBy("tok").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead = [f"lead{k}" for k in range(1, leaders + 1)]
    met = (posting.withColumns({c: F.nth_value(entry, k + 1).over(whole) for k, c in enumerate(lead)})
           .where(F.col(lead[min(1, leaders - 1)]).isNotNull()))                 # no posting of one line
    own = {c: F.col(c) for c in columns}
    close = {c: F.coalesce((F.col(f"{c}.pos") < F.col("pos")) & _near(F.col(c), own, num, den), F.lit(False)) for c in lead}
    led = met.withColumns({f"near_{c}": x for c, x in close.items()})
    some_near = reduce(Column.__or__, [F.col(f"near_{c}") for c in lead])
    near = led.where(some_near)
    alone = led.where(~some_near & (F.col("pos") > F.col(f"{lead[-1]}.pos")))

    def meet(some: DataFrame, every: DataFrame) -> DataFrame:
        """Pairs of ``some`` entries with all earlier entries of their postings."""
        a = some.select("tok", entry.alias("a"))
        b = every.select("tok", entry.alias("b"))
        return (a.join(b, "tok").where((F.col("b.pos") < F.col("a.pos")) & _near(F.col("a"), F.col("b"), num, den))
                .select(F.col("a.pos").alias("pos"), F.col("b.pos").alias("earlier")))

    # Two kinds of rows are kept: pairs, with a leader or found in whole
    # postings, and the entries that came near a leader, which may be needed again.
    kind = lambda df, k: df.withColumn("kind", F.lit(k))
    nothing = F.lit(None).cast("long")
    some = near.select("tok", *columns, F.posexplode(F.array(*[
        F.when(F.col(f"near_{c}"), F.col(f"{c}.pos")) for c in lead], nothing)).alias("k", "earlier"))
    led = (some.where((F.col("k") == leaders) | F.col("earlier").isNotNull()).drop("k")
           .withColumn("kind", F.when(F.col("earlier").isNull(), "near").otherwise("lead")))
    seen = stored(led.unionByName(kind(meet(alone, posting), "whole"), allowMissingColumns=True), in_order=True)
    pairs = seen.where("kind IN ('lead', 'whole')").select("pos", "earlier", "kind").distinct()

    def alike(pairs: DataFrame) -> DataFrame:
        """The pairs that ``SIGNS`` times 64 parities of their words leave over: with the 64 of the postings, pairs of long
        lines that have little in common come this far, more than their share as the corpus grows. Only parities move."""
        word = (fetch(pairs.select(F.explode(F.array("pos", "earlier")).alias("__pos")).distinct())
                .select("__pos", F.explode(_word_set("__line")).alias("w")).select("__pos", F.xxhash64("w").alias("h")))
        place = F.shiftright("h", 6).bitwiseAND(F.lit(SIGNS - 1))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
        signs = word.groupBy("__pos").agg(F.count(F.lit(1)).alias("n"), *[
            F.bit_xor(F.when(place == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SIGNS)])
        own = ["n", *[f"s{k}" for k in range(SIGNS)]]
        side = lambda key, name: signs.select(F.col("__pos").alias(key), F.struct(*own).alias(name))
        total = F.col("a.n") + F.col("b.n")
        need = F.floor((total * num + (num + den - 1)) / F.lit(num + den))
        differ = reduce(Column.__add__, [F.bit_count(F.col(f"a.s{k}").bitwiseXOR(F.col(f"b.s{k}"))) for k in range(SIGNS)])
        return (pairs.join(side("pos", "a"), "pos").join(side("earlier", "b"), "earlier")
                .where(differ <= total - need * 2).select("pos", "earlier"))

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs whose word sets reach the similarity."""
        pairs = stored(alike(pairs))
        found = fetch(pairs.select(F.explode(F.array("pos", "earlier")).alias("__pos")).distinct())   # lines are smaller than their words
        both = (pairs.join(found.select(F.col("__pos").alias("pos"), F.col("__line").alias("x")), "pos")
                .join(found.select(F.col("__pos").alias("earlier"), F.col("__line").alias("y")), "earlier")
                .select("pos", _word_set("x").alias("a"), _word_set("y").alias("b")))
        common = F.size(F.array_intersect("a", "b"))
        return both.where(common * den >= (F.size("a") + F.size("b") - common) * num).select("pos").distinct()

    found = stored(similar(pairs.select("pos", "earlier").distinct()))
    # near a leader by the filters, yet similar to none so far: there these lines meet the whole posting
    doubtful = pairs.where("kind = 'lead'").select("pos").distinct().join(found, "pos", "left_anti")
    again = seen.where("kind = 'near'").join(doubtful, "pos", "left_semi")
    rest = meet(again, posting).distinct().join(
        pairs.select("pos", "earlier"), ["pos", "earlier"], "left_anti")
    found = found.union(similar(stored(rest)))

    text_of = F.shiftright("__pos", LINE_BITS).alias("__t")
    gone = (lines.join(firsts.where("c > 1").select("k1", "k2", F.col("__pos").alias("first")), ["k1", "k2"])
            .where("__pos > first").select("__pos").union(found.select(F.col("pos").alias("__pos"))).distinct()
            .select(text_of, F.col("__pos").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int").alias("__i"))
            .groupBy("__t").agg(F.collect_list("__i").alias("__gone")))
    counts = lines.groupBy(text_of).agg(F.count(F.lit(1)).alias("n_lines"))
    info = stored(numbers.join(counts, "__t", "left").join(gone, "__t", "left").select(
        *_H, "__d", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"), "__gone"))
    release(posting)

    # Texts stay where they lie: the rows, without texts, come to them, and only
    # a text's first row does. All rows meet the counts; a much-copied text's
    # rows can be split there, as the exchanges are that join's own.
    kept = (texts.join(info.where("n_lines > 0").select(*_H, "n_lines", "n_removed", "__gone"), _H)
            .select(*_H, "n_lines", "n_removed", "__gone", parts.alias("__parts"))
            .select(*_H, F.when(F.col("n_removed") == F.col("n_lines"), F.lit("")).otherwise(F.array_join(
                F.when(F.col("__gone").isNull(), F.col("__parts")).otherwise(F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), "__gone"),
                    lambda i: F.get("__parts", i))), "\n")).alias("text")))
    tie = F.xxhash64("__h1").alias("__h3")
    wordless = F.when(~F.col("text").rlike("[^ \\t\\r\\f\\x0B\\n]"), F.col("text")).alias("__own")
    known = (rows.select(*[c for c in rows.columns if c != "text"], tie, wordless)
             .join(info.select(*_H, tie, "__d", "n_lines", "n_removed"), [*_H, "__h3"], "left"))
    first = (F.coalesce("n_lines", F.lit(0)) > 0) & F.col("doc_id").eqNullSafe(F.col("__d"))
    columns = [*docs.drop("n_lines", "n_removed").columns, "n_lines", "n_removed"]
    others = (known.where(~first).withColumn("text", F.when(F.col("n_lines") > 0, F.lit("")).otherwise(F.col("__own")))
              .withColumn("n_lines", F.coalesce("n_lines", F.lit(0).cast("long"))).withColumn("n_removed", F.col("n_lines")))
    return known.where(first).join(kept, _H).select(*columns).unionByName(others.select(*columns))
