"""Entity search over stored postings: which documents mention what a list of
patterns matches, without testing every pattern on every index row.

The index holds the *distinct* entity values. Every value is filed under its
three-letter runs (lower-cased); a pattern's certain letters are taken out of
its regular expression, only values that have all of their runs are fetched,
and the whole pattern decides on those. A pattern without three certain letters
in a row is tested on all distinct values, still not on the index rows.

Tables under ``root``: ``values`` (v1, v2, value, exotic), ``postings`` (gram, v1,
v2) and ``rows`` (v1, v2, entity_type, source_id), each in folders by a hash of
its key; v1, v2 are 128 bits of hash that stand for a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.entities import _matcher, collect_hits, match_patterns
from vigil.sources import files as FS

GRAM = 3
VALUE = ["v1", "v2"]


def _key(value: str = "value") -> dict[str, Column]:
    return {"v1": F.xxhash64(value), "v2": F.xxhash64(F.lit(7), value)}


def _bucket(col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def _exotic(value: Column) -> Column:
    """Values with letters that a case-insensitive pattern equates with plain
    letters other than their lower case (I with dot, dotless i, long s):
    candidates always."""
    return value.rlike("[\u0130\u0131\u017f]")


def grams_of(value: Column) -> Column:
    """The distinct three-letter runs of a value, lower-cased."""
    low = F.lower(value)
    n = F.length(low) - (GRAM - 1)
    return F.array_distinct(F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                                      lambda i: F.substring(low, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>")))


def required_literals(pattern: str) -> list[str]:
    """Strings that stand in whatever the regular expression finds; none
    where the expression leaves that open (alternatives, flags, look-around)."""
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return []
    runs: list[str] = []
    run: list[str] = []
    depth, i = 0, 0

    def end() -> None:
        if run:
            runs.append("".join(run))
            run.clear()
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "\\":
            c = pattern[i:i + 1]
            i += 1
            if not c or c in "pPxuckN0":        # escapes with operands
                return []
            if c.isalnum():
                end()
            elif not depth:
                run.append(c)
        elif c == "[":
            end()
            start = i + (pattern[i:i + 1] == "^")
            i = start
            while i < len(pattern) and pattern[i] != "]":
                i += 2 if pattern[i] == "\\" else 1
            if i == start or "[" in pattern[start:i]:
                return []
            i += 1
        elif c in "()":
            end()
            depth += 1 if c == "(" else -1
        elif c in "*?{+":
            if run and c != "+":
                run.pop()
            end()
            if c == "{":
                i = pattern.find("}", i) + 1
                if not i:
                    return []
            if pattern[i:i + 1] in ("?", "+"):
                i += 1
        elif c in ".^$" or depth or not _plain(c):
            end()
        else:
            run.append(c)
    end()
    return runs


def _plain(c: str) -> bool:
    """Letters whose case pairs are one lower and one upper letter."""
    return c < "ɐ" and len(c.lower()) == len(c.upper()) == 1 and c.upper().lower() == c.lower()


def pattern_grams(pattern: str, mode: str = "regex") -> list[str]:
    """Runs that every value has in which the pattern is found."""
    if mode == "substring":
        literals, part = [], ""
        for c in pattern:
            if _plain(c):
                part += c
            else:
                literals, part = [*literals, part], ""
        literals.append(part)
    else:
        literals = required_literals(pattern)
    return sorted({x.lower()[i:i + GRAM] for x in literals for i in range(len(x) - GRAM + 1)})


def build_value_index(entity_index: DataFrame, root: str, buckets: int = 64) -> None:
    """Write the three tables from entity rows (entity_type, value, source_id),
    or add what isn't there yet: rows already stored add nothing. Null values
    can't be found and are left out."""
    spark = entity_index.sparkSession
    rows = (entity_index.filter(F.col("value").isNotNull()).select("value", "entity_type", "source_id")
            .withColumns(_key()).withColumn("bucket", _bucket("v1", buckets)))
    path = FS.scratch_dir(spark, "entity_rows")
    FS.write_scratch(rows, path)
    rows = spark.read.parquet(path)
    new_rows, values = rows.drop("value").distinct(), rows.select(*VALUE, "bucket", "value").distinct()
    if FS.path_exists(spark, f"{root}/rows/_SUCCESS"):
        stored = spark.read.parquet(f"{root}/rows").select(*[c for c in new_rows.columns])
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in new_rows.columns]
        new_rows = new_rows.alias("n").join(stored.alias("o"), same, "left_anti")
        values = values.join(spark.read.parquet(f"{root}/values").select("bucket", *VALUE), ["bucket", *VALUE], "left_anti")
        FS.write_scratch(values, f"{path}-values")      # decided before the first table grows
        FS.write_scratch(new_rows, f"{path}-rows")
        values, new_rows = spark.read.parquet(f"{path}-values"), spark.read.parquet(f"{path}-rows")
    grams = (values.select(*VALUE, F.explode(grams_of(F.col("value"))).alias("gram"))
             .withColumn("bucket", _bucket("gram", buckets)))
    values = values.withColumn("exotic", _exotic(F.col("value")))
    for name, df, order in (("postings", grams, "gram"), ("values", values, "v1"), ("rows", new_rows, "v1")):
        (df.hint("rebalance", "bucket").sortWithinPartitions("bucket", order)
           .write.mode("append").partitionBy("bucket").parquet(f"{root}/{name}"))


def search_values(spark: SparkSession, root: str, patterns: list[str], mode: str = "regex",
                  buckets: int = 64) -> DataFrame:
    """(pattern_pos, v1, v2, bucket) of the values in which each pattern of the
    list is found (case-insensitively)."""
    values = spark.read.parquet(f"{root}/values")
    grams = {i: pattern_grams(p, mode) for i, p in enumerate(patterns)}
    filed = [i for i, g in grams.items() if g]
    keep = [*VALUE, "bucket"]

    def whole(rows: DataFrame, which: list[int]) -> DataFrame:
        found = match_patterns(rows, [patterns[i] for i in which], mode, keep=keep)
        place = F.element_at(F.array(*[F.lit(i) for i in which]), F.col("pattern_pos") + 1)
        return found.withColumn("pattern_pos", place)
    parts = []
    rest = [i for i in grams if i not in filed]
    if rest:
        parts.append(whole(values, rest))
    if filed:
        parts.append(whole(values.filter("exotic"), filed))
        # the caller's patterns: their number and size are known
        wanted = spark.createDataFrame([(i, g, len(grams[i])) for i in filed for g in grams[i]], "pattern_pos int, gram string, _n int")
        places = [r.b for r in wanted.select(_bucket("gram", buckets).alias("b")).distinct().collect()]
        postings = spark.read.parquet(f"{root}/postings").filter(
            F.col("bucket").isin(places) & F.col("gram").isin(sorted({g for i in filed for g in grams[i]})))
        candidates = (postings.select("gram", *VALUE).join(F.broadcast(wanted), "gram")
                      .groupBy("pattern_pos", "_n", *VALUE).agg(F.count_distinct("gram").alias("_c"))
                      .filter("_c = _n").select("pattern_pos", *VALUE).withColumn("bucket", _bucket("v1", buckets)))
        found = None
        for i in filed:
            hit = (F.col("pattern_pos") == i) & _matcher(patterns[i], mode)
            found = hit if found is None else found | hit
        parts.append(values.filter("NOT exotic").join(candidates, [*VALUE, "bucket"]).filter(found)
                     .select(*keep, "pattern_pos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def documents_of(spark: SparkSession, root: str, patterns: list[str], mode: str = "regex",
                 buckets: int = 64) -> DataFrame:
    """(pattern_pos, source_id), each once; no patterns give no rows."""
    if not patterns:
        return spark.read.parquet(f"{root}/rows").select(F.lit(None).cast("int").alias("pattern_pos"), "source_id").limit(0)
    hits = search_values(spark, root, patterns, mode, buckets)
    return (spark.read.parquet(f"{root}/rows").join(hits, [*VALUE, "bucket"])
            .select("pattern_pos", "source_id").distinct())


def collect_from_index(root: str, library_index: DataFrame, listing: DataFrame, channels: DataFrame,
                       entities_list: list[str], mode: str = "regex", buckets: int = 64) -> DataFrame:
    """``collect_multi_entity_data`` by the stored postings."""
    hits = documents_of(library_index.sparkSession, root, entities_list, mode, buckets)
    return collect_hits(hits, library_index, listing, channels, entities_list)
