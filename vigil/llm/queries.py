"""One registered query per operator of this package, with its oracle SQL
where SQL can express it. Every query reads its tables whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import (chat, chunk_codec, langid, line_dedup, lsh, maxscore, ngram_join, packing, phrases, pii,
                       prefix_trie, quality, token_files)


#: for the registered queries on invented data only; a caller passes a key of its own
PII_KEY = b"registered queries, invented data"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(both).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chat(turns.unionByName(own)))


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l'))
    + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
      ELSE 2 + length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')) END
    + length('### : </turn>') + 1 AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                WHEN before IN ('system', 'assistant') THEN role = 'user'
                WHEN before = 'user' THEN role = 'assistant' ELSE false END
           AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM o GROUP BY conv_id
"""


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return maxscore.search(vectors, F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS terms FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.terms, c.terms) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_codec.encode_documents(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def line_dedup_sql(source: str, columns: str = "d.doc_id") -> str:
    """DuckDB SQL of the line dedup over ``source`` (distinct doc_ids)."""
    return rf"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(p))) AS i, unnest(p) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM {source} WHERE text IS NOT NULL)),
w AS (
  SELECT doc_id, i, line, list_sort(list_distinct([x for x in string_split(
    translate(line, chr(9) || chr(13) || chr(12) || chr(11), '    '), ' ') if x <> ''])) AS w FROM lines),
k AS (SELECT w, len(w) AS n, min(struct_pack(doc_id, i)) AS first FROM w WHERE len(w) > 0 GROUP BY w),
e AS (SELECT first, n, unnest(w) AS x FROM k),
f AS (SELECT x, count(*) AS c FROM e GROUP BY x),
o AS (SELECT e.first, e.n, e.x, row_number() OVER (PARTITION BY e.first ORDER BY f.c, e.x) AS at FROM e JOIN f ON e.x = f.x),
c AS (
  SELECT DISTINCT b.first AS later, a.first AS earlier FROM o a JOIN o b ON a.x = b.x AND a.first < b.first
  WHERE a.at <= a.n - (4 * a.n + 4) // 5 + 1 AND b.at <= b.n - (4 * b.n + 4) // 5 + 1
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
g AS (
  SELECT DISTINCT c.later FROM c JOIN k a ON a.first = c.earlier JOIN k b ON b.first = c.later
  WHERE 5 * len(list_intersect(a.w, b.w)) >= 4 * (a.n + b.n - len(list_intersect(a.w, b.w)))),
r AS (
  SELECT w.doc_id, w.i, w.line, len(w.w) > 0 AS worded,
    len(w.w) > 0 AND (g.later IS NOT NULL OR struct_pack(w.doc_id, w.i) <> k.first) AS gone
  FROM w LEFT JOIN k ON w.w = k.w AND len(w.w) > 0 LEFT JOIN g ON g.later = k.first),
t AS (
  SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept
  FROM r GROUP BY doc_id)
SELECT {columns}, CASE WHEN d.text IS NULL THEN NULL WHEN t.n_removed > 0 AND t.n_removed = t.n_lines THEN ''
    ELSE coalesce(t.kept, '') END AS text,
  CAST(coalesce(t.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(t.n_removed, 0) AS BIGINT) AS n_removed
FROM {source} d LEFT JOIN t ON d.doc_id = t.doc_id"""


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(_table(spark, sf_dir, "documents"), ngram_join.Jaccard(words=4, over=85, under=100))


def component_sql(source: str, words: int, over: int, under: int) -> str:
    """DuckDB SQL for doc_id, n_shingles, component_id over ``source`` (a table
    with distinct doc_ids and text)."""
    word = ", ".join(f"w[i + {k}]" for k in range(words))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS w FROM {source}),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string([{word}], ' ') for i in range(1, len(w) - {words - 1} + 1)]) END AS s FROM w),
k AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM s) WHERE len(s) > 0 GROUP BY s),
e AS (SELECT rep, n, unnest(s) AS x FROM k),
p AS (
  SELECT a.rep AS u, b.rep AS v, count(*) AS common, any_value(a.n) AS m, any_value(b.n) AS n
  FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep GROUP BY a.rep, b.rep),
l AS (SELECT u, v FROM p WHERE {under} * common >= {over} * (m + n - common)),
t AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(node, seen) AS (SELECT rep, rep FROM k UNION SELECT r.node, t.v FROM r JOIN t ON r.seen = t.u),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM (SELECT doc_id, list_sort(s) AS s FROM s) d LEFT JOIN k ON d.s = k.s AND len(d.s) > 0 LEFT JOIN c ON c.node = k.rep"""


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, key=PII_KEY)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS p FROM (
    SELECT coalesce(lang, 'und') AS lang,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, words, unnest([array_to_string(w[i:i + words - 1], ' ') for i in range(1, len(w) - words + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS words) WHERE len(w) >= words),
f AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
cuts AS (
  SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < words),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
wider AS (
  SELECT lang, sub, max(a) AS a FROM (
    SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS sub
    FROM c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < words AND i + m - 1 <= words)
  GROUP BY lang, sub),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN wider v ON v.lang = s.lang AND v.sub = s.phrase
  WHERE v.a IS NULL OR 100 * CAST(v.a AS HUGEINT) < 80 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


# crc32 by its table of 256 entries, which the query builds from the polynomial
OP13_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
t AS (
  SELECT conv_id, sha256(octet_length(encode(role)) || ':' || role || text) AS item, length(text) AS n,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      [CAST(unicode(x) AS BIGINT) for x in string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t), crc),
r AS (
  SELECT c.conv_id, t.pos AS place, t.item, t.n FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos + 5, t.item, t.n FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, n, array_to_string(list(item) OVER w, ' ') AS node,
    count(*) OVER (PARTITION BY conv_id) AS len
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c.conv_id, 0, 0, '', (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c),
v AS (
  SELECT depth, node, any_value(n) AS n, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, node),
links AS (
  SELECT DISTINCT a.depth, a.node, b.depth AS below_depth, b.node AS below
  FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
inner_nodes AS (SELECT depth, node, count(*) AS n_children FROM links WHERE below_depth = depth + 1 GROUP BY depth, node),
parents AS (
  SELECT l.below_depth AS depth, l.below AS node, v.conv_id AS parent_conv_id
  FROM links l JOIN v ON v.depth = l.depth AND v.node = l.node WHERE l.below_depth = l.depth + 1),
sums AS (
  SELECT l.depth, l.node, count(*) FILTER (i.node IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.n) AS saved_tokens
  FROM links l JOIN v u ON u.depth = l.below_depth AND u.node = l.below
  LEFT JOIN inner_nodes i ON i.depth = u.depth AND i.node = u.node GROUP BY l.depth, l.node)
SELECT v.conv_id, v.depth, parents.parent_conv_id, v.n_convs, coalesce(i.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN sums s ON s.depth = v.depth AND s.node = v.node
LEFT JOIN inner_nodes i ON i.depth = v.depth AND i.node = v.node
LEFT JOIN parents ON parents.depth = v.depth AND parents.node = v.node
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_topk_search": op2_topk_search,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_line_dedup": op6_line_dedup,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_pii": op9_pii,
    "op10_language_id": op10_language_id,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": OP1_SQL,
    "op2_topk_search": OP2_SQL,
    "op6_line_dedup": line_dedup_sql("documents"),
    "op7_ngram_jaccard": component_sql("documents", 4, 85, 100),
    "op11_phrase_collocations": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
