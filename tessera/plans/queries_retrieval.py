"""Queries: chunks, ranking, recall, cards, frames, alignment, quizzes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import vectors
from tessera.operators import cards as C
from tessera.operators import frames as FR
from tessera.operators import quiz as Q
from tessera.operators import quotes
from tessera.operators import relational as R
from tessera.operators import retrieval as T
from tessera.plans.catalogue import query
from tessera.session import table

CHUNKS_SQL = r"""
  base AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
  k AS (SELECT *, CASE WHEN n < 500 THEN 0 ELSE (n - 500) // 400 + 1 END AS w FROM base),
  pieces AS (SELECT doc_id, CAST(i AS BIGINT) AS chunk_no, CAST(i * 400 AS BIGINT) AS "start",
      CASE WHEN i < w THEN substr(t, i * 400 + 1, 500) ELSE substr(t, i * 400 + 1) END AS "text", i < w AS whole
    FROM (SELECT *, unnest(generate_series(0, w)) AS i FROM k)),
  chunks AS (SELECT doc_id, chunk_no, "start", "text" FROM pieces WHERE whole OR regexp_matches("text", '[^\s]'))"""
GRAMS = r"""CASE WHEN length({t}) < 2 THEN [{t}] ELSE list_transform(generate_series(1, length({t}) - 1), lambda i: substr({t}, i, 2)) END"""


def grams_sql(column: str) -> str:
    return GRAMS.format(t=rf"regexp_replace({column}, '\s+', '', 'g')")


def turns(spark, sf_dir):
    """Conversations as speaker blocks of courses: a turn begins every ten seconds."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("course_id"), F.col("turn").alias("block_idx"), F.col("role").alias("speaker"), (F.col("turn") * 10.0).alias("start_sec"), "text"
    )


def chunk_table(spark, sf_dir):
    found = T.fixed_chunks(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select((F.col("doc_id") * 100000 + F.col("chunk_no")).alias("chunk_id"), "text")


@query(f"WITH {CHUNKS_SQL} SELECT * FROM chunks")
def chunk_fixed(spark, sf_dir):
    """Windows of 500 characters every 400, and a tail."""
    return T.fixed_chunks(table(spark, sf_dir, "documents"), "doc_id", "text")


FOLD_SQL = r"""
WITH RECURSIVE b AS (
  SELECT conv_id, role, text, turn, length(text) + {extra} AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
f AS (
  SELECT conv_id, i, turn, role, n AS size, 0 AS g FROM b WHERE i = 1
  UNION ALL
  SELECT b.conv_id, b.i, b.turn, b.role, CASE WHEN {cut} THEN b.n ELSE f.size + b.n END, CASE WHEN {cut} THEN f.g + 1 ELSE f.g END
  FROM f JOIN b ON b.conv_id = f.conv_id AND b.i = f.i + 1)
"""


@query(FOLD_SQL.format(extra=24, cut="f.size + b.n > 4000") + "SELECT conv_id AS course_id, turn AS block_idx, CAST(g AS BIGINT) AS group_no FROM f")
def segments_packed(spark, sf_dir):
    """Blocks packed greedily into segments of up to 4000 characters."""
    blocks = turns(spark, sf_dir).withColumn("n", F.length("text") + 24)
    return T.packed_segments(blocks, "course_id", "block_idx", "n")


@query(
    FOLD_SQL.format(extra=1, cut="((b.role <> f.role AND f.size >= 300) OR f.size >= 700)")
    + r""", c AS (SELECT f.conv_id, f.g, string_agg(b.text || chr(10), '' ORDER BY f.turn) AS t, min(f.turn) * 10.0 AS s, max(f.turn) * 10.0 AS e
       FROM f JOIN b ON b.conv_id = f.conv_id AND b.i = f.i GROUP BY ALL)
    SELECT conv_id AS course_id, CAST(g AS BIGINT) AS chunk_no, trim(t, chr(32) || chr(10) || chr(9) || chr(13)) AS text, CAST(s AS DOUBLE) AS start_sec, CAST(e AS DOUBLE) AS end_sec
    FROM c WHERE regexp_matches(t, '[^\s]')"""
)
def chunk_semantic(spark, sf_dir):
    """Chunks of whole blocks that end at a change of speaker or at length."""
    return T.semantic_chunks(turns(spark, sf_dir))


@query(
    f"""WITH p AS (SELECT conv_id * 1000 + turn AS id, unnest({grams_sql("text")}) AS term FROM conversations), n AS (SELECT count(DISTINCT id) AS n FROM p),
    d AS (SELECT term, count(DISTINCT id) AS df FROM p GROUP BY term)
    SELECT term, CAST(df AS BIGINT) AS df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM d, n"""
)
def bm25_terms(spark, sf_dir):
    """Document frequency and weight of all character pairs of the turns."""
    docs = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return T.bm25_stats(T.postings(docs, "id", "text"), "id")[1].select("term", "df", F.round("idf", 6).alias("idf"))


BM25_SQL = f"""
  posted AS (SELECT id, term, count(*) AS tf FROM (SELECT doc_id * 100000 + chunk_no AS id, unnest({grams_sql("text")}) AS term FROM chunks) GROUP BY ALL),
  len AS (SELECT id, sum(tf) AS dl FROM posted GROUP BY id),
  tot AS (SELECT avg(dl) AS avgdl, count(*) AS n FROM len),
  dfs AS (SELECT term, count(*) AS df FROM posted GROUP BY term),
  asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({grams_sql("substr(text, 1, 60)")}) AS term FROM benchmark)),
  scored AS (SELECT item_id, id AS chunk_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
    FROM asked JOIN dfs USING (term) JOIN posted USING (term) JOIN len USING (id), tot GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, chunk_id) AS rank FROM scored),
  top AS (SELECT * FROM ranked WHERE rank <= 5)"""


def bench_queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote"), F.substring("text", 1, 60).alias("asked"))


def bench_top(spark, sf_dir, chunks):
    return T.bm25_top(chunks, bench_queries(spark, sf_dir), "chunk_id", "text", "item_id", "asked", 5)


TURNS_SQL = "chunks AS (SELECT conv_id AS doc_id, turn AS chunk_no, text FROM conversations)"


@query(f"WITH {TURNS_SQL}, {BM25_SQL} SELECT item_id, chunk_id, CAST(rank AS INTEGER) AS rank FROM top")
def bm25_turns(spark, sf_dir):
    """The five best turns of each benchmark text's first 60 characters, from a table of all postings."""
    docs = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100000 + F.col("turn")).alias("chunk_id"), "text")
    scores = T.bm25_scores(T.postings(docs, "chunk_id", "text"), bench_queries(spark, sf_dir), "chunk_id", "item_id", "asked")
    return T.top_k(scores, "item_id", "chunk_id", 5).select("item_id", "chunk_id", "rank")


@query(f"WITH {CHUNKS_SQL}, {BM25_SQL} SELECT item_id, chunk_id, CAST(rank AS INTEGER) AS rank FROM top")
def bm25_top(spark, sf_dir):
    """The five best chunks of each benchmark text's first 60 characters."""
    return bench_top(spark, sf_dir, chunk_table(spark, sf_dir)).select("item_id", "chunk_id", "rank")


TRUE_SQL = """true_chunk AS (SELECT item_id, min(doc_id * 100000 + chunk_no) AS chunk_id FROM benchmark b JOIN chunks c ON contains(c.text, substr(b.text, 1, 60)) GROUP BY item_id)"""


@query(f"WITH {CHUNKS_SQL}, {TRUE_SQL} SELECT * FROM true_chunk")
def quote_truth(spark, sf_dir):
    """The first chunk that holds a benchmark text's first 60 characters."""
    return T.truth(chunk_table(spark, sf_dir), bench_queries(spark, sf_dir), "chunk_id", "text", "item_id", "quote")


#: White space as the engine's patterns have it.
SPACE = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Places of squeezed quotes: texts are split by them; solid lists the places of the characters that count.
PLACES_SQL = rf"""
  sq AS (SELECT item_id, regexp_replace(text, '{SPACE}+', '', 'g') AS q FROM benchmark), sd AS (SELECT doc_id, text, regexp_replace(text, '{SPACE}+', '', 'g') AS t FROM documents),
  met AS (SELECT item_id, doc_id, q, text, string_split(t, q) AS parts FROM sq JOIN sd ON q <> '' AND contains(t, q)),
  begun AS (SELECT item_id, doc_id, q, text, list_sum(list_transform(parts[:k], lambda p: length(p))) + (k - 1) * length(q) AS b FROM (SELECT *, unnest(generate_series(1, len(parts) - 1)) AS k FROM met)),
  solids AS (SELECT doc_id, list_filter(generate_series(1, length(text)), lambda i: NOT regexp_matches(c[i], '{SPACE}')) AS solid FROM (SELECT DISTINCT doc_id, text, string_split(text, '') AS c FROM met)),
  places AS (SELECT item_id, doc_id, CAST(solid[CAST(b AS BIGINT) + 1] - 1 AS BIGINT) AS "start", CAST(solid[CAST(b AS BIGINT) + length(q)] AS BIGINT) AS "end" FROM begun JOIN solids USING (doc_id))"""


@query(f"WITH {PLACES_SQL} SELECT * FROM places")
def quote_places(spark, sf_dir):
    """All places of whole benchmark texts in whole documents, white space aside."""
    return quotes.quote_places(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")


@query(
    f"""WITH {CHUNKS_SQL}, {BM25_SQL}, {TRUE_SQL},
    hits AS (SELECT b.item_id, t.chunk_id IS NOT NULL AS known, bool_or(coalesce(x.chunk_id = t.chunk_id, false)) AS hit
      FROM benchmark b LEFT JOIN true_chunk t USING (item_id) LEFT JOIN top x USING (item_id) GROUP BY b.item_id, t.chunk_id)
    SELECT 'fixed' AS strategy, count(*) AS queries, count(*) FILTER (known) AS answerable, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 3) AS recall FROM hits"""
)
def retrieval_recall(spark, sf_dir):
    """Recall of BM25's five best chunks for the benchmark's texts."""
    chunks, asked = chunk_table(spark, sf_dir), bench_queries(spark, sf_dir).withColumn("strategy", F.lit("fixed"))
    top = bench_top(spark, sf_dir, chunks).withColumn("strategy", F.lit("fixed"))
    true = T.truth(chunks, asked, "chunk_id", "text", "item_id", "quote")
    return T.recall(asked, top, true, "item_id", "chunk_id", ["strategy"])


LETTERS = "abcdefghijklmnopqrstuvwxyz"
VEC = "list_transform(string_split('a,b,c,d,e,f,g,h,i,j,k,l,m,n,o,p,q,r,s,t,u,v,w,x,y,z', ','), lambda c: CAST(length({t}) - length(replace({t}, c, '')) AS DOUBLE))"
VDOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"
RECALL_SQL = (
    FOLD_SQL.format(extra=1, cut="((b.role <> f.role AND f.size >= 300) OR f.size >= 700)")
    + rf""", cs AS (SELECT conv_id AS course_id, 'turn' AS strategy, turn AS chunk_id, text FROM conversations
      UNION ALL SELECT f.conv_id, 'semantic', min(f.turn), trim(string_agg(b.text, chr(10) ORDER BY f.turn), chr(32) || chr(10) || chr(9) || chr(13)) FROM f JOIN b ON b.conv_id = f.conv_id AND b.i = f.i GROUP BY f.conv_id, f.g),
    ch AS (SELECT *, {VEC.format(t="text")} AS e FROM cs),
    qs AS (SELECT conv_id AS course_id, turn AS query_id, text, {VEC.format(t="text")} AS e FROM conversations WHERE role = 'user'),
    po AS (SELECT course_id, strategy, chunk_id, term, count(*) AS tf FROM (SELECT course_id, strategy, chunk_id, unnest({grams_sql("text")}) AS term FROM ch) GROUP BY ALL),
    le AS (SELECT course_id, strategy, chunk_id, sum(tf) AS dl FROM po GROUP BY ALL), tot AS (SELECT course_id, strategy, avg(dl) AS avgdl, count(*) AS n FROM le GROUP BY ALL),
    df AS (SELECT course_id, strategy, term, count(*) AS df FROM po GROUP BY ALL),
    qt AS (SELECT DISTINCT course_id, query_id, term FROM (SELECT course_id, query_id, unnest({grams_sql("substr(text, 1, 60)")}) AS term FROM qs)),
    words AS (SELECT course_id, strategy, query_id, chunk_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
      FROM qt JOIN df USING (course_id, term) JOIN po USING (course_id, strategy, term) JOIN le USING (course_id, strategy, chunk_id) JOIN tot USING (course_id, strategy) GROUP BY ALL),
    near AS (SELECT q.course_id, strategy, query_id, chunk_id, round({VDOT.format(a="c.e", b="q.e")} / ((sqrt({VDOT.format(a="c.e", b="c.e")}) + 1e-9) * (sqrt({VDOT.format(a="q.e", b="q.e")}) + 1e-9)), 6) AS score FROM qs q JOIN ch c USING (course_id)),
    sides AS (SELECT *, score / coalesce(nullif(max(score) OVER (PARTITION BY course_id, strategy, query_id), 0), 1) AS s FROM words UNION ALL SELECT *, score / coalesce(nullif(max(score) OVER (PARTITION BY course_id, strategy, query_id), 0), 1) FROM near),
    al AS (SELECT 'bm25' AS ranker, * FROM words UNION ALL SELECT 'vector', * FROM near UNION ALL SELECT 'hybrid', course_id, strategy, query_id, chunk_id, round(sum(s), 6) FROM sides GROUP BY course_id, strategy, query_id, chunk_id),
    best AS (SELECT *, row_number() OVER (PARTITION BY ranker, course_id, strategy, query_id ORDER BY score DESC, chunk_id) AS rk FROM al),
    tr AS (SELECT q.course_id, strategy, query_id, min(chunk_id) AS chunk_id FROM qs q JOIN ch c ON c.course_id = q.course_id AND contains(c.text, substr(q.text, 1, 60)) GROUP BY ALL),
    mk AS (SELECT r.ranker, q.course_id, w.strategy, q.query_id, t.chunk_id IS NOT NULL AS known, x.chunk_id IS NOT NULL AS hit FROM qs q, (SELECT DISTINCT course_id, strategy FROM ch) w, (SELECT DISTINCT ranker FROM al) r
      LEFT JOIN tr t ON t.course_id = q.course_id AND t.strategy = w.strategy AND t.query_id = q.query_id
      LEFT JOIN best x ON x.ranker = r.ranker AND x.course_id = q.course_id AND x.strategy = w.strategy AND x.query_id = q.query_id AND x.chunk_id = t.chunk_id AND x.rk <= 1 WHERE w.course_id = q.course_id),
    rc AS (SELECT course_id, strategy, ranker, count(*) AS queries, count(*) FILTER (known) AS answerable, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 3) AS recall FROM mk GROUP BY ALL)"""
)


def letter_vector(text):
    """Counts of letters: a vector that SQL can state, in place of a model's."""
    return F.array(*[(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))).cast("double") for c in LETTERS])


def recalls(spark, sf_dir):
    blocks = turns(spark, sf_dir)
    each = blocks.select("course_id", F.lit("turn").alias("strategy"), F.col("block_idx").alias("chunk_id"), "text")
    whole = T.semantic_chunks(blocks).select("course_id", F.lit("semantic").alias("strategy"), (F.col("start_sec") / 10).cast("long").alias("chunk_id"), "text")
    chunks = each.unionByName(whole)
    asked = blocks.filter("speaker = 'user'").select("course_id", F.col("block_idx").alias("query_id"), F.col("text").alias("quote"), F.substring("text", 1, 60).alias("asked"), letter_vector(F.col("text")).alias("embedding"))
    return T.recall_by_ranker(chunks.withColumn("embedding", letter_vector(F.col("text"))), asked, k=1)


@query(RECALL_SQL + " SELECT * FROM rc")
def recall_by_ranker(spark, sf_dir):
    """Recall of each course, chunking strategy and ranker (character pairs, letter vectors, both)."""
    return recalls(spark, sf_dir)


@query(RECALL_SQL + " SELECT strategy, round(avg(recall), 6) AS recall FROM rc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def chosen_strategy(spark, sf_dir):
    """The strategy whose recalls are best on average."""
    return T.chosen_strategy(R.stored(recalls(spark, sf_dir)))


@query(
    f"""WITH p AS (SELECT conv_id * 1000 + turn AS id, unnest({grams_sql("text")}) AS term FROM conversations), l AS (SELECT id, count(*) AS dl FROM p GROUP BY id)
    SELECT 'turn' AS strategy, (SELECT count(*) FROM l) AS chunks, (SELECT round(avg(dl), 6) FROM l) AS avg_length, (SELECT count(DISTINCT term) FROM p) AS terms, (SELECT count(*) FROM embeddings) AS vectors, (SELECT CAST(max(len(embedding)) AS INTEGER) FROM embeddings) AS dimensions"""
)
def index_meta(spark, sf_dir):
    """What an index of all turns and all vectors holds."""
    docs = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return T.index_meta(T.postings(docs, "id", "text"), table(spark, sf_dir, "embeddings"), "id", "embedding", "turn")


DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"
COSINE_SQL = f"""
  e AS (SELECT vec_id, label, embedding, sqrt({DOT.format(a="embedding", b="embedding")}) + 1e-9 AS len FROM embeddings),
  s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, round({DOT.format(a="q.embedding", b="d.embedding")} / (q.len * d.len), 6) AS score, q.label = d.label AS same
    FROM e q, e d WHERE q.vec_id % 50 = 0)"""


@query(f"WITH {COSINE_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score FROM r WHERE rank <= 10")
def cosine_top(spark, sf_dir):
    """The ten nearest vectors of the stated query set."""
    rows = table(spark, sf_dir, "embeddings")
    asked = rows.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return T.nearest(rows, asked, "vec_id", "query_id", "embedding", 10).select("query_id", "vec_id", "rank", F.round("score", 4).alias("score"))


@query(
    f"""WITH {COSINE_SQL.replace(" WHERE q.vec_id % 50 = 0", "")}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, score FROM r WHERE rank <= 10"""
)
def cosine_all(spark, sf_dir):
    """The ten nearest vectors of every vector, itself among them."""
    rows = table(spark, sf_dir, "embeddings")
    return T.nearest(rows, rows.withColumnRenamed("vec_id", "query_id"), "vec_id", "query_id", "embedding", 10).select("query_id", "vec_id", "rank", "score")


@query(
    f"""WITH {COSINE_SQL}, h AS (SELECT query_id, vec_id, round(score / coalesce(nullif(max(score) OVER (PARTITION BY query_id), 0), 1) + CASE WHEN same THEN 1.0 ELSE 0.0 END, 6) AS score FROM s),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM h) SELECT query_id, vec_id, round(score, 4) AS score FROM r WHERE rank <= 5"""
)
def hybrid_top(spark, sf_dir):
    """Cosine and label agreement, each over its greatest value, added."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    asked = rows.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return T.hybrid_top(rows, asked, "vec_id", "query_id", "embedding", "label", 5).select("query_id", "vec_id", F.round("score", 4).alias("score"))


@query(
    """WITH m AS (SELECT o_orderpriority AS s, round(avg(o_totalprice), 3) AS v FROM orders GROUP BY 1) SELECT s AS strategy, v AS mean FROM m ORDER BY v DESC, s LIMIT 1"""
)
def best_strategy(spark, sf_dir):
    """The strategy of the greatest mean; the first listed wins ties."""
    means = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("strategy")).agg(F.round(F.avg("o_totalprice"), 3).alias("mean"))
    return T.best_strategy(means, "strategy", "mean", "strategy")


SPANS_SQL = """
  s AS (SELECT conv_id AS course_id, turn AS block_idx, turn * 10.0 AS start_sec, length(text) AS n,
      CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS text_end,
      lead(turn * 10.0) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM conversations)"""


def spans(spark, sf_dir):
    return C.block_spans(turns(spark, sf_dir).withColumn("n_chars", F.length("text")))


@query(f"WITH {SPANS_SQL} SELECT course_id, block_idx, text_end - n AS text_start, text_end, CAST(round(coalesce(after, start_sec + greatest(n / 5.0, 5.0)), 3) AS DOUBLE) AS end_sec FROM s")
def block_ranges(spark, sf_dir):
    """Character range and end of every block."""
    return spans(spark, sf_dir).select("course_id", "block_idx", "text_start", "text_end", "end_sec")


@query(f"WITH {SPANS_SQL}, p AS (SELECT course_id, unnest(generate_series(0, max(text_end), 100)) AS pos FROM s GROUP BY course_id) SELECT course_id, CAST(pos AS BIGINT) AS pos, block_idx FROM p JOIN s USING (course_id) WHERE pos >= text_end - n AND pos < text_end")
def position_to_block(spark, sf_dir):
    """The block at every hundredth character."""
    blocks = spans(spark, sf_dir).filter("text_start < text_end")
    points = blocks.groupBy("course_id").agg(F.max("text_end").alias("m")).select("course_id", F.explode(F.sequence(F.lit(0).cast("long"), "m", F.lit(100).cast("long"))).alias("pos"))
    return R.in_interval(points, blocks.select("course_id", "block_idx", "text_start", "text_end"), ["course_id"], "pos", "text_start", "text_end", 500).select("course_id", "pos", "block_idx")


PAIR_GRAMS = r"list_distinct(list_filter(list_transform(generate_series(1, greatest(length({t}) - 1, 1)), lambda i: substr({t}, i, 2)), lambda g: length(g) = 2 AND NOT regexp_matches(substr(g, 2, 1), '\s')))"


@query(
    f"""WITH g AS (SELECT conv_id * 1000 + turn AS id, conv_id AS course, {PAIR_GRAMS.format(t="text")} AS s FROM conversations),
    r AS (SELECT id, course, len(s) AS n, unnest(s) AS gram FROM g),
    m AS (SELECT a.id AS a, b.id AS b, count(*) AS inter, any_value(a.n) + any_value(b.n) AS total FROM r a JOIN r b ON a.gram = b.gram AND a.id < b.id AND a.course <> b.course GROUP BY a.id, b.id)
    SELECT a, b, inter, round(inter / (total - inter), 6) AS jaccard FROM m WHERE inter >= 6 AND inter / (total - inter) >= 0.5"""
)
def similar_cards(spark, sf_dir):
    """Pairs of turns of different conversations whose whole texts have like character pairs."""
    rows = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "conv_id", F.col("text").alias("t"))
    return C.similar_pairs(rows, "id", "conv_id", "t", least=0.5)


CARD_SQL = r"""SELECT d.doc_id, b.item_id, CASE d.doc_id % 6 WHEN 0 THEN '事实' WHEN 1 THEN '流程' WHEN 2 THEN 'x' WHEN 3 THEN '决策' WHEN 4 THEN ' 禁忌 ' ELSE '运营' END AS type,
  CASE WHEN d.doc_id % 7 = 0 THEN 'short' ELSE substr(d.text, 1, 20) || 'content' END AS content, substr(b.text, 1, 10 + 8 * (b.item_id % 20)) AS quote, d.text
  FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id"""


@query(
    rf"""WITH c AS ({CARD_SQL}), l AS (SELECT *, regexp_replace(text, '\s+', '', 'g') AS squeezed, regexp_replace(quote, '\s+', '', 'g') AS q FROM c),
    e AS (SELECT *, q <> '' AND contains(squeezed, q) AS found FROM l),
    r AS (SELECT CASE WHEN trim(type) NOT IN ('事实', '流程', '决策', '禁忌', '运营') THEN 'bad_type' WHEN length(trim(content)) < 8 THEN 'bad_content' WHEN NOT found THEN 'quote_not_found'
      WHEN contains(quote, 'Speaker') THEN 'quote_has_header' WHEN NOT (length(trim(quote, chr(32) || chr(10))) BETWEEN 30 AND 150) THEN 'quote_length' ELSE 'accepted' END AS reason FROM e)
    SELECT reason, count(*) AS n FROM r GROUP BY reason"""
)
def card_rejections(spark, sf_dir):
    """Why cards drawn from documents and benchmark quotes are rejected."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").withColumnRenamed("text", "b_text")
    kind = F.element_at(F.array(*map(F.lit, ["事实", "流程", "x", "决策", " 禁忌 ", "运营"])), (F.col("doc_id") % 6 + 1).cast("int"))
    rows = d.join(R.small(b), F.col("doc_id") % b.count() == F.col("item_id")).select(
        "text", kind.alias("type"), F.when(F.col("doc_id") % 7 == 0, "short").otherwise(F.concat(F.substring("text", 1, 20), F.lit("content"))).alias("content"), F.substr("b_text", F.lit(1), (10 + 8 * (F.col("item_id") % 20)).cast("int")).alias("quote")
    )
    # the place is only worked out where the quote is found
    hit = F.contains(X.squeeze(F.col("text")), X.squeeze(F.col("quote")))
    rows = rows.withColumn("at", F.when(hit, C.located(F.col("text"), F.col("quote"))))
    span = F.btrim(F.substr("text", (F.col("at.start") + 1).cast("int"), (F.col("at.end") - F.col("at.start")).cast("int")), F.lit(" \n\t\r"))
    reason = C.reject_reason(F.col("type"), F.col("content"), span, F.lit(True))
    return rows.select(F.coalesce(reason, F.lit("accepted")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def of_day(spark, sf_dir):
    """Events with their second of the whole month."""
    seconds = F.expr("CAST(datediff(ts, DATE'2024-01-01') AS BIGINT) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT)")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", seconds.alias("t"))


SECONDS_SQL = "ev AS (SELECT event_id, user_id, event_type, value, CAST(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS BIGINT) AS t FROM events)"


@query(
    f"""WITH {SECONDS_SQL}, v AS (SELECT user_id, t, max(event_id) AS view_id FROM ev WHERE event_type = 'view' GROUP BY user_id, t), p AS (SELECT * FROM ev WHERE event_type = 'purchase')
    SELECT p.event_id, v.t AS view_t, v.view_id FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.t >= v.t"""
)
def as_of_view(spark, sf_dir):
    """Each purchase with its user's last view at or before it."""
    rows = of_day(spark, sf_dir)
    views = rows.filter("event_type = 'view'").select("user_id", F.col("t").alias("view_t"), F.col("event_id").alias("view_id"))
    return R.as_of(rows.filter("event_type = 'purchase'"), views, ["user_id"], "t", "view_t", ["view_id"]).select("event_id", "view_t", "view_id")


@query(
    f"""WITH {SECONDS_SQL}
    SELECT p.event_id, count(c.event_id) AS clicks, round(sum(c.value), 2) AS value FROM ev p JOIN ev c ON c.user_id = p.user_id AND c.event_type = 'click' AND c.t BETWEEN greatest(p.t - 86400, 0) AND p.t + 86400
    WHERE p.event_type = 'purchase' GROUP BY p.event_id"""
)
def clicks_around(spark, sf_dir):
    """Clicks of the same user within a day of each purchase."""
    rows = of_day(spark, sf_dir)
    around = rows.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase"), F.greatest(F.col("t") - 86400, F.lit(0)).alias("low"), (F.col("t") + 86400).alias("high"))
    met = R.in_interval(rows.filter("event_type = 'click'"), around, ["user_id"], "t", "low", "high", 172800, closed=True)
    return met.groupBy(F.col("purchase").alias("event_id")).agg(F.count("*").alias("clicks"), F.round(F.sum("value"), 2).alias("value"))


ALIGNED_SQL = f"""WITH {SECONDS_SQL}, f AS (SELECT event_id AS frame_id, user_id AS course, t FROM ev WHERE event_type = 'error'), b AS (SELECT user_id AS course, t FROM ev WHERE event_type = 'view'),
    c AS (SELECT f.frame_id, f.course, f.t BETWEEN 0 AND 2000000 AS in_video, EXISTS (SELECT 1 FROM b WHERE b.course = f.course AND b.t <= f.t) AS has_block,
      EXISTS (SELECT 1 FROM b WHERE b.course = f.course AND b.t BETWEEN greatest(f.t - 60, 0) AND f.t + 60) AS has_text FROM f),
    j AS (SELECT *, CASE WHEN NOT has_text THEN 'unknown' WHEN frame_id % 5 = 0 THEN 'failed' WHEN frame_id % 2 = 0 THEN 'agree' ELSE 'differ' END AS judged FROM c)
    SELECT frame_id, in_video, has_block, judged, in_video AND has_block AND judged = 'agree' AS passed FROM j"""


@query(ALIGNED_SQL)
def frames_aligned(spark, sf_dir):
    """Three checks of error events as frames against view events as blocks."""
    rows = of_day(spark, sf_dir)
    frames = rows.filter("event_type = 'error'").select(F.col("event_id").alias("frame_id"), F.col("user_id").alias("course_id"), F.col("t").cast("double").alias("timestamp_sec"), F.lit(2000000.0).alias("duration"))
    blocks = rows.filter("event_type = 'view'").select(F.col("user_id").alias("course_id"), F.col("event_id").alias("block_idx"), F.col("t").cast("double").alias("start_sec"), F.lit("text").alias("text"))
    replies = frames.filter("frame_id % 5 <> 0").select("frame_id", (F.col("frame_id") % 2 == 0).alias("consistent"))
    return FR.aligned(frames, blocks, replies).select("frame_id", "in_video", "has_block", "judged", "passed")


@query(f"SELECT count(*) AS checks, count(*) FILTER (passed) AS passes, CAST(format('{{:.4f}}', count(*) FILTER (passed) / count(*)) AS DOUBLE) AS ratio FROM ({ALIGNED_SQL})")
def alignment_ratio(spark, sf_dir):
    """How many of the frames' checks have passed, of all."""
    return FR.pass_ratio(frames_aligned(spark, sf_dir))


@query(
    """SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase,
    count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'view') AS "view" FROM events GROUP BY user_id"""
)
def label_pivot(spark, sf_dir):
    """Events of each user by type, one column each."""
    return FR.label_counts(table(spark, sf_dir, "events"), "user_id", "event_type", ["click", "error", "purchase", "signup", "view"])


HEX = "CAST('0x' || substr({h}, {i}, 8) AS BIGINT)"


@query(
    f"""WITH h AS (SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS a, md5(CAST(event_id + 1 AS VARCHAR)) AS b FROM events)
    SELECT event_id, CAST(bit_count(xor({HEX.format(h="a", i=1)}, {HEX.format(h="b", i=1)})) + bit_count(xor({HEX.format(h="a", i=9)}, {HEX.format(h="b", i=9)})) AS INTEGER) AS distance FROM h"""
)
def hash_distance(spark, sf_dir):
    """Differing bits of each event's hash and the next one's."""
    digest = lambda c: F.substring(F.md5(c.cast("string").cast("binary")), 1, 16)
    return table(spark, sf_dir, "events").select("event_id", vectors.hamming(digest(F.col("event_id")), digest(F.col("event_id") + 1)).alias("distance"))


@query(
    """WITH RECURSIVE b AS (SELECT user_id, event_id, substr(md5(CAST(event_id AS VARCHAR)), 1, 16) AS phash, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 16) AS UBIGINT) AS h, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
    f AS (SELECT user_id, event_id, phash, i, [h] AS kept, true AS fine FROM b WHERE i = 1
      UNION ALL SELECT user_id, event_id, phash, i, CASE WHEN fine THEN list_append(kept, h) ELSE kept END, fine FROM (
        SELECT b.*, f.kept, len(list_filter(f.kept, lambda k: bit_count(xor(k, b.h)) <= 24)) = 0 AS fine FROM f JOIN b ON b.user_id = f.user_id AND b.i = f.i + 1))
    SELECT user_id, event_id, phash FROM f WHERE fine"""
)
def frames_distinct(spark, sf_dir):
    """Frames of each user whose hashes differ in more than 24 bits from all that were kept before."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 16).alias("phash"))
    return FR.distinct_frames(rows, "user_id", "event_id", "phash", 24)


@query(
    """WITH RECURSIVE b AS (SELECT CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS course_id, event_id, CAST('0x' || substr(md5(CAST(event_id // 8 AS VARCHAR)), 1, 14) || substr(md5(CAST(event_id AS VARCHAR)), 1, 2) AS UBIGINT) AS h FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY event_id) AS i FROM b),
    f AS (SELECT course_id, event_id, i, [h] AS kept, true AS fine FROM n WHERE i = 1
      UNION ALL SELECT course_id, event_id, i, CASE WHEN fine THEN list_append(kept, h) ELSE kept END, fine FROM (
        SELECT n.*, f.kept, len(list_filter(f.kept, lambda k: bit_count(xor(k, n.h)) <= 6)) = 0 AS fine FROM f JOIN n ON n.course_id = f.course_id AND n.i = f.i + 1))
    SELECT course_id, event_id FROM f WHERE fine"""
)
def scene_frames(spark, sf_dir):
    """Frames of scenes of near copies, at the usual distance; a third of all belongs to one course."""
    digest = lambda c, n: F.substring(F.md5(c.cast("string").cast("binary")), 1, n)
    phash = F.concat(digest(F.floor(F.col("event_id") / 8), 14), digest(F.col("event_id"), 2))
    rows = table(spark, sf_dir, "events").select(F.when(F.col("user_id") % 3 == 0, -1).otherwise(F.col("user_id")).alias("course_id"), "event_id", phash.alias("phash"))
    return FR.distinct_frames(rows, "course_id", "event_id", "phash").select("course_id", "event_id")


@query(
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END AS label, round(value / 7, 3) AS confidence, CAST((event_id - 0.5) * 45.0 AS DOUBLE) AS frame_sec FROM events"""
)
def closed_labels(spark, sf_dir):
    """Labels outside the closed set become other; frame times from their numbers."""
    rows = table(spark, sf_dir, "events").withColumn("c", FR.closed_label(F.col("event_type"), F.col("value") / 7, ["click", "view"], "other"))
    return rows.select("event_id", "c.label", "c.confidence", FR.frame_time(F.col("event_id")).alias("frame_sec"))


def question_rows(spark, sf_dir):
    """Parts as questions of the course of their brand; some break a rule."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    text = lambda n: F.concat(F.col("p_name"), F.lit(f" {n}"))
    options = F.map_from_arrays(F.when(k % 11 == 0, F.array(*map(F.lit, "ABCE"))).otherwise(F.array(*map(F.lit, "ABCD"))), F.array(text(1), text(2), F.when(k % 13 == 0, " ").otherwise(text(3)), F.when(k % 17 == 0, text(1)).otherwise(text(4))))
    return p.select(
        F.col("p_brand").alias("course_id"), k.alias("pos"), F.concat(F.col("p_name"), F.lit(" "), (k % 50).cast("string")).alias("stem"), options.alias("options"), F.when(k % 19 == 0, "E").otherwise("b").alias("answer"),
        F.when(k % 23 == 0, "short").otherwise(F.concat(F.lit("because of "), "p_type")).alias("explanation"), F.array(F.concat(F.lit("c"), (k % 29).cast("string"))).alias("source_card_ids"),
        F.when(k % 3 == 0, F.array(F.lit("无"))).otherwise(F.array(F.concat(F.lit("c"), (k % 31).cast("string")))).alias("distractor_source"), F.when(k % 37 == 0, " ").otherwise("note").alias("distractor_note"),
    )


def card_rows(spark, sf_dir):
    """Each brand's cards: c0 to c24."""
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("course_id")).distinct().select("course_id", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("n")).select("course_id", F.concat(F.lit("c"), F.col("n").cast("string")).alias("card_id"))


QUESTION_SQL = """
  q AS (SELECT *, p_name || ' ' || CAST(p_partkey % 50 AS VARCHAR) AS stem, CASE WHEN p_partkey % 3 = 0 THEN '无' ELSE 'c' || CAST(p_partkey % 31 AS VARCHAR) END AS other FROM part),
  e AS (SELECT *, CASE WHEN length(trim(stem)) < 8 THEN 'short_stem' WHEN p_partkey % 11 = 0 THEN 'bad_options' WHEN p_partkey % 13 = 0 THEN 'empty_option' WHEN p_partkey % 17 = 0 THEN 'equal_options'
      WHEN p_partkey % 19 = 0 THEN 'bad_answer' WHEN p_partkey % 23 = 0 THEN 'short_explanation' WHEN p_partkey % 29 > 24 THEN 'unknown_source'
      WHEN p_partkey % 3 <> 0 AND p_partkey % 31 > 24 THEN 'unknown_distractor' WHEN p_partkey % 37 = 0 THEN 'empty_note' END AS err FROM q),
  v AS (SELECT *, CASE WHEN err IS NULL AND row_number() OVER (PARTITION BY p_brand, trim(stem), err IS NULL ORDER BY p_partkey) > 1 THEN 'equal_stem' ELSE err END AS error FROM e)"""


@query(f"WITH {QUESTION_SQL} SELECT p_brand AS course_id, p_partkey AS pos, coalesce(error, 'accepted') AS error FROM v")
def question_validation(spark, sf_dir):
    """The first rule that each question breaks."""
    return Q.validated(question_rows(spark, sf_dir), card_rows(spark, sf_dir)).select("course_id", "pos", F.coalesce("error", F.lit("accepted")).alias("error"))


@query(f"WITH {QUESTION_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY other = '无', p_partkey) AS q_no FROM v WHERE error IS NULL) SELECT p_brand AS course_id, p_partkey AS pos, CAST(q_no AS INTEGER) AS q_no FROM r WHERE q_no <= 5")
def questions_selected(spark, sf_dir):
    """Five accepted questions of each course, real distractors first."""
    fine = Q.validated(question_rows(spark, sf_dir), card_rows(spark, sf_dir)).filter("error is null")
    return Q.selected(fine, "course_id", "pos").select("course_id", "pos", "q_no")


@query(
    f"""WITH {QUESTION_SQL}, i AS (SELECT DISTINCT p_brand, unnest(['c' || CAST(p_partkey % 29 AS VARCHAR), other]) AS id FROM v WHERE error IS NULL), u AS (SELECT p_brand, count(*) AS used FROM i WHERE id <> '无' AND CAST(substr(id, 2) AS INTEGER) <= 24 GROUP BY p_brand)
    SELECT p_brand AS course_id, coalesce(used, 0) AS used, CAST(25 AS BIGINT) AS cards, round(coalesce(used, 0) / 25, 3) AS coverage FROM (SELECT DISTINCT p_brand FROM part) LEFT JOIN u USING (p_brand)"""
)
def card_coverage(spark, sf_dir):
    """The share of each course's cards that its accepted questions draw on."""
    cards = card_rows(spark, sf_dir)
    return Q.used_cards(Q.validated(question_rows(spark, sf_dir), cards).filter("error is null"), cards, "course_id")


#: Questions below which a course is weak; brands have hundreds of parts.
WEAK = 70


@query(f"WITH {QUESTION_SQL}, g AS (SELECT p_brand AS course_id, count(*) AS questions, count(*) FILTER (other <> '无') AS real FROM v WHERE error IS NULL  GROUP BY 1) SELECT * FROM g WHERE questions < {WEAK} OR real < 1")
def weak_courses(spark, sf_dir):
    """Courses with too few questions."""
    rows = Q.validated(question_rows(spark, sf_dir), card_rows(spark, sf_dir)).filter("error is null")
    return Q.course_gate(rows, "course_id", WEAK)


@query("SELECT p_brand AS course_id, CAST(p_partkey AS VARCHAR) AS key, 'c' || CAST(p_partkey % 29 AS VARCHAR) AS id FROM part WHERE p_partkey % 29 > 24")
def unknown_sources(spark, sf_dir):
    """Questions that name cards which do not exist."""
    rows = question_rows(spark, sf_dir).withColumn("key", F.col("pos").cast("string"))
    found = Q.unknown_ids(rows, "key", "source_card_ids", card_rows(spark, sf_dir), "course_id", "card_id")
    return found.join(rows.select("key", "course_id"), "key").select("course_id", "key", "id")


@query(
    f"""WITH {SECONDS_SQL}, m AS (SELECT DISTINCT user_id, t % 86400 AS mark FROM ev WHERE event_type = 'click'), c AS (SELECT user_id, t % 86400 AS s FROM ev WHERE event_type = 'view')
    SELECT user_id AS course_id, mark FROM m WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = m.user_id AND abs(c.s - m.mark) <= 600)"""
)
def stray_marks(spark, sf_dir):
    """Time marks of handouts made of clicks that no view stands within ten minutes of."""
    rows = of_day(spark, sf_dir).withColumn("s", F.col("t") % 86400)
    mark = F.concat(F.lit("【"), X.hms(F.col("s")), F.lit("】"))
    pages = rows.filter("event_type = 'click'").groupBy(F.col("user_id").alias("course_id")).agg(F.array_join(F.collect_set(mark), " ").alias("markdown"))
    cards = rows.filter("event_type = 'view'").select(F.col("user_id").alias("course_id"), F.col("s").cast("double").alias("start_sec"))
    return Q.stray_marks(pages, cards, reach=600).select("course_id", "mark")


@query(
    """WITH l AS (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_size, p_partkey) AS i, CASE WHEN p_type = 'SMALL' THEN '> ' ELSE '- ' END || '【00:' || lpad(CAST(p_size AS VARCHAR), 2, '0') || ':00】' || p_name AS line FROM part WHERE p_type IN ('ECONOMY', 'SMALL')),
    s AS (SELECT p_brand, p_type, '## ' || p_type || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY i) AS b FROM l GROUP BY p_brand, p_type)
    SELECT p_brand AS course_id, string_agg(b, chr(10) || chr(10) ORDER BY p_type) || chr(10) AS markdown FROM s GROUP BY p_brand"""
)
def template_handouts(spark, sf_dir):
    """Handouts made of parts as cards: a section per type, in order of time."""
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("course_id"), F.col("p_type").alias("type"), (F.col("p_size") * 60.0).alias("start_sec"), F.col("p_partkey").alias("card_id"), F.col("p_name").alias("content"))
    return Q.template_handout(rows, types=["ECONOMY", "SMALL"], quoted="SMALL")


@query(
    r"""WITH RECURSIVE b AS (SELECT conv_id, turn, text AS quote, regexp_replace(text, '\s+', '', 'g') AS q, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
    f AS (SELECT conv_id, turn, quote, i, [q] AS kept, true AS fine FROM b WHERE i = 1
      UNION ALL SELECT conv_id, turn, quote, i, CASE WHEN fine THEN list_append(kept, q) ELSE kept END, fine FROM (
        SELECT b.*, f.kept, len(list_filter(f.kept, lambda k: contains(k, b.q) OR contains(b.q, k))) = 0 AS fine FROM f JOIN b ON b.conv_id = f.conv_id AND b.i = f.i + 1))
    SELECT conv_id, turn, quote FROM f WHERE fine"""
)
def contained_cards(spark, sf_dir):
    """Turns that neither hold an earlier kept turn's text nor are part of one."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("quote"))
    return C.drop_contained(rows, "conv_id", "turn", "quote")


#: A pick a step: t types left (names and counts), p picks so far; a type pointed at without a card leaves.
@query(
    """WITH RECURSIVE c AS (SELECT p_brand, p_partkey, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS nth FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')),
    n AS (SELECT p_brand, list(p_type ORDER BY p_type) AS t, list(n ORDER BY p_type) AS n FROM (SELECT p_brand, p_type, count(*) AS n FROM c GROUP BY ALL) GROUP BY p_brand),
    f AS (SELECT p_brand, t, n, 0 AS turn, [0 for x in t] AS used, CAST(NULL AS VARCHAR) AS pick, CAST(0 AS BIGINT) AS nth FROM n
      UNION ALL SELECT p_brand, CASE WHEN has THEN t ELSE list_concat(t[:pos - 1], t[pos + 1:]) END, CASE WHEN has THEN n ELSE list_concat(n[:pos - 1], n[pos + 1:]) END, CASE WHEN has THEN turn + 1 ELSE turn END,
        CASE WHEN has THEN list_concat(used[:pos - 1], [used[pos] + 1], used[pos + 1:]) ELSE list_concat(used[:pos - 1], used[pos + 1:]) END, CASE WHEN has THEN t[pos] END, CASE WHEN has THEN CAST(used[pos] + 1 AS BIGINT) ELSE 0 END
      FROM (SELECT *, used[pos] < n[pos] AS has FROM (SELECT *, turn % len(t) + 1 AS pos FROM f WHERE len(t) > 0 AND turn < 12)))
    SELECT c.p_brand, c.p_partkey, c.p_type, CAST(f.turn AS BIGINT) AS pick_no FROM f JOIN c ON c.p_brand = f.p_brand AND c.p_type = f.pick AND c.nth = f.nth WHERE f.pick IS NOT NULL"""
)
def cards_in_turn(spark, sf_dir):
    """Twelve parts of each brand, their types in turn."""
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_type")
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    return C.round_robin(rows, "p_brand", "p_partkey", "p_type", types=types)


@query("SELECT p_brand AS course_id, p_type AS type, count(*) AS n FROM part GROUP BY ALL")
def card_types(spark, sf_dir):
    return C.distribution(table(spark, sf_dir, "part").select(F.col("p_brand").alias("course_id"), F.col("p_type").alias("type")), "course_id", "type")
