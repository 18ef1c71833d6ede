"""Queries: a dictionary's work on whole texts (replacement with guards, contexts, candidates' surroundings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import vocabulary as V
from tessera.operators import replacement as R
from tessera.operators import terms as M
from tessera.operators.relational import stored
from tessera.plans import queries_terms as T
from tessera.plans.catalogue import query
from tessera.session import table

#: The dictionary of the queries is made of so many of the most frequent words of three to eight letters.
FORMS = 480
WORD = "[a-zß-ÿ]+"

#: Words by frequency: every second one is a variant, the others are canonicals. A variant's canonical is the most
#: frequent one that holds it, else itself with a plus. Of three variants one is guarded in front, one behind.
DICTIONARY_SQL = f"""
  counted AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS w FROM documents) WHERE length(w) BETWEEN 3 AND 8 GROUP BY w),
  ranked AS (SELECT w, row_number() OVER (ORDER BY n DESC, w) - 1 AS r FROM counted ORDER BY r LIMIT {FORMS}),
  variants AS (SELECT v.w AS form, v.r, coalesce(arg_min(c.w, c.r), v.w || '+') AS canonical FROM ranked v LEFT JOIN ranked c ON c.r % 2 = 0 AND c.w <> v.w AND contains(c.w, v.w) WHERE v.r % 2 = 1 GROUP BY v.w, v.r),
  forms AS (SELECT form, canonical, r % 3 = 0 AS front, r % 3 = 1 AS behind FROM variants UNION ALL SELECT DISTINCT canonical, NULL, false, false FROM variants WHERE canonical NOT IN (SELECT form FROM variants))"""
#: All places at which a form begins; longest first, guards tested; overlapping places make an island, in which they are taken from the left.
CHARS_SQL = """
  chars AS (SELECT doc_id, unnest(generate_series(1, length(text))) AS i, unnest(string_split(text, '')) AS c FROM documents WHERE text <> ''),
  s AS (SELECT doc_id, i, c, coalesce(lag(c) OVER w, '') AS p, {leads} FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  met AS (SELECT doc_id, i, i + length(form) AS e, f.form, canonical, (front AND p <> '' AND contains('aeiou', p)) OR (behind AND nx <> '' AND contains('aeiou', nx)) AS refused FROM (
    {unions}) m JOIN forms f ON f.form = m.s),
  fine AS (SELECT * EXCLUDE (refused) FROM met WHERE NOT refused QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY e DESC) = 1),
  isle AS (SELECT *, sum(CASE WHEN i >= coalesce(reach, 0) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM fine)),
  walk AS (SELECT * FROM (SELECT doc_id, island, i, e, form, canonical FROM isle QUALIFY row_number() OVER (PARTITION BY doc_id, island ORDER BY i) = 1)
    UNION ALL SELECT doc_id, island, i, e, form, canonical FROM (SELECT n.doc_id, n.island, n.i, n.e, n.form, n.canonical FROM walk JOIN isle n ON n.doc_id = walk.doc_id AND n.island = walk.island AND n.i >= walk.e
      QUALIFY row_number() OVER (PARTITION BY n.doc_id, n.island ORDER BY n.i) = 1)),
  lost AS (SELECT m.doc_id, m.canonical FROM met m LEFT JOIN walk t ON t.doc_id = m.doc_id AND ((t.i < m.i AND m.i < t.e) OR (t.i = m.i AND t.e > m.e)) WHERE m.refused AND t.doc_id IS NULL)"""


def _walk_sql() -> str:
    """The common tables up to the places taken (walk) and the guarded skips (lost); forms have three to nine letters."""
    leads = ", ".join(f"lead(c, {k}) OVER w AS c{k}" for k in range(1, 10))
    parts = []
    for size in range(3, 10):
        text = " || ".join(["c", *[f"c{k}" for k in range(1, size)]])
        parts.append(f"SELECT doc_id, i, p, {text} AS s, coalesce(c{size}, '') AS nx FROM s")
    return f"WITH RECURSIVE {DICTIONARY_SQL},{CHARS_SQL.format(leads=leads, unions=' UNION ALL '.join(parts))}"


def dictionary(spark, sf_dir):
    """(terms, guards): words of the documents as a dictionary, see DICTIONARY_SQL."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("w")).filter(F.length("w").between(3, 8))
    ranked = [r.w for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(FORMS).collect()]
    canonicals, terms, guards = ranked[::2], {}, {}
    for r, form in list(enumerate(ranked))[1::2]:
        terms.setdefault(next((c for c in canonicals if form in c), form + "+"), []).append(form)
        if r % 3 < 2:
            guards[form] = ("aeiou", "") if r % 3 == 0 else ("", "aeiou")
    return list(terms.items()), guards


def cleaned_documents(spark, sf_dir):
    terms, guards = dictionary(spark, sf_dir)
    return R.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text"), terms, guards)


@query(
    f"""{_walk_sql()} SELECT doc_id, canonical, CAST(sum(n) AS BIGINT) AS n, CAST(sum(skipped) AS BIGINT) AS skipped FROM (SELECT doc_id, canonical, 1 AS n, 0 AS skipped FROM walk WHERE canonical IS NOT NULL UNION ALL SELECT doc_id, canonical, 0, 1 FROM lost) GROUP BY ALL"""
)
def replacement_counts(spark, sf_dir):
    """Hits and guarded skips of a dictionary of 240 variants on the whole texts of all documents."""
    return R.hit_counts(cleaned_documents(spark, sf_dir), "doc_id")


@query(
    f"""{_walk_sql()}, pieces AS (SELECT s.doc_id, s.i, CASE WHEN t.i IS NULL OR t.canonical IS NULL OR s.i >= t.e THEN c WHEN t.i = s.i THEN t.canonical ELSE '' END AS piece FROM chars s ASOF LEFT JOIN walk t ON t.doc_id = s.doc_id AND t.i <= s.i)
    SELECT doc_id, md5(coalesce(string_agg(piece, '' ORDER BY i), '')) AS h FROM pieces GROUP BY doc_id"""
)
def cleaned_texts(spark, sf_dir):
    """The texts that have any character, with the dictionary's canonicals in place of its variants."""
    return cleaned_documents(spark, sf_dir).filter("text <> ''").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))


@query(
    f"""WITH {DICTIONARY_SQL}, f AS (SELECT form, min(doc_id) AS doc_id FROM forms JOIN documents ON contains(text, form) GROUP BY form), p AS (SELECT form, doc_id, text, instr(text, form) - 1 AS pos FROM f JOIN documents USING (doc_id))
    SELECT form, doc_id, '…' || replace(substr(text, greatest(pos - 22, 0) + 1, pos - greatest(pos - 22, 0) + length(form) + 22), chr(10), ' ') || '…' AS context FROM p"""
)
def term_contexts(spark, sf_dir):
    """Every form of the dictionary with its surroundings in the first document that holds it."""
    terms, _ = dictionary(spark, sf_dir)
    forms = spark.createDataFrame([(f,) for c, vs in terms for f in (c, *vs)], "form string")
    return R.first_contexts(forms, table(spark, sf_dir, "documents"), "form", "doc_id", "text")


@query(
    f"""WITH {T.STATS_SQL}, {T.TERMS_SQL}, {T.CANDIDATES_SQL}, texts AS (SELECT conv_id * 1000 + turn AS id, lower(text) AS t FROM conversations),
    asked AS (SELECT b AS form FROM candidates UNION SELECT a FROM candidates WHERE kind <> '锚定'), firsts AS (SELECT form, min(id) AS id FROM asked JOIN texts ON contains(t, form) GROUP BY form),
    ctx AS (SELECT form, '…' || replace(substr(t, greatest(instr(t, form) - 23, 0) + 1, instr(t, form) - 1 - greatest(instr(t, form) - 23, 0) + length(form) + 22), chr(10), ' ') || '…' AS context FROM firsts JOIN texts USING (id))
    SELECT kind, a, b, CASE WHEN kind = '锚定' THEN (SELECT count(*) FROM texts) ELSE na END AS na, CASE WHEN kind = '锚定' THEN '(词典 canonical:' || a || ')' ELSE coalesce(xa.context, '') END AS ctx_a, coalesce(xb.context, '') AS ctx_b,
      CASE WHEN kind = '锚定' THEN '建议采纳(与词典术语同音异形)' ELSE '建议 LLM 裁决' END AS suggest FROM candidates LEFT JOIN ctx xa ON xa.form = a LEFT JOIN ctx xb ON xb.form = b"""
)
def candidate_contexts(spark, sf_dir):
    """Anchored and clustered candidates of all conversations, as they are handed to a judge."""
    counts = stored(T.stats(spark, sf_dir).filter("n >= 3"))
    pairs = T.anchored_terms(spark, sf_dir, counts).select(F.lit(V.ANCHORED).alias("kind"), "a", "b", F.lit(None).cast("long").alias("na"))
    pairs = pairs.unionAll(T.clustered_terms(spark, sf_dir, counts).select(F.lit("聚类").alias("kind"), "a", "b", "na"))
    texts = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lower("text").alias("t"))
    return R.enriched(stored(pairs), texts, "id", "t").select("kind", "a", "b", "na", "ctx_a", "ctx_b", "suggest")
