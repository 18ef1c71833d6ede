"""Queries: terminology, replacement, number checks, text statistics, acceptance checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.functions import text as X
from tessera.operators import frames as FR
from tessera.operators import terms as M
from tessera.operators.relational import batches, small, stored
from tessera.plans import checks
from tessera.plans.catalogue import query
from tessera.plans.providers import numbered_prompt
from tessera.plans.queries_retrieval import SPACE, turns
from tessera.session import table

LATIN = "[a-z]{2,}"
#: Letters that sound alike have one key; the others keep theirs.
SOUNDS = {c: k for k, cs in {"a": "aeiou", "b": "bp", "d": "dt", "g": "gkcq", "s": "szx", "m": "mn", "f": "fvw", "r": "rl", "h": "hjy"}.items() for c in cs}
SOUND_MAP = "MAP {" + ", ".join(f"'{c}': '{k}'" for c, k in SOUNDS.items()) + "}"
STATS_SQL = r"""
  runs AS (SELECT conv_id * 1000 + turn AS id, unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS r FROM conversations),
  grams AS (SELECT id, unnest(flatten(list_transform(generate_series(2, 6), lambda k: CASE WHEN length(r) < k THEN [] ELSE list_transform(generate_series(1, length(r) - k + 1), lambda i: substr(r, i, k)) END))) AS gram FROM runs),
  stats AS (SELECT gram, count(*) AS n, count(DISTINCT id) AS courses FROM grams GROUP BY gram)"""


def stats(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lower("text").alias("t"))
    return M.gram_stats(rows, "id", "t", run=LATIN)


@query(f"WITH {STATS_SQL} SELECT gram, n, courses FROM stats WHERE n >= 3")
def gram_counts(spark, sf_dir):
    """Letter grams of two to six that occur three times or more."""
    return stats(spark, sf_dir).filter("n >= 3")


def dictionary(spark):
    rows = [("the", ["teh"], "w", "seed", 0), ("and", ["ant", "xnd"], "w", "seed", 1), ("tion", [], "w", "mined", 2), ("with", ["wiht"], "w", "mined", 3)]
    return spark.createDataFrame(rows, "canonical string, variants array<string>, category string, source string, ord long")


TERMS_SQL = "terms(canonical, ord) AS (VALUES ('the', 0), ('and', 1), ('tion', 2), ('with', 3)), names(gram) AS (VALUES ('the'), ('and'), ('tion'), ('with'), ('teh'), ('ant'), ('xnd'), ('wiht'))"


def sound(column: str) -> str:
    return f"array_to_string(list_transform(string_split({column}, ''), lambda c: coalesce(snd[c], '')), ' ')"


#: anchored (a, b, n, courses), clustered (a, b, ca, cb, na, nb, score), and both as candidates (kind, a, b, na).
CANDIDATES_SQL = f"""
  sm AS (SELECT {SOUND_MAP} AS snd), f AS (SELECT gram, n, courses, {sound("gram")} AS key FROM stats, sm WHERE n >= 3 AND gram NOT IN (SELECT gram FROM names)),
  c AS (SELECT canonical, ord, {sound("canonical")} AS key FROM terms, sm),
  anchored AS (SELECT a, b, n, courses FROM (SELECT canonical AS a, gram AS b, n, courses, row_number() OVER (PARTITION BY gram ORDER BY ord) AS i FROM f JOIN c ON f.key = c.key AND length(gram) = length(canonical) WHERE NOT (canonical = 'the' AND gram = 'tha')) WHERE i = 1),
  k AS (SELECT gram, n, courses, {sound("gram")} AS key FROM stats, sm WHERE n >= 5), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, gram) AS rk FROM k), t AS (SELECT r.*, canonical IS NOT NULL AS canon FROM r LEFT JOIN terms ON gram = canonical WHERE rk <= 6),
  p AS (SELECT x.gram AS a, y.gram AS b, x.key, x.n AS ca, y.n AS cb, x.courses AS na, y.courses AS nb, least(x.n, y.n) AS score, x.rk AS i, y.rk AS j FROM t x JOIN t y ON x.key = y.key AND x.rk < y.rk WHERE NOT (x.canon AND y.canon)),
  clustered AS (SELECT a, b, ca, cb, na, nb, score FROM p WHERE (a, b) NOT IN (('er', 'ir'), ('ir', 'er')) ORDER BY score DESC, key, i, j LIMIT 300),
  candidates AS (SELECT '锚定' AS kind, a, b, NULL AS na FROM anchored UNION ALL SELECT '聚类', a, b, na FROM clustered)"""


@query(f"WITH {STATS_SQL}, {TERMS_SQL}, {CANDIDATES_SQL} SELECT a, b, n, courses FROM anchored")
def anchored_terms(spark, sf_dir, counts=None):
    """Grams that sound like a dictionary term of their length."""
    known = spark.createDataFrame([("the", "tha")], "a string, b string")
    return M.anchored(stats(spark, sf_dir) if counts is None else counts, dictionary(spark), known, SOUNDS, 3).drop("key")


@query(f"WITH {STATS_SQL}, {TERMS_SQL}, {CANDIDATES_SQL} SELECT a, b, ca, cb, na, nb, score FROM clustered")
def clustered_terms(spark, sf_dir, counts=None):
    """Pairs of frequent grams that sound alike, the best 300."""
    known = spark.createDataFrame([("er", "ir")], "a string, b string")
    return M.clustered(stats(spark, sf_dir) if counts is None else counts, dictionary(spark), known, SOUNDS, 5, 300).drop("key")


ASKED_SQL = """
  q AS (SELECT (p_partkey // 15) AS batch_no, p_partkey % 15 + 1 AS item_no, p_name AS a, p_type AS b, p_partkey AS k FROM part),
  w AS (SELECT *, batch_no % 5 <> 0 AS answered, k % 4 <> 0 AS replied, CASE k % 3 WHEN 0 THEN 'adopt' WHEN 1 THEN 'synonym' ELSE 'reject' END AS d, CASE WHEN k % 7 = 0 THEN 'else' ELSE b END AS v FROM q),
  j AS (SELECT batch_no, item_no, a, b, CASE WHEN NOT answered THEN 'undecided' WHEN NOT replied THEN 'reject' WHEN d <> 'reject' AND v <> b THEN 'reject' ELSE d END AS decision, v FROM w)"""


def judged(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    asked = p.select(F.floor(k / 15).alias("batch_no"), (k % 15 + 1).alias("item_no"), F.col("p_name").alias("a"), F.col("p_type").alias("b"), k.alias("k"))
    decision = F.when(k % 3 == 0, "adopt").when(k % 3 == 1, "synonym").otherwise("reject")
    first = p.filter((F.floor(k / 15) % 5 != 0) & (k % 4 != 0)).select(F.floor(k / 15).alias("batch_no"), (k % 15 + 1).alias("item_no"), F.lit("reject").alias("decision"), F.lit("x").alias("canonical"), F.lit("y").alias("variant"), F.lit(0).alias("pos"))
    last = p.filter((F.floor(k / 15) % 5 != 0) & (k % 4 != 0)).select(F.floor(k / 15).alias("batch_no"), (k % 15 + 1).alias("item_no"), decision.alias("decision"), F.col("p_name").alias("canonical"), F.when(k % 7 == 0, "else").otherwise(F.col("p_type")).alias("variant"), F.lit(1).alias("pos"))
    return M.adjudicated(asked, first.unionAll(last))


@query(f"WITH {ASKED_SQL} SELECT batch_no, item_no, a, b, decision, CASE WHEN decision IN ('adopt', 'synonym') THEN a END AS canonical, CASE WHEN decision IN ('adopt', 'synonym') THEN v END AS variant FROM j")
def adjudications(spark, sf_dir):
    """Decisions on pairs of forms: the last reply counts, adoptions must name the pair."""
    return judged(spark, sf_dir)


@query(f"WITH {ASKED_SQL} SELECT decision, count(*) AS n FROM j GROUP BY decision")
def decision_counts(spark, sf_dir):
    return judged(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"))


@query(
    """WITH base AS (SELECT p_brand AS canonical, p_type AS variant, min(p_partkey) AS o FROM part WHERE p_partkey % 3 = 0 GROUP BY ALL), new AS (SELECT p_brand AS canonical, p_type AS variant, min(p_partkey) AS o FROM part WHERE p_partkey % 3 = 1 GROUP BY ALL),
    u AS (SELECT canonical, variant, o, 0 AS r FROM base UNION ALL SELECT canonical, variant, o, 1 FROM new WHERE (canonical, variant) NOT IN (SELECT (canonical, variant) FROM base))
    SELECT canonical, string_agg(variant, ',' ORDER BY r, o) AS variants FROM u GROUP BY canonical"""
)
def dictionary_merge(spark, sf_dir):
    """A dictionary of brands and types with adopted variants added once each."""
    p = table(spark, sf_dir, "part")
    once = lambda k: p.filter(F.col("p_partkey") % 3 == k).groupBy(F.col("p_brand").alias("canonical"), F.col("p_type").alias("variant")).agg(F.min("p_partkey").alias("o"))
    parts = F.array_sort(F.collect_list(F.struct("o", "variant")))
    terms = once(0).groupBy("canonical").agg(F.transform(parts, lambda x: x["variant"]).alias("variants"), F.min("o").alias("ord")).select("canonical", "variants", F.lit("c").alias("category"), F.lit("seed").alias("source"), "ord")
    new = once(1).select("canonical", "variant", F.lit("c").alias("category"), F.col("o").alias("pos"))
    return M.merged(terms, new).select("canonical", F.array_join("variants", ",").alias("variants"))


@query(
    """WITH t AS (SELECT p_brand AS canonical, p_type AS variant, min(p_partkey) AS o FROM part GROUP BY ALL), k AS (SELECT * FROM t WHERE variant <> 'ECONOMY'),
    n AS (SELECT canonical, bool_or(variant = 'ECONOMY') AS touched FROM t GROUP BY canonical), g AS (SELECT canonical, string_agg(variant, ',' ORDER BY o) AS variants FROM k GROUP BY canonical)
    SELECT n.canonical, coalesce(variants, '') AS variants FROM n LEFT JOIN g USING (canonical) WHERE NOT (variants IS NULL AND touched AND substr(n.canonical, 7, 1) <> '1') UNION ALL SELECT 'Brand#new', 'v'"""
)
def dictionary_review(spark, sf_dir):
    """Excluded variants go, and with the last one a term that is no seed; included terms come."""
    once = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("canonical"), F.col("p_type").alias("variant")).agg(F.min("p_partkey").alias("o"))
    terms = once.groupBy("canonical").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "variant"))), lambda x: x["variant"]).alias("variants")).select(
        "canonical", "variants", F.lit("c").alias("category"), F.when(F.substring("canonical", 7, 1) == "1", "seed").otherwise("mined").alias("source")
    )
    out = once.filter("variant = 'ECONOMY'").select("canonical", "variant")
    include = spark.createDataFrame([("Brand#new", ["v"], "c", "human")], "canonical string, variants array<string>, category string, source string")
    return M.reviewed(terms, out, include).select("canonical", F.array_join("variants", ",").alias("variants"))


@query("SELECT doc_id, md5(replace(replace(replace(text, 'there', 'THERE'), 'the', 'THE'), 'ß', 'ss')) AS h, contains(text, 'ß') AS had FROM documents")
def canonical_migration(spark, sf_dir):
    """Longest-first literal replacement, then a single character."""
    text = M.migrated(F.col("text"), {"the": "THE", "there": "THERE"}, ("ß", "ss"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.cast("binary")).alias("h"), F.contains("text", F.lit("ß")).alias("had"))


@query(r"""WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '\d+\.\d+')) AS fragment FROM documents) SELECT doc_id, 'decimal' AS unit, fragment, count(*) AS n FROM f GROUP BY ALL""")
def number_fragments(spark, sf_dir):
    """Number fragments of all documents, counted."""
    found = numbers.number_places(table(spark, sf_dir, "documents"), "doc_id", "text", [(r"[0-9]+\.[0-9]+", "decimal")])
    return found.groupBy("doc_id", "unit", "fragment").agg(F.count("*").alias("n"))


@query(
    r"""WITH r AS (SELECT * FROM (VALUES ('number', '[0-9]+(?:\.[0-9]+)?'), ('mark', '[0-9]+[%$#]')) t(unit, p)), m AS (SELECT doc_id, unit, regexp_extract_all(text, p) AS hit, regexp_split_to_array(text, p) AS gap FROM documents, r WHERE regexp_matches(text, p)),
    u AS (SELECT *, unnest(generate_series(1, len(hit))) AS k FROM m),
    w AS (SELECT doc_id, unit, hit[k] AS fragment, list_sum(list_transform(gap[:k], lambda g: length(g))) + coalesce(list_sum(list_transform(hit[:k - 1], lambda h: length(h))), 0) AS b FROM u)
    SELECT doc_id, unit, CAST(b AS BIGINT) AS "start", CAST(b AS BIGINT) + length(fragment) AS "end", fragment FROM w"""
)
def number_positions(spark, sf_dir):
    """Every number of all documents, with decimals if it has them, and numbers with a mark, with their places."""
    return numbers.number_places(table(spark, sf_dir, "documents"), "doc_id", "text", [(r"(\d+)", "number"), (r"[0-9]+[%$#]", "mark")]).drop("ctx")


@query(
    """SELECT l_orderkey, l_linenumber, CAST(format('{:.2f}', l_extendedprice * l_discount) AS DOUBLE) AS money, CAST(format('{:.2f}', l_quantity / 8) AS DOUBLE) AS ties, CAST(format('{:.4f}', l_discount / l_quantity) AS DOUBLE) AS ratio FROM lineitem"""
)
def exact_rounding(spark, sf_dir):
    """Doubles rounded by their exact binary value, ties to even: products, eighths (of which a quarter are ties), quotients."""
    rows = table(spark, sf_dir, "lineitem")
    rounded = {"money": (F.col("l_extendedprice") * F.col("l_discount"), 2), "ties": (F.col("l_quantity") / 8, 2), "ratio": (F.col("l_discount") / F.col("l_quantity"), 4)}
    return rows.select("l_orderkey", "l_linenumber", *[numbers.half_even(v, n).alias(k) for k, (v, n) in rounded.items()])


@query(
    """WITH i AS (SELECT o_custkey, o_orderpriority AS unit, o_orderkey AS pos, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, o_orderkey, o_orderpriority) AS turn FROM orders)
    SELECT o_custkey, pos, NOT (turn <= 8 AND pos % 3 = 0 AND pos % 5 <> 0) AS ok, CASE WHEN turn <= 8 AND pos % 3 = 0 AND pos % 5 <> 0 THEN 'fix' END AS corrected, CASE WHEN turn > 8 THEN 'sampled_out' WHEN pos % 3 <> 0 THEN 'failed' ELSE 'reviewed' END AS review_state FROM i"""
)
def review_states(spark, sf_dir):
    """Eight items of each course are reviewed, by the priority of their unit."""
    items = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("unit"), F.col("o_orderkey").alias("pos"))
    replies = items.filter("pos % 3 = 0").select("o_custkey", "unit", "pos", F.lit(False).alias("ok"), F.when(F.col("pos") % 5 != 0, "fix").alias("corrected"), F.lit(0).alias("reply_pos"))
    return M.review_state(items, replies, "o_custkey", ["1-URGENT", "2-HIGH"]).select("o_custkey", "pos", "ok", "corrected", "review_state")


@query(
    r"""WITH c AS (SELECT doc_id, text, instr(text, 'tion') - 1 AS pos FROM documents)
    SELECT doc_id, CASE WHEN pos < 0 THEN '' ELSE '…' || replace(substr(text, greatest(pos - 22, 0) + 1, pos - greatest(pos - 22, 0) + 4 + 22), chr(10), ' ') || '…' END AS context FROM c"""
)
def first_contexts(spark, sf_dir):
    """Surroundings of a word's first occurrence."""
    return table(spark, sf_dir, "documents").select("doc_id", X.context(F.col("text"), F.lit("tion")).alias("context"))


@query(
    """WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 40) SELECT doc_id, md5(substr(text, 1, 5) || '<a>' || substr(text, 11, 10) || '<b>' || substr(text, 24)) AS h FROM d"""
)
def placed_fixes(spark, sf_dir):
    """Two spans of each document replaced by position."""
    spans = F.array(F.struct(F.lit(5).alias("start"), F.lit(10).alias("end"), F.lit("<a>").alias("new")), F.struct(F.lit(20).alias("start"), F.lit(23).alias("end"), F.lit("<b>").alias("new")))
    return table(spark, sf_dir, "documents").filter(F.length("text") >= 40).select("doc_id", F.md5(M.placed(F.col("text"), spans).cast("binary")).alias("h"))


@query("SELECT conv_id AS course_id, count(*) FILTER (turn % 5 = 4 OR turn % 7 = 3) AS changed FROM conversations GROUP BY conv_id HAVING count(*) FILTER (turn % 5 = 4 OR turn % 7 = 3) > 0")
def structure_changes(spark, sf_dir):
    """Courses whose blocks changed between two versions."""
    before = turns(spark, sf_dir)
    after = before.filter("block_idx % 5 <> 4").withColumn("speaker", F.when(F.col("block_idx") % 7 == 3, "other").otherwise(F.col("speaker")))
    return M.structure_changes(before, after)


@query(
    r"""WITH c AS (SELECT doc_id, unnest(['thth', 'aa']) AS word, text FROM documents), n AS (SELECT doc_id, word, len(list_filter(generate_series(1, greatest(length(text) - length(word) + 1, 1)), lambda i: substr(text, i, length(word)) = word)) AS n FROM c WHERE contains(text, word))
    SELECT doc_id, word, CAST(n AS INTEGER) AS n FROM n WHERE n > 0"""
)
def residue(spark, sf_dir):
    """Forbidden strings left in documents, overlaps counted."""
    docs = table(spark, sf_dir, "documents").filter(F.contains("text", F.lit("thth")) | F.contains("text", F.lit("aa")))
    return checks.residue(docs, "doc_id", "text", ["thth", "aa"])


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '(?:^|[^a-z])tion')) AS INTEGER) AS n FROM documents WHERE regexp_matches(text, '(?:^|[^a-z])tion')""")
def unguarded_variants(spark, sf_dir):
    """Documents where a variant begins a word."""
    return checks.unguarded(table(spark, sf_dir, "documents"), "doc_id", "text", "tion", before="a-z")


@query("SELECT event_type, count(*) AS rows FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1")
def closed_vocabulary(spark, sf_dir):
    """Values outside the closed set."""
    return checks.outside(table(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def uncovered_keys(spark, sf_dir):
    """Customers without an order."""
    return checks.uncovered(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query(
    rf"""SELECT d.doc_id AS course_id, CAST(b.item_id AS VARCHAR) AS card_id FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id WHERE NOT contains(regexp_replace(d.text, '{SPACE}+', '', 'g'), regexp_replace(b.text, '{SPACE}+', '', 'g'))"""
)
def lost_quotes(spark, sf_dir):
    """Cards whose whole quote is not in their course: each document is asked for one benchmark text."""
    docs, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    cards = docs.select("doc_id").join(small(b), F.col("doc_id") % b.count() == F.col("item_id")).select(F.col("doc_id").alias("course_id"), F.col("item_id").cast("string").alias("card_id"), F.col("text").alias("quote"))
    return checks.lost_quotes(cards, docs.select(F.col("doc_id").alias("course_id"), "text"))


@query(
    """WITH t AS (SELECT p_brand AS canonical, p_type AS variant, min(p_partkey) AS o FROM part GROUP BY ALL), f AS (SELECT canonical, min(o) AS ord FROM t GROUP BY canonical)
    SELECT variant, arg_max(canonical, ord) AS canonical FROM t JOIN f USING (canonical) GROUP BY variant UNION ALL SELECT canonical, canonical FROM f"""
)
def variant_lookup(spark, sf_dir):
    """What each form stands for; the last term that lists it wins."""
    once = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("canonical"), F.col("p_type").alias("variant")).agg(F.min("p_partkey").alias("o"))
    terms = once.groupBy("canonical").agg(F.collect_list("variant").alias("variants"), F.min("o").alias("ord")).withColumn("category", F.lit("c"))
    return M.variant_map(terms, "c")


@query(
    """SELECT p_brand, string_agg(CAST(b AS VARCHAR), '/' ORDER BY b) AS batches, CAST(sum(n) AS BIGINT) AS items FROM (SELECT p_brand, p_partkey // 15 AS b, count(*) AS n FROM part WHERE (p_partkey // 15) % 5 = 0 GROUP BY ALL) GROUP BY p_brand"""
)
def failed_batches(spark, sf_dir):
    """Batches without a reply, in one message per brand."""
    rows = table(spark, sf_dir, "part").select("p_brand", F.floor(F.col("p_partkey") / 15).alias("batch_no"))
    return M.failed_batches(rows, rows.filter("batch_no % 5 <> 0"), "p_brand")


@query("SELECT doc_id, (length(text) - length(replace(text, 'tion', ''))) // 4 AS replaced, CAST(0 AS BIGINT) AS \"left\" FROM documents WHERE contains(text, 'tion')")
def migration_counts(spark, sf_dir):
    """Old forms per document before and after a migration."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = docs.withColumn("text", M.migrated(F.col("text"), {"tion": "TION"}))
    return M.migration_report(docs, done, "doc_id", "text", ["tion"])


@query("SELECT count(*) FILTER (p_size < 20) AS wanted, count(*) FILTER (p_size < 20 AND p_partkey % 3 = 0) AS finished, round(count(*) FILTER (p_size < 20 AND p_partkey % 3 = 0) / count(*) FILTER (p_size < 20), 4) AS ratio FROM part")
def completion_ratio(spark, sf_dir):
    """The share of small parts that are done."""
    from tessera.operators.quiz import completion

    rows = table(spark, sf_dir, "part").select((F.col("p_size") < 20).alias("case"), (F.col("p_partkey") % 3 == 0).alias("done"))
    return completion(rows, "case", "done")


@query()
def mining_rounds(spark, sf_dir):
    """The dictionary after two rounds in which a rule adopts what begins alike."""
    judge = lambda found: found.select("a", "b", F.when(F.substring("a", 1, 1) == F.substring("b", 1, 1), "adopt").otherwise("reject").alias("decision"), F.col("a").alias("canonical"), F.col("b").alias("variant"), F.lit("mined").alias("category"))
    rows = stored(stats(spark, sf_dir).filter("n >= 20"))
    return M.mined(rows, dictionary(spark).drop("note"), judge, SOUNDS, ((100, 200, 20), (50, 100, 20)), 1000).select("canonical", "variants", "source")


@query(
    """SELECT p_partkey, CASE WHEN fine THEN 'unify' ELSE 'doubtful' END AS verdict, CASE WHEN fine THEN p_brand END AS canonical FROM (SELECT p_partkey, p_brand, p_partkey % 3 <> 0 AND (p_partkey % 5 <> 0 OR p_type = p_brand) AS fine FROM part)"""
)
def agreed_forms(spark, sf_dir):
    """Replies on two forms: unified only where the reply names just these two."""
    p = table(spark, sf_dir, "part")
    rows = p.select(
        "p_partkey", F.col("p_brand").alias("form_a"), F.col("p_type").alias("form_b"), F.when(F.col("p_partkey") % 3 != 0, "unify").otherwise("doubtful").alias("decision"),
        F.col("p_brand").alias("canonical"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).otherwise(F.col("p_brand")).alias("variant"),
    )
    return M.agreed(rows).select("p_partkey", "verdict", "canonical")


@query(r"""SELECT CAST(sum(length(text) - length(replace(text, 'the', 'th'))) AS BIGINT) AS the_, CAST(sum(length(text) - length(replace(text, 'und', 'un'))) AS BIGINT) AS und_ FROM documents""")
def counter_totals(spark, sf_dir):
    """Sums over all documents of the counters of two forms."""
    count = lambda w: X.occurrences(F.coalesce(F.col("text"), F.lit("")), w)
    counts = table(spark, sf_dir, "documents").select("doc_id", count("the").alias("the_"), count("und").alias("und_"))
    return M.totals(counts, ["the_", "und_"])


@query("""SELECT 'orders of no customer' AS "check", count(DISTINCT o_custkey) AS violations, count(*) = 0 AS passed FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'customers without an order', count(*), count(*) = 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'kinds that never occur', count(*), count(*) = 0 FROM (VALUES ('click'), ('view'), ('refund')) v(k) WHERE k NOT IN (SELECT event_type FROM events)
    UNION ALL SELECT 'kinds outside the list', count(DISTINCT event_type), count(*) = 0 FROM events WHERE event_type NOT IN ('click', 'view', 'refund')
    UNION ALL SELECT 'documents with blank columns', count(*), count(*) = 0 FROM documents WHERE coalesce(text, '') = '' OR coalesce(lang, '') = '' OR coalesce(source, '') = ''
    UNION ALL SELECT 'documents with forbidden words', count(*), count(*) = 0 FROM documents WHERE contains(text, 'thth')""")
def acceptance_gate(spark, sf_dir):
    """Checks run together: what each found, and whether it passed."""
    orders, customers = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), table(spark, sf_dir, "customer")
    events, docs, kinds = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents"), ["click", "view", "refund"]
    return checks.gate({
        "orders of no customer": checks.uncovered(orders, customers, "c_custkey"),
        "customers without an order": checks.uncovered(customers, orders, "c_custkey"),
        "kinds that never occur": checks.missing_values(kinds, events, "event_type"),
        "kinds outside the list": checks.outside(events, "event_type", kinds),
        "documents with blank columns": checks.blank_columns(docs, ["text", "lang", "source"]),
        "documents with forbidden words": checks.residue(docs, "doc_id", "text", ["thth"]),
    })


@query(
    f"""WITH {STATS_SQL}, {TERMS_SQL}, {CANDIDATES_SQL}, q AS (SELECT a, b, (row_number() OVER (ORDER BY score DESC, a, b) - 1) AS i FROM clustered)
    SELECT i // 15 AS batch_no, 'Are these the same word?' || chr(10) || string_agg(CAST(i % 15 + 1 AS VARCHAR) || '. ' || a || ' / ' || b, chr(10) ORDER BY i) AS payload FROM q GROUP BY i // 15"""
)
def request_prompts(spark, sf_dir):
    """The clustered candidates as requests to a judge: fifteen numbered pairs each."""
    pairs = batches(clustered_terms(spark, sf_dir), [], [F.desc("score"), F.col("a"), F.col("b")], 15)
    return numbered_prompt(pairs, ["batch_no"], "item_no", F.concat("a", F.lit(" / "), "b"), "Are these the same word?")


@query("""SELECT unnest(['german', 'long', 'none']) AS condition, unnest([count(*) FILTER (lang = 'de'), count(*) FILTER (n_chars > 5000), count(*) FILTER (lang = 'xx')]) AS rows,
    unnest([count(*) FILTER (lang = 'de') > 0, count(*) FILTER (n_chars > 5000) > 0, count(*) FILTER (lang = 'xx') > 0]) AS present FROM documents""")
def conditions_present(spark, sf_dir):
    """Which kinds of documents are there at all."""
    docs = table(spark, sf_dir, "documents")
    return checks.present(docs, {"german": F.col("lang") == "de", "long": F.col("n_chars") > 5000, "none": F.col("lang") == "xx"})


@query("SELECT s_suppkey AS id, CAST(row_number() OVER (ORDER BY s_nationkey % 2 = 1 DESC, s_suppkey) AS INTEGER) AS place FROM supplier ORDER BY 2 LIMIT 20")
def work_order(spark, sf_dir):
    """The first twenty suppliers in the order of work: the marked ones first."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 2 == 1).alias("marked"))
    return FR.by_priority(rows, "marked", "id", 20).select("id", "place")
