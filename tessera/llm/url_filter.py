"""URL filtering by given rules, and by association rules mined from labels.

Given rules name a host and a path prefix and allow or block; the longest that fits wins.
Where none fits, mined rules decide: Spark's FP-growth finds combinations of URL tokens that
go with one label often (support) and nearly always (confidence). A mined rule is indexed
under its rarest token; a URL finds the rules of each of its tokens there and keeps those
whose other tokens it has too. The most confident one decides (then the one of more
support, then allow); no rule allows. A rule whose tokens hold those of another with the same
label and no less confidence never decides anything, and is dropped.

Tokens of a URL: each label of its host, its path segments with their depth (numbers by
their first digit and length), and its query's keys, each thing in one form.

A page's label for mining is the row of the labels with its id (labels.doc_id is the number of
the page's document, as page_id is): block if that is toxic or of low quality, else allow. Other
pages are not learned from, and verdicts of given rules are no labels.

Results for special inputs: a null URL, or one without "://", has an empty host and path, no
tokens and is allowed; repeated rows are judged alike; without labels nothing is mined. Other
columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import Written

#: (rule, verdict): host, then path prefix.
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
SUPPORT = 0.002
CONFIDENCE = 0.8
#: Rules up to which they are broadcast; beyond, they are joined.
BROADCAST_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url):
    """Columns (host, path) of a URL column."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def suffixes(host):
    """All suffixes of a host at label borders: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    )


def given_rules(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(url, rule, verdict): the longest rule that fits each distinct (url, host, path)."""
    spark = urls.sparkSession
    rows = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for r, v in rules]
    table = spark.createDataFrame(rows, "r_host string, r_path string, rule string, verdict string")
    if len(rows) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    fits = urls.select("url", "path", F.explode(suffixes(F.col("host"))).alias("r_host")).join(table, "r_host").filter(F.startswith("path", F.col("r_path")))
    top = F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("verdict"))).alias("top")
    return fits.groupBy("url").agg(top).select("url", "top.rule", "top.verdict")


def tokens(host, path, url):
    """Distinct tokens of a URL."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    shape = lambda s: F.when(s.rlike(r"^\d+(\.\w+)?$"), F.concat(F.substring(s, 1, 1), F.lit("#"), F.length(s).cast("string"))).otherwise(F.lower(s))
    by_depth = F.transform(segments, lambda s, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), shape(s)))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "&")
    keys = F.transform(F.filter(query, lambda q: q != ""), lambda q: F.concat(F.lit("q:"), F.substring_index(q, "=", 1)))
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("l:"), x))
    return F.array_distinct(F.concat(labels, by_depth, keys))


def mine(labelled: DataFrame, support: float, confidence: float, written: Written) -> DataFrame:
    """labelled (tokens, label) -> rules (id, tokens, anchor, verdict, confidence, support)."""
    items = labelled.filter(F.size("tokens") > 0).select(F.array_append("tokens", F.concat(F.lit("="), F.col("label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    verdict = F.element_at("consequent", 1)
    found = model.associationRules.filter((F.size("consequent") == 1) & F.startswith(verdict, F.lit("=")))
    found = found.filter(~F.exists("antecedent", lambda t: F.startswith(t, F.lit("="))))
    found = found.select(F.array_sort("antecedent").alias("tokens"), F.substring(verdict, 2, 10).alias("verdict"), "confidence", "support")
    found = written.save(found.filter(F.size("tokens") > 0), "url-rules")
    without = F.transform("tokens", lambda t: F.array_remove("tokens", t))
    shorter = found.select("tokens", "verdict", "confidence", F.explode(without).alias("fewer"))
    known = found.select(F.col("tokens").alias("fewer"), "verdict", F.col("confidence").alias("theirs"))
    idle = shorter.join(known, ["fewer", "verdict"]).filter("theirs >= confidence").select("tokens", "verdict").distinct()
    found = found.join(idle, ["tokens", "verdict"], "left_anti")
    # a rule is filed under its rarest token
    seen = items.select(F.explode("items").alias("token")).groupBy("token").count()
    each = found.select("*", F.explode("tokens").alias("token")).join(seen, "token")
    return written.save(each.groupBy("tokens", "verdict", "confidence", "support").agg(F.min(F.struct("count", "token")).alias("a")).select("tokens", F.col("a.token").alias("anchor"), "verdict", "confidence", "support"), "url-index")


def mined_verdicts(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, mined, mined_rule) of urls (url, tokens) that a rule of the index fits."""
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    index = index.select("anchor", F.col("tokens").alias("needs"), "verdict", "confidence", "support")
    # a URL is a short row with many rules to try: dealt out by number, not by size
    urls = urls.repartition(int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), "url")
    fits = urls.select("url", "tokens", F.explode("tokens").alias("anchor")).join(index, "anchor").filter(F.forall("needs", lambda t: F.array_contains(F.col("tokens"), t)))
    order = F.struct("confidence", "support", F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("a"), (-F.size("needs")).alias("n"), F.array_join("needs", " ").alias("rule"), "verdict")
    return fits.groupBy("url").agg(F.max(order).alias("top")).select("url", F.col("top.verdict").alias("mined"), F.col("top.rule").alias("mined_rule"))


def judge(
    pages: DataFrame,
    labels: DataFrame | None,
    rules: list[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    written: Written | None = None,
) -> DataFrame:
    """id_col, host, path, rule, verdict, mined_rule for each row of pages."""
    written = written or Written(pages.sparkSession)
    picked = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    urls = picked.select("url").filter("url is not null").distinct().select("url", host.alias("host"), path.alias("path"))
    urls = written.save(urls.select("*", tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens")), "urls")
    given = written.save(given_rules(urls, rules), "url-given")
    if labels is not None:
        bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
        marks = labels.groupBy(F.col(label_id).alias("page")).agg(F.max(F.when(bad, "block").otherwise("allow")).alias("label"))
        labelled = picked.join(marks, "page").join(urls.select("url", "tokens"), "url").select("tokens", "label")
    else:
        labelled = urls.select("tokens", F.lit(None).cast("string").alias("label")).limit(0)
    labelled = written.save(labelled, "url-labelled")
    if labelled.isEmpty():
        verdicts = given.withColumn("mined", F.lit(None).cast("string")).withColumn("mined_rule", F.lit(None).cast("string"))
    else:
        mined = mined_verdicts(urls.join(given, "url", "left_anti"), mine(labelled, support, confidence, written))
        verdicts = given.join(mined, "url", "full_outer")
    verdicts = written.save(verdicts, "url-verdicts")
    out = picked.join(verdicts, "url", "left")
    return out.select(F.col("page").alias(id_col), host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", "mined", F.lit("allow")).alias("verdict"), "mined_rule")


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's URL judged."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
