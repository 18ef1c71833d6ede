"""Quality rules with thresholds learned per language and source from mergeable sketches.

A document's measures are counted from its whole text. For each language, source and ratio a
logarithmic quantile sketch counts the documents in buckets whose bounds grow by a fixed
factor, so that any quantile is known within ``ERROR`` of its value; two sketches merge by
adding counts, which makes them independent of order and partitioning. Documents that fail the
base rules are in no sketch.

A ratio is an outlier beyond median + times * (upper quantile - median), and for some ratios also
below median - times * (median - lower quantile). Median and quantiles all come from the
sketches, so place and width of a fence both follow the group; only the level of the quantile
and the multiple are set for each ratio (``RATIOS``). Quantiles are shrunk: those of a source
with n documents are (n * own + ``WEIGHT`` * the language's) / (n + ``WEIGHT``), and the language's
likewise with those of all documents, so a group's own share grows with its size without a
step. One unit (a symbol, a line) beyond a fence is not held against a text.

Results for special inputs: a null or empty text has measures 0 and fails the base rules;
null language or source is a group of its own; repeated rows are judged alike (and each
counts); an empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import scan
from tessera.llm.shared import Written, bounded

#: Relative error of quantiles.
ERROR = 0.01
#: Documents that a merged sketch counts for beside a group's own.
WEIGHT = 100
#: ratio: (numerator, denominator, level of the upper quantile, times, low side counts too)
RATIOS = {
    "word_length": ("word_chars", "n_words", 0.75, 8, True),
    "symbols": ("n_symbols", "n_words", 0.9, 2, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.99, 2, False),
    "repeats": ("n_repeat_words", "n_words", 0.99, 2, False),
    "capitals": ("n_capitals", "word_chars", 0.95, 4, False),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]
WINDOW = 8
#: Rows of thresholds up to which they are broadcast; beyond, they are joined.
BROADCAST_ROWS = 100_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _distinct(row: np.ndarray, value: np.ndarray):
    """Order by (row, value), and where a value of a row begins in it."""
    order = np.lexsort((value, row))
    new = np.ones(len(order), bool)
    r, v = row[order], value[order]
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return order, new


def measures(w: scan.Words) -> list[np.ndarray]:
    """MEASURES of each text of a slice."""
    data, at, n = w.data, w.text, w.n
    n_words = np.diff(w.first)
    point = (data & 0xC0) != 0x80
    word_chars = np.diff(_sums(point & ~scan._WHITE[data])[at])
    symbols, capitals = np.diff(_sums(_SYMBOL[data])[at]), np.diff(_sums(_CAPITAL[data])[at])
    # lines: those with a word, and those of them that are equal to an earlier one
    row = w.row_of
    begins = np.zeros(len(data) + 1, bool)
    begins[1:] = data == 0x0A
    begins[at] = True
    line_start = np.flatnonzero(begins[:-1]) if len(data) else np.zeros(0, np.int64)
    of_word = np.searchsorted(line_start, w.start, "right") - 1
    used = np.unique(of_word)
    start = line_start[used]
    end = np.append(line_start[1:], len(data))[used] if len(line_start) else start
    end = end - ((end > start) & (data[np.maximum(end - 1, 0)] == 0x0A))
    h = scan.hashes(data, start, end)
    line_row = np.searchsorted(at, start, "right") - 1
    lines = np.bincount(line_row, minlength=n)
    _, new = _distinct(line_row, h)
    different = np.bincount(np.sort(line_row)[new], minlength=n)
    # words of windows that occur again in the text
    g, first = scan.shingles(w, WINDOW, whole_if_short=False)
    count = np.diff(first)
    g_row = np.repeat(np.arange(n), count)
    order, new = _distinct(g_row, g)
    run = np.cumsum(new) - 1
    again = np.zeros(len(g), bool)
    again[order] = np.bincount(run)[run] > 1 if len(g) else False
    covers = np.zeros(len(w.hash) + 1, np.int64)
    word = np.arange(len(g)) - np.repeat(first[:-1] - w.first[:-1], count)
    np.add.at(covers, word[again], 1)
    np.add.at(covers, word[again] + WINDOW, -1)
    repeats = np.bincount(row[np.cumsum(covers)[:-1] > 0], minlength=n) if len(row) else np.zeros(n, np.int64)
    return [x.astype(np.int64) for x in (n_words, word_chars, symbols, lines - different, repeats, lines, capitals)]


def measured(docs: DataFrame, keys: list, text_col: str = "text") -> DataFrame:
    """keys (columns) and MEASURES of each row."""
    picked = bounded(docs).select(*keys, F.col(text_col).alias("__text"))
    names = picked.columns[:-1]

    def run(batches):
        for batch in batches:
            for w in scan.words(batch.column(len(names))):
                kept = [batch.column(i).slice(w.row, w.n) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, measures(w))], names=[*names, *MEASURES])

    schema = picked.select(*names).schema
    for m in MEASURES:
        schema = schema.add(m, "long")
    return picked.mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def sketches(stats: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, ratio, bucket, docs): mergeable sketches of the rows that pass the base rules."""
    gamma = (1 + ERROR) / (1 - ERROR)
    ratio = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), F.try_divide(F.col(a), F.col(b)).alias("value")) for k, (a, b, *_) in RATIOS.items()]))
    rows = stats.filter(~base_failed()).select(*groups, ratio.alias("r")).select(*groups, "r.ratio", "r.value")
    bucket = F.when(F.col("value") > 0, F.ceil(F.log("value") / math.log(gamma))).otherwise(F.lit(None)).cast("long")
    return rows.groupBy(*groups, "ratio", bucket.alias("bucket")).agg(F.count("*").alias("docs"))


def quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, ratio, docs, low, mid, high) of sketches grouped by the given columns."""
    gamma = (1 + ERROR) / (1 - ERROR)
    merged = sketch.groupBy(*groups, "ratio", "bucket").agg(F.sum("docs").alias("docs"))
    by = Window.partitionBy(*groups, "ratio")
    rows = merged.withColumn("upto", F.sum("docs").over(by.orderBy(F.asc_nulls_first("bucket")))).withColumn("total", F.sum("docs").over(by))
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.pow(F.lit(gamma), F.col("bucket")) / (gamma + 1))
    per_mille = reduce(lambda c, k: c.when(F.col("ratio") == k, round(1000 * RATIOS[k][2])), RATIOS, F).cast("long")
    reached = lambda level: F.min(F.when(1000 * F.col("upto") >= level * F.col("total"), value))
    out = rows.withColumn("level", per_mille).groupBy(*groups, "ratio")
    return out.agg(F.max("total").alias("docs"), reached(1000 - F.col("level")).alias("low"), reached(F.lit(500)).alias("mid"), reached(F.col("level")).alias("high"))


def shrunk(own: DataFrame, wider: DataFrame, groups: list[str]) -> DataFrame:
    """The quantiles of own, drawn towards those of the wider groups (by the given columns) it lies in."""
    names = [*groups, "ratio", "low", "mid", "high"]
    wider = wider.select(*[F.col(c).alias(f"w_{c}") for c in names])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in [*groups, "ratio"]])
    drawn = [((F.col("docs") * F.col(c) + WEIGHT * F.col(f"w_{c}")) / (F.col("docs") + WEIGHT)).alias(c) for c in ("low", "mid", "high")]
    few = wider if groups else F.broadcast(wider)  # without groups: a row for each ratio
    return own.join(few, same).select(*[c for c in own.columns if c not in ("low", "mid", "high")], *drawn)


def fences(sketch: DataFrame) -> DataFrame:
    """(q_lang, q_source, ratio, docs, floor, ceiling) from the sketches of languages and sources."""
    every, lang, own = (quantiles(sketch, g) for g in ([], ["q_lang"], ["q_lang", "q_source"]))
    drawn = shrunk(own, shrunk(lang, every, []), ["q_lang"])
    times = reduce(lambda c, k: c.when(F.col("ratio") == k, float(RATIOS[k][3])), RATIOS, F)
    sided = F.col("ratio").isin([k for k, v in RATIOS.items() if v[4]])
    floor, ceiling = (F.col("mid") + times * (F.col(c) - F.col("mid")) for c in ("low", "high"))
    return drawn.select("q_lang", "q_source", "ratio", "docs", F.when(sided, floor).alias("floor"), ceiling.alias("ceiling"))


def thresholds(stats: DataFrame, written: Written) -> DataFrame:
    """One row for each (q_lang, q_source) of stats, with floor_ and ceiling_ of each ratio."""
    sketch = written.save(sketches(stats, ["q_lang", "q_source"]), "quality-sketch")
    one = [F.max(F.when(F.col("ratio") == k, F.col(c))).alias(f"{c}_{k}") for k in RATIOS for c in ("floor", "ceiling")]
    out = written.save(fences(sketch).groupBy("q_lang", "q_source").agg(*one), "quality-fences")
    written.drop(sketch)
    return out


def judged(stats: DataFrame, fence: DataFrame) -> DataFrame:
    """stats with base_failed and kept."""
    fence = fence.select(F.col("q_lang").alias("f_lang"), F.col("q_source").alias("f_source"), *[c for c in fence.columns if c not in ("q_lang", "q_source")])
    if fence.count() <= BROADCAST_ROWS:
        fence = F.broadcast(fence)
    same = F.col("q_lang").eqNullSafe(F.col("f_lang")) & F.col("q_source").eqNullSafe(F.col("f_source"))
    fine = F.lit(True)
    for k, (a, b, _, _, low) in RATIOS.items():
        fine &= F.coalesce(F.col(a) <= F.col(f"ceiling_{k}") * F.col(b) + 1, F.lit(True))
        if low:
            fine &= F.coalesce(F.col(a) >= F.col(f"floor_{k}") * F.col(b) - 1, F.lit(True))
    return stats.join(fence, same, "left").withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & fine)


def _grouped(lang_col, source_col):
    return [F.col(lang_col).cast("string").alias("q_lang"), F.col(source_col).cast("string").alias("q_source")]


def assess(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", written: Written | None = None) -> DataFrame:
    """id_col, the measures, base_failed and kept for each row of docs."""
    written = written or Written(docs.sparkSession)
    stats = written.save(measured(docs, [F.col(id_col).alias("q_id"), *_grouped(lang_col, source_col)], text_col), "quality-stats")
    out = judged(stats, thresholds(stats, written))
    return out.select(F.col("q_id").alias(id_col), *MEASURES[:5], "base_failed", "kept", *MEASURES[5:])


def keep_good(docs: DataFrame, text_col="text", lang_col="lang", source_col="source", written: Written | None = None) -> DataFrame:
    """The rows of docs, as they are, that the rules keep."""
    written = written or Written(docs.sparkSession)
    # the rows are written beside their measures, so that texts are measured once
    stats = written.save(measured(docs, [F.struct("*").alias("q_row"), *_grouped(lang_col, source_col)], text_col), "quality-rows")
    return judged(stats, thresholds(stats, written)).filter("kept").select("q_row.*")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Every document measured and judged."""
    return assess(spark.read.parquet(f"{sf_dir}/documents.parquet"))
