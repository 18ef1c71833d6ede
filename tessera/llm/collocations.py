"""Phrase collocations: frequent phrases of two to five words, scored by how much they exceed chance.

Counting takes a reading of the texts for each length of phrases, which only tell what the last one may leave out:

1. Words are counted by the hash of language and word. Those that occur ``least`` times or more are marked in a bitmap.
2. Pairs of marked neighbours are counted by hash, then runs of three words that consist of marked pairs, and so on; frequent ones are
   marked likewise. A bitmap has a fixed size (``BITS``), whatever the input; a hash that two things share can only let in
   more, as the last reading counts exactly.
3. Each task cuts its texts into shards of marked words, and sorts a shard's suffixes by numpy prefix doubling over word ids
   (ranks of 1, 2, 4, 8 words). Suffixes end where a run is not marked, so no frequent phrase is
   cut. Neighbours' common prefixes (LCP) part the suffix array into intervals; an interval of
   n common words is one n-gram with its count in the shard. Shards are merged by (language, phrase) text.

A phrase that is frequent has only frequent parts, so every count that a score needs is in the merged table. Scores
are exact integers (decimals of 38 digits). A language's best phrases are taken in each partition before they meet in one
window, so a language with most of the rows costs no more there than another.

Results for special inputs: null texts are empty; a null language is `und`; repeated rows count as often as they
stand; equal scores are ordered by count, then by the phrase's bytes; an empty table, or one without frequent phrases,
gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import scan
from tessera.llm.shared import Written, bounded, looked_up

MAX_WORDS = 5
LEAST = 100
TOP = 2000
#: Bits of a bitmap of frequent keys (8 MB).
BITS = 1 << 26
#: Runs of 1 to so many words are counted by hash before phrases are.
LEVELS = 5
#: Words of a shard, unless one text has more.
SHARD_WORDS = 1 << 18
#: Different phrases up to which a task adds up its shards' counts.
MERGED_ROWS = 400_000
#: Splits of the input that a task of the last reading takes.
TASK_SPLITS = 4
#: Phrases whose bytes are gathered at a time.
GATHERED_ROWS = 20_000
#: Language of rows without one.
UNKNOWN = "und"

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WHITE = _BREAK.copy()
_WHITE[[0x20, 0x09]] = True


def words_of(batches):
    """Slices of batches (lang, text): languages, and of each word its language's number, key (hash with the language),
    whether it goes on with the piece of the word before, bytes, start and end."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        names, code = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)
        at, data = scan.texts(names)
        salt = scan.mix(scan.hashes(data, at[:-1], at[1:]), 41)
        for w in scan.words(batch.column(1), lower=True, white=_WHITE):
            lang = code[w.row + w.row_of]
            breaks = np.zeros(len(w.data) + 1, np.int32 if len(w.data) < 1 << 31 else np.int64)
            np.cumsum(_BREAK[w.data], out=breaks[1:])
            on = np.zeros(len(w.start), bool)
            on[1:] = breaks[w.start[1:]] == breaks[w.end[:-1]]
            on[w.first[:-1][np.diff(w.first) > 0]] = False
            yield names, lang, scan.mix(w.hash * scan.ODD + salt[lang], 43), on, scan._LOWER[w.data], w.start, w.end


def keyed(keys: np.ndarray) -> tuple[pa.Array, pa.Array]:
    found, n = np.unique(keys, return_counts=True)
    return pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits that are set at the lower digits of the keys: at most BITS / 64 rows reach the driver."""
    place = F.col("key").bitwiseAND(F.lit(BITS - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    rows = keys.select(place.alias("place")).select(F.shiftright("place", 6).alias("block"), bit.alias("bit")).groupBy("block").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[rows.column("block").to_numpy()] = rows.column("bit").to_numpy()
    return out.view(np.uint64)


def marked(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key & np.uint64(BITS - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def runs(key: np.ndarray, on: np.ndarray, bits: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """What bitmaps of runs of 1, 2, ... words tell of a slice.

    For each of these lengths a mask of the places where a marked run begins; then the mask of the runs that are one word longer
    and consist of marked ones, and their keys.
    """
    valid, may, keys = [], np.ones(len(key), bool), key
    for n, own in enumerate(bits, 2):
        now = np.zeros(len(key), bool)
        now[: len(keys)] = may & marked(own, keys)
        valid.append(now)
        keys = scan.mix(keys[:-1] * scan.ODD + key[n - 1 :], 45 + n)
        may = (now[:-1] & now[1:] & on[1:])[: len(keys)]
    return valid, may, keys


def suffix_array(ids: np.ndarray, reach: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of at most `most` words in order, and the words that each has in common with the one before it.

    ids are the shard's words; the suffix at i has reach[i] words. Ranks of p words double to ranks of 2p words.
    """
    rank, p = ids, 1
    while p < most:
        wide = np.zeros(len(rank), np.int64)
        wide[: len(rank) - p] = rank[p:] + 1
        _, rank = np.unique(rank * (int(wide.max(initial=0)) + 1) + np.where(reach > p, wide, 0), return_inverse=True)
        p *= 2
    order = np.argsort(rank, kind="stable")
    common, alike = np.zeros(len(order), np.int64), np.ones(max(0, len(order) - 1), bool)
    a, b = order[:-1], order[1:]
    for k in range(most):
        alike &= (reach[a] > k) & (reach[b] > k)
        alike[alike] = ids[a[alike] + k] == ids[b[alike] + k]
        common[1:] += alike
    return order, common


def reaches(known: np.ndarray, levels: int, most: int) -> np.ndarray:
    """Words, `most` at most, that may be read on from each place: known tells it up to `levels`, where longer runs go on."""
    reach = known.copy()
    for _ in range(levels, most):
        reach[:-1] = np.where(known[:-1] == levels, np.minimum(reach[1:] + 1, most), known[:-1])
    return reach


def shard(names, lang, key, reach, data, start, end, most: int):
    """(lang, words, phrase, n) of one shard of marked words, of which reach may be read on from each."""
    size = len(key)
    _, ids = np.unique(key, return_inverse=True)
    _, first, n = np.unique(ids, return_index=True, return_counts=True)
    found = [(1, first, n)]
    order, common = suffix_array(ids, reach, most)
    for k in range(2, most + 1):
        begin = np.flatnonzero(common < k)
        count = np.diff(np.append(begin, size))
        long = reach[order[begin]] >= k
        found.append((k, order[begin[long]], count[long]))
    for k, i, n in found:
        for lo in range(0, len(i), GATHERED_ROWS):
            j = i[lo : lo + GATHERED_ROWS]
            columns = [names.take(pa.array(lang[j])), pa.array(np.full(len(j), k, np.int32)), scan.gathered(data, start[j], end[j + k - 1]), pa.array(n[lo : lo + GATHERED_ROWS].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])


class Merged:
    """Counts of a task's shards, added up until they are more than MERGED_ROWS different phrases."""

    def __init__(self):
        self.held, self.n, self.different = [], 0, 0

    def add(self, rows: pa.RecordBatch):
        self.held.append(pa.Table.from_batches([rows]))
        self.n += rows.num_rows
        # rows that were added up already are told from new ones, which are half of them at most
        if self.n > self.different + max(MERGED_ROWS // 4, self.different // 2):
            self.merge()
            if self.n > MERGED_ROWS:
                yield from self.rows()

    def merge(self) -> None:
        sums = pa.concat_tables(self.held).group_by(["lang", "words", "phrase"]).aggregate([("n", "sum")])
        self.held, self.n = [sums.rename_columns(["lang", "words", "phrase", "n"])], sums.num_rows
        self.different = self.n
        del sums
        pa.default_memory_pool().release_unused()

    def rows(self):
        if self.held:
            self.merge()
            out, self.held, self.n, self.different = self.held[0], [], 0, 0
            yield from out.to_batches(GATHERED_ROWS)


def counted(batches, bits: list[np.ndarray], most: int, shard_words: int):
    """(lang, words, phrase, n) of a task's texts, shard by shard, added up as far as Merged does."""
    names, parts, held, at = [], [], 0, 0
    merged = Merged()

    def done():
        lang, key, known, data, start, end = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        for rows in shard(pa.array(names, pa.string()), lang, key, reaches(known, len(bits), most), data, start, end, most):
            yield from merged.add(rows)

    for found, lang, key, on, data, start, end in words_of(batches):
        valid, _, _ = runs(key, on, bits)
        ok, known = valid[0], np.sum(valid, axis=0)
        numbers = {name: k for k, name in enumerate(names)}
        for name in found.to_pylist():
            if name not in numbers:
                numbers[name] = len(names)
                names.append(name)
        code = np.array([numbers[name] for name in found.to_pylist()], np.int32)
        s, e = start[ok], end[ok]
        n = e - s + 1  # each word and one space
        fresh = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=fresh[1:])
        inside = np.zeros(len(data) + 1, np.int8)
        inside[s] += 1
        inside[e] -= 1  # a text's first word may begin where the last one of the text before ends
        of_words = np.ones(fresh[-1], bool)
        of_words[fresh[1:] - 1] = False
        taken = np.full(fresh[-1], 0x20, np.uint8)
        taken[of_words] = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        parts.append((code[lang[ok]], key[ok], known[ok].astype(np.int8), taken, at + fresh[:-1], at + fresh[1:] - 1))
        at, held = at + int(fresh[-1]), held + len(s)
        if held >= shard_words:
            yield from done()
            held, at = 0, 0
    if held:
        yield from done()
    yield from merged.rows()


def in_wide_tasks(texts: DataFrame) -> DataFrame:
    """texts in tasks of TASK_SPLITS splits, but no fewer tasks than two for each core: each task tells the count of a
    frequent phrase once, so wide ones tell fewer rows."""
    splits = texts.rdd.getNumPartitions()
    return texts.coalesce(max(2 * texts.sparkSession.sparkContext.defaultParallelism, splits // TASK_SPLITS))


def phrase_counts(texts: DataFrame, bits: list[np.ndarray], most: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, words, phrase, f): all phrases of up to `most` words that consist of marked runs, merged over shards."""
    shared, bits = texts.sparkSession.sparkContext.broadcast(bits[:most]), None
    rows = in_wide_tasks(texts).mapInArrow(lambda batches: counted(batches, shared.value, most, shard_words), "lang string, words int, phrase string, n long")
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))


def frequent_phrases(docs: DataFrame, written: Written, least: int = LEAST, most: int = MAX_WORDS, lang_col: str = "lang", text_col: str = "text", shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of up to `most` words with f >= least, and (lang, n) of all languages' words."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = bounded(docs.select(lang, F.coalesce(F.col(text_col), F.lit("")).alias("text")))

    def count_words(batches):
        for names, lang, key, *_ in words_of(batches):
            keys, n = keyed(key)
            total = np.bincount(lang, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([keys, pa.nulls(len(names), pa.int64())]), pa.concat_arrays([pa.nulls(len(keys), pa.string()), names]), pa.concat_arrays([n, pa.array(total)])], names=["key", "lang", "n"])

    words = texts.mapInArrow(count_words, "key long, lang string, n long").groupBy("key", "lang").agg(F.sum("n").alias("n"))
    words = written.save(words.filter(F.col("key").isNull() | (F.col("n") >= least)), "words")
    bits = [bitmap(words.filter("key is not null"))]
    for _ in range(min(LEVELS, most) - 1):
        shared = texts.sparkSession.sparkContext.broadcast(bits)

        def count_runs(batches, shared=shared):
            for _, _, key, on, *_ in words_of(batches):
                _, may, keys = runs(key, on, shared.value)
                keys, n = keyed(keys[may])
                yield pa.RecordBatch.from_arrays([keys, n], names=["key", "n"])

        found = texts.mapInArrow(count_runs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        bits = [*bits, bitmap(found.filter(F.col("n") >= least))]
    found = phrase_counts(texts, bits, most, shard_words).filter(F.col("f") >= least)
    return written.save(found, "phrases"), words.filter("key is null").select("lang", "n")


def scored(phrases: DataFrame, totals: DataFrame, written: Written) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of phrases of two words or more: the cut with the least score, then the first."""
    whole = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).withColumn("first", first)
    cuts = written.save(cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)")), "cuts")
    for part, f in (("first", "l"), ("rest", "r")):
        wanted = cuts.groupBy("lang", part).agg(F.count("*").alias("rows"))
        table = wanted.join(phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(f)), ["lang", part])
        cuts = written.save(looked_up(cuts, written.save(table, "parts"), ["lang", part], "rows"), "cuts")
    exact = {c: F.col(c).cast("decimal(20,0)") for c in "alrn"}
    rows = cuts.join(totals, "lang").withColumns({f"_{c}": v for c, v in exact.items()})
    rows = rows.withColumn("score", F.expr("(1000 * _a * _n) div (_l * _r)"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return rows.groupBy("lang", "phrase", "words", "a", "n").agg(least).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def contained(phrases: DataFrame, share: int = 100) -> DataFrame:
    """(lang, phrase) of phrases inside a longer one that has at least share percent of their count."""
    inner = F.flatten(F.expr("transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(split(phrase, ' '), i, n), ' ')))"))
    longer = phrases.filter("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return phrases.join(longer, ["lang", "phrase"]).filter(100 * F.col("longer") >= share * F.col("f")).select("lang", "phrase")


def collocations(docs: DataFrame, written: Written | None = None, least: int = LEAST, top: int = TOP, most: int = MAX_WORDS, **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best `top` phrases."""
    written = written or Written(docs.sparkSession)
    phrases, totals = frequent_phrases(docs, written, least, most, **columns)
    rows = scored(phrases, totals, written).join(contained(phrases), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All phrases by lists of words, all cuts by a join.
ORACLE_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, s, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS s
    FROM w, (SELECT unnest(generate_series(1, 5)) AS k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, s, k, f AS a, string_split(s, ' ') AS ws FROM g WHERE k > 1),
cut AS (SELECT lang, s, k, a, j, array_to_string(ws[:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c)),
q AS (SELECT cut.lang, cut.s, a, x.f AS l, y.f AS r, n, j, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score FROM cut
    JOIN g x ON x.lang = cut.lang AND x.s = cut.x JOIN g y ON y.lang = cut.lang AND y.s = cut.y JOIN total ON total.lang = cut.lang),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, j) = 1),
inner_ AS (SELECT lang, a, unnest(flatten(list_transform(generate_series(2, k - 1), lambda m: list_transform(generate_series(1, k - m + 1), lambda i: array_to_string(list_slice(ws, i, i + m - 1), ' '))))) AS s FROM c WHERE k > 2),
longer AS (SELECT lang, s, max(a) AS longer FROM inner_ GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.s) AS rank, b.s AS phrase, a, l, r, n, score
    FROM b LEFT JOIN longer ON longer.lang = b.lang AND longer.s = b.s WHERE NOT coalesce(100 * longer >= 100 * a, false)) WHERE rank <= 2000
"""
