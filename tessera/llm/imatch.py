"""I-Match fingerprints by document frequency, in DataFrame functions alone.

Terms are runs of letters and digits (only ASCII punctuation, white space and controls part
them), in lower case. Over all distinct texts the terms' document frequency is counted, so copies
push no term out of the band; the lexicon keeps those in an inverse-document-frequency band,
log(1/HIGH) to log(1/LOW), that two texts have at least. A text's distinct terms of the lexicon are
sorted, and for each of 64 randomised subsets of the lexicon the sorted terms that fall into it are
hashed. Subsets keep 1/16, 1/64, 1/256 or 1/1024 of the lexicon, so that texts of any length have
subsets that hold few of their terms: one term that differs then leaves most hashes alone. The
likeness of two fingerprints is the share of equal hashes among the subsets that at least one of the
texts has a term in. A text without a term of the lexicon has 64 hashes of all its own distinct
terms, so it is like those alone that have the same ones.

A lexicon term is in at least LOW of the distinct texts, so the lexicon has at most (mean number of
distinct terms) / LOW terms, whatever the number of documents; it is broadcast up to
``BROADCAST_ROWS`` terms, and joined beyond.

The next document (ascending id, then text) is found within cells of ``CELL`` neighbouring ids, cut
at their quantiles: each cell also gets the first document of the next cell, so no task sees more
than a cell (and the rows of one id, which stay together).

Results for special inputs: a null text counts as empty; texts without any term are alike 1; null ids
come first; ids of any type that can be ordered will do; rows that repeat an id and text follow each
other; a single document is its own next one; an empty table gives no rows. Other columns of the
input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import Written

LOW, HIGH = 0.002, 0.02
#: (first bit, bits) of a term's 64-bit hash that tell its subset; 16 subsets of each are used.
LEVELS = [(0, 4), (4, 6), (10, 8), (18, 10)]
SUBSETS = 16
#: Ids of a cell.
CELL = 4096
BROADCAST_ROWS = 1_000_000
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    """Distinct terms of a text column; the empty string, if there, is no term."""
    return F.array_distinct(F.split(F.lower(text), SPLIT))


def lexicon(docs: DataFrame, text_col: str, written: Written, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Hashes (t) of the terms whose share of the distinct texts is from low to high."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    copies = written.save(docs.groupBy(F.xxhash64(text).alias("k")).agg(F.count("*").alias("copies")), "imatch-copies")
    n = copies.count()
    several = copies.filter("copies > 1")
    if several.count() <= BROADCAST_ROWS:
        several = F.broadcast(several)
    # each of c copies counts for 1 / c
    each = docs.select(text.alias("text"), F.xxhash64(text).alias("k")).join(several, "k", "left").select("text", F.lit(1.0) / F.coalesce("copies", F.lit(1)))
    each = each.toDF("text", "weight").select("weight", F.explode(terms(F.col("text"))).alias("term")).filter("term <> ''")
    counted = each.select(F.xxhash64("term").alias("t"), "weight").groupBy("t").agg(F.round(F.sum("weight"), 3).alias("df"))
    return written.save(counted.filter((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= max(2.0, high * n))).select("t"), "imatch-lexicon")


def hashes(numbers, own):
    """The 64 subsets' hashes of a sorted array of distinct terms' hashes, null where a subset has none; of own where all are empty."""

    def level(first: int, bits: int):
        # classes 0 to 15, by their two upper bits and then their two lower ones; each list is bound, so it is filtered once
        def of_bits(values, mask: int, step: int):
            cases = F.array(*[F.lit(c * step).cast("long") for c in range(4)])
            return F.transform(cases, lambda c: F.filter(values, lambda x: x.bitwiseAND(mask) == c))

        other = ((1 << bits) - SUBSETS) << first
        used = numbers if not other else F.filter(numbers, lambda x: x.bitwiseAND(other) == 0)
        quarters = of_bits(used, 12 << first, 4 << first)
        held = F.flatten(F.transform(quarters, lambda part: of_bits(part, 3 << first, 1 << first)))
        return F.transform(held, lambda x: F.when(F.size(x) > 0, F.xxhash64(x).bitwiseAND((1 << 31) - 1).cast("int")))

    instead = F.transform(F.sequence(F.lit(0), F.lit(len(LEVELS) * SUBSETS - 1)), lambda c: F.xxhash64(own, c).bitwiseAND((1 << 31) - 1).cast("int"))
    return F.when(F.size(numbers) == 0, instead).otherwise(F.concat(*[level(first, bits) for first, bits in LEVELS]))


def as_text(found):
    """A fingerprint as a string: its hashes in hexadecimal, empty where there is none."""
    return F.array_join(F.transform(found, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit(""))), ".")


def likeness(a, b):
    """Share of equal hashes among those that either fingerprint has."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(F.coalesce(x == y, F.lit(False))))
    either = F.size(F.filter(both, lambda e: e.isNotNull()))
    equal = F.size(F.filter(both, lambda e: e))
    return F.try_divide(equal, either)


def cells(rows: DataFrame, written: Written) -> tuple[DataFrame, int]:
    """The least id of each cell, as one row of lists of so many ids; each range of ids begins a cell."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("id").filter("id is not null").repartitionByRange(parts, "id").select("id", F.spark_partition_id().alias("range"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("id"))
    bounds = written.save(ids.withColumn("place", place).filter((F.col("place") - 1) % CELL == 0).select("id").distinct(), "imatch-bounds")
    width = max(1, round(bounds.count() ** 0.5))
    all_ids = bounds.agg(F.array_sort(F.collect_list("id")).alias("all"))  # an id for CELL documents
    lists = F.transform(F.sequence(F.lit(0), F.ceil(F.size("all") / width).cast("int")), lambda k: F.slice("all", k * width + 1, width))
    return all_ids.select(F.filter(lists, lambda x: F.size(x) > 0).alias("lists"), F.lit(1).alias("one")), width


def with_next(docs: DataFrame, id_col: str, text_col: str, written: Written) -> DataFrame:
    """(rid, next_rid, id, text, next_text): each row with the text of the next one."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds, width = cells(rows, written)
    whole = F.size(F.filter("lists", lambda x: x[0] <= F.col("id")))  # lists that begin at or before the id
    last = F.size(F.filter(F.get("lists", F.col("whole") - 1), lambda x: x <= F.col("id")))
    cell = F.when(F.col("id").isNull(), -1).when(F.col("whole") == 0, 0).otherwise((F.col("whole") - 1) * width + last)
    rows = rows.withColumn("one", F.lit(1)).join(F.broadcast(bounds), "one").withColumn("whole", whole).select("id", "text", cell.cast("long").alias("cell"))
    order = Window.orderBy("cell")  # a row for each cell
    heads = rows.groupBy("cell").agg(F.min("id").alias("head"))
    heads = heads.withColumn("before", F.lag("cell").over(order)).withColumn("wrap", F.when(F.col("before").isNull(), 1).otherwise(0))
    end = F.max("cell").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("cell").alias("h_cell"), "head", F.coalesce("before", end).alias("before"), "wrap")
    heads = F.broadcast(written.save(heads, "imatch-heads"))
    # a cell's first documents also go to the cell before it (of the first cell: to the last)
    joined = rows.join(heads, (F.col("cell") == F.col("h_cell")) & F.col("id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("cell").alias("at"), F.lit(0).alias("wrap"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("at"), F.col("wrap").alias("wrap"), F.lit(True).alias("guest"))
    placed = joined.select("id", "text", "cell", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("p"))
    placed = placed.select("id", "text", "cell", "p.at", "p.wrap", "p.guest")
    by = Window.partitionBy("at").orderBy("wrap", "guest", F.asc_nulls_first("id"), "text")
    number = F.when(F.col("guest"), F.lit(1)).otherwise(F.row_number().over(by)).cast("long")
    placed = placed.withColumn("rid", F.shiftleft(F.col("cell"), 32) + number)
    out = placed.withColumn("next_rid", F.lead("rid").over(by)).withColumn("next_text", F.lead("text").over(by))
    return out.filter(~F.col("guest")).select("rid", "next_rid", "id", "text", "next_text")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", written: Written | None = None, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of each text and of its edited text.

    Returns id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The edited text has its last half replaced by as much of the beginning of the next text.
    """
    written = written or Written(docs.sparkSession)
    known = lexicon(docs, text_col, written, low, high)
    known = known.withColumn("number", F.col("t"))
    # the empty term keeps texts without terms in the join
    marker = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("t"), F.lit(None).cast("long").alias("number"))
    small = known.count() <= BROADCAST_ROWS
    known = known.unionAll(marker)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs, id_col, text_col, written)
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)))
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))
    rows = rows.select("rid", "next_rid", "id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), F.explode(both).alias("b"))
    # split once a text; what stands for the whole text goes with the empty term's row alone, so rows of terms stay short
    rows = rows.select("rid", "next_rid", "id", "n_chars", "sha", "b.which", F.array_remove(terms(F.col("b.t")), "").alias("terms"))
    rows = rows.select("rid", "which", "terms", F.struct("next_rid", "id", "n_chars", "sha", F.xxhash64(F.sort_array("terms")).alias("own")).alias("info"))
    exploded = rows.select("rid", "which", "info", F.explode(F.array_append("terms", F.lit(""))).alias("term"))
    of_text = F.when(F.col("term") == "", F.col("info"))
    keyed = exploded.select("rid", "which", of_text.alias("info"), F.when(F.col("term") == "", F.lit(0)).otherwise(F.xxhash64("term")).alias("t"))
    held = keyed.join(F.broadcast(known) if small else known, "t")
    first = lambda which, value: F.first(F.when(F.col("which") == which, value), ignorenulls=True)
    sets = held.groupBy("rid").agg(
        first(0, F.col("info")).alias("info"), first(1, F.col("info.own")).alias("own_b"),
        F.collect_set(F.when(F.col("which") == 0, F.col("number"))).alias("a"), F.collect_set(F.when(F.col("which") == 1, F.col("number"))).alias("b"),
    )
    sets = sets.select("rid", "info.next_rid", "info.id", "info.n_chars", "info.sha", F.col("info.own").alias("own_a"), "own_b", "a", "b")
    sets = sets.withColumns({c: F.sort_array(c) for c in ("a", "b")})  # once, not for each subset
    prints = written.save(sets.select("rid", "next_rid", "id", "n_chars", "sha", hashes(F.col("a"), F.col("own_a")).alias("a"), hashes(F.col("b"), F.col("own_b")).alias("b")), "imatch-prints")
    following = prints.select(F.col("rid").alias("n_rid"), F.col("a").alias("c"))
    out = prints.join(following, F.col("next_rid") == F.col("n_rid"))
    return out.select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"),
    )


def op4_imatch(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint(spark.read.parquet(f"{sf_dir}/documents.parquet"))
