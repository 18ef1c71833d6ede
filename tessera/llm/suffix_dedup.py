"""Repeated passages by a sparse suffix array at content-selected minimiser positions.

A passage of ``MIN_WORDS`` words has one minimiser: of the runs of ``SEED`` words in it the one with the
least hash (the leftmost of equal ones). Equal passages have it in the same place, so only
suffixes that begin at minimisers are retained, about two in ``MIN_WORDS - SEED`` words. Each
carries its reach: how far the passages whose minimiser it is extend to its left and right.

1. The retained suffixes are sorted: by their first ``SEED`` words, then by all words in reach (words
   compare by 64-bit hashes of their runs). The sort goes by ranges that split a hot seed over many
   tasks. Each suffix is compared with its two neighbours. Without an equal seed beside it, it
   leaves. Neighbours that agree in all words in reach form a class, whose matches extend to the left
   and right as far as the reach goes; one of its members stands for it from here on.
2. Where classes with the same seed stand beside each other, their matches are extended word by word: from
   the farthest to the left (with the fewest words to the right) to the farthest to the right, each
   extension that makes a passage is compared with the same one of the other classes.
3. What was matched is joined to maximal spans. This gives exactly the union of all
   passages of ``MIN_WORDS`` words that occur twice, in any two places; passages that a document repeats
   itself are found in the document.

Of each repeated passage the first occurrence (least id, then position) is kept; spans of all
others can be cut.

Results for special inputs: null or empty texts and texts of fewer than ``MIN_WORDS`` words have
no spans; rows with a null id are left alone; rows that repeat an id and its words are one
place, of which nothing is cut for the other; rows that repeat an id with other words have spans
of their own, and what only they share is not repeated; an empty table has no spans. Other
columns of the input are not looked at, and kept as they are by cut().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.llm import scan
from tessera.llm.shared import Written, bounded, looked_up

MIN_WORDS = 50
SEED = 25
#: Estimated bytes of lists up to which they are broadcast to the texts they belong to; beyond, they are joined.
BROADCAST_BYTES = 64 << 20


def sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of each run of `size` values, in linear time."""
    n = len(values)
    if n < size:
        return values[:0]
    pad = -n % size
    edge = np.uint64(0xFFFFFFFFFFFFFFFF) if best is np.minimum else np.uint64(0)
    blocks = np.concatenate([values, np.full(pad, edge)]).reshape(-1, size)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - size + 1], ahead[size - 1 : n])


def repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur more than once, and which are not the first of these."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    again[order[1:]] |= same
    again[order[:-1]] |= same
    return again, later


def signatures(w: scan.Words) -> np.ndarray:
    """A number that stands for the words of each text."""
    place = np.arange(len(w.hash)) - w.first[:-1][w.row_of]
    sums = np.zeros(len(w.hash) + 1, np.uint64)
    np.cumsum(scan.mix(w.hash ^ scan.mix(place.astype(np.uint64), 17)), out=sums[1:])
    return scan.mix(sums[w.first[1:]] - sums[w.first[:-1]]).astype(np.uint32).view(np.int32)


def reach_hash(passage: np.ndarray, first: np.ndarray, last: np.ndarray, seed_at: np.ndarray) -> np.ndarray:
    """Hash of the words from passage `first` to passage `last`, with the minimiser's place in them."""
    shape = ((last - first) << 20 | (seed_at - first)).astype(np.uint64)
    return scan.mix(passage[first] * scan.ODD + scan.mix(passage[last] + scan.mix(shape, 19), 23), 29)


def suffixes(w: scan.Words, seed: int, min_words: int):
    """The retained suffixes of a slice: row, seed hash, reach hash, first and last passage in reach, again, later.

    again: the text repeats these passages itself; later: these are not their first places in it.
    """
    passage, h = scan.runs(w.hash, min_words), scan.runs(w.hash, seed)
    if not len(passage):
        return None
    order = np.argsort(h, kind="stable")
    rank = np.empty(len(h), np.uint64)
    rank[order] = np.arange(len(h), dtype=np.uint64)
    seed_at = order[sliding(rank, min_words - seed + 1, np.minimum).astype(np.int64)]
    row = w.row_of[: len(passage)]
    at = np.flatnonzero(np.arange(len(passage)) + min_words <= w.first[1:][row])
    if not len(at):
        return None
    again, later = repeats(scan.mix(passage[at] + scan.mix(row[at].astype(np.uint64), 3)))
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (seed_at[at][1:] != seed_at[at][:-1]) | (again[1:] != again[:-1]) | (later[1:] != later[:-1])
    begin = np.flatnonzero(new)
    first, last = at[begin], at[np.append(begin[1:], len(at)) - 1]
    own = seed_at[first]
    return row[first], h[own], reach_hash(passage, first, last, own), first, last, again[begin], later[begin]


def met(batches):
    """Sorted suffixes whose neighbour has the same seed; several: a neighbour with the same seed differs in reach.

    The first and last of a partition have neighbours elsewhere, so they stay, as if they had met.
    """
    held, left, other = None, True, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h, c, again = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 6))
        same = h[1:] == h[:-1]
        differ = same & (c[1:] != c[:-1])
        lefts, others = np.append(left, same), np.append(other, differ)
        stay = lefts[:-1] | same | again[:-1]
        out = pa.RecordBatch.from_arrays([*batch.slice(0, len(h) - 1).columns, pa.array(others[:-1] | differ)], names=[*batch.schema.names, "several"])
        yield out.filter(pa.array(stay))
        held, left, other = batch.slice(len(h) - 1), lefts[-1], others[-1]
    if held is not None:
        yield pa.RecordBatch.from_arrays([*held.columns, pa.array([True])], names=[*held.schema.names, "several"])


def with_lists(docs: DataFrame, lists: DataFrame, id_col: str, of: str, width: int) -> DataFrame:
    """docs joined by id with lists (of, items) of about width bytes an item."""
    size = lists.agg(F.sum(F.size("items")), F.count("*")).first()
    if (size[0] or 0) * width + size[1] * 64 <= BROADCAST_BYTES:
        lists = F.broadcast(lists)
    return docs.join(lists, F.col(id_col) == F.col(of))


def word_spans(docs: DataFrame, id_col: str, text_col: str, min_words: int, seed: int, written: Written) -> DataFrame:
    """Maximal repeated spans in words: doc, sig, first, last (beyond the span), is_first, of."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = bounded(docs).filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))

    def retained(batches):
        for batch in batches:
            for w in scan.words(batch.column(1)):
                if (found := suffixes(w, seed, min_words)) is None:
                    continue
                row, h, c, first, last, again, later = found
                doc = batch.column(0).slice(w.row, w.n).take(pa.array(row))
                small = [signatures(w)[row], (first - w.first[row]).astype(np.int32), (last - first).astype(np.int16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), doc, *map(pa.array, small), pa.array(again), pa.array(later)],
                    names=["h", "c", "doc", "sig", "at", "more", "again", "later"],
                )

    columns = f"h long, c long, doc {kind}, sig int, at int, more short, again boolean"
    all_suffixes = written.save(texts.mapInArrow(retained, f"{columns}, later boolean"), "suffixes")
    later = all_suffixes.filter("later").select("doc", "sig", F.col("at").alias("first"), (F.col("at") + F.col("more")).alias("last"), F.lit(False).alias("is_first"), F.col("doc").alias("of"))

    # 1. the sorted array; neighbours
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    array = all_suffixes.filter("not later").drop("later").repartitionByRange(parts, "h", "c", "doc").sortWithinPartitions("h", "c", "doc", "at")
    members = written.save(array.mapInArrow(met, f"{columns}, several boolean"), "suffixes-met")
    classes = members.groupBy("h", "c").agg(
        F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.max("again").alias("again"), F.max("several").alias("several"),
        F.count("*").alias("n"), F.min(F.struct("doc", "sig", "at", "more")).alias("one"),
    )
    classes = written.save(classes.filter("lo <> hi or again or several"), "suffix-classes")

    # 2. extensions of classes that share a seed, each read off the text of one member
    asked = classes.filter("several").select(F.col("one.doc").alias("of"), F.struct("one.sig", "one.at", "one.more", "h", "c", "lo", "hi", "again").alias("item"))
    asked = written.save(asked.groupBy("of").agg(F.collect_list("item").alias("items")), "suffixes-asked")

    def extended(batches):
        for batch in batches:
            lists = batch.column(1)
            for w in scan.words(batch.column(0)):
                mine = lists.slice(w.row, w.n)
                item = mine.flatten()
                owner = np.repeat(np.arange(w.n), np.diff(mine.offsets.to_numpy()))
                sig, at, more = (item.field(k).to_numpy() for k in (0, 1, 2))
                fits = (signatures(w)[owner] == sig) & (w.first[owner] + at + more + min_words <= w.first[1:][owner])
                pick = np.flatnonzero(fits)
                count = more[pick].astype(np.int64) + 1
                which = np.repeat(pick, count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                passage = scan.runs(w.hash, min_words)[w.first[owner[which]] + at[which] + step]
                kept = [item.field(k).take(pa.array(which)) for k in (3, 4, 5, 6, 7)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(passage.view(np.int64)), pa.array(step.astype(np.int16))], names=["h", "c", "lo", "hi", "again", "p", "i"])

    steps = with_lists(texts, asked, "doc", "of", 40).select("text", "items").mapInArrow(extended, f"h long, c long, lo {kind}, hi {kind}, again boolean, p long, i short")
    steps = written.save(steps, "suffix-steps")
    equal = steps.groupBy("h", "p").agg(F.min("lo").alias("p_lo"), F.max("hi").alias("p_hi"), F.max("again").alias("p_again"), F.count("*").alias("n")).filter("n > 1")
    equal = written.save(equal, "suffix-extensions")
    seen = looked_up(steps, equal, ["h", "p"], "n", "left").select(
        "h", "c", "i", F.coalesce("p_lo", "lo").alias("of"), (F.coalesce("p_lo", "lo") != F.coalesce("p_hi", "hi")).alias("two"), F.coalesce("p_again", "again").alias("own")
    )
    of_class = seen.groupBy("h", "c").agg(F.array_sort(F.collect_set(F.struct("i", "of", (F.col("two") | F.col("own")).alias("found")))).alias("s"))  # a reach has few steps
    changes = F.filter("s", lambda x, k: (k == 0) | ~(F.get("s", k - 1)["of"].eqNullSafe(x["of"]) & (F.get("s", k - 1)["found"] == x["found"])))
    of_class = of_class.select("h", "c", changes.alias("s")).select(
        "h", "c", F.transform("s", lambda x, k: F.struct(x["i"].cast("int").alias("i"), (F.get("s", k + 1)["i"].cast("int") - 1).alias("j"), x["of"].alias("of"), x["found"].alias("found"))).alias("runs")
    )
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(None).cast("int").alias("j"), F.col("lo").alias("of"), (F.col("again") | (F.col("lo") != F.col("hi"))).alias("found")))
    known = classes.join(of_class, ["h", "c"], "left").select("h", "c", "n", F.filter(F.coalesce("runs", whole), lambda r: r["found"]).alias("runs")).filter(F.size("runs") > 0)
    known = written.save(known, "suffix-runs")

    # 3. spans
    placed = looked_up(members, known, ["h", "c"], "n").select("doc", "sig", "at", "more", F.explode("runs").alias("r"))
    first = (F.col("at") + F.col("r.i")).alias("first")
    last = (F.col("at") + F.coalesce("r.j", F.col("more").cast("int"))).alias("last")
    placed = placed.select("doc", "sig", first, last, (F.col("doc") == F.col("r.of")).alias("is_first"), F.col("r.of").alias("of")).unionAll(later)
    by = Window.partitionBy("doc", "sig", "is_first").orderBy("first", "last")
    before = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = placed.withColumn("new", F.coalesce(F.col("first") - before > min_words, F.lit(True)).cast("int"))
    island = island.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    out = island.groupBy("doc", "sig", "is_first", "island").agg(F.min("first").alias("first"), (F.max("last") + min_words).alias("last"), F.min("of").alias("of"))
    return out.drop("island")


def places(w: scan.Words, lists: pa.ListArray):
    """(item, row, start, end) in characters of those items (sig, first, last, ...) that are in their text."""
    item, owner = lists.flatten(), np.repeat(np.arange(w.n), np.diff(lists.offsets.to_numpy()))
    sig, first, last = (item.field(k).to_numpy() for k in range(3))
    pick = np.flatnonzero((signatures(w)[owner] == sig) & (w.first[owner] + last <= w.first[1:][owner]))
    row = owner[pick]
    point = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum((w.data & 0xC0) != 0x80, out=point[1:])
    base = point[w.text[row]]
    return item.take(pa.array(pick)), row, point[w.start[w.first[row] + first[pick]]] - base, point[w.end[w.first[row] + last[pick] - 1]] - base


def spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    written: Written | None = None,
) -> DataFrame:
    """Maximal repeated spans: id_col, start, end (character offsets), words, is_first, first_doc_id.

    is_first: the span's passages occur here first; others can be cut. first_doc_id: least id of
    the documents that hold the first occurrences of the span's passages (for a passage that the
    document itself has before, that document).
    """
    written = written or Written(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    found = word_spans(docs, id_col, text_col, min_words, seed, written)
    lists = written.save(found.groupBy("doc").agg(F.collect_list(F.struct("sig", "first", "last", "is_first", "of")).alias("items")).withColumnRenamed("doc", "of"), "suffix-spans")

    def run(batches):
        for batch in batches:
            for w in scan.words(batch.column(1)):
                item, row, start, end = places(w, batch.column(2).slice(w.row, w.n))
                first, last = (item.field(k).to_numpy() for k in (1, 2))
                doc = batch.column(0).slice(w.row, w.n).take(pa.array(row))
                columns = [doc, pa.array(start), pa.array(end), pa.array((last - first).astype(np.int64)), item.field(3), item.field(4)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "end", "words", "is_first", "first_doc_id"])

    texts = bounded(docs).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    out = with_lists(texts, lists, "doc", "of", 24).select("doc", "text", "items")
    # rows that repeat an id and its text tell the same spans
    return out.mapInArrow(run, f"`{id_col}` {kind}, start long, end long, words long, is_first boolean, first_doc_id {kind}").distinct()


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", min_words: int = MIN_WORDS, written: Written | None = None) -> DataFrame:
    """docs without all but the first occurrence of each repeated passage; length_col follows the text."""
    written = written or Written(docs.sparkSession)
    found = word_spans(docs, id_col, text_col, min_words, min(SEED, min_words // 2), written).filter("not is_first")
    lists = written.save(found.groupBy(F.col("doc").alias("c_of")).agg(F.collect_list(F.struct("sig", "first", "last")).alias("items")), "suffix-cuts")
    columns = docs.columns
    rows = bounded(docs).select(F.struct("*").alias("c_row"), F.col(id_col).alias("c_id"), F.col(text_col).alias("c_text"))
    hit = with_lists(rows, lists, "c_id", "c_of", 24).select("c_text", "items", "c_row")
    rest = rows.join(lists.select("c_of"), F.col("c_id") == F.col("c_of"), "left_anti").select("c_text", "c_row")

    def run(batches):
        for batch in batches:
            out = []
            for w in scan.words(batch.column(0)):
                _, row, start, end = places(w, batch.column(1).slice(w.row, w.n))
                holes: list[list] = [[] for _ in range(w.n)]
                for r, a, b in sorted(zip(row.tolist(), start.tolist(), end.tolist(), strict=True)):
                    holes[r].append((a, b))
                for text, own in zip(batch.column(0).slice(w.row, w.n).to_pylist(), holes, strict=True):
                    if own:
                        kept, at = [], 0
                        for a, b in own:
                            kept.append(text[at : max(at, a)])
                            at = max(at, b)
                        text = "".join([*kept, text[at:]])
                    out.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(2)], names=["c_text", "c_row"])

    schema = StructType([StructField("c_text", StringType()), rows.schema["c_row"]])
    new = hit.mapInArrow(run, schema).unionAll(rest)
    pick = []
    for c in columns:
        value = F.col(f"c_row.`{c}`")
        if c == text_col:
            value = F.col("c_text")
        elif c == length_col:
            value = F.when(F.col("c_text").eqNullSafe(F.col(f"c_row.`{text_col}`")), value).otherwise(F.length("c_text").cast(docs.schema[c].dataType))
        pick.append(value.alias(c))
    return new.select(*pick)


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Spans of all passages of 50 words or more that occur twice in the documents."""
    return spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
