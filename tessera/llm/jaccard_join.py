"""Exact Jaccard join of documents' word shingles in metric space.

The Jaccard distance d = 1 - |x n y| / |x u y| is a metric, so documents within
``1 - similarity`` of each other lie within that distance of each other as seen from any
pivot. The join works on sets of shingle hashes (64 bits), equal sets once:

1. A partner shares at least ceil(s * n) of a set's n shingles, so two linked sets share
   some of the first shingles in any fixed order. Each set shows its first ones in hash
   order; sets that share too few of them with others lie at the far end of the metric
   from all others (no window reaches them) and leave. The rest are counted again among
   themselves, until few leave.
2. The sets that stay show their rarest shingles, rarest among them first, as many as any
   partner must meet one of. Each such shingle is a region holding all sets that show it;
   a set is replicated to every region that a set within the distance may lie in.
3. In each region the most central member is the pivot. A set belongs to the Voronoi cell
   of the pivot it meets in most regions, and its exact distance to that pivot is found.
   Sets within the distance link to the pivot, so a group of copies becomes a star, not all
   pairs.
4. Regions whose members are not yet connected are joined recursively: members outside a
   region's largest component become pivots in turn, more of them each round, against the
   members that the triangle inequality leaves (seen from a common pivot, distances that
   differ by more than the window rule a pair out) and whose place in the order of shingles
   leaves enough of them for the overlap. A region ends when its members are
   connected, or every pair of members from different components was compared or ruled
   out; so no link between components is lost.

Results for special inputs: null or empty texts have no shingles, n_shingles 0, and are their
own component; a text with fewer words than a shingle has its whole sequence as its one
shingle; equal sets are linked; repeated rows give repeated results; a null id is never a
component's id. Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import scan
from tessera.llm.components import components
from tessera.llm.shared import Written, bounded

WORDS = 5
#: Similarity of 0.8 as a ratio of integers.
SIMILARITY = (4, 5)
#: Regions whose open pairs are at most this many times their members are finished in one round.
LINEAR = 30
#: Ids up to which texts or sets are chosen by a broadcast of them; beyond, by a join.
BROADCAST_ROWS = 1_000_000


def needed(n, similarity=SIMILARITY):
    """Least overlap of a set of n shingles with any partner (numpy or int)."""
    a, b = similarity
    return -(-n * a // b)


def slack(n):
    """Common shingles beyond one that a set shows in the first pass."""
    return np.maximum(1, n // 20)


def sets_of(w: scan.Words, size: int):
    """Sorted distinct shingle hashes of each text, in one array, with n + 1 indexes."""
    h, at = scan.shingles(w, size)
    row = np.repeat(np.arange(w.n), np.diff(at))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(w.n + 1)).astype(np.int64)


def signatures(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for each set."""
    out = []
    for seed in (1, 2):
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(scan.mix(h, seed), out=sums[1:])
        out.append(scan.mix(sums[at[1:]] - sums[at[:-1]], seed).view(np.int64))
    return out[0], out[1]


def _lists(h: np.ndarray, begin: np.ndarray, length: np.ndarray) -> pa.ListArray:
    total = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=total[1:])
    pick = np.arange(total[-1]) - np.repeat(total[:-1] - begin, length)
    return pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), pa.array(h[pick].view(np.int64)))


def shown(docs: DataFrame, id_col: str, text_col: str, size: int, similarity) -> DataFrame:
    """Each document's set: size n, signature (s1, s2), and its first shingles in hash order."""

    def run(batches):
        for batch in batches:
            for w in scan.words(batch.column(1), lower=True):
                h, at = sets_of(w, size)
                n = np.diff(at)
                s1, s2 = signatures(h, at)
                first = np.where(n > 0, np.minimum(n, n - needed(n, similarity) + slack(n)), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.row, w.n), pa.array(n), pa.array(s1), pa.array(s2), _lists(h, at[:-1], first)],
                    names=["doc", "n", "s1", "s2", "first"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return bounded(docs).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(run, f"doc {kind}, n long, s1 long, s2 long, first array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """The whole sets of the wanted (doc, s1)."""

    def run(batches):
        for batch in batches:
            expect = batch.column(2).to_numpy()
            for w in scan.words(batch.column(1), lower=True):
                h, at = sets_of(w, size)
                s1, _ = signatures(h, at)
                same = np.flatnonzero(s1 == expect[w.row : w.row + w.n])
                n = np.diff(at)[same]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.row, w.n).take(pa.array(same)), pa.array(n), _lists(h, at[:-1][same], n)],
                    names=["doc", "n", "shingles"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(wanted, "doc")
    return picked.select("doc", "text", "s1").mapInArrow(run, f"doc {kind}, n long, shingles array<long>")


def linked(pairs: DataFrame, sets: DataFrame, similarity) -> DataFrame:
    """pairs (x, p) with common, nx, np, and whether they link."""
    a, b = similarity
    own = sets.select(F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("shingles").alias("sx"))
    other = sets.select(F.col("doc").alias("p"), F.col("n").alias("np"), F.col("shingles").alias("sp"))
    common = F.size(F.array_intersect("sx", "sp")).cast("long")
    return (
        pairs.join(own, "x").join(other, "p")
        .select("x", "p", "nx", "np", common.alias("common"))
        .withColumn("link", F.col("common") * b >= (F.col("nx") + F.col("np") - F.col("common")) * a)
    )


def asked(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets that pairs (x, p), a stored table, name: a round with few pairs does not deal out all sets again."""
    ids = pairs.select(F.explode(F.array("x", "p")).alias("doc")).distinct()
    return sets.join(F.broadcast(ids), "doc", "left_semi") if pairs.count() <= BROADCAST_ROWS // 2 else sets


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WORDS,
    similarity: tuple[int, int] = SIMILARITY,
    written: Written | None = None,
) -> DataFrame:
    """One row for each row of docs: id_col, n_shingles, component_id."""
    written = written or Written(docs.sparkSession)
    before = list(written.tables)
    a, b = similarity
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shows = written.save(shown(docs, id_col, text_col, size, similarity), "join-sets")
    # a few bytes a row: few files
    held = written.save(shows.drop("first").coalesce(max(1, parts // 8)), "join-signatures")

    # 1. sets with too few common first shingles leave
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * a / b) / 20)).cast("long")
    entries = shows.filter("n > 0").select("s1", "n", F.explode("first").alias("h"))

    def shared(rows: DataFrame) -> DataFrame:
        """Entries whose shingle another set shows too, each once.

        Rows are dealt out by ranges of (shingle, set) and compared with their neighbours, so a shingle
        that a third of all sets show fills many tasks. The first and last shingle of a batch count as
        shared, as this filter may keep too many.
        """

        def neighbours(batches):
            for batch in batches:
                h, s1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                if not len(h):
                    continue
                same, other = h[1:] == h[:-1], s1[1:] != s1[:-1]
                begin = np.flatnonzero(np.concatenate([[True], ~same]))
                mixed = np.add.reduceat(np.concatenate([[0], same & other]).astype(np.int64), begin) > 0
                mixed[[0, -1]] = True
                once = np.concatenate([[True], ~same | other])
                yield batch.filter(pa.array(np.repeat(mixed, np.diff(np.append(begin, len(h)))) & once))

        ranged = rows.select("h", "s1", "n").repartitionByRange(parts, "h", "s1").sortWithinPartitions("h", "s1")
        return ranged.mapInArrow(neighbours, "h long, s1 long, n long")

    def staying(rows: DataFrame) -> DataFrame:
        return rows.groupBy("s1").agg(F.max("n").alias("n"), F.count("*").alias("c")).filter(F.col("c") >= least).select("s1")

    common = written.save(shared(entries), "join-entries")
    written.drop(shows)
    again = written.save(shared(common.join(staying(common), "s1", "left_semi")), "join-entries")
    written.drop(common)
    stay = staying(again)

    # equal sets are one class, named by its least id
    classes = held.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep"), F.count("*").alias("members"))
    classes = written.save(classes.filter("rep is not null"), "join-classes")
    wanted = written.save(classes.join(stay, "s1", "left_semi").select(F.col("rep").alias("doc"), "s1"), "join-wanted")
    written.drop(again)
    few = wanted.count() <= BROADCAST_ROWS
    sets = written.save(full_sets(docs, F.broadcast(wanted) if few else wanted, id_col, text_col, size), "join-full")

    # 2. regions: the rarest shingles of each set
    known = sets.select("doc", "n", F.explode("shingles").alias("h")).repartition("h")
    known = known.withColumn("df", F.count("*").over(Window.partitionBy("h"))).filter("df > 1")
    by_doc = Window.partitionBy("doc")
    known = (
        known.withColumn("c", F.count("*").over(by_doc)).withColumn("central", F.sum("df").over(by_doc) / F.col("n"))
        .filter(F.col("c") * b >= F.col("n") * a)
        .withColumn("rank", F.row_number().over(by_doc.orderBy("df", "h")))
        .filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * a / b) + 1 - (F.col("n") - F.col("c")))
        .select("h", F.col("doc").alias("x"), "n", "central", (F.col("n") - F.col("c") + F.col("rank") - 1).alias("pos"))
    )
    # a pair is compared only where its overlap may suffice if this is its first common shingle
    may_reach = lambda n, pos, m: (F.col(n) - F.col(pos)) * (a + b) >= (F.col(n) + F.col(m)) * a
    members = written.save(known, "join-members")

    # 3. the Voronoi cells of the regions' pivots
    pivots = members.groupBy("h").agg(F.max(F.struct("central", F.col("n").alias("pn"), F.col("x").alias("p"), F.col("pos").alias("ppos"))).alias("top"), F.count("*").alias("m")).filter("m > 1")
    cells = (
        members.join(pivots.select("h", "top.p", "top.pn", "top.ppos"), "h").filter("x <> p")
        .filter(may_reach("n", "pos", "pn") & may_reach("pn", "ppos", "n"))
        .groupBy("x", "p").agg(F.count("*").alias("met"))
        .groupBy("x").agg(F.max(F.struct("met", "p")).alias("top")).select("x", "top.p")
    )
    compared = written.save(linked(cells, sets, similarity), "join-compared")
    links = compared.filter("link").select(F.col("x").alias("a"), F.col("p").alias("b"))
    seen_from = compared.select("x", F.col("p").alias("cell"), (1 - F.col("common") / (F.col("nx") + F.col("np") - F.col("common"))).alias("d"))
    seen_from = written.save(seen_from.unionAll(compared.select(F.col("p").alias("x"), F.col("p").alias("cell"), F.lit(0.0).alias("d")).distinct()).groupBy("x").agg(F.min(F.struct("d", "cell")).alias("at")).select("x", "at.cell", "at.d"), "join-cells")
    members = written.save(members.join(seen_from, "x", "left").select("h", "x", "n", "central", "pos", "cell", "d"), "join-members")

    # 4. regions that are not connected join recursively
    done, each, window = compared.select("x", "p"), 4, 1 - a / b + 1e-9
    while True:
        joined = components(links, written)
        marked = members.join(joined.select(F.col("v").alias("x"), "label"), "x", "left").withColumn("label", F.coalesce("label", "x"))
        groups = marked.groupBy("h", "label").agg(F.count("*").alias("size"))
        largest = groups.groupBy("h").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("groups")).filter("groups > 1").select("h", F.col("top.label").alias("main"))
        marked = written.save(marked.join(largest, "h"), "join-marked")
        outside = marked.filter("label <> main")
        u = outside.select("h", F.col("x").alias("p"), F.col("n").alias("pn"), F.col("cell").alias("pcell"), F.col("d").alias("pd"), F.col("label").alias("plabel"), F.col("pos").alias("ppos"), "central")
        possible = (
            (F.col("label") != F.col("plabel"))
            & may_reach("n", "pos", "pn") & may_reach("pn", "ppos", "n")
            & ~F.coalesce((F.col("cell") == F.col("pcell")) & (F.abs(F.col("d") - F.col("pd")) > window), F.lit(False))
        )
        sizes = marked.groupBy("h").agg(F.count("*").alias("all"), F.count_if(F.col("label") != F.col("main")).alias("out"))
        work = sizes.agg(F.max("out").alias("most"), F.sum(F.col("all") * F.col("out")).alias("pairs"), F.sum("all").alias("rows")).first().asDict()
        work = {k: v or 0 for k, v in work.items()}
        if work["pairs"] <= LINEAR * work["rows"]:
            each = max(each, work["most"])
        # a region's pivots of this round
        open_pairs = lambda p: marked.drop("central").join(p, "h").filter(possible).select("h", F.least("x", "p").alias("x"), F.greatest("x", "p").alias("p"), F.col("p").alias("pivot"))
        ranked = u.withColumn("turn", F.row_number().over(Window.partitionBy("h").orderBy(F.desc("central"), "p"))).filter(F.col("turn") <= each)
        tried = open_pairs(ranked).select("x", "p").distinct()
        fresh = tried.join(done.select(F.least("x", "p").alias("x"), F.greatest("x", "p").alias("p")).distinct(), ["x", "p"], "left_anti")
        fresh = written.save(fresh, "join-pairs")
        now = written.save(linked(fresh, asked(sets, fresh), similarity), "join-compared")
        links = links.unionAll(now.filter("link").select(F.col("x").alias("a"), F.col("p").alias("b")))
        done = done.unionAll(now.select("x", "p"))
        written.drop(marked, fresh)
        if work["most"] <= each and now.filter("link").isEmpty():
            break
        each *= 8

    # the last round linked nothing, so its components are final; documents outside their own class' name or component
    named = classes.join(joined.select(F.col("v").alias("rep"), "label"), "rep", "left").filter("members > 1 or label is not null")
    named = written.save(named.select("n", "s1", "s2", F.coalesce("label", "rep").alias("component")), "join-named")
    written.keep(before, held, named)
    out = held.join(named, ["n", "s1", "s2"], "left")
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def op6_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of all documents linked at a Jaccard similarity of 0.8 of five-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
