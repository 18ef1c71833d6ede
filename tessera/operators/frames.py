"""Video frames: hash dedup, labels, alignment with transcripts."""

from __future__ import annotations

from itertools import combinations, pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors
from tessera.functions import vocabulary as V
from tessera.functions.numbers import half_even
from tessera.operators.greedy import dropped
from tessera.operators.relational import as_of, dealt, forget, group_key, in_interval, ranked, small, stored

#: Different hashes of a course up to which they all meet, which costs less than slots do.
SMALL_COURSE = 500


def frame_time(seq: Column, step: float = V.FRAME_STEP) -> Column:
    """The middle of the stretch that the seq-th frame (from 1) stands for."""
    return (seq - 0.5) * step


def bit_slots(bits: Column, distance: int) -> Column:
    """Array of longs: 64-bit values within `distance` bits have one in common.

    The 16 digits are cut into distance + 2 blocks; of these, differing bits spoil `distance` at most, so two
    are equal, and any two of them make a slot. Where digits are too few for that, one block does, or none.
    """
    blocks = min(16, distance + 2)
    edges = [64 - 4 * (16 * k // blocks) for k in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for high, low in pairwise(edges)]
    chosen = [*combinations(range(blocks), blocks - distance)] if distance < blocks else [()]
    # one shuffle key for each choice of blocks and their bits; what two keys share by chance is told apart by the exact distance
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    return F.array(*[F.xxhash64(F.lit(k), bits.bitwiseAND(F.lit(signed(sum(masks[i] for i in c))))) for k, c in enumerate(chosen)])


def hash_slots(phash: Column, distance: int) -> Column:
    """bit_slots of 16 hexadecimal digits."""
    return bit_slots(vectors.bits_of(phash), distance)


def distinct_frames(frames: DataFrame, key: str, order: str, phash: str, distance: int = V.HASH_DISTANCE) -> DataFrame:
    """In order, a frame stays if it differs in more than `distance` bits from every kept frame of its course.

    Equal hashes are one item, told by its first frame. Items of a small course all meet, those of larger ones in slots (bit_slots). First
    come rounds of leaders: an item that is the first of all its slots stays for sure, and what is near it goes; they end when a round decides
    less than a fifth. Of what is left, near pairs are conflicts, and greedy.dropped settles them. Frames without a hash stay.
    """
    bits = vectors.bits_of(F.lpad(F.lower(F.col(phash)), 16, "0"))
    rows = stored(ranked(frames.withColumn("_key", group_key(key)).withColumn("_bits", bits), ["_key"], [F.col(order)], "_place"))
    firsts = rows.filter("_bits is not null").groupBy("_key", "_bits").agg(F.min("_place").alias("_place"))
    large = stored(firsts.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > SMALL_COURSE).select("_key", F.lit(True).alias("_large")))
    items = stored(firsts.join(small(large), "_key", "left").withColumn("_large", F.col("_large").isNotNull()))
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance
    slots_of = lambda df: df.select("_key", "_bits", "_place", "_large", F.explode(F.when(F.col("_large"), bit_slots(F.col("_bits"), distance)).otherwise(F.array(F.lit(0).cast("long")))).alias("slot"))
    of_large = F.size(bit_slots(F.lit(0).cast("long"), distance))
    rest, lost, left = items, None, items.count()
    while left:
        # a slot's first item leads it; who leads as many slots as it has stays
        slots = slots_of(rest)
        first = stored(slots.groupBy("_key", "slot").agg(F.min(F.struct("_place", "_bits", F.col("_large"))).alias("lead")).select("_key", "slot", F.col("lead._place").alias("l_place"), F.col("lead._bits").alias("l_bits"), F.col("lead._large").alias("_large")))
        sure = stored(first.groupBy("_key", "l_place").agg(F.count("*").alias("n"), F.first("_large").alias("_large")).filter(F.col("n") == F.when(F.col("_large"), of_large).otherwise(1)).select("_key", "l_place"))
        leads = first.drop("_large").join(dealt(sure), ["_key", "l_place"], "left_semi")
        gone = slots.join(dealt(leads), ["_key", "slot"]).filter((F.col("l_place") < F.col("_place")) & near("_bits", "l_bits"))
        gone = stored(gone.select("_key", "_place").distinct())
        lost = gone if lost is None else lost.unionAll(gone)
        decided = gone.unionAll(sure.withColumnRenamed("l_place", "_place"))
        fewer = stored(rest.join(dealt(decided), ["_key", "_place"], "left_anti").select(*rest.columns))
        forget(first, sure, *([rest] if rest is not items else []))
        rest, now = fewer, fewer.count()
        if 5 * (left - now) < left:
            break
        left = now
    slots = slots_of(rest)
    a, b = (slots.select("_key", "slot", F.col("_bits").alias(f"{k}_bits"), F.col("_place").alias(p)) for k, p in (("a", "earlier"), ("b", "later")))
    met = a.join(dealt(b), ["_key", "slot"]).filter("earlier < later").filter(near("a_bits", "b_bits"))
    conflicts = met.select(F.col("_key").alias("key"), "earlier", "later").distinct()
    out = dropped(conflicts).select(F.col("key").alias("_key"), F.col("place").alias("_place"))
    lost = out if lost is None else lost.unionAll(out)
    kept = items.select("_key", "_place").join(dealt(lost), ["_key", "_place"], "left_anti").unionAll(rows.filter("_bits is null").select("_key", "_place"))
    return rows.join(dealt(kept), ["_key", "_place"], "left_semi").select(*frames.columns)


def closed_label(label: Column, confidence: Column, labels: list[str] = V.FRAME_LABELS, other: str = V.OTHER_LABEL) -> Column:
    """(label, confidence): labels outside the set become `other`; confidence to 3 places, 0 where unknown."""
    return F.struct(F.when(label.isin(labels), label).otherwise(other).alias("label"), F.round(F.coalesce(confidence.cast("double"), F.lit(0.0)), 3).alias("confidence"))


def label_counts(frames: DataFrame, key: str, label: str, labels: list[str] = V.FRAME_LABELS) -> DataFrame:
    """One row per course, one column per label."""
    return frames.groupBy(key).pivot(label, labels).count().na.fill(0, labels)


def text_around(frames: DataFrame, blocks: DataFrame, key: str, at: str, reach: float = 60.0) -> DataFrame:
    """Each frame's id columns with the blocks' texts that begin within `reach` seconds, in their order."""
    spans = frames.select(key, "frame_id", F.greatest(F.col(at) - reach, F.lit(0.0)).alias("_low"), (F.col(at) + reach).alias("_high"))
    met = in_interval(blocks.select(key, "block_idx", "start_sec", "text"), spans, [key], "start_sec", "_low", "_high", 2 * reach, closed=True)
    return met.groupBy(key, "frame_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "text"))), lambda b: b["text"]), "\n").alias("window_text"))


def aligned(frames: DataFrame, blocks: DataFrame, replies: DataFrame, key: str = "course_id") -> DataFrame:
    """Three checks of each frame (frame_id, timestamp_sec, duration): its time is in the video, a block
    stands there, and the judged replies (frame_id, consistent) find text and picture to agree."""
    placed = as_of(frames, blocks.select(key, "start_sec", "block_idx"), [key], "timestamp_sec", "start_sec", ["block_idx"])
    placed = placed.join(text_around(frames, blocks, key, "timestamp_sec"), [key, "frame_id"], "left").join(replies.withColumn("answered", F.lit(True)), "frame_id", "left")
    judged = F.when(F.coalesce(F.btrim("window_text"), F.lit("")) == "", "unknown").when(F.col("answered").isNull(), "failed").when(F.col("consistent"), "agree").otherwise("differ")
    out = placed.withColumns({"in_video": F.col("timestamp_sec").between(F.lit(0), F.col("duration")), "has_block": F.col("block_idx").isNotNull(), "judged": judged})
    return out.withColumn("passed", F.col("in_video") & F.col("has_block") & (F.col("judged") == "agree"))


def pass_ratio(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count("*").alias("checks"), F.count_if("passed").alias("passes"), half_even(F.try_divide(F.count_if("passed"), F.count("*")), 4).alias("ratio"))


def by_priority(courses: DataFrame, first: str, id_col: str, most: int | None = None) -> DataFrame:
    """Courses in the order of work, place (int) from 1: the marked ones first, then by id; up to `most`."""
    order = [F.coalesce(F.col(first), F.lit(False)).desc(), F.col(id_col)]
    out = courses if most is None else courses.orderBy(*order).limit(most)
    return ranked(out, [], order).withColumn("place", F.col("place").cast("int"))
