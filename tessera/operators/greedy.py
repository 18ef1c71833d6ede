"""What a greedy pass keeps: in order, an item stays unless it conflicts with one that stayed before it.

The pass depends on order, but an item depends on its conflicts alone. Conflicts are cut into stretches, each a range of
the order within a group, or of several groups. A task decides the items of its stretch from first to last, with what is known of
earlier stretches; an item that waits for an undecided one waits for the next round. So conflicts that stand close in
order, however long their chain, are settled in one round, and there are no more rounds than stretches.
No task holds more than its stretch: the conflicts of an item are read as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import dealt, forget, stored

#: Conflicts of a stretch, about: so many are decided in one task.
STRETCH = 2_000_000


def dropped(conflicts: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(key, place): the items that a greedy pass does not keep.

    conflicts: key (string), earlier, later (long, earlier < later): two items of a group that cannot both stay. Items are
    told by their places in the group's order. Repeated conflicts do no harm.
    """
    rows = stored(conflicts.select("key", "earlier", "later").filter("earlier < later"))
    stretches = max(1, -(-rows.count() // stretch))
    rows = stored(rows.repartitionByRange(stretches, "key", "later").withColumn("stretch", F.spark_partition_id()))
    ends = rows.select("key", F.col("later").alias("place")).distinct()
    known = rows.select("key", F.col("earlier").alias("place")).distinct().join(dealt(ends), ["key", "place"], "left_anti").withColumn("kept", F.lit(True))
    known, waiting = stored(known), rows
    while True:
        told = waiting.join(dealt(known.select("key", F.col("place").alias("earlier"), "kept")), ["key", "earlier"], "left")
        told = told.select("stretch", "key", "later", "earlier", "kept").repartition(stretches, "stretch").sortWithinPartitions("stretch", "key", "later", "earlier")
        new = stored(told.mapInArrow(_decide, "key string, place long, kept boolean"))
        if new.isEmpty():
            return known.filter("not kept").select("key", "place")
        more = stored(known.unionAll(new))
        forget(known)
        known = more
        if stretches == 1:  # nothing waits for another task
            return known.filter("not kept").select("key", "place")
        fewer = stored(waiting.join(dealt(new.select("key", F.col("place").alias("later"))), ["key", "later"], "left_anti"))
        forget(waiting, new)
        waiting = fewer


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose fate follows from what is known, of rows (stretch, key, later, earlier, kept) in order."""
    group, own = None, {}  # what was decided here of the group at hand
    item, fate = None, None  # fate: False if a conflict stayed, None if one is undecided, else True
    out: list[tuple] = []

    def settle():
        if item is not None:
            own[item] = fate
            if fate is not None:
                out.append((group[1], item, fate))

    def told():
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()))], names=["key", "place", "kept"])

    for batch in batches:
        for stretch, key, later, earlier, kept in zip(*(c.to_pylist() for c in batch.columns)):
            if (stretch, key) != group or later != item:
                settle()
                if (stretch, key) != group:
                    group, own = (stretch, key), {}
                item, fate = later, True
            met = kept if kept is not None else own.get(earlier)
            if met:
                fate = False
            elif met is None and fate:
                fate = None
        if len(out) > 10_000:
            yield told()
            out.clear()
    settle()
    yield told()
