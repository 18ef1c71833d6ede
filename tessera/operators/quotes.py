"""Where quotes stand in texts: a positional index of character grams, probed by each quote's rarest gram.

A quote is covered by grams of ``GRAM`` characters at 0, GRAM, 2 GRAM, ... and at its end (a shorter quote is one
gram). Texts are read once, and give the places (gram, text, position) of those grams alone: a bitmap of fixed size tells
which places may matter, whatever the number of quotes. A quote is looked up by the gram of its cover that has the fewest places;
each of these tells where the quote would begin, and it stands there if all other grams of its cover have a place at
their distance. Texts themselves are never shuffled, and never compared pairwise with quotes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import stored

GRAM = 12
#: Bits of the bitmap of grams (8 MB).
BITS = 1 << 26
#: Unicode's white space, as the engine's patterns have it.
WHITE = np.array([*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)


def solid(text: str, squeeze: bool) -> tuple[str, np.ndarray, np.ndarray]:
    """The characters that count, as text and code points, and their places in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not squeeze:
        return text, codes, np.arange(len(codes))
    at = np.flatnonzero(~np.isin(codes, WHITE))
    codes = codes[at]
    return (codes.tobytes().decode("utf-32-le", "surrogatepass") if len(at) < len(text) else text), codes, at


#: Characters whose grams a task holds at a time, unless one text is longer.
SLICE = 1 << 18


def slices(batch: pa.RecordBatch, text: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch, so many characters of its texts at a time: what a task holds does not grow with the rows of a batch."""
    size, at = size or SLICE, 0
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")) - at)
        yield batch.slice(at, n)
        at += n


def gram_slots(codes: np.ndarray, size: int) -> np.ndarray:
    """Bit of each run of `size` code points."""
    n = len(codes) - size + 1
    if n < 1:
        return np.zeros(0, np.int64)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h & np.uint64(BITS - 1)).astype(np.int64)


def cover(size: int, gram: int) -> list[int]:
    """Offsets of the grams that cover a quote of `size` characters."""
    if size <= gram:
        return [0]
    return [*range(0, size - gram, gram), size - gram]


def covers(quotes: DataFrame, quote: str, squeeze: bool, gram: int = GRAM) -> DataFrame:
    """Rows of quotes with (size, parts: how many grams cover it, gram, shift, slot), a row for each gram; none for empty quotes."""
    names = quotes.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, quote)):
            row, found = [], []
            for k, text in enumerate(batch.column(quote).to_pylist()):
                text, codes, _ = solid(text or "", squeeze)
                if text:
                    g = min(gram, len(codes))
                    slots, offsets = gram_slots(codes, g), cover(len(codes), g)
                    row += [k] * len(offsets)
                    found += [(len(codes), len(offsets), text[o : o + g], o, int(slots[o])) for o in offsets]
            if row:
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64()))]
                kept = pa.Table.from_batches([batch]).take(pa.array(row)).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*names, "size", "parts", "gram", "shift", "slot"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in quotes.schema)
    return quotes.mapInArrow(cut, fields + ", size int, parts int, gram string, shift int, slot long")


def bitmap(slots: DataFrame) -> np.ndarray:
    """Bytes whose bits are set at the slots; at most BITS / 8 rows reach the driver."""
    bit = F.expr("shiftleft(1, cast(slot & 7 as int))")
    rows = slots.select(F.shiftright("slot", 3).alias("byte"), bit.alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(BITS // 8, np.uint8)
    out[rows.column("byte").to_numpy()] = rows.column("bit").to_numpy()
    return out


def gram_places(texts: DataFrame, text: str, bits: np.ndarray, sizes: list[int], squeeze: bool) -> DataFrame:
    """Rows of texts without the text, with (gram, pos, raw_start, raw_end), a row for each marked gram."""
    keys = [c for c in texts.columns if c != text]
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in (part for whole in batches for part in slices(whole, text)):
            rows, grams, places, starts, ends = [], [], [], [], []
            for k, own in enumerate(batch.column(text).to_pylist()):
                own, codes, at = solid(own or "", squeeze)
                for size in sizes:
                    slots = gram_slots(codes, size)
                    found = np.flatnonzero((bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
                    if len(found):
                        rows.append(np.full(len(found), k))
                        grams += [own[p : p + size] for p in found.tolist()]
                        places.append(found)
                        starts.append(at[found])
                        ends.append(at[found + size - 1] + 1)
            if rows:
                kept = pa.Table.from_batches([batch]).select(keys).take(pa.array(np.concatenate(rows))).combine_chunks().to_batches()[0]
                numbers = [pa.array(np.concatenate(x).astype(np.int32)) for x in (places, starts, ends)]
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(grams, pa.string()), *numbers], names=[*keys, "gram", "pos", "raw_start", "raw_end"])

    fields = "".join(f"`{texts.schema[c].name}` {texts.schema[c].dataType.simpleString()}, " for c in keys)
    return texts.select(*keys, text).mapInArrow(place, fields + "gram string, pos int, raw_start int, raw_end int")


def quote_places(quotes: DataFrame, texts: DataFrame, quote_id: str, quote: str, text_id: str, text: str, on: list[str] | None = None, squeeze: bool = True, gram: int = GRAM) -> DataFrame:
    """(*on, quote_id, text_id, start, end): all places of whole quotes in texts, overlapping ones too.

    Columns of `on` must agree; text_id may be one of them. White space does not count unless squeeze is False; start
    and end are places in the text as it is. Empty quotes stand nowhere. Ids name one quote and one text (within `on`).
    """
    on = on or []
    keys = [*dict.fromkeys([*on, text_id])]
    asked = stored(covers(quotes.select(*dict.fromkeys([*on, quote_id]), F.col(quote).alias("_quote")), "_quote", squeeze, gram).drop("_quote"))
    sizes = sorted(r[0] for r in asked.select(F.least("size", F.lit(gram))).distinct().collect())  # at most `gram` numbers
    bits = bitmap(asked.select("slot"))
    places = gram_places(texts.select(*keys, F.col(text).alias("_text")), "_text", bits, sizes, squeeze)
    places = stored(places.join(asked.select(*on, "gram").distinct(), [*on, "gram"], "left_semi").select(*keys, "gram", "pos", "raw_start", "raw_end"))
    counted = places.groupBy(*on, "gram").agg(F.count("*").alias("df"))
    own = [*dict.fromkeys([*on, quote_id])]
    rarest = asked.join(counted, [*on, "gram"], "left").groupBy(*own).agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shift", "gram", "parts", "size")).alias("r"))
    rarest = rarest.filter("r.df > 0").select(*own, "r.shift", "r.gram", "r.parts", "r.size")
    begun = places.select(*keys, "gram", "pos").join(rarest, [*on, "gram"]).withColumn("begin", F.col("pos") - F.col("shift")).filter("begin >= 0")
    begun = begun.select(*dict.fromkeys([*keys, *own]), "begin", "parts", "size")
    expected = begun.join(asked.select(*own, "gram", "shift"), own).withColumn("pos", F.col("begin") + F.col("shift"))
    met = expected.join(places, [*keys, "gram", "pos"])
    whole = met.groupBy(*dict.fromkeys([*keys, *own]), "begin", "parts").agg(F.count("*").alias("n"), F.min("raw_start").alias("start"), F.max("raw_end").alias("end")).filter("n = parts")
    return whole.select(*dict.fromkeys([*on, quote_id, text_id]), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
