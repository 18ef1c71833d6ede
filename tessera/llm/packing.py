"""Mixture-controlled packing of tokenised documents into sequences of bounded length.

Each source is a queue of token streams. Deficit round-robin visits the queues window by
window: per window a queue earns its target share of the window's tokens, sends as many
whole tokens as it has earned, and carries the rest (less than one token) to the next
window. Earnings only depend on how many windows have passed, so the tokens sent before
window w are floor(share * w * window): any task finds the place of any document from
its position in its queue, and deficits carry over windows and partitions without a
sequential pass. Without targets, shares are those of the corpus and hold from the first
window to the last; with targets, shares are held until a queue runs dry, and are
then scaled anew over the rest, as a round-robin over the remaining queues does.

The windows follow each other in one gapless stream that is cut every ``sequence`` tokens,
so that only the very last sequence is padded.

A source with a target has a queue of its own, however small it is, and so has every source that
earns a token a window. The others cannot each be in every window; they share one queue, which earns
what they earn together. So at most ``window`` queues and those of the targets reach the driver.

Results for special inputs: a null or empty text is a document of its end id alone; a
null source is a source of its own; repeated rows are packed each; an empty table gives
no pieces. Other columns of the input are not looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import SPACE, byte_alphabet
from tessera.llm.shared import Written, bounded

SEQUENCE = 2048
#: Tokens of a mixture window: sixteen sequences.
WINDOW = 16 * SEQUENCE
#: Shares of the query's sequences; sources that are not named keep their share of the corpus.
TARGETS = {"src0": 0.2, "src1": 0.1, "src2": 0.05}
#: Id after each document.
END = 1
#: Rows of (source, partition) offsets up to which they are broadcast; beyond, they are joined.
BROADCAST_ROWS = 500_000
#: Fixed value: how the vocabulary's splitter divides a text.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"



class Tokenised:
    """Ids of a byte-level vocabulary in a tokenizers file.

    Merges of this vocabulary are numbered as their results are, so its tokens are ranks, and the
    rank encoder gives the library's ids in a third of its time. It is slow for long runs
    without a break, so texts with one go to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, special = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged) or max(merged, default=0) >= 1 << 16:
            raise ValueError("ids must be in the order of merges and fit 16 bits")
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.run = re.compile(r"[^\s]{1000}|[^\S ]{1000}| {1000}")

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 16-bit ids of each text."""
        out = []
        for t in texts:
            if not t:
                out.append(b"")
            elif self.run.search(t):
                out.append(np.array(self.lib.encode(t, add_special_tokens=False).ids, "<u2").tobytes())
            else:
                out.append(self.fast.encode_to_numpy(t, allowed_special="all").astype("<u2").tobytes())
        return out


@lru_cache(maxsize=2)
def loaded(path: str) -> Tokenised:
    return Tokenised(path)


class Schedule:
    """Where the token at a queue's position stands in the stream.

    totals: tokens of each queue; targets: weights of the queues, or None for their shares.
    A phase lasts until a queue runs dry; phases hold (start in the stream, [start in each queue], [tokens of each queue]).
    """

    def __init__(self, totals: list[int], window: int, targets: list[float] | None = None):
        self.window = window
        self.phases: list[tuple[int, list[int], list[int]]] = []
        left, at, begin = list(totals), [0] * len(totals), 0
        while any(left):
            if targets is None:
                sent = list(left)
            else:
                lasts = min(n / w for n, w in zip(left, targets, strict=True) if n)
                sent = [n if n / w <= lasts else min(n, int(w * lasts)) for n, w in zip(left, targets, strict=True)]
            self.phases.append((begin, at, sent))
            begin += sum(sent)
            at = [a + s for a, s in zip(at, sent, strict=True)]
            left = [n - s for n, s in zip(left, sent, strict=True)]
        self.starts = [[p[1][q] for p in self.phases] for q in range(len(totals))]
        self.known: dict[tuple[int, int], tuple[int, list[int]]] = {}

    def layout(self, phase: int, w: int) -> tuple[int, list[int]]:
        """Tokens sent before window w of a phase: of all queues, and of each."""
        if (found := self.known.get((phase, w))) is None:
            sent = self.phases[phase][2]
            total = sum(sent)
            n = min(w * self.window, total)
            each = [s * n // total for s in sent]
            if len(self.known) > 10_000:
                self.known.clear()
            found = self.known[phase, w] = (sum(each), each)
        return found

    def runs(self, queue: int, start: int, length: int):
        """Cut positions [start, start + length) of a queue into (length, position in the stream)."""
        end = start + length
        while start < end:
            phase = bisect_right(self.starts[queue], start) - 1
            begin, at, sent = self.phases[phase]
            p, mine, total = start - at[queue], sent[queue], sum(sent)
            w = p * total // (mine * self.window)
            while self.layout(phase, w)[1][queue] > p:
                w -= 1
            while self.layout(phase, w + 1)[1][queue] <= p:
                w += 1
            (before, each), (_, after) = self.layout(phase, w), self.layout(phase, w + 1)
            take = min(end - start, after[queue] - p)
            stands = begin + before + sum(after[:queue]) - sum(each[:queue]) + p - each[queue]
            yield take, stands
            start += take


def tokenise(docs: DataFrame, path: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Ids of each document with its end id, and its start among its partition's tokens of its source."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        tokens, part, begun = loaded(path), TaskContext.get().partitionId(), {}
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                ids = [x + end for x in tokens.ids(rows.column(2).to_pylist())]
                starts = []
                for s, x in zip(rows.column(1).to_pylist(), ids, strict=True):
                    starts.append(begun.get(s, 0))
                    begun[s] = starts[-1] + len(x) // 2
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array([part] * len(ids), pa.int64()), pa.array(starts, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc", "source", "part", "local_start", "n", "ids"],
                )

    picked = bounded(docs).select(F.col(id_col).alias("doc"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"doc {kind}, source string, part long, local_start long, n long, ids binary")


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    sequence: int = SEQUENCE,
    window: int = WINDOW,
    targets: dict[str | None, float] | None = None,
    keep_ids: bool = False,
    written: Written | None = None,
) -> DataFrame:
    """Pack all documents; one row for each piece of a document that lies in one sequence.

    targets: shares by source (sources without one keep their share of the corpus; all are scaled to one).
    keep_ids: also return each piece's ids (binary, little-endian unsigned 32-bit).
    """
    written = written or Written(docs.sparkSession)
    held = written.save(tokenise(docs, path, id_col, text_col, source_col), "packing-ids")
    parts = written.save(held.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing-parts")
    of_source = parts.groupBy("source").agg(F.sum("n").alias("n"))
    whole = of_source.agg(F.sum("n")).first()[0] or 0
    # at most `window` sources earn a token a window, so this is a bounded list
    own = F.col("n") * window >= F.lit(whole)
    for name in targets or {}:
        own |= F.col("source").eqNullSafe(F.lit(name))
    rows = of_source.filter(own).collect()
    queues = sorted(((r.source, r.n) for r in rows), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    names, totals = [q[0] for q in queues], [q[1] for q in queues]
    shares = [(targets or {}).get(s, n / whole) for s, n in zip(names, totals, strict=True)]
    if whole > sum(totals):  # the queue of all others
        totals.append(whole - sum(totals))
        shares.append(totals[-1] / whole)
    weights = None
    if targets is not None and totals:
        weights = [float(x) for x in shares]
        if min(weights) <= 0:
            raise ValueError("targets must be above 0")
    schedule = Schedule(totals, window, weights)
    number = docs.sparkSession.createDataFrame([(s, i) for i, s in enumerate(names)], "name string, queue int")
    order = Window.partitionBy("queue").orderBy("source", "part")
    bases = (
        parts.join(F.broadcast(number), F.col("source").eqNullSafe(F.col("name")), "left")
        .select("source", "part", "n", F.coalesce("queue", F.lit(len(names))).alias("queue"))
        .withColumn("base", F.sum("n").over(order) - F.col("n"))
        .select(F.col("source").alias("b_source"), F.col("part").alias("b_part"), "queue", "base")
    )
    if parts.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = held.join(bases, held.source.eqNullSafe(F.col("b_source")) & (held.part == F.col("b_part")))
    kind = docs.schema[id_col].dataType.simpleString()
    names_out = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids

    def run(batches):
        for batch in batches:
            docs_, queue, at, n, ids = (c.to_pylist() for c in batch.columns)
            out: list[list] = [[] for _ in range(7 + keep_ids)]
            for d, q, a, k, raw in zip(docs_, queue, at, n, ids, strict=True):
                wide, start = np.frombuffer(raw, "<u2").astype("<u4"), 0
                for take, stands in schedule.runs(q, a, k):
                    while take:
                        length = min(take, sequence - stands % sequence)
                        piece = wide[start : start + length].tobytes()
                        row = (d, start, length, zlib.crc32(piece), k, stands // sequence, stands % sequence, piece)
                        for column, value in zip(out, row, strict=False):
                            column.append(value)
                        take, start, stands = take - length, start + length, stands + length
            types = [batch.schema.field(0).type] + [pa.int64()] * 6 + [pa.binary()] * keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names_out)

    ddl = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in names_out[1:7]) + ", ids binary" * keep_ids
    return placed.select("doc", "queue", (F.col("base") + F.col("local_start")).alias("at"), "n", "ids").mapInArrow(run, ddl)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed with the shares of TARGETS in every window."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), targets=TARGETS)
