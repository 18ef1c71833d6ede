"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of weights of a text's terms + sum over pairs of terms of the
inner products of their factors). The pair part learns what an additive model misses: a
term that is harmless alone and toxic beside another. A text's terms are its distinct
lower-cased words without outer ASCII punctuation, and their leading letters (the first
``PREFIX`` ones), hashed to ``DIMENSIONS`` slots.

Training uses labelled rows whose crc32(id as text) mod 3 is not 1. At most ``max_rows``
of them are used, those with the least hash of their id (a documented bound, so that the
model fits on the driver); slots that too few training rows have stay 0. All others get a
weight and factors, so that terms which are neutral alone can be toxic together. Slots learn at
rates that grow with how often they occur, up to a full one; rare slots have it too if their own
tie to the label is beyond chance, as there are thousands of rare ones.
Labels, language, source and id are never inputs of a score.

Results for special inputs: null or empty texts have no terms and score the bias alone;
without any usable label all texts score 0; repeated rows score alike; a null id counts as
not held out and is never trained on. Other columns of the input are not looked at.
"""

from __future__ import annotations

import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import WORD, bounded

DIMENSIONS = 1 << 20
PREFIXES = (4, 5, 6)
FACTORS = 4
MAX_ROWS = 20_000
MIN_ROWS = 4
#: Likelihood ratio from which a slot's tie to the label counts (chance reaches it in 1 of 100,000 slots).
MIN_G2 = 20.0
#: Share of the training rows from which a slot without such a tie is trusted as much.
OFTEN = 0.5
#: Learning rates of weights and factors: of trusted slots, and of rare ones without a tie.
RATES = (0.3, 0.05)
NEUTRAL_RATES = (0.0003, 0.003)
THRESHOLD = 0.7
EPOCHS = 24
#: Words a worker remembers the slots of.
MEMORY = 200_000

_memory: dict[str, tuple[int, ...]] = {}


def slot(term: str) -> int:
    return zlib.crc32(term.encode()) % (DIMENSIONS - 1) + 1


def slots_of_word(word: str) -> tuple[int, ...]:
    """Slots of one lower-cased word: itself, and its leading letters."""
    core = word.strip(string.punctuation)
    if not core:
        return ()
    return tuple({slot(f"w {core}"), *(slot(f"p {core[:k]}") for k in PREFIXES if len(core) > k)})


def slots(text: str | None) -> np.ndarray:
    """Sorted distinct slots of a text."""
    if not text:
        return np.zeros(0, np.int32)
    found = set(WORD.findall(text.lower()))
    if len(_memory) + len(found) > MEMORY:
        _memory.clear()
    out: set[int] = set()
    for w in found:
        if (got := _memory.get(w)) is None:
            got = _memory[w] = slots_of_word(w)
        out.update(got)
    return np.sort(np.fromiter(out, np.int32, len(out)))


class Machine:
    """A trained factorization machine over the kept slots."""

    def __init__(self, keep: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.place = np.zeros(DIMENSIONS, np.int32)
        self.place[keep] = np.arange(1, len(keep) + 1)
        self.bias = bias
        self.weights = np.concatenate([[0.0], weights])
        self.factors = np.vstack([np.zeros((1, factors.shape[1])), factors])

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        at = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) for r in rows], out=at[1:])
        place = self.place[np.concatenate(rows)] if at[-1] else np.zeros(0, np.int32)
        raw = margin(place, at, self.bias, self.weights, self.factors)[0]
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def margin(place, at, bias, weights, factors):
    """Scores before the sigmoid, with the sums of factors; place 0 is no term."""
    sums = np.zeros((len(at) - 1, factors.shape[1]))
    squares, linear = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
    if (full := np.flatnonzero(np.diff(at))).size:
        begin = at[full]
        linear[full] = np.add.reduceat(weights[place], begin)
        squares[full] = np.add.reduceat((factors * factors).sum(1)[place], begin)
        for f in range(factors.shape[1]):
            sums[full, f] = np.add.reduceat(np.ascontiguousarray(factors[:, f])[place], begin)
    return bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Slots in MIN_ROWS training rows at least whose tie to the label is beyond chance (likelihood ratio G2)."""
    counts = [sum((np.bincount(r, minlength=DIMENSIONS) for r in _joined(rows, labels == y)), np.zeros(DIMENSIONS, np.int64)) for y in (0, 1)]
    total = [(labels == 0).sum(), (labels == 1).sum()]
    n, both = sum(total), counts[0] + counts[1]
    g2 = np.zeros(DIMENSIONS)
    for y in (0, 1):
        for seen, column in ((counts[y], both), (total[y] - counts[y], n - both)):
            expected = column * (total[y] / n)
            g2 += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0)
    return np.flatnonzero((both >= MIN_ROWS) & (g2 >= MIN_G2))


def held_by(rows: list[np.ndarray]) -> np.ndarray:
    """Training rows that have each slot."""
    everyone = np.ones(len(rows), bool)
    return sum((np.bincount(r, minlength=DIMENSIONS) for r in _joined(rows, everyone)), np.zeros(DIMENSIONS, np.int64))


def _joined(rows, chosen, size=2000):
    picked = [r for r, c in zip(rows, chosen, strict=True) if c]
    for lo in range(0, len(picked), size):
        yield np.concatenate(picked[lo : lo + size])


def train(rows: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 0) -> Machine:
    """Fit by AdaGrad on the logistic loss, both labels of equal total weight."""
    held = held_by(rows)
    keep = np.flatnonzero(held >= MIN_ROWS)
    trust = np.concatenate([[0.0], np.where(np.isin(keep, telling(rows, labels)), 1.0, np.minimum(held[keep] / (OFTEN * len(rows)), 1.0))])
    rate_w, rate_v = (b + (a - b) * trust for a, b in zip(RATES, NEUTRAL_RATES, strict=True))
    place_of = np.zeros(DIMENSIONS, np.int32)
    place_of[keep] = np.arange(1, len(keep) + 1)
    kept = [p[p > 0] for p in (place_of[r] for r in rows)]
    rng = np.random.default_rng(seed)
    k = len(keep) + 1
    w, v, bias = np.zeros(k), rng.normal(0, 0.001, (k, factors)), 0.0
    v[0] = 0
    gw, gv, gb = np.full(k, 1e-6), np.full((k, factors), 1e-6), 1e-6
    here, number = np.zeros(k, bool), np.zeros(k, np.int64)
    positive = max(1, int(labels.sum()))
    weight = np.where(labels == 1, 0.5 * len(labels) / positive, 0.5 * len(labels) / max(1, len(labels) - positive))
    weight = np.minimum(weight, 20)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 64):
            part = order[lo : lo + 64]
            at = np.zeros(len(part) + 1, np.int64)
            np.cumsum([len(kept[i]) for i in part], out=at[1:])
            place = np.concatenate([kept[i] for i in part])
            # the batch's own slots, numbered in ascending order without a sort
            here[place] = True
            u = np.flatnonzero(here)
            here[u] = False
            number[u] = np.arange(len(u))
            inv = number[place]
            vu = v[u]
            raw, sums = margin(inv, at, bias, w[u], vu)
            err = weight[part] * (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[part])
            total = np.bincount(inv, np.repeat(err, np.diff(at)), len(u))
            dw = total + 1e-4 * w[u]
            # of a slot, the sum of err * (sums of the text - own factors) over its texts
            dv = (1e-3 - total)[:, None] * vu
            for f in range(factors):
                dv[:, f] += np.bincount(inv, np.repeat(err * sums[:, f], np.diff(at)), len(u))
            gw[u] += dw * dw
            gv[u] += dv * dv
            gb += err.sum() ** 2
            w[u] -= rate_w[u] * dw / np.sqrt(gw[u])
            v[u] -= rate_v[u, None] * dv / np.sqrt(gv[u])
            bias -= 0.2 * err.sum() / np.sqrt(gb)
            w[0], v[0] = 0, 0
    return Machine(keep, bias, w[1:], v[1:])


def remainder(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int):
    """(slots, label) of the bounded training sample."""
    usable = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (remainder(id_col) != 1))
        .groupBy(F.col(id_col).alias("doc")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc"), "doc").limit(max_rows)
    )

    def featurise(batches):
        for batch in batches:
            found = [slots(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["slots", "label"])

    # the sample has at most max_rows rows, so this broadcast is bounded
    picked = bounded(docs).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(F.broadcast(usable), "doc")
    got = picked.select("text", "label").mapInArrow(featurise, "slots array<int>, label int").toArrow().combine_chunks()
    if not got.num_rows:
        return [], np.zeros(0)
    lists = got.column(0).combine_chunks() if isinstance(got.column(0), pa.ChunkedArray) else got.column(0)
    values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    rows = [values[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
    marks = got.column(1).to_numpy().astype(float)
    # row order must not depend on the cluster: by content
    order = sorted(range(len(rows)), key=lambda i: (len(rows[i]), rows[i].tobytes(), marks[i]))
    return [rows[i] for i in order], marks[order]


def fit(docs, labels, id_col="doc_id", text_col="text", label_col="toxic", max_rows=MAX_ROWS) -> Machine:
    rows, marks = training_rows(docs, labels, id_col, text_col, label_col, max_rows)
    if not len(marks) or not marks.any():
        return Machine(np.zeros(0, np.int64), -40.0, np.zeros(0), np.zeros((0, FACTORS)))
    return train(rows, marks)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id_col, held_out, score, predicted for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most DIMENSIONS slots

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                s = m.scores([slots(t) for t in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    names=[id_col, "held_out", "score", "predicted"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    held_out = F.coalesce(remainder(id_col) == 1, F.lit(False)).alias("held_out")
    return bounded(docs).select(F.col(id_col), held_out, F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, as they are, whose text scores below the threshold."""
    bounded(docs)
    shared, at = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield part.filter(pa.array(m.scores([slots(t) for t in part.column(at).to_pylist()]) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document scored by a machine trained on this table's labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(docs, labels))
