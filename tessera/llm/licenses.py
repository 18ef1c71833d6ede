"""License scans: MinHash bands over overlapping windows retrieve templates, shingles verify them.

Words are runs of ASCII letters and digits or of other non-ASCII characters, in lower case. A
place of a template of L words has at most 2L words (a notice with words put in), and holds
``CONTAINED`` of its shingles. Windows begin every `step` words (a power of two, L / 4 at
most) and are so long that each such place lies wholly in one.

Every template is filed under the values of its bands; a band is the least hashes of the template's
shingles by ROWS functions. The bands of each window are looked up there, and a template with a
common band is a candidate. A window of W shingles that holds ``CONTAINED`` of a template's S
has a Jaccard similarity of at least j = need / (W + S - need) with it, so some band agrees with a
probability of 1 - (1 - j ** rows) ** bands; each group of templates has as many bands as bring
that to ``GUARANTEE``, of one row for short templates and of two rows for long ones. A
template that is one shingle has windows of that length, and one band.

Candidates are then verified exactly: the share of the template's distinct shingles in the window
must be ``CONTAINED`` or more. The hits of such windows are split into places: runs in the
template's order first, then what is left in any order.

Shingles have five words; a template with fewer words is one shingle of all its words.

Results for special inputs: null or empty texts have no rows; a template that stands several
times in a text gives a row for each place; repeated rows give repeated results; an empty table
gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import bisect
import math
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import scan
from tessera.llm.license_texts import TEMPLATES
from tessera.llm.shared import bounded

SHINGLE = 5
CONTAINED = (4, 5)
GUARANTEE = 1 - 5e-7
#: Words of a template from which its bands have two rows.
LONG = 32

SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
NOTHING = np.uint32(0xFFFFFFFF)


def _hashes(texts: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for w in scan.words(pa.array(texts, pa.string()), lower=True, white=SEPARATORS):
        out += [w.hash[a:b] for a, b in zip(w.first, w.first[1:], strict=False)]
    return out


@lru_cache(maxsize=4096)
def seeds(k: int) -> tuple[np.uint32, np.uint32]:
    a, b = scan.mix(np.arange(2, dtype=np.uint64), 1000 + k) >> np.uint64(32)
    return np.uint32(a), np.uint32(b | np.uint64(1))


def function(k: int, short: np.ndarray) -> np.ndarray:
    """Values of hash function k on 32-bit shingles."""
    a, b = seeds(k)
    return (short ^ a) * b


def least(blocks: np.ndarray, n: int) -> np.ndarray:
    """Least value of each n blocks in a row."""
    m, p = blocks, 1
    while 2 * p <= n:
        m, p = np.minimum(m[:-p], m[p:]), 2 * p
    return np.minimum(m[: len(blocks) - n + 1], m[n - p :]) if n > p else m


def shorten(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32)


class Group:
    """Templates whose windows have the same shingle size, step and number of steps."""

    def __init__(self, size: int, step: int, steps: int, rows: int):
        self.size, self.step, self.steps, self.rows, self.bands = size, step, steps, rows, 1
        self.names: list[str] = []
        self.shingles: list[np.ndarray] = []
        self.needs: list[int] = []

    def add(self, name: str, shingles: np.ndarray, need: int) -> None:
        self.names.append(name)
        self.shingles.append(shingles)
        self.needs.append(need)
        j = self.similarity(-1)
        self.bands = max(self.bands, 1 if j == 1 else math.ceil(math.log(1 - GUARANTEE) / math.log(1 - j**self.rows)))

    def similarity(self, k: int) -> float:
        """Least Jaccard similarity of template k and a window that holds enough of it."""
        return self.needs[k] / (self.step * self.steps + len(self.shingles[k]) - self.needs[k])

    def file(self) -> None:
        """The index: for each band its values in order, the templates that have them, and a quick first test."""
        self.index, self.heads = [], []
        short = [shorten(s) for s in self.shingles]
        for b in range(self.bands):
            mins = [[function(b * self.rows + r, s).min(keepdims=True) for r in range(self.rows)] for s in short]
            keys, heads = np.array([self.key(m)[0] for m in mins], np.uint64), np.array([m[0][0] for m in mins], np.uint32)
            order = np.argsort(keys, kind="stable")
            low = np.zeros(1 << 16, bool)
            low[(heads & np.uint32(0xFFFF)).astype(np.intp)] = True
            self.index.append((keys[order], order, low))
            self.heads.append(np.unique(heads))

    def lookup(self, band: int, values: list[np.ndarray]):
        """(windows, templates) that have the same value of a band."""
        keys, templates, low = self.index[band]
        if len(keys) <= 4:  # a first test by the first row
            at = np.flatnonzero(np.logical_or.reduce([values[0] == x for x in self.heads[band]]))
        else:
            at = np.flatnonzero(low[(values[0] & np.uint32(0xFFFF)).astype(np.intp)])
        if not len(at):
            return
        found = self.key([v[at] for v in values])
        for x in np.intersect1d(found, keys).tolist():
            yield at[found == np.uint64(x)].tolist(), templates[keys == np.uint64(x)].tolist()

    def key(self, values: list[np.ndarray]) -> np.ndarray:
        out = values[0].astype(np.uint64)
        for v in values[1:]:
            out = out * scan.ODD + v
        return out ^ out >> np.uint64(29)


class Index:
    """Templates by the values of their bands."""

    def __init__(self, templates: dict[str, str]):
        self.orders: dict[str, dict[int, list[int]]] = {}  # where each shingle stands in its template
        self.lengths: dict[str, int] = {}
        groups: dict[tuple, Group] = {}
        for (name, _), h in zip(templates.items(), _hashes(list(templates.values())), strict=True):
            if not len(h):
                continue
            size, length = min(SHINGLE, len(h)), len(h)
            runs = scan.runs(h, size)
            shingles = np.unique(runs)
            self.lengths[name] = length
            order = self.orders.setdefault(name, {})
            for i, x in enumerate(runs.tolist()):
                order.setdefault(x, []).append(i)
            need = -(-len(shingles) * CONTAINED[0] // CONTAINED[1])
            step = 1 << max(0, (length // 4).bit_length() - 1)
            steps = -(-(2 * length - size + step) // step)
            if need == 1:  # a place is the shingle itself
                step = steps = 1
            key = (size, step, steps, 2 if length >= LONG else 1)
            groups.setdefault(key, Group(*key)).add(name, shingles, need)
        self.groups = list(groups.values())
        for g in self.groups:
            g.file()

    def guaranteed(self) -> dict[str, float]:
        """Probability that some band brings a window with enough of a template to it."""
        return {name: 1 - (1 - g.similarity(k) ** g.rows) ** g.bands for g in self.groups for k, name in enumerate(g.names)}

    def candidates(self, size: int, h: np.ndarray) -> dict[Group, set[tuple[int, int]]]:
        """(window, template) pairs with a common band, for the groups of a shingle size; h: shingles, 0 for none."""
        groups = [g for g in self.groups if g.size == size]
        # beyond the end stands nothing, so that windows there are whole
        tail = np.full(max((g.step * g.steps for g in groups), default=0), NOTHING)
        short, none = shorten(h), np.flatnonzero(h == 0)
        out: dict[Group, set[tuple[int, int]]] = {g: set() for g in groups}
        values: dict[Group, list[np.ndarray]] = {g: [] for g in groups}
        for k in range(max((g.rows * g.bands for g in groups), default=0)):
            own = np.append(function(k, short), tail)
            own[none] = NOTHING
            wanted = sorted((g for g in groups if k < g.rows * g.bands), key=lambda g: g.step)
            step = 1
            for g in wanted:
                while step < g.step:
                    own = np.append(own, NOTHING) if len(own) % 2 else own
                    own, step = np.minimum(own[::2], own[1::2]), 2 * step
                values[g].append(least(own, g.steps))
                if len(values[g]) < g.rows:
                    continue
                found, values[g] = values[g], []
                for at, templates in g.lookup(k // g.rows, found):
                    out[g].update((i, t) for i in at for t in templates)
        return out


def _apart(found: list, kept: list) -> None:
    """Adds to kept (first word, end, share) those of found that overlap none: most of the template, then shortest, then first."""
    for a, b, c in sorted(found, key=lambda x: (-x[2], x[1] - x[0], x[0])):
        i = bisect.bisect_left(kept, (a, b, c))
        if (i == 0 or kept[i - 1][1] <= a) and (i == len(kept) or b <= kept[i][0]):
            kept.insert(i, (a, b, c))


def places(at: list[int], shingles: list[int], order: dict[int, list[int]], length: int, size: int) -> list[tuple[float, int, int]]:
    """(share, first word, end) of the places of a template, given where its shingles stand in a text.

    First the runs of shingles in the template's order, so that each of several copies side by side
    is a place; then, of what no such place covers, the spans with most of the template in any order.
    No place has more than 2 * length words.
    """
    enough = lambda n: n * CONTAINED[1] >= len(order) * CONTAINED[0]
    runs: list = []
    last = 0
    for p, x in zip(at, shingles, strict=True):
        later = [i for i in order[x] if i > last]
        if runs and later and p + size - runs[-1][0] <= 2 * length:
            last = later[0]
            runs[-1][1] = p + size
            runs[-1][2].add(x)
        else:
            last = order[x][0]
            runs.append([p, p + size, {x}])
    kept: list = []
    _apart([(a, b, len(own) / len(order)) for a, b, own in runs if enough(len(own))], kept)
    taken, k, rest = list(kept), 0, [[]]
    for p, x in zip(at, shingles, strict=True):
        while k < len(taken) and taken[k][1] <= p:
            k += 1
            rest.append([])
        if k == len(taken) or p + size <= taken[k][0]:
            rest[-1].append((p, x))
    for part in rest:
        spans = []
        for i, (p, _) in enumerate(part):
            own: set = set()
            for q, x in part[i:]:
                if q + size - p > 2 * length:
                    break
                if x not in own:
                    own.add(x)
                    if enough(len(own)):
                        spans.append((p, q + size, len(own) / len(order)))
        _apart(spans, kept)
    return [(c, a, b) for a, b, c in kept]


def matches(w: scan.Words, index: Index):
    """(row, template, contained, start word, end word) in a slice."""
    rows = w.row_of
    for size in sorted({g.size for g in index.groups}):
        h = np.maximum(scan.runs(w.hash, size), np.uint64(1))
        h[rows[: len(h)] != rows[size - 1 :][: len(h)]] = 0  # a run over two texts is none
        for g, found in index.candidates(size, h).items():
            hits: dict = defaultdict(set)
            for window, t in sorted(found):
                name, begin = g.names[t], window * g.step
                order = index.orders[name]
                own = [(begin + i, x) for i, x in enumerate(h[begin : begin + g.step * g.steps].tolist()) if x in order]
                for r in {int(rows[p]) for p, _ in own}:
                    if len({x for p, x in own if rows[p] == r}) >= g.needs[t]:
                        hits[r, name].update(p for p, _ in own if rows[p] == r)
            for (r, name), at in hits.items():
                places_ = sorted(at)
                for c, a, b in places(places_, h[places_].tolist(), index.orders[name], index.lengths[name], size):
                    yield r, name, c, a, b


@lru_cache(maxsize=2)
def loaded(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(dict(templates))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, license, contained, start, end (character offsets) of each place of a template."""
    templates = TEMPLATES if templates is None else templates
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        index = loaded(tuple(templates.items()))
        for batch in batches:
            for w in scan.words(batch.column(1), lower=True, white=SEPARATORS):
                found = list(matches(w, index))
                if not found:
                    continue
                point = np.zeros(len(w.data) + 1, np.int64)
                np.cumsum((w.data & 0xC0) != 0x80, out=point[1:])
                row = np.array([f[0] for f in found])
                base = point[w.text[row]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.row, w.n).take(pa.array(row)),
                        pa.array([f[1] for f in found]),
                        pa.array([f[2] for f in found]),
                        pa.array(point[w.start[[f[3] for f in found]]] - base),
                        pa.array(point[w.end[[f[4] - 1 for f in found]]] - base),
                    ],
                    names=[id_col, "license", "contained", "start", "end"],
                )

    return bounded(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, license string, contained double, start long, end long")


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    """All places of license notices in the documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
