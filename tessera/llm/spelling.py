"""Spelling variants: words of a vocabulary at edit distance one, by a trie joined with itself.

**Vocabulary.** Words are maximal runs of Latin letters, counted over all texts. Runs of each batch are
hashed and counted as numpy arrays; Spark adds the counts up by word.

**Trie self-join.** Two words at distance one with five code points or more agree in their first two code points,
or in their last two. So each word stands in two tries, of the words and of the words read backwards, both
partitioned by a prefix of two code points; the second one emits only pairs whose first two differ, so no pair comes
twice. A task walks its tries level by level, all nodes of a level as numpy arrays. The active nodes
of a node are itself, nodes of its level that differ by one replaced code point, and nodes one level
deeper that have one more: siblings enter the first set, children (and from there on siblings' children) the
second, and both go down wherever the two nodes have children of the same code point. Where both nodes are
ends of words, the pair is emitted. A node with one word and no active node but itself is not followed.

**Hot prefixes.** A prefix shared by more than a 4,096th of the words (and by more than ``GROUP_WORDS``) is split into
its children, again and again. What a split parts are pairs whose edit is right behind that prefix: from there on
the active nodes' distance is used up, so the rest of both words is equal, and the pair meets by one key (prefix, rest)
in a shuffle; a key has one word for each letter of the alphabet at most.

**Forms.** A word's form is its near word of largest count, if that is twice its own or more; roots follow
forms to the last one by pointer jumping over written tables (a chain doubles its count with each step, so there are few rounds).

Results for special inputs: null texts have no words; a null id counts as an empty one; repeated rows count as
often as they stand; ties of count go to the smallest word in code-point order; words of fewer than five code
points have no near words (the tries do not cover them, and asking for fewer raises ValueError); an empty
table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import scan
from tessera.llm.shared import Written, bounded

MIN_CHARS = 5
MIN_COUNT = 3
#: Code points that a trie's root stands for: with MIN_CHARS >= 2 * HEAD + 1, each pair agrees in the first or the last HEAD.
HEAD = 2
#: Words of a prefix up to which it is never split, and the part of all words (one in ...) above which it always is.
GROUP_WORDS = 5_000
GROUPS = 4_096
#: One run in so many loses a code point.
SLIP = 97

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of the bytes [start, end) of each word, carried on from `before`."""
    state = before ^ np.uint32(0xFFFFFFFF)
    live, at = np.arange(len(start)), start
    while True:
        more = at < end[live]
        live, at = live[more], at[more]
        if not len(live):
            return state ^ np.uint32(0xFFFFFFFF)
        s = state[live]
        state[live] = _CRC[(s ^ data[at]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        at = at + 1


def runs(data: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the maximal runs of [A-Za-z\\u00C0-\\u00FF] in texts that begin at the offsets `text`.

    U+00C0 to U+00FF are the byte C3 and the one after it; no other code point has that byte first.
    """
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == 0xC3
    before, after = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    before[1:], after[:-1] = ~letter, ~letter
    before[text], after[text] = True, True
    return np.flatnonzero(letter & before[:-1]), np.flatnonzero(letter & after[1:]) + 1


def counted(data: np.ndarray, text: np.ndarray, ids: list, min_chars: int, slip: int) -> pa.RecordBatch:
    """(word, n) of a slice: its runs, lower-cased, some without a code point, that keep min_chars code points."""
    data = scan._LOWER[data]
    start, end = runs(data, text)
    row = np.searchsorted(text, start, "right") - 1
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    chars = heads[end] - heads[start]
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = crc32(data, start, end, prefix[row])
    slipped = np.flatnonzero(h % slip == 0)
    shorter = []
    for k in slipped[chars[slipped] > min_chars].tolist():
        word = data[start[k] : end[k]].tobytes().decode()
        at = int(h[k]) % len(word)
        shorter.append(word[:at] + word[at + 1 :])
    whole = chars >= min_chars
    whole[slipped] = False
    start, end = start[whole], end[whole]
    _, first, n = np.unique(scan.hashes(data, start, end), return_index=True, return_counts=True)
    words = pa.concat_arrays([scan.gathered(data, start[first], end[first]), pa.array(shorter, pa.string())])
    return pa.RecordBatch.from_arrays([words, pa.array(np.concatenate([n, np.ones(len(shorter), np.int64)]))], names=["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of all texts with their counts."""

    def count(batches):
        for batch in batches:
            at, data = scan.texts(batch.column(1))
            ids, row = batch.column(0).to_pylist(), 0
            while row < len(ids):
                n = max(1, int(np.searchsorted(at, at[row] + 8 * scan.SLICE, "right")) - 1 - row)
                yield counted(data[at[row] : at[row + n]], at[row : row + n] - at[row], ids[row : row + n], min_chars, slip)
                row += n

    texts = bounded(docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")))
    found = texts.filter("text is not null").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def hot_prefixes(sides: DataFrame, limit: int) -> set[tuple[bool, str]]:
    """(back, prefix) of all prefixes that more than `limit` words share, found depth by depth.

    A depth has at most as many as GROUPS in each direction, as `limit` is a GROUPS-th of the words or more.
    """
    found, depth = set(), HEAD
    live = sides
    while True:
        counts = live.groupBy("back", F.substring("s", 1, depth).alias("prefix"), (F.length("s") >= depth).alias("full")).count()
        new = [(r.back, r.prefix) for r in counts.filter(F.col("full") & (F.col("count") > limit)).collect()]
        if not new:
            return found
        found |= set(new)
        hot = sides.sparkSession.createDataFrame(new, "back boolean, prefix string")
        depth += 1
        live = sides.join(F.broadcast(hot), (sides.back == hot.back) & (F.substring(sides.s, 1, depth - 1) == hot.prefix), "left_semi")


def ragged(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 0, 3): owners (0, 0, 2, 2, 2) and places (0, 1, 0, 1, 2)."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


class Level:
    """Nodes of one depth: parent, code point, and where each parent's children begin."""

    def __init__(self, parent: np.ndarray, char: np.ndarray, parents: int):
        self.parent, self.char = parent, char
        self.first = np.searchsorted(parent, np.arange(parents + 1))
        self.key = parent << 21 | char

    def children(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner, place = ragged(self.first[node + 1] - self.first[node])
        return owner, self.first[node][owner] + place

    def child(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The child of node by char, or -1."""
        key = node << 21 | char
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == key, at, -1) if len(self.key) else np.full(len(node), -1)


def trie_pairs(words: list[str], root: np.ndarray, depth: np.ndarray):
    """Index pairs of distinct words at distance one under each root.

    words are sorted by root and then by code points; root numbers the tries, depth tells how many code
    points each word's root stands for.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size) - size
    live, node, at = np.arange(len(words)), root.astype(np.int64), depth.astype(np.int64)
    nodes = int(root[-1]) + 1
    ends = np.full(nodes, -1)
    done = at[live] == size[live]
    ends[node[done]] = live[done]
    none = np.zeros(0, np.int64)
    same = (none, none)  # nodes of this level that differ by one code point
    more = (none, none)  # a node of the level before, and one of this level that has a code point more
    fresh = none  # nodes of this level that are more than their parents by their last code point alone
    before = None
    while len(live):
        on = at[live] < size[live]
        live, node = live[on], node[on]
        char = codes[begin[live] + at[live]]
        new = np.ones(len(live), bool)
        new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
        level = Level(node[new], char[new], nodes)
        here = np.cumsum(new) - 1
        count = len(level.char)
        at[live] += 1
        end = np.full(count, -1)
        done = at[live] == size[live]
        end[here[done]] = live[done]

        owner, x = level.children(same[0])
        y = level.child(same[1][owner], level.char[x])
        old = (x[y >= 0], y[y >= 0])
        left = level.first[level.parent + 1] - np.arange(count) - 1
        x, place = ragged(left)
        same_next = (np.concatenate([old[0], x]), np.concatenate([old[1], x + 1 + place]))

        if before is None:
            grown = (none, none)
        else:
            owner, x = before.children(more[0])
            y = level.child(more[1][owner], before.char[x])
            grown = (x[y >= 0], y[y >= 0])
            owner, x = before.children(before.parent[fresh])
            other = x != fresh[owner]
            owner, x = owner[other], x[other]
            y = level.child(fresh[owner], before.char[x])
            grown = (np.concatenate([grown[0], x[y >= 0]]), np.concatenate([grown[1], y[y >= 0]]))

        for x, y in ((end[same_next[0]], end[same_next[1]]), (ends[grown[0]], end[grown[1]]), (ends[level.parent], end)):
            met = (x >= 0) & (y >= 0)
            if met.any():
                yield x[met], y[met]

        follow = np.bincount(here, minlength=count) > 1
        for part in (*same_next, grown[1]):
            follow[part] = True
        follow |= level.first[level.parent + 1] - level.first[level.parent] > 1
        shorter = np.zeros(nodes, bool)
        shorter[grown[0]] = True
        follow |= shorter[level.parent]
        same, more, fresh = same_next, grown, np.arange(count)
        before, ends, nodes = level, end, count
        stay = follow[here]
        live, node = live[stay], here[stay]


def joined(batches, head: int = HEAD):
    """(words, counts, x, y) of sorted rows (back, root, s, n): index pairs at distance one of each stretch of whole tries."""

    def tables():
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
            roots = rows.column("root").to_pylist()
            cut = len(roots) - 1
            while cut > 0 and roots[cut - 1] == roots[-1]:
                cut -= 1
            if cut:
                yield rows.slice(0, cut)
            held = rows.slice(cut)
        if held is not None:
            yield held

    for rows in tables():
        back, root = (rows.column(k).to_numpy() for k in ("back", "root"))
        words, n = rows.column("s").to_pylist(), rows.column("n").to_numpy()
        new = np.ones(len(words), bool)
        new[1:] = (root[1:] != root[:-1]) | (back[1:] != back[:-1])
        depth = np.fromiter(map(len, root), np.int64, len(words))
        own = [w[::-1] if b else w for w, b in zip(words, back.tolist())]
        heads = np.array([w[:head] for w in own])
        for x, y in trie_pairs(words, np.cumsum(new) - 1, depth):
            keep = ~back[x].astype(bool) | (heads[x] != heads[y])
            yield own, n, x[keep], y[keep]


def _sides(words: DataFrame) -> DataFrame:
    two = F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("s")), F.struct(F.lit(True).alias("back"), F.reverse("word").alias("s")))
    return words.select("word", "n", F.explode(two).alias("t")).select("t.back", "t.s", "word", "n")


def _placed(sides: DataFrame, hot: set[tuple[bool, str]]) -> DataFrame:
    """Each word's trie (kind 0), and its keys at the hot prefixes that part it: cut (1) without the code point there, whole (2)."""
    shared = sides.sparkSession.sparkContext.broadcast(hot)

    def place(batches):
        hot = shared.value
        for batch in batches:
            out = {k: [] for k in ("kind", "back", "root", "s", "n", "depth")}
            for back, s, n in zip(*(batch.column(k).to_pylist() for k in ("back", "s", "n"))):
                rows, depth = [], HEAD
                while depth <= len(s) and (back, s[:depth]) in hot:
                    rows.append((2, f"{depth} {s}", depth))
                    if depth < len(s):
                        rows.append((1, f"{depth} {s[:depth]}{s[depth + 1 :]}", depth))
                    depth += 1
                if depth <= len(s):
                    rows.append((0, s[:depth], depth))
                for kind, root, at in rows:
                    for k, v in zip(out, (kind, back, root, s, n, at)):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("kind", pa.int32()), ("back", pa.bool_()), ("root", pa.string()), ("s", pa.string()), ("n", pa.int64()), ("depth", pa.int32())]))

    return sides.mapInArrow(place, "kind int, back boolean, root string, s string, n long, depth int")


def _parted(placed: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs whose edit is right behind a hot prefix, a's key being a whole word or the smaller cut one."""
    own = F.when(F.col("back"), F.reverse("s")).otherwise(F.col("s"))
    keys = placed.filter("kind > 0").select("kind", "back", "root", "depth", own.alias("word"), "n", F.expr("substring(s, depth + 1, 1)").alias("char"))
    a, b = (keys.select("back", "root", *[F.col(c).alias(f"{k}_{c}") for c in ("kind", "word", "n", "char")]) for k in "ab")
    met = a.join(b.filter("b_kind = 1"), ["back", "root"]).filter("a_char <> b_char and (a_kind = 2 or a_word < b_word)")
    met = met.filter(~F.col("back") | (F.substring("a_word", 1, HEAD) != F.substring("b_word", 1, HEAD)))
    return met.select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")


def _tries(words: DataFrame, written: Written, group_words: int) -> tuple[DataFrame, DataFrame]:
    """The words' tries, sorted by prefix within partitions, and the pairs that hot prefixes part."""
    words = words.select("word", "n").filter("word is not null")
    sizes = words.agg(F.count("*").alias("n"), F.min(F.length("word")).alias("least")).first()
    if sizes.n and sizes.least < 2 * HEAD + 1:
        raise ValueError(f"words of fewer than {2 * HEAD + 1} code points")
    hot = hot_prefixes(_sides(words), max(group_words, -(-sizes.n // GROUPS)))
    placed = bounded(_placed(_sides(words), hot))
    if hot:
        placed = written.save(placed, "placed")
    tries = placed.filter("kind = 0").select("back", "root", "s", "n").repartition("back", "root").sortWithinPartitions("back", "root", "s")
    return tries, _parted(placed) if hot else None


def near_pairs(words: DataFrame, written: Written | None = None, group_words: int = GROUP_WORDS) -> DataFrame:
    """(a, b), a < b: all pairs of words (word, n) that differ by exactly one inserted, deleted or replaced code point."""
    written = written or Written(words.sparkSession)
    tries, parted = _tries(words, written, group_words)

    def pairs(batches):
        for own, _, x, y in joined(batches):
            yield pa.RecordBatch.from_pydict({"a": pa.array([own[k] for k in x.tolist()], pa.string()), "b": pa.array([own[k] for k in y.tolist()], pa.string())})

    found = tries.mapInArrow(pairs, "a string, b string")
    if parted is not None:
        found = found.unionAll(parted.select("a", "b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def nearest(words: DataFrame, written: Written | None = None, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best_n, best): for each word with near ones their number, and the one of largest n (ties: the smallest).

    A task adds up its own tries' pairs, so at most one row of a word leaves it for each stretch of tries.
    """
    written = written or Written(words.sparkSession)
    tries, parted = _tries(words, written, group_words)

    def summed(batches):
        own, counts, met = None, None, []

        def told():
            x, y = (np.concatenate([p[k] for p in met] + [p[1 - k] for p in met]) for k in (0, 1))
            rank = np.empty(len(own), np.int64)
            rank[sorted(range(len(own)), key=own.__getitem__)] = np.arange(len(own))
            order = np.lexsort((rank[y], -counts[y], x))
            x, y = x[order], y[order]
            first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            near = np.diff(np.append(first, len(x)))
            return pa.RecordBatch.from_pydict({
                "word": pa.array([own[k] for k in x[first].tolist()], pa.string()), "n_near": pa.array(near, pa.int64()),
                "best_n": pa.array(counts[y[first]], pa.int64()), "best": pa.array([own[k] for k in y[first].tolist()], pa.string()),
            })

        for words_, n, x, y in joined(batches):
            if own is not words_ and met:
                yield told()
                met = []
            own, counts = words_, n
            if len(x):
                met.append((x, y))
        if met:
            yield told()

    found = tries.mapInArrow(summed, "word string, n_near long, best_n long, best string")
    if parted is not None:
        one = F.lit(1).cast("long").alias("n_near")
        found = found.unionAll(parted.select(F.col("a").alias("word"), one, F.col("b_n").alias("best_n"), F.col("b").alias("best")))
        found = found.unionAll(parted.select(F.col("b").alias("word"), one, F.col("a_n").alias("best_n"), F.col("a").alias("best")))
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best"))).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame, written: Written) -> DataFrame:
    """(word, root) of rows (word, form): forms followed to the last word."""
    now = written.save(forms.filter("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = written.save(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        written.drop(now)
        if new.filter("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")
        now.written_at = new.written_at


def groups(words: DataFrame, written: Written | None = None, factor: int = 2, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n): variants told by their near words of larger count."""
    written = written or Written(words.sparkSession)
    words = written.save(words.select("word", "n"), "vocabulary")
    is_form = F.col("best_n") >= factor * F.col("n")
    rows = words.join(nearest(words, written, group_words), "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    rows = written.save(rows, "near")
    return rows.join(roots(rows, written), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of documents."""
    return groups(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))
