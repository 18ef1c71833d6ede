import random
import re
from collections import defaultdict

import numpy as np

from tessera.llm import suffix_dedup


def brute(rows, m):
    """(id, start, end, words, is_first, first id) by all windows of m words."""
    places, spots = defaultdict(list), {}
    for i, t in rows:
        if i is None:
            continue
        spots[i] = [(x.start(), x.end()) for x in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        words = [t[a:b] for a, b in spots[i]]
        for p in range(len(words) - m + 1):
            places[tuple(words[p : p + m])].append((i, p))
    marks = defaultdict(dict)
    for found in places.values():
        found = sorted(set(found))
        if len(found) > 1:
            for i, p in found:
                before = any(j == i and q < p for j, q in found)
                marks[i, (i, p) == found[0]][p] = i if before else found[0][0]
    out = []
    for (i, first), ps in marks.items():
        group = []
        for p in [*sorted(ps), 10**9]:
            if group and p - group[-1] > m:
                out.append((i, spots[i][group[0]][0], spots[i][group[-1] + m - 1][1], group[-1] - group[0] + m, first, min(ps[g] for g in group)))
                group = []
            group.append(p)
    return sorted(out)


def run(spark, rows, m):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, suffix_dedup.spans(df, min_words=m, seed=m // 2).collect()))


def test_sliding():
    r = np.random.default_rng(1)
    for n in (0, 3, 10, 57):
        v = r.integers(0, 1000, n).astype(np.uint64)
        for s in (1, 4, 10):
            for f, g in ((np.minimum, min), (np.maximum, max)):
                assert suffix_dedup.sliding(v, s, f).tolist() == [g(v[i : i + s]) for i in range(n - s + 1)]


def test_random_passages(spark):
    r = random.Random(4)
    word = lambda: r.choice(["é", "b"]) * r.randint(1, 2) + str(r.randint(0, 60))
    passages = [[word() for _ in range(r.randint(8, 40))] for _ in range(12)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(r.randint(0, 5)):
            words += r.choice(passages)[r.randint(0, 3) :] if r.random() < 0.6 else [word() for _ in range(r.randint(1, 15))]
        rows.append((i, r.choice([" ", "\n", "  "]).join(words)))
    for m in (8, 10, 13):
        want = brute(rows, m)
        assert run(spark, rows, m) == want
    assert len(want) > 20


def test_special_inputs(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", 0)
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, "x " + text), (2, text + " y"), (2, text + " y"), (None, text), (3, None), (4, ""), (6, "z z z z " * 6000), (7, "short")]
    want = brute(rows, 10)
    got = run(spark, rows, 10)
    assert got == want
    df = spark.createDataFrame([(*r, "k", 7) for r in rows], "doc_id long, text string, start string, n_chars int")
    out = suffix_dedup.cut(df, min_words=10)
    assert out.schema.simpleString() == df.schema.simpleString()
    kept = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert kept[5] == ("x ", 2) and kept[2] == (text + " y", 7) and kept[3] == (None, 7) and kept[None] == (text, 7)
    assert out.count() == len(rows)
    assert suffix_dedup.spans(df.limit(0)).count() == 0 and suffix_dedup.cut(df.limit(0)).count() == 0


def test_neighbours_alone_would_miss(spark):
    """The middle row is nearest to both others in the order of suffixes; the outer two share a passage of their own."""
    seed = [f"s{i}" for i in range(5)]
    left, right = [f"l{i}" for i in range(6)], [f"r{i}" for i in range(6)]
    rows = [
        (1, " ".join(left + seed + right[:2] + ["x1", "y1"])),
        (2, " ".join(["q"] * 2 + left[-1:] + seed + right + ["x2"])),
        (3, " ".join(left + seed + right[:2] + ["x3", "y3"])),
        (4, " ".join(["p"] * 2 + left[-1:] + seed + right + ["x4"])),
    ]
    for m in (8, 10, 12):
        assert run(spark, rows, m) == brute(rows, m)


def test_an_id_with_two_texts(spark):
    text, other = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, text + " end"), (2, other), (2, other)], "doc_id long, text string")
    out = sorted(r.text for r in suffix_dedup.cut(df, min_words=10, length_col=None).collect())
    assert out == sorted([text, " end", other, other])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, suffix_dedup.op3_suffix_dedup(spark, sf).collect())) == brute(rows, 50)
