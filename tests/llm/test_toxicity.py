import random
import zlib

import numpy as np

from tessera.llm import toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def made(n, pairwise=False):
    """Texts whose label is an insult, or (pairwise) an odd combination of two terms."""
    r = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(15)]
        a, b = r.random() < 0.5, r.random() < 0.5
        words += ["groupname"] * a + ["mildinsult"] * b
        if pairwise:
            y = int(a and b) if r.random() < 0.99 else 0
        else:
            y = int(a)
        r.shuffle(words)
        docs.append((i, " ".join(words).title()))
        labels.append((i, y))
    return docs, labels


def test_gradient_like_brute_force():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=6), rng.normal(size=(6, 3))
    rows = [np.array([1, 3, 5]), np.array([], int), np.array([2])]
    at = np.array([0, 3, 3, 4])
    got = toxicity.margin(np.concatenate(rows).astype(int), at, 0.5, w, v)[0]
    for r, g in zip(rows, got, strict=True):
        want = 0.5 + w[r].sum() + sum(v[r[i]] @ v[r[j]] for i in range(len(r)) for j in range(i))
        assert abs(g - want) < 1e-9


def test_learns_pairs():
    docs, labels = made(3000, pairwise=True)
    rows, y = [toxicity.slots(t) for _, t in docs], np.array([v for _, v in labels], float)
    m = toxicity.train(rows[:2000], y[:2000])
    p = m.scores(rows[2000:]) >= 0.7
    assert (p == (y[2000:] == 1)).mean() > 0.95


def test_query_is_accurate_on_held_out_rows(spark):
    docs, labels = made(900)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(df, toxicity.fit(df, lab)).collect()}
    assert len(out) == 900
    truth = dict(labels)
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in out.items())
    right = [r.predicted == truth[i] for i, r in out.items() if r.held_out]
    assert sum(right) / len(right) > 0.97
    # labels of held-out rows change nothing
    other = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, y in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.score(df, toxicity.fit(df, other)).collect()}
    assert all(abs(again[i] - r.score) < 1e-12 for i, r in out.items())
    clean = toxicity.keep_clean(df, toxicity.fit(df, lab))
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in out.items() if not r.predicted}


def test_special_inputs(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "", "b"), (3, "word " * 50000, "c"), (4, "!!! ...", "d")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
        assert [r.held_out for r in out if r.doc_id is None] == [False]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_query(spark):
    out = toxicity.op5_toxicity(spark, "/root/testdata/sf0.001")
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and out.count() == 200
