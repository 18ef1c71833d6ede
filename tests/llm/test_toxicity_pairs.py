import random

import numpy as np

from tessera.llm import toxicity


def test_learns_exclusive_or():
    """Neither term has a tie of its own to the label."""
    r = random.Random(1)
    rows, labels = [], []
    for _ in range(3000):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(15)]
        a, b = r.random() < 0.5, r.random() < 0.5
        rows.append(toxicity.slots(" ".join(words + ["groupname"] * a + ["mildinsult"] * b)))
        labels.append(float(a != b))
    y = np.array(labels)
    p = toxicity.train(rows[:2000], y[:2000]).scores(rows[2000:]) >= 0.5
    assert (p == (y[2000:] == 1)).mean() > 0.95
    additive = toxicity.train(rows[:2000], y[:2000], factors=0).scores(rows[2000:]) >= 0.5
    assert (additive == (y[2000:] == 1)).mean() < 0.6


def test_learns_a_pair_with_weak_ties_of_its_members():
    """One document in ten has the pair; each member alone is in three of ten clean ones."""
    r = random.Random(2)
    rows, labels = [], []
    for _ in range(4000):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(15)]
        kind = r.random()
        a, b = (True, True) if kind < 0.1 else (kind < 0.4, 0.4 <= kind < 0.7)
        rows.append(toxicity.slots(" ".join(words + ["groupname"] * a + ["mildinsult"] * b)))
        labels.append(float(a and b))
    y = np.array(labels)
    p = toxicity.train(rows[:3000], y[:3000]).scores(rows[3000:]) >= 0.7
    assert (p == (y[3000:] == 1)).mean() > 0.95


def test_held_out_rows_of_the_real_table(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [(r.predicted, truth[r.doc_id]) for r in toxicity.op5_toxicity(spark, sf).filter("held_out").collect() if r.doc_id in truth]
    assert len(out) > 1000
    assert sum(p == t for p, t in out) / len(out) > 0.975
    assert sum(t for p, t in out if p) / sum(p for p, _ in out) > 0.95
