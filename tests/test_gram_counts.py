"""Gram counts by tasks and first contexts, against loops."""

import random
from collections import Counter, defaultdict

import pyarrow as pa

from tessera.operators import replacement, terms


def counted(rows, low, high):
    n, held = Counter(), defaultdict(set)
    for i, t in rows:
        for r in "".join(c if "a" <= c <= "z" else " " for c in t or "").split():
            if len(r) > 1:
                for k in range(low, high + 1):
                    for at in range(len(r) - k + 1):
                        n[r[at : at + k]] += 1
                        held[r[at : at + k]].add(i)
    return {(g, c, len(held[g])) for g, c in n.items()}


def test_gram_counts_of_ids_with_several_rows(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abc") for _ in range(r.choice([1, 2, 3, 7])))
    rows = [(i, None if i == 3 else " ".join(word() for _ in range(30))) for i in range(40)]
    once = spark.createDataFrame(rows + [(50, "a" * 300)], "i long, t string")
    assert {tuple(x) for x in terms.gram_stats(once, "i", "t", 2, 4, "[a-z]{2,}").collect()} == counted(rows + [(50, "a" * 300)], 2, 4)
    rows += [(5, "abc abc"), (5, "abc"), (6, None)]
    twice = spark.createDataFrame(rows, "i long, t string")
    assert {tuple(x) for x in terms.gram_stats(twice, "i", "t", 2, 4, "[a-z]{2,}").collect()} == counted(rows, 2, 4)


def test_a_task_counts_each_gram_once():
    """What a task deals out grows with its different grams, not with its texts; and it tells them early if they are many."""
    texts = pa.RecordBatch.from_arrays([pa.array([["abc", "abc"]] * 500, pa.list_(pa.string()))], names=["runs"])
    out = [x for b in terms._gram_counts(2, 3)([texts, texts]) for x in b.to_pylist()]
    assert sorted((x["gram"], x["n"], x["courses"]) for x in out) == [("ab", 2000, 1000), ("abc", 2000, 1000), ("bc", 2000, 1000)]


def test_early_counts_add_up(monkeypatch):
    monkeypatch.setattr(terms, "HELD_GRAMS", 4)
    monkeypatch.setattr(terms, "LONG_RUN", 5)
    r = random.Random(8)
    texts = [["".join(r.choice("abcd") for _ in range(r.choice([2, 4, 9]))) for _ in range(4)] for _ in range(60)]
    out, want = [x for b in terms._gram_counts(2, 3)([pa.RecordBatch.from_arrays([pa.array(texts)], names=["runs"])]) for x in b.to_pylist()], counted([(i, " ".join(t)) for i, t in enumerate(texts)], 2, 3)
    n, courses = Counter(), Counter()
    for x in out:
        n[x["gram"]] += x["n"]
        courses[x["gram"]] += x["courses"]
    assert len(out) > len(n) and {(g, n[g], courses[g]) for g in n} == want


def test_first_contexts_of_a_task_are_few(spark):
    """A task tells each form once, in its first text by order, also with nulls and equal orders."""
    texts = spark.createDataFrame([(3, "x abc"), (2, "y abc z"), (2, "a abc z"), (9, "q"), (5, None), (1, "nothing")], "o int, t string").coalesce(1)
    forms = spark.createDataFrame([("abc",), ("q",), ("none",), ("",)], "f string")
    found = replacement.first_contexts(forms, texts, "f", "o", "t", 2)
    assert {tuple(x) for x in found.collect()} == {("abc", 2, "…a abc z…"), ("q", 9, "…q…")} and found.schema["o"].dataType.simpleString() == "int"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"


def test_texts_are_cleaned_in_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    texts = spark.range(3000).selectExpr("id", "'a teh b' AS text").coalesce(1)
    done = replacement.cleaned(texts, [("the", ["teh"])])
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"
    assert done.filter("text = 'a the b'").count() == 3000
