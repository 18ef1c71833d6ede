import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tessera.llm import collocations
from tessera.llm.shared import Written


def brute(rows, least, top, most=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = defaultdict(list)
    cands = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    for (lang, p), a in cands.items():
        inside = any(
            g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 100 * a for (g, q), b in cands.items()
        )
        if inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for k, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def some_rows(seed, k):
    r = random.Random(seed)
    words = ["a", "b", "Cc", "dé", "é", "x y", "日本", "E"]
    phrases = [[r.choice(words) for _ in range(r.randint(2, 6))] for _ in range(6)]
    rows = []
    for _ in range(k):
        text = ""
        for _ in range(r.randint(0, 12)):
            text += " ".join(r.choice(phrases) if r.random() < 0.5 else [r.choice(words)]) + r.choice([" ", "  ", "\t", ". ", ",", "\n", "! ", " ?", "\x0b"])
        rows.append((r.choice(["en", "en", "en", "de", None, ""]), text))
    return rows + [("en", None), ("fr", ""), ("fr", "."), ("de", "a b " * 2000), (None, "a b")]


@pytest.mark.parametrize("seed,least,top,shard", [(1, 5, 2000, 1 << 21), (2, 20, 7, 50), (3, 2, 3, 1), (4, 1, 2000, 300)])
def test_brute_force(spark, seed, least, top, shard):
    rows = some_rows(seed, 60)
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "lang string, text string, n int").repartition(3)
    got = collocations.collocations(df, least=least, top=top, shard_words=shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_bits_that_let_all_in_change_nothing(spark):
    rows = some_rows(9, 40)
    texts = spark.createDataFrame(rows, "lang string, text string").selectExpr("coalesce(lang, 'und') as lang", "coalesce(text, '') as text")
    full = np.full(collocations.BITS // 64, 2**64 - 1, np.uint64)
    every = {(r.lang, r.phrase): r.f for r in collocations.phrase_counts(texts, [full, full], 5).collect()}
    phrases, _ = collocations.frequent_phrases(texts, Written(spark), least=4)
    assert {(r.lang, r.phrase): r.f for r in phrases.collect()} == {k: n for k, n in every.items() if n >= 4}


def test_task_sums_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MERGED_ROWS", 3)
    merged, out = collocations.Merged(), Counter()
    r = random.Random(2)
    want = Counter(r.choice("abcdefgh") for _ in range(200))
    every = [x for x, n in want.items() for _ in range(n)]
    import pyarrow as pa

    parts = [pa.RecordBatch.from_pydict({"lang": ["x"], "words": pa.array([1], pa.int32()), "phrase": [w], "n": [1]}) for w in every]
    for rows in [*(b for p in parts for b in merged.add(p)), *merged.rows()]:
        for w, n in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist()):
            out[w] += n
    assert out == want and not merged.held


def test_suffix_array():
    r = np.random.default_rng(3)
    ids = r.integers(0, 3, 200)
    reach = np.ones(200, int)
    for i in range(198, -1, -1):
        reach[i] = min(reach[i + 1] + 1, 5) if r.random() < 0.7 else 1
    order, common = collocations.suffix_array(ids, reach, 5)
    suffix = [tuple(ids[i : i + reach[i]]) for i in range(200)]
    assert [suffix[i] for i in order] == sorted(suffix)
    for a, b, c in zip(order, order[1:], common[1:]):
        same = [x == y for x, y in zip(suffix[a], suffix[b])]
        assert c == (same + [False]).index(False)


def test_large_products(spark):
    big = 10**10
    phrases = spark.createDataFrame([("x", 2, "a b", big), ("x", 1, "a", big + 7), ("x", 1, "b", big + 9)], "lang string, words int, phrase string, f long")
    totals = spark.createDataFrame([("x", 10**13 + 1)], "lang string, n long")
    row = collocations.scored(phrases, totals, Written(spark)).first()
    assert row.score == 1000 * big * (10**13 + 1) // ((big + 7) * (big + 9))


def test_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_sql(spark):
    rows = some_rows(5, 900)
    df = spark.createDataFrame(rows, "lang string, text string")
    con = duckdb.connect()
    table = df.toArrow()
    con.register("documents", table)
    assert sorted(con.execute(collocations.ORACLE_SQL).fetchall()) == sorted(map(tuple, collocations.collocations(df).collect()))


def test_task_holds_few_rows_that_are_not_added_up(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "MERGED_ROWS", 400)
    merged, out = collocations.Merged(), Counter()
    r = random.Random(4)
    for _ in range(60):
        some = [f"p{k}" for k in r.sample(range(200), 50)]
        rows = pa.RecordBatch.from_pydict({"lang": ["x"] * 50, "words": pa.array([1] * 50, pa.int32()), "phrase": some, "n": [1] * 50})
        out.update(some)
        assert not list(merged.add(rows))
        assert merged.n <= 1.5 * max(merged.different, 200)
    got = {w: n for b in merged.rows() for w, n in zip(b.column(2).to_pylist(), b.column(3).to_pylist())}
    assert got == out


def test_last_reading_takes_wide_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    for splits, tasks in ((cores * 16, cores * 4), (cores, cores)):
        texts = spark.range(0, 1000, 1, splits).selectExpr("'en' as lang", "'a b' as text")
        assert collocations.in_wide_tasks(texts).rdd.getNumPartitions() == tasks
