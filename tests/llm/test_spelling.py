import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm import spelling


def variants(w):
    """Distance-one neighbours by deleted places."""
    return {w[:k] + w[k + 1 :] for k in range(len(w))}


def brute_near(words):
    near = defaultdict(set)
    words = sorted(words)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if len(a) == len(b):
                ok = sum(x != y for x, y in zip(a, b)) == 1
            elif abs(len(a) - len(b)) == 1:
                ok = min(a, b, key=len) in variants(max(a, b, key=len))
            else:
                ok = False
            if ok:
                near[a].add(b)
                near[b].add(a)
    return near


def brute_vocabulary(rows):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(rows):
    n = brute_vocabulary(rows)
    near, form = brute_near(n), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def some_words(r, k, letters="abé"):
    out = set()
    while len(out) < k:
        w = "".join(r.choice(letters) for _ in range(r.randint(5, 9)))
        out.add(w)
        if r.random() < 0.5:
            out.add("".join(r.choice(letters) if r.random() < 0.15 else c for c in w) + r.choice(["", "", "a"]))
    return sorted(out)


@pytest.mark.parametrize("group_words", [10_000, 40, 3, 0])
def test_near_pairs(spark, group_words):
    words = some_words(random.Random(group_words), 500) + ["aaaaa", "aaaaaa", "aaaaaaa", "aabaaa", "a" * 300, "a" * 150 + "b" + "a" * 150]
    words = sorted(set(words))
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r.a, r.b) for r in spelling.near_pairs(df, group_words=group_words).collect()]
    near = brute_near(words)
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in near for b in near[a] if a < b}


@pytest.mark.parametrize("group_words", [10_000, 5])
def test_nearest(spark, group_words):
    r = random.Random(5)
    n = {w: r.choice([3, 3, 5, 7, 20]) for w in some_words(r, 400)}
    got = {x.word: (x.n_near, x.best_n, x.best) for x in spelling.nearest(spark.createDataFrame(list(n.items()), "word string, n long"), group_words=group_words).collect()}
    near = brute_near(n)
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    assert got == {w: (len(near[w]), n[v], v) for w, v in best.items()}


def texts(r, rows):
    words = some_words(r, 250, "abcé") + ["Übung", "ÜBUNG", "naïve", "x×y÷z", "abcd", "abc"]
    return [(i, " ".join(r.choice(["", "", "1", "ß", ",", "日"]) + (w.upper() if r.random() < 0.3 else w) for w in r.choices(words, k=r.randint(0, 60)))) for i in range(rows)]


def test_whole_query(spark):
    rows = texts(random.Random(2), 150) + [(None, "abcde abcde abcde"), (151, None), (152, ""), (153, "abcdeabcde " * 3000), (7, "abcdf abcdf abcdf"), (7, "abcdf abcdf abcdf")]
    rows.append((154, "éabcde " + "z" * 20000 + " " + "ÿ" * 50))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string")
    got = spelling.groups(spelling.vocabulary(df))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_slips_delete_code_points(spark):
    rows = [(i, "wörter") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.vocabulary(df, min_count=1).collect()} == Counter(
        w if h % 97 else w[: h % 6] + w[h % 6 + 1 :] for i, w in rows for h in [zlib.crc32(f"{i}:{w}".encode())]
    )


def test_chains_and_empty(spark):
    n = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "ccccc": 3, "ccccd": 5}
    got = {r.word: (r.form, r.root) for r in spelling.groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got["aaaaa"] == ("aaaab", "bbbbb") and got["bbbbb"] == (None, "bbbbb") and got["ccccc"] == (None, "ccccc")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.groups(spelling.vocabulary(none)).collect() == []
    with pytest.raises(ValueError):
        spelling.groups(spark.createDataFrame([("abc", 3)], "word string, n long"))
