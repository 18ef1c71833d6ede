import random
import re

from tessera.llm import jaccard_join


def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size=5):
    """Components by comparing all pairs of small fixtures."""
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in sets:
        for g in s:
            index.setdefault(g, []).append(i)
    by = dict(sets)
    tried = set()
    for ids in index.values():
        for x in ids:
            for y in ids:
                if x < y and (x, y) not in tried:
                    tried.add((x, y))
                    c = len(by[x] & by[y])
                    if 100 * c >= 80 * (len(by[x]) + len(by[y]) - c):
                        a, b = sorted((root(x), root(y)))
                        parent[b] = a
    return sorted((i, len(s), root(i)) for i, s in sets)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, jaccard_join.near_duplicates(df, **kw).collect()))


def edited(r, words, rate):
    return [r.choice("abcdefgh") * 3 if r.random() < rate else w for w in words]


def test_chains_and_hot_groups(spark):
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefghijk") for _ in range(4)) for _ in range(300)]
    passage = [r.choice(vocab) for _ in range(60)]
    rows = []
    for base in range(6):
        words = [r.choice(vocab) for _ in range(r.choice([12, 40, 150]))]
        for _ in range(25):
            rows.append((len(rows), " ".join(edited(r, words, r.choice([0, 0.005, 0.02, 0.05])))))
    words = [r.choice(vocab) for _ in range(100)]
    for _ in range(40):  # a chain: each is close to the one before, the ends are far from each other
        words = edited(r, words, 0.01)
        rows.append((len(rows), " ".join(words)))
    for n in [0, 10, 40, 200]:  # one passage that many share
        for _ in range(12):
            rows.append((len(rows), " ".join(passage + [r.choice(vocab) for _ in range(n)])))
    r.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_special_inputs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    long = "w1 w2 w3 w4 w5 w6 w7 " * 20000
    rows = [(9, None), (8, ""), (7, " \n"), (6, "One two"), (5, "one TWO"), (4, "one"), (3, "one two three four five"), (2, "ONE two three four five"), (1, long), (0, long + "x"), (20, "É x"), (21, "é x")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, "a b", 1), (2, "a b", 1)], "doc_id long, text string, n long")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [(-1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard_join.op6_ngram_jaccard(spark, sf).collect())) == brute(rows)


def test_rounds_ask_for_the_sets_of_their_pairs(spark, monkeypatch):
    sets = spark.createDataFrame([(i, 1, [i]) for i in range(6)], "doc long, n long, shingles array<long>")
    pairs = spark.createDataFrame([(1, 4), (1, 5)], "x long, p long")
    assert sorted(r.doc for r in jaccard_join.asked(sets, pairs).collect()) == [1, 4, 5]
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    assert jaccard_join.asked(sets, pairs) is sets
