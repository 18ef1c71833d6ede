import random
import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import quality, scan


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(8)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines), len(re.findall("[A-Z]", text))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB# é\n\t", max_size=60)), max_size=6))
def test_measures_like_brute_force(texts):
    got = [list(map(int, r)) for w in scan.words(pa.array(texts, pa.string())) for r in zip(*quality.measures(w), strict=True)]
    assert got == [brute(t) for t in texts]


def made(n=600):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    rows, bad = [], set()
    for i in range(n):
        words = [word() for _ in range(r.randint(30, 90))]
        source = f"s{i % 3}"
        if source == "s2":  # a source where symbols are ordinary
            words = [w + "#" if r.random() < 0.5 else w for w in words]
        if i % 20 == 0:
            bad.add(i)
            kind = r.choice(["symbols", "capitals", "long"])
            words = [w + "$$$%%&" if kind == "symbols" else w.upper() if kind == "capitals" else w * 6 for w in words]
        rows.append((i, " ".join(words), "en", source))
    return rows, bad


def test_fences_follow_each_source(spark):
    rows, bad = made()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in quality.assess(df).collect()}
    assert {i for i, r in out.items() if not r.kept} == bad
    for i, text, *_ in rows:
        assert [out[i][m] for m in quality.MEASURES] == brute(text)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(out) - bad


def test_quantiles_within_the_error(spark):
    rows, _ = made()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    stats = quality.measured(df, [*quality._grouped("lang", "source")]).cache()
    found = {r.q_source: r for r in quality.quantiles(quality.sketches(stats, ["q_source"]), ["q_source"]).filter("ratio = 'word_length'").collect()}
    for source, f in found.items():
        values = sorted(r.word_chars / r.n_words for r in stats.filter(f"q_source = '{source}'").collect())
        for level, got in ((0.25, f.low), (0.5, f.mid), (0.75, f.high)):
            want = values[max(0, -(-round(len(values) * 1000 * level) // 1000) - 1)]
            assert abs(got - want) <= 0.0101 * want
        assert f.docs == len(values)


def test_places_and_widths_follow_the_sketches(spark):
    """Two sources of one language with the same median: the wider one has the wider fence."""
    r = random.Random(6)
    rows = []
    for i in range(2000):
        spread = 0.2 if i % 2 else 2.0
        size = max(1, round(r.gauss(6, spread)))
        rows.append((i, " ".join(f"{k:0{size}d}" for k in range(40)), "en", f"s{i % 2}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    stats = quality.measured(df, [*quality._grouped("lang", "source")]).cache()
    f = {x.q_source: x for x in quality.fences(quality.sketches(stats, ["q_lang", "q_source"])).filter("ratio = 'word_length'").collect()}
    assert f["s0"].ceiling - f["s0"].floor > 2 * (f["s1"].ceiling - f["s1"].floor)


def test_a_groups_share_grows_without_a_step(spark):
    own = spark.createDataFrame([("en", "word_length", n, 1.0, 2.0, 3.0) for n in (1, 50, 100, 10**6)], "q_lang string, ratio string, docs long, low double, mid double, high double")
    wider = spark.createDataFrame([("en", "word_length", 10**7, 5.0, 6.0, 7.0)], own.schema)
    got = {r.docs: (r.low, r.mid, r.high) for r in quality.shrunk(own, wider, ["q_lang"]).collect()}
    for n, values in got.items():
        w = quality.WEIGHT / (n + quality.WEIGHT)
        assert all(abs(v - (x + 4 * w)) < 1e-9 for v, x in zip(values, (1.0, 2.0, 3.0), strict=True))


def test_merging_order_changes_nothing(spark):
    rows, _ = made(200)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    a, b = (sorted(map(tuple, quality.assess(d).collect())) for d in (df.repartition(7), df.orderBy(df.doc_id.desc()).coalesce(1)))
    assert a == b


def test_special_inputs(spark, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    rows = [(1, None, None, None, "x"), (1, None, None, None, "x"), (2, "", "en", None, "x"), (3, "same words " * 40000, "en", "s", "x"), (None, " ".join(f"w{i}" for i in range(40)), None, "s", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    out = quality.assess(df).collect()
    assert len(out) == 5 and [r.kept for r in out if r.doc_id is None] == [True] and not any(r.kept for r in out if r.doc_id)
    assert quality.keep_good(df).count() == 1
    assert quality.assess(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in quality.op2_quality(spark, sf).collect():
        want = brute(docs[r.doc_id])
        assert [r[m] for m in quality.MEASURES] == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.kept and r.base_failed)
