"""Dictionary replacement by automaton against a scan by places, contexts against a loop."""

import random

from pyspark.sql import functions as F

from tessera.functions import vocabulary as V
from tessera.operators import replacement as R


def by_places(text, terms, guards):
    """The same rules, place by place: longest form first, canonicals stay, guarded variants are skipped."""
    becomes = {v: c for c, vs in terms for v in vs if v and v != c}
    names = sorted({c for c, _ in terms} | set(becomes), key=lambda n: (-len(n), n))
    out, hits, skips, at = [], {}, {}, 0
    while at < len(text):
        for n in names:
            if text.startswith(n, at):
                before, after = guards.get(n, ("", ""))
                if n not in becomes:
                    out.append(n)
                elif (at and text[at - 1] in before) or (text[at + len(n) : at + len(n) + 1] and text[at + len(n)] in after):
                    skips[becomes[n]] = skips.get(becomes[n], 0) + 1
                    continue
                else:
                    out.append(becomes[n])
                    hits[becomes[n]] = hits.get(becomes[n], 0) + 1
                at += len(n)
                break
        else:
            out.append(text[at])
            at += 1
    return "".join(out), hits, skips


def test_like_a_scan_by_places(spark):
    r = random.Random(3)
    word = lambda k: "".join(r.choice("abc和") for _ in range(r.randint(1, k)))
    terms = [(word(5), [word(4) for _ in range(r.randint(0, 4))]) for _ in range(40)]
    forms = [v for _, vs in terms for v in vs]
    guards = {v: (r.choice(["", "a", "bc"]), r.choice(["", "和", "ab"])) for v in forms if r.random() < 0.5}
    texts = ["".join(r.choice("abc和. ") for _ in range(r.randint(0, 80))) for _ in range(150)] + ["", "abc" * 20_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(-1, None)], "k long, text string")
    got = {x.k: x for x in R.cleaned(df, terms, guards).collect()}
    for k, t in enumerate(texts):
        text, hits, skips = by_places(t, terms, guards)
        assert got[k].text == text
        assert {h.canonical: h.n for h in got[k].hits} == hits and {h.canonical: h.n for h in got[k].skipped} == skips
    assert got[-1].text is None and not got[-1].hits
    counts = {x.k: (x.n, x.skipped) for x in R.hit_counts(R.cleaned(df, terms, guards), "k").groupBy("k").agg(F.sum("n").alias("n"), F.sum("skipped").alias("skipped")).collect()}
    for k, t in enumerate(texts):
        _, hits, skips = by_places(t, terms, guards)
        assert counts.get(k, (0, 0)) == (sum(hits.values()), sum(skips.values()))


def test_empty_dictionary_and_one_broadcast(spark):
    df = spark.createDataFrame([("abc",), (None,)], "text string")
    done = R.cleaned(df, [])
    assert [x.text for x in done.collect()] == ["abc", None]
    many = [(f"canonical {k}", [f"form{k}x"]) for k in range(20_000)]
    row = R.cleaned(spark.createDataFrame([("form7x form19999x form",)], "text string"), many).first()
    assert row.text == "canonical 7 canonical 19999 form"


def test_first_contexts(spark, monkeypatch):
    r = random.Random(8)
    texts = [(k, "".join(r.choice("ab\n") for _ in range(r.randint(0, 120)))) for k in range(60)] + [(60, None), (61, "")]
    forms = list({"".join(r.choice("ab") for _ in range(r.randint(1, 7))) for _ in range(60)}) + ["zz"]
    want = {}
    for f in forms:
        for k, t in texts:
            at = (t or "").find(f)
            if at >= 0:
                want[f] = (k, "…" + t[max(0, at - 22) : at + len(f) + 22].replace("\n", " ") + "…")
                break
    fs = spark.createDataFrame([(f,) for f in forms + ["", None]], "form string")
    df = spark.createDataFrame(texts, "k long, t string").repartition(3)
    for lot in (1000, 7):
        monkeypatch.setattr(R, "LOT", lot)
        got = R.first_contexts(fs, df, "form", "k", "t").collect()
        assert {x.form: (x.k, x.context) for x in got} == want and len(got) == len(want)
    assert R.first_contexts(fs.limit(0), df, "form", "k", "t").collect() == []


def test_enriched(spark):
    texts = spark.createDataFrame([(1, "x ab y"), (2, "cd")], "k long, t string")
    pairs = spark.createDataFrame([(V.ANCHORED, "dict", "ab", None), ("other", "cd", "zz", 5)], "kind string, a string, b string, na long")
    rows = {x.b: x for x in R.enriched(pairs, texts, "k", "t").collect()}
    assert (rows["ab"].na, rows["ab"].ctx_a, rows["ab"].ctx_b, rows["ab"].suggest) == (2, "(词典 canonical:dict)", "…x ab y…", V.SUGGEST[0])
    assert (rows["zz"].na, rows["zz"].ctx_a, rows["zz"].ctx_b, rows["zz"].suggest) == (5, "…cd…", "", V.SUGGEST[1])
