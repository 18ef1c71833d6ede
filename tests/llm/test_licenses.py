import random
import re

from tessera.llm import licenses

T = licenses.TEMPLATES


def grams(text):
    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", text.lower())
    return w


def contained(template, text):
    """Best share of a template's shingles in any window of twice its words, at every word."""
    t, w = grams(template), grams(text)
    size = min(5, len(t))
    want = {tuple(t[i : i + size]) for i in range(len(t) - size + 1)}
    best = 0.0
    for i in range(max(1, len(w) - 2 * len(t) + 1)):
        x = w[i : i + 2 * len(t)]
        best = max(best, len(want & {tuple(x[k : k + size]) for k in range(len(x) - size + 1)}) / len(want))
    return best


def test_bands_guarantee_templates():
    assert min(licenses.Index(T).guaranteed().values()) > 0.999999


def test_like_brute_force(spark):
    r = random.Random(3)
    rows = []
    for i in range(60):
        words = [r.choice("lorem ipsum dolor sit amet the under license version é".split()) for _ in range(r.randint(0, 80))]
        for _ in range(r.randint(0, 2)):
            notice = r.choice(list(T.values())).split(" ")
            if r.random() < 0.4:
                notice[r.randrange(len(notice))] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = [w.upper() if r.random() < 0.3 else w for w in notice]
        rows.append((i, r.choice(["\n", " ", " -- "]).join(words)))
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(x.doc_id, x.license) for x in out}
    for i, text in rows:
        for name, template in T.items():
            if contained(template, text) >= 0.8:
                assert (i, name) in got
            else:
                assert (i, name) not in got
    texts = dict(rows)
    for x in out:
        assert x.contained >= 0.8 and contained(T[x.license], texts[x.doc_id][x.start : x.end]) >= x.contained - 1e-9


def test_special_inputs(spark):
    notice = T["mit"]
    rows = [(1, None, "a"), (2, "", "a"), (None, notice, "a"), (3, notice + " x" * 100 + "\n" + notice, "a"), (3, notice + " x" * 100 + "\n" + notice, "a"), (4, "word " * 60000 + notice, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    out = sorted((x.doc_id or 0, x.license, x.start) for x in licenses.scan_licenses(df).collect())
    assert out == [(0, "mit", 0)] + [(3, "mit", 0)] * 2 + [(3, "mit", 232)] * 2 + [(4, "mit", 300000)]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(x.doc_id, x.license) for x in licenses.op8_licenses(spark, sf).collect()}
    plain = {n: t for n, t in T.items() if n in ("mit", "apache-2.0", "gpl-3.0", "cc-by-nc-4.0", "all-rights-reserved")}
    assert {(i, n) for i, t in docs.items() for n, x in plain.items() if x in t} <= got
