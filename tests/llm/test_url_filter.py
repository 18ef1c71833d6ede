import re
from collections import Counter
from itertools import combinations

from tessera.llm import url_filter


def split(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def given(url, rules=url_filter.RULES):
    host, path = split(url)
    fits = []
    for r, v in rules:
        h, p = r.split("/", 1)
        if host and (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r), r, v))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://example.org/en/123", "https://a.EXAMPLE.org/es/1?x=1", "https://example.org/es", "http://myexample.org/es/", "x.org/", None, "", "ftp://com/fr/", "http://b.com/fr?x", "http://b.com/de/1#f",
    "http://b.net/de/5", "http://net", "http:///path", "http://org?q=/es/", "http://example.org/en/2", "a://b://c.org/", "HTTP://WWW.ÉX.COM/de/é", "http://.com/de/", "http://b.com/DE/",
]


def test_given_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string")
    out = url_filter.judge(df, None).collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        url = URLS[r.page_id % len(URLS)]
        rule, verdict = given(url)
        assert (r.host, r.path) == split(url) and r.rule == rule and (verdict is None or r.verdict == verdict), url
    assert url_filter.judge(df.limit(0), None).count() == 0


def test_mined_rules_like_brute_force(spark):
    rows, marks = [], []
    for i in range(400):
        spam, deep = i % 5 == 0, i % 3 == 0
        rows.append((i, f"http://{'bad' if spam else 'good'}{i % 2}.net/{'x' if deep else 'y'}/{i}"))
        if i % 2:
            marks.append((i, 1, int(spam and deep)))
    df = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = {r.page_id: r for r in url_filter.judge(df, labels, support=0.02, confidence=0.8).collect()}
    toks = {i: set(df.sparkSession.createDataFrame([], "a int").schema and []) for i, _ in rows}
    host, path = url_filter.host_and_path(df.url)
    for r in df.select("page_id", url_filter.tokens(host, path, df.url).alias("t")).collect():
        toks[r.page_id] = set(r.t)
    count, both = Counter(), Counter()
    for i, _, bad in marks:
        label = "block" if bad else "allow"
        for k in range(1, len(toks[i]) + 1):
            for c in combinations(sorted(toks[i]), k):
                count[c] += 1
                both[c, label] += 1
    rules = [(both[c, v] / count[c], both[c, v] / len(marks), v == "allow", 0, c, v) for c, v in both if both[c, v] / len(marks) >= 0.02 and both[c, v] / count[c] >= 0.8]
    for i, _ in rows:
        fits = [r for r in rules if set(r[4]) <= toks[i]]
        want = max((round(r[0], 9), round(r[1], 9), r[2], r[3], r[5]) for r in fits)[4] if fits else "allow"
        assert out[i].verdict == want
    assert {r.verdict for r in out.values()} == {"allow", "block"}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = url_filter.op10_url_filter(spark, sf).collect()
    assert len(out) == len(urls)
    for r in out:
        rule, verdict = given(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (*split(urls[r.page_id]), rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
