"""Quote places against a search by places."""

import random
import re

import pytest

from tessera.operators import quotes as Q
from tessera.operators import retrieval as T


def brute(quotes, texts, squeeze, same=False):
    out = []
    for q, quote in quotes:
        s = re.sub(r"\s+", "", quote or "") if squeeze else quote or ""
        for t, text in texts:
            if not s or (same and q[0] != t):
                continue
            at = [k for k, c in enumerate(text or "") if not (squeeze and c.isspace())]
            own = "".join((text or "")[k] for k in at)
            out += [(q, t, at[p], at[p + len(s) - 1] + 1) for p in range(len(own) - len(s) + 1) if own.startswith(s, p)]
    return sorted(out)


def cases(seed):
    r = random.Random(seed)
    say = lambda n: "".join(r.choice("ab  é\n𝕏") for _ in range(n))
    texts = [(k, say(r.randint(0, 150))) for k in range(30)] + [(30, None), (31, ""), (32, "ab" * 3000), (33, "a a" * 40)]
    quotes = []
    for k in range(40):
        t = r.choice(texts)[1] or ""
        i = r.randrange(len(t) + 1)
        quotes.append((k, t[i : i + r.choice([1, 2, 5, 11, 12, 13, 24, 40, 100])]))
    return [*quotes, (40, None), (41, " \n"), (42, "abab" * 10), (43, "zzz")], texts


@pytest.mark.parametrize("squeeze,gram", [(True, 12), (False, 12), (True, 3)])
def test_all_places(spark, squeeze, gram):
    quotes, texts = cases(gram)
    got = Q.quote_places(spark.createDataFrame(quotes, "q long, quote string"), spark.createDataFrame(texts, "t long, text string").repartition(3), "q", "quote", "t", "text", squeeze=squeeze, gram=gram)
    assert got.columns == ["q", "t", "start", "end"]
    assert sorted(map(tuple, got.collect())) == brute(quotes, texts, squeeze)


def test_within_own_text(spark):
    quotes, texts = cases(5)
    r = random.Random(1)
    own = [(r.randrange(34), k, q) for k, q in quotes]
    got = Q.quote_places(spark.createDataFrame(own, "t long, q long, quote string"), spark.createDataFrame(texts, "t long, text string"), "q", "quote", "t", "text", on=["t"])
    want = [(t, q, s, e) for (t, q), _, s, e in brute([((t, q), quote) for t, q, quote in own], texts, True, same=True)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_nothing(spark):
    none = spark.createDataFrame([], "q long, quote string")
    texts = spark.createDataFrame([(1, "abc")], "t long, text string")
    assert Q.quote_places(none, texts, "q", "quote", "t", "text").collect() == []
    assert Q.quote_places(spark.createDataFrame([(1, "abc")], "q long, quote string"), texts.limit(0), "q", "quote", "t", "text").collect() == []


def test_truth_is_the_first_chunk(spark):
    chunks = spark.createDataFrame([("a", 2, "xx the quote yy"), ("a", 1, "the quote"), ("b", 3, "the quote"), ("b", 0, None)], "course string, id long, text string")
    asked = spark.createDataFrame([("a", 7, "the quote"), ("b", 8, "the quote"), ("b", 9, ""), ("a", 10, "no"), ("a", 11, None)], "course string, q long, quote string")
    got = T.truth(chunks, asked, "id", "text", "q", "quote", ["course"])
    assert sorted(map(tuple, got.select("course", "q", "id").collect())) == [("a", 7, 1), ("b", 8, 3), ("b", 9, 0)]
