import hashlib
import re
import struct
from collections import Counter

import xxhash

from tessera.llm import imatch

signed = lambda x: x - (1 << 64) if x >> 63 else x


def terms(text):
    return {t for t in re.split(imatch.SPLIT, text.lower()) if t}


def prints(text, known):
    numbers = sorted({signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in terms(text) if t in known})
    if not numbers:  # of its own terms
        own = 42
        for t in sorted(terms(text)):
            own = xxhash.xxh64_intdigest(t.encode(), own)
        own = xxhash.xxh64_intdigest(struct.pack("<Q", own), 42)
        return [xxhash.xxh64_intdigest(struct.pack("<i", c), own) & ((1 << 31) - 1) for c in range(64)]
    out = []
    for first, bits in imatch.LEVELS:
        for c in range(imatch.SUBSETS):
            own = [x for x in numbers if (x >> first) & ((1 << bits) - 1) == c]
            seed = 42
            for x in own:
                seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
            out.append(seed & ((1 << 31) - 1) if own else None)
    return out


def like(a, b):
    either = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
    return sum(x == y for x, y in either) / len(either) if either else 1.0


def brute(rows, low=imatch.LOW, high=imatch.HIGH):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or ("" if isinstance(r[0], str) else 0), r[1].encode()))
    texts = {x for _, x in rows}
    df = Counter(t for x in texts for t in terms(x))
    known = {t for t, n in df.items() if max(2, low * len(texts)) <= n <= max(2, high * len(texts))}
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        edited = t[: len(t) - h] + after[:h]
        a, b, c = prints(t, known), prints(edited, known), prints(after, known)
        text = lambda p: ".".join("" if x is None else f"{x:x}" for x in p)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), like(a, b), like(a, c)))
    return sorted(out, key=str)


def test_like_brute_force(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    monkeypatch.setattr(imatch, "CELL", 7)
    got = imatch.op4_imatch(spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    edited, following = (sum(r[k] for r in got) / len(got) for k in ("near_edited", "near_next"))
    assert edited > 2 * following


def test_special_inputs(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BROADCAST_ROWS", 0)
    rows = [(5, "One two"), (5, "One two"), (2, None), (9, "éÉ two ONE three " * 30000), (None, "one"), (None, "é"), (100, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_chars string")
    got = imatch.fingerprint(df, low=0.1, high=0.9).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 0.1, 0.9)
    assert imatch.fingerprint(df.limit(0)).count() == 0
    assert len(imatch.fingerprint(df.limit(1)).collect()) == 1


def test_ids_far_apart_and_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(imatch, "CELL", 3)
    rows = [(i, f"one two w{(i or 0) % 5} x{i} y{(i or 0) // 3}") for i in (*range(40), 10**15, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((str(r[0]), *r[1:]) for r in brute(rows, 0.05, 0.5))
    got = imatch.fingerprint(df, low=0.05, high=0.5).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    held = imatch.with_next(df, "doc_id", "text", imatch.Written(spark))
    sizes = [r["count"] for r in held.groupBy((held.rid / 2**32).cast("long").alias("cell")).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 2 * 3
    names = [(f"id-{i:04d}", t) for i, (_, t) in enumerate(rows)]
    got = imatch.fingerprint(spark.createDataFrame(names, "doc_id string, text string"), low=0.05, high=0.5).collect()
    assert sorted(map(tuple, got)) == sorted(brute(names, 0.05, 0.5))


def test_ranges_of_fewer_ids_than_a_cell_are_cells(spark, monkeypatch):
    monkeypatch.setattr(imatch, "CELL", 1000)
    df = spark.range(2000).selectExpr("id as doc_id", "'one two' as text")
    held = imatch.with_next(df, "doc_id", "text", imatch.Written(spark))
    sizes = [r["count"] for r in held.groupBy((held.rid / 2**32).cast("long").alias("cell")).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 1000 and sum(sizes) == 2000


def test_long_text_among_others(spark):
    rows = [(0, " ".join(f"t{i}" for i in range(40000))), *[(i, f"one t{i} t{i + 1}") for i in range(1, 30)]]
    got = imatch.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), low=0.05, high=0.5).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 0.05, 0.5)


def test_large_groups_of_copies_keep_their_terms(spark):
    """Two groups of copies with no term in common; the frequency of their terms counts distinct texts."""
    rows = [(i, "alpha beta gamma" if i % 3 else "delta epsilon zeta") for i in range(60)]
    got = imatch.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.fingerprint for r in got}) == 2 and {r.near_next for r in got} == {0.0, 1.0}


def test_no_python_on_the_main_path(spark):
    plan = imatch.op4_imatch(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
